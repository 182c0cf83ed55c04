"""Aggregates of a time series over an interval relative to each event.

For an event at time T the interval is closed: [T + start, T + end]. All events share its length,
so no (event, series row) pair has to be formed. Time is cut into tiles of fixed widths, each level
`FAN` times as wide as the one below. An interval is the tail of its first tile, the head of its
last one and the whole tiles between; these are, one level up, again a tail, a head and whole tiles
between, until fewer than `FAN` of the widest tiles that fit into the interval are left. Heads and
tails are running aggregates, so an event costs two look-ups a level. Series rows of one instant
are combined before anything is shuffled by tile, which bounds a window partition by the instants
of the smallest tile or by a few times `FAN` rows, for any interval length and whatever share of
the rows a single key or period holds.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from eventwin.functions.times import HOUR, time_micros

STATS = ("rows", "count", "mean", "min", "max", "std")
TILE = 60_000_000  # microseconds; upper bound for the number of instants of one key in a tile
FAN = 4_096  # tiles of one level in a tile of the next
DIGITS = 18  # of a decimal's distance from the overall mean, in units of its last place
LIMB = 30  # bits of a whole number that is summed on its own
MOST_LIMBS = 8  # a DOUBLE is read down to 2^-240 of the largest one of its column
LEAST_UNIT = -1022  # power of two below which no DOUBLE is read

NO_TIME = -9_000_000_000_000_000_000  # far below the first representable timestamp

_ITEM, _TAIL, _HEAD = 0, 1, 2


@dataclass(frozen=True)
class Interval:
    """Closed interval [T + start_hours, T + end_hours]; offsets may be negative or fractional."""

    start_hours: float
    end_hours: float

    @property
    def start(self) -> int:
        return round(self.start_hours * HOUR)

    @property
    def end(self) -> int:
        return round(self.end_hours * HOUR)

    @property
    def length(self) -> int:
        return self.end - self.start


@dataclass(frozen=True)
class _Part:
    """One mergeable number kept per instant, tile or interval."""

    name: str
    first: str  # aggregate over raw rows
    how: str  # "sum", "min" or "max"

    @property
    def merge(self) -> str:
        return f"{self.how}({self.name})"


def _quoted(names: Iterable[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def tile_widths(length: int, tile: int | None = None) -> list[int]:
    """Widths of the levels: from a minute (or `tile`) up by `FAN`, none wider than the interval."""
    widths = [min(tile or TILE, length)]
    while widths[-1] * FAN <= length:
        widths.append(widths[-1] * FAN)
    return widths


def _floor_div(col: str, by: int) -> str:
    return f"(({col}) - pmod({col}, {by}L)) div {by}L"


def _measure(df: DataFrame, name: str) -> Column:
    """The column as DECIMAL (exact sums) or DOUBLE with NaN read as missing."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(name)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _scan(rows: DataFrame, by: Sequence[str], pos: str, parts: Sequence[_Part]) -> DataFrame:
    """Running aggregates at the probe rows: `_TAIL` from `pos` on, `_HEAD` up to `pos`, both inclusive."""
    group = ", ".join(_quoted(by))

    def running(direction: str, mark: str) -> list[str]:
        over = f"over (partition by {group} order by {pos} {direction}, _kind rows unbounded preceding)"
        return [f"{p.merge} {over} as {mark}{p.name}" for p in parts]

    keep = [c for c in rows.columns if c not in {p.name for p in parts}]
    return (
        rows.selectExpr("*", *running("desc", "_tail")).selectExpr("*", *running("asc", "_head"))
        .where(f"_kind <> {_ITEM}")
        .selectExpr(*_quoted(keep), *[f"if(_kind = {_TAIL}, _tail{p.name}, _head{p.name}) as {p.name}" for p in parts])
    )


def _probes(df: DataFrame, shared: Sequence[str], ends: Mapping[int, str], pos: str, like: DataFrame,
            parts: Sequence[_Part]) -> DataFrame:
    """One probe row per end (kind -> position) of each row; a null position drops the probe."""
    spots = ", ".join(f"struct({kind} as _kind, {at} as {pos})" for kind, at in ends.items())
    empty = [f"cast(null as {like.schema[p.name].dataType.simpleString()}) as {p.name}" for p in parts]
    return df.selectExpr(*shared, f"inline(array({spots}))").where(f"{pos} is not null").selectExpr("*", *empty)


def _merge(df: DataFrame, by: Sequence[str], parts: Sequence[_Part]) -> DataFrame:
    return df.groupBy(*_quoted(by)).agg(*[F.expr(f"{p.merge} as {p.name}") for p in parts])


def _between(pairs: DataFrame, tiles: DataFrame, keys: Sequence[str], widths: Sequence[int], length: int,
             parts: Sequence[_Part]) -> DataFrame:
    """Merged tiles `_a + 1 … _b - 1` of the lowest of `widths` for each distinct (keys, `_a`, `_b`) of `pairs`."""
    k, names = _quoted(keys), [p.name for p in parts]
    top = len(widths) == 1
    by = length // widths[0] if top else FAN
    group = lambda at: _floor_div(at, by)
    if top:  # by or by - 1 tiles: a suffix and a prefix of two groups, or one of them
        one = f"{group('_a + 1')} = {group('_b - 1')}"
        prefix = f"pmod(_a + 1, {by}L) = 0"
        ends = {_TAIL: f"if(_b - _a > 1 and not ({one} and {prefix}), _a + 1, null)",
                _HEAD: f"if(_b - _a > 1 and not ({one} and not {prefix}), _b - 1, null)"}
    else:  # the rest of the first tile's group and the beginning of the last one's
        ends = {_TAIL: f"if({group('_a + 1')} = {group('_a')}, _a + 1, null)", _HEAD: f"if({group('_b - 1')} = {group('_b')}, _b - 1, null)"}
    probes = _probes(pairs, [*k, "_a", "_b"], ends, "_at", tiles, parts)
    items = tiles.selectExpr(*k, "_tile as _at", *names, f"{_ITEM} as _kind")
    rows = items.unionByName(probes, allowMissingColumns=True).selectExpr("*", f"{group('_at')} as _group")
    found = _scan(rows, [*keys, "_group"], "_at", parts).select(*k, "_a", "_b", *names)
    if not top:
        wider = _merge(tiles.selectExpr(*k, f"{group('_tile')} as _tile", *names), [*keys, "_tile"], parts)
        homes = pairs.selectExpr(*k, "_a", "_b", f"{group('_a')} as _up_a", f"{group('_b')} as _up_b")
        above = _between(homes.selectExpr(*k, "_up_a as _a", "_up_b as _b").distinct(), wider, keys, widths[1:], length, parts)
        above = above.withColumnsRenamed({"_a": "_up_a", "_b": "_up_b"})
        found = found.unionByName(homes.join(above, [*keys, "_up_a", "_up_b"]).select(*k, "_a", "_b", *names))
    return _merge(found, [*keys, "_a", "_b"], parts)


def _partials(points: DataFrame, instants: DataFrame, keys: Sequence[str], span: Interval,
              parts: Sequence[_Part], tile: int | None) -> DataFrame:
    """Merged parts per distinct (keys, `_t`) of `points`; `instants` has one row per (keys, `_ts`)."""
    k, names = _quoted(keys), [p.name for p in parts]
    low, high = f"_t + {span.start}L", f"_t + {span.end}L"
    if span.length == 0:
        return points.selectExpr("*", f"{low} as _ts").join(instants, [*keys, "_ts"]).select(*k, "_t", *names)
    widths = tile_widths(span.length, tile)
    in_tile = f"{_floor_div('_ts', widths[0])} as _tile"
    placed = instants.selectExpr("*", f"{_ITEM} as _kind", in_tile)
    probes = _probes(points, [*k, "_t"], {_TAIL: low, _HEAD: high}, "_ts", placed, parts).selectExpr("*", in_tile)
    edges = _scan(placed.unionByName(probes, allowMissingColumns=True), [*keys, "_tile"], "_ts", parts)
    homes = points.selectExpr(*k, "_t", f"{_floor_div(low, widths[0])} as _a", f"{_floor_div(high, widths[0])} as _b")
    whole = _between(homes.select(*k, "_a", "_b").distinct(), _merge(placed, [*keys, "_tile"], parts), keys, widths,
                     span.length, parts)
    middle = homes.join(whole, [*keys, "_a", "_b"]).select(*k, "_t", *names)
    return _merge(edges.select(*k, "_t", *names).unionByName(middle), [*keys, "_t"], parts)


@dataclass(frozen=True)
class _Units:
    """The DOUBLE values of a column as whole numbers in units of 2^`unit`, cut into `limbs` of `LIMB` bits."""

    unit: int
    limbs: int

    @classmethod
    def spanning(cls, low: float | None, high: float | None, whole: bool | None) -> "_Units":
        """Down to the last bit of the smallest magnitude `low` and up to the largest one; `whole` if there are no fractions."""
        if not high:
            return cls(0, 1)
        top, last = math.frexp(high)[1], math.frexp(low)[1] - 53
        unit = max(max(last, 0) if whole else last, top - LIMB * MOST_LIMBS, LEAST_UNIT)
        return cls(unit, max(1, -(-(top - unit) // LIMB)))

    def cut(self, value: str, i: int) -> list[str]:
        """The limbs of `value`, each with its sign. A product with a power of two and a remainder lose no bit."""
        def limb(j: int) -> str:
            scaled = f"abs({value}) * double('{2.0 ** -(self.unit + LIMB * j)!r}')"
            return f"cast(signum({value}) as bigint) * cast(floor({scaled} % {2**LIMB}D) as bigint) as _l{i}_{j}"

        return [limb(j) for j in range(self.limbs)]

    def pairs(self, s: int) -> list[tuple[int, int]]:
        return [(j, s - j) for j in range(self.limbs) if 0 <= s - j < self.limbs]

    def sums(self, i: int) -> list[_Part]:
        return [_Part(f"_u{i}_{j}", f"sum(_l{i}_{j})", "sum") for j in range(self.limbs)]

    def squares(self, i: int) -> list[_Part]:
        """Sums of the products of limbs by their common power; at most eight of 60 bits, so a row's fit a long."""
        products = [" + ".join(f"_l{i}_{a} * _l{i}_{b}" for a, b in self.pairs(s)) for s in range(2 * self.limbs - 1)]
        return [_Part(f"_q{i}_{s}", f"sum(cast({p} as decimal(19, 0)))", "sum") for s, p in enumerate(products)]

    def total(self, i: int) -> str:
        return _magnitude([f"cast(_u{i}_{j} as decimal(38, 0))" for j in range(self.limbs)])

    def spread(self, i: int) -> str:
        """n * sum of squares - square of sum, exact until it is read as one DOUBLE."""
        u = lambda j: f"cast(_u{i}_{j} as decimal(20, 0))"
        squared = [" + ".join(f"{u(a)} * {u(b)}" for a, b in self.pairs(s)) for s in range(2 * self.limbs - 1)]
        return _magnitude([f"cast(cast(_n{i} as decimal(20, 0)) * _q{i}_{s} - ({p}) as decimal(38, 0))" for s, p in enumerate(squared)])


def _magnitude(limbs: Sequence[str]) -> str:
    """The whole number sum(limbs[s] * 2^(LIMB * s)) as DOUBLE: carries first, so only digits of one sign are added up."""
    base = f"{2**LIMB}BD"

    def carried(sign: str) -> str:
        step = (f"struct(cast((x.c + p - pmod(x.c + p, {base})) / {base} as decimal(38, 0)) as c, "
                f"x.t + x.w * cast(pmod(x.c + p, {base}) as double) as t, x.w * {2**LIMB}D as w)")
        return (f"aggregate(array({', '.join(sign + l for l in limbs)}), struct(cast(0 as decimal(38, 0)) as c, 0D as t, 1D as w), "
                f"(x, p) -> {step}, x -> struct(x.c as c, x.t + x.w * cast(x.c as double) as t))")

    return f"if({carried('')}.c < 0, -{carried('-')}.t, {carried('')}.t)"


def _survey(series: DataFrame, centred: Sequence[str], limbed: Sequence[str]) -> tuple[dict[str, Decimal], dict[str, _Units]]:
    """From one pass: a centre for each DECIMAL column of `centred`, the units for each DOUBLE one of `limbed`."""
    if not centred and not limbed:
        return {}, {}
    found = []
    for i, c in enumerate(centred):
        kind = series.schema[c].dataType
        found.append(F.round(F.avg(c), kind.scale).cast(kind).alias(f"m{i}"))
    for i, c in enumerate(limbed):
        size = F.abs(_measure(series, c))
        size = F.when((size > 0) & (size < float("inf")), size)
        found += [F.min(size).alias(f"lo{i}"), F.max(size).alias(f"hi{i}"), F.min(size % 1 == 0).alias(f"w{i}")]
    row = series.agg(*found).first()
    return ({c: row[f"m{i}"] or Decimal(0) for i, c in enumerate(centred)},
            {c: _Units.spanning(row[f"lo{i}"], row[f"hi{i}"], row[f"w{i}"]) for i, c in enumerate(limbed)})


def interval_stats(
    events: DataFrame,
    series: DataFrame,
    span: Interval,
    outputs: Mapping[str, tuple[str, str | None]],
    *,
    event_time: str,
    series_time: str,
    keys: Iterable[str] = (),
    tile: int | None = None,
) -> DataFrame:
    """`events` plus one column per entry of `outputs`: name -> (stat, series column).

    stat: `rows` (series rows in the interval, column None), `count` (non-missing values), `mean`,
    `min`, `max`, `std` (population). Intervals without values give null, `rows`/`count` give 0.
    A null event time, or a null key, matches nothing. `tile` sets the smallest tile in microseconds.
    DECIMAL columns are summed exactly, for `std` as distances from their overall mean rounded to their
    scale; totals that 38 digits can't hold are an error. Other columns are read as DOUBLE and summed exactly too,
    as a few whole numbers per value, so `mean` and `std` are right to the last digits wherever the values lie
    and don't depend on how rows are partitioned. Bits below 2^-240 of the column's largest magnitude, or below 2^-1022,
    are cut; more than 2^33 values in an interval are an error. Infinite values make the mean infinite (NaN if both
    signs occur) and `std` NaN.
    """
    keys = list(keys)
    for frame, needed, what in ((events, [event_time, *keys], "events"),
                                (series, [series_time, *keys, *{c for _, c in outputs.values() if c}], "series")):
        missing = [c for c in needed if c not in frame.columns]
        if missing:
            raise ValueError(f"{what} lacks column(s) {missing}")
    if span.length < 0:
        raise ValueError("interval end lies before its start")
    clash = [n for n in outputs if n in events.columns]
    if clash:
        raise ValueError(f"events already has column(s) {clash}")
    wanted: dict[str, set[str]] = {}
    for stat, column in outputs.values():
        if stat not in STATS:
            raise ValueError(f"unknown statistic '{stat}'")
        if column:
            wanted.setdefault(column, set()).add(stat)

    parts: list[_Part] = []
    inputs: list[Column] = []
    slot = {c: i for i, c in enumerate(wanted)}
    decimal = {c for c in wanted if isinstance(series.schema[c].dataType, T.DecimalType)}
    summed = [c for c, stats in wanted.items() if stats & {"mean", "std"} and c not in decimal]
    middle, units = _survey(series, [c for c in wanted if c in decimal and "std" in wanted[c]], summed)
    if any(stat == "rows" for stat, _ in outputs.values()):
        parts.append(_Part("_rows", "count(1)", "sum"))
    for column, stats in wanted.items():
        i, value, kind = slot[column], _measure(series, column), series.schema[column].dataType
        inputs.append(value.alias(f"_v{i}"))
        if column in units:
            parts += units[column].sums(i)
            parts += units[column].squares(i) if "std" in stats else []
        elif "std" in stats:
            centre = F.lit(middle[column]).cast(kind)
            unit = F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))
            far = (value - centre).cast(T.DecimalType(DIGITS, kind.scale)) * unit
            inputs.append(far.cast(T.DecimalType(DIGITS, 0)).alias(f"_c{i}"))
            parts += [_Part(f"_u{i}", f"sum(_c{i})", "sum"), _Part(f"_q{i}", f"sum(_c{i} * _c{i})", "sum")]
        if stats & {"count", "mean", "std"}:
            parts.append(_Part(f"_n{i}", f"count(_v{i})", "sum"))
        if "mean" in stats and column in decimal:
            parts.append(_Part(f"_s{i}", f"sum(_v{i})", "sum"))
        if "min" in stats or column in units:
            parts.append(_Part(f"_lo{i}", f"min(_v{i})", "min"))
        if "max" in stats or column in units:
            parts.append(_Part(f"_hi{i}", f"max(_v{i})", "max"))

    k = _quoted(keys)
    instants = (
        series.select(*k, time_micros(series, series_time).alias("_ts"), *inputs)
        .where("_ts is not null")
        .selectExpr("*", *[e for c, u in units.items() for e in u.cut(f"if(abs(_v{slot[c]}) < double('Infinity'), _v{slot[c]}, null)", slot[c])])
        .groupBy(*k, "_ts")
        .agg(*[F.expr(f"{p.first} as {p.name}") for p in parts])
    )
    stamped = events.withColumn("_t", time_micros(events, event_time))
    points = stamped.select(*k, "_t").where("_t is not null").distinct()
    found = _partials(points, instants, keys, span, parts, tile)

    def result(name: str, stat: str, column: str | None) -> Column:
        i = slot.get(column)
        if stat in ("min", "max"):
            return F.expr(f"cast({'_lo' if stat == 'min' else '_hi'}{i} as double) as `{name}`")
        if stat in ("rows", "count"):
            return F.expr(f"coalesce({'_rows' if stat == 'rows' else f'_n{i}'}, 0L) as `{name}`")
        if column in units:
            scaled = f"/ _n{i} * double('{2.0 ** units[column].unit!r}')"
            exact = f"{units[column].total(i)} {scaled}" if stat == "mean" else f"sqrt({units[column].spread(i)}) {scaled}"
            exact = f"coalesce({exact}, raise_error('the sums of {column} need more than 38 digits'))"
            endless = f"_lo{i} + _hi{i}" if stat == "mean" else "double('NaN')"
            found = f"if(_lo{i} > double('-Infinity') and _hi{i} < double('Infinity'), {exact}, {endless})"
            return F.expr(f"if(_n{i} > 0, {found}, null) as `{name}`")
        if stat == "mean":
            return F.expr(f"cast(_s{i} as double) / nullif(_n{i}, 0) as `{name}`")
        # n * sum of squares - square of sum, in units of the last place: whole numbers
        total = f"cast(_n{i} as decimal(20, 0)) * _q{i} - _u{i} * _u{i}"
        total = f"coalesce({total}, raise_error('the squares of {column} need more than 38 digits'))"
        spread = f"sqrt(cast({total} as double)) / nullif(_n{i}, 0) / {10.0 ** series.schema[column].dataType.scale!r}D"
        return F.expr(f"if(_n{i} > 0, {spread}, null) as `{name}`")

    # events without a time match nothing: give them scattered impossible times, not one shared partition
    hashed = [c for c in events.columns if not isinstance(events.schema[c].dataType, (T.MapType, T.VariantType))]
    nowhere = f"{NO_TIME}L + pmod(xxhash64({', '.join(_quoted(hashed))}), 1000003L)"
    # `_at` is `_t` in a type of its own, so the aggregate's partitioning cannot serve the join: with a
    # shuffle on both sides adaptive execution may split the events of an instant that very many share
    left = stamped.selectExpr("*", f"cast(coalesce(_t, {nowhere}) as decimal(20,0)) as _at").drop("_t")
    right = found.selectExpr("*", "cast(_t as decimal(20,0)) as _at").drop("_t")
    joined = left.join(right, [*keys, "_at"], "left")
    return joined.select(*_quoted(events.columns), *[result(n, *spec) for n, spec in outputs.items()])


def forward_max_label(
    events: DataFrame,
    series: DataFrame,
    *,
    hours: float = 72,
    threshold: float = 5.0,
    event_time: str = "startTime",
    series_time: str = "time",
    value: str = "kp",
    max_name: str | None = None,
    label: str = "label_storm",
    observed: str | None = None,
    keys: Iterable[str] = (),
) -> DataFrame:
    """Highest `value` within `hours` after each event, and whether it reaches `threshold`.

    An event without any value gets a null maximum and label 0; `observed` names an optional count
    of the values seen, so callers can tell "no storm" from "no data".
    """
    top = max_name or f"kp_max_h{hours:g}"
    outputs = {top: ("max", value)}
    if observed:
        outputs[observed] = ("count", value)
    out = interval_stats(events, series, Interval(0, hours), outputs, event_time=event_time,
                         series_time=series_time, keys=keys)
    return out.withColumn(label, F.coalesce(F.col(top) >= F.lit(threshold), F.lit(False)).cast("int"))


@dataclass(frozen=True)
class WindowStats:
    """Which columns to summarise, how, and over which interval after each event."""

    start_hours: float = 24
    end_hours: float = 72
    columns: tuple[str, ...] = ("Bmag", "By_gsm", "Bz_gsm", "V", "Np", "T", "Pdyn", "Efield", "beta", "MachA",
                                "AE", "SYM_H")
    stats: tuple[str, ...] = ("mean", "min", "max", "std")
    series: str = "omni"

    @property
    def prefix(self) -> str:
        return f"{self.series}_w{self.start_hours:g}_{self.end_hours:g}"

    def name(self, stat: str, column: str) -> str:
        return f"{self.prefix}_{stat}_{column}"


def window_features(
    events: DataFrame,
    series: DataFrame,
    spec: WindowStats = WindowStats(),
    *,
    event_time: str = "startTime",
    series_time: str = "time",
    keys: Iterable[str] = (),
) -> DataFrame:
    """Summary statistics of every present column of `spec` over its interval."""
    present = [c for c in spec.columns if c in series.columns]
    if absent := [c for c in spec.columns if c not in present]:
        warnings.warn(f"series lacks {absent}: their statistics are left out", stacklevel=2)
    if not present:
        raise ValueError(f"series has none of the columns {list(spec.columns)}")
    outputs = {spec.name(stat, c): (stat, c) for c in present for stat in spec.stats}
    return interval_stats(events, series, Interval(spec.start_hours, spec.end_hours), outputs,
                          event_time=event_time, series_time=series_time, keys=keys)


def interval_exists(
    events: DataFrame,
    series: DataFrame,
    span: Interval,
    name: str,
    *,
    event_time: str = "startTime",
    series_time: str = "time",
    keys: Iterable[str] = (),
) -> DataFrame:
    """`events` plus a boolean: has the series any row in the interval?"""
    out = interval_stats(events, series, span, {name: ("rows", None)}, event_time=event_time,
                         series_time=series_time, keys=keys)
    return out.withColumn(name, F.col(name) > 0)
