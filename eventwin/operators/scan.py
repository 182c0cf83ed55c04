"""Running totals in value order and exact quantiles, without a single-task sort.

A DOUBLE becomes a whole number in the same order (sign, exponent and mantissa), which is read as four
digits of 16 bits. Totals before a value are those before its first digit, plus those before its second
one among values that share the first, and so on. Each of the four windows is partitioned by the digits
before its own, so none holds more than 65,536 rows of a group, however the values lie.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from math import ceil, floor

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventwin.session import staged

#: Bits below a digit's place, from the first digit to the last.
SHIFTS = (48, 32, 16, 0)
#: A column's sketch errs by at most its number of values over this.
SKETCH = 8_192
#: Most distinct values of a range that one window puts in order; a range with more is cut into so many pieces.
RANGE_VALUES, PIECES = 1 << 20, 256


def _q(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _text(value: str) -> str:
    """A string as an SQL literal, whatever characters it holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unit(value: str, lo: str, hi: str) -> str:
    """Position of `value` in [lo, hi] as 0..1; never decreasing in `value`, 0 when lo = hi."""
    return f"least(greatest((cast({value} as double) - {lo}) / nullif({hi} - {lo}, 0D), 0D), 1D)"


def sort_key(value: str) -> str:
    """SQL for a BIGINT in the order of a DOUBLE that isn't NaN; equal only for equal values."""
    a = f"abs({value})"
    near = f"greatest(cast(floor(log2({a})) as int), -1022)"  # off by one at most
    power = f"(case when pow(2D, {near}) > {a} then greatest({near} - 1, -1022) when {a} >= pow(2D, {near} + 1) then {near} + 1 else {near} end)"
    size = f"({power} + 1023) * 4503599627370496L + cast(({a} / pow(2D, {power}) - 1D) * 4503599627370496D as bigint)"
    return f"(case when {a} = double('infinity') then 9218868437227405312L when {a} > 0D then {size} else 0L end * if({value} < 0D, -1L, 1L))"


def running_totals(df: DataFrame, order: str, measures: Sequence[str], *, by: Sequence[str] = (), descending: bool = False
                   ) -> DataFrame:
    """`df` (one row per (by, order), order without null and NaN) plus `<measure>_before`, the total over rows
    strictly earlier in order, and `<measure>_total`, that of the whole group."""
    direction = "desc" if descending else "asc"
    group, frame = _q(by), "rows between unbounded preceding and 1 preceding"
    places = [f"_k{i}" for i in range(len(SHIFTS))]

    def before(level: int) -> list[str]:
        partition = [*group, *places[level - 1:level]] if level else group
        over = f"{'partition by ' + ', '.join(partition) + ' ' if partition else ''}order by {places[level]} {direction} {frame}"
        return [f"coalesce(sum(`{m}`) over ({over}), 0) as `_b_{m}`" for m in measures]

    # never null: otherwise each use below would get its own null filter and its own read of `df`
    key = f"coalesce({sort_key(f'cast(`{order}` as double)')}, 0L)"
    rows = df.selectExpr("*", f"{key} as {places[-1]}").selectExpr("*", f"shiftright({places[-1]}, {SHIFTS[-2]}) as {places[-2]}")
    tables = [rows]
    for level in range(len(SHIFTS) - 2, -1, -1):
        sums = tables[0].groupBy(*group, places[level]).agg(*[F.expr(f"sum(`{m}`) as `{m}`") for m in measures])
        if level:
            sums = sums.selectExpr("*", f"shiftright({places[level]}, {SHIFTS[level - 1] - SHIFTS[level]}) as {places[level - 1]}")
        tables.insert(0, sums)
    whole = f"over ({'partition by ' + ', '.join(group) if group else ''})"
    found = tables[0].selectExpr(*group, places[0], *[f"sum(`{m}`) {whole} as `_n_{m}`" for m in measures], *before(0))
    for level in range(1, len(SHIFTS)):
        above = found.selectExpr(*group, places[level - 1], *[f"`_b_{m}` as `_a_{m}`" for m in measures], *[f"`_n_{m}`" for m in measures])
        last = level == len(SHIFTS) - 1
        kept = [f"`{c}`" for c in df.columns] if last else [*group, places[level]]
        inner = tables[level].selectExpr(*kept, places[level - 1], *before(level))
        found = inner.join(above, [*by, places[level - 1]]).selectExpr(
            *kept, *[f"`_a_{m}` + `_b_{m}` as `_b_{m}`" for m in measures], *[f"`_n_{m}`" for m in measures])
    return found.selectExpr(*_q(df.columns), *[f"`_b_{m}` as `{m}_before`" for m in measures], *[f"`_n_{m}` as `{m}_total`" for m in measures])


def _ranges(bounds: Sequence[tuple[float, float]], least: float, most: float, n: int, probs: Sequence[float]) -> list[tuple[float, float]]:
    """Disjoint ranges of values, in order, that hold the ranks wanted, from what a sketch tells three of its errors below and above each.

    With so few values that an error is less than one rank, all values are one range.
    """
    found: list[tuple[float, float]] = []
    for p, (lo, hi) in sorted(zip(probs, bounds)):
        lo, hi = (lo if n >= SKETCH and p > 3 / SKETCH else least), (hi if n >= SKETCH and p < 1 - 3 / SKETCH else most)
        if found and lo <= found[-1][1]:
            found[-1] = found[-1][0], max(hi, found[-1][1])
        else:
            found.append((lo, hi))
    return found


def _placed(values: DataFrame, ranges: Sequence[Sequence[tuple[float, float]]]) -> DataFrame:
    """(place, part, v, c) from one pass over a column per place: how often each value inside a range occurs, and, with v null, how many
    values lie outside: part says before which range."""
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        edges = [(np.array([lo for lo, _ in r], float), np.array([hi for _, hi in r], float)) for r in ranges]
        outside = [np.zeros(len(r) + 1, np.int64) for r in ranges]

        def told(i: int, parts, found, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), i), pa.int32()), pa.array(parts, pa.int32()), found, pa.array(counts, pa.int64())],
                                              ["place", "part", "v", "c"])

        for batch in batches:
            for i, (lo, hi) in enumerate(edges):
                given = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                part = np.searchsorted(lo, given, side="right") - 1
                inside = part >= 0
                inside[inside] = given[inside] <= hi[part[inside]]
                outside[i] += np.bincount(part[~inside] + 1, minlength=len(lo) + 1)
                found, first, counts = np.unique(given[inside], return_index=True, return_counts=True)
                if len(found):
                    yield told(i, part[inside][first], pa.array(found, pa.float64()), counts)
        for i, counts in enumerate(outside):
            some = np.flatnonzero(counts)
            yield told(i, some, pa.nulls(len(some), pa.float64()), counts[some])

    return values.mapInArrow(place, "place int, part int, v double, c bigint").groupBy("place", "part", "v").agg(F.sum("c").alias("c"))


def exact_quantiles(df: DataFrame, columns: Sequence[str] | Mapping[str, str], probs: Sequence[float]) -> DataFrame:
    """Quantiles with linear interpolation: rows (column, prob, value, n); missing values are left out.

    `columns` may map output names to SQL expressions. Two passes over the needed columns: one aggregate makes a mergeable sketch of each
    column, which tells a narrow range of values around each wanted rank; the other counts what lies between ranges and keeps the
    values inside. Should a rank lie outside its range, that column's range becomes all of its values, so results are exact in any case.
    """
    named = dict(columns) if isinstance(columns, Mapping) else {c: f"`{c}`" for c in columns}
    names, spark = list(named), df.sparkSession
    values = df.selectExpr(*[f"nanvl(cast({expr} as double), cast(null as double)) as c{i}" for i, expr in enumerate(named.values())])
    shares = F.lit([min(max(p + d / SKETCH, 0.0), 1.0) for p in probs for d in (-3, 3)])
    told = values.agg(*[e for i in range(len(names)) for e in (
        F.count(f"c{i}").alias(f"n{i}"), F.min(f"c{i}").alias(f"a{i}"), F.max(f"c{i}").alias(f"b{i}"),
        F.percentile_approx(f"c{i}", shares, SKETCH).alias(f"s{i}"))]).first()
    kept = [i for i in range(len(names)) if told[f"n{i}"]]
    size = {i: told[f"n{i}"] for i in kept}
    bounds = {i: list(zip(told[f"s{i}"][::2], told[f"s{i}"][1::2])) for i in kept}
    ranges = {i: _ranges(bounds[i], told[f"a{i}"], told[f"b{i}"], size[i], probs) for i in kept}
    ranks = {i: sorted({r for p in probs for r in (floor((size[i] - 1) * p), ceil((size[i] - 1) * p))}) for i in kept}
    missed = set(kept)
    while missed:
        found = staged(_placed(values.select(*[f"c{i}" for i in kept]), [ranges[i] for i in kept]), "quantile-ranges")
        sums = {(kept[r["place"]], r["part"], r["outside"]): (r["c"], r["d"]) for r in found.groupBy(
            "place", "part", F.expr("v is null as outside")).agg(F.sum("c").alias("c"), F.count("v").alias("d")).collect()}  # two rows for each range
        wanted, missed = [], set()
        for place, i in enumerate(kept):
            before = 0
            for part in range(len(ranges[i])):
                before += sums.get((i, part, True), (0, 0))[0]
                inside = sums.get((i, part, False), (0, 0))[0]
                wanted += [(place, part, r, r - before) for r in ranks[i] if before <= r < before + inside]
                before += inside
            if sum(w[0] == place for w in wanted) < len(ranks[i]):
                missed.add(i)
                ranges[i] = [(told[f"a{i}"], told[f"b{i}"])]
    at = _at_ranks(found.where("v is not null"), wanted, max((d for _, d in sums.values()), default=0)) if kept else {}
    rows = []
    for place, i in enumerate(kept):
        for p in probs:
            position = (size[i] - 1) * p
            a, b = at[place, floor(position)], at[place, ceil(position)]
            rows.append((names[i], float(p), a + (b - a) * (position - floor(position)), size[i]))
    return spark.createDataFrame(rows, "column string, prob double, value double, n bigint")


def _at_ranks(inside: DataFrame, wanted: list[tuple[int, int, int, int]], most: int) -> dict[tuple[int, int], float]:
    """(place, rank) to value for wanted (place, part, rank, rank within the part) over counted values (place, part, v, c).

    Parts with more than RANGE_VALUES values are cut at a sketch of theirs, and only the pieces that hold a wanted rank stay; so no
    window is over more values than that.
    """
    spark = inside.sparkSession
    while most > RANGE_VALUES:
        steps = F.lit([i / PIECES for i in range(1, PIECES)])
        cuts = inside.groupBy("place", "part").agg(F.percentile_approx("v", steps, PIECES * 4).alias("cuts"))
        # a row of PIECES numbers for each range
        cut = inside.join(F.broadcast(cuts), ["place", "part"]).selectExpr("place", "part", "size(filter(cuts, e -> e < v)) as piece", "v", "c")
        held: dict[tuple, list] = {}
        for r in cut.groupBy("place", "part", "piece").agg(F.sum("c").alias("c"), F.count("v").alias("d")).collect():
            held.setdefault((r["place"], r["part"]), []).append((r["piece"], r["c"], r["d"]))
        chosen, narrowed, most = {}, [], 0
        for place, part, rank, left in wanted:
            for piece, c, d in sorted(held[place, part]):
                if left < c:
                    narrowed.append((place, chosen.setdefault((place, part, piece), len(chosen)), rank, left))
                    most = max(most, d)
                    break
                left -= c
        wanted = narrowed
        pieces = spark.createDataFrame([(*k, v) for k, v in chosen.items()], "place int, part int, piece int, next int")
        inside = staged(cut.join(F.broadcast(pieces), ["place", "part", "piece"]).selectExpr("place", "next as part", "v", "c"), "quantile-pieces")
    # at most two ranks per column and probability
    targets = F.broadcast(spark.createDataFrame(wanted, "place int, part int, rank bigint, r bigint"))
    before = F.expr("coalesce(sum(c) over (partition by place, part order by v rows between unbounded preceding and 1 preceding), 0L) as c0")
    hits = inside.select("*", before).join(targets, ["place", "part"]).where("r >= c0 and r < c0 + c")
    return {(r["place"], r["rank"]): r["v"] for r in hits.select("place", "rank", "v").collect()}


def quantile(df: DataFrame, column: str, prob: float):
    """One exact quantile as a scalar subquery, usable inside any expression."""
    return exact_quantiles(df, [column], [prob]).select("value").scalar()
