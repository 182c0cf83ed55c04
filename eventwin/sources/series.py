"""Time series from CSV, fixed-width and whitespace-separated text."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from eventwin.functions.parse import EVERY, FILL_VALUES, apart, fills_to_null, number, to_numbers, utc_time
from eventwin.functions.times import from_date_and_hours, from_year_day
from eventwin.operators.clean import keep_between, keep_first, rename_aliases, require
from eventwin.sources.schemas import EXPORTED_COLUMNS, KP_ALIASES, SOLAR_WIND_COLUMNS, TIME_ALIASES
from eventwin.sources.versions import record, recorded

Paths = str | Sequence[str]


def parse_kp(raw: DataFrame) -> DataFrame:
    """(time, kp) from a text table with any known header; rows outside 0..9 or unreadable are dropped."""
    named = rename_aliases(raw, KP_ALIASES)
    require(named, ["time", "kp"], "Kp table")
    return named.select(utc_time("time").alias("time"), F.expr(f"{number('cast(kp as string)')} as kp")).where(
        "time is not null and kp between 0 and 9")


def read_kp_csv(spark: SparkSession, path: Paths) -> DataFrame:
    return parse_kp(spark.read.csv(path, header=True))


def parse_wide_series(raw: DataFrame) -> DataFrame:
    """Time column by any known name; every other column as a number; rows without time are dropped."""
    named = rename_aliases(raw, {"time": TIME_ALIASES})
    require(named, ["time"], "series table")
    timed = named.withColumn("time", utc_time("time")).where("time is not null")
    return to_numbers(timed, exclude=["time"])


def read_wide_csv(spark: SparkSession, path: Paths) -> DataFrame:
    return parse_wide_series(spark.read.csv(path, header=True))


def _kp_cells(lines: DataFrame) -> DataFrame:
    """`value`, `kp` and `time` of fixed-width lines."""
    # 1-based position and length of each field.
    fields = {"y": (1, 4), "m": (6, 2), "d": (9, 2), "h": (12, 4), "kp": (47, 6)}
    cells = ", ".join(f"{number(f'substring(value, {at}, {size})')} as {n}" for n, (at, size) in fields.items())
    # the generator keeps the filters below from cutting each line again per condition
    cut = lines.selectExpr("value", f"inline(array(struct({cells})))")
    return cut.withColumn("time", from_date_and_hours(F.col("y"), F.col("m"), F.col("d"), F.col("h")))


def _kp_period(start: str, end: str) -> str:
    return f"time >= timestamp'{start} 00:00:00' and time < timestamp'{end} 00:00:00' + interval 1 day"


def parse_kp_lines(lines: DataFrame, start: str, end: str) -> DataFrame:
    """(time, kp) from fixed-width lines (`value`) for start ≤ time < end + 1 day; one row per time."""
    timed = _kp_cells(lines.where("value <> '' and not startswith(value, '#')")).where(f"{_kp_period(start, end)} and kp is not null")
    return keep_first(timed.select("time", "kp", "value"), ["time"], ["value"]).select("time", "kp")


def judge_kp_lines(lines: DataFrame, start: str, end: str) -> DataFrame:
    """Every fixed-width line (value, time, kp) with `reason`: why `parse_kp_lines` leaves it out, null for those that it takes."""
    return _kp_cells(lines).selectExpr("value", "time", "kp", f"""case when coalesce(value, '') = '' then 'blank' when startswith(value, '#') then 'comment'
when time is null then 'no time' when not ({_kp_period(start, end)}) then 'outside the period' when kp is null then 'no value' end as reason""")


def read_kp_text(spark: SparkSession, path: Paths, start: str, end: str) -> DataFrame:
    return parse_kp_lines(spark.read.text(path), start, end)


#: Closed ranges of the fields that make up a line's time; the years are arguments.
_FIELDS = {"day": (1, 366), "hour": (0, 23), "minute": (0, 59)}


def _plain_numbers():
    """Function of lines: the numbers of those that hold nothing but spaces and short decimals, null for all others."""
    number = r"-?[0-9]{1,15}(\.[0-9]{1,15})?([eE][-+]?[0-9]{1,2})?"

    @F.arrow_udf("array<double>")
    def numbers(lines: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(lines, rf"^ *{number}( +{number})* *$")
        words = pc.ascii_split_whitespace(pc.ascii_trim(pc.if_else(plain, lines, None), " "))
        return pa.ListArray.from_arrays(words.offsets, pc.cast(words.values, pa.float64()), mask=words.is_null())

    return numbers


def _solar_wind_cells(lines: DataFrame, kept: Sequence[str]) -> DataFrame:
    words = r"split(trim(value), '\\s+')"
    # numbers spelled `1d` or `1f` are rare: look for them once per line
    checked = (rf"if(value rlike '(?i)[0-9.][df](\\s|$)', transform({words}, x -> if(x rlike '(?i)^[^i]*[df]$', null, x)), "
               f"{words})")
    # nearly all lines are plain; the generator keeps filters from splitting each other line once per condition
    parts = lines.withColumn("_n", _plain_numbers()("value")).selectExpr(*kept, "_n", f"explode(array(if(_n is null, {checked}, null))) as _p")
    word = lambda i: apart(f"get(_p, {i})") if i % EVERY == EVERY - 1 else f"get(_p, {i})"
    return parts.selectExpr(*kept, *[f"coalesce(get(_n, {i}), nanvl(try_cast({word(i)} as double), null)) as `{c}`" for i, c in enumerate(SOLAR_WIND_COLUMNS)])


def _solar_wind_values(cells: DataFrame, fills) -> DataFrame:
    timed = cells.withColumn("time", from_year_day(*[F.col(c) for c in ("year", "day", "hour", "minute")]))
    return fills_to_null(timed, SOLAR_WIND_COLUMNS[4:], fills)


def parse_solar_wind_lines(lines: DataFrame, *, year_min: int = 1995, year_max: int = 2030,
                           fills=FILL_VALUES) -> DataFrame:
    """All solar-wind columns plus `time` from lines (`value`); other columns of `lines` are kept.

    Short lines leave their last columns missing, over-long lines lose their surplus; lines without
    a valid year, day, hour and minute (headers among them) are dropped.
    """
    cells = _solar_wind_cells(lines, [c for c in lines.columns if c != "value"])
    return _solar_wind_values(keep_between(cells, {"year": (year_min, year_max), **_FIELDS}), fills)


def judge_solar_wind_lines(lines: DataFrame, *, year_min: int = 1995, year_max: int = 2030, fills=FILL_VALUES) -> DataFrame:
    """Every line with its text, columns and time as `parse_solar_wind_lines` makes them, and `reason`: why that leaves it out, else null.

    The first reason counts: blank, a field of the time that isn't a number, one that is out of its range.
    """
    fields = {"year": (year_min, year_max), **_FIELDS}
    cells = _solar_wind_cells(lines, lines.columns)
    reasons = [f"when {c} is null then 'no {c}'" for c in fields] + [f"when {c} not between {lo} and {hi} then '{c} out of range'" for c, (lo, hi) in fields.items()]
    judged = cells.withColumn("reason", F.expr(f"case when trim(coalesce(value, '')) = '' then 'blank' {' '.join(reasons)} end"))
    return _solar_wind_values(judged, fills)


def write_judged(judged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) lines, written side by side in one pass over the text."""
    judged.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(path)
    back = judged.sparkSession.read.schema(T.StructType([*judged.schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(path)
    return back.where("not rejected").drop("rejected", "reason"), back.where("rejected").drop("rejected")


def line_report(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, reason, n): how many lines were accepted or left out for each reason."""
    return judged.groupBy(*by, F.expr("coalesce(reason, 'accepted') as reason")).agg(F.count(F.lit(1)).alias("n"))


def read_solar_wind_text(spark: SparkSession, path: Paths, **options) -> DataFrame:
    """Solar-wind files; all yearly files are read in one pass. One row per time: the first by file, then by text."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"),
                                         F.col("value").alias("_line"))
    parsed = parse_solar_wind_lines(lines, **options)
    return keep_first(parsed, ["time"], ["_file", "_line"]).drop("_file", "_line")


def combine_series(*parts: DataFrame) -> DataFrame:
    """Series stacked, one row per time; for equal times the earlier part wins, then the smaller row."""
    if not parts:
        raise ValueError("no series to combine")
    stacked = None
    for i, part in enumerate(parts):
        tagged = part.withColumn("_part", F.lit(i))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    rest = [c for c in stacked.columns if c not in ("time", "_part")]
    return keep_first(stacked, ["time"], ["_part", *rest]).drop("_part")


def trim_series(df: DataFrame, columns: Sequence[str] = EXPORTED_COLUMNS) -> DataFrame:
    """The wanted columns that exist, as numbers next to `time`."""
    if absent := [c for c in columns if c not in df.columns]:
        warnings.warn(f"series lacks {absent}: they are left out", stacklevel=2)
    return df.selectExpr(*[f"`{c}`" if c == "time" else f"cast(`{c}` as double) as `{c}`"
                           for c in columns if c in df.columns])


def export_series(df: DataFrame, path: str, columns: Sequence[str] = EXPORTED_COLUMNS, *, mode: str = "overwrite",
                  format: str = "parquet") -> None:
    """Write the trimmed series: Parquet partitioned by year, or CSV with a header."""
    out = trim_series(df, columns)
    if format == "csv":
        out.write.mode(mode).option("header", True).csv(path)
        return
    dated = out.withColumn("year", F.year("time"))
    # cut by time, a task writes to one or two years, and files cover narrow spans that filters can skip
    dated.repartitionByRange("year", "time").sortWithinPartitions("time").write.mode(mode).partitionBy("year").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def build_series_once(spark: SparkSession, folder: str, out: str, start_year: int, end_year: int, *,
                      resolution: str = "5min", overwrite: bool = False) -> DataFrame:
    """Parse the yearly files of `folder` into `out` unless it is there in full, and return it. A missing year is an error."""
    if overwrite or not _exists(spark, f"{out}/_SUCCESS"):  # a folder that a lost job left half-written is built again
        files = [f"{folder}/omni_{resolution}{y}.asc" for y in range(start_year, end_year + 1)]
        missing = [f for f in files if not _exists(spark, f)]
        if missing:
            raise FileNotFoundError(f"missing yearly files: {missing}")
        export_series(read_solar_wind_text(spark, files), out)
    return spark.read.parquet(out).drop("year")


_BUILT = "version bigint, year int, mark string, files bigint, bytes bigint, build string, strays bigint"


def yearly_files(spark: SparkSession, folder: str, resolution: str = "5min") -> DataFrame:
    """(year, files, bytes, mark) of the yearly files, or folders of parts, from their listing alone.

    `mark` changes with the path, the size or the time of change of any file.
    """
    name = f"omni_{resolution}"
    try:
        listed = spark.read.format("binaryFile").load(f"{folder}/{name}*.asc").select("path", "length", "modificationTime")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    year = F.regexp_extract("path", rf"{name}(\d{{1,9}})\.asc", 1)
    one = F.concat_ws(" ", "path", "length", F.unix_micros("modificationTime"))
    return listed.where(year != "").groupBy(year.cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(one))), 256).alias("mark"))


def built_years(spark: SparkSession, out: str) -> list[Row]:
    """What `update_series` has committed to `out`: the last row of each year, by year."""
    rows = recorded(spark, f"{out}/ledger", _BUILT)
    last = rows.groupBy("year").agg(F.max_by(F.struct(*rows.columns), F.struct("version", "build")).alias("r"))
    return last.select("r.*").orderBy("year").collect()


def update_series(spark: SparkSession, folder: str, out: str, start_year: int, end_year: int, *, resolution: str = "5min",
                  **options) -> list[int]:
    """Parse the yearly files of `folder` that are new or changed since they were last built into `out`; the years built.

    Each year is committed on its own by a row of the ledger, so a run that is lost goes on where it stopped, and
    readers see a year as it was until its new files are complete. A missing year is an error before anything is built.
    """
    found = {r["year"]: r for r in yearly_files(spark, folder, resolution).where(F.col("year").between(start_year, end_year)).collect()}
    if missing := [y for y in range(start_year, end_year + 1) if y not in found]:
        raise FileNotFoundError(f"{folder} lacks the yearly files of {missing}")
    known = {r["year"]: r for r in built_years(spark, out)}
    changed = [y for y in sorted(found) if y not in known or known[y]["mark"] != found[y]["mark"]]
    for year in changed:
        build = uuid.uuid4().hex
        path = f"{out}/data/file_year={year}/build={build}"
        rows = trim_series(read_solar_wind_text(spark, f"{folder}/omni_{resolution}{year}.asc", **options))
        rows.repartitionByRange("time").sortWithinPartitions("time").write.parquet(path)
        strays = spark.read.parquet(path).where(F.year("time") != year).count()
        version = known[year]["version"] + 1 if year in known else 1
        record(spark, f"{out}/ledger", (version, year, found[year]["mark"], found[year]["files"], found[year]["bytes"], build, strays), _BUILT)
    return changed


def updated_series(spark: SparkSession, out: str, start_year: int, end_year: int) -> DataFrame:
    """The series of the committed years, one row per time as a single reading of all their files gives it.

    Times are compared across files only if a file holds times of another year.
    """
    built = [r for r in built_years(spark, out) if start_year <= r["year"] <= end_year]
    if missing := sorted(set(range(start_year, end_year + 1)) - {r["year"] for r in built}):
        raise FileNotFoundError(f"{out} lacks the years {missing}")
    paths = [f"{out}/data/file_year={r['year']}/build={r['build']}" for r in built]
    rows = spark.read.option("basePath", f"{out}/data").parquet(*paths).drop("build")
    return (keep_first(rows, ["time"], ["file_year"]) if any(r["strays"] for r in built) else rows).drop("file_year")
