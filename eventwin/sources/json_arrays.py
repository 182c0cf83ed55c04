"""A JSON array of objects read by many tasks, wherever its lines break.

Spark's text reader cuts files by byte ranges at closing braces. What a piece does to the nesting depends only on whether it starts inside
a string, so each range is summed up for both cases, a window over the few ranges of a file tells how each really starts, and tasks
then cut objects out on their own. Only objects that lie across ranges are put together by a shuffle.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventwin.session import staged

# executors get the functions below by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)
STEP = {"{": 1, "[": 1, "}": -1, "]": -1}


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (file, block, value) to a row per range: whether it has an odd number of quotes, and its steps in depth from both starts."""
    ranges: dict[tuple, list] = {}
    for batch in batches:
        for name, block, value in zip(*(c.to_pylist() for c in batch.columns)):
            at = ranges.setdefault((name, block), [False, True, 0, 0])  # inside a string now, depth gained: if started outside, inside
            for token in TOKEN.finditer(value + "}"):
                if (t := token[0]) == '"':
                    at[0], at[1] = not at[0], not at[1]
                elif t in STEP:
                    at[2] += 0 if at[0] else STEP[t]
                    at[3] += 0 if at[1] else STEP[t]
    columns = list(zip(*((*k, v[0], v[2], v[3]) for k, v in ranges.items()))) or [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "odd", "outside", "inside"])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (file, block, value, starts inside a string, depth) to objects and their fragments (file, block, place, opens, closes, value)."""
    names, kinds = ["file", "block", "place", "opens", "closes", "value"], [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    of, text, opens, place, quoted, depth = None, None, False, 0, False, 0  # text: pieces of the object that is being read

    def told(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names)

    for batch in batches:
        done: list[tuple] = []
        for name, block, value, starts_quoted, starts_at in zip(*(c.to_pylist() for c in batch.columns)):
            if (name, block) != of:
                if text:
                    done.append((*of, place, opens, False, "".join(text)))
                of, opens, place, quoted, depth = (name, block), False, 0, starts_quoted, starts_at
                text = [] if depth > 1 else None
            value, begin = value + "}", 0
            for token in TOKEN.finditer(value):
                if (t := token[0]) == '"':
                    quoted = not quoted
                elif not quoted and t in STEP:
                    if t == "{" and depth == 1:
                        text, opens, begin = [], True, token.start()
                    depth += STEP[t]
                    if t == "}" and depth == 1 and text is not None:
                        done.append((*of, place, opens, True, "".join([*text, value[begin:token.end()]])))
                        text, place = None, place + 1
            if text is not None:
                text.append(value[begin:])
        yield told(done)
    if text:
        yield told([(*of, place, opens, False, "".join(text))])


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the text of every object that is an element of a file's top-level array.

    Braces, brackets and quotes in strings and escapes are text. Elements that aren't objects are left out, as is what stands
    outside the array. An object that its file doesn't close comes as far as it goes. An empty array has no rows. The ranges are those
    of `spark.sql.files.maxPartitionBytes`; an object may lie across any number of them and is one row.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    sums = pieces.mapInArrow(_summed, "file string, block bigint, odd boolean, outside bigint, inside bigint")
    before = "over (partition by file order by block rows between unbounded preceding and 1 preceding)"
    starts = sums.selectExpr("*", f"coalesce(sum(cast(odd as int)) {before}, 0) % 2 = 1 as quoted").selectExpr(
        "file", "block", "quoted", f"coalesce(sum(if(quoted, inside, outside)) {before}, 0L) as depth")
    # one row per range of the input: a hundred-millionth of its bytes; a join by hash would lose the order of pieces
    met = pieces.join(F.broadcast(starts.withColumnsRenamed({"file": "f", "block": "b"})), F.expr("file = f and block = b"))
    found = met.select("file", "block", "value", "quoted", "depth").mapInArrow(
        _cut, "file string, block bigint, place bigint, opens boolean, closes boolean, value string")
    found = staged(found, "array-objects")
    whole = found.where("opens and closes").select("file", "value")
    order = "over (partition by file order by block, place)"
    parts = found.where("not (opens and closes)").selectExpr("*", f"sum(cast(opens as int)) {order} as object", f"lag(closes) {order} as ended")
    joined = parts.where("opens or (object > 0 and not ended)").groupBy("file", "object").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("parts"))
    return whole.unionByName(joined.selectExpr("file", "array_join(parts.value, '') as value"))


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The objects of JSON arrays as rows; fields that are absent or of another kind are null."""
    return array_objects(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
