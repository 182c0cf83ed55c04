"""Sharding by jump consistent hashing, in Spark expressions alone.

A key walks over shard numbers: from shard b it jumps to floor((b + 1) / u) with u drawn from the key and the step, and stays at the
last number below the shard count. No ring or table is kept; with one more shard only keys whose next jump is exactly the new number
move. The draws are XXH64 of key and step (the usual linear generator needs wrapping products, which SQL arithmetic refuses).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventwin.sources.sinks import staged
from llm.exprs import let
from llm.prefix import running_total

#: Steps tried first; a walk takes about log(shards) of them, and one that needs more goes on to the end.
SHORT_WALK = 24


def _walk(key: Column, state: Column, first: int, last: int, shards: int) -> Column:
    def step(at: Column, i: Column) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, i), 33) + 1  # 1 to 2^31
        jump = F.floor((at["next"] + 1) * F.lit(float(1 << 31)) / draw).cast("bigint")
        return F.when(at["next"] < shards, F.struct(at["next"].alias("shard"), jump.alias("next"))).otherwise(at)

    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), state, step)


def jump_hash(key: Column, shards: int) -> Column:
    """struct(shard, next): the shard of `key` among `shards`, and the number at which a growing count first moves it."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    start = F.struct(F.lit(0).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("next"))
    short = _walk(key, start, 1, min(shards, SHORT_WALK), shards)
    if shards <= SHORT_WALK:
        return short
    return let(short, lambda at: F.when(at["next"] >= shards, at).otherwise(_walk(key, at, SHORT_WALK + 1, shards, shards)))


def assign_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """`df` with shard and grown_shard (its shard among one more); columns of these names are replaced.

    A null key is a key like any other. Rows of one key share a shard, as the law says, however many they are.
    """
    kept = [F.col(c) for c in df.columns if c.lower() not in ("shard", "grown_shard", "jump__")]
    walked = df.select(*kept, jump_hash(F.col(key), shards).alias("jump__"))
    grown = F.when(F.col("jump__.next") == shards, shards).otherwise(F.col("jump__.shard"))
    return walked.withColumn("shard", F.col("jump__.shard").cast("int")).withColumn("grown_shard", grown.cast("int")).drop("jump__")


def number_slots(df: DataFrame, name: str = "sharded") -> DataFrame:
    """`df` (with `shard`) and slot: gapless from 0 in each shard.

    Rows are numbered in the order they were read, within shard and reading task, and each task's numbers start after those of the
    tasks before it: no window holds more than one task's share of a shard, however few shards or keys there are. The rows are
    written once, so a lost executor can't renumber them.
    """
    kept = [c for c in df.columns if c.lower() not in ("slot", "task__", "place__")]
    rows = staged(df.select(*kept, F.spark_partition_id().alias("task__"), F.monotonically_increasing_id().alias("place__")), name)
    return running_total(rows, "shard", "task__", ["place__"], F.lit(1).cast("bigint"), "slot").select(*kept, "slot")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents; the law is `key` on doc_id.

    Size is the text's UTF-8 bytes (null: none) plus 16; a null text has the crc32 of the empty one. Repeated rows have slots of
    their own. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return number_slots(assign_shards(rows, "doc_id", shards))


def write_shards(docs: DataFrame, path: str, shards: int, *, rows_per_file: int = 1_000_000) -> None:
    """Documents written to `path`/shard=k. A shard is written by as many tasks as read it, not by one."""
    placed = assign_shards(docs, "doc_id", shards).drop("grown_shard")
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
