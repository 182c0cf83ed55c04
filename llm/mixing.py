"""Mixing sources to target weights.

The words of each source's documents form one stream, cut into blocks of fixed length. A source's slots are its blocks in whole
passes, then as many as its target still needs, each pass in an order of its own: a pseudorandom permutation (a Feistel network over
block numbers, nothing is stored). Output shards draw how many slots each source gets: a multinomial draw conditioned on the totals,
made by halving the range of shards again and again, so any task computes the counts and first slots of its shards by itself. Blocks
are then joined to slots by (source, block number), which has no hot keys.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventwin.sources.sinks import staged
from llm.prefix import running_total

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Words taken as a share of all words, and the most times a source (and so a document) may be taken.
SHARE, MOST_TIMES = 1.5, 2.0
BLOCK_WORDS = 1_024
SHARD_SLOTS = 256
#: Parts that a source is cut into for numbering its words; the same for every input, so reruns agree.
PARTS = 1_024
#: Sources are listed on the driver; more than this is an error.
MOST_SOURCES = 100_000


class Source(NamedTuple):
    name: str | None
    words: int
    target: float
    block_words: int = BLOCK_WORDS

    @property
    def take(self) -> int:
        return round(self.target)

    @property
    def blocks(self) -> int:
        return -(-self.words // self.block_words)

    @property
    def slots(self) -> int:
        passes, rest = divmod(self.take, self.words) if self.words else (0, 0)
        return passes * self.blocks + -(-rest // self.block_words)


def share_out(words: Sequence[int], weights: Sequence[float], total: float, most_times: float) -> list[float]:
    """Targets by weight that stop at `most_times` a source's words; the excess is shared again by weight until none is above."""
    targets, caps = [0.0] * len(words), [most_times * w for w in words]
    open_, left = list(range(len(words))), float(total)
    while open_:
        weight = math.fsum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > caps[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = caps[i]
        left -= math.fsum(caps[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def permute(index, size: int, key: str):
    """A pseudorandom permutation of range(size), applied to an array of numbers below it."""
    import numpy as np

    if size <= 1:
        return index.copy()
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.blake2b(key.encode(), digest_size=32).digest(), "<u8") | np.uint64(1)

    def rounds(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * k
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):  # values beyond the size walk on to one below it
        out[todo] = rounds(out[todo])
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _draw(random, counts, drawn: int):
    """Of `counts` of each kind, how many are among `drawn` drawn without putting back."""
    import numpy as np

    out, left, total = np.zeros(len(counts), np.int64), int(drawn), int(counts.sum())
    for i, n in enumerate(counts):
        n, rest = int(n), total - int(n)
        low, high = max(0, left - rest), min(n, left)
        if low == high:
            got = low
        elif total < 10**9:
            got = int(random.hypergeometric(n, rest, left))
        else:  # beyond the generator's range the law is normal to many digits
            mean = left * n / total
            spread = math.sqrt(max(0.0, mean * (rest / total) * (total - left) / (total - 1)))
            got = min(high, max(low, round(random.normal(mean, spread))))
        out[i], left, total = got, left - got, rest
    return out


class Draws:
    """Slots of each source in each output shard."""

    def __init__(self, slots: Sequence[int], seed: int, shard_slots: int = SHARD_SLOTS):
        import numpy as np

        self.slots, self.seed, self.total, self.size = np.asarray(slots, np.int64), seed, int(sum(slots)), shard_slots
        self.shards, self.known = -(-self.total // shard_slots), {}

    def _left(self, low: int, high: int, counts):
        import numpy as np

        if (low, high) not in self.known:
            if len(self.known) > 5_000:
                self.known.clear()
            middle = (low + high) // 2
            self.known[low, high] = _draw(np.random.default_rng([self.seed, low, high]), counts, (middle - low) * self.size)
        return self.known[low, high]

    def of(self, shard: int):
        """(first slots, counts) of each source in a shard."""
        import numpy as np

        low, high, counts, first = 0, self.shards, self.slots, np.zeros(len(self.slots), np.int64)
        while high - low > 1:
            middle, left = (low + high) // 2, self._left(low, high, counts)
            if shard < middle:
                high, counts = middle, left
            else:
                low, first, counts = middle, first + left, counts - left
        return first, counts


def list_sources(sized: DataFrame, weights: Sequence[float], share: float, most_times: float, block_words: int) -> list[Source]:
    """Every source's words and target; sources by code point, null last, weigh `weights` in turn."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("words")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    words = [r.words for r in rows]
    targets = share_out(words, [weights[i % len(weights)] for i in range(len(rows))], share * sum(words), most_times)
    return [Source(r.source, r.words, t, block_words) for r, t in zip(rows, targets)]


def draw_slots(spark: SparkSession, sources: Sequence[Source], seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, place, source_no, epoch, block, take: the block that fills each place of each output shard and the words taken of it."""
    sources = list(sources)
    n_shards = Draws([s.slots for s in sources], seed, shard_slots).shards

    def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        draws = Draws([s.slots for s in sources], seed, shard_slots)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                columns: list[list] = [[], [], [], []]
                for number, first, count in zip(range(len(sources)), *draws.of(shard)):
                    if not count:
                        continue
                    s, slot = sources[number], np.arange(first, first + count)
                    epoch, index = slot // s.blocks, slot % s.blocks
                    block, whole = index.copy(), s.blocks - 1  # the last block may be short: it stays last
                    for e in np.unique(epoch):
                        own = np.flatnonzero((epoch == e) & (index < whole))
                        block[own] = permute(index[own], whole, f"{seed}|{s.name}|{e}")
                    # the last slot takes what the target lacks
                    take = np.where(slot == s.slots - 1, s.take - epoch * s.words - index * s.block_words, s.block_words)
                    for column, values in zip(columns, (np.full(count, number), epoch, block, np.minimum(take, s.block_words))):
                        column.append(values)
                merged = [np.concatenate(c) for c in columns]
                places = np.random.default_rng([seed, shard, -1 & 0xFFFF]).permutation(len(merged[0]))
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
                values = [np.full(len(places), shard), places, *merged]
                yield pa.RecordBatch.from_arrays([pa.array(v).cast(k) for v, k in zip(values, kinds)], ["shard", "place", "source_no", "epoch", "block", "take"])

    schema = "shard bigint, place int, source_no int, epoch int, block bigint, take int"
    return spark.range(n_shards).mapInArrow(slots, schema) if n_shards else spark.createDataFrame([], schema)


class Mix(NamedTuple):
    """`rows`: row, doc_id, source, size, source_no, first_word. `sources`: a row each. `taken`: row, shard, place, epoch, from_word, n_words."""

    rows: DataFrame
    sources: DataFrame
    taken: DataFrame


def mix(docs: DataFrame, *, row: Column | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_times: float = MOST_TIMES,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 11) -> Mix:
    """Which words of which documents the mix takes, and where they go. Rerunning gives the same mix.

    `share` of all words is taken, shared by weight; a source (null is one) gives at most `most_times` its words, and no document more
    than that of its own. A null or empty text has no words. Repeated rows are rows of their own; extra columns are ignored; an empty
    table gives empty ones. Each source's taken words are its target, rounded.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.monotonically_increasing_id() if row is None else row
    sized = staged(docs.select(row.alias("row"), F.col("doc_id").cast("bigint"), F.col("source").cast("string"),
                               F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64("doc_id", text).alias("mark")), "sized")
    sources = list_sources(sized, weights, share, most_times, block_words)
    listed = spark.createDataFrame([(i, s.name, s.words, s.target) for i, s in enumerate(sources)],
                                   "source_no int, name string, source_size bigint, target double")
    part = F.pmod("mark", F.lit(PARTS)).alias("part")
    placed = running_total(sized.select("*", part), "source", "part", ["doc_id", "mark", "row"], F.col("size"), "first_word")
    # one row for each source, MOST_SOURCES at most
    numbered = staged(placed.join(F.broadcast(listed), F.col("source").eqNullSafe(F.col("name")))
                      .select("row", "doc_id", "source", "size", "source_no", "first_word"), "streams")
    length = F.lit(block_words)
    cut = numbered.where("size > 0").select("row", "source_no", "first_word", "size", F.explode(F.sequence(
        F.expr(f"first_word div {block_words}"), F.expr(f"(first_word + size - 1) div {block_words}"))).alias("block"))
    low = F.greatest(F.col("first_word"), F.col("block") * length)
    high = F.least(F.col("first_word") + F.col("size"), (F.col("block") + 1) * length)
    pieces = cut.select("row", "source_no", "block", (low - F.col("first_word")).alias("from_word"), (low - F.col("block") * length).alias("at"),
                        (high - low).alias("held"))
    # a task makes many slots of one shard number, which Spark's size estimate misses: never broadcast them
    joined = pieces.join(draw_slots(spark, sources, seed, shard_slots).hint("merge"), ["source_no", "block"])
    words = F.least(F.col("held"), F.col("take") - F.col("at")).cast("bigint")
    taken = joined.select("row", "shard", "place", "epoch", "from_word", words.alias("n_words")).where("n_words > 0")
    return Mix(numbered, listed, taken)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of all documents."""
    m = mix(docs, **options)
    sums = m.taken.groupBy("row").agg(F.sum("n_words").alias("taken"))
    rows = m.rows.join(sums, "row", "left").join(F.broadcast(m.sources), "source_no")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed words with the columns of `docs`: a row for each run of words that one pass takes of a document without a gap.

    A document taken whole is its text as it was; a run's text goes from its first word to where the next would begin. n_chars, if
    there, is the new text's length. Documents without words aren't taken.
    """
    import re

    kept = docs.columns
    stored = staged(docs.withColumn("row__", F.monotonically_increasing_id()), "mixed-from")
    m = mix(stored, row=F.col("row__"), **options)
    runs = m.taken.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("epoch", "from_word", "n_words"))).alias("runs__"))
    joined = stored.join(runs.withColumnRenamed("row", "row__"), "row__").drop("row__")
    at, has_size = kept.index("text"), kept.index("n_chars") if "n_chars" in kept else None
    word = re.compile(WORD)

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, out = [], []
            for i, (text, taken) in enumerate(zip(batch.column(at).to_pylist(), batch.column(len(kept)).to_pylist())):
                merged: list[list[int]] = []
                for run in taken:
                    if merged and merged[-1][0] == run["epoch"] and merged[-1][2] == run["from_word"]:
                        merged[-1][2] += run["n_words"]
                    else:
                        merged.append([run["epoch"], run["from_word"], run["from_word"] + run["n_words"]])
                starts = [x.start() for x in word.finditer(text)]
                for _, low, high in merged:
                    places.append(i)
                    out.append(text[starts[low] if low else 0:starts[high] if high < len(starts) else len(text)])
            columns = list(batch.select(range(len(kept))).take(pa.array(places, pa.int64())).columns)
            columns[at] = pa.array(out, columns[at].type)
            if has_size is not None:
                columns[has_size] = pa.array(list(map(len, out))).cast(columns[has_size].type)
            yield pa.RecordBatch.from_arrays(columns, kept)

    return joined.select(*kept, "runs__").mapInArrow(texts, docs.select(*kept).schema)
