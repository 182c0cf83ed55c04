"""SimHash near-dedup with a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, where neighbours differ in few bits, and cut into chunks. A node over consecutive
fingerprints keeps the bits that all of them share (a mask and a pattern); upper nodes do the same over nodes. Two nodes are compared
on the bits both share: more than `DISTANCE` differences rule out all pairs below them. The search goes down from the root against
itself: the upper levels are tables joined by parent, and a pair of chunks that survives is searched by one task through the levels
inside. A task returns a spanning forest of the links it finds, never all pairs of a group. Links are then joined to components by
alternating star contraction over stored tables.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from eventwin.sources.sinks import staged
from llm.exprs import added

DISTANCE = 2
SHINGLE = 3
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Fingerprints in a chunk, and children of a node.
CHUNK_ROWS = 8_192
FAN = 16
#: Pairs of lowest nodes that are checked at once.
STEP = 2_048
HASHES_AT_ONCE = 65_536


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of all word shingles, in order; a text of fewer words is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest

    # bytes.lower changes A-Z alone
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    if len(words) < shingle:
        return [xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])]


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint: a bit is 1 if set in over half the XXH64 (seed 42) of all word 3-shingles."""
    return majority(shingle_hashes(text))


def majority(hashes: list[int]) -> int:
    """The signed number whose bits are 1 if set in over half the hashes; zero for none."""
    import numpy as np

    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        some = np.array(hashes[i:i + HASHES_AT_ONCE], ">u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes)).view(">u8")[0]
    return int(bits.astype(np.uint64).astype(np.int64))


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` and fp (signed 64 bits; zero for null, empty and blank texts), from whole texts; a column fp is replaced."""
    kept = [c for c in docs.columns if c.lower() != "fp"]
    docs, at = docs.select(*kept), kept.index("text")

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*kept, "fp"])

    return docs.mapInArrow(add, added(docs.schema, fp=LongType()))


def gray_rank(fp: Column) -> Column:
    """The place of a fingerprint in the Gray sequence (as a signed number: the sequence is a ring, so any start will do)."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _pattern(values, masks=None):
    """(pattern, mask) of the bits that all values (in rows of a 2-d array) share."""
    import numpy as np

    first = values[:, :1]
    mask = ~np.bitwise_or.reduce(values ^ first, axis=1)
    if masks is not None:
        mask &= np.bitwise_and.reduce(masks, axis=1)
    return values[:, 0] & mask, mask


class Levels:
    """Nodes over a chunk's fingerprints in Gray order; level 0 is the fingerprints themselves."""

    def __init__(self, prints):
        import numpy as np

        self.values, self.masks = [prints], [np.full(len(prints), -1 & (1 << 64) - 1, np.uint64)]
        while len(self.values[-1]) > 1:
            size = -(-len(self.values[-1]) // FAN)
            spread = np.minimum(np.arange(size * FAN), len(self.values[-1]) - 1).reshape(size, FAN)  # the last one fills up
            value, mask = _pattern(self.values[-1][spread], self.masks[-1][spread])
            self.values.append(value)
            self.masks.append(mask)


def _near(a: Levels, i, b: Levels, j, level_a: int, level_b: int, most: int):
    import numpy as np

    x = (a.values[level_a][i] ^ b.values[level_b][j]) & a.masks[level_a][i] & b.masks[level_b][j]
    return np.bitwise_count(x) <= most


def _down(a: Levels, b: Levels, i, j, level_a: int, level_b: int, most: int, same: bool):
    """Yields (i, j): places of fingerprints at most `most` bits apart under the node pairs (i, j)."""
    import numpy as np

    for start in range(0, len(i), STEP):
        x, y = i[start:start + STEP], j[start:start + STEP]
        keep = _near(a, x, b, y, level_a, level_b, most)
        if same and level_a == level_b:
            keep &= x <= y
        x, y = x[keep], y[keep]
        if not len(x):
            continue
        if level_a == level_b == 0:
            yield (x[x < y], y[x < y]) if same else (x, y)
            continue
        below_a, below_b = max(level_a - 1, 0), max(level_b - 1, 0)
        fan_a, fan_b = FAN if level_a else 1, FAN if level_b else 1
        x = np.repeat((x[:, None] * fan_a + np.arange(fan_a)), fan_b, axis=1).ravel()
        y = np.tile(y[:, None] * fan_b + np.arange(fan_b), (1, fan_a)).ravel()
        real = (x < len(a.values[below_a])) & (y < len(b.values[below_b]))
        yield from _down(a, b, x[real], y[real], below_a, below_b, most, same)


def _joined(pairs, count: int):
    """For places 0 to count, joined by (i, j) as they come: (places, one place linked to each), a spanning forest."""
    import numpy as np

    root, linked = np.arange(count), np.zeros(count, bool)
    for i, j in pairs:
        linked[i] = linked[j] = True
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(jumped := root[root], root):
                root = jumped
    own = np.flatnonzero(linked & (root != np.arange(count)))
    return own, root[own]


def forest(prints_a, prints_b, most: int = DISTANCE):
    """A spanning forest (pairs of different fingerprints) of the links between two chunks, or inside one if both are the same."""
    import numpy as np

    same = prints_a is prints_b
    a, b = Levels(prints_a), None
    b = a if same else Levels(prints_b)
    shift = 0 if same else len(prints_a)
    every = prints_a if same else np.concatenate([prints_a, prints_b])
    top = np.zeros(1, np.int64)
    found = _down(a, b, top, top, len(a.values) - 1, len(b.values) - 1, most, same)
    u, v = _joined(((i, j + shift) for i, j in found), len(every))
    return every[u], every[v]


def links(prints: DataFrame, *, distance: int = DISTANCE) -> DataFrame:
    """(u, v): links between distinct fingerprints (`fp`) at most `distance` bits apart, enough of them to connect what is connected."""
    def search(a, b):
        import numpy as np

        a, b = (x[0].view(np.uint64) for x in (a, b)) if a is not b else [a[0].view(np.uint64)] * 2
        u, v = forest(a, b, distance)
        yield u.astype(np.int64), v.astype(np.int64)

    return _searched(prints.select("fp"), distance, search)


def _searched(nodes: DataFrame, distance: int, search: Callable) -> DataFrame:
    """(u, v) that `search` yields for pairs of chunks that may hold fingerprints at most `distance` bits apart.

    It takes two matrices (one twice for pairs in it), a row for each column (bigint, the first is fp) of `nodes`, in Gray order.
    """
    names = nodes.columns
    n = nodes.count()
    n_chunks = max(1, math.ceil(n / CHUNK_ROWS))
    ranked = nodes.select("*", gray_rank(F.col("fp")).alias("rank")).repartitionByRange(n_chunks, "rank", *names[1:])
    ordered = ranked.sortWithinPartitions("rank", *names[1:]).select(*names, F.spark_partition_id().alias("chunk"))

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held, number = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([np.asarray(batch.column(i)).astype("<i8") for i in range(len(names))]))
                number = batch.column(len(names))[0].as_py()
        if held:
            own = np.concatenate(held, axis=1)
            value, mask = _pattern(own[:1].view(np.uint64))
            columns = [pa.array([number], pa.int32()), pa.array(value.astype(np.int64)), pa.array(mask.astype(np.int64)), pa.array([own.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "value", "mask", "prints"])

    stored = staged(ordered.mapInArrow(chunks, "node int, value bigint, mask bigint, prints binary"), "gray-chunks")
    levels, size = [stored.select("node", "value", "mask")], int(stored.agg(F.coalesce(F.max("node"), F.lit(-1)).alias("n")).collect()[0].n) + 1
    while size > 1:  # upper nodes: what all children share
        size = -(-size // FAN)
        shared = levels[-1].groupBy(F.expr(f"node div {FAN}").cast("int").alias("node")).agg(
            F.bit_and("mask").alias("mask"), F.bit_and("value").alias("ones"), F.bit_or("value").alias("some"))
        mask = F.col("mask").bitwiseAND(F.bitwise_not(F.col("ones").bitwiseXOR(F.col("some"))))
        levels.append(staged(shared.select("node", F.col("ones").bitwiseAND(mask).alias("value"), mask.alias("mask")), "gray-nodes"))
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        child = lambda side: level.select(F.expr(f"node div {FAN}").cast("int").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in level.columns))
        met = pairs.join(child("a"), "a").join(child("b"), "b").where("node_a <= node_b")
        shared = F.expr("(value_a ^ value_b) & mask_a & mask_b")
        pairs = met.where(F.bit_count(shared) <= distance).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    side = lambda c: stored.select(F.col("node").alias(c), F.col("prints").alias(f"prints_{c}"))
    # chunks are alike in size, so pairs are alike in work: deal them out evenly
    work = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "prints_a", "prints_b").repartition("a", "b")

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(x, "<i8").reshape(len(names), -1)
                for u, v in search(own, own if a == b else np.frombuffer(y, "<i8").reshape(len(names), -1)):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return work.mapInArrow(found, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes in `edges` (u, v); all nodes of a component share its smallest node as root, itself among them.

    Alternating star contraction: each round hangs neighbours on smaller ones, first the larger and then the smaller, until nothing
    changes. Each half round is an aggregate with map-side combination and a join, and is stored, so lineage stays short.
    """
    def stored(e: DataFrame) -> DataFrame:
        return staged(e.where("u != v").distinct(), "star-edges")

    def told(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0])

    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    now = told(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u")
        edges = stored(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v"))))
        before, now = now, told(edges)
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(prints: DataFrame, *, distance: int = DISTANCE) -> DataFrame:
    """`prints` (distinct fp) and root: the smallest fingerprint of its component."""
    prints = staged(prints, "prints")
    found = components(links(prints, distance=distance))
    return prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) of all documents.

    Repeated rows give a row each. A null doc_id is linked like any other but never a component_id, unless nothing else is there
    (then it's null). Extra columns are ignored; an empty table gives no rows.
    """
    given = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    rows = staged(with_fingerprints(given).select("doc_id", "fp"), "fingerprints")
    found = classes(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), distance=distance)
    named = staged(found, "classes")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = staged(named.join(ids, "root").select("fp", "component_id"), "components")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(by_print, "fp").select("doc_id", digits, "component_id")


def keep_one(docs: DataFrame, *, distance: int = DISTANCE) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (nulls last; of repeated rows the first read).

    Null, empty and wordless texts share the fingerprint zero, so one of them stays. Whole texts count, however long. Extra columns
    are kept; an empty table stays empty.
    """
    kept = docs.columns
    rows = staged(with_fingerprints(docs.withColumn("row__", F.monotonically_increasing_id())), "fingerprinted")
    first = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id").alias("doc_id"), F.col("row__").alias("row"))
    found = classes(rows.groupBy("fp").agg(F.min(first).alias("first")), distance=distance)
    chosen = found.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row__"))
    return rows.join(chosen, "row__", "left_semi").select(*kept)
