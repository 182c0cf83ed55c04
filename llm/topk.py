"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and packed into buckets. A query's threshold is its k-th best product with the longest vectors. A bucket
is skipped where its greatest length can't reach the threshold; inside a bucket the threshold becomes a local cosine threshold, and
for each query either length pruning (a prefix of the bucket) or coordinate pruning (ranges in sorted lists of the query's largest
coordinates) leaves candidates, whose products are computed exactly. Queries come in blocks; a bucket meets the blocks one by one,
so a task holds one bucket and one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwin.sources.sinks import staged
from llm.vectors import PACK_SCHEMA, as_rows, matrix, pack

BUCKET_ROWS = 1_024
BLOCK_ROWS = 256
#: Longest vectors whose products give the first thresholds; they are sent to all tasks.
SEED_ROWS = 4_096
#: Cosine threshold from which sorted coordinates prune better than lengths.
COORDINATE_COSINE = 0.5
COORDINATES = 4
#: Blocks and buckets that one cell of the pairing looks at.
CELL = 256, 1_024


def _products(queries, candidates):
    """Exact inner products of integer-valued doubles: in doubles where no partial sum passes 2^53, else in 64-bit integers."""
    import numpy as np

    bound = lambda m: math.sqrt(float((m * m).sum(1).max(initial=0)))
    most = bound(queries) * bound(candidates) * 1.001
    if most < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    if most >= 2**63 or max(np.abs(queries).max(), np.abs(candidates).max()) >= 2**53:
        raise OverflowError("scores don't fit in 64 bits")
    return queries.astype(np.int64) @ candidates.astype(np.int64).T


def _best(scores, ids, k: int):
    """Places of the k highest scores, ties to smaller ids."""
    import numpy as np

    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _thresholds(seeds: dict, k: int):
    """Adds to packs of queries the k-th best product with the seeds (-inf if there are fewer) and what a bucket's length must reach."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            floors, needs = [], []
            for dim, ids, data in zip(batch.column(1).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                queries, floor = matrix(data, len(ids), dim), np.full(len(ids), -np.inf)
                if dim in seeds and len(seeds[dim][0]) > k:
                    seed_ids, vectors = seeds[dim]
                    scores = _products(queries, vectors).astype(np.float64)
                    scores[np.asarray(ids)[:, None] == seed_ids[None, :]] = -np.inf
                    floor = np.partition(scores, -k, axis=1)[:, -k]
                lengths = np.sqrt((queries * queries).sum(1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where((floor > 0) & (lengths > 0), floor / lengths, 0.0)
                floors.append(floor.tolist())
                needs.append(float(need.min(initial=np.inf)) * (1 - 1e-9))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.list_(pa.float64())), pa.array(needs, pa.float64())],
                                             [*batch.schema.names, "floors", "need"])

    return add


class Bucket:
    """A bucket's vectors, longest first, with coordinate lists sorted when first asked for."""

    def __init__(self, dim: int, ids: list[int], data: bytes):
        import numpy as np

        self.vectors, self.ids = matrix(data, len(ids), dim), np.asarray(ids, np.int64)
        self.lengths = np.sqrt((self.vectors * self.vectors).sum(1))
        order = np.argsort(-self.lengths, kind="stable")
        self.vectors, self.ids, self.lengths = self.vectors[order], self.ids[order], self.lengths[order]
        self.lists: dict = {}

    def coordinate(self, f: int):
        import numpy as np

        if f not in self.lists:
            with np.errstate(divide="ignore", invalid="ignore"):
                unit = np.where(self.lengths > 0, self.vectors[:, f] / self.lengths, 0.0)
            order = np.argsort(unit, kind="stable")
            self.lists[f] = unit[order], order
        return self.lists[f]

    def candidates(self, query, length: float, floor: float):
        """Places of the vectors that may reach `floor` with `query`."""
        import numpy as np

        if floor <= 0 or length <= 0 or self.lengths[0] <= 0:
            return np.arange(len(self.ids)) if floor <= 0 else np.arange(0)
        if (cosine := floor / (length * self.lengths[0]) - 1e-9) > 1:
            return np.arange(0)
        prefix = np.searchsorted(-self.lengths, -(floor / length) * (1 - 1e-9), side="right")
        if cosine < COORDINATE_COSINE:
            return np.arange(prefix)  # a low local threshold: lengths decide
        unit, met = query / length, np.zeros(len(self.ids), np.int8)
        focus, spread = np.argsort(-np.abs(unit))[:COORDINATES], math.acos(min(1.0, cosine))
        for f in focus:
            angle = math.acos(max(-1.0, min(1.0, unit[f])))
            low, high = math.cos(min(math.pi, angle + spread)) - 1e-9, math.cos(max(0.0, angle - spread)) + 1e-9
            values, order = self.coordinate(int(f))
            met[order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]] += 1
        met[prefix:] = 0
        return np.flatnonzero(met == len(focus))


def _search(k: int):
    """Rows (bucket or block, buckets first in their group) to the best of each query in each bucket."""
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        bucket = None
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for is_block, dim, rows, ids, data, floors in zip(*(c.to_pylist() for c in batch.columns)):
                if not is_block:
                    bucket = Bucket(dim, ids, data)
                    continue
                queries = matrix(data, len(ids), dim)
                lengths = np.sqrt((queries * queries).sum(1))
                for query, row, owner, length, floor in zip(queries, rows, ids, lengths, floors):
                    at = bucket.candidates(query, float(length), floor)
                    at = at[bucket.ids[at] != owner]
                    if not len(at):
                        continue
                    scores = _products(query[None, :], bucket.vectors[at])[0]
                    best = _best(scores, bucket.ids[at], k)
                    best = best[scores[best] >= floor]
                    for column, values in zip(found, ([row] * len(best), [owner] * len(best), bucket.ids[at][best].tolist(), scores[best].tolist())):
                        column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["row", "query_id", "vec_id", "score"])

    return search


def top_k(df: DataFrame, is_query: Column, *, k: int = 5, scale_floor: int | None = 256, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products with all other rows, ties to smaller vec_id.

    `is_query` is over `id`. Components x count as floor(scale_floor * x), or as they are, if whole numbers, with None. Vectors that
    are null or hold null or non-finite components, and rows without an id, take no part; only vectors of one dimension have a
    product. Rows with the query's own id are never its candidates; other ids that repeat are candidates each. An empty table gives
    no rows. Scores that don't fit in 64 bits raise an error.
    """
    spark = df.sparkSession
    rows = staged(as_rows(df, id_column, vector_column, zero=True, scale_floor=scale_floor), "vectors").withColumn("key", F.lit(0))
    n, n_queries = rows.count(), rows.where(is_query).count()
    ranged = rows.repartitionByRange(max(1, math.ceil(n / BUCKET_ROWS)), "dim", F.desc("length"), "id", "row")
    packed = pack(ranged.sortWithinPartitions("dim", F.desc("length"), "id", "row"), BUCKET_ROWS)
    buckets = staged(packed.withColumn("bucket", F.monotonically_increasing_id()), "buckets")
    longest: dict = {}
    for r in rows.orderBy(F.desc("length"), "row").limit(SEED_ROWS).collect():
        longest.setdefault(r.dim, []).append(r)
    import numpy as np

    seeds = {dim: (np.array([r.id for r in own], np.int64), matrix(b"".join(bytes(r.vector) for r in own), len(own), dim)) for dim, own in longest.items()}
    dealt = rows.where(is_query).repartitionByRange(max(1, math.ceil(n_queries / BLOCK_ROWS)), "dim", "id", "row")
    blocks = pack(dealt.sortWithinPartitions("dim", "id", "row"), BLOCK_ROWS).mapInArrow(_thresholds(seeds, k), PACK_SCHEMA + ", floors array<double>, need double")
    blocks = staged(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    # pairs of blocks and buckets that may hold a result, looked for in a grid of cells of bounded size
    down, across = (max(1, math.ceil(t.count() / size)) for t, size in zip((blocks, buckets), CELL))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    cells = lambda c, count: F.pmod(F.xxhash64(c), F.lit(count)).cast("int")
    left = blocks.select("block", "dim", "need", "rows", "ids", "vectors", "floors", cells("block", down).alias("down"), spread(across).alias("across"))
    right = buckets.select("bucket", "dim", "most", cells("bucket", across).alias("across"), spread(down).alias("down"))
    pairs = left.join(right, ["dim", "down", "across"]).where("most >= need").select("bucket", F.lit(True).alias("is_block"), "dim", "rows", "ids", "vectors", "floors")
    held = buckets.select("bucket", F.lit(False).alias("is_block"), "dim", "rows", "ids", "vectors", F.lit(None).cast("array<double>").alias("floors"))
    meetings = held.unionByName(pairs).repartition("bucket").sortWithinPartitions("bucket", "is_block").drop("bucket")
    found = meetings.mapInArrow(_search(k), "row bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
