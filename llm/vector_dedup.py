"""Embedding near-dedup by an inverted multi-index.

Unit vectors are cut in halves, each half has a codebook of its own, and pairs of codes are the cells of a product grid. A vector's
list is the cell of its nearest codes. From each vector the grid is walked by multi-sequence traversal, cells in order of distance,
until the margin is reached within which the target share of partners at the least cosine has its cell; the margin is measured on
sampled vectors turned by just that angle. What is found is verified by cosine. Neighbouring cells share a bin, which is how
vectors travel: packs of bounded size per bin meet all vectors that visit it.

Equal vectors are one node with a number of copies. A task returns link counts and a spanning forest, never the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventwin.sources.sinks import staged
from llm.ann import fit_centroids
from llm.lookup import looked_up
from llm.simhash import components
from llm.vectors import as_rows, matrix

#: Vectors on which codebooks and margins are fitted, drawn by a hash of row places; all vectors are indexed.
SAMPLE_ROWS, TURNED_ROWS = 20_000, 2_000
#: Share of the partners at the least cosine whose cell is visited.
TARGET_RECALL = 0.98
#: Vectors that a cell should hold, and the most codes of a half: with more vectors cells grow.
CELL_ROWS, MOST_CODES = 16, 1_024
#: Codes of the second half in a bin, most vectors of a pack, and visits that one task has of a pack.
BIN_CODES, PACK_ROWS, VISITS = 32, 2_048, 32_768
BATCH = 512
#: Cosines this close to the least are computed again with exact sums.
DOUBT = 1e-9


def units(vectors):
    """Rows of length one; the greatest component comes first to 1, so that squares of any finite vector are in range."""
    import numpy as np

    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _squares(points, codes):
    import numpy as np

    return np.maximum((points * points).sum(1)[:, None] - 2 * (points @ codes.T) + (codes * codes).sum(1)[None, :], 0)


class Grid:
    """Two codebooks over the halves of unit vectors, and how far a traversal goes."""

    def __init__(self, sample, count: float, cosine: float, target: float, seed: int = 5):
        import numpy as np

        random, self.half = np.random.default_rng(seed), sample.shape[1] // 2
        codes = max(1, min(MOST_CODES, round(math.sqrt(count / CELL_ROWS))))
        fitted = lambda part: fit_centroids(part, codes) if part.shape[1] else np.zeros((1, 0))
        self.first, second = fitted(sample[:, :self.half]), fitted(sample[:, self.half:])
        # codes of the second half lie in the order of their widest direction, so that a bin's cells are near each other
        centred = second - second.mean(0)
        self.second = second[np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")]
        self.across = -(-len(self.second) // BIN_CODES)
        x, margins = sample[:TURNED_ROWS], []
        for changed in (slice(None), slice(0, self.half), slice(self.half, None)):  # all over, or in one half above all
            z = np.zeros_like(x)
            z[:, changed] = random.standard_normal(x[:, changed].shape)
            z -= (z * x).sum(1, keepdims=True) * x
            length = np.sqrt((z * z).sum(1, keepdims=True))
            y = cosine * x + math.sqrt(1 - cosine * cosine) * np.divide(z, length, out=np.zeros_like(z), where=length > 1e-12)
            margins.append(np.quantile(np.minimum(self._excess(x, y), self._excess(y, x)), target))
        self.margin = float(max(margins)) + 1e-9

    def distances(self, points):
        return _squares(points[:, :self.half], self.first), _squares(points[:, self.half:], self.second)

    def _excess(self, x, y):
        """How much farther than its nearest cell each x finds the cell of its y."""
        import numpy as np

        own, other, rows = self.distances(x), self.distances(y), np.arange(len(x))
        return sum(o[rows, p.argmin(1)] - o.min(1) for o, p in zip(own, other))

    def traverse(self, points):
        """(own cells, rows, cells): the cell of each point, and all cells it visits, in order of distance for each point.

        Both halves' distances are walked in ascending order: for each code of the first, codes of the second follow until the sum
        passes the limit, and a longer first distance leaves a shorter walk. Points are handled side by side.
        """
        import numpy as np

        left, right = self.distances(points)
        limit = left.min(1) + right.min(1) + self.margin
        own = left.argmin(1) * len(self.second) + right.argmin(1)
        row, i = np.nonzero(left <= (limit - right.min(1))[:, None])
        order = np.argsort(right, axis=1, kind="stable")
        walk = np.take_along_axis(right, order, 1)
        steps = (walk[row] <= (limit[row] - left[row, i])[:, None]).sum(1)
        at = np.repeat(np.arange(len(row)), steps)
        step = np.arange(len(at)) - np.repeat(np.cumsum(steps) - steps, steps)
        j = order[row[at], step]
        row, i = row[at], i[at]
        near = np.lexsort((left[row, i] + right[row, j], row))
        return own, row[near], (i * len(self.second) + j)[near]

    def bins(self, cells):
        return cells // len(self.second) * self.across + cells % len(self.second) // BIN_CODES


def _postings(grids: dict):
    """(node, copies, dim, vector) with bin and visited: the bin of a vector's cell, and those of all cells that it visits.

    Vectors of a dimension that the sample lacks are all in one bin.
    """
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                dims, vectors = np.asarray(batch.column(2)), batch.column(3).to_pylist()
                own, visited = np.zeros(len(dims), np.int32), [[0]] * len(dims)
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    if (grid := grids.get(int(dim))) is None:
                        continue
                    cells, rows, met = grid.traverse(units(matrix(b"".join(vectors[i] for i in at), len(at), int(dim))))
                    own[at] = grid.bins(cells)
                    for i, bins in zip(at, np.split(grid.bins(met), np.searchsorted(rows, np.arange(1, len(at))))):
                        visited[i] = np.unique(bins).tolist()
                columns = [*batch.columns, pa.array(own, pa.int32()), pa.array(visited, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "bin", "visited"])

    return place


def _packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, bin, node, copies, visited, vector) in order to packs of at most PACK_ROWS of one bin."""
    names = ["dim", "bin", "nodes", "copies", "visited", "visits", "vectors"]
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    of, held = None, []

    def closed() -> pa.RecordBatch:
        nodes, copies, visited, vectors = zip(*held)
        values = [*of, list(nodes), list(copies), [b for v in visited for b in v], [len(v) for v in visited], b"".join(vectors)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, [pa.int32(), pa.int32(), longs, longs, ints, ints, pa.binary()])], names)

    for batch in batches:
        for dim, place, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and ((dim, place) != of or len(held) >= PACK_ROWS):
                yield closed()
                held = []
            of = dim, place
            held.append(row)
    if held:
        yield closed()


def _merge(root, i, j) -> None:
    """Joins places i and j; `root` then holds the smallest place of each group."""
    import numpy as np

    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jumped := root[root], root):
            root[:] = jumped


def _linked(cosine: float, queries, vectors):
    """(i, j) of the pairs with at least this cosine."""
    import numpy as np

    products = queries @ vectors.T
    near = products >= cosine
    for i, j in zip(*np.nonzero(np.abs(products - cosine) < DOUBT)):
        x, y = queries[i], vectors[j]
        near[i, j] = math.fsum(x * y) >= cosine * math.sqrt(math.fsum(x * x) * math.fsum(y * y))
    return np.nonzero(near)


def _verified(cosine: float):
    """Rows (pack, or vector that visits it; packs first) to (node, other, amount): links counted for a node, and links of a forest."""
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names, pack = ["node", "other", "amount"], None

        def told(nodes, others, amounts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(others, pa.int64(), from_pandas=True) if others is not None
                                               else pa.nulls(len(nodes), pa.int64()), pa.array(amounts, pa.int64())], names)

        def meet(asked: list[tuple]) -> Iterator[pa.RecordBatch]:
            nodes, copies, vectors, place, visits, root, gained = pack
            own, own_copies, own_bins = (np.array([a[i] for a in asked], np.int64) for i in range(3))
            i, j = _linked(cosine, units(matrix(b"".join(a[3] for a in asked), len(asked), vectors.shape[1])), vectors)
            other = own[i] != nodes[j]
            i, j = i[other], j[other]
            counted = np.bincount(i, copies[j], len(asked)).astype(np.int64)
            some = np.flatnonzero(counted)
            if not len(some):
                return
            yield told(own[some], None, counted[some])
            # a member that doesn't visit the other's bin won't count this link there
            foreign = np.flatnonzero(own_bins[i] != place)
            key = j[foreign] * (1 << 32) + own_bins[i[foreign]]
            at = np.minimum(np.searchsorted(visits, key), len(visits) - 1)
            alone = foreign[visits[at] != key]
            np.add.at(gained, j[alone], own_copies[i[alone]])
            size = len(nodes)
            root[size:] = np.arange(size, len(root))
            _merge(root, i + size, j)
            yield told(own[some], nodes[root[some + size]], np.zeros(len(some)))

        def closed() -> Iterator[pa.RecordBatch]:
            nodes, _, _, _, _, root, gained = pack
            some, moved = np.flatnonzero(gained), np.flatnonzero(root[:len(nodes)] != np.arange(len(nodes)))
            yield told(nodes[some], None, gained[some])
            yield told(nodes[moved], nodes[root[moved]], np.zeros(len(moved)))

        for batch in batches:
            asked: list[tuple] = []
            for is_visit, dim, place, nodes, copies, visited, visits, data in zip(*batch.columns):
                if is_visit.as_py():
                    asked.append((nodes.as_py()[0], copies.as_py()[0], place.as_py(), data.as_py()))
                    if len(asked) == BATCH:
                        yield from meet(asked)
                        asked = []
                    continue
                if asked:
                    yield from meet(asked)
                    asked = []
                if pack:
                    yield from closed()
                own, sizes = np.array(nodes.as_py(), np.int64), np.asarray(visits.values)
                keys = np.repeat(np.arange(len(own)), sizes) * (1 << 32) + np.asarray(visited.values)
                pack = (own, np.array(copies.as_py(), np.int64), units(matrix(data.as_py(), len(own), dim.as_py())), place.as_py(), keys,
                        np.arange(len(own) + BATCH), np.zeros(len(own), np.int64))
            if asked:
                yield from meet(asked)
        if pack:
            yield from closed()

    return verify


def linked_nodes(nodes: DataFrame, *, cosine: float, target: float = TARGET_RECALL) -> DataFrame:
    """(node, other, amount) over distinct vectors (node, copies, dim, vector): counts of links, where other is null, and a forest of links."""
    n, sample = nodes.count(), {}
    for r in nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS).select("dim", "vector").collect():
        sample.setdefault(r.dim, []).append(bytes(r.vector))
    drawn = sum(map(len, sample.values()))
    grids = {dim: Grid(units(matrix(b"".join(own), len(own), dim)), n * len(own) / drawn, cosine, target) for dim, own in sample.items()}
    postings = staged(nodes.mapInArrow(_postings(grids), "node bigint, copies bigint, dim int, vector binary, bin int, visited array<int>"), "postings")
    order = ["dim", "bin", "node"]
    ranged = postings.repartitionByRange(*order).sortWithinPartitions(*order).select("dim", "bin", "node", "copies", "visited", "vector")
    packs = ranged.mapInArrow(_packs, "dim int, bin int, nodes array<bigint>, copies array<bigint>, visited array<int>, visits array<int>, vectors binary")
    packs = staged(packs.withColumn("pack", F.monotonically_increasing_id()), "packs")
    visits = postings.select("dim", F.explode("visited").alias("to")).groupBy("dim", "to").agg(F.count(F.lit(1)).alias("visits"))
    parts = F.ceil(F.col("visits") / VISITS).cast("int").alias("parts")
    aims = staged(packs.select("dim", F.col("bin").alias("to"), "pack").join(visits, ["dim", "to"]).select("dim", "to", "pack", parts), "aims")
    one = lambda c: F.array(c).alias({"node": "nodes"}.get(c, c))
    none = F.array().cast("array<int>")
    visitors = postings.select("node", "copies", "dim", "vector", "bin", F.explode("visited").alias("to")).join(aims, ["dim", "to"])
    visitors = visitors.select("pack", F.expr("cast(pmod(xxhash64(node), parts) as int)").alias("part"), F.lit(True).alias("is_visit"), "dim", "bin",
                               one("node"), one("copies"), none.alias("visited"), none.alias("visits"), F.col("vector").alias("vectors"))
    held = packs.join(aims.select("pack", "parts"), "pack").select("pack", F.expr("explode(sequence(0, parts - 1))").alias("part"), F.lit(False).alias("is_visit"),
                                                                   "dim", "bin", "nodes", "copies", "visited", "visits", "vectors")
    meetings = held.unionByName(visitors).repartition("pack", "part").sortWithinPartitions("pack", "part", "is_visit").drop("pack", "part")
    return staged(meetings.select("is_visit", "dim", "bin", "nodes", "copies", "visited", "visits", "vectors").mapInArrow(
        _verified(cosine), "node bigint, other bigint, amount bigint"), "verified")


def near_duplicates(df: DataFrame, *, cosine: float = 0.9, target: float = TARGET_RECALL, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per vector: the id, n_links (other vectors found with at least this cosine), component_id (smallest id reachable), kept.

    Vectors that are null, zero or hold null or non-finite components link with nothing; only vectors of one dimension link. Equal
    vectors link with each other. Repeated ids and rows give a row each. A row without an id links like any other, but its
    id is a component_id only where a component has no other. kept is whether a row's id is its component's. Extra columns are
    ignored; an empty table gives no rows.
    """
    given = staged(df.select(F.monotonically_increasing_id().alias("own"), F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("v")), "given")
    rows = as_rows(given, "own", "v", zero=False).select(F.col("id").alias("own"), "dim", "vector")
    rows = staged(rows.join(given.select("own", "vec_id"), "own"), "vectors")
    nodes = staged(rows.groupBy("dim", "vector").agg(F.min("own").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")), "nodes")
    verified = linked_nodes(nodes.select("node", "copies", "dim", "vector"), cosine=cosine, target=target)
    counts = verified.where("other is null").groupBy("node").agg(F.sum("amount").alias("links"))
    roots = components(verified.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    named = nodes.join(counts, "node", "left").join(roots, "node", "left")
    named = staged(named.select("node", "dim", "vector", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "rooted")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    told = looked_up(named, ["root"], ids, "node").select("dim", "vector", "n_links", "component_id")
    found = looked_up(rows.select("own", "dim", "vector"), ["dim", "vector"], told, "own").select("own", "n_links", "component_id", F.lit(True).alias("usable"))
    every = given.select("own", "vec_id").join(found, "own", "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return every.select(F.col("vec_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                        F.col("vec_id").eqNullSafe(component).alias("kept"))
