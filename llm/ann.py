"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample by splitting: a list that holds too large a share of the sample is cut again, so lists are
balanced. Every vector is indexed: it goes to the list of its nearest centroid, and a vector near a boundary also to others that are
nearly as near. Centroids are found in an in-memory graph: a best-first walk with a beam finds the nearest ones, and for a query the
walk then goes on through every centroid within a ratio of the nearest one's distance, so the ratio alone decides how many lists are
read. Posting lists are stored in segments of bounded size, so a list that holds a third of all vectors (copies can't be split) is
work for many tasks. Distances to all vectors of the read lists are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventwin.sources.sinks import staged
from llm.vectors import as_rows, matrix, pack

#: Vectors that the centroids are fitted on, drawn by a hash of row places, and more where lists would get fewer than so many each; all
#: vectors are indexed.
SAMPLE_ROWS, SAMPLE_EACH = 20_000, 4
#: Vectors that a list should hold, and the most centroids: their graph is sent to all tasks.
LIST_ROWS, MOST_LISTS = 250, 16_384
#: A vector is also put in up to three more lists whose centroids are at most this times as far as its nearest.
REPLICA_RATIO, REPLICAS = 1.05, 4
#: Centroids that the graph search keeps while it looks for those nearest to a vector and to a query.
ASSIGN_BEAM, SEARCH_BEAM = 48, 64
#: A query's walk passes through centroids at most this times as far as the ones whose lists it reads.
WALK_RATIO = 1.05
#: A query reads all lists whose centroids are at most this times as far as its nearest; so many at least. A query that finds too few
#: neighbours in them reads all lists.
SEARCH_RATIO, LEAST_LISTS = 1.2, 8
#: Neighbours of a centroid in the graph, chosen among so many nearest ones; some are drawn at random, which keeps it connected over clusters.
LINKS, LINKS_FROM, FAR_LINKS = 16, 48, 4
#: A walk starts from the nearest of this many times the square root of the number of centroids, drawn at random.
ENTRIES = 8
SEGMENT_ROWS = 1_024
BATCH = 256
#: Components of vectors that a task compares with centroids at once.
COMPARED = 1 << 22
#: Rows that a batch of assigned ones holds at most, and queries whose nearest a task holds at once.
BATCH_OUT, HELD_QUERIES = 4_096, 16_384


def _squares(a, b):
    """Squared distances of all rows of a to all rows of b."""
    import numpy as np

    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0)


def _two_means(points, random):
    """A split of points in two halves of equal size, by their projection on the line between two centroids."""
    import numpy as np

    a, b = points[random.integers(len(points))], points[random.integers(len(points))]
    for _ in range(6):
        side = ((points - (a + b) / 2) @ (b - a)) > 0
        if side.all() or not side.any():
            break
        a, b = points[~side].mean(0), points[side].mean(0)
    along = points @ (b - a)
    order = np.argsort(along, kind="stable")
    return order[:len(order) // 2], order[len(order) // 2:]


def fit_centroids(sample, lists: int, seed: int = 7):
    """At most `lists` centroids: the largest group of the sample is halved until there are enough, then moved by Lloyd steps."""
    import heapq

    import numpy as np

    random = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    lists = max(1, min(lists, len(distinct)))
    heap, tie = [(-len(distinct), 0, np.arange(len(distinct)))], 0
    while len(heap) < lists:
        _, _, group = heapq.heappop(heap)
        for half in _two_means(distinct[group], random):
            tie += 1
            heapq.heappush(heap, (-len(half), tie, group[half]))
    centroids = np.stack([distinct[g].mean(0) for _, _, g in heap])
    for _ in range(4):
        owner = np.concatenate([_squares(distinct[i:i + 512], centroids).argmin(1) for i in range(0, len(distinct), 512)])
        sums, counts = np.zeros_like(centroids), np.bincount(owner, minlength=lists)
        np.add.at(sums, owner, distinct)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


class Graph:
    """Centroids and links to near neighbours, searched best first for many points at once."""

    def __init__(self, centroids, seed: int = 7):
        import numpy as np

        n, random = len(centroids), np.random.default_rng(seed)
        self.centroids, self.norms = centroids, (centroids * centroids).sum(1)
        near = min(LINKS_FROM, n - 1)
        links = []
        for i in range(0, n, 256):
            far = _squares(centroids[i:i + 256], centroids)
            far[np.arange(len(far)), np.arange(i, i + len(far))] = np.inf
            nearest = np.argpartition(far, near - 1, axis=1)[:, :near] if near else np.empty((len(far), 0), int)
            order = np.argsort(np.take_along_axis(far, nearest, 1), axis=1, kind="stable")
            links.append(self._spread(np.take_along_axis(nearest, order, 1), np.take_along_axis(far, np.take_along_axis(nearest, order, 1), 1)))
        ring = (np.arange(n)[:, None] + 1) % n  # every centroid can be reached
        self.links = np.hstack([*[np.vstack(links)], ring, random.integers(0, n, (n, FAR_LINKS - 1))])
        self.entries = random.choice(n, min(n, math.ceil(ENTRIES * math.sqrt(n))), replace=False)

    def _spread(self, near, far):
        """LINKS of each row's near centroids, nearest first: first those nearer to the row than to any link before, then the nearest rest."""
        import numpy as np

        points = self.centroids[near]
        between = self.norms[near][:, :, None] + self.norms[near][:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        kept = np.zeros(near.shape, bool)
        for i in range(near.shape[1]):
            kept[:, i] = ~(kept[:, :i] & (between[:, i, :i] < far[:, i, None])).any(1)
        return np.take_along_axis(near, np.argsort(~kept, axis=1, kind="stable")[:, :LINKS], 1)

    def _all(self, points):
        """(distances, centroids), nearest first, of all centroids: for a beam that would hold them all."""
        import numpy as np

        squares = _squares(points, self.centroids)
        order = np.argsort(squares, axis=1, kind="stable")
        return np.sqrt(np.take_along_axis(squares, order, 1)), order

    def search(self, points, most: int):
        """(distances, centroids), nearest first, of up to `most` centroids found for each point."""
        import numpy as np

        n, count = len(self.centroids), len(points)
        if n <= most:
            return self._all(points)
        at = np.arange(count)[:, None]
        norms = (points * points).sum(1)[:, None]
        far = lambda c: np.maximum(norms + self.norms[c] - 2 * np.einsum("pd,pcd->pc", points, self.centroids[c]), 0)
        seen = np.zeros((count, n), bool)
        squares = _squares(points, self.centroids[self.entries])
        kept = np.argpartition(squares, min(most, len(self.entries)) - 1, axis=1)[:, :most]
        beam, squares, done = self.entries[kept], np.take_along_axis(squares, kept, 1), np.zeros(kept.shape, bool)
        seen[:, self.entries] = True
        while True:
            open_squares = np.where(done, np.inf, squares)
            step = np.argsort(open_squares, axis=1, kind="stable")[:, :4]  # four at a time
            ready = np.isfinite(np.take_along_axis(open_squares, step, 1))
            if not ready.any():
                break
            np.put_along_axis(done, step, True, 1)
            found = self.links[np.take_along_axis(beam, step, 1)].reshape(count, -1)
            fresh = ~seen[at, found] & np.repeat(ready, self.links.shape[1], axis=1)
            first = np.argsort(found, axis=1, kind="stable")  # of links met twice in a step, one counts
            ordered = np.take_along_axis(found, first, 1)
            repeated = np.hstack([np.zeros((count, 1), bool), ordered[:, 1:] == ordered[:, :-1]])
            twice = np.empty_like(repeated)
            np.put_along_axis(twice, first, repeated, 1)
            fresh &= ~twice
            met, column = np.nonzero(fresh)
            seen[met, found[met, column]] = True
            beam, squares = np.hstack([beam, found]), np.hstack([squares, np.where(fresh, far(found), np.inf)])
            done = np.hstack([done, ~fresh])
            if beam.shape[1] > most:
                kept = np.argpartition(squares, most - 1, axis=1)[:, :most]
                beam, squares, done = (np.take_along_axis(x, kept, 1) for x in (beam, squares, done))
        order = np.argsort(squares, axis=1, kind="stable")
        return np.sqrt(np.take_along_axis(squares, order, 1)), np.take_along_axis(beam, order, 1)

    def within(self, points, ratio: float, beam: int, least: int = 1):
        """(points, centroids): all met whose distance is at most `ratio` times the nearest one's, and each point's `least` nearest.

        The walk starts from the beam around a point and goes on, without a bound on their number, from every centroid near enough.
        """
        import numpy as np

        count, n = len(points), len(self.centroids)
        far, found = self.search(points, max(beam, least))
        limit = far[:, 0] * ratio + 1e-12
        met = np.isfinite(far)
        chosen = met & ((far <= limit[:, None]) | (np.arange(far.shape[1]) < least))
        at, first = np.nonzero(chosen)
        out = [(at, found[at, first])]
        if met.sum() < count * n:
            walk, norms = limit * WALK_RATIO, (points * points).sum(1)
            at, first = np.nonzero(met)
            seen = np.zeros(count * n, bool)
            seen[at * n + found[at, first]] = True
            at, first = np.nonzero(met & (far <= walk[:, None]))
            nodes = found[at, first]
            step = max(1, COMPARED // points.shape[1])
            while len(nodes):
                links = (at[:, None] * n + self.links[nodes]).ravel()
                links = np.unique(links[~seen[links]])
                seen[links] = True
                at, nodes = np.divmod(links, n)
                products = [np.einsum("pd,pd->p", points[at[i:i + step]], self.centroids[nodes[i:i + step]]) for i in range(0, len(at), step)]
                apart = np.sqrt(np.maximum(norms[at] + self.norms[nodes] - 2 * np.concatenate([np.empty(0), *products]), 0))
                inside = apart <= limit[at]
                out.append((at[inside], nodes[inside]))
                on = apart <= walk[at]
                at, nodes = at[on], nodes[on]
        return tuple(map(np.concatenate, zip(*out)))


def _assigned(graphs: dict, ratio: float, *, beam: int | None = None, least: int = 1, most: int | None = None):
    """Rows (row, id, dim, length, vector) to rows with `key`, one for each list within `ratio` of the nearest, `least` to `most`.

    Lists are found in the graph, all that the ratio allows unless `most` is given. A dimension that the sample lacks is one list of
    its own, -1: it's searched in full.
    """
    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                dims, vectors = np.asarray(batch.column(2).to_pylist()), batch.column(4).to_pylist()
                keys, places = [], []
                for dim in np.unique(dims):
                    own = np.flatnonzero(dims == dim)
                    if (graph := graphs.get(int(dim))) is None:
                        keys.append(np.full(len(own), -1))
                        places.append(own)
                        continue
                    points = matrix(b"".join(vectors[i] for i in own), len(own), int(dim))
                    if most is None:
                        at, lists = graph.within(points, ratio, beam or SEARCH_BEAM, least)
                    else:
                        far, found = (x[:, :most] for x in graph.search(points, beam or ASSIGN_BEAM))
                        near = np.isfinite(far) & ((far <= far[:, :1] * ratio + 1e-12) | (np.arange(far.shape[1]) < least))
                        at, first = np.nonzero(near)
                        lists = found[at, first]
                    keys.append(lists)
                    places.append(own[at])
                if keys:
                    key, place = np.concatenate(keys).astype(np.int32), np.concatenate(places)
                    for i in range(0, len(key), BATCH_OUT):
                        columns = batch.take(pa.array(place[i:i + BATCH_OUT])).columns
                        yield pa.RecordBatch.from_arrays([pa.array(key[i:i + BATCH_OUT]), *columns], ["key", *batch.schema.names])

    return assign


def _distances(k: int):
    """Rows (segment or query, segments first in their group) to the nearest of each query that a task finds in all its segments.

    A task keeps the k nearest of each query so far, and only looks at vectors that may be nearer.
    """
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        segment, best, names = None, {}, ["row", "query_id", "other", "vec_id", "score"]  # best: query to (id, other to (score, vec_id))

        def told() -> pa.RecordBatch:
            rows = [(row, owner, other, vec, score) for row, (owner, held) in best.items() for other, (score, vec) in held.items()]
            kinds = [pa.int64()] * 4 + [pa.float64()]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)

        def meet(asked: list[tuple]) -> None:
            own_rows, own_ids, vectors, norms = segment
            queries = matrix(b"".join(data for _, _, data in asked), len(asked), vectors.shape[1])
            sizes = (queries * queries).sum(1)
            rough = norms - 2 * (queries @ vectors.T) + sizes[:, None]
            rough[own_ids == np.array([owner for _, owner, _ in asked])[:, None]] = np.inf
            limit = np.full(len(asked), np.finfo(float).max)
            for i, (row, owner, _) in enumerate(asked):
                held = best.setdefault(row, (owner, {}))[1]
                if len(held) == k:
                    limit[i] = max(score for score, _ in held.values()) ** 2
            if len(own_ids) > k:
                limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1])
            near = (rough <= (limit + 1e-9 * (sizes + float(norms.max())))[:, None]) & np.isfinite(rough)
            for i in np.flatnonzero(near.any(1)):
                at = np.flatnonzero(near[i])
                exact = np.sqrt(((vectors[at] - queries[i]) ** 2).sum(1))
                first = at[order := np.lexsort((own_rows[at], own_ids[at], exact))[:k]]
                held = best[asked[i][0]][1]
                for score, vec, other in zip(exact[order].tolist(), own_ids[first].tolist(), own_rows[first].tolist()):
                    held[other] = score, vec  # a replica isn't another neighbour
                while len(held) > k:
                    del held[max(held, key=lambda o: (*held[o], o))]

        for batch in batches:
            asked: list[tuple] = []
            for is_query, dim, rows, ids, data in zip(*(c.to_pylist() for c in batch.columns)):
                if is_query:
                    asked.append((rows[0], ids[0], data))
                if asked and (not is_query or len(asked) == BATCH):
                    meet(asked)
                    asked = []
                if not is_query:
                    vectors = matrix(data, len(ids), dim)
                    segment = np.asarray(rows), np.asarray(ids), vectors, (vectors * vectors).sum(1)
            if asked:
                meet(asked)
            if len(best) > HELD_QUERIES:
                yield told()
        yield told()

    return search


def nearest(df: DataFrame, is_query: Column, *, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
            search_ratio: float = SEARCH_RATIO) -> DataFrame:
    """query_id, rank, vec_id, score: up to k nearest rows found for each query, nearest first, ties to smaller vec_id.

    `is_query` is over `id`; score is the Euclidean distance of the vectors given, in double precision. Null and zero vectors, those
    with null or non-finite components and rows without an id take no part; distances exist inside one dimension. Rows with the
    query's own id are never its candidates; other ids that repeat are candidates each. An empty table gives no rows. Where fewer
    than k are found in the lists read, a query reads all lists, so it gets k if there are k candidates.
    """
    rows = staged(as_rows(df, id_column, vector_column, zero=False), "vectors")
    n = rows.count()
    sample: dict = {}
    most = max(SAMPLE_ROWS, SAMPLE_EACH * min(MOST_LISTS, math.ceil(n / LIST_ROWS)))
    for r in rows.orderBy(F.xxhash64("row"), "row").limit(most).select("dim", "vector").collect():
        sample.setdefault(r.dim, []).append(bytes(r.vector))
    drawn = sum(map(len, sample.values()))
    graphs = {}
    for dim, own in sample.items():
        lists = min(MOST_LISTS, math.ceil(n / LIST_ROWS * len(own) / drawn))
        graphs[dim] = Graph(fit_centroids(matrix(b"".join(own), len(own), dim), lists))
    schema = "key int, " + "row bigint, id bigint, dim int, length double, vector binary"
    # stored, as drawing the range bounds would assign all vectors a second time
    postings = staged(rows.mapInArrow(_assigned(graphs, REPLICA_RATIO, beam=ASSIGN_BEAM, most=REPLICAS), schema), "postings")
    order = ["dim", "key", "id", "row"]
    segments = pack(postings.repartitionByRange(*order).sortWithinPartitions(*order), SEGMENT_ROWS)
    segments = staged(segments.withColumn("segment", F.monotonically_increasing_id()), "segments")
    queries = rows.where(is_query)
    near = queries.mapInArrow(_assigned(graphs, search_ratio, least=LEAST_LISTS), schema)
    names = ["row", "id", "dim", "vector"]

    def found(met: DataFrame) -> DataFrame:
        asked = met.select("segment", F.lit(True).alias("is_query"), "dim", F.array("row").alias("rows"), F.array("id").alias("ids"), F.col("vector").alias("vectors"))
        held = segments.select("segment", F.lit(False).alias("is_query"), "dim", "rows", "ids", "vectors")
        meetings = held.unionByName(asked).repartition("segment").sortWithinPartitions("segment", "is_query").drop("segment")
        results = meetings.mapInArrow(_distances(k), "row bigint, query_id bigint, other bigint, vec_id bigint, score double")
        once = results.groupBy("row", "query_id", "other", "vec_id").agg(F.min("score").alias("score"))  # a replica isn't another neighbour
        rank = F.row_number().over(Window.partitionBy("row").orderBy("score", "vec_id", "other"))
        return once.withColumn("rank", rank).where(F.col("rank") <= k)

    best = staged(found(near.select(*names, "key").join(segments.select("dim", "key", "segment"), ["dim", "key"])), "nearest")
    complete = best.where(F.col("rank") == k)
    lacking = staged(queries.join(complete, "row", "left_anti").select(*names), "lacking")
    if lacking.count():
        best = complete.select("row").join(best, "row").unionByName(found(lacking.join(segments.select("dim", "segment"), "dim")))
    return best.select("query_id", "rank", "vec_id", "score")
