"""Exact and approximate vector search against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import ann, topk

VECTORS = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], VECTORS)


def clean(rows, zero):
    return [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(np.float32(x) != 0 for x in v))]


def best_products(rows, every, k):
    rows = [(i, np.floor(256 * v)) for i, v in clean(rows, True)]
    out = []
    for i, q in rows:
        if i % every == 0:
            found = sorted((-int(q @ v), j) for j, v in rows if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


ODD = [(900, None), (950, []), (1000, [0.0, 0.0]), (1050, [1.0, None]), (1100, [float("nan"), 1.0]), (1150, [float("inf"), 1.0]),
       (None, [1.0, 2.0]), (1200, [1.0, 2.0, 3.0]), (1201, [1.0, -2.0, 3.5]), (1250, [-1.0] * 8), (1251, [0.0] * 8)]


def lengths(kind, random, n, dim):
    v = random.normal(size=(n, dim))
    if kind == "unit":
        v /= np.linalg.norm(v, axis=1)[:, None]
    if kind == "skewed":
        v *= np.exp(random.normal(size=(n, 1)) * 2)
    if kind == "close":
        v = v[:3][random.integers(0, 3, n)] + random.normal(size=(n, dim)) * 0.05
    return v


@pytest.mark.parametrize("kind", ["unit", "skewed", "close", "same"])
def test_top_k(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 64)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "SEED_ROWS", 50)
    monkeypatch.setattr(topk, "CELL", (2, 3))
    random = np.random.default_rng(2)
    v = np.tile(random.normal(size=8), (700, 1)) if kind == "same" else lengths(kind, random, 700, 8)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + ODD
    got = topk.top_k(frame(spark, rows).withColumn("row", F.lit("x")).withColumn("score", F.lit(1)), F.col("id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == best_products(rows, 50, 5)


def test_top_k_prunes():
    random = np.random.default_rng(3)
    v = np.floor(256 * lengths("close", random, 1000, 32))
    bucket = topk.Bucket(32, list(range(1000)), v.astype("<f8").tobytes())
    q = v[5]
    floor = float(np.sort(v @ q)[-5])
    at = bucket.candidates(q, float(np.sqrt(q @ q)), floor)
    reached = {int(bucket.ids[i]) for i in at}
    assert {int(i) for i in np.flatnonzero(v @ q >= floor)} <= reached and len(reached) < 600


def test_top_k_of_large_numbers(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 2.0]), (2, [-(2.0**20), 3.0])]
    assert sorted(map(tuple, topk.top_k(frame(spark, rows), F.col("id") == 0).collect())) == [(0, 1, 1, 2**56 + 2**17), (0, 2, 2, -(2**56) + 3 * 2**16)]
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(frame(spark, [(0, [1e30]), (1, [1e30])]), F.col("id") == 0).collect()


def test_no_vectors(spark):
    assert topk.top_k(frame(spark, []), F.col("id") % 50 == 0).count() == 0
    assert ann.nearest(frame(spark, []), F.col("id") % 100 == 0).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0])]), F.col("id") % 100 == 0).count() == 0


def near(rows, every, k):
    rows = clean(rows, False)
    out = {}
    for i, q in rows:
        if i % every == 0:
            out[i] = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in rows if j != i and len(v) == len(q))[:k]
    return out


@pytest.mark.parametrize("kind", ["unit", "close", "same"])
def test_nearest(spark, kind, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    monkeypatch.setattr(ann, "SEGMENT_ROWS", 64)
    random = np.random.default_rng(5)
    v = np.tile(random.normal(size=8), (2500, 1)) if kind == "same" else lengths(kind, random, 2500, 8)
    v[1200:2000] = v[7]  # a third of the rows are copies
    odd = [((i or 0) * 100, x) if i is not None else (None, x) for i, x in ODD]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(10**6 + (i or 0), x) if i is not None else (i, x) for i, x in odd]
    found = ann.nearest(frame(spark, rows).withColumn("row", F.lit("x")), F.col("id") % 100 == 0).collect()
    want, got, hits = near(rows, 100, 10), {}, 0
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(got) == {i for i, w in want.items() if w}
    vectors = dict(clean(rows, False))
    for i, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(want[i]) + 1))
        assert [(s, j) for _, s, j in own] == sorted((s, j) for _, s, j in own)
        assert all(s == pytest.approx(float(np.sqrt(((vectors[j] - vectors[i]) ** 2).sum())), abs=1e-12) for _, s, j in own)
        hits += len({j for _, _, j in own} & {j for _, j in want[i]})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_every_list_in_the_ratio_is_read():
    random = np.random.default_rng(8)
    v = lengths("unit", random, 5000, 64).astype(np.float32)
    graph = ann.Graph(ann.fit_centroids(v.astype(float), 200))
    far = np.sqrt(ann._squares(v[:20].astype(float), graph.centroids))
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(range(20)), pa.array([64] * 20, pa.int32()), pa.array([1.0] * 20),
                                        pa.array([x.tobytes() for x in v[:20]], pa.binary())], ["row", "id", "dim", "length", "vector"])
    read = [set() for _ in range(20)]
    for out in ann._assigned({64: graph}, ann.SEARCH_RATIO, least=ann.LEAST_LISTS)([batch]):
        for key, row in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            read[row].add(key)
    assert max(map(len, read)) > 96 and all(set(np.flatnonzero(f <= f.min() * ann.SEARCH_RATIO).tolist()) <= r for f, r in zip(far, read))


def test_graph_search_finds_the_nearest():
    random = np.random.default_rng(6)
    graph = ann.Graph(random.normal(size=(900, 16)))
    points = random.normal(size=(300, 16))
    far, found = graph.search(points, 32)
    want = ann._squares(points, graph.centroids).argmin(1)
    assert (found[:, 0] == want).mean() > 0.95 and (np.diff(far[np.isfinite(far).all(1)], axis=1) >= 0).all()
    assert all(len(set(f[np.isfinite(d)].tolist())) == np.isfinite(d).sum() for f, d in zip(found, far))


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_walk_finds_every_centroid_in_the_ratio(kind):
    random = np.random.default_rng(12)
    v = lengths("unit", random, 6000, 32)
    if kind == "clusters":
        v = v[random.integers(0, 150, 6000)] + random.normal(size=(6000, 32)) * 0.05
    graph = ann.Graph(ann.fit_centroids(v, 1200))
    far = np.sqrt(ann._squares(v[:200], graph.centroids))
    want, got = far <= far.min(1)[:, None] * ann.SEARCH_RATIO, np.zeros(far.shape, int)
    at, found = graph.within(v[:200], ann.SEARCH_RATIO, ann.SEARCH_BEAM, ann.LEAST_LISTS)
    np.add.at(got, (at, found), 1)
    assert got.max() == 1 and (got.sum(1) >= ann.LEAST_LISTS).all()
    assert (want & (got == 1)).sum() >= 0.97 * want.sum()
    at, found = graph.within(v[:3], 1e9, ann.SEARCH_BEAM)  # no bound on how many
    assert len(found) == 3 * len(graph.centroids)


def test_all_lists_come_from_the_graph(spark, monkeypatch):
    """With more centroids than a beam holds no vector is compared with all of them."""
    random = np.random.default_rng(13)
    monkeypatch.setattr(ann, "LIST_ROWS", 10)
    v = lengths("unit", random, 100, 16)[random.integers(0, 100, 3000)] + random.normal(size=(3000, 16)) * 0.05
    graph = ann.Graph(ann.fit_centroids(v, 300))
    monkeypatch.setattr(graph, "_all", None, raising=False)
    for options in ({"beam": ann.ASSIGN_BEAM, "most": ann.REPLICAS}, {"least": ann.LEAST_LISTS}):
        batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(range(50)), pa.array([16] * 50, pa.int32()), pa.array([1.0] * 50),
                                            pa.array([x.tobytes() for x in v[:50]], pa.binary())], ["row", "id", "dim", "length", "vector"])
        out = pa.Table.from_batches(ann._assigned({16: graph}, 1.05, **options)([batch])).to_pydict()
        assert set(out["row"]) == set(range(50)) and len(set(zip(out["row"], out["key"]))) == len(out["key"])
    found = ann.nearest(frame(spark, [(i, x.tolist()) for i, x in enumerate(v)]), F.col("id") % 100 == 0).collect()
    want = near(list(enumerate(v)), 100, 10)
    hits = sum((r.vec_id in {j for _, j in want[r.query_id]}) for r in found)
    assert len(found) == 300 and hits >= 270
