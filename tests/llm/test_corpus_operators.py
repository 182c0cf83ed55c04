"""Mixing, near-duplicates, quality and the pipeline against plain Python."""

import re
import zlib
from collections import Counter
from random import Random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from helpers import AWKWARD, documents, with_clashes
from llm import mixing, quality, simhash

SF = "/root/testdata/sf0.001"


# --- mixing

def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=12))
def test_shares(words):
    weights = [(3, 1, 2)[i % 3] for i in range(len(words))]
    got = mixing.share_out(words, weights, 1.5 * sum(words), 2.0)
    assert sum(got) == pytest.approx(1.5 * sum(words))
    assert all(t <= 2 * w + 1e-6 for t, w in zip(got, words))
    free = [t / w for t, w, n in zip(got, weights, words) if t < 2 * n - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))
    assert all(t / w <= min(free) + 1e-6 for t, w in zip(got, weights)) if free else True


@pytest.mark.parametrize("size", [1, 2, 3, 10, 257, 5000])
def test_permutations(size):
    own = mixing.permute(np.arange(size), size, "a")
    assert sorted(own.tolist()) == list(range(size))
    assert size < 10 or own.tolist() != mixing.permute(np.arange(size), size, "b").tolist()


def test_draws_add_up():
    draws = mixing.Draws([1000, 3, 0, 20000], 5)
    at = np.zeros(4, int)
    for shard in range(draws.shards):
        first, counts = draws.of(shard)
        assert first.tolist() == at.tolist() and counts.sum() == min(mixing.SHARD_SLOTS, draws.total - shard * mixing.SHARD_SLOTS)
        at += counts
    assert at.tolist() == [1000, 3, 0, 20000]


def test_large_draws_are_near_their_mean():
    got = mixing._draw(np.random.default_rng(1), np.array([3 * 10**10, 10**10]), 10**9)
    assert got.sum() == 10**9 and abs(got[0] - 7.5e8) < 1e6


SMALL = {"block_words": 16, "shard_slots": 8}


def mixed_rows(seed=1):
    random = Random(seed)
    rows = [(i, " ".join(f"w{random.randrange(50)}" for _ in range(random.randrange(90))), random.choice(["a", "b", "b", "b", "ü", None, "B"])) for i in range(400)]
    return rows + [(i, t, "awkward") for i, t, *_ in AWKWARD]


def test_mix(spark):
    rows = mixed_rows()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words_in(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.share_out([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2.0)))
    df = with_clashes(documents(spark, rows))
    got = mixing.mixed_sizes(df, **SMALL).collect()
    assert len(got) == len(rows) and sorted(mixing.mixed_sizes(df, **SMALL).collect(), key=str) == sorted(got, key=str)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.size in {words_in(t) for i, t, *_ in rows if i == r.doc_id}
        taken[r.target, r.source_size] += r.taken
    for s in order:
        assert abs(taken[targets[s], sizes[s]] - targets[s]) <= 1
    # the same whatever the input's partitions are
    again = mixing.mixed_sizes(df.repartition(7), **SMALL).collect()
    plain = lambda found: sorted((str(r.doc_id), r.size, r.taken) for r in found if r.doc_id not in (None, 7))
    assert plain(again) == plain(got)


def test_mixed_texts(spark):
    rows = mixed_rows(2)
    df = documents(spark, rows)
    got, sums = mixing.mixed_documents(df, **SMALL), mixing.mixed_sizes(df, **SMALL).collect()
    assert got.columns == df.columns
    found, texts = Counter(), {}
    for i, t, *_ in rows:
        texts.setdefault(i, set()).add(t)
    for r in got.collect():
        found[r.doc_id] += words_in(r.text)
        assert r.n_chars == len(r.text) and any(r.text in t for t in texts[r.doc_id] if t)
    want = Counter()
    for r in sums:
        want[r.doc_id] += r.taken
    # blocks are the same; only the numbers of repeated rows may differ
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in want.items() if v}


def test_mix_of_nothing(spark):
    assert mixing.mixed_sizes(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    got = mixing.mixed_sizes(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


# --- SimHash

def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance=2):
    """Places to the smallest place of their component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def near_prints(random, n, centres):
    out = []
    for _ in range(n):
        x = random.choice(centres)
        for _ in range(random.randrange(5)):
            x ^= 1 << random.randrange(64)
        out.append(x)
    return sorted(set(out), key=lambda x: random.random())


def ranked(prints):
    def rank(f):
        for s in (1, 2, 4, 8, 16, 32):
            f ^= f >> s
        return f

    return np.array(sorted(prints, key=rank), np.uint64)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 300), st.integers(0, 300))
def test_forest_connects_what_is_linked(seed, n, m):
    random = Random(seed)
    centres = [random.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    prints = near_prints(random, n + m, centres)
    a, b = ranked(prints[:n]), ranked(prints[n:])
    edges = [*zip(*simhash.forest(a, a))]
    if len(b):
        edges += [*zip(*simhash.forest(b, b)), *zip(*simhash.forest(a, b))]
    assert len(edges) <= 2 * (len(a) + len(b))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        root[find(int(u))] = find(int(v))
    want = groups(prints)
    assert len({find(p) for p in prints}) == len(set(want))
    assert len({(find(p), w) for p, w in zip(prints, want)}) == len(set(want))


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 16)
    random = Random(3)
    base = [" ".join(f"w{random.randrange(9999)}" for _ in range(200)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(400):
        words = random.choice(base).split()
        for _ in range(random.randrange(3)):
            words[random.randrange(len(words))] = f"w{random.randrange(9999)}"
        rows.append((1000 + i, " ".join(words).upper() if i % 3 == 0 else "  ".join(words)))
    rows += [(5000 + (i or 0) if i is not None else None, t) for i, t, *_ in AWKWARD]
    got = simhash.near_duplicates(with_clashes(documents(spark, rows)).repartition(4)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{p:016x}") for (i, _), p in zip(rows, prints))
    least = {}
    for (i, _), g in zip(rows, groups(prints)):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted((str(i), str(least.get(g))) for (i, _), g in zip(rows, groups(prints)))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(documents(spark, rows))
    alone = {g for (i, _), g in zip(rows, groups(prints))} - set(least)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == documents(spark, []).columns
    assert sorted(x for x in ids if x is not None) == sorted(least.values()) and ids.count(None) == len(alone)


def test_pipeline_keeps_one_of_near_documents(spark, monkeypatch):
    """The stage is operator 6 with its contract: one document of each group linked at two bits stays, whatever the order of rows."""
    import corpus_pipeline

    monkeypatch.setattr(simhash, "CHUNK_ROWS", 64)
    random = Random(5)
    base = [[f"w{random.randrange(9999)}" for _ in range(300)] for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(base)]
    for i in range(160):
        words = list(base[i % 8])  # large groups: some members lie within two bits of others, some don't
        for _ in range(random.randrange(3)):
            words[random.randrange(300)] = f"x{random.randrange(9999)}"
        rows.append((1000 + i, "  ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    rows += [(5000, "a b"), (5001, "A  b"), (5002, "a c"), (5003, ""), (5004, None), (5005, " ")]
    least = {}
    for (i, _), g in zip(rows, groups([plain_fingerprint(t) for _, t in rows])):
        least[g] = min(i, least.get(g, i))
    kept = corpus_pipeline.dedup_stage(spark, documents(spark, rows).repartition(3), "")
    assert kept.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert len(least) < len(rows) - 40
    assert corpus_pipeline.dedup_stage(spark, documents(spark, []), "").count() == 0


def test_a_large_group_gives_a_forest(spark, monkeypatch):
    """Fingerprints that are all near each other give rows in proportion to them and the chunk pairs, not all pairs."""
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 128)
    prints = [0, *(1 << i for i in range(63)), *((1 << i) | (1 << j) for i in range(30) for j in range(i))]
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp bigint")).collect()
    chunks = -(-len(prints) // 128)
    assert len(found) <= len(prints) * (chunks + 1) < len(prints) ** 2 / 20
    assert len({r.root for r in simhash.components(spark.createDataFrame(found, "u bigint, v bigint")).collect()}) == 1


def test_components_of_long_chains(spark):
    random, n = Random(4), 300
    names = random.sample(range(-10**6, 10**6), n)
    edges = [(names[i], names[i + 1]) for i in range(n - 1) if i != 150]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: min(names[:151]) for x in names[:151]} | {x: min(names[151:]) for x in names[151:]}
    assert simhash.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_no_documents_no_groups(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0


# --- quality

def test_ranker_learns_preferences():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, len(quality.NAMES)))
    y = (x[:, 3] - x[:, 5] > -1).astype(int)
    model = quality.fit_ranker(x, y, 1 - y.mean())
    predicted = model.scores(x) >= quality.THRESHOLD
    assert (predicted == y).mean() > 0.95
    assert abs((~predicted).mean() - (1 - y.mean())) < 0.01


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    folder = SF.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "predicted", "score", "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got) and len(got) > 300
    right = [r.predicted == r.quality for r in got]
    assert sum(right) / len(right) > 0.97
    good = [r.predicted for r in got if r.quality == 1]
    assert sum(good) / len(good) > 0.98
    assert quality.train(docs, labels.where("false")).weights == [0.0] * len(quality.NAMES)
    hidden = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, hidden) == quality.train(docs, labels)


def test_scores_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (4, 1, 1), (4, 0, 1), (99, 1, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, AWKWARD)
    got = quality.classify(with_clashes(docs), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out is (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = quality.keep_good(with_clashes(docs), labels)
    assert kept.columns == with_clashes(docs).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)
    assert quality.classify(documents(spark, []), labels).count() == 0


# --- pipeline

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from test_tokens import check_packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outputs = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        outputs.append(docs.collect())
    good, unique, mixed, packed = outputs
    given = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = {r.doc_id: r.predicted for r in quality.classify(given, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in good) == sorted(i for i, p in verdicts.items() if p)
    prints = [plain_fingerprint(r.text) for r in good]
    least = {}
    for r, g in zip(good, groups(prints)):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    assert sorted(r.doc_id for r in unique) == sorted(least.values())
    sizes = Counter()
    for r in unique:
        sizes[r.source] += words_in(r.text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.share_out([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2.0)
    taken = Counter()
    for r in mixed:
        taken[r.source] += words_in(r.text)
    assert all(abs(taken[s] - t) <= 1 for s, t in zip(order, targets))
    check_packing(packed, [(r.doc_id, r.text) for r in mixed], 2048)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        str(r) for r in docs.select("doc_id", "piece", "length", "ids_crc32").collect())
