"""The prefix trie, collocations and embedding near-duplicates against brute force, on odd rows and on hot groups."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import AWKWARD, documents, with_clashes
from llm import collocations, prefix_trie, vector_dedup

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"


# --- prefix trie

def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt, members, children = {}, defaultdict(list), defaultdict(list)
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(own.get(conv - int(math.fmod(conv, 20)), [])[:h] + own[conv][h:])
        for d in range(len(rebuilt[conv]) + 1):
            members[rebuilt[conv][:d]].append(conv)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[p]) if rebuilt[c] == p)
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(df, **settings):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in prefix_trie.trie(df, **settings).select(*names).collect()), key=str)


@pytest.mark.parametrize("range_rows", [20_000, 8])
def test_trie_of_the_table(spark, range_rows):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert trie_rows(with_clashes(df), range_rows=range_rows) == plain_trie([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def odd_turns():
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["a b", "a", "", None])) for c in range(60) for t in range(draw.randint(1, 6))]
    rows += [(7, None, "user", "before"), (7, 2, "user", "again"), (7, 2, "user", "again"), (None, 0, "user", "nobody's"), (-3, 0, "user", "a"), (-41, 1, "user", "a")]
    rows += [(200 + i, t, "user", "same words here") for i in range(150) for t in range(3)]  # a hot conversation
    rows += [(500, t, "user", f"deep {t}") for t in range(300)] + [(520, 0, "user", "long " * 20_000), (1021, 0, "user", "no base")]
    return rows


@pytest.mark.parametrize("range_rows", [20_000, 1])
def test_trie_of_odd_rows(spark, range_rows):
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert trie_rows(df, range_rows=range_rows) == plain_trie(rows)


def test_trie_without_rows(spark):
    assert trie_rows(spark.createDataFrame([], TURNS)) == []


def test_ids_longer_than_a_chunk(spark, monkeypatch):
    """A node's ids pass through the digest in chunks and across tasks."""
    rows = [(20 * i, 0, "user", "hello") for i in range(3_000)]
    chains = prefix_trie.rebuilt(spark.createDataFrame(rows, TURNS).repartition(6)).mapInArrow(prefix_trie._chains, prefix_trie.CHAINS)
    ordered = chains.repartitionByRange(7, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = ordered.mapInArrow(prefix_trie._joined_ids, "node binary, chain binary, words array<bigint>, least bigint, amount bigint, ids string")
    assert chunks.count() > 3
    one = chunks.repartition("node").sortWithinPartitions("node", "least").mapInArrow(prefix_trie._ended, prefix_trie.ROWS).collect()
    assert [(r.n_convs, r.ends) for r in one] == [(3_000, hashlib.sha256(",".join(str(20 * i) for i in range(3_000)).encode()).hexdigest())]


def test_open_nodes_are_those_on_the_rims():
    """Peeling in ranges of any cut gives what peeling at once gives."""
    draw = random.Random(5)
    chains = sorted({bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 6))) for _ in range(60)})
    size = prefix_trie.DIGEST
    digest = lambda c: hashlib.blake2b(c, digest_size=size).digest()
    rows = [(b"".join(digest(c[:d]) for d in range(1, len(c) + 1)), [3] * len(c), i, 1 + i % 2, 0, 0, 0, f"e{i}") for i, c in enumerate(chains)]
    rows.sort()
    whole = sorted((n[0], n[1], *n[3:]) for n, _ in prefix_trie.peel(rows, True))
    for cut in (1, 3, 10):
        left, done = [], []
        for i in range(0, len(rows), cut):
            for node, row in prefix_trie.peel(rows[i:i + cut], False):
                (done if node else left).append(node or row)
        assert len(left) <= sum(2 * 7 for _ in range(0, len(rows), cut))
        done += [n for n, _ in prefix_trie.peel(left, True)]
        known = {n[0]: n[3] for n in done}
        assert sorted((n[0], n[1], n[3], n[4], known[n[1]] if n[2] else n[5], *n[6:]) for n in done) == whole


# --- collocations

def plain_collocations(rows, longest=3, least=10, top=2_000):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = {(lang, w[i:i + size]) for (lang, w), a in candidates.items() for size in range(2, len(w)) for i in range(len(w) - size + 1)
               if 100 * a >= 50 * counts[lang, w[i:i + size]]}
    found = []
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, cut = min((1_000_000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
            found.append((lang, -score, -a, " ".join(w).encode(), counts[lang, w[:cut]], counts[lang, w[cut:]]))
    out, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def told(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bits", [64, 9])
def test_collocations_of_the_table(spark, bits):
    """With nine bits nearly all fingerprints collide."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert told(collocations.collocations(with_clashes(docs), bits=bits)) == plain_collocations([(r.lang, r.text) for r in docs.collect()])


def odd_texts():
    draw = random.Random(8)
    vocabulary = ["a", "b", "Élan", "x y", "\U0001f600", "the", "THE", "don't", "-", "ß"]
    gaps = [" ", "  ", "\t", " \t ", ". ", ",", "\n", "\x0b", " ; "]
    texts = [(draw.choice(["en", None, "und", "de"]), "".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))) for _ in range(200)]
    return texts + [("en", None), (None, ""), ("en", " \t\n.,"), ("de", "a b " * 3_000), ("de", "the end"), *[("en", "same words in many rows")] * 300]


@pytest.mark.parametrize("settings", [{}, {"longest": 4}, {"top": 3}])
def test_collocations_of_odd_rows(spark, monkeypatch, settings):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert told(collocations.collocations(df.repartition(4), **settings)) == plain_collocations(texts, **settings)
    assert collocations.collocations(documents(spark, AWKWARD)).count() > 0  # the long run of a b c
    assert told(collocations.collocations(documents(spark, []))) == []


def test_long_texts_are_hashed_in_parts(monkeypatch):
    """Phrases over the rim of two parts are found once, and a word longer than a part stays whole."""
    draw = random.Random(1)
    data = "".join(draw.choice(["ab", "c", "é", "." , " ", "\t", " ", "w" * 90]) for _ in range(4_000)).encode()
    spoken = lambda at, n: tuple(m[0] for m, _ in zip(collocations.WORD.finditer(data, at), range(n)))
    for n in (1, 2, 3):
        monkeypatch.setattr(collocations, "AT_ONCE", 1 << 30)
        starts, hashes, places = next(collocations.grams(data, n))
        want = Counter(zip(starts[places].tolist(), collocations.polynomials()[0].grams(hashes[0], places, n).tolist()))
        monkeypatch.setattr(collocations, "AT_ONCE", 50)
        got = Counter()
        for starts, hashes, places in collocations.grams(data, n):
            got.update(zip(starts[places].tolist(), collocations.polynomials()[0].grams(hashes[0], places, n).tolist()))
        assert got == want and len({h for _, h in want}) == len({spoken(s, n) for s, _ in want})


def test_equal_phrases_have_equal_fingerprints_anywhere():
    data = b"one two three. x one  two\tthree one two. one-two"
    (starts, hashes, places), = collocations.grams(data, 2)
    prints = dict(zip(starts[places].tolist(), collocations.polynomials()[0].grams(hashes[0], places, 2).tolist()))
    assert prints[0] == prints[17] == prints[32] and len(set(prints.values())) == len(prints) - 3


# --- embedding near-duplicates

def plain_links(rows, cosine=0.9):
    """(id, links, component, kept) of each row, in the order of the rows."""
    usable = [i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    linked, root = defaultdict(set), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in usable:
        for j in usable:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                x, y = (np.array(rows[k][1], float) for k in (i, j))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if math.fsum(x * y) >= cosine * math.sqrt(math.fsum(x * x) * math.fsum(y * y)):
                    linked[i].add(j)
                    linked[j].add(i)
                    root[find(j)] = find(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(linked[i]), least.get(find(i)), key == least.get(find(i))) for i, (key, _) in enumerate(rows)]


def linked_rows(df, **settings):
    return sorted((tuple(r) for r in vector_dedup.near_duplicates(df, **settings).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def clustered(count, dim, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((count // 8, dim))
    return centres[draw.integers(0, len(centres), count)] + draw.standard_normal((count, dim)) * draw.choice([0.1, 0.25, 0.3, 0.5], (count, 1))


def test_links_on_odd_rows(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(160, 12))]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [1.0, None] + [0.0] * 10), (1004, [math.nan] * 12), (1005, [math.inf] + [0.0] * 11),
             (1006, [1e300] * 12), (1007, [1e-300] * 12), (1008, [2.0]), (1009, [5.0]), (1010, [-1.0]), (1011, [0.0, 1.0]), (1012, [-0.0, 2.0]),
             (3, rows[100][1]), (3, rows[100][1]), (None, rows[5][1]), (None, [9.0, 0.0, 0.0]), *[(2000 + i, rows[20][1]) for i in range(100)]]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, label int")
    assert linked_rows(with_clashes(df.repartition(3)), target=1.0) == sorted(plain_links(rows), key=str)
    assert linked_rows(df.limit(0)) == []


def test_links_in_small_packs(spark, monkeypatch):
    """Groups that fill many packs, cells and tasks, near copies of a third of all rows among them."""
    for name, value in (("BIN_CODES", 1), ("CELL_ROWS", 4)):
        monkeypatch.setattr(vector_dedup, name, value)
    draw = np.random.default_rng(4)
    hot = draw.standard_normal(16) + draw.standard_normal((150, 16)) * 0.22
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([clustered(300, 16, 2), hot]))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, want = linked_rows(df), sorted(plain_links(rows), key=str)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    most = {r[0]: r[1] for r in want}
    assert all(r[1] <= most[r[0]] for r in got) and sum(a == b for a, b in zip(got, want)) > 0.8 * len(want)


def test_recall_over_clusters(spark):
    vectors = clustered(3_000, 64, 6).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    unit = vector_dedup.units(vectors.astype(float))
    want = ((unit @ unit.T) >= 0.9).sum(1) - 1
    got = {r[0]: r[1] for r in linked_rows(df)}
    assert sum(want) > 1_000 and all(got[i] <= w for i, w in enumerate(want)) and sum(got.values()) >= 0.97 * want.sum()


def test_traversal_is_the_multi_sequence_order():
    """The cells come as a heap over both sorted sequences gives them, and no others lie within the margin."""
    points = vector_dedup.units(clustered(400, 10, 9))
    grid = vector_dedup.Grid(points, 4_000, 0.9, 0.95)
    own, rows, cells = grid.traverse(points[:40])
    left, right = grid.distances(points[:40])
    for p in range(40):
        a, b = np.argsort(left[p], kind="stable"), np.argsort(right[p], kind="stable")
        heap, seen, order, limit = [(left[p, a[0]] + right[p, b[0]], 0, 0)], {(0, 0)}, [], left[p].min() + right[p].min() + grid.margin
        while heap and heap[0][0] <= limit:
            far, i, j = heapq.heappop(heap)
            order.append((far, a[i] * len(grid.second) + b[j]))
            for step in ((i + 1, j), (i, j + 1)):
                if step not in seen and step[0] < len(a) and step[1] < len(b):
                    seen.add(step)
                    heapq.heappush(heap, (left[p, a[step[0]]] + right[p, b[step[1]]], *step))
        assert cells[rows == p].tolist() == [c for _, c in sorted(order, key=lambda x: x[0])] and order[0][1] == own[p]


def test_margin_keeps_the_target_share():
    points = vector_dedup.units(np.random.default_rng(2).standard_normal((4_000, 32)))
    grid = vector_dedup.Grid(points[:2_000], 4_000, 0.9, 0.98)
    x = points[2_000:]
    z = np.random.default_rng(3).standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
    assert (np.minimum(grid._excess(x, y), grid._excess(y, x)) <= grid.margin).mean() >= 0.96
