"""Quality scores learned from preferences by a Bradley-Terry model.

Every document has a strength, linear in features of its whole text; a good one is preferred to a bad one with the logistic of the
difference of strengths. Strengths are learned from preference pairs by the logistic loss on differences of features. The threshold
is a quantile of the strengths of the labelled sample, at the sample's share of bad documents, and scores are the logistic of the
distance from it, moved so that the threshold has score 0.3.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from llm.exprs import added

#: Labelled documents that the model is fitted on, at most (drawn by a hash of their ids; half of each label if there are as many),
#: and good partners drawn for each bad one (and the reverse).
SAMPLE_ROWS = 20_000
PARTNERS = 8
#: Score at and above which a document is predicted to be good.
THRESHOLD = 0.3
PENALTY = 1e-3
STEPS = 40

#: Rates of these characters are features; upper-case, digits, spaces and bytes of other scripts are counted as kinds.
MARKS = "!?.,;:|*#$%&@/\\<>{}[]()=+-_~^\"'"
NAMES = ("words", "characters a word", "distinct words", "repeats of the word before", "commonest word", "upper-case words",
         "words without letters", "lines", "distinct lines", "upper case", "digits", "spaces", "controls", "other bytes", *MARKS)


def features(text: str | None) -> list[float]:
    """Features of a whole text; zeros for null, empty and blank ones. Nothing but the text is looked at."""
    from collections import Counter
    from operator import eq

    import numpy as np

    words = text.split() if text else []
    if not words:
        return [0.0] * len(NAMES)
    n, counted, lines = len(words), Counter(words), text.split("\n")
    data = text.encode("utf-8", "surrogatepass")
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    root = math.sqrt
    kinds = [octets[65:91].sum(), octets[48:58].sum(), octets[32], octets[:32].sum(), octets[128:].sum()]
    upper = sum(v for w, v in counted.items() if len(w) > 2 and w.isupper())
    bare = sum(v for w, v in counted.items() if not any(map(str.isalpha, w)))
    return [math.log1p(n), len(text) / n / 10, len(counted) / n, root(sum(map(eq, words, words[1:])) / n), root(max(counted.values()) / n),
            root(upper / n), root(bare / n), math.log1p(len(lines)), len(set(lines)) / len(lines), *map(root, kinds),
            *(root(octets[ord(c)]) for c in MARKS)]


class Ranker(NamedTuple):
    """Strength: weights over features (centred and scaled), less the strength at the threshold."""

    centre: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def strengths(self, rows):
        import numpy as np

        return ((np.asarray(rows, float).reshape(-1, len(self.centre)) - self.centre) / self.scale) @ np.asarray(self.weights) - self.threshold

    def scores(self, rows):
        import numpy as np

        z = np.clip(self.strengths(rows) + math.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)
        return 1 / (1 + np.exp(-z))


def fit_ranker(rows, labels, bad_share: float, seed: int = 5) -> Ranker:
    """A model of features and 0/1 labels; with one label alone all strengths are equal and every document is as that label says."""
    import numpy as np

    x, y, random = np.asarray(rows, float).reshape(-1, len(NAMES)), np.asarray(labels, int), np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker([0.0] * len(NAMES), [1.0] * len(NAMES), [0.0] * len(NAMES), 1.0 if len(bad) else -1.0)
    centre, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = (x - centre) / scale
    better = np.concatenate([random.choice(good, len(bad) * PARTNERS), np.repeat(good, 1)])
    worse = np.concatenate([np.repeat(bad, PARTNERS), random.choice(bad, len(good))])
    difference, w = z[better] - z[worse], np.zeros(z.shape[1])
    for _ in range(STEPS):  # Newton steps of the penalized loss
        p = 1 / (1 + np.exp(np.clip(difference @ w, -500, 500)))
        slope = difference.T @ p / len(p) - PENALTY * w
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / len(p) + PENALTY * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    # the quantile at the share of bad documents among all labelled ones, each label's rows weighted as they occur there
    weight = np.where(y == 0, bad_share / len(bad), (1 - bad_share) / len(good))
    order = np.argsort(s, kind="stable")
    below = np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-12) + 1
    threshold = s[order[-1]] if below >= len(s) else (s[order[below - 1]] + s[order[below]]) / 2
    return Ranker(centre.tolist(), scale.tolist(), w.tolist(), float(threshold))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels aren't learned: every fifth by the crc32 of the id as text (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Ranker:
    """A model from documents with a label 0 or 1 in `quality` that aren't held out; other labels and unlabelled rows are ignored.

    Labels that contradict each other for one id count as the smaller. Only the ids of the sample's rows are joined to texts.
    """
    known = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, half = sum(counts.values()), sample_rows // 2
    if not total:
        return fit_ranker([], [], 0.0)
    room = {q: max(half, sample_rows - counts.get(1 - q, 0)) for q in (0, 1)}
    drawn = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(room[q]) for q in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # sample_rows ids at most
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(chosen, "doc_id").select("quality", "text")

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.float64()))], ["quality", "x"])

    # ids that repeat in the documents can't make the sample larger
    sample = rows.mapInArrow(measured, "quality int, x array<double>").orderBy(F.xxhash64("x"), "quality").limit(sample_rows).toArrow()
    return fit_ranker(sample.column("x").to_pylist(), sample.column("quality").to_pylist(), counts.get(0, 0) / total)


def with_scores(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """`docs` and score (0 to 1) of every whole text; a column score is replaced. Null and empty texts are scored like any other."""
    kept = [c for c in docs.columns if c.lower() != "score"]
    docs, at = docs.select(*kept), kept.index("text")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = ranker.scores([features(t.as_py()) for t in batch.column(at)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*kept, "score"])

    return docs.mapInArrow(score, added(docs.schema, score=DoubleType()))


def classify(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents. Repeated rows give a row each; extra columns are ignored."""
    given = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    scored = with_scores(given, train(docs, labels, sample_rows=sample_rows)).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents predicted to be good, with their columns."""
    kept = docs.columns
    plain = docs.select(*[F.col(c).alias(f"_{c}" if c.lower() == "score" else c) for c in kept])
    good = with_scores(plain, train(docs, labels, sample_rows=sample_rows)).where(F.col("score") >= THRESHOLD)
    return good.select(*[F.col(f"_{c}" if c.lower() == "score" else c).alias(c) for c in kept])
