"""Second-order gradient boosting on Spark: logistic loss, trees grown level by level from histograms.

Features are cut once into at most `bins` parts at exact quantiles, and rows are stored as blocks of bytes, dealt by a hash of their
key. For each level of a tree every task adds up gradients and hessians of its rows by (node, feature, bin); Spark sums these
histograms, and only they reach the driver, which picks the splits of greatest gain. A right child's histogram is its parent's less its
sibling's, so just left children and roots are counted. Sums are of whole numbers (gradients in units of a power of two), so a
fit gives the same trees however rows are spread and whatever tasks are repeated. Margins are stored with the blocks every few trees; in
between, tasks add the trees since then.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventwin.operators.scan import _q, exact_quantiles
from eventwin.operators.trees import Tree, outputs
from eventwin.sources.sinks import staged

# executors get the functions below by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, trees after which margins are stored anew, and the number of the bin of missing values.
BLOCK_ROWS, STORE_EVERY, MISSING = 4_096, 16, 255
#: Gradients count in units of two to the minus this, or coarser where 62 bits wouldn't hold all of them.
PRECISION = 36
#: Fixed value: a split must gain more than this.
LEAST_GAIN = 1e-6
BLOCKS = "block bigint, keys binary, labels binary, bins binary, margins binary"


@dataclass
class BoostedTrees:
    """A fitted model: `start` plus the trees' outputs is the margin, the log-odds of class 1."""

    features: list[str]
    trees: list[Tree]
    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    #: (tree, node, gain) of all splits
    gains: list[tuple[int, int, float]] = field(default_factory=list)

    def margins(self, df: DataFrame, name: str = "margin") -> DataFrame:
        """`df` plus the margin, in place of a column of that name; features that are null or NaN count as missing."""
        spark, columns, start = df.sparkSession, list(self.features), self.start
        kept = [c for c in df.columns if c.lower() != name]
        shipped = spark.sparkContext.broadcast(self.trees)
        given = df.select(*_q(kept), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x__"))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(float)
                total = start + outputs(values.reshape(batch.num_rows, len(columns)), shipped.value)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total)], [*batch.schema.names[:-1], name])

        return given.mapInArrow(add, T.StructType([*df.select(*_q(kept)).schema.fields, T.StructField(name, T.DoubleType())]))

    def predict(self, df: DataFrame) -> DataFrame:
        """`df` plus `score`, the probability of class 1, and `prediction`, 1 from a score above 0.5."""
        margin = F.col("margin__")
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        return self.margins(df, "margin__").select(*_q(df.columns), score.alias("score"), (margin > 0).cast("int").alias("prediction"))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature (null for leaves), split_limit, missing_left, left, right, value, cover, gain."""
        gains = {(t, n): g for t, n, g in self.gains}
        rows = [(t, n, self.features[f] if left >= 0 else None, limit if left >= 0 else None, missing if left >= 0 else None, left, right, value, cover,
                 gains.get((t, n)))
                for t, tree in enumerate(self.trees)
                for n, (f, limit, missing, left, right, value, cover) in enumerate(zip(*(c.tolist() for c in (
                    tree.feature, tree.limit, tree.missing_left, tree.left, tree.right, tree.value, tree.cover))))]
        return spark.createDataFrame(rows, "tree int, node int, feature string, split_limit double, missing_left boolean, left int, right int, "
                                           "value double, cover double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and feature names as Parquet."""
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(i, name, self.start) for i, name in enumerate(self.features)]
        spark.createDataFrame(head, "position int, feature string, start double").write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head = spark.read.parquet(f"{path}/features").orderBy("position").collect()
        features = [r["feature"] for r in head]
        place, trees, gains = {name: i for i, name in enumerate(features)}, {}, []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            split = r["left"] >= 0
            trees.setdefault(r["tree"], []).append((place[r["feature"]] if split else -1, r["split_limit"] if split else 0.0, bool(r["missing_left"]),
                                                    r["left"], r["right"], r["value"], r["cover"]))
            if split:
                gains.append((r["tree"], r["node"], r["gain"]))
        return cls(features, [Tree.of(trees[t]) for t in sorted(trees)], head[0]["start"], gains=gains)


def cut_points(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature, distinct values that are quantiles (all but the smallest value, if there are few): a row is left of a cut if below it."""
    probs = [i / bins for i in range(bins + 1)]
    rows = exact_quantiles(df, features, probs).select("column", "value").collect()  # features x bins values
    found: dict[str, set] = {f: set() for f in features}
    for column, value in rows:
        found[column].add(value)
    return [np.array(sorted(found[f])[1:][:MISSING - 1]) for f in features]


def _draws(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each key, another one for each salt."""
    x = keys.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53


def _blocks(rows: DataFrame, features: Sequence[str], label: str, key: str | None, cuts: list[np.ndarray]) -> DataFrame:
    """Rows as blocks of bytes: hashed keys, labels and the bins of all features, feature by feature."""
    keyed = F.xxhash64(F.col(f"`{key}`")) if key else F.xxhash64(*[F.col(f"`{c}`") for c in features], F.col(f"`{label}`"))
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    given = rows.select(keyed.alias("key"), F.col(f"`{label}`").cast("int").alias("label"), values.alias("x")).where("label in (0, 1)")
    # equal keys may be a large share of all rows, so these are dealt too; where a row lies changes nothing
    dealt = given.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(64))).repartition("key", "part").drop("part")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(cuts))
                binned = np.stack([np.where(np.isnan(c), MISSING, np.searchsorted(cut, c, side="right")).astype(np.uint8) for c, cut in zip(x.T, cuts)])
                labels, keys = np.asarray(batch.column(1)).astype(np.uint8), np.asarray(batch.column(0)).astype("<i8")
                columns = [keys.tobytes(), labels.tobytes(), binned.tobytes(), np.zeros(batch.num_rows).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["keys", "labels", "bins", "margins"])

    packed = dealt.mapInArrow(pack, "keys binary, labels binary, bins binary, margins binary")
    return staged(packed.select(F.monotonically_increasing_id().alias("block"), "keys", "labels", "bins", "margins"), "boosting-blocks")


class _Grown:
    """A tree while it grows: splits by bin, so that it can be followed over stored blocks."""

    def __init__(self):
        self.rows: list[list] = [[-1, 0.0, False, -1, -1, 0.0, 0.0]]  # as Tree.of takes them
        self.bin: list[int] = [0]

    def split(self, node: int, feature: int, bin: int, limit: float, missing_left: bool) -> tuple[int, int]:
        left = len(self.rows)
        self.rows += [[-1, 0.0, False, -1, -1, 0.0, 0.0] for _ in range(2)]
        self.bin += [0, 0]
        self.rows[node][:5] = [feature, limit, missing_left, left, left + 1]
        self.bin[node] = bin
        return left, left + 1

    def arrays(self) -> tuple:
        return (*(np.array([r[i] for r in self.rows]) for i in (0, 2, 3, 4, 5)), np.array(self.bin))


def _places(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """The node that each row of a block (feature by row) has come to."""
    feature, missing_left, left, right, _, limit = tree
    at, row = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    while True:
        inner = left[at] >= 0
        if not inner.any():
            return at
        own = at[inner]
        value = bins[feature[own], row[inner]]
        goes = np.where(value == MISSING, missing_left[own], value <= limit[own])
        at[inner] = np.where(goes, left[own], right[own])


def _margins(block: tuple, trees: list[tuple], n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, margins) of a block with the trees since it was stored."""
    bins = np.frombuffer(block[3], np.uint8).reshape(n_features, -1)
    margin = np.frombuffer(block[4], float).copy()
    for tree in trees:
        margin += tree[4][_places(tree, bins)]
    return bins, margin


def _histograms(blocks: DataFrame, since: list[tuple], growing: tuple, counted: list[int], columns: np.ndarray, n_features: int, weight: float,
                share: float, salt: int, unit: float) -> np.ndarray:
    """[node, column, bin, (gradient, hessian)] in units, summed over all sampled rows in the nodes `counted`."""
    shipped = blocks.sparkSession.sparkContext.broadcast((since, growing))
    place = np.full(len(growing[2]), -1)
    place[counted] = np.arange(len(counted))
    size = MISSING + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, tree = shipped.value
        sums = np.zeros((2, len(counted) * len(columns) * size), np.int64)
        for batch in batches:
            for block in zip(*(c.to_pylist() for c in batch.columns)):
                bins, margin = _margins(block, trees, n_features)
                positive = np.frombuffer(block[2], np.uint8) == 1
                node = place[_places(tree, bins)]
                used = node >= 0
                if share < 1:
                    used &= _draws(np.frombuffer(block[1], "<i8"), salt) < share
                at = np.flatnonzero(used)
                p = 1 / (1 + np.exp(-margin[at]))
                w = np.where(positive[at], weight, 1.0)
                # whole numbers below 2^53 in a block, so their sums in doubles are exact
                parts = np.rint(w * (p - positive[at]) * unit), np.rint(np.maximum(w * p * (1 - p), 1e-16) * unit)
                for i, column in enumerate(columns):
                    cell = (node[at] * len(columns) + i) * size + bins[column, at]
                    low = int(cell.min(initial=0))
                    for total, part in zip(sums, parts):
                        found = np.bincount(cell - low, part)
                        total[low:low + len(found)] += found.astype(np.int64)
        cells = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[0, cells]), pa.array(sums[1, cells])], ["cell", "g", "h"])

    found = blocks.mapInArrow(add, "cell bigint, g bigint, h bigint").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, len(counted) * len(columns) * size), np.int64)
    cells = np.asarray(found.column("cell"))
    out[0, cells], out[1, cells] = np.asarray(found.column("g")), np.asarray(found.column("h"))
    shipped.unpersist()
    return out.reshape(2, len(counted), len(columns), size).transpose(1, 2, 3, 0)


def best_split(histogram: np.ndarray, n_cuts: Sequence[int], penalty: float, least_child: float) -> tuple[float, int, int, bool] | None:
    """(gain, column, bin, missing_left) of the split of greatest gain of one node's [column, bin, (gradient, hessian)].

    Rows of a bin up to the split's go left. Ties go to the first column, then the lowest bin, then missing values to the right.
    """
    best = None
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + penalty)
    for column, cuts in enumerate(n_cuts):
        if not cuts:
            continue
        whole, missing = histogram[column].sum(0), histogram[column, MISSING]
        left = np.cumsum(histogram[column, :cuts], axis=0)
        both = np.stack([left, left + missing], axis=1)  # [cut, missing right or left, 2]
        rest = whole - both
        gain = (score(both) + score(rest) - score(whole)) / 2
        allowed = (both[..., 1] >= max(least_child, 1e-12)) & (rest[..., 1] >= max(least_child, 1e-12))
        gain = np.where(allowed, gain, -np.inf).ravel()
        first = int(gain.argmax())
        if np.isfinite(gain[first]) and (best is None or gain[first] > best[0]):
            best = float(gain[first]), column, first // 2, bool(first % 2)
    return best


@dataclass(frozen=True)
class Binned:
    """Training rows as blocks of bins, made once for any number of fits over the same rows."""

    blocks: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    weight: float  # of positives
    unit: float


def bin_rows(train: DataFrame, features: Sequence[str], label: str = "label_storm", *, positive_weight: float | None = None, bins: int = 254,
             key: str | None = None) -> Binned:
    """The rows labelled 0 or 1, cut at quantiles and stored. Positives weigh negatives / positives unless given."""
    from eventwin.operators.models import class_sizes

    features = list(features)
    n0, n1 = class_sizes(train, label)
    weight = n0 / n1 if positive_weight is None else float(positive_weight)
    unit = 2.0 ** min(PRECISION, 61 - math.ceil(math.log2(n0 + n1 * weight + 1)), 52 - math.ceil(math.log2(BLOCK_ROWS * max(weight, 1.0))))
    cuts = cut_points(train.where(f"`{label}` in (0, 1)"), features, min(bins, MISSING - 1))
    return Binned(_blocks(train, features, label, key, cuts), features, cuts, weight, unit)


def fit_trees(train: DataFrame, features: Sequence[str], label: str = "label_storm", *, rounds: int = 500, depth: int = 4, step: float = 0.05,
              rows: float = 0.8, columns: float = 0.8, positive_weight: float | None = None, penalty: float = 1.0, gamma: float = 0.0,
              least_child: float = 1.0, bins: int = 254, seed: int = 42, key: str | None = None) -> BoostedTrees:
    """Boosted trees for labels 0 and 1; rows with another label are left out.

    A split's gain is half of GL²/(HL+penalty) + GR²/(HR+penalty) - G²/(H+penalty); it must exceed `gamma`, and each child needs a
    hessian of `least_child`. A leaf's value is -step G/(H+penalty). Each tree sees a share `rows` of the rows, drawn by a
    hash of `key` (of all values without one, so equal rows are drawn together) and a share `columns` of the features. Missing values go to
    the side of greater gain. Positives weigh negatives / positives unless given.
    """
    binned = bin_rows(train, features, label, positive_weight=positive_weight, bins=bins, key=key)
    return grow_trees(binned, rounds=rounds, depth=depth, step=step, rows=rows, columns=columns, penalty=penalty, gamma=gamma,
                      least_child=least_child, seed=seed)


def grow_trees(binned: Binned, kept: Sequence[str] | None = None, *, rounds: int = 500, depth: int = 4, step: float = 0.05, rows: float = 0.8,
               columns: float = 0.8, penalty: float = 1.0, gamma: float = 0.0, least_child: float = 1.0, seed: int = 42) -> BoostedTrees:
    """`fit_trees` over rows that are binned already, from the features `kept` alone (all by default).

    With rows drawn by a key, this is the model that `fit_trees` fits to a table of only these features.
    """
    names, random = [f for f in binned.features if kept is None or f in set(kept)], np.random.default_rng(seed)
    place = [binned.features.index(f) for f in names]  # in the blocks
    blocks, n_features, cuts = binned.blocks, len(binned.features), [binned.cuts[i] for i in place]
    per_tree = max(1, round(columns * len(names)))
    model, since = BoostedTrees(names, [], 0.0, cuts), []
    for number in range(rounds):
        drawn = np.sort(random.permutation(len(names))[:per_tree])
        stored = np.array([place[i] for i in drawn], dtype=int)
        tree, salt = _Grown(), seed * 1_000_003 + number
        histograms = lambda counted: _histograms(blocks, since, tree.arrays(), counted, stored, n_features, binned.weight, rows, salt, binned.unit) / binned.unit
        level = dict(zip([0], histograms([0])))
        for deep in range(depth + 1):
            children = []
            for node, histogram in level.items():
                g, h = histogram[0].sum(0)
                tree.rows[node][5:] = [-step * g / (h + penalty), h]
                found = best_split(histogram, [len(cuts[c]) for c in drawn], penalty, least_child) if deep < depth else None
                if found and found[0] > max(gamma, LEAST_GAIN):
                    gain, column, bin, missing_left = found
                    left, right = tree.split(node, int(stored[column]), bin, float(cuts[drawn[column]][bin]), missing_left)
                    model.gains.append((number, node, gain))
                    children.append((node, left, right))
            if not children:
                break
            counted = histograms([left for _, left, _ in children])
            level = {child: h for (node, left, right), own in zip(children, counted) for child, h in ((left, own), (right, level[node] - own))}
        for row in tree.rows:
            if row[3] >= 0:
                row[5] = 0.0
        model.trees.append(Tree.of([[place.index(row[0]) if row[3] >= 0 else -1, *row[1:]] for row in tree.rows]))
        since.append(tree.arrays())
        if len(since) == STORE_EVERY and number + 1 < rounds:
            blocks, since = _stored(blocks, since, n_features), []
    return model


def _stored(blocks: DataFrame, trees: list[tuple], n_features: int) -> DataFrame:
    """The blocks with margins that include the trees."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [_margins(block, trees, n_features)[1].tobytes() for block in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(margins, pa.binary())], batch.schema.names)

    return staged(blocks.mapInArrow(add, BLOCKS), "boosting-blocks")
