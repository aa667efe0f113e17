"""Second-order boosted trees on binned columns.

Rows lie in blocks of some thousands, which hold their bins (a byte a feature) and their margins as arrays. A level of a tree is
one small job: tasks add up the gradients and hessians of their rows by node, feature and bin, and the driver, which gets a number of
sums that depends on the settings alone, picks the splits. The first job of a tree also adds the tree before to the margins and keeps
the blocks for the other levels. Only the lighter child of a split is counted; its sibling is
what is left of the parent. Gradients and hessians are whole multiples of 2 ** -30, so sums, and with
them the trees, do not depend on how rows lie in partitions, nor on a task that runs twice.

A split sends rows without a value to the side that gains more. Leaves are shrunk by `reg_lambda`; a child must have hessians
of `min_child_weight` in all. Rows are drawn for each tree by a hash, columns once a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import delete, ensure_checkpoint_dir

LOGISTIC, SQUARED = "logistic", "squared"
SCALE = 1 << 30
# Bin numbers fit a byte; the last one is for rows without a value.
MISSING, CELLS = 255, 256
# The least gain of a split.
LEAST_GAIN = 1e-6
# Trees after which the blocks are stored anew, so that a lost one is made again from at most as many trees.
REFRESH = 16
# Rows of a partition, if there are cores for more partitions, and at most.
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 20
# Partitions whose sums the driver adds up itself.
FEW = 16
DEFAULTS = {
    "trees": 100, "depth": 3, "rate": 0.1, "min_child_weight": 1.0, "rows": 1.0, "columns": 1.0,
    "reg_lambda": 1.0, "bins": 255, "seed": 42,
}
BLOCK = "bins binary, label binary, margin binary, draw binary"
NODES = (
    "tree int, node int, feature int, threshold double, missing_left boolean, value double, cover double, gain double"
)


@dataclass(frozen=True)
class Tree:
    """Nodes by number: the children of node i are 2 i + 1 and 2 i + 2. A leaf has feature -1.

    A row goes left if its value is at most the threshold. `cover` is the sum of hessians of the training rows in a node.
    """

    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def reach(self, x: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(len(self.feature).bit_length() - 1):
            feature = self.feature[at]
            tested = np.maximum(feature, 0)
            left = np.where(missing[rows, tested], self.missing_left[at], x[rows, tested] <= self.threshold[at])
            at = np.where(feature >= 0, 2 * at + 2 - left, at)
        return at

    def add_to(self, margins: np.ndarray, x: np.ndarray, missing: np.ndarray) -> None:
        margins += self.value[self.reach(x, missing)]


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: the sum of its trees on top of `base`; a logistic one gives the chance of that sum as log-odds."""

    features: list[str]
    objective: str
    base: float
    trees: list[Tree]

    @property
    def inputs(self) -> Column:
        return F.array(*[F.col(c).cast("double") for c in self.features])

    def margins(self, x: np.ndarray) -> np.ndarray:
        missing, out = np.isnan(x), np.full(len(x), self.base)
        for tree in self.trees:
            tree.add_to(out, x, missing)
        return out

    def score(self, df: DataFrame, column: str) -> DataFrame:
        """Append the chance of a logistic model, or the prediction of one for numbers."""
        width, logistic = len(self.features), self.objective == LOGISTIC

        @F.arrow_udf("double")
        def scored(values: pa.Array) -> pa.Array:
            margins = self.margins(matrix_of(values, width))
            return pa.array(chance(margins) if logistic else margins)

        return df.withColumn(column, scored(self.inputs))

    def importances(self) -> list[tuple[str, float]]:
        """The mean gain of each feature's splits, as a share of all."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gain, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        mean = gain / np.maximum(splits, 1)
        return list(zip(self.features, (mean / (mean.sum() or 1.0)).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the nodes that rows can reach, and what else the model holds."""
        rows = [
            (t, int(i), int(tree.feature[i]), float(tree.threshold[i]), bool(tree.missing_left[i]),
             float(tree.value[i]), float(tree.cover[i]), float(tree.gain[i]))
            for t, tree in enumerate(self.trees) for i in np.flatnonzero(tree.cover > 0)
        ]
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = [(self.features, self.objective, self.base, [len(tree.feature) for tree in self.trees])]
        fields = "features array<string>, objective string, base double, sizes array<int>"
        spark.createDataFrame(facts, fields).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        features, objective, base, sizes = spark.read.parquet(f"{path}/model").first()
        trees = [Tree.of_depth(size.bit_length() - 1) for size in sizes]
        for row in spark.read.parquet(f"{path}/nodes").collect():  # as many as the settings allow
            tree, i = trees[row.tree], row.node
            for name in ("feature", "threshold", "missing_left", "value", "cover", "gain"):
                getattr(tree, name)[i] = row[name]
        return cls(list(features), objective, base, trees)


def chance(margins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margins))


def matrix_of(values: pa.Array, width: int) -> np.ndarray:
    """An array column as a matrix; nulls become NaN."""
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def cut_points(train: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """The upper ends of each feature's bins: quantiles of its values, and infinity as the last one."""
    shares = [(i + 1) / bins for i in range(bins - 1)]
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    found = train.agg(*[F.percentile_approx(value(c), shares, 10_000).alias(c) for c in features]).first()
    return [np.append(np.unique([v for v in found[c] or [] if np.isfinite(v)]), np.inf) for c in features]


def _states(train: DataFrame, features: Sequence[str], label: Column, cuts: list[np.ndarray], base: float) -> DataFrame:
    """The training rows as tasks need them."""

    @F.arrow_udf("binary")
    def binned(values: pa.Array) -> pa.Array:
        x = matrix_of(values, len(cuts))
        out = np.empty(x.shape, np.uint8)
        for j, ends in enumerate(cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(ends, x[:, j]))
        return pa.array([row.tobytes() for row in out], pa.binary())

    inputs = F.array(*[F.col(c).cast("double") for c in features])
    return train.select(
        binned(inputs).alias("bins"), label.alias("label"), F.lit(base).alias("margin"), F.xxhash64(inputs, label).alias("draw")
    )


@dataclass(frozen=True)
class Block:
    """Some thousand rows: bins by feature and row, labels, margins and draws; of the rows that the tree at hand is grown on,
    their places, gradients and hessians."""

    bins: np.ndarray
    label: np.ndarray
    margin: np.ndarray
    draw: np.ndarray
    inside: np.ndarray | None = None
    slopes: tuple[np.ndarray, np.ndarray] | None = None

    def before(self, number: int, last: Tree | None, objective: str, settings: dict) -> Block:
        """The block before tree `number` is grown, with the values of the `last` one."""
        margin = self.margin if last is None else self.margin + last.value[reached(last, self.bins)]
        inside = np.flatnonzero(drawn(self.draw, settings["seed"], number, settings["rows"]))
        return Block(self.bins, self.label, margin, self.draw, inside, slopes(objective, self.label[inside], margin[inside]))


def reached(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node of a tree over bin numbers in which each row ends, of bins by feature and row."""
    inner = np.flatnonzero(tree.feature >= 0)
    at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    left = np.arange(CELLS) <= tree.threshold[:, None]
    left[:, MISSING] = tree.missing_left
    tested = np.maximum(tree.feature, 0)
    for _ in range(int(inner[-1] + 1).bit_length() if len(inner) else 0):
        below = 2 * at + 2 - left[at, bins[tested[at], rows]]
        at = np.where(tree.feature[at] >= 0, below, at)
    return at


def _blocks(states: DataFrame, parts: int, width: int) -> RDD:
    """The training rows as `parts` partitions of blocks; an Arrow batch makes a block."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width).T
            rest = [batch.column(name).to_numpy() for name in ("label", "margin", "draw")]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (bins, *rest)], names)

    names = ["bins", "label", "margin", "draw"]
    kinds = np.uint8, np.float64, np.float64, np.int64

    def block(row) -> Block:
        bins, *rest = (np.frombuffer(part, kind) for part, kind in zip(row, kinds))
        return Block(bins.reshape(width, -1), *rest)

    return states.repartition(parts).mapInArrow(packed, BLOCK).rdd.map(block)


def drawn(draw: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree is grown on, by a hash of the row, the seed and the tree."""
    if share >= 1:
        return np.ones(len(draw), bool)
    z = draw.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * 2**64))


def slopes(objective: str, label: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of each row, in multiples of 1 / SCALE."""
    if objective == LOGISTIC:
        p = chance(margins)
        first, second = p - label, np.maximum(p * (1 - p), 1 / SCALE)
    else:
        first, second = margins - label, np.ones(len(label))
    return np.rint(first * SCALE), np.rint(second * SCALE)


def _histograms(blocks: RDD, tree: Tree, nodes: Sequence[int], columns: np.ndarray, width: int) -> np.ndarray:
    """Sums of gradients and hessians by node, feature and bin: one job for all `nodes`.

    Of few partitions the driver adds up the sums itself, which spares a shuffle a level; of more, Spark does. Sums of whole numbers
    are the same either way.
    """
    slot_of = np.full(len(tree.feature), -1)
    slot_of[list(nodes)] = range(len(nodes))

    def add(rows: Iterator[Block]) -> Iterator[np.ndarray]:
        sums = np.zeros((2, len(nodes), len(columns), CELLS), np.int64)
        for block in rows:
            slot = slot_of[reached(tree, block.bins)[block.inside]]
            counted = np.flatnonzero(slot >= 0)
            used, first = block.inside[counted], slot[counted] * CELLS
            parts = [part[counted] for part in block.slopes]
            for i, j in enumerate(columns):
                cells = first + block.bins[j][used]
                for part, into in zip(parts, sums):
                    into[:, i] += np.bincount(cells, part, len(nodes) * CELLS).astype(np.int64).reshape(-1, CELLS)
        yield sums

    parts = blocks.mapPartitions(add)
    picked = sum(parts.collect()) if blocks.getNumPartitions() <= FEW else parts.treeReduce(np.add)
    sums = np.zeros((2, len(nodes), width, CELLS), np.int64)
    sums[:, :, columns] = picked
    return sums


@dataclass(frozen=True)
class Split:
    feature: int
    bin: int
    missing_left: bool
    gain: float
    left: tuple[float, float]
    right: tuple[float, float]


def best_split(
    sums: np.ndarray, cuts: list[np.ndarray], columns: np.ndarray, reg_lambda: float, min_child_weight: float
) -> Split | None:
    """The split of a node that gains most; of equal ones that of the first feature, the least bin, and to the right for
    rows without a value. `sums` are gradients and hessians by feature and bin."""
    picked = sums[:, columns] / SCALE
    none, total = picked[:, :, MISSING], picked.sum(axis=2)
    left = np.cumsum(picked[:, :, :MISSING], axis=2)
    left = np.stack([left, left + none[:, :, None]], axis=2)  # by sum, feature, side of the missing ones, and bin
    right = total[:, :, None, None] - left
    (g, h), (g_right, h_right) = left, right
    bins = np.array([len(cuts[j]) for j in columns])[:, None, None] > np.arange(MISSING)
    allowed = bins & (h >= min_child_weight) & (h_right >= min_child_weight) & (h > 0) & (h_right > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g**2 / (h + reg_lambda) + g_right**2 / (h_right + reg_lambda)
    whole = total[0] ** 2 / (total[1] + reg_lambda) if total[1].any() else np.zeros(len(columns))
    gain = np.where(allowed, gain - whole[:, None, None], -np.inf)
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[at] > LEAST_GAIN:
        return None
    ends = (float(g[at]), float(h[at])), (float(g_right[at]), float(h_right[at]))
    return Split(int(columns[at[0]]), int(at[2]), bool(at[1]), float(gain[at]), *ends)


def _grow(
    histograms: Callable[[Tree, list[int]], np.ndarray], cuts: list[np.ndarray], columns: np.ndarray, settings: dict
) -> Tree:
    """One tree, level by level; thresholds are bin numbers."""
    tree = Tree.of_depth(settings["depth"])
    shrink = settings["reg_lambda"]

    def close(node: int, g: float, h: float) -> None:
        tree.value[node] = -settings["rate"] * g / (h + shrink) if h > 0 else 0.0
        tree.cover[node] = h

    open_nodes = {0: histograms(tree, [0])[:, 0]}
    close(0, *(open_nodes[0][:, columns[0]].sum(axis=1) / SCALE))
    for level in range(settings["depth"]):
        splits = {}
        for node, sums in open_nodes.items():
            split = best_split(sums, cuts, columns, shrink, settings["min_child_weight"])
            if split:
                splits[node] = split
                tree.feature[node], tree.threshold[node] = split.feature, split.bin
                tree.missing_left[node], tree.gain[node] = split.missing_left, split.gain
                close(2 * node + 1, *split.left)
                close(2 * node + 2, *split.right)
        if not splits or level + 1 == settings["depth"]:
            break
        lighter = {node: 2 * node + 1 + (s.right[1] < s.left[1]) for node, s in splits.items()}
        counted = histograms(tree, list(lighter.values()))
        parents, open_nodes = open_nodes, {}
        for i, (node, child) in enumerate(lighter.items()):
            open_nodes[child] = counted[:, i]
            open_nodes[4 * node + 3 - child] = parents[node] - counted[:, i]
    return tree


def fit_boosted(train: DataFrame, features: Sequence[str], target: str, objective: str, **settings: float) -> BoostedTrees:
    """Boosted trees for `target`: the chance that it is 1 or true (LOGISTIC), or its value (SQUARED).

    Rows without the target are left out; without any row an error is raised. NULL and NaN are missing values,
    infinities belong to the outermost bins. Rows that are alike in all features and target are drawn together. DEFAULTS names
    the settings.
    """
    if unknown := settings.keys() - DEFAULTS.keys():
        raise TypeError(f"no such settings: {sorted(unknown)}")
    settings = {**DEFAULTS, **settings}
    if not 2 <= settings["bins"] <= MISSING:
        raise ValueError(f"bins must be between 2 and {MISSING}")
    label = F.col(target).cast("int").cast("double") if objective == LOGISTIC else F.col(target).cast("double")
    train = train.filter(label.isNotNull())
    n, mean = train.agg(F.count("*"), F.avg(label)).first()
    if not n:
        raise ValueError("no training rows")
    base = float(np.log(mean / (1 - mean))) if objective == LOGISTIC and 0 < mean < 1 else float(mean)
    if objective == LOGISTIC and mean in (0.0, 1.0):
        base = float(np.log((n + 1) / 1) * (1 if mean else -1))  # all alike: as if one more were different
    cuts = cut_points(train, features, settings["bins"])
    spark, width = train.sparkSession, len(features)
    ensure_checkpoint_dir(spark)
    cores = spark.sparkContext.defaultParallelism
    parts = max(min(cores, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS))
    blocks = _blocks(_states(train, features, label, cuts, base), parts, width)
    draw_columns = np.random.default_rng(settings["seed"])
    some = max(1, int(settings["columns"] * width))
    trees: list[Tree] = []
    kept = stored = None  # the blocks of the tree before, and the folder that they are made from
    for number in range(settings["trees"]):
        columns = np.sort(draw_columns.choice(width, some, replace=False))
        last = trees[-1] if trees else None
        ready = _before(kept or blocks, number, last, objective, settings).persist(StorageLevel.MEMORY_AND_DISK)
        if number % REFRESH == 0:
            ready.checkpoint()
        trees.append(_grow(lambda tree, nodes, at=columns, rows=ready: _histograms(rows, tree, nodes, at, width), cuts, columns, settings))
        if kept:
            kept.unpersist()
        if number % REFRESH == 0:
            if stored:
                delete(spark, stored)
            stored = ready.getCheckpointFile()
        kept = ready
    if kept:
        kept.unpersist()
        delete(spark, stored)
    return BoostedTrees(list(features), objective, base, [_with_values(tree, cuts) for tree in trees])


def _before(blocks: RDD, number: int, last: Tree | None, objective: str, settings: dict) -> RDD:
    return blocks.map(lambda block: block.before(number, last, objective, settings))


def _with_values(tree: Tree, cuts: list[np.ndarray]) -> Tree:
    """The tree with values as thresholds in place of bin numbers."""
    threshold = np.array([cuts[j][int(b)] if j >= 0 else 0.0 for j, b in zip(tree.feature, tree.threshold)])
    return Tree(tree.feature, threshold, tree.missing_left, tree.value, tree.cover, tree.gain)
