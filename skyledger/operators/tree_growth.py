"""Gradient-boosted trees grown from histograms, as models of MLlib.

The trees are those of MLlib's ``GBTClassifier``: the same candidate splits, gains, losses and
weights. MLlib takes every row through the tree and to six sums for each level, row by row, from
a cache of objects that must fit into memory. Here rows are reduced to cells once, the rows of
equal bins in all features, and cells are stored in slices as arrays. A pass is a few array
operations per slice: move the cells one level down, sum weights and residuals by node and bin.
What a pass notes about its cells (node, margin, residual) is stored beside them, so no task
holds more than a slice and any task can be run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import dealt_evenly, freeing_shuffles, materialise, scratch_path, send_code_with_tasks
from skyledger.sources.paths import file_system

send_code_with_tasks(__name__)

# Neighbouring features are summed together while their bins make no more cells than this.
JOINT_BINS = 4096
# Slices of a task at most, where there are more than cores, one after the other; and from how
# many tasks on their sums are added up by tasks before they reach the driver.
TASK_SLICES, TASKS_TO_DRIVER = 16, 64
# Gains below this share of a node's squared mean, and differences of gains below this share of
# the best, are the rounding of sums whose order is not fixed.
ROUNDING = 1e-12


# --- arrays in files ------------------------------------------------------------


def _store(folder: str, *arrays: np.ndarray) -> str:
    """Write arrays to a new file; a task that is run again writes another one."""
    path = f"{folder}/{uuid.uuid4().hex}"
    system, inner = file_system(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    head = json.dumps([[a.dtype.str, a.shape] for a in arrays]).encode()
    with system.open_output_stream(inner, compression=None) as stream:
        stream.write(len(head).to_bytes(8, "little") + head + b" " * (-(8 + len(head)) % 64))
        for array in arrays:
            stream.write(np.ascontiguousarray(array).data)
            stream.write(b" " * (-array.nbytes % 64))
    return path


def _fetch(path: str) -> list[np.ndarray]:
    system, inner = file_system(path)
    with system.open_input_stream(inner, compression=None) as stream:
        data = stream.read()
    size = int.from_bytes(data[:8], "little")
    place, arrays = 8 + size + -(8 + size) % 64, []
    for kind, shape in json.loads(data[8 : 8 + size]):
        array = np.frombuffer(data, dtype=kind, count=int(np.prod(shape)), offset=place).reshape(shape)
        arrays.append(array)
        place += array.nbytes + -array.nbytes % 64
    return arrays


# --- bins -----------------------------------------------------------------------


def quantile_splits(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's thresholds for a feature of more values than bins, from sorted distinct values."""
    stride, target, count, found = weights.sum() / bins, weights.sum() / bins, weights[0], []
    for i in range(1, len(values)):
        before, count = count, count + weights[i]
        if abs(before - target) < abs(count - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(found)


def candidate_splits(rows: DataFrame, bins: int, seed: int) -> list[np.ndarray]:
    """The thresholds of each feature: midway between all its values, or, for a feature of more
    than ``bins`` values, quantiles of as many rows as MLlib draws for them."""
    values = materialise(rows.select(F.posexplode("x").alias("feature", "value")).distinct(), "feature-values")
    sizes = {r.feature: r["count"] for r in values.groupBy("feature").count().collect()}
    wide = sorted(f for f, size in sizes.items() if size > bins)
    few = values.filter(~F.col("feature").isin(wide)) if wide else values
    if not sizes:
        raise ValueError("there are no rows to train with")
    splits = [np.array([])] * len(sizes)
    found = few.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("values")).collect()
    for feature, known in found:
        known = np.array(known, dtype=np.float64)
        splits[feature] = (known[:-1] + known[1:]) / 2
    if wide:
        share = max(bins * bins, 10_000) / rows.count()
        drawn = rows.sample(False, share, seed) if share < 1 else rows
        sample = drawn.select("weight", *[F.col("x")[f].alias(f"v{f}") for f in wide]).toPandas()
        for feature in wide:
            by_value = sample.groupby(f"v{feature}")["weight"].sum()
            splits[feature] = quantile_splits(by_value.index.to_numpy(), by_value.to_numpy(), bins)
    return splits


def binned_cells(rows: DataFrame, splits: list[np.ndarray]) -> DataFrame:
    """The rows of equal bins in all features as one: the weights of either class, and how many."""
    names = [f"b{f}" for f in range(len(splits))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            label, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight"))
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            if not (weight >= 0).all() or not np.isfinite(weight).all() or np.isnan(x).any():
                raise ValueError("weights must be finite and not below 0, features must be numbers")
            bins = [pa.array(np.searchsorted(s, x[:, f], "left").astype(np.int32)) for f, s in enumerate(splits)]
            sides = [pa.array(np.where(label == y, weight, 0.0)) for y in (1.0, 0.0)]
            yield pa.RecordBatch.from_arrays([*bins, *sides], [*names, "late", "punctual"])

    binned = rows.mapInArrow(work, ", ".join(f"{n} int" for n in names) + ", late double, punctual double")
    sums = [F.sum(c).alias(c) for c in ("late", "punctual")]
    return materialise(binned.groupBy(*names).agg(*sums, F.count("*").alias("rows")), "cells")


# --- passes over slices ---------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """How many bins each feature has, and which features are summed together."""

    sizes: tuple[int, ...]

    @property
    def joint(self) -> list[list[int]]:
        groups: list[list[int]] = []
        for feature, size in enumerate(self.sizes):
            if groups and size * np.prod([self.sizes[f] for f in groups[-1]]) <= JOINT_BINS:
                groups[-1].append(feature)
            else:
                groups.append([feature])
        return groups

    def histograms(self, joint: list[np.ndarray], slots: np.ndarray | None, nodes: int, *amounts: np.ndarray) -> np.ndarray:
        """The sums of each amount by node and bin, the bins of all features one after another.
        Cells of slot ``nodes`` belong to none."""
        sums = np.zeros((len(amounts), nodes, sum(self.sizes)))
        begins = np.concatenate([[0], np.cumsum(self.sizes)])
        for group, codes in zip(self.joint, joint):
            sizes = [self.sizes[f] for f in group]
            width = int(np.prod(sizes))
            at = codes if slots is None else slots * width + codes
            for amount, to in zip(amounts, sums):
                found = np.bincount(at, amount, minlength=(nodes + 1) * width)[: nodes * width].reshape(nodes, *sizes)
                for axis, feature in enumerate(group):
                    others = tuple(1 + a for a in range(len(group)) if a != axis)
                    to[:, begins[feature] : begins[feature + 1]] = found.sum(axis=others)
        return sums


@dataclass
class Slice:
    """One slice of the cells: the files of what never changes and of what the last passes noted."""

    cells: str
    rounds: str = ""
    nodes: str = ""


def _down(bins: np.ndarray, nodes: np.ndarray | None, tree: Tree) -> np.ndarray:
    """Each cell's node after one more level; a leaf's cells stay."""
    feature, below, child = tree.steps()
    if nodes is None:
        if feature[0] < 0:
            return np.zeros(len(bins), dtype=np.int64)
        return np.where(bins[:, feature[0]] > below[0], child[1], child[0]).astype(np.int64)
    nodes = nodes.astype(np.int64)
    own = bins.reshape(-1)[np.arange(0, bins.size, bins.shape[1]) + np.maximum(feature, 0)[nodes]]
    return child[2 * nodes + (own > below[nodes])]


def _begin(own: Slice, bins: Bins, folder: str):
    """The residuals of the first tree are the labels, 1 and -1."""
    _, _, late, punctual, _, *joint = _fetch(own.cells)
    residual = late - punctual
    rounds = _store(folder, np.zeros(len(late)), residual, late + punctual)
    return Slice(own.cells, rounds), bins.histograms(joint, None, 1, late + punctual, residual)


def _level(own: Slice, bins: Bins, tree: Tree, slots: np.ndarray, count: int, folder: str):
    """One level down, and the sums of the nodes there that may be split."""
    codes, weight, _, _, _, *joint = _fetch(own.cells)
    _, residual, _ = _fetch(own.rounds)
    nodes = _down(codes, _fetch(own.nodes)[0] if own.nodes else None, tree)
    kept = _store(folder, nodes.astype(np.min_scalar_type(len(tree.feature))))
    return Slice(own.cells, own.rounds, kept), bins.histograms(joint, slots[nodes], count, weight, residual)


def _finish(own: Slice, bins: Bins, tree: Tree, share: float, folder: str):
    """The sums of the leaves, the margins with this tree, and the sums of the next one's root."""
    codes, weight, late, punctual, rows, *joint = _fetch(own.cells)
    margin, residual, square = _fetch(own.rounds)
    nodes = _down(codes, _fetch(own.nodes)[0] if own.nodes else None, tree)
    leaves = np.array([np.bincount(nodes, a, len(tree.feature)) for a in (weight, residual, square, rows)])
    margin = margin + share * np.array(tree.prediction)[nodes]
    # The gradient of the logistic loss as MLlib has it: -4 y / (1 + exp(2 y margin)).
    with np.errstate(over="ignore"):
        up, down = 4 / (1 + np.exp(2 * margin)), -4 / (1 + np.exp(-2 * margin))
    residual, square = late * up + punctual * down, late * up**2 + punctual * down**2
    rounds = _store(folder, margin, residual, square)
    return Slice(own.cells, rounds), leaves, bins.histograms(joint, None, 1, weight, residual)


def _write_slices(cells: DataFrame, bins: Bins, folder: str) -> list[Slice]:
    """Deal the cells over files of equal size: bins by cell, weights, classes, joint bins."""
    names = [f"b{f}" for f in range(len(bins.sizes))]
    kind = np.min_scalar_type(max(bins.sizes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        column = {n: table.column(n).to_numpy() for n in table.column_names}
        joint = []
        for group in bins.joint:
            code = np.zeros(table.num_rows, dtype=np.int64)
            for feature in group:
                code = code * bins.sizes[feature] + column[f"b{feature}"]
            joint.append(code.astype(np.min_scalar_type(JOINT_BINS) if len(group) > 1 else kind))
        codes = np.stack([column[n] for n in names], axis=1).astype(kind)
        late, punctual = column["late"], column["punctual"]
        path = _store(folder, codes, late + punctual, late, punctual, column["rows"].astype(np.float64), *joint)
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return [Slice(r.path) for r in dealt_evenly(cells).mapInArrow(work, "path string").collect()]


# --- trees ----------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order in which they appeared, children after their parents."""

    feature: list[int] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    prediction: list[float] = field(default_factory=list)
    stats: np.ndarray | None = None

    def add(self, weight: float, total: float) -> int:
        self.feature.append(-1)
        self.below.append(0)
        self.left.append(-1)
        self.right.append(-1)
        self.gain.append(-1.0)
        self.prediction.append(float(total / weight))
        return len(self.feature) - 1

    def split(self, node: int, found: tuple) -> list[int]:
        self.gain[node], self.feature[node], self.below[node], left, right = found
        self.left[node], self.right[node] = self.add(*left), self.add(*right)
        return [self.left[node], self.right[node]]

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature and bin of each node's split, and its two children; of a leaf, itself twice."""
        own, feature = np.arange(len(self.feature)), np.array(self.feature)
        children = np.where(feature[:, None] < 0, own[:, None], np.stack([self.left, self.right], axis=1))
        return feature, np.array(self.below), children.reshape(-1)

    def settle(self, leaves: np.ndarray) -> None:
        """Keep the sums of all nodes, those within from their children's."""
        self.stats = leaves.copy()
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0:
                self.stats[:, node] = self.stats[:, self.left[node]] + self.stats[:, self.right[node]]


def best_split(bins: Bins, weight: np.ndarray, total: np.ndarray) -> tuple | None:
    """``gain, feature, bin, (weight, total) of the left and of the right side`` of the best split
    of a node, the first of equal ones; None if no split gains anything."""
    begins = np.concatenate([[0], np.cumsum(bins.sizes)])
    whole_w, whole_t = weight[: bins.sizes[0]].sum(), total[: bins.sizes[0]].sum()
    if not whole_w > 0:
        return None
    candidates = []
    for feature, size in enumerate(bins.sizes):
        own = slice(begins[feature], begins[feature + 1])
        left_w, left_t = np.cumsum(weight[own])[:-1], np.cumsum(total[own])[:-1]
        # Sums from the right, as a difference would leave rounding where nothing is.
        right_w, right_t = (np.cumsum(a[own][::-1])[::-1][1:] for a in (weight, total))
        valid = (left_w > 0) & (right_w > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_w * right_w / (left_w + right_w) ** 2 * (left_t / left_w - right_t / right_w) ** 2
        for at in np.flatnonzero(valid):
            candidates.append((gain[at], feature, int(at), (left_w[at], left_t[at]), (right_w[at], right_t[at])))
    most = max((c[0] for c in candidates), default=0.0)
    if most <= ROUNDING * ROUNDING * (whole_t / whole_w) ** 2:
        return None
    found = next(c for c in candidates if c[0] >= most * (1 - ROUNDING))
    return float(found[0]), *found[1:]


# --- boosting -------------------------------------------------------------------


class Passes:
    """Runs passes over the slices; what each noted is kept for one tree after the next."""

    def __init__(self, spark: SparkSession, slices: list[Slice], bins: Bins, folder: str):
        self.spark, self.slices, self.bins, self.folder, self.tree = spark, slices, bins, folder, 0

    def run(self, work, *options) -> list[np.ndarray]:
        """The sums of what ``work`` returns for the slices; it also notes what comes of them."""
        bins, folder, context = self.bins, f"{self.folder}/tree-{self.tree}", self.spark.sparkContext

        def together(slices: Iterator[Slice]) -> Iterator[tuple[list[Slice], list[np.ndarray]]]:
            done, sums = [], None
            for own in slices:
                after, *found = work(own, bins, *options, folder)
                done.append(after)
                sums = found if sums is None else [a + b for a, b in zip(sums, found)]
            if done:
                yield done, sums

        def both(a, b):
            return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]

        tasks = min(len(self.slices), max(context.defaultParallelism, len(self.slices) // TASK_SLICES))
        found = context.parallelize(self.slices, tasks).mapPartitions(together)
        self.slices, sums = found.treeReduce(both) if tasks > TASKS_TO_DRIVER else reduce(both, found.collect())
        return sums

    def next_tree(self) -> None:
        """What was noted for the tree before the last one is not needed any more."""
        self.tree += 1
        old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/tree-{self.tree - 2}")
        old.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)


def grow_tree(passes: Passes, root: np.ndarray, depth: int) -> Tree:
    """A tree, level by level, from the sums of its root."""
    tree, bins = Tree(), passes.bins
    first = slice(0, bins.sizes[0])
    level, sums = [tree.add(root[0, 0, first].sum(), root[1, 0, first].sum())], root
    for at in range(depth):
        children = []
        for slot, node in enumerate(level):
            if found := best_split(bins, sums[0, slot], sums[1, slot]):
                children += tree.split(node, found)
        level = children
        if not level or at + 1 == depth:
            break
        slots = np.full(len(tree.feature), len(level))
        slots[level] = np.arange(len(level))
        (sums,) = passes.run(_level, tree, slots, len(level))
    return tree


def boost(passes: Passes, trees: int, depth: int, rate: float) -> list[Tree]:
    """The trees, the first for the labels and each further one for the residuals so far."""
    (root,) = passes.run(_begin)
    grown = []
    for number in range(trees):
        passes.next_tree()
        tree = grow_tree(passes, root, depth)
        leaves, root = passes.run(_finish, tree, 1.0 if number == 0 else rate)
        tree.settle(leaves)
        grown.append(tree)
    return grown


# --- models of MLlib ------------------------------------------------------------


NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _node_rows(number: int, tree: Tree, splits: list[np.ndarray]) -> Iterator[tuple]:
    for node, feature in enumerate(tree.feature):
        weight, total, square, rows = (float(v) for v in tree.stats[:, node])
        impurity = max(0.0, (square - total * total / weight) / weight) if weight else 0.0
        split = (feature, [float(splits[feature][tree.below[node]])], -1) if feature >= 0 else (-1, [], -1)
        yield number, (
            node, tree.prediction[node], impurity, [weight, total, square], int(rows), tree.gain[node],
            tree.left[node], tree.right[node], split,
        )


def _described(spark: SparkSession, stage, path: str, name: str, **more) -> dict:
    """How MLlib describes a stored model of a stage's parameters."""
    stage.write().overwrite().save(path)
    return json.loads(spark.read.text(f"{path}/metadata").first()[0]) | {"class": name} | more


def as_mllib_model(spark: SparkSession, classifier: GBTClassifier, trees: list[Tree], splits: list[np.ndarray]) -> GBTClassificationModel:
    """The trees in the files in which MLlib keeps such a model, loaded by it."""
    path, place = scratch_path(spark, "grown-trees"), scratch_path(spark, "parameters")
    options = {p.name: classifier.getOrDefault(p) for p in (classifier.featuresCol, classifier.labelCol, classifier.maxBins, classifier.maxDepth, classifier.seed)}
    if classifier.isSet(classifier.weightCol):
        options["weightCol"] = classifier.getWeightCol()
    model = _described(
        spark, classifier, f"{place}/model", "org.apache.spark.ml.classification.GBTClassificationModel",
        numFeatures=len(splits), numTrees=len(trees),
    )
    tree = _described(spark, DecisionTreeRegressor(**options), f"{place}/tree", "org.apache.spark.ml.regression.DecisionTreeRegressionModel")
    spark.createDataFrame([(json.dumps(model),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    shares = [1.0] + [classifier.getStepSize()] * (len(trees) - 1)
    described = [(i, json.dumps(tree | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), share) for i, share in enumerate(shares)]
    spark.createDataFrame(described, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for i, tree in enumerate(trees) for row in _node_rows(i, tree, splits)]
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


class GrownTrees(Estimator):
    """Fits the trees that a ``GBTClassifier`` of logistic loss describes, for rows of any number."""

    def __init__(self, classifier: GBTClassifier):
        super().__init__()
        self.classifier = classifier

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        spark, given = dataset.sparkSession, self.classifier
        weight = F.col(given.getWeightCol()) if given.isSet(given.weightCol) else F.lit(1.0)
        with freeing_shuffles(spark):
            rows = dataset.select(
                vector_to_array(F.col(given.getFeaturesCol())).alias("x"),
                F.col(given.getLabelCol()).cast("double").alias("label"), weight.cast("double").alias("weight"),
            )
            rows = materialise(rows, "vectors")
            splits = candidate_splits(rows, given.getMaxBins(), given.getSeed())
            bins = Bins(tuple(len(s) + 1 for s in splits))
            folder = scratch_path(spark, "growth")
            slices = _write_slices(binned_cells(rows, splits), bins, f"{folder}/cells")
            trees = boost(Passes(spark, slices, bins, folder), given.getMaxIter(), given.getMaxDepth(), given.getStepSize())
        return as_mllib_model(spark, given, trees, splits)
