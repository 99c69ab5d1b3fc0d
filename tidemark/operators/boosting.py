"""Gradient-boosted trees fitted in one Spark job.

Spark's ``GBTClassifier`` starts a job for every level of every tree.  Here the
rows are binned once by the same rules (quantile splits of a sample, ordered
categories) and dealt to the tasks of one barrier stage, which keep them for the
whole fit.  At each level the tasks add up histograms of counts and residuals
and all take the same best splits: variance gain, log loss, leaf means.  The
result is Spark's own ``GBTClassificationModel``.
"""

from __future__ import annotations

import pickle
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable, shared_dir

#: Rows of a task, at least; a fit on fewer needs one task and no exchange.
ROWS_PER_WORKER = 200_000
#: Rows that are binned, and later counted, together.
ROWS_PER_BLOCK = 16_384
ROWS_PER_CHUNK = 1 << 18
#: Bins of the features that are counted in one pass, at most.
PACKED_BINS = 1024
#: Deeper trees are left to Spark: a task counts all nodes of a level at once.
DEEPEST = 10
#: The nodes of a saved ensemble.
NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
    "rawCount bigint, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)
EPSILON = float(np.finfo(np.float64).eps)


def categories_of(df: DataFrame, column: str) -> dict[int, int]:
    """Number of categories of each feature that the column's attributes call binary or nominal."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: 2 for a in attributes.get("binary", [])}
    for a in attributes.get("nominal", []):
        n = len(a["vals"]) if "vals" in a else a.get("num_vals")
        if n:
            found[a["idx"]] = n
    return found


def continuous_splits(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Spark's thresholds of a continuous feature: all midpoints, or about even strides.

    ``expected`` is the expected size of the sample; what it exceeds the values
    other than zero by counts as zeros.
    """
    some = values[values != 0]
    if not len(some):
        return np.empty(0)
    value, count = np.unique(some, return_counts=True)
    count = count.astype(np.float64)
    if expected - len(some) > EPSILON * len(some) * len(some):
        at = int(np.searchsorted(value, 0.0))
        value, count = np.insert(value, at, 0.0), np.insert(count, at, expected - len(some))
    middle = (value[:-1] + value[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    stride = expected / bins
    seen = np.cumsum(count)
    target, out = stride, []
    for i in range(1, len(value)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def packed(sizes: list[int]) -> list[list[int]]:
    """Features in groups whose bins, combined, stay within :data:`PACKED_BINS`."""
    groups: list[list[int]] = []
    room: list[int] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        g = next((g for g, r in enumerate(room) if r >= sizes[f]), None)
        if g is None:
            groups.append([])
            room.append(max(PACKED_BINS, sizes[f]))
            g = len(groups) - 1
        groups[g].append(f)
        room[g] //= sizes[f]
    return groups


class Exchange:
    """Adds up arrays over the tasks of a barrier stage through files in the shared folder.

    Every task writes its array under the number of the step, waits for those
    of the others and adds all in the order of the tasks, so that all get the
    same sum.  A task that has read a step knows that all had read the one before.
    """

    def __init__(self, folder: str, task: int, tasks: int) -> None:
        from pyarrow import fs

        self.task, self.tasks, self.step = task, tasks, 0
        if tasks > 1:
            self.store, self.folder = fs.FileSystem.from_uri(folder)
            self.store.create_dir(self.folder, recursive=True)

    def name(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def __call__(self, mine: np.ndarray) -> np.ndarray:
        if self.tasks == 1:
            return mine
        at = self.name(self.step, self.task)
        with self.store.open_output_stream(f"{at}.part", compression=None) as out:
            out.write(np.ascontiguousarray(mine).tobytes())
        self.store.move(f"{at}.part", at)
        total, pause = np.zeros_like(mine), 0.0005
        for other in range(self.tasks):
            if other == self.task:
                total += mine
                continue
            where = self.name(self.step, other)
            while not self.store.get_file_info(where).is_file:
                time.sleep(pause)
                pause = min(pause * 1.2, 0.02)
            with self.store.open_input_stream(where, compression=None) as got:
                total += np.frombuffer(got.read(), mine.dtype).reshape(mine.shape)
        if self.step:
            self.store.delete_file(self.name(self.step - 1, self.task))
        self.step += 1
        return total


class Rows:
    """The rows of one task: packed bins in a file without a name, labels, margins and residuals."""

    def __init__(self, batches: Iterator[pa.RecordBatch], sizes: list[int]) -> None:
        self.sizes, self.groups = sizes, packed(sizes)
        self.wide = [int(np.prod([sizes[f] for f in g])) for g in self.groups]
        files = [tempfile.TemporaryFile() for _ in self.groups]
        labels, self.blocks = [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "n", "bins", "label")]
            for key, n, bins, label in zip(*columns, strict=True):
                self.blocks.append((key, n))
                labels.append(np.frombuffer(label, np.int8))
                of = np.frombuffer(bins, np.uint16).reshape(len(sizes), n)
                for file, group in zip(files, self.groups, strict=True):
                    code = np.zeros(n, np.uint32)
                    for f in group:
                        code = code * sizes[f] + of[f]
                    file.write(code.astype(np.uint16).tobytes())
        self.label = np.concatenate(labels) if labels else np.empty(0, np.int8)
        self.n = len(self.label)
        self.codes = []
        for file in files:
            file.flush()
            self.codes.append(np.memmap(file, np.uint16, "r", shape=(self.n,)) if self.n else np.empty(0, np.uint16))
        self.margin = np.zeros(self.n)
        self.target = self.label.astype(np.float64)
        self.at = np.zeros(self.n, np.int16)
        self.drawn: np.ndarray | None = None

    def draw(self, rate: float, seed: int) -> None:
        """Which rows the next tree sees: a pure function of the block and the seed."""
        self.drawn = None if rate >= 1 else np.concatenate(
            [np.empty(0, bool)]
            + [np.random.default_rng([seed % 2**32, key]).random(n, np.float32) < rate for key, n in self.blocks]
        )

    def chunks(self) -> Iterator[slice]:
        for start in range(0, self.n, ROWS_PER_CHUNK):
            yield slice(start, min(self.n, start + ROWS_PER_CHUNK))

    def squares(self, nodes: int) -> np.ndarray:
        """Count, sum and sum of squares of the residuals by node; rows at a finished leaf are left out."""
        out = np.zeros((3, nodes + 1))
        for part in self.chunks():
            at, t = self.at[part], self.target[part]
            if self.drawn is not None:
                at, t = at[self.drawn[part]], t[self.drawn[part]]
            at = at.astype(np.intp)
            for k, w in enumerate((None, t, t * t)):
                out[k] += np.bincount(at, w, nodes + 1)
        return out[:, :nodes]

    def histogram(self, nodes: int) -> np.ndarray:
        """``(2, nodes, bins of all features)``: counts and sums of residuals."""
        totals = [np.zeros((2, (nodes + 1) * w)) for w in self.wide]
        for part in self.chunks():
            at, t = self.at[part].astype(np.intp), self.target[part]
            own = None if self.drawn is None else np.flatnonzero(self.drawn[part])
            if own is not None:
                at, t = at[own], t[own]
            for code, wide, total in zip(self.codes, self.wide, totals, strict=True):
                key = at * wide
                key += code[part] if own is None else code[part][own]
                total[0] += np.bincount(key, minlength=total.shape[1])
                total[1] += np.bincount(key, t, total.shape[1])
        starts = np.concatenate(([0], np.cumsum(self.sizes)))
        out = np.zeros((2, nodes, starts[-1]))
        for group, total in zip(self.groups, totals, strict=True):
            cube = total.reshape(2, nodes + 1, *[self.sizes[f] for f in group])[:, :nodes]
            for k, f in enumerate(group):
                others = tuple(2 + j for j in range(len(group)) if j != k)
                out[:, :, starts[f] : starts[f + 1]] = cube.sum(axis=others)
        return out

    def move(self, group: np.ndarray, right: np.ndarray, to: np.ndarray, add: np.ndarray) -> None:
        """Send rows to the children of their node.

        ``right[node, code]`` says which way a code of ``group[node]`` goes,
        ``to[node, way]`` is the next node and ``add[node, way]`` joins the margin.
        """
        for part in self.chunks():
            at = self.at[part].astype(np.intp)
            code = self.codes[0][part]
            for g in range(1, len(self.codes)):
                code = np.where(group[at] == g, self.codes[g][part], code)
            key = at * 2 + right[at, code]
            self.at[part] = to.ravel()[key]
            self.margin[part] += add.ravel()[key]

    def residuals(self) -> None:
        """The negative gradient of the log loss."""
        for part in self.chunks():
            y = self.label[part]
            with np.errstate(over="ignore"):
                self.target[part] = 4.0 * y / (1.0 + np.exp(2.0 * y * self.margin[part]))
        self.at[:] = 0


def impurity(stats: np.ndarray) -> np.ndarray:
    n = np.maximum(stats[0], 1)
    return (stats[2] - stats[1] * stats[1] / n) / n


def best_splits(hist, stats, sizes, ordered, some, least_rows, least_gain):
    """``(gain, feature, left bins as a mask)`` of each node, gain -inf where none is valid.

    ``ordered[f]`` is a feature whose bins keep their order; those of categories
    are sorted by the mean of the residuals.  ``some[node, f]`` may be used.
    """
    nodes = hist.shape[1]
    gain = np.full(nodes, -np.inf)
    feature, left = np.zeros(nodes, int), np.zeros((nodes, max(sizes)), bool)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    row, (n, s) = np.arange(nodes), stats[:2]
    for f, size in enumerate(sizes):
        if size < 2:
            continue
        count, total = hist[:, :, starts[f] : starts[f + 1]]
        order = np.broadcast_to(np.arange(size), count.shape)
        if not ordered[f]:
            mean = np.where(count > 0, total / np.maximum(count, 1), np.finfo(np.float64).max)
            order = mean.argsort(axis=1, kind="stable")
            count, total = np.take_along_axis(count, order, 1), np.take_along_axis(total, order, 1)
        nl, sl = count.cumsum(axis=1)[:, :-1], total.cumsum(axis=1)[:, :-1]
        nr, sr = n[:, None] - nl, s[:, None] - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            got = (sl * sl / nl + sr * sr / nr - (s * s / n)[:, None]) / n[:, None]
        got[~((nl >= least_rows) & (nr >= least_rows) & (got >= least_gain) & some[:, f][:, None])] = -np.inf
        at = got.argmax(axis=1)
        better = got[row, at] > gain
        gain[better], feature[better] = got[row, at][better], f
        mask = np.zeros((nodes, max(sizes)), bool)
        np.put_along_axis(mask, order, np.arange(size) <= at[:, None], 1)
        left[better] = mask[better]
    return gain, feature, left


def grow(rows: Rows, add_up, p: dict, ordered: list[bool], seed: int, weight: float) -> list[tuple]:
    """One tree: ``(left, right, gain, feature, left bins, stats)`` of each node; margins are moved on."""
    sizes = rows.sizes
    rng = np.random.default_rng([seed % 2**32, 1])
    rows.draw(p["rate"], seed)
    group_of = {f: g for g, group in enumerate(rows.groups) for f in group}
    tree: list[list] = [[-1, -1, -1.0, -1, None, None]]
    level = [0]
    for depth in range(p["depth"] + 1):
        a = len(level)
        flat = [rows.squares(a).ravel()]
        if depth < p["depth"]:
            flat.append(rows.histogram(a).ravel())
        got = add_up(np.concatenate(flat))
        stats, hist = got[: 3 * a].reshape(3, a), got[3 * a :].reshape(2, a, -1) if depth < p["depth"] else None
        gain = np.full(a, -np.inf)
        if hist is not None:
            some = np.ones((a, len(sizes)), bool)
            if p["features"] < len(sizes):
                some = rng.random(some.shape).argsort(axis=1).argsort(axis=1) < p["features"]
            gain, feature, left = best_splits(hist, stats, sizes, ordered, some, p["least_rows"], p["least_gain"])
        split = (gain > 0) & (np.abs(impurity(stats)) >= EPSILON)
        following, wide = [], max(rows.wide)
        group, right = np.zeros(a + 1, int), np.zeros((a + 1, wide), bool)
        to, add = np.full((a + 1, 2), -1), np.zeros((a + 1, 2))
        for i, node in enumerate(level):
            tree[node][5] = stats[:, i].tolist()
            if not split[i]:
                add[i] = weight * stats[1, i] / stats[0, i] if stats[0, i] else 0.0
                continue
            f = int(feature[i])
            g = group[i] = group_of[f]
            members = rows.groups[g]
            after = int(np.prod([sizes[x] for x in members[members.index(f) + 1 :]]))
            bins = np.arange(rows.wide[g]) // after % sizes[f]
            right[i, : rows.wide[g]] = ~left[i][bins]
            tree[node][:5] = [len(tree), len(tree) + 1, float(gain[i]), f, np.flatnonzero(left[i][: sizes[f]]).tolist()]
            to[i] = len(following), len(following) + 1
            following += [len(tree), len(tree) + 1]
            tree += [[-1, -1, -1.0, -1, None, None], [-1, -1, -1.0, -1, None, None]]
        to[to < 0] = len(following)  # finished
        rows.move(group, right, to, add)
        level = following
        if not level:
            break
    return [tuple(x) for x in tree]


def boost(rows: Rows, add_up, p: dict, ordered: list[bool]) -> list[list[tuple]]:
    """All trees: the first has weight 1, the others the step size."""
    trees = []
    for m in range(p["rounds"]):
        trees.append(grow(rows, add_up, p, ordered, p["seed"] + m, 1.0 if m == 0 else p["step"]))
        rows.residuals()
    return trees


def features_per_node(strategy: str, n: int) -> int:
    """Spark's reading of ``featureSubsetStrategy`` for one tree."""
    named = {"auto": n, "all": n, "sqrt": np.ceil(np.sqrt(n)), "onethird": np.ceil(n / 3.0), "log2": max(1, np.ceil(np.log2(n)))}
    if strategy.lower() in named:
        return int(named[strategy.lower()])
    value = float(strategy)
    whole = strategy.isdigit() and value >= 1
    return int(min(value, n) if whole else np.ceil(value * n))


class Binned:
    """Rows of a data set as blocks of bins: ``blocks (key, n, bins, label)``, one row for many."""

    @classmethod
    def of(cls, estimator: GBTClassifier, dataset: DataFrame, write: bool = False) -> Binned | None:
        """``None`` where there are no rows or too many categories, for which Spark has its own errors."""
        get, spark = estimator.getOrDefault, dataset.sparkSession
        importable(spark)
        jvm = spark.sparkContext._jvm
        of = dataset.select(
            F.col(get("labelCol")).cast("double").alias("label"), F.col(get("featuresCol")).alias("features")
        )
        categories = categories_of(of, "features")
        rows = of.count()
        most = min(get("maxBins"), rows)
        if not rows or max(categories.values(), default=0) > most:
            return None

        # the sample that Spark takes, drawn by the same sampler
        fraction = min(1.0, max(most**2, 10_000) / rows)
        jdf, found = of._jdf, of
        if fraction < 1:
            drawn = jdf.rdd().sample(False, fraction, jvm.org.apache.spark.util.random.XORShiftRandom(get("seed")).nextInt())
            found = DataFrame(spark._jsparkSession.createDataFrame(drawn, jdf.schema()), spark)
        values = np.array([x.v for x in found.select(vector_to_array("features").alias("v")).collect()])
        width = values.shape[1] if values.ndim == 2 else len(of.first().features)
        values = values.reshape(-1, width)
        splits = [
            np.empty(0) if f in categories else continuous_splits(values[:, f], fraction * rows, most) for f in range(width)
        ]
        sizes = [categories.get(f, len(splits[f]) + 1) for f in range(width)]
        ordered = [f not in categories for f in range(width)]

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, k = TaskContext.get().partitionId(), 0
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                    block = batch.slice(start, ROWS_PER_BLOCK)
                    label = block.column("label").to_numpy(zero_copy_only=False)
                    x = block.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
                    if not np.isin(label, (0.0, 1.0)).all():
                        raise ValueError("labels must be 0 or 1, and not null")
                    if x.shape[1] != width or not np.isfinite(x).all():
                        raise ValueError("features must be finite and of one size")
                    bins = np.empty((width, len(label)), np.uint16)
                    for f in range(width):
                        if ordered[f]:
                            bins[f] = np.searchsorted(splits[f], x[:, f])
                            continue
                        bins[f] = x[:, f].astype(np.uint16)
                        if (bins[f] != x[:, f]).any() or (bins[f] >= sizes[f]).any():
                            raise ValueError(f"feature {f} holds other categories than its attributes")
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([part << 32 | k], pa.int64()), "n": pa.array([len(label)], pa.int32()),
                        "bins": [bins.tobytes()], "label": [(2 * label - 1).astype(np.int8).tobytes()],
                    })
                    k += 1

        self = cls()
        self.spark, self.rows, self.splits, self.sizes, self.ordered = spark, rows, splits, sizes, ordered
        self.blocks = of.select("label", vector_to_array("features").alias("v")).mapInArrow(
            pack, "key long, n int, bins binary, label binary"
        )
        if write:
            path = shared_dir(spark, "binned")
            self.blocks.write.parquet(path)
            self.blocks = spark.read.schema(self.blocks.schema).parquet(path)
        return self


class BoostedTrees(GBTClassifier):
    """``GBTClassifier`` whose fit is one job; other params than those used here are left to Spark."""

    def _ours(self) -> bool:
        get = self.getOrDefault
        return not (
            any(self.isDefined(x) and get(x) for x in ("validationIndicatorCol", "weightCol"))
            or get("minWeightFractionPerNode") > 0 or get("maxBins") > PACKED_BINS or get("maxDepth") > DEEPEST
        )

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        binned = Binned.of(self, dataset) if self._ours() else None
        return self._boosted(binned) if binned else super()._fit(dataset)

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """Fits on one set of binned rows, unless the params change the bins or the columns."""
        kept = {"maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy", "minInstancesPerNode", "minInfoGain"}
        trials = [self.copy(m) for m in paramMaps]
        binned = None
        if all(t._ours() for t in trials) and all(p.name in kept for m in paramMaps for p in m):
            binned = Binned.of(self, dataset, write=True)
        if binned is None:
            return super().fitMultiple(dataset, paramMaps)
        return iter([(i, t._boosted(binned)) for i, t in enumerate(trials)])

    def _boosted(self, binned: Binned) -> GBTClassificationModel:
        get, spark, sizes, ordered = self.getOrDefault, binned.spark, binned.sizes, binned.ordered
        p = {
            "rounds": get("maxIter"), "depth": get("maxDepth"), "step": get("stepSize"), "rate": get("subsamplingRate"),
            "features": features_per_node(get("featureSubsetStrategy"), len(sizes)), "seed": get("seed"),
            "least_rows": get("minInstancesPerNode"), "least_gain": get("minInfoGain"),
        }
        jsc = spark.sparkContext._jsc.sc()
        slots = jsc.maxNumConcurrentTasks(jsc.resourceProfileManager().defaultResourceProfile())
        tasks = max(1, min(slots, binned.rows // ROWS_PER_WORKER))
        shared = shared_dir(spark, "boosting")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, folder = 0, shared
            if tasks > 1:
                from pyspark import BarrierTaskContext

                context = BarrierTaskContext.get()
                mine = context.partitionId()
                # a stage that is tried again starts in another folder
                folder = f"{shared}/{context.allGather(uuid.uuid4().hex)[0]}"
            trees = boost(Rows(batches, sizes), Exchange(folder, mine, tasks), p, ordered)
            if mine == 0:
                for i, tree in enumerate(trees):
                    yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "tree": [pickle.dumps(tree)]})

        fitted = binned.blocks.repartition(tasks).mapInArrow(run, "i int, tree binary", barrier=tasks > 1)
        trees = [pickle.loads(r.tree) for r in sorted(fitted.collect(), key=lambda r: r.i)]
        return self._copyValues(self._model(spark, trees, binned.splits, sizes, ordered))

    def _model(self, spark, trees, splits, sizes, ordered) -> GBTClassificationModel:
        """Spark's model of the trees.

        Nodes made one by one from here would take a call each, so a model of
        bare leaves is saved, its table of nodes written anew and loaded.
        """
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        kind, double = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, jvm.double
        made, weights = gateway.new_array(kind, len(trees)), gateway.new_array(double, len(trees))
        leaf = jvm.org.apache.spark.ml.tree.LeafNode(
            0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(double, 3), 0)
        )
        for i in range(len(trees)):
            made[i] = kind(jvm.org.apache.spark.ml.util.Identifiable.randomUID("dtr"), leaf, len(sizes))
            weights[i] = float(self.getOrDefault("stepSize")) if i else 1.0
        bare = jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, made, weights, len(sizes), 2)
        path = shared_dir(spark, "model")
        GBTClassificationModel(bare).save(path)

        nodes = []
        for i, tree in enumerate(trees):
            for k, (left, right, gain, f, bins, (n, s, q)) in enumerate(tree):
                split = (-1, [], -1)
                if left >= 0 and ordered[f]:
                    split = (f, [float(splits[f][len(bins) - 1])], -1)
                elif left >= 0:
                    split = (f, [float(b) for b in bins], sizes[f])
                own = max(0.0, (q - s * s / n) / n) if n else 0.0
                nodes.append((i, (k, s / n if n else 0.0, own, [n, s, q], int(n), gain, left, right, split)))
        spark.createDataFrame(nodes, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        return GBTClassificationModel.load(path)


class BoostedSearch(TrainValidationSplit):
    """``TrainValidationSplit`` that keeps both parts on disk and bins the rows once for all trials."""

    def _fit(self, dataset: DataFrame) -> TrainValidationSplitModel:
        estimator, maps, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        drawn = dataset.select("*", F.rand(self.getSeed()).alias(f"{self.uid}_rand"))
        held = drawn[f"{self.uid}_rand"] >= self.getTrainRatio()
        validation = drawn.filter(held).persist(StorageLevel.DISK_ONLY)
        train = drawn.filter(~held).persist(StorageLevel.DISK_ONLY)
        metrics = [0.0] * len(maps)
        models: list | None = [None] * len(maps) if self.getCollectSubModels() else None
        try:
            for i, model in estimator.fitMultiple(train, maps):
                metrics[i] = evaluator.evaluate(model.transform(validation, maps[i]))
                if models is not None:
                    models[i] = model
        finally:
            train.unpersist()
            validation.unpersist()
        best = int(np.argmax(metrics) if evaluator.isLargerBetter() else np.argmin(metrics))
        return self._copyValues(TrainValidationSplitModel(estimator.fit(dataset, maps[best]), metrics, models))
