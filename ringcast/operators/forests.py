"""Forests and boosted trees grown each in a task of its own, over bins of the features.

Spark's own trees gather statistics of all open nodes from every task on each pass, a full
table of bins for nodes of two rows too, and the driver holds every node.  Here the learning
rows are written once as one byte per feature, the place among the feature's cuts, and a
task grows whole trees over them: a level at a time, in arrays, with statistics of the rows
that are still in open nodes.  Trees are written where they are grown, as a table of arrays,
and tasks that score or explain rows read them one after the other, so that neither the
driver nor a task ever holds a forest.

The trees are those of Spark's algorithms with the same parameters: cuts by the quantiles of
as many rows as there, Poisson weights for the rows of a tree of a forest, a draw of features
for each node, Gini or variance gain, leaves of one parent that predict alike merged, and for
boosted trees the logistic loss.  Draws are other draws.  What a task holds grows with rows x
features: tables beyond CELLS, labels other than 0 and 1 and settings that only Spark knows
are fitted by Spark itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.session import shared_dir

CELLS = 150_000_000  # rows x features that a task holds, a byte each
SAMPLE = 10_000  # rows whose quantiles are the cuts, or the square of the bins, as in Spark
HELD = 1 << 20  # cells of statistics worked on at once
ROWS = 1 << 15  # rows worked on at once
SCORED = 1 << 16  # rows that trees are read for at once
SCHEMA = (
    "tree int, weight double, feature array<int>, threshold array<double>, child array<int>, "
    "value array<double>, cover array<double>, gain array<double>"
)


@dataclass(frozen=True)
class Tree:
    """Nodes of a tree, each before those below it; the children are ``child`` and the next.

    A leaf has feature -1.  ``value`` is the share of class 1 or the mean, ``cover`` the weight
    of the learning rows, ``gain`` what the split wins.
    """

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    weight: float = 1.0


# --- growing -----------------------------------------------------------------


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts of a feature: between all its values if they are few, else at even strides."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = counts.sum() / bins
    reached, target, chosen = np.cumsum(counts).tolist(), stride, []
    for i in range(1, len(reached)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            chosen.append(i - 1)
            target += stride
    return middles[chosen]


def merged(feature, child, alike):
    """Leaf flags once leaves of one parent that predict ``alike`` are merged, bottom up."""
    leaf = feature < 0
    for at in np.flatnonzero(~leaf)[::-1].tolist():
        c = child[at]
        if leaf[c] and leaf[c + 1] and alike[c] == alike[c + 1]:
            leaf[at] = True
    return leaf


def _finished(feature, threshold, child, value, cover, gain, alike) -> Tree:
    """The tree without the nodes below merged leaves."""
    leaf = merged(feature, child, alike)
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for at in np.flatnonzero(~leaf).tolist():  # parents come first
        if kept[at]:
            kept[child[at]] = kept[child[at] + 1] = True
    place = np.cumsum(kept) - 1
    inner = ~leaf[kept]
    return Tree(
        np.where(inner, feature[kept], -1).astype(np.int32),
        np.where(inner, threshold[kept], 0.0),
        np.where(inner, place[child[kept]], -1).astype(np.int32),
        value[kept], cover[kept], np.where(inner, gain[kept], 0.0),
    )


def _dealt(node, start, go, n_left):
    """Places of rows, sorted by node, once each node's rows are sorted by side."""
    before = np.cumsum(go) - go
    first = start.take(node)
    rights = before - before.take(first)
    at = np.arange(len(node))
    return np.where(go, first + n_left.take(node) + rights, at - rights)


def grow_classes(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, cuts: Sequence[np.ndarray],
    depth: int, drawn: int, rng: np.random.Generator,
) -> Tree:
    """A tree of two classes; each node draws ``drawn`` features.

    ``weight`` is how often each row was drawn, 0 for rows that are out.
    """
    width, bins = codes.shape[1], max(len(c) for c in cuts) + 1
    flat = codes.ravel()
    rows = np.flatnonzero(weight).astype(np.int64)
    node = np.zeros(len(rows), np.int64)
    w, y = weight[rows].astype(np.float64), label[rows].astype(np.int64)
    zeros, ones = [np.array([w[y == 0].sum()])], [np.array([w[y == 1].sum()])]
    feature, cut, child, gain = [], [], [], []
    made, open_ids = 1, np.zeros(1, np.int64)  # open_ids: places of open nodes within their level
    for level in range(depth + 1):
        size = len(zeros[level])
        f_of, s_of, c_of, g_of = np.full(size, -1), np.zeros(size, np.int64), np.full(size, -1), np.zeros(size)
        for store, values in ((feature, f_of), (cut, s_of), (child, c_of), (gain, g_of)):
            store.append(values)
        n = len(open_ids)
        if n == 0 or level == depth:
            break
        counts = np.bincount(node, minlength=n)
        start = np.cumsum(counts) - counts
        best_f, best_s = np.zeros(n, np.int64), np.zeros(n, np.int64)
        best_g, lefts = np.zeros(n), np.zeros((n, 2))
        step = max(1, HELD // (drawn * bins * 2))
        for a in range(0, n, step):
            b = min(n, a + step)
            some = rng.random((b - a, width)).argpartition(drawn - 1, 1)[:, :drawn]
            some.sort(1)
            held = np.zeros((b - a) * drawn * bins * 2)
            lo, hi = start[a], start[b - 1] + counts[b - 1]
            for p in range(lo, hi, ROWS):
                q = min(hi, p + ROWS)
                at = node[p:q] - a
                key = flat.take(rows[p:q, None] * width + some.take(at, 0)).astype(np.int64)
                key += (at * drawn)[:, None] * bins + np.arange(drawn) * bins
                key *= 2
                key += y[p:q, None]
                held += np.bincount(key.ravel(), np.repeat(w[p:q], drawn), len(held))
            left = held.reshape(b - a, drawn, bins, 2).cumsum(2)
            total = left[:, :1, -1:, :]
            l0, l1, t0, t1 = left[..., 0], left[..., 1], total[..., 0], total[..., 1]
            on_left, whole = l0 + l1, t0 + t1
            on_right = whole - on_left
            # the gain of Gini's impurity, exactly 0 where both sides are alike
            won = np.divide(
                2 * np.square(l1 * t0 - l0 * t1), whole * whole * on_left * on_right,
                out=np.full_like(l0, -1.0), where=(on_left > 0) & (on_right > 0),
            ).reshape(b - a, -1)
            top = won.argmax(1)
            at = np.arange(b - a)
            best_g[a:b] = won[at, top]
            best_f[a:b], best_s[a:b] = some[at, top // bins], top % bins
            lefts[a:b] = left.reshape(b - a, -1, 2)[at, top]
        split = best_g > 0
        ids, own = open_ids[split], np.flatnonzero(split)
        below = 2 * np.arange(len(own))
        f_of[ids], s_of[ids], g_of[ids] = best_f[own], best_s[own], best_g[own]
        c_of[ids] = made + below
        made += 2 * len(own)
        here = np.stack([zeros[level][ids], ones[level][ids]], 1)
        both = np.stack([lefts[own], here - lefts[own]], 1).reshape(-1, 2)
        zeros.append(both[:, 0])
        ones.append(both[:, 1])
        # rows move on; those of leaves are done
        goes = split.take(node)
        go = np.zeros(len(rows), np.int64)
        go[goes] = flat.take(rows[goes] * width + best_f.take(node[goes])) > best_s.take(node[goes])
        n_left = counts - np.bincount(node, go, n).astype(np.int64)
        moved = np.empty(len(rows), np.int64)
        moved[_dealt(node, start, go, n_left)] = np.arange(len(rows))
        open_ids = np.flatnonzero((both[:, 0] > 0) & (both[:, 1] > 0))
        number = np.full(len(both), -1)
        number[open_ids] = np.arange(len(open_ids))
        target = np.full((n, 2), -1)
        target[own] = number.reshape(-1, 2)
        node = target[node, go][moved]
        stay = node >= 0
        moved, node = moved[stay], node[stay]
        rows, w, y = rows[moved], w[moved], y[moved]
    feature, cut, child, gain = (np.concatenate(v) for v in (feature, cut, child, gain))
    zero, one = np.concatenate(zeros), np.concatenate(ones)
    threshold = np.array([cuts[f][s] if f >= 0 else 0.0 for f, s in zip(feature.tolist(), cut.tolist())])
    cover = zero + one
    share = np.divide(one, cover, out=np.zeros_like(one), where=cover > 0)
    return _finished(feature, threshold, child, share, cover, gain, one > zero)


def grow_means(
    codes: np.ndarray, target: np.ndarray, cuts: Sequence[np.ndarray], depth: int
) -> tuple[Tree, np.ndarray]:
    """A tree of means over all features, and its value for each row."""
    n, width = codes.shape
    bins = max(len(c) for c in cuts) + 1
    node, open_nodes = np.zeros(n, np.int64), [0]
    feature, cut, child, gain = [-1], [0], [-1], [0.0]
    sums, counts = [float(target.sum())], [float(n)]
    base = np.arange(width) * bins
    place = np.zeros(n, np.int64)  # the node of each row in the whole tree
    for _ in range(depth):
        if not open_nodes:
            break
        held = np.zeros((2, len(open_nodes) * width * bins))
        for p in range(0, n, ROWS):
            q = min(n, p + ROWS)
            inside = np.flatnonzero(node[p:q] >= 0) + p
            key = codes[inside].astype(np.int64)
            key += base + (node[inside] * (width * bins))[:, None]
            key = key.ravel()
            held[0] += np.bincount(key, minlength=held.shape[1])
            held[1] += np.bincount(key, np.repeat(target[inside], width), held.shape[1])
        left = held.reshape(2, len(open_nodes), width, bins).cumsum(3)
        following, turned = [], np.full((len(open_nodes), 2), -1)
        best = np.full((2, len(open_nodes)), -1)
        for i, at in enumerate(open_nodes):
            ln, ls = left[0, i], left[1, i]
            rn, rs = counts[at] - ln, sums[at] - ls
            sound = (ln > 0) & (rn > 0)
            parts = np.where(sound, ls * ls / np.maximum(ln, 1) + rs * rs / np.maximum(rn, 1), -np.inf)
            won = (parts - sums[at] * sums[at] / counts[at]) / counts[at]
            f, s = divmod(int(won.argmax()), bins)
            if not won[f, s] > 1e-15:
                continue
            feature[at], cut[at], child[at], gain[at] = f, s, len(feature), float(won[f, s])
            best[:, i] = f, s
            for side, (c, t) in enumerate(((ln[f, s], ls[f, s]), (rn[f, s], rs[f, s]))):
                turned[i, side] = len(following)
                following.append(len(feature))
                for store, value in ((feature, -1), (cut, 0), (child, -1), (gain, 0.0)):
                    store.append(value)
                counts.append(float(c))
                sums.append(float(t))
        inside = np.flatnonzero(node >= 0)
        was = node[inside]
        split = best[0].take(was) >= 0
        node[inside[~split]] = -1
        inside, was = inside[split], was[split]
        go = (codes[inside, best[0].take(was)] > best[1].take(was)).astype(np.int64)
        node[inside] = turned[was, go]
        open_nodes = following
        place[inside] = np.array(following, np.int64).take(node[inside]) if following else 0
    threshold = np.array([cuts[f][s] if f >= 0 else 0.0 for f, s in zip(feature, cut)])
    cover = np.array(counts)
    value = np.array(sums) / cover
    tree = _finished(np.array(feature), threshold, np.array(child), value, cover, np.array(gain), value)
    return tree, value.take(place)


def boost(codes: np.ndarray, label: np.ndarray, cuts: Sequence[np.ndarray], turns: int, depth: int, pace: float) -> Iterator[Tree]:
    """Boosted trees of the logistic loss; the sum of their weighted values is the margin."""
    sign = 2.0 * label - 1
    margin, target = np.zeros(len(label)), sign
    for turn in range(turns):
        weight = 1.0 if turn == 0 else pace
        tree, value = grow_means(codes, target, cuts, depth)
        yield Tree(**{**tree.__dict__, "weight": weight})
        margin = margin + weight * value
        target = 4 * sign / (1 + np.exp(2 * sign * margin))


# --- tables of rows and trees --------------------------------------------------


def files_of(path: str) -> tuple[fs.FileSystem, list[str]]:
    system, base = fs.FileSystem.from_uri(path)
    found = system.get_file_info(fs.FileSelector(base))
    return system, sorted(f.path for f in found if f.path.endswith(".parquet"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ringcast/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def write_codes(vectors: DataFrame, cuts: Sequence[np.ndarray], path: str) -> None:
    """Rows (label, values) as blocks of one byte per feature."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1), len(cuts))
            codes = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1)
            label = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.astype(np.uint8).tobytes()], pa.binary()) for v in (label, codes)],
                ["label", "codes"],
            )

    vectors.mapInArrow(run, "label binary, codes binary").write.parquet(path)


def read_codes(path: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of all rows, in the order of the files."""
    system, files = files_of(path)
    labels, codes = [], []
    for name in files:
        table = pq.read_table(name, filesystem=system)
        labels += [np.frombuffer(v.as_buffer(), np.uint8) for v in table.column("label")]
        codes += [np.frombuffer(v.as_buffer(), np.uint8).reshape(-1, width) for v in table.column("codes")]
    return np.concatenate(codes), np.concatenate(labels)


def _batch(number: int, tree: Tree) -> pa.RecordBatch:
    lists = [
        pa.array([a.tolist()], pa.list_(kind))
        for a, kind in (
            (tree.feature, pa.int32()), (tree.threshold, pa.float64()), (tree.child, pa.int32()),
            (tree.value, pa.float64()), (tree.cover, pa.float64()), (tree.gain, pa.float64()),
        )
    ]
    names = ["tree", "weight", "feature", "threshold", "child", "value", "cover", "gain"]
    first = [pa.array([number], pa.int32()), pa.array([tree.weight], pa.float64())]
    return pa.RecordBatch.from_arrays([*first, *lists], names)


def trees_in(table) -> Iterator[Tree]:
    for i in range(len(table)):
        arrays = {
            name: table.column(name)[i].values.to_numpy(zero_copy_only=False)
            for name in ("feature", "threshold", "child", "value", "cover", "gain")
        }
        yield Tree(**arrays, weight=table.column("weight")[i].as_py())


def read_trees(path: str) -> Iterator[Tree]:
    """The trees of a table, a file at a time, in their order: sums are the same each time."""
    system, files = files_of(path)
    for name in files:
        yield from trees_in(pq.read_table(name, filesystem=system))


def copy_trees(spark: SparkSession, path: str, to: str) -> None:
    table = spark.read.schema(SCHEMA).parquet(path)
    table.repartitionByRange("tree").sortWithinPartitions("tree").write.parquet(to)


def values_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The value of the leaf of each row."""
    out, width, flat = np.empty(len(x)), x.shape[1], x.ravel()
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    while len(rows):
        f = tree.feature.take(node)
        inner = f >= 0
        if not inner.all():
            out[rows[~inner]] = tree.value.take(node[~inner])
            rows, node, f = rows[inner], node[inner], f[inner]
        go = ~(flat.take(rows * width + f) <= tree.threshold.take(node))
        node = tree.child.take(node) + go
    return out


# --- models --------------------------------------------------------------------


class _Writer(MLWriter):
    def __init__(self, model: TreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        facts = {"kind": self.model.kind, "width": self.model.width}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=facts)
        copy_trees(self.sparkSession, self.model.path, f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> TreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        # a copy of its own, which a later model saved there does not touch
        own = fresh_path(self.sparkSession, "trees")
        copy_trees(self.sparkSession, f"{path}/trees", own)
        model = TreesModel(own, metadata["kind"], metadata["width"])
        model._resetUid(metadata["uid"])
        return model


class TreesModel(Model, MLWritable, MLReadable):
    """Trees in a table: ``kind`` is "forest" (mean of shares) or "boosted" (margin)."""

    def __init__(self, path: str, kind: str, width: int):
        super().__init__()
        self.path, self.kind, self.width = path, kind, width

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def trees(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self.path)

    def summed(self, values):
        """Column of the weighted sum of the trees' values, from an array of features."""
        path, width = self.path, self.width

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            held, n = [], 0

            def done():
                x = np.concatenate(held)
                total = np.zeros(len(x))
                for tree in read_trees(path):
                    total += tree.weight * values_of(tree, x)
                at = 0
                for part in held:
                    yield pa.array(total[at : at + len(part)])
                    at += len(part)

            for batch in batches:
                held.append(_matrix(batch, width))
                n += len(held[-1])
                if n >= SCORED:
                    yield from done()
                    held, n = [], 0
            if held:
                yield from done()

        return F.arrow_udf(run, "double")(values)

    def with_score(self, df: DataFrame, values, name: str = "score") -> DataFrame:
        """``df`` with the probability of class 1."""
        total = F.col("_total")
        share = total if self.kind == "forest" else 1 / (1 + F.exp(-2 * total))
        return df.withColumn("_total", self.summed(values)).withColumn(name, share).drop("_total")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = self.with_score(dataset, vector_to_array("features"), "_share")
        share = F.col("_share")
        return scored.select(
            *dataset.columns,
            array_to_vector(F.array(1 - share, share)).alias("probability"),
            (share > 0.5).cast("double").alias("prediction"),
        )

    @property
    def featureImportances(self) -> DenseVector:
        """Gains times cover by feature, of a forest as shares of each tree."""
        spark, width, forest = SparkSession.active(), self.width, self.kind == "forest"

        def run(batches):
            for batch in batches:
                for number, tree in zip(batch.column(0).to_pylist(), trees_in(batch)):
                    inner = tree.feature >= 0
                    won = np.bincount(tree.feature[inner], (tree.gain * tree.cover)[inner], width)
                    if forest and won.sum() > 0:
                        won = won / won.sum()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([won.tolist()], pa.list_(pa.float64()))],
                        ["tree", "won"],
                    )

        found = self.trees(spark).mapInArrow(run, "tree int, won array<double>").orderBy("tree").collect()
        won = np.sum([r.won for r in found], axis=0)
        return Vectors.dense(won / won.sum() if won.sum() > 0 else won)


# --- estimators ----------------------------------------------------------------


def _grown(estimator, dataset: DataFrame, kind: str) -> TreesModel | None:
    """The model of a forest or of boosted trees; None where Spark has to fit it."""
    get = estimator.getOrDefault
    name, bins, seed = get("labelCol"), get("maxBins"), get("seed")
    plain = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "subsamplingRate": 1.0, "minWeightFractionPerNode": 0.0}
    known = all(get(p) == v for p, v in plain.items()) and bins <= 256 and not estimator.isDefined("weightCol")
    known &= (get("impurity"), get("bootstrap")) == ("gini", True) if kind == "forest" else (
        get("featureSubsetStrategy") == "all" and not estimator.isDefined("validationIndicatorCol")
    )
    if not known:
        return None
    label = F.col(name).cast("double")
    facts = dataset.agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("low"), F.max(label).alias("high"),
        F.count_if(F.coalesce(label.isin(0.0, 1.0), F.lit(False))).alias("known"),
    ).first()
    if not facts.n or facts.known < facts.n or facts.high < 1:
        return None
    values = dataset.select(label.cast("int").alias("label"), vector_to_array(get("featuresCol")).alias("x"))
    sampled = max(bins * bins, SAMPLE)
    share = min(1.0, sampled / facts.n)
    picked = (values if share == 1 else values.sample(False, share, seed)).select("x").toArrow().column(0)
    width = len(picked[0]) if len(picked) else 0
    if not width or facts.n * width > CELLS:
        return None
    picked = _matrix(picked.combine_chunks(), width)
    cuts = [cuts_of(picked[:, j], min(bins, facts.n)) for j in range(width)]
    spark = dataset.sparkSession
    codes_path, path = fresh_path(spark, "codes"), fresh_path(spark, "trees")
    write_codes(values, cuts, codes_path)
    depth = get("maxDepth")
    if kind == "forest":
        count, drawn = get("numTrees"), _drawn(get("featureSubsetStrategy"), width, get("numTrees"))
        tasks = min(count, 4 * spark.sparkContext.defaultParallelism)

        def run(batches):
            codes = label = None
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    if codes is None:
                        codes, label = read_codes(codes_path, width)
                    rng = np.random.default_rng([seed % (1 << 63), number])
                    weight = rng.poisson(1.0, len(label))
                    while not weight.any():  # very few rows
                        weight = rng.poisson(1.0, len(label))
                    tree = grow_classes(codes, label, weight, cuts, depth, drawn, rng)
                    yield _batch(number, Tree(**{**tree.__dict__, "weight": 1 / count}))
    else:
        tasks, turns, pace = 1, get("maxIter"), get("stepSize")

        def run(batches):
            for batch in batches:
                for _ in range(len(batch)):
                    codes, label = read_codes(codes_path, width)
                    for number, tree in enumerate(boost(codes, label, cuts, turns, depth, pace)):
                        yield _batch(number, tree)

    jobs = spark.range(0, count if kind == "forest" else 1, 1, tasks)
    jobs.mapInArrow(run, SCHEMA).write.parquet(path)
    return TreesModel(path, kind, width)


def _drawn(strategy: str, width: int, trees: int) -> int:
    """Features that a node draws, by Spark's names."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    if strategy == "all":
        return width
    share = {"sqrt": np.sqrt(width), "log2": np.log2(width), "onethird": width / 3}.get(strategy)
    if share is None:
        number = float(strategy)
        share = number if strategy.isdigit() else number * width
    return int(min(width, max(1, np.ceil(share))))


class Forest(RandomForestClassifier):
    """A random forest whose trees are grown one to a task."""

    def _fit(self, dataset: DataFrame):
        return _grown(self, dataset, "forest") or super()._fit(dataset)


class Boosted(GBTClassifier):
    """Boosted trees grown in one task: for fits that run side by side."""

    def _fit(self, dataset: DataFrame):
        return _grown(self, dataset, "boosted") or super()._fit(dataset)
