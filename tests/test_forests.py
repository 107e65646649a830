import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ringcast.operators import forests, models
from ringcast.operators.tree_paths import group_paths, paths_in, shapley, tree_contributions
from ringcast.operators.tree_paths import Node
from ringcast.sources import sinks


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        x = [round(rng.random(), 3), float(rng.randrange(4)), 0.0, rng.gauss(0, 1)]
        rows.append((i, Vectors.dense(x), int(x[0] + 0.3 * x[1] + 0.3 * rng.gauss(0, 1) > 0.9)))
    return spark.createDataFrame(rows, ["id", "features", "target"]).cache()


def arrays(data):
    rows = data.orderBy("id").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.target for r in rows], np.uint8)


def codes_of(x, cuts):
    return np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1).astype(np.uint8)


def shares(model, data):
    found = model.transform(data).select("id", vector_to_array("probability")[1]).collect()
    return np.array([v for _, v in sorted(found)])


@pytest.mark.parametrize("depth", [3, 8, 20])
def test_a_tree_over_all_features_is_that_of_spark(data, depth):
    x, y = arrays(data)
    cuts = [forests.cuts_of(x[:, j], 32) for j in range(4)]
    tree = forests.grow_classes(
        codes_of(x, cuts), y, np.ones(len(y), int), cuts, depth, 4, np.random.default_rng(1)
    )
    own = DecisionTreeClassifier(labelCol="target", maxDepth=depth).fit(data)
    np.testing.assert_allclose(forests.values_of(tree, x), shares(own, data), atol=1e-12)
    # of splits that win alike either may be taken
    assert abs(len(tree.feature) - own.numNodes) <= 0.02 * own.numNodes


def test_boosted_trees_are_those_of_spark(data):
    settings = {"labelCol": "target", "maxIter": 12, "maxDepth": 3, "stepSize": 0.1, "seed": 5}
    made, own = forests.Boosted(**settings).fit(data), GBTClassifier(**settings).fit(data)
    assert isinstance(made, forests.TreesModel)
    np.testing.assert_allclose(shares(made, data), shares(own, data), atol=1e-9)


def test_cuts_are_between_few_values_or_at_even_strides():
    assert forests.cuts_of(np.array([1.0, 3.0, 3.0, 7.0]), 32).tolist() == [2.0, 5.0]
    assert forests.cuts_of(np.zeros(9), 32).tolist() == []
    cuts = forests.cuts_of(np.arange(10_000.0), 32)
    assert 30 <= len(cuts) <= 31 and np.ptp(np.diff(cuts)) < 5


def test_rows_drawn_twice_count_twice_and_others_not():
    codes = np.array([[0], [1], [1], [0]], np.uint8)
    tree = forests.grow_classes(
        codes, np.array([0, 1, 0, 1], np.uint8), np.array([2, 3, 1, 0]), [np.array([0.5])], 5, 1,
        np.random.default_rng(1),
    )
    assert tree.cover.tolist() == [6, 2, 4] and tree.value.tolist() == [0.5, 0, 0.75]
    assert tree.feature.tolist() == [0, -1, -1] and tree.child.tolist() == [1, -1, -1]


def test_work_in_small_parts_gives_the_same_tree(data, monkeypatch):
    x, y = arrays(data)
    cuts = [forests.cuts_of(x[:, j], 32) for j in range(4)]
    codes, weight = codes_of(x, cuts), np.random.default_rng(2).poisson(1.0, len(y))

    def made():
        return forests.grow_classes(codes, y, weight, cuts, 20, 4, np.random.default_rng(1))

    whole = made()
    monkeypatch.setattr(forests, "HELD", 1)
    monkeypatch.setattr(forests, "ROWS", 7)
    parts = made()
    assert all(np.array_equal(getattr(whole, k), getattr(parts, k)) for k in ("feature", "threshold", "child", "value"))


def test_a_forest_is_kept_as_a_table_and_grown_one_tree_to_a_task(data):
    model = models._estimator("rf", "target", 42, numTrees=9, maxDepth=20).fit(data)
    assert isinstance(model, forests.TreesModel)
    assert sorted(r.tree for r in model.trees(data.sparkSession).collect()) == list(range(9))
    again = models._estimator("rf", "target", 42, numTrees=9, maxDepth=20).fit(data)
    assert np.array_equal(shares(model, data), shares(again, data))
    own = RandomForestClassifier(labelCol="target", numTrees=9, maxDepth=20, seed=42).fit(data)
    y = arrays(data)[1]
    right = [((shares(m, data) > 0.5) == y).mean() for m in (model, own)]
    assert right[0] > right[1] - 0.05
    weights = model.featureImportances.toArray()
    assert abs(weights.sum() - 1) < 1e-12 and weights[2] == 0


def test_what_the_tasks_cannot_hold_or_do_not_know_spark_fits(data, monkeypatch):
    small = {"numTrees": 2, "maxDepth": 2}
    three = data.withColumn("target", F.col("id") % 3)
    assert not isinstance(models._estimator("rf", "target", 1, **small).fit(three), forests.TreesModel)
    bare = data.withColumn("target", F.lit(0))
    assert not isinstance(models._estimator("rf", "target", 1, **small).fit(bare), forests.TreesModel)
    entropy = models._estimator("rf", "target", 1, impurity="entropy", **small)
    assert not isinstance(entropy.fit(data), forests.TreesModel)
    monkeypatch.setattr(forests, "CELLS", 3000)
    assert not isinstance(models._estimator("rf", "target", 1, **small).fit(data), forests.TreesModel)


def test_rows_of_one_class_and_missing_rows(data):
    ones = data.withColumn("target", F.lit(1))
    model = models._estimator("rf", "target", 1, numTrees=3).fit(ones)
    assert set(shares(model, data)) == {1.0}
    assert model.featureImportances.toArray().tolist() == [0, 0, 0, 0]
    assert model.transform(data.where("id < 0")).count() == 0


def test_saved_over_its_own_folder_it_stays_whole(spark, data, tmp_path):
    frame = data.select("id", "target", *[vector_to_array("features")[i].alias(f"x{i}") for i in range(4)])
    frame = frame.withColumnsRenamed({"id": "account_number"})
    model = models.fit(frame, "rf", numTrees=5, maxDepth=6)
    path = sinks.save_model(model, str(tmp_path), "rf")
    loaded = sinks.load_model(path)
    assert sinks.save_model(loaded, str(tmp_path), "rf") == path
    pick = ["account_number", "score"]
    wanted = sorted(models.score(frame, model).select(pick).collect())
    assert sorted(models.score(frame, loaded).select(pick).collect()) == wanted
    assert sorted(models.score(frame, sinks.load_model(path)).select(pick).collect()) == wanted


def test_paths_of_a_tree_in_arrays_are_those_of_its_nodes(data):
    x, y = arrays(data)
    cuts = [forests.cuts_of(x[:, j], 32) for j in range(4)]
    tree = forests.grow_classes(
        codes_of(x, cuts), y, np.ones(len(y), int), cuts, 9, 2, np.random.default_rng(1)
    )
    nodes = {
        i: Node(tree.cover[i], tree.value[i], int(f), tree.threshold[i], int(c), int(c) + 1) if f >= 0
        else Node(tree.cover[i], tree.value[i])
        for i, (f, c) in enumerate(zip(tree.feature, tree.child))
    }
    base, groups = group_paths([nodes], [1.0])
    own_base, paths = paths_in(tree)
    assert abs(base - own_base) < 1e-12
    np.testing.assert_allclose(shapley(x, [paths]), shapley(x, groups), atol=1e-12)
    np.testing.assert_allclose(shapley(x, [paths]).sum(1) + base, forests.values_of(tree, x), atol=1e-10)


def test_boosted_trees_of_a_table_are_explained(spark, data):
    frame = data.select("id", "target", *[vector_to_array("features")[i].alias(f"x{i}") for i in range(4)])
    frame = frame.withColumnsRenamed({"id": "account_number"})
    stack = models.fit_stack(frame, keys=["account_number"], folds=2, params={"rf": {"numTrees": 3}, "gbt": {"maxIter": 4}})
    assert all(isinstance(m.stages[-1], forests.TreesModel) for m in stack.bases.values())
    model = stack.bases["gbt"]
    table, base = tree_contributions(frame, model, ["account_number"])
    sums = {r.account_number: base + sum(r[f"x{i}"] for i in range(4)) for r in table.collect()}
    for r in models.score(frame, model).collect():
        assert abs(1 / (1 + np.exp(-2 * sums[r.account_number])) - r.score) < 1e-9
