import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringcast.operators import explain, metrics, models
from ringcast.sources import sinks


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((str(i), dt.date(2024, 1, 1 + i % 28), b, a, c, int(a + 0.2 * rng.random() > 0.6)))
    return spark.createDataFrame(
        rows, "account_number string, event_date date, beta double, Alpha double, gamma double, target int"
    ).cache()


SMALL = {"rf": {"numTrees": 10, "maxDepth": 4}, "gbt": {"maxIter": 5}}


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_fit_and_score(data, kind):
    model = models.fit(data, kind, **SMALL[kind])
    assert models.feature_order(model) == ["Alpha", "beta", "gamma"]
    scored = models.score(data, model)
    assert scored.columns == [*data.columns, "pred", "score"]
    assert metrics.roc_auc(scored).first().roc_auc > 0.9
    assert scored.where("score < 0 or score > 1 or (score > 0.5) <> (pred = 1)").isEmpty()


def test_stack(data, tmp_path):
    model = models.fit_stack(data, folds=3, params=SMALL)
    scored = models.apply_model(data, model)
    assert scored.columns == [*data.columns, "pred", "score"]
    assert metrics.roc_auc(scored).first().roc_auc > 0.9
    again = sinks.load_model(sinks.save_model(model, str(tmp_path), "stack"), "stack")
    pick = ["account_number", "pred"]
    assert sorted(scored.select(pick).collect()) == sorted(
        models.apply_model(data, again).select(pick).collect()
    )


def test_boosted_trees_of_a_stack_do_not_depend_on_what_runs_beside_them(data):
    pick = ["account_number", "score"]
    one, more = (
        dict(models.score(data, models.fit_stack(data, folds=2, params=SMALL, together=n).bases["gbt"]).select(pick).collect())
        for n in (1, 6)
    )
    assert one == pytest.approx(more, abs=1e-9)


def test_fits_of_a_stack_take_no_more_tasks_than_their_rows_need(data, monkeypatch):
    seen, made = [], models._estimator

    class Watched:
        def __init__(self, *args, **params):
            self.inner = made(*args, **params)

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return self.inner.fit(rows)

    monkeypatch.setattr(models, "_estimator", Watched)
    monkeypatch.setattr(models, "TASK_ROWS", 300)
    models.fit_stack(data.repartition(8), folds=2, params=SMALL)
    assert len(seen) == 6 and set(seen) == {2}  # 600 rows


def test_stack_needs_two_folds(data):
    with pytest.raises(ValueError, match="two folds"):
        models.fit_stack(data, folds=1, params=SMALL)


def test_null_features_score_as_zero(data):
    model = models.fit(data, "rf", **SMALL["rf"])
    blank = data.withColumn("beta", F.lit(None).cast("double"))
    zero = data.withColumn("beta", F.lit(0.0))
    pick = ["account_number", "score"]
    assert sorted(models.score(blank, model).select(pick).collect()) == sorted(
        models.score(zero, model).select(pick).collect()
    )


def test_unknown_kind(data):
    with pytest.raises(ValueError, match="svm"):
        models.fit(data, "svm")


def test_saved_model_scores_alike(data, tmp_path):
    model = models.fit(data, "rf", **SMALL["rf"])
    path = sinks.save_model(model, str(tmp_path), "rf", dt.date(2024, 2, 1))
    assert path.endswith("contact_rf_2024-02-01")
    again = sinks.load_model(path)
    pick = ["account_number", "score"]
    assert sorted(models.score(data, again).select(pick).collect()) == sorted(
        models.score(data, model).select(pick).collect()
    )


def test_importances(spark, data):
    table = explain.importances(spark, models.fit(data, "rf", **SMALL["rf"])).collect()
    assert abs(sum(r.importance for r in table) - 1) < 1e-9
    assert max(table, key=lambda r: r.importance).feature == "Alpha"


def test_global_surrogate(data):
    model = models.fit(data, "rf", **SMALL["rf"])
    table = explain.global_surrogate(models.score(data, model), ["Alpha", "beta", "gamma"], maxIter=5)
    assert max(table.collect(), key=lambda r: r.importance).feature == "Alpha"


def test_local_contributions_match_least_squares(data):
    scored = models.score(data, models.fit(data, "rf", **SMALL["rf"]))
    names = ["Alpha", "beta", "gamma"]
    table = explain.local_contributions(scored, names)
    assert table.columns == [*names, "account_number", "event_date"]
    rows = scored.select("account_number", *names, "score").collect()
    x = np.array([[r[n] for n in names] for r in rows])
    y = np.array([r.score for r in rows])
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.linalg.lstsq(design, y, rcond=None)[0][1:]
    want = {r.account_number: (x[i] - x.mean(axis=0)) * weights for i, r in enumerate(rows)}
    for row in table.collect():
        got = np.array([row[n] for n in names])
        assert np.allclose(got, want[row.account_number], atol=1e-4)


def test_forests_keep_the_node_of_each_row():
    forest = models._estimator("rf", "target", 42)
    assert forest.getCacheNodeIds()
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (100, 20)
