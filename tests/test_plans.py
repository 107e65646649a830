import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringcast.functions.scalar import scoring_date
from ringcast.operators import models
from ringcast.operators.quality import check_presence, require_rows
from ringcast.plans import inference, training
from ringcast.plans.features import (
    FEATURES,
    METRICS,
    feature_frame,
    history_slice,
    last_rows,
    point_in_time,
)
from ringcast.plans.training import build_dataset, labelled_frame
from ringcast.sources import read as sources
from ringcast.sources import sinks, specs

DAY = "2024-01-20"
TRAIN, TEST = ("2024-01-06", "2024-01-15"), ("2024-01-16", "2024-01-20")
SMALL = {"rf": {"numTrees": 5, "maxDepth": 3}, "gbt": {"maxIter": 3}}
SMALL["stack"] = dict(SMALL)


def rows(df, digits=9):
    rounded = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(*rounded).collect()))


@pytest.fixture(scope="module")
def whole(feeds):
    return feature_frame(feeds, with_mac=True).cache()


def test_width(feeds):
    assert len(feature_frame(feeds).columns) == 73 == len(FEATURES) + 2
    assert len([*FEATURES, "called"]) == 72


@pytest.mark.parametrize("start, end", [("2024-01-12", "2024-01-14"), ("2024-01-29", "2024-01-30"),
                                        ("2024-01-01", "2024-01-01"), ("2025-01-01", "2025-01-02")])
def test_slice_equals_whole_panel(feeds, whole, start, end):
    some = feature_frame(feeds, start, end, with_mac=True)
    assert rows(some) == rows(whole.where(f"event_date between '{start}' and '{end}'"))


@pytest.mark.parametrize("bounds", [{"start": "2024-01-12"}, {"end": "2024-01-12"}])
def test_one_bound_is_refused(feeds, bounds):
    with pytest.raises(ValueError):
        feature_frame(feeds, **bounds)


def test_history_reads_metrics_by_date_only(feeds):
    """Without a lower bound on the date, scans may read keys alone."""
    history = history_slice(feeds, DAY, DAY)
    plan = history.inside.unionByName(history.before)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert scans
    for scan in scans:
        read = scan[scan.index("ReadSchema: struct<"):]
        if any(m in read for m in METRICS):
            assert "GreaterThanOrEqual(event_date" in scan


def test_sources_are_joined_once_for_a_slice(feeds):
    """Each further read of the slice is of a staged table, not of the joined sources."""
    history = history_slice(feeds, DAY, DAY, staged=True)
    frames = {"history-panel": history.inside.unionByName(history.before), "panel-keys": history.days}
    for name, df in frames.items():
        files = df.inputFiles()
        assert files and all(f"/{name}-" in f for f in files)


def test_reversed_split_has_targets(feeds):
    def positives(train, test):
        frame = labelled_frame(feeds, train, test, window=3)
        return frame.groupBy("target").count().orderBy("target").collect()

    early, late = ("2024-01-08", "2024-01-12"), ("2024-01-13", "2024-01-16")
    assert positives(early, late) == positives(late, early)
    assert len(positives(late, early)) == 2


def test_label_complete_on_request(feeds):
    days = ("2024-01-08", "2024-01-12"), ("2024-01-13", "2024-01-16")
    train_df, test_df = build_dataset(feeds, *days, window=3, with_complete=True)
    assert "label_complete" in train_df.columns
    done = {r.event_date.day: r.label_complete for r in test_df.collect()}
    assert done[13] and not done[14] and not done[16]
    assert "label_complete" not in build_dataset(feeds, *days)[0].columns


def test_point_in_time_equals_first_modem(feeds, whole):
    first = whole.where(f"event_date = '{DAY}'").groupBy("account_number").agg(
        F.min_by(F.struct(*whole.columns), "mac").alias("r")
    ).select("r.*")
    assert rows(point_in_time(feeds, DAY)) == rows(first.select("account_number", "event_date", "mac", *FEATURES))


def test_last_rows_are_cut_before_the_shuffle(feeds):
    plan = last_rows(feeds.accessibility, 14)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_filters_reach_the_scan(feeds):
    plan = feeds.panel().where(f"event_date <= '{DAY}'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 6 and all("LessThanOrEqual(event_date" in line for line in scans)


def test_inference_frame_is_one_row_per_account(feeds):
    frame = inference.inference_frame(feeds, DAY)
    assert frame.columns == ["account_number", "event_date", *FEATURES, "category_name", "called"]
    assert frame.count() == frame.select("account_number").distinct().count()
    assert not any(v is None for r in frame.collect() for v in r)


def test_training_and_inference_jobs(spark, feeds, tmp_path):
    train_df, test_df = training.build_dataset(feeds, TRAIN, TEST, window=3, out=str(tmp_path / "set"))
    balance = dict(train_df.groupBy("target").count().collect())
    assert balance[0] == balance[1]
    saved = training.train_saved(
        spark, str(tmp_path / "set/train"), str(tmp_path / "set/test"),
        split=(*TRAIN, *TEST), null_policy="zero", out=str(tmp_path / "run"),
        run_date=dt.date(2024, 2, 1), params=SMALL,
    )
    assert set(saved) == {"rf", "gbt", "stack"}
    record = spark.read.parquet(str(tmp_path / "run/training_scores/rf/LATEST")).first()
    assert record.train_start_date == TRAIN[0] and 0 <= record.AUC <= 1
    assert spark.read.parquet(str(tmp_path / "run/profile")).count() == 4

    model = sinks.load_model(saved["rf"].path)
    assert models.feature_order(model) == sorted([*FEATURES, "called"])
    out = str(tmp_path / "scored")
    scored = inference.run_inference(spark, feeds, model, out, DAY)
    n = inference.inference_frame(feeds, DAY).count()
    for name in ("features", "scores", "explanations"):
        for place in ("LATEST", f"ARCHIVE/DATE_PART={DAY}"):
            assert spark.read.parquet(f"{out}/{name}/{place}").count() == n
    assert dict(scored.dtypes)["account_number"] == "string"
    stacked = models.apply_model(inference.inference_frame(feeds, DAY), saved["stack"].model)
    assert stacked.count() == n


def test_test_rows_are_capped(feeds):
    _, capped = training.build_dataset(feeds, TRAIN, TEST, window=3, test_rows=5)
    assert capped.count() == 5


def test_missing_day_stops_the_run(spark, feeds, tmp_path):
    with pytest.raises(inference.MissingData, match="svq"):
        inference.run_inference(spark, feeds, None, str(tmp_path), "2024-03-01")
    missing, message = check_presence(feeds.checked(), "2024-03-01")
    assert missing and len(message.splitlines()) == 6


def test_empty_batch(spark):
    with pytest.raises(ValueError, match="no rows"):
        require_rows(spark.range(0))


def test_archive_rewrites_one_day_only(spark, tmp_path):
    def batch(day, n):
        return spark.range(n).withColumn("event_date", F.lit(day).cast("date"))

    base = str(tmp_path)
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 5)):
        assert sinks.write_latest_archive(batch(day, n), base) == day
    archived = spark.read.parquet(f"{base}/ARCHIVE").groupBy("DATE_PART").count()
    assert {str(r[0]): r[1] for r in archived.collect()} == {"2024-01-01": 5, "2024-01-02": 4}
    assert spark.read.parquet(f"{base}/LATEST").count() == 5


def test_scoring_date():
    assert scoring_date("2024-01-05") == dt.date(2024, 1, 5)
    assert scoring_date("Today") == dt.date.today() - dt.timedelta(days=2)


def test_reads_by_name_and_bad_values(spark):
    raw = spark.createDataFrame(
        [("aa", "2024-01-01", 1, "50", 7, "x")],
        "mac string, event_date string, outage_count long, ACCESSIBILITY_PERC_FULL_DAY string, "
        "FULL_ACCOUNT_NUMBER long, ACCESSIBILITY_PERC_PRIME string",
    )
    raw.createOrReplaceTempView("my_access")
    got = sources.read(spark, specs.ACCESSIBILITY, {"accessibility": "my_access"}, "outage_count > 0").first()
    assert got.event_date == dt.date(2024, 1, 1) and got.account_number == 7
    assert got.ACCESSIBILITY_PERC_FULL_DAY == 0.5 and got.ACCESSIBILITY_PERC_PRIME is None
