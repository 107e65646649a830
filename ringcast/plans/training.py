"""Training datasets and model training."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ringcast.operators.dataset import (
    NULL_POLICIES,
    between_days,
    class_profile,
    take_hashed,
    undersample,
)
from ringcast.operators.labels import attach_label, forward_label
from ringcast.operators.explain import global_surrogate
from ringcast.operators.metrics import score_record
from ringcast.operators.models import apply_model, feature_order, fit, fit_stack
from ringcast.plans.features import FEATURES, Feeds, feature_frame
from ringcast.session import stage
from ringcast.sources.sinks import log_metrics, save_model, write_latest_archive, write_parquet

Days = tuple[str | dt.date, str | dt.date]
DATASET_COLUMNS = (
    "account_number",
    "event_date",
    *FEATURES,
    "category_name",
    "called",
    "window",
    "target",
)


def labelled_frame(feeds: Feeds, train: Days, test: Days, window: int = 10) -> DataFrame:
    """Features with past and forward labels for all days from the first to the last.

    The ranges may come in either order. ``label_complete`` tells the rows whose forward
    window ends within the days.

    Labels after the test end are unknown, so later panel rows cannot matter
    to a target and are not read.
    """
    start, end = min(train[0], test[0]), max(train[1], test[1])
    features = feature_frame(feeds, start, end, with_mac=True)
    known = between_days(feeds.labels, start, end)
    labelled = stage(attach_label(features, known), "labelled")
    return forward_label(labelled, "called", window, horizon_end=str(end))


def training_half(frame: DataFrame, days: Days, columns: Sequence[str]) -> DataFrame:
    """Balanced rows of the training days of a staged labelled frame."""
    return undersample(between_days(frame, *days)).select(*columns)


def testing_half(
    frame: DataFrame, days: Days, columns: Sequence[str], rows: int | None = None
) -> DataFrame:
    """Rows of the test days of a staged labelled frame, at most ``rows`` if given."""
    test_df = between_days(frame, *days)
    return (test_df if rows is None else take_hashed(test_df, rows)).select(*columns)


def build_dataset(
    feeds: Feeds,
    train: Days,
    test: Days,
    window: int = 10,
    test_rows: int | None = None,
    out: str | None = None,
    with_complete: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Balanced training rows and test rows, split by time.

    All test rows are kept unless ``test_rows`` gives a limit. ``with_complete`` adds
    ``label_complete``: with a test range shorter than the window, targets of test rows
    near its end only know of the days up to it.
    """
    columns = [*DATASET_COLUMNS, *(["label_complete"] if with_complete else [])]
    frame = stage(labelled_frame(feeds, train, test, window), "dataset")
    balanced = training_half(frame, train, columns)
    tested = testing_half(frame, test, columns, test_rows)
    if out is not None:
        write_parquet(balanced, f"{out}/train")
        write_parquet(tested, f"{out}/test")
    return balanced, tested


@dataclass(frozen=True)
class Trained:
    kind: str
    model: object
    record: DataFrame
    scored: DataFrame
    path: str | None = None


def train(
    train_df: DataFrame,
    test_df: DataFrame,
    kinds: Sequence[str] = ("rf",),
    split: tuple[str, str, str, str] = ("", "", "", ""),
    null_policy: str = "drop",
    out: str | None = None,
    run_date: dt.date | None = None,
    params: dict[str, dict] | None = None,
) -> dict[str, Trained]:
    """Fit, score and record each kind of model ("rf", "gbt", "stack")."""
    run_date = run_date or dt.date.today()
    params = params or {}
    clean = NULL_POLICIES[null_policy]
    train_df, test_df = stage(clean(train_df), "train"), stage(clean(test_df), "test")
    if out is not None:
        log_metrics(class_profile({"train": train_df, "test": test_df}), f"{out}/profile")
    results = {}
    for kind in kinds:
        model = (
            fit_stack(train_df, params=params)
            if kind == "stack"
            else fit(train_df, kind, **params.get(kind, {}))
        )
        scored = stage(apply_model(test_df, model), "test-scores")
        record = score_record(scored, split[:2], split[2:], run_date)
        path = None
        if out is not None:
            path = save_model(model, f"{out}/models", kind, run_date)
            write_latest_archive(record, f"{out}/training_scores/{kind}", batch_date=run_date)
            order = feature_order(model if kind != "stack" else model.bases["rf"])
            write_parquet(global_surrogate(scored, order), f"{out}/explanations/{kind}")
        results[kind] = Trained(kind, model, record, scored, path)
    return results


def train_saved(
    spark: SparkSession, train_name: str, test_name: str, **options
) -> dict[str, Trained]:
    """Train all three kinds on saved datasets, by table name or folder."""
    from ringcast.sources.read import read_dataset

    return train(
        read_dataset(spark, train_name),
        read_dataset(spark, test_name),
        kinds=("rf", "gbt", "stack"),
        **options,
    )
