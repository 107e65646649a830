"""Evaluation of scored rows: precision, recall, ROC AUC and curve points."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.session import stage

SLICES = 64


def precision_recall(df: DataFrame, label: str = "target", pred: str = "pred") -> DataFrame:
    """One row: precision and recall of class 1; 0 where undefined."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    hit = F.count_if(y & p)
    return df.agg(
        F.coalesce(F.try_divide(hit, F.count_if(p)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hit, F.count_if(y)), F.lit(0.0)).alias("recall"),
    )


def running_totals(
    df: DataFrame, by: str, columns: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Append ``cum_<column>``: totals over all rows with ``by`` at least this row's.

    ``by`` must be unique. Values are cut at quantiles into slices; each slice
    is summed in its own task and starts from the total of the slices above,
    so no task sees the whole order.
    """
    df = stage(df, "totals")
    if slices is None:
        slices = max(SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.approxQuantile(by, [i / slices for i in range(1, slices)], 1 / (4 * slices))
    place = F.lit(0)
    if cuts:
        edges = F.array(*map(F.lit, sorted(set(cuts))))
        place = F.size(F.filter(edges, lambda edge: edge <= F.col(by)))
    sliced = df.withColumn("_slice", place)

    above = Window.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice
    starts = sliced.groupBy("_slice").agg(*[F.sum(c).alias(f"_{c}") for c in columns]).select(
        "_slice",
        *[F.coalesce(F.sum(f"_{c}").over(above), F.lit(0)).alias(f"_{c}") for c in columns],
    )
    within = Window.partitionBy("_slice").orderBy(F.col(by).desc())
    return sliced.join(starts, "_slice").select(
        *df.columns,
        *[(F.col(f"_{c}") + F.sum(c).over(within)).alias(f"cum_{c}") for c in columns],
    )


def score_counts(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Positives and negatives at each distinct score, with running totals from the top.

    A NULL or NaN score has no place in the order and raises an error; without rows
    there are no steps.
    """
    value = F.col(score).cast("double")
    unfit = value.isNull() | F.isnan(value)
    checked = F.when(unfit, F.raise_error(F.lit("a score is NULL or NaN"))).otherwise(value)
    counted = df.groupBy(checked.alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_totals(counted, "threshold", ["pos", "neg"])


def roc_auc(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """One row: area under the ROC curve, ties counted half; NULL without both classes."""
    steps = score_counts(df, label, score)
    won = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return steps.agg(F.try_divide(F.sum(won), pairs).alias("roc_auc"))


def _totals(steps: DataFrame) -> dict[str, int]:
    row = steps.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    return {"pos": row["pos"] or 0, "neg": row["neg"] or 0}


def roc_curve(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Points (threshold, fpr, tpr), one per distinct score, led by (0, 0)."""
    steps = score_counts(df, label, score)
    total = _totals(steps)
    points = steps.select(
        "threshold",
        F.try_divide("cum_neg", F.lit(total["neg"])).alias("fpr"),
        F.try_divide("cum_pos", F.lit(total["pos"])).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Points (threshold, precision, recall), one per distinct score, closed by (1, 0)."""
    steps = score_counts(df, label, score)
    total = _totals(steps)
    points = steps.select(
        "threshold",
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide("cum_pos", F.lit(total["pos"])).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def score_record(
    scored: DataFrame,
    train: tuple[str, str],
    test: tuple[str, str],
    run_date: dt.date | str,
    label: str = "target",
) -> DataFrame:
    """One row: AUC, precision, recall, the run date and the four split dates."""
    rates = precision_recall(scored, label).first()
    auc = roc_auc(scored, label).first()["roc_auc"]
    return scored.sparkSession.createDataFrame(
        [(auc, rates["precision"], rates["recall"], str(run_date), *train, *test)],
        "AUC double, precision double, recall double, event_date string, "
        "train_start_date string, train_end_date string, "
        "test_start_date string, test_end_date string",
    )
