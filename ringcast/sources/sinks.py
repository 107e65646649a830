"""Parquet, table, archive, metric and model outputs."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.operators.models import StackedModel


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int | None = None
) -> None:
    """``rows_per_file`` deals the rows to as few files as hold them, one task for each.

    An output of up to that many rows is a single file, and a larger one never goes
    through a single task. Counts ``df`` first: pass a staged or cheap frame.
    """
    if rows_per_file is not None:
        df = df.repartition(max(1, -(-df.count() // rows_per_file)))
    df.write.mode(mode).parquet(path)


def write_latest_archive(
    df: DataFrame,
    base: str,
    day: str = "event_date",
    batch_date: str | dt.date | None = None,
) -> str:
    """Write one batch to ``ARCHIVE/DATE_PART=<day>`` and as ``LATEST``; return the day.

    The batch day is the latest ``day`` unless given. Only that archive
    partition is replaced, so a rerun is safe. ``LATEST`` is copied from the
    written partition, so the batch is computed once.
    """
    spark = df.sparkSession
    if batch_date is None:
        batch_date = df.agg(F.max(day)).first()[0]
        if batch_date is None:
            raise ValueError(f"no {day} in the batch")
    folder = f"{base}/ARCHIVE/DATE_PART={batch_date}"
    df.write.mode("overwrite").parquet(folder)
    spark.read.schema(df.schema).parquet(folder).write.mode("overwrite").parquet(f"{base}/LATEST")
    return str(batch_date)


def save_table(
    df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None
) -> None:
    """Create a catalog table from ``df``; with ``path`` its files live there."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def log_metrics(df: DataFrame, path: str) -> None:
    """Append metric or profile rows to a parquet log."""
    df.write.mode("append").parquet(path)


def model_path(base: str, name: str, day: dt.date | None = None, prefix: str = "contact") -> str:
    return f"{base}/{prefix}_{name}_{day or dt.date.today()}"


def save_model(
    model, base: str, name: str, day: dt.date | None = None, prefix: str = "contact"
) -> str:
    """Save under a dated name; return the path."""
    path = model_path(base, name, day, prefix)
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)
    return path


def load_model(path: str, kind: str = "rf") -> PipelineModel | StackedModel:
    return StackedModel.load(path) if kind == "stack" else PipelineModel.load(path)
