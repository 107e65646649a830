"""Run a job when new files land in a folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "DATE_PART"


def on_new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> None:
    """Give every file not seen before to ``action(rows, batch_id)``, then return.

    A batch may be replayed after a failure, so ``action`` must be repeatable:
    key its output by batch id, or overwrite whole date partitions.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(folder)
        .writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_writer(
    out: str, transform: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Action that writes each transformed batch to its own folder, replacing a replay's."""

    def write(rows: DataFrame, batch_id: int) -> None:
        transform(rows).write.mode("overwrite").parquet(f"{out}/BATCH={batch_id}")

    return write


def retrain_action(rebuild: Callable[[SparkSession], None]) -> Callable[[DataFrame, int], None]:
    """Action that runs a whole rebuild once per batch of new files."""

    def run(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            rebuild(rows.sparkSession)

    return run


def rebuild_days(
    landing: str,
    out: str,
    build: Callable[[DataFrame, Sequence[dt.date]], DataFrame],
    ahead: int = 0,
    behind: int = 0,
    day: str = "event_date",
) -> Callable[[DataFrame, int], None]:
    """Action that keeps a dataset by day up to date, rebuilding only the days a batch reaches.

    Rows land under ``landing`` by batch.  A row of day d changes the output of the days
    from d - ``behind`` (labels that look forward) to d + ``ahead`` (histories that look
    back), of those that have rows.  ``build(landed, days)`` gives the output rows of
    these days, with ``day``, from all rows landed so far; it should bound its scan by
    ``days``.  They replace the day partitions of ``out``.

    A replayed batch lands in its own place and rebuilds the same days from the same
    rows, so every replay, also of an earlier batch, ends in the full build.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{landing}/BATCH={batch_id}")
        batch = spark.read.schema(rows.schema).parquet(f"{landing}/BATCH={batch_id}")
        landed = spark.read.schema(rows.schema).parquet(f"{landing}/BATCH=*")
        touched = batch.where(F.col(day).isNotNull()).select(F.col(day).alias("_touched")).distinct()
        reached = touched.select(
            F.explode(F.sequence(F.date_sub("_touched", behind), F.date_add("_touched", ahead))).alias(day)
        )
        # days of a calendar, not rows
        days = [r[0] for r in landed.select(day).distinct().join(reached, day, "left_semi").collect()]
        if not days:
            return
        made = build(landed, sorted(days))
        made.withColumn(PART, F.col(day)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(PART).parquet(out)

    return run
