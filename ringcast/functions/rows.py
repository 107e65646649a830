"""Row-level helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096


def repeat_rows(df: DataFrame, times: str, spread: bool = False) -> DataFrame:
    """Each row as many times as its ``times`` column says (none for 0 or NULL).

    Repeats in chunks, so that no array of all copies is ever built; ``spread``
    deals the chunks out over all tasks, for few rows with very many copies.
    """
    n = F.col(times).cast("long")
    one = F.lit(1).cast("long")
    chunks = F.when(n > 0, F.sequence(one, F.ceil(n / CHUNK)))
    chunked = df.withColumn("_chunk", F.explode(chunks))
    if spread:
        # a stated number: by size, adaptive execution would merge the small chunks again
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunked = chunked.repartition(tasks, "_chunk")
    left = F.least(F.lit(CHUNK).cast("long"), n - (F.col("_chunk") - 1) * CHUNK)
    return (
        chunked.withColumn("_copy", F.explode(F.sequence(one, left)))
        .drop("_chunk", "_copy")
    )
