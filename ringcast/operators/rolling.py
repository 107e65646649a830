"""Rolling statistics over the last rows of each account.

``kurtosis`` is the raw fourth moment E[x^4] and ``var`` is E[x^2] - E[x]^2
(never clamped, so rounding may leave it just below zero): saved models depend
on these definitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ringcast.session import stage

STATS = ("avg", "var", "kurtosis", "sum", "max")
RANGE = "_part"


def rolling_stats(
    df: DataFrame,
    metrics: Sequence[str],
    stats: Sequence[str] = ("avg", "var", "kurtosis"),
    rows: int = 14,
    key: str = "account_number",
    order: Sequence[str] = ("event_date", "mac"),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append ``<metric>_<stat>`` over the current row and ``rows`` before it.

    The rows are cut into ranges of (key, order), each led by the rows before it, so an
    account of any size is worked on in as many tasks as it has ranges. ``df`` may come
    from ``cut_ranges``; otherwise it is cut (and so staged) here. ``keep`` names the
    input columns to carry along (default: all).
    """
    unknown = [s for s in stats if s not in STATS]
    if unknown:
        raise ValueError(f"unknown statistics {unknown}; choose from {STATS}")
    ranged = df if RANGE in df.columns else cut_ranges(df, key, order)
    carried = [c for c in (keep if keep is not None else ranged.columns) if c != RANGE]
    frame = Window.partitionBy(key, RANGE).orderBy(*order).rowsBetween(-rows, 0)
    led = with_halo(ranged, rows, key, order)
    names = [*carried, *[f"{m}_{s}" for m in metrics for s in stats]]
    return _windowed(led, metrics, stats, frame, [*carried, "_own"]).where("_own").select(*names)


def cut_ranges(
    df: DataFrame,
    key: str = "account_number",
    order: Sequence[str] = ("event_date", "mac"),
    parts: int | None = None,
) -> DataFrame:
    """Stage ``df`` cut into ranges of (key, order), with the range in ``_part``."""
    parts = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = df.repartitionByRange(parts, key, *order).withColumn(RANGE, F.spark_partition_id())
    return stage(cut, "ranges")


def with_halo(ranged: DataFrame, rows: int, key: str, order: Sequence[str]) -> DataFrame:
    """Lead each range of each key by the ``rows`` rows before it.

    Adds ``_own`` (false for the copied leading rows). A row frame of up to ``rows``
    preceding rows over (key, _part) then sees exactly what it would see over the whole
    key.
    """
    # one row per (key, range): at most one range more than parts for each key
    in_key = Window.partitionBy(key).orderBy("_part")
    sizes = ranged.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_end", F.sum("_n").over(in_key)).withColumn(
        "_next",
        F.collect_list(F.struct("_part", (F.col("_end") - F.col("_n")).alias("start"))).over(
            in_key.rowsBetween(1, rows)
        ),
    )
    last = Window.partitionBy(key, "_part").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        ranged.withColumn("_back", F.row_number().over(last)).where(F.col("_back") <= rows)
    )
    places = starts.select(F.col(key).alias("_k"), F.col("_part").alias("_p"), "_end", "_next")
    # a tail row leads every later range that starts at most `rows` rows after it
    reached = F.filter(
        "_next", lambda r: r["start"] - F.col("_end") + F.col("_back") <= rows
    )
    halo = (
        tails.join(places, tails[key].eqNullSafe(places["_k"]) & (F.col("_part") == F.col("_p")))
        .withColumn("_to", F.explode(F.transform(reached, lambda r: r["_part"])))
        .withColumn("_part", F.col("_to"))
        .select(*ranged.columns)
        .withColumn("_own", F.lit(False))
    )
    return ranged.withColumn("_own", F.lit(True)).unionByName(halo)


def _windowed(df, metrics, stats, window: WindowSpec, carried) -> DataFrame:
    """All raw moments in one select (one Window node), differences in a second."""
    moments: dict[str, Column] = {}
    final: list[Column] = []
    for m in metrics:
        x = F.col(m).cast("double")
        raw = {"avg": F.avg(x), "sum": F.sum(m), "max": F.max(m), "kurtosis": F.avg(x * x * x * x)}
        for s in stats:
            if s == "var":
                moments[f"_{m}_m1"] = F.avg(x)
                moments[f"_{m}_m2"] = F.avg(x * x)
                mean = F.col(f"_{m}_m1")
                final.append((F.col(f"_{m}_m2") - mean * mean).alias(f"{m}_var"))
            elif s == "avg":
                moments[f"_{m}_m1"] = raw["avg"]
                final.append(F.col(f"_{m}_m1").alias(f"{m}_avg"))
            else:
                moments[f"_{m}_{s}"] = raw[s]
                final.append(F.col(f"_{m}_{s}").alias(f"{m}_{s}"))
    first = df.select(*carried, *[c.over(window).alias(n) for n, c in moments.items()])
    return first.select(*carried, *final)
