"""Same-day and trailing contact counts.

Counts are taken per account and day first. Range frames then run over at most
one row per account and day, however many rows an account has on that day, and
the result is joined back once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.functions.rows import repeat_rows
from ringcast.functions.scalar import day_number

# Days that the trailing counts look back, as the saved models know them.
HISTORY_DAYS = (60, 30, 10, 120)


def daily_counts(
    events: DataFrame,
    key: str = "account_number",
    day: str = "creation_time",
    out: str = "call_count_0",
) -> DataFrame:
    """Events per account and day, as (key, event_date, out)."""
    return events.groupBy(key, F.col(day).alias("event_date")).agg(F.count(day).alias(out))


def event_copies(
    events: DataFrame,
    key: str = "account_number",
    day: str = "creation_time",
    out: str = "call_count_0",
) -> DataFrame:
    """Compat form of ``daily_counts``: one row per event, each with the day's count."""
    return repeat_rows(daily_counts(events, key, day, out), out)


def add_same_day(
    panel: DataFrame,
    events: DataFrame,
    day: str = "creation_time",
    out: str = "call_count_0",
    compat: bool = False,
) -> DataFrame:
    """Left-join the same-day count, 0 where there is none.

    With ``compat`` a panel row is repeated once per event of its day, each copy
    carrying the full count, so trailing sums over it grow with the square.
    """
    counted = event_copies if compat else daily_counts
    joined = panel.join(
        counted(events, day=day, out=out), ["account_number", "event_date"], "left"
    )
    return joined.fillna({out: 0})


def trailing_sums(
    daily: DataFrame,
    column: str,
    windows: Sequence[int],
    prefix: str,
    key: str = "account_number",
    day: str = "event_date",
) -> DataFrame:
    """Append ``<prefix><N>``: sum of ``column`` over the N days before, today excluded.

    NULL where no row lies in the frame. ``daily`` has one row per key and day.
    """
    by_day = Window.partitionBy(key).orderBy(day_number(day))
    sums = [
        F.sum(column).over(by_day.rangeBetween(-n, -1)).alias(f"{prefix}{n}") for n in windows
    ]
    return daily.select("*", *sums)


def join_days(
    panel: DataFrame,
    daily: DataFrame,
    columns: Sequence[str],
    key: str = "account_number",
    day: str = "event_date",
) -> DataFrame:
    """Attach per-day columns to every panel row; an unknown account matches itself."""
    side = daily.select(F.col(key).alias("_key"), F.col(day).alias("_day"), *columns)
    same = panel[key].eqNullSafe(side["_key"]) & panel[day].eqNullSafe(side["_day"])
    return panel.join(side, same).drop("_key", "_day")


def add_trailing(
    panel: DataFrame,
    column: str = "call_count_0",
    windows: Sequence[int] = HISTORY_DAYS,
    prefix: str = "call_count_",
    key: str = "account_number",
    day: str = "event_date",
) -> DataFrame:
    """Trailing sums of a panel column over the account's rows of earlier days."""
    daily = panel.groupBy(key, day).agg(F.sum(column).alias("_sum"))
    sums = trailing_sums(daily, "_sum", windows, prefix, key, day)
    return join_days(panel, sums, [f"{prefix}{n}" for n in windows], key, day)


def add_contact_history(
    panel: DataFrame,
    events: DataFrame,
    windows: Sequence[int] = HISTORY_DAYS,
    prefix: str = "call_count_",
    day: str = "creation_time",
    compat: bool = False,
    days: DataFrame | None = None,
) -> DataFrame:
    """``add_same_day`` and ``add_trailing`` with a single join onto the panel.

    ``days`` gives the panel's (account_number, event_date) rows where they
    reach further back than ``panel`` itself. Without it ``panel`` is read twice:
    pass a staged or cheap frame.
    """
    keys = ["account_number", "event_date"]
    out = f"{prefix}0"
    present = (days if days is not None else panel).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    daily = present.join(daily_counts(events, day=day, out=out), keys, "left").fillna({out: 0})
    copies = F.greatest(F.col(out), F.lit(1)) if compat else F.lit(1)
    daily = daily.withColumn("_sum", F.col("_rows") * copies * F.col(out))
    sums = trailing_sums(daily, "_sum", windows, prefix)
    joined = join_days(panel, sums, [out, *[f"{prefix}{n}" for n in windows]])
    if compat:
        joined = repeat_rows(
            joined.withColumn("_times", F.greatest(F.col(out), F.lit(1))), "_times"
        ).drop("_times")
    return joined
