"""The feature frame: rolling modem statistics plus contact history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringcast.operators.counts import HISTORY_DAYS, add_contact_history
from ringcast.operators.dataset import between_days, one_per_account
from ringcast.operators.labels import TECHNICAL_CATEGORIES, call_labels
from ringcast.operators.panel import add_wifi, modem_panel
from ringcast.operators.rolling import RANGE, cut_ranges, rolling_stats
from ringcast.session import stage
from ringcast.sources import specs
from ringcast.sources.read import Tables, read

# Metric names as the saved models know them.
METRICS = (
    "outage_count",
    "codeword_error_rate",
    "cmts_cm_us_rx_power_avg",
    "cmts_cm_us_signal_noise_avg",
    "ACCESSIBILITY_PERC_FULL_DAY",
    "US_SPEED_ATTAINABLE_FULL",
    "DS_SPEED_ATTAINABLE_FULL",
    "attainability_pct",
    "down_gb",
    "up_gb",
    "Intermittent_hrs",
    "transitions",
    "Offline_counts",
    "hsi_down_1d_rank",
    "hsi_up_1d_rank",
    "IPTV_Down_1D_rank",
    "IPTV_Up_1D_rank",
    "RHP_Down_1D_rank",
    "RHP_Up_1D_rank",
    "whix_daily",
    "daily_wifi_disconnects",
    "COUNT_DAILY_GW_WIFI_TOOHOT",
)
STATS = ("avg", "var", "kurtosis")
ROWS_BEFORE = 14
KEYS = ("account_number", "event_date", "mac")
COUNTS = tuple(f"call_count_{n}" for n in (0, 30, 60, 10, 120))
FEATURES = (*COUNTS, *(f"{m}_{s}" for m in METRICS for s in STATS))


@dataclass(frozen=True)
class Feeds:
    """The projected inputs of the feature and label plans."""

    accessibility: DataFrame
    service_quality: DataFrame
    attainability: DataFrame
    intermittency: DataFrame
    usage: DataFrame
    whix: DataFrame
    cases: DataFrame
    labels: DataFrame

    @classmethod
    def read(
        cls,
        spark: SparkSession,
        tables: Tables | None = None,
        categories: Sequence[str] = TECHNICAL_CATEGORIES,
    ) -> Feeds:
        return cls(
            accessibility=read(spark, specs.ACCESSIBILITY, tables),
            service_quality=read(spark, specs.SERVICE_QUALITY, tables, "channel_number = 0"),
            attainability=read(spark, specs.ATTAINABILITY, tables),
            intermittency=read(spark, specs.INTERMITTENCY, tables),
            usage=read(spark, specs.USAGE_RANKED, tables),
            whix=read(spark, specs.WHIX, tables),
            cases=read(spark, specs.SUPPORT_CASES, tables),
            labels=call_labels(
                read(spark, specs.CONVERSATIONS, tables),
                read(spark, specs.SESSIONS_BOOKED, tables),
                read(spark, specs.SESSIONS_CATEGORIES, tables),
                read(spark, specs.CATEGORIES, tables),
                categories,
            ),
        )

    def panel(self) -> DataFrame:
        joined = modem_panel(
            self.accessibility,
            self.service_quality,
            self.attainability,
            self.intermittency,
            self.usage,
        )
        return add_wifi(joined, self.whix).select(
            "account_number", "event_date", "mac", *METRICS
        )

    def checked(self) -> Mapping[str, DataFrame]:
        """The sources a scoring day cannot do without."""
        return {
            "svq": self.service_quality,
            "accessibility": self.accessibility,
            "attainability": self.attainability,
            "intermittency": self.intermittency,
            "resi": self.usage,
            "speech": self.labels,
        }


def last_rows(
    rows: DataFrame,
    n: int,
    key: str = "account_number",
    order: Sequence[str] = ("event_date", "mac"),
) -> DataFrame:
    """The last ``n`` rows of each key.

    Spark already cuts each key to ``n`` rows in every map task
    (WindowGroupLimit), so a large key does not reach one task whole.
    """
    latest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= n).drop("_rank")


@dataclass(frozen=True)
class History:
    """What the features of some days need of the panel."""

    inside: DataFrame  # panel rows of the days
    before: DataFrame  # each account's last rows before them
    days: DataFrame  # (account_number, event_date) of every panel row counts reach


def _panel_keys(feeds: Feeds, seen: DataFrame, start: Column, end: Column) -> DataFrame:
    """Keys of the panel rows of some days and accounts; no metric column is read."""
    inside = F.col("event_date").between(start, end)
    own = feeds.accessibility.where(inside).select(*KEYS)
    own = own.join(seen, own["account_number"].eqNullSafe(seen["_seen"]), "left_semi")
    others = (feeds.service_quality, feeds.attainability, feeds.intermittency, feeds.usage)
    return modem_panel(own, *[o.where(inside).select("mac", "event_date") for o in others])


def history_slice(
    feeds: Feeds,
    start: str | dt.date,
    end: str | dt.date,
    rows: int = ROWS_BEFORE,
    staged: bool = False,
) -> History:
    """Panel rows of [start, end], and each account's last ``rows`` rows before.

    That is all a row frame over these days can reach. Keys come first: only key columns
    of the whole history are read, for accounts seen on the days, and ranked. Metrics are
    then fetched for the keys that remain, from their dates on. Day counts need the keys
    of the days they reach. Keys are staged, as they are read several times, and with ``staged``
    the fetched rows.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col("event_date")
    seen = feeds.accessibility.where(day.between(first, last)).select(
        F.col("account_number").alias("_seen")
    ).distinct()
    beginning = F.lit("0001-01-01").cast("date")
    keys = stage(_panel_keys(feeds, seen, beginning, last), "panel-keys")
    wanted = last_rows(keys.where(day < first), rows).unionByName(keys.where(day >= first))
    wanted = stage(wanted.distinct(), "history-keys")

    oldest = wanted.agg(F.min(day)).first()[0]
    bounded = day.between(F.coalesce(F.lit(oldest).cast("date"), first), last)
    own = feeds.accessibility.where(bounded)
    chosen = wanted.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    same = [own[k].eqNullSafe(chosen[f"_{k}"]) for k in ("account_number",)]
    same += [own[k] == chosen[f"_{k}"] for k in ("event_date", "mac")]
    chosen_feeds = replace(
        feeds,
        accessibility=own.join(chosen, same, "left_semi"),
        **{
            name: getattr(feeds, name).where(bounded)
            for name in ("service_quality", "attainability", "intermittency", "usage", "whix")
        },
    )
    fetched = chosen_feeds.panel()
    if staged:
        fetched = stage(fetched, "history-panel")
    reach = F.date_sub(first, max(HISTORY_DAYS))
    return History(
        inside=fetched.where(day >= first),
        before=last_rows(fetched.where(day < first), rows),
        days=keys.where(day >= reach).select("account_number", "event_date"),
    )


def _reached_cases(feeds: Feeds, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Cases that any trailing count of the days can reach."""
    reach = F.date_sub(F.lit(start).cast("date"), max(HISTORY_DAYS))
    return feeds.cases.where(F.col("creation_time").between(reach, F.lit(end).cast("date")))


def feature_frame(
    feeds: Feeds,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    agg_window: int = -ROWS_BEFORE,
    compat: bool = False,
    with_mac: bool = False,
) -> DataFrame:
    """Keys, contact counts and rolling statistics: 73 columns, and ``mac`` on request.

    With ``start`` and ``end`` only the rows of those days are produced, with
    the same values, from a slice of the history instead of all of it. One bound
    alone is refused.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    whole = start is None
    if whole:
        panel, cases = cut_ranges(feeds.panel()), feeds.cases
        days = panel.drop(RANGE)
    else:
        history = history_slice(feeds, start, end, -agg_window, staged=True)
        panel = cut_ranges(history.inside.unionByName(history.before))
        days = history.days
        cases = _reached_cases(feeds, start, end)
    rolled = rolling_stats(panel, METRICS, STATS, rows=-agg_window, keep=KEYS)
    if not whole:
        rolled = between_days(rolled, start, end)
    full = add_contact_history(rolled, cases, compat=compat, days=days)
    keys = ["account_number", "event_date", *(["mac"] if with_mac else [])]
    return full.select(*keys, *FEATURES)


def point_in_time(feeds: Feeds, when: str | dt.date) -> DataFrame:
    """One feature row per account seen on one day, by aggregation alone.

    Equals the ``feature_frame`` row of the account's first modem on that day.
    """
    day = F.lit(when).cast("date")
    history = history_slice(feeds, when, when, staged=True)
    today = one_per_account(history.inside, order=["mac"])
    present = history.days.groupBy("account_number", "event_date").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    opened = (
        _reached_cases(feeds, when, when)
        .groupBy("account_number", F.col("creation_time").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("_cases"))
    )
    per_day = present.join(opened, ["account_number", "event_date"], "left").fillna({"_cases": 0})
    ago = F.date_diff(day, F.col("event_date"))
    same_day = F.max(F.when(ago == 0, F.col("_cases"))).alias("call_count_0")
    trailing = [
        F.sum(F.when(ago.between(1, n), F.col("_rows") * F.col("_cases"))).alias(f"call_count_{n}")
        for n in HISTORY_DAYS
    ]
    counts = per_day.groupBy(F.col("account_number").alias("_account")).agg(same_day, *trailing)
    return day_features(today, history.before, counts, day)


def day_features(today: DataFrame, before: DataFrame, counts: DataFrame, day: Column) -> DataFrame:
    """Feature rows of a day from one panel row per account, the rows before it, and counts.

    ``counts`` has the account in ``_account`` and the contact counts of the day.
    """
    reached = before.unionByName(today)
    moments = []
    for m in METRICS:
        x = F.col(m).cast("double")
        moments += [
            F.avg(x).alias(f"{m}_avg"),
            (F.avg(x * x) - F.avg(x) * F.avg(x)).alias(f"{m}_var"),
            F.avg(x * x * x * x).alias(f"{m}_kurtosis"),
        ]
    rolled = (
        reached.groupBy("account_number")
        .agg(
            F.max_by("mac", F.struct("event_date", "mac")).alias("mac"),
            F.max("event_date").alias("_last"),
            *moments,
        )
        .where(F.col("_last") == day)
    )
    same = rolled["account_number"].eqNullSafe(counts["_account"])
    return rolled.join(counts, same).select(
        "account_number", day.alias("event_date"), "mac", *FEATURES
    )
