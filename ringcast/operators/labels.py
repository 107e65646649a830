"""Past-contact labels from speech analytics and cases, and forward targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.functions.scalar import day_number
from ringcast.operators.counts import join_days

# The call categories that count as a technical contact.
TECHNICAL_CATEGORIES = (
    "Cable Customer Frustration",
    "L1R - Tech Issues: Internet",
    "BP1 Technical Support",
    "BP3 Technical Support",
    "HOT TOPIC: National Outage",
    "Ignite TV",
    "L1R - Tech Issues: TV",
    "L2R - INT: Modem Offline",
    "HOT TOPIC: Outage Compensation",
    "L1F - Tech Issues: Internet",
    "L2R - General Inquiries: Internet",
)
# Case levels of a technical internet case.
CASE_LEVEL_2 = ("Internet",)
CASE_LEVEL_3 = ("RF Signal", "Network Performance", "Signal RF", "Modem")

RULES = ("speech_id", "unit_and_session")
ACCOUNT_DAY = ["account_number", "event_date"]


def session_categories(
    sessions_categories: DataFrame, categories: DataFrame, kept: Sequence[str]
) -> DataFrame:
    """(sid, category_name) of the sessions in the kept categories."""
    wanted = categories.where(F.col("category_name").isin(list(kept)))
    return sessions_categories.join(wanted, "category_key").select("sid", "category_name")


def call_labels(
    conversations: DataFrame,
    sessions_booked: DataFrame,
    sessions_categories: DataFrame,
    categories: DataFrame,
    kept: Sequence[str] = TECHNICAL_CATEGORIES,
    rules: Sequence[str] = RULES,
) -> DataFrame:
    """Distinct (account_number, event_date, category_name, called = 1).

    A conversation belongs to a session when their speech ids agree, or when
    its id splits into the session's unit and sid. Both rules run as one join
    on a (rule, a, b) key. Sessions are first reduced to their distinct kept
    categories, so a conversation meets at most one row per category and rule,
    however often its key repeats.
    """
    named = session_categories(sessions_categories, categories, kept).distinct()
    booked = sessions_booked.join(named, "sid")
    pairs = {
        "speech_id": (("speech_id",), ("speech_id",)),
        "unit_and_session": (("unit_num", "sid"), ("speech_unit", "speech_session")),
    }

    def keyed(df: DataFrame, side: int, carried: Sequence[str]) -> DataFrame:
        keys = []
        for rule in rules:
            first, *rest = pairs[rule][side]
            second = F.col(rest[0]).cast("string") if rest else F.lit("")
            keys.append(
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.col(first).cast("string").alias("a"),
                    second.alias("b"),
                )
            )
        return df.select(F.inline(F.array(*keys)), *carried)

    known = keyed(booked, 0, ["category_name"]).distinct()
    spoken = keyed(conversations, 1, ACCOUNT_DAY)
    return (
        spoken.join(known, ["rule", "a", "b"])
        .select(*ACCOUNT_DAY, "category_name", F.lit(1).alias("called"))
        .distinct()
    )


def ground_truth(
    conversations: DataFrame,
    sessions_booked: DataFrame,
    sessions_categories: DataFrame,
    categories: DataFrame,
    kept: Sequence[str] = TECHNICAL_CATEGORIES,
) -> DataFrame:
    """Every matching (conversation, session, category) by speech id, duplicates kept."""
    spoken = conversations.select("speech_id", *ACCOUNT_DAY).distinct()
    booked = sessions_booked.select("speech_id", "sid").distinct()
    named = session_categories(sessions_categories, categories, kept)
    return spoken.join(booked, "speech_id").join(named, "sid").select(
        *ACCOUNT_DAY, "category_name"
    )


def attach_label(panel: DataFrame, labels: DataFrame) -> DataFrame:
    """Left-join labels by account and day: one row per category, else not called."""
    return panel.join(labels, ACCOUNT_DAY, "left").fillna(
        {"called": 0, "category_name": "no_call"}
    )


def case_label(
    panel: DataFrame,
    cases: DataFrame,
    level_2: Sequence[str] = CASE_LEVEL_2,
    level_3: Sequence[str] = CASE_LEVEL_3,
) -> DataFrame:
    """``target_icm`` = 1 where the account opened a technical case that day.

    One row per distinct level-3 type, as the label join multiplies.
    """
    technical = (
        cases.where(F.col("CASE_TYPE_LVL2").isin(list(level_2)))
        .where(F.col("CASE_TYPE_LVL3").isin(list(level_3)))
        .select("account_number", F.col("creation_time").alias("event_date"), "CASE_TYPE_LVL3")
        .distinct()
    )
    flag = F.when(F.col("CASE_TYPE_LVL3").isNull(), 0).otherwise(1)
    return (
        panel.join(technical, ACCOUNT_DAY, "left")
        .withColumn("target_icm", flag)
        .drop("CASE_TYPE_LVL3")
    )


def next_day_case_label(
    panel: DataFrame, cases: DataFrame, level_1: Sequence[str], level_5: Sequence[str]
) -> DataFrame:
    """``target`` = 1 where a case of the given levels opens on the next day."""
    opened = (
        cases.where(F.col("CASE_TYPE_LVL1").isin(list(level_1)))
        .where(F.col("X_CASE_TYPE_LVL5").isin(list(level_5)))
        .select(
            "account_number",
            F.date_add("creation_time", -1).alias("event_date"),
            F.lit(1).alias("target"),
        )
        .distinct()
    )
    return panel.join(opened, ACCOUNT_DAY, "left").fillna({"target": 0})


def forward_label(
    panel: DataFrame,
    column: str = "called",
    days: int = 10,
    horizon_end=None,
    key: str = "account_number",
    day: str = "event_date",
) -> DataFrame:
    """``target`` = 1 if any of the account's rows 1..``days`` days ahead has ``column`` > 0.

    ``window`` records the span. ``label_complete`` is false for the last days
    before ``horizon_end`` (default: the last day of the panel), whose future
    is cut off, so that a 0 there may only mean "not seen yet".
    """
    # a sum over non-negative flags is positive where their daily maximum is
    daily = panel.groupBy(key, day).agg(F.sum(column).alias("_sum"))
    ahead = Window.partitionBy(key).orderBy(day_number(day)).rangeBetween(1, days)
    daily = daily.withColumn(
        "target", F.when(F.sum("_sum").over(ahead) > 0, 1).otherwise(0)
    )
    end = F.lit(horizon_end) if horizon_end else panel.select(F.max(day)).scalar()
    return join_days(panel, daily, ["target"], key, day).select(
        *panel.columns,
        F.lit(days).alias("window"),
        "target",
        (F.col(day) <= F.date_sub(end.cast("date"), days)).alias("label_complete"),
    )
