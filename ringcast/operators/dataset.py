"""Splitting, balancing, sampling and null handling of training data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.functions.rows import repeat_rows
from ringcast.functions.scalar import hash_fraction, row_hash

ROW_KEY = ("account_number", "event_date", "mac", "category_name")
Day = str | dt.date
HASH_DIGITS = 32  # of an md5 in hex


def between_days(df: DataFrame, start: Day, end: Day, day: str = "event_date") -> DataFrame:
    return df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def on_day(df: DataFrame, when: Day, day: str = "event_date") -> DataFrame:
    return df.where(F.col(day) == F.lit(when).cast("date"))


def time_split(
    df: DataFrame, train: tuple[Day, Day], test: tuple[Day, Day], day: str = "event_date"
) -> tuple[DataFrame, DataFrame]:
    return between_days(df, *train, day), between_days(df, *test, day)


def take_hashed(
    df: DataFrame, n: int, keys: Sequence[str] = ROW_KEY, digits: int = 4, ranked: int = 1000
) -> DataFrame:
    """The ``n`` rows of lowest ``row_hash``, without sorting or moving the rest.

    ``orderBy(hash).limit(n)`` would gather n rows in one task. Here the hashes
    are counted by their first hex digits (at most 16**digits groups), whole
    groups below the cut are kept in place, and the group at the cut is counted
    again by more digits until it holds at most ``ranked`` rows, or rows of one
    hash only. Those are ranked, equal rows first folded into one and a count.
    Evaluates ``df`` several times: pass a staged frame.
    """
    hashed = df.withColumn("_hash", row_hash(keys))
    inside, upto, length, needed = F.lit(True), F.sum("_n").over(Window.orderBy("_group")), 0, n
    while True:
        length = min(length + digits, HASH_DIGITS)
        group = F.left("_hash", F.lit(length))
        groups = hashed.where(inside).groupBy(group.alias("_group"))
        groups = groups.agg(F.count(F.lit(1)).alias("_n")).withColumn("_upto", upto)
        cut = groups.where(F.col("_upto") >= needed).orderBy("_group").first()
        if cut is None:
            return df
        needed -= cut["_upto"] - cut["_n"]
        inside = group == cut["_group"]
        if cut["_n"] <= ranked or length == HASH_DIGITS:
            break
    below = hashed.where(group < cut["_group"]).select(*df.columns)

    rank = Window.partitionBy("_group").orderBy("_hash", *df.columns)
    at_cut = (
        hashed.withColumn("_group", group)
        .where(F.col("_group") == cut["_group"])
        .groupBy("_group", "_hash", *df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_before", F.sum("_copies").over(rank) - F.col("_copies"))
        .where(F.col("_before") < needed)
        .withColumn("_take", F.least("_copies", F.lit(needed) - F.col("_before")))
    )
    return below.unionByName(repeat_rows(at_cut, "_take", spread=True).select(*df.columns))


def undersample(
    df: DataFrame, label: str = "target", keys: Sequence[str] = ROW_KEY
) -> DataFrame:
    """All positives and as many negatives (all of them where they are fewer)."""
    positives = df.where(F.col(label) == 1)
    negatives = df.where(F.col(label) == 0)
    return take_hashed(negatives, positives.count(), keys).unionByName(positives)


def bernoulli_sample(
    df: DataFrame, fraction: float, keys: Sequence[str] = ROW_KEY, seed: int = 0
) -> DataFrame:
    """Keep each row with probability ``fraction``, by its hash: stable on retry."""
    return df.where(hash_fraction(keys, seed) < fraction)


def stratified_sample(
    df: DataFrame,
    column: str,
    fractions: Mapping[object, float],
    keys: Sequence[str] = ROW_KEY,
    seed: int = 0,
) -> DataFrame:
    """Keep each row with its stratum's probability; strata without one are dropped."""
    chances = F.create_map(*[F.lit(v) for pair in fractions.items() for v in pair])
    return df.where(hash_fraction(keys, seed) < F.coalesce(chances[F.col(column)], F.lit(0.0)))


def random_split(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str] = ROW_KEY, seed: int = 0
) -> list[DataFrame]:
    """Disjoint parts that together hold every row, in proportion to the weights."""
    total = float(sum(weights))
    bounds = [0.0]
    for weight in weights[:-1]:
        bounds.append(bounds[-1] + weight / total)
    bounds.append(1.0)
    place = hash_fraction(keys, seed)
    return [
        df.where((place >= low) & (place < high)) for low, high in zip(bounds, bounds[1:])
    ]


def fill_zero(df: DataFrame) -> DataFrame:
    """0 for NULL in every numeric column."""
    return df.fillna(0)


def drop_null(df: DataFrame) -> DataFrame:
    """Only rows without any NULL."""
    return df.dropna()


NULL_POLICIES = {"zero": fill_zero, "drop": drop_null}


def class_profile(frames: Mapping[str, DataFrame], label: str = "target") -> DataFrame:
    """Rows per dataset and class, with the dataset's width."""
    profiles = [
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("dataset"), label, "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def one_per_account(
    df: DataFrame,
    key: str = "account_number",
    order: Sequence[str] = ("category_name", "mac"),
) -> DataFrame:
    """One row per account, the first in ``order``.

    An aggregate rather than a ranking, so map tasks already reduce each
    account to one row before the shuffle.
    """
    others = [c for c in df.columns if c not in order]
    first = F.min(F.struct(*order, *others)).alias("_row")
    return df.groupBy(F.col(key).alias("_key")).agg(first).select(
        *[F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def feature_columns(df: DataFrame, drop: Sequence[str]) -> list[str]:
    """Every column but the dropped ones, in sorted order."""
    return sorted(set(df.columns) - set(drop))
