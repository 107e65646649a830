"""Column expressions shared by the operators. All built-in, no Python UDFs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 2**32


def gateway_mac(mac: str | Column) -> Column:
    """Gateway form of a modem address: no hyphens, upper case."""
    return F.upper(F.regexp_replace(mac, "-", ""))


def day_number(day: str | Column) -> Column:
    """Whole days since 1970-01-01.

    Day ranges are framed over this number, so a daylight-saving change can
    neither widen nor narrow a frame (seconds since midnight would).
    """
    return F.unix_date(F.col(day) if isinstance(day, str) else day)


def row_hash(keys: Sequence[str], seed: object | None = None) -> Column:
    """md5 of the key columns as text; the same row always hashes alike.

    Sampling and limiting by this hash gives the same rows after a task retry
    or on another partitioning, which ``rand`` and a bare ``limit`` do not.
    """
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.insert(0, F.lit(str(seed)))
    return F.md5(F.concat_ws("|", *parts))


def hash_fraction(keys: Sequence[str], seed: object | None = None) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of ``row_hash``."""
    bits = F.conv(F.left(row_hash(keys, seed), F.lit(8)), 16, 10).cast("long")
    return bits / F.lit(HASH_SPACE)


def iso_day(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def scoring_date(stamp: str | dt.date = "Today", lag_days: int = 2) -> dt.date:
    """Date to score: an ISO date, or ``"Today"`` for today less the feed lag."""
    if isinstance(stamp, dt.date):
        return stamp
    if stamp == "Today":
        return dt.date.today() - dt.timedelta(days=lag_days)
    return dt.date.fromisoformat(stamp)
