"""Modem tables stored by modem and day, so that the panel join moves no rows.

All tables are bucketed by the same keys into the same number of buckets, one file to a
bucket and write.  Spark then joins bucket with bucket, without a shuffle.  Pick as many
buckets as make files of some hundred megabytes; a table is rewritten to change them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from ringcast.operators.panel import MODEM_DAY
from ringcast.plans.features import Feeds

MODEM_TABLES = ("accessibility", "service_quality", "attainability", "intermittency", "usage")


def save_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    keys: Sequence[str] = MODEM_DAY,
    mode: str = "overwrite",
) -> DataFrame:
    """Store ``df`` as a catalog table bucketed by ``keys``; mode ``append`` adds rows.

    Rows are dealt out by the hash that buckets go by, so a task writes one file.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode(mode)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_feeds(
    feeds: Feeds, prefix: str, folder: str, buckets: int, mode: str = "overwrite"
) -> Feeds:
    """Feeds whose five modem tables are stored as ``<prefix>_<table>`` under ``folder``."""
    stored = {
        name: save_bucketed(
            getattr(feeds, name), f"{prefix}_{name}", f"{folder}/{name}", buckets, mode=mode
        )
        for name in MODEM_TABLES
    }
    return replace(feeds, **stored)
