"""Reads of the test tables, and learning rows, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def held_out(doc_id: Column, folds: int, rest: int) -> Column:
    """Whether a row belongs to the fold kept from learning; rows without id do not."""
    return F.coalesce(fold(doc_id, folds) == rest, F.lit(False))


def agreed_labels(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Every key with its ``label``; a key with two different labels is left out."""
    return (
        rows.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.min(label).alias("label"), F.max(label).alias("_max"))
        .where(F.col("label") == F.col("_max"))
        .select(key, "label")
    )


def sample_per_class(
    rows: DataFrame, key: str, label: str, per_class: int, classes: list
) -> DataFrame:
    """At most ``per_class`` keys of each class, by the hash of the key.

    A key with two different labels is left out.  The result is bounded by
    ``per_class`` times the number of classes.
    """
    clean = agreed_labels(rows, key, label)
    parts = [
        clean.where(F.col("label") == c).orderBy(F.xxhash64(key), key).limit(per_class)
        for c in classes
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
