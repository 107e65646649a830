"""Projected reads of source tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.sources.specs import SourceSpec

Tables = Mapping[str, "DataFrame | str"]


def read(
    spark: SparkSession,
    spec: SourceSpec,
    tables: Tables | None = None,
    condition: str | None = None,
) -> DataFrame:
    """Project one source; ``condition`` filters the raw table, so it pushes down.

    ``tables`` maps the spec's name to a catalog table name or to a DataFrame;
    without an entry, the table or view called ``spec.name`` is read.
    """
    target = (tables or {}).get(spec.name, spec.name)
    raw = spark.table(target) if isinstance(target, str) else target
    if condition is not None:
        raw = raw.where(condition)
    if not spec.whole:
        columns = {name: F.col(name) for name in spec.kept}
        columns |= {new: F.col(old) for new, old in spec.renamed.items()}
        columns |= {
            new: F.col(old).try_cast("double") / F.lit(float(by))
            for new, (old, by) in spec.divided.items()
        }
        columns |= {new: F.expr(sql) for new, sql in spec.derived.items()}
        for day in spec.dates:
            if day in columns:
                columns[day] = _as_date(raw, spec, day, columns[day])
        raw = raw.select(*[column.alias(name) for name, column in columns.items()])
    return raw.distinct() if spec.distinct else raw


def _as_date(raw: DataFrame, spec: SourceSpec, day: str, column):
    """Cast only where needed: a cast over a date column would block pruning."""
    old = spec.renamed.get(day, day)
    kinds = {f.name.lower(): f.dataType.typeName() for f in raw.schema.fields}
    return column if kinds.get(old.lower()) == "date" else column.try_cast("date")


def read_all(
    spark: SparkSession, family: Mapping[str, SourceSpec], tables: Tables | None = None
) -> dict[str, DataFrame]:
    """Every table of a source family, keyed by its logical name."""
    return {name: read(spark, spec, tables) for name, spec in family.items()}


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Expose frames to SQL under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def read_dataset(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A saved dataset: a parquet folder, or the name of a catalog table."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
