"""Feature importances and surrogate explanations of a score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.functions.scalar import hash_fraction
from ringcast.operators.models import feature_order
from ringcast.operators.tree_paths import tree_contributions
from ringcast.session import stage


def _table(spark: SparkSession, features: Sequence[str], weights) -> DataFrame:
    rows = [(name, float(weight)) for name, weight in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double")


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame | None:
    """(feature, importance) of a fitted tree model; None where it has none."""
    weights = getattr(model.stages[-1], "featureImportances", None)
    return None if weights is None else _table(spark, feature_order(model), weights.toArray())


def _vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    filled = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features], "score"
    )
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def global_surrogate(
    scored: DataFrame, features: Sequence[str], seed: int = 42, **params
) -> DataFrame:
    """Importances of boosted trees fitted to reproduce ``score``."""
    model = GBTRegressor(labelCol="score", seed=seed, **{"maxIter": 20, **params}).fit(
        _vectors(scored, features)
    )
    return _table(scored.sparkSession, features, model.featureImportances.toArray())


def fidelity(
    scored: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = ("account_number", "event_date"),
    share: float = 0.7,
    seed: int = 42,
    **params,
) -> DataFrame:
    """How well boosted trees reproduce ``score`` on rows they were not fitted to.

    A row is held out by the hash of its key.  One row: ``n_fitted``, ``n_held_out`` and
    ``r2``, the share of the held-out scores' variance that the surrogate explains (NULL
    if these do not vary, below 0 if their mean would do better).
    """
    held = hash_fraction(keys, seed) >= share
    rows = stage(scored.select(*features, "score", held.alias("_held")), "surrogate")
    model = GBTRegressor(labelCol="score", seed=seed, **{"maxIter": 20, **params}).fit(
        _vectors(rows.where("not _held"), features)
    )
    found = model.transform(_vectors(rows.where("_held"), features))
    error = F.sum(F.pow(F.col("score") - F.col("prediction"), 2))
    spread = F.var_pop("score") * F.count("score")
    facts = found.agg(
        F.count("*").alias("n_held_out"), F.when(spread > 0, 1 - error / spread).alias("r2")
    )
    fitted = rows.where("not _held").agg(F.count("*").alias("n_fitted"))
    return fitted.join(facts)


def mean_contributions(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean_abs): the mean size of each feature's contributions, in one pass."""
    sizes = contributions.agg(*[F.avg(F.abs(F.col(f"`{c}`"))).alias(c) for c in features])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("mean_abs")) for c in features
    ])
    return sizes.select(F.explode(pairs).alias("f")).select("f.*")


def global_explanation(
    scored: DataFrame,
    model: PipelineModel,
    keys: Sequence[str] = ("account_number", "event_date"),
    **params,
) -> DataFrame:
    """Per feature of a tree model: mean size of its path contributions, its importance in
    a boosted surrogate of the score, and the surrogate's fidelity (the same on each row)."""
    order = feature_order(model)
    sizes = mean_contributions(tree_contributions(scored, model, keys)[0], order)
    surrogate = global_surrogate(scored, order, **params)
    # one row on the right
    return sizes.join(surrogate, "feature").join(fidelity(scored, order, keys, **params))


def local_contributions(
    scored: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = ("account_number", "event_date"),
) -> DataFrame:
    """Per row and feature: weight x (value - mean) in a linear fit of ``score``.

    An approximation of the model near its average row; a row's contributions
    sum to its fitted score less the mean score.
    """
    features = list(features)
    # a slight ridge penalty keeps the weights finite when features move together
    model = LinearRegression(labelCol="score", regParam=1e-6, solver="normal").fit(
        _vectors(scored, features)
    )
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    means = scored.agg(*[F.avg(value[c]).alias(c) for c in features]).first()
    return scored.select(
        *[
            ((value[c] - F.lit(means[c])) * F.lit(float(w))).alias(c)
            for c, w in zip(features, model.coefficients)
        ],
        *keys,
    )
