"""Classifiers on the feature frame, trained and applied by pyspark.ml."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.functions.scalar import hash_fraction
from ringcast.operators.dataset import feature_columns
from ringcast.operators.forests import Boosted, Forest, TreesModel
from ringcast.session import stage

# Columns of a dataset that are never features.
NOT_FEATURES = (
    "account_number",
    "event_date",
    "join_date",
    "category_name",
    "target",
    "window",
    "label_complete",
    "mac",
    "gw_mac",
)
FOLDS = 5
TASK_ROWS = 50_000  # of a stack's vectors, for one task of a fit


def _estimator(kind: str, label: str, seed: int, in_task: bool = False, **params):
    """Defaults follow the usual ones of the single-machine classifiers.

    Trees of a forest are grown one to a task, and with ``in_task`` boosted trees in one.
    Where Spark fits a forest itself, each row keeps the node it is in, so that a pass over
    the rows need not go down the trees made so far, nor send them to every task.
    """
    if kind == "rf":
        settings = {"numTrees": 100, "maxDepth": 20, "featureSubsetStrategy": "sqrt",
                    "cacheNodeIds": True, **params}
        return Forest(labelCol=label, seed=seed, **settings)
    if kind == "gbt":
        settings = {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, **params}
        return (Boosted if in_task else GBTClassifier)(labelCol=label, seed=seed, **settings)
    raise ValueError(f"unknown model kind {kind!r}; choose rf, gbt or stack")


def fit(
    df: DataFrame,
    kind: str = "rf",
    label: str = "target",
    features: Sequence[str] | None = None,
    seed: int = 42,
    **params,
) -> PipelineModel:
    """Fit one classifier; the saved pipeline holds the sorted feature order."""
    columns = list(features or feature_columns(df, NOT_FEATURES))
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    return Pipeline(stages=[assembler, _estimator(kind, label, seed, **params)]).fit(df)


def feature_order(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Append ``pred`` (class) and ``score`` (probability of class 1); NULL features count 0."""
    columns = feature_order(model)
    filled = df.select(
        "*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}") for c in columns]
    )
    assembled = VectorAssembler(
        inputCols=[f"_x_{c}" for c in columns], outputCol="features"
    ).transform(filled)
    last = model.stages[-1]
    if isinstance(last, TreesModel):
        share = F.col("_share")
        return last.with_score(assembled, vector_to_array("features"), "_share").select(
            *df.columns, (share > 0.5).cast("int").alias("pred"), share.alias("score")
        )
    return last.transform(assembled).select(
        *df.columns,
        F.col("prediction").cast("int").alias("pred"),
        vector_to_array("probability")[1].alias("score"),
    )


class StackedModel:
    """Base pipelines and the logistic regression over their scores."""

    def __init__(self, bases: dict[str, PipelineModel], final):
        self.bases = bases
        self.final = final

    def transform(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        for name, model in self.bases.items():
            df = score(df, model).drop("pred").withColumnRenamed("score", f"_{name}")
        names = [f"_{name}" for name in self.bases]
        meta = VectorAssembler(inputCols=names, outputCol="features").transform(df)
        return self.final.transform(meta).select(
            *columns,
            F.col("prediction").cast("int").alias("pred"),
            vector_to_array("probability")[1].alias("score"),
        )

    def save(self, path: str) -> None:
        for name, model in self.bases.items():
            model.write().overwrite().save(f"{path}/base_{name}")
        self.final.write().overwrite().save(f"{path}/final")

    @classmethod
    def load(cls, path: str) -> StackedModel:
        bases = {kind: PipelineModel.load(f"{path}/base_{kind}") for kind in ("rf", "gbt")}
        return cls(bases, LogisticRegressionModel.load(f"{path}/final"))


def fit_stack(
    df: DataFrame,
    label: str = "target",
    keys: Sequence[str] = ("account_number", "event_date"),
    folds: int = FOLDS,
    seed: int = 42,
    params: dict[str, dict] | None = None,
    together: int = 12,
) -> StackedModel:
    """Logistic regression over out-of-fold scores of a forest and boosted trees.

    A row's fold comes from its key's hash, so it is the same on every pass.  Features are
    assembled once, into one staged table of vectors; the fits of all folds and of the
    whole read it side by side, ``together`` at a time, each in as few tasks as TASK_ROWS
    allows, as the fits share the cores; boosted trees are grown in one task a fit.  Folds
    that have no rows, or hold all of them, are left out; without any other the stack cannot
    be fitted.  Forests draw rows by where they lie, so those of two runs over one table may
    differ.
    """
    params = params or {}
    assembler = VectorAssembler(
        inputCols=feature_columns(df, NOT_FEATURES), outputCol="features"
    )
    fold = F.floor(hash_fraction(keys, seed) * folds).cast("int")
    vectors = stage(
        assembler.transform(df.withColumn("_fold", fold)).select("_fold", label, "features"),
        "vectors",
    )
    sizes = dict(vectors.groupBy("_fold").count().collect())
    used = sorted(f for f, n in sizes.items() if n < sum(sizes.values()))
    if not used:
        raise ValueError("a stack needs rows in two folds at least")

    few = vectors.coalesce(math.ceil(sum(sizes.values()) / TASK_ROWS))

    def fitted(job):
        kind, left_out = job
        rows = few if left_out is None else few.where(F.col("_fold") != left_out)
        return _estimator(kind, label, seed, in_task=True, **params.get(kind, {})).fit(rows)

    # boosted trees take longest, so they begin first
    jobs = [(kind, f) for kind in ("gbt", "rf") for f in (None, *used)]
    with ThreadPool(min(together, len(jobs))) as pool:
        done = pool.map(inheritable_thread_target(df.sparkSession)(fitted), jobs, chunksize=1)
    made = dict(zip(jobs, done, strict=True))

    parts = []
    for f in used:
        held = vectors.where(F.col("_fold") == f).select(label, "features")
        for kind in ("rf", "gbt"):
            held = made[kind, f].transform(held).select(
                *held.columns, vector_to_array("probability")[1].alias(f"_{kind}")
            )
        parts.append(held.select(label, "_rf", "_gbt"))
    out_of_fold = stage(reduce(DataFrame.unionByName, parts), "out-of-fold")
    meta = VectorAssembler(inputCols=["_rf", "_gbt"], outputCol="features").transform(out_of_fold)
    final = LogisticRegression(labelCol=label).fit(meta)
    bases = {kind: PipelineModel([assembler, made[kind, None]]) for kind in ("rf", "gbt")}
    return StackedModel(bases, final)


def apply_model(df: DataFrame, model: PipelineModel | StackedModel) -> DataFrame:
    return model.transform(df) if isinstance(model, StackedModel) else score(df, model)
