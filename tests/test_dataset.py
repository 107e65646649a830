import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ringcast.operators import dataset


def hashed(*keys):
    return hashlib.md5("|".join(str(k) for k in keys if k is not None).encode()).hexdigest()


def frame(spark, n, copies=1, seed=0):
    """Rows of which one is repeated, making up a third or more of the whole."""
    rng = random.Random(seed)
    rows = [(i, rng.randrange(100), int(rng.random() < 0.3)) for i in range(n)] + [(5, 0, 0)] * copies
    return rows, spark.createDataFrame(rows, "id long, v long, target int")


@pytest.mark.parametrize("n", [0, 1, 7, 250, 600, 601, 5000])
@pytest.mark.parametrize("digits", [1, 4])
def test_take_hashed_is_exact(spark, n, digits):
    rows, df = frame(spark, 400, copies=300)
    got = sorted(tuple(r) for r in dataset.take_hashed(df, n, ["id"], digits).collect())
    want = sorted(sorted(rows, key=lambda r: (hashed(r[0]), r))[:n])
    assert got == want


def test_undersample(spark):
    rows, df = frame(spark, 500, copies=100)
    got = dataset.undersample(df, keys=["id"]).groupBy("target").count().collect()
    positives = sum(r[2] for r in rows)
    assert dict(got) == {1: positives, 0: positives}
    few = df.where("target = 1 or id < 20")
    left = dataset.undersample(few, keys=["id"]).where("target = 0").count()
    assert left == few.where("target = 0").count()


def test_samples_do_not_depend_on_partitioning(spark):
    _, df = frame(spark, 2000)
    for sample in (
        lambda d: dataset.bernoulli_sample(d, 0.5, ["id"], 3),
        lambda d: dataset.stratified_sample(d, "target", {0: 0.05, 1: 0.2}, ["id"], 3),
        lambda d: dataset.random_split(d, [1, 2], ["id"], 3)[1],
        lambda d: dataset.take_hashed(d, 100, ["id"]),
    ):
        assert sorted(sample(df.repartition(7)).collect()) == sorted(sample(df.coalesce(1)).collect())


def test_sample_shares(spark):
    df = spark.range(40000).withColumn("target", (F.col("id") < 20000).cast("int"))
    assert 0.48 < dataset.bernoulli_sample(df, 0.5, ["id"], 1).count() / 40000 < 0.52
    got = dict(
        dataset.stratified_sample(df, "target", {1: 0.2, 0: 0.05}, ["id"], 1).groupBy("target").count().collect()
    )
    assert 0.18 < got[1] / 20000 < 0.22 and 0.04 < got[0] / 20000 < 0.06
    only = dataset.stratified_sample(df, "target", {1: 1.0}, ["id"])
    assert only.count() == 20000 and only.where("target = 0").isEmpty()


def test_random_split_covers_everything(spark):
    df = spark.range(5000)
    parts = dataset.random_split(df, [0.7, 0.1, 0.2], ["id"], 9)
    ids = [r.id for part in parts for r in part.collect()]
    assert sorted(ids) == list(range(5000))


def test_null_policies(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 2.0, None)], "i long, d double, s string")
    filled = dataset.fill_zero(df).collect()
    assert [tuple(r) for r in filled] == [(1, 0.0, "a"), (0, 2.0, None)]
    assert dataset.drop_null(df).isEmpty()


def test_one_per_account_keeps_unknown_accounts(spark):
    df = spark.createDataFrame(
        [(1, "b", "m"), (1, "a", "n"), (1, "a", "k"), (None, "z", "q")],
        "account_number long, category_name string, mac string",
    )
    got = {tuple(r) for r in dataset.one_per_account(df).collect()}
    assert got == {(1, "a", "k"), (None, "z", "q")}


def test_feature_columns_are_sorted(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b long, A long, target long")
    assert dataset.feature_columns(df, ["target"]) == ["A", "b"]


@pytest.mark.parametrize("n", [1, 37, 399, 400])
@pytest.mark.parametrize("ranked", [1, 5, 1000])
def test_take_hashed_narrows_the_cut(spark, n, ranked):
    """However few rows may be ranked, the rows of lowest hash come out; ties too."""
    df = spark.createDataFrame([(i % 150, i % 2) for i in range(400)], "id long, x long")
    got = dataset.take_hashed(df, n, ["id"], digits=1, ranked=ranked).collect()
    whole = sorted((hashlib.md5(str(i % 150).encode()).hexdigest(), i % 150, i % 2) for i in range(400))
    assert sorted(tuple(r) for r in got) == sorted((i, x) for _, i, x in whole[:n])
