import datetime as dt
import random

from pyspark.sql import functions as F

from ringcast.streaming.refresh import batch_writer, on_new_files, rebuild_days, retrain_action


def drop_file(spark, folder, n):
    spark.range(n).coalesce(1).write.mode("append").parquet(folder)


def test_only_new_files_are_processed(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = spark.range(1).schema
    drop_file(spark, inbox, 3)
    action = batch_writer(out, lambda rows: rows.groupBy().agg(F.count("id").alias("n")))
    on_new_files(spark, inbox, schema, action, mark)
    drop_file(spark, inbox, 5)
    on_new_files(spark, inbox, schema, action, mark)
    on_new_files(spark, inbox, schema, action, mark)
    assert {r.BATCH: r.n for r in spark.read.parquet(out).collect()} == {0: 3, 1: 5}


def test_replay_replaces_its_batch(spark, tmp_path):
    write = batch_writer(str(tmp_path), lambda rows: rows)
    write(spark.range(3), 0)
    write(spark.range(4), 1)
    write(spark.range(3), 0)
    assert spark.read.parquet(str(tmp_path)).count() == 7


def test_retrain_once_per_batch(spark, tmp_path):
    inbox, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    runs = []
    drop_file(spark, inbox, 3)
    action = retrain_action(lambda session: runs.append(session.range(1).count()))
    for _ in range(2):
        on_new_files(spark, inbox, spark.range(1).schema, action, mark)
    assert runs == [1]


def _sums(landed, days):
    """Rows of each day and of the three days before it."""
    by_day = landed.groupBy("event_date").agg(F.count("*").alias("n"))
    past = by_day.select(F.col("event_date").alias("_past"), F.col("n").alias("_n"))
    ago = F.date_diff("event_date", "_past")
    near = by_day.join(past, ago.between(1, 3), "left").groupBy("event_date", "n").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("before")
    )
    return near.where(F.col("event_date").isin(list(days)))


def test_days_rebuilt_in_two_batches_and_a_replay_equal_the_full_build(spark, tmp_path):
    rng = random.Random(2)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 20)), str(i)) for i in range(60)]
    rows.append((None, "no day"))
    whole = spark.createDataFrame(rows, "event_date date, key string")
    halves = [spark.createDataFrame(rows[a:b], whole.schema) for a, b in ((0, 25), (25, 61))]
    built = []

    def build(landed, days):
        built.append(days)
        return _sums(landed, days)

    action = rebuild_days(str(tmp_path / "landing"), str(tmp_path / "out"), build, ahead=3)
    wanted = sorted(map(tuple, _sums(whole, {r[0] for r in rows if r[0]}).collect()))
    for k in (0, 1, 1, 0):
        action(halves[k], k)
        got = spark.read.parquet(str(tmp_path / "out")).select("event_date", "n", "before").collect()
        if k or len(built) > 1:
            assert sorted(map(tuple, got)) == wanted
    action(spark.createDataFrame([], whole.schema), 2)
    assert len(built) == 4


def test_only_reached_days_are_rebuilt(spark, tmp_path):
    built = []

    def build(landed, days):
        built.append([d.day for d in days])
        return _sums(landed, days)

    action = rebuild_days(str(tmp_path / "landing"), str(tmp_path / "out"), build, ahead=3, behind=1)
    day = [(dt.date(2024, 1, d), "x") for d in (1, 5, 6, 9, 10, 20)]
    action(spark.createDataFrame(day, "event_date date, key string"), 0)
    action(spark.createDataFrame(day[2:3], "event_date date, key string"), 1)
    assert built == [[1, 5, 6, 9, 10, 20], [5, 6, 9]]
