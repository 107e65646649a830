import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ringcast.operators.rolling import STATS, cut_ranges, rolling_stats, with_halo

SCHEMA = "account_number long, event_date date, mac string, x double"


def panel_rows(n, seed, accounts, hot_share=0.0, null_accounts=False):
    rng = random.Random(seed)
    start, rows, used = dt.date(2024, 1, 1), [], set()
    while len(rows) < n:
        account = 0 if rng.random() < hot_share else rng.randrange(accounts)
        if null_accounts and account == 1:
            account = None
        day, mac = start + dt.timedelta(days=rng.randrange(20)), f"m{rng.randrange(400):03d}"
        if (account, day, mac) not in used:
            used.add((account, day, mac))
            rows.append((account, day, mac, None if rng.random() < 0.05 else round(rng.random() * 9, 2)))
    return rows


def brute(rows, before):
    """The statistics from their definitions, one account at a time."""
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    out = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for i, row in enumerate(group):
            seen = [r[3] for r in group[max(0, i - before) : i + 1] if r[3] is not None]
            if not seen:
                out[row[:3]] = dict.fromkeys(STATS)
                continue
            mean = sum(seen) / len(seen)
            out[row[:3]] = {
                "avg": mean,
                "var": sum(v * v for v in seen) / len(seen) - mean * mean,
                "kurtosis": sum(v**4 for v in seen) / len(seen),
                "sum": sum(seen),
                "max": max(seen),
            }
    return out


def check(result, rows, before):
    want, got = brute(rows, before), result.collect()
    assert len(got) == len(rows)
    for row in got:
        for stat in STATS:
            a, b = row[f"x_{stat}"], want[(row.account_number, row.event_date, row.mac)][stat]
            assert (a is None) == (b is None)
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("before", [0, 3, 14])
def test_matches_brute_force(spark, before):
    rows = panel_rows(400, before, 7, null_accounts=True)
    df = spark.createDataFrame(rows, SCHEMA)
    check(rolling_stats(df, ["x"], STATS, before), rows, before)


@pytest.mark.parametrize("seed,parts", [(1, 2), (2, 40), (3, 200)])
def test_hot_accounts_split_alike(spark, seed, parts):
    rows = panel_rows(600, seed, 9, hot_share=0.34, null_accounts=True)
    df = spark.createDataFrame(rows, SCHEMA)
    check(rolling_stats(cut_ranges(df, parts=parts), ["x"], STATS, 14), rows, 14)


def test_ranges_shorter_than_the_frame(spark):
    """More ranges than rows: a frame has to reach over several of them."""
    rows = panel_rows(60, 5, 2)
    cut = cut_ranges(spark.createDataFrame(rows, SCHEMA), parts=40)
    ranged = with_halo(cut, 14, "account_number", ("event_date", "mac"))
    assert ranged.where("_own").count() == len(rows)
    sizes = ranged.where("_own").groupBy("account_number", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 10
    led = ranged.groupBy("account_number", "_part").agg(
        F.count_if(~F.col("_own")).alias("led")
    ).orderBy("account_number", "_part").collect()
    own = {(r[0], r[1]): r[2] for r in sizes.collect()}
    before = {}
    for row in led:
        assert row.led == min(14, before.get(row.account_number, 0))
        before[row.account_number] = before.get(row.account_number, 0) + own[row[0], row[1]]


def test_two_modems_are_deterministic(spark):
    rows = panel_rows(120, 8, 1)
    one, many = (
        rolling_stats(spark.createDataFrame(rows, SCHEMA).repartition(n), ["x"]).orderBy(
            "event_date", "mac"
        ).collect()
        for n in (1, 13)
    )
    assert one == many


def test_unknown_statistic(spark):
    with pytest.raises(ValueError, match="median"):
        rolling_stats(spark.createDataFrame([], SCHEMA), ["x"], ["median"])


def test_one_window_node(spark):
    df = spark.createDataFrame(panel_rows(50, 1, 3), SCHEMA).withColumn("y", F.col("x") + 1)
    out = rolling_stats(df, ["x", "y"], ["var", "avg", "kurtosis"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # of the windows, one holds all statistics
    assert plan.count("windowspecdefinition") and plan.count("avg(") >= 3
    assert sum("avg(" in line for line in plan.splitlines() if "Window [" in line) == 1
