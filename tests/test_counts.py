import datetime as dt

import pytest

from ringcast.functions.rows import CHUNK, repeat_rows
from ringcast.operators import counts


def day(n, month=1, year=2024):
    return dt.date(year, month, n)


@pytest.fixture
def same_day(spark):
    panel = spark.createDataFrame(
        [(1, day(n), "a") for n in range(1, 6)], "account_number long, event_date date, mac string"
    )
    cases = spark.createDataFrame([(1, day(2))] * 3, "account_number long, creation_time date")
    return panel, cases


def test_three_cases_on_a_day(same_day):
    got = counts.add_contact_history(*same_day, windows=[10]).orderBy("event_date").collect()
    assert [r.call_count_0 for r in got] == [0, 3, 0, 0, 0]
    assert [r.call_count_10 for r in got] == [None, 0, 3, 3, 3]


def test_three_cases_on_a_day_compat(same_day):
    got = counts.add_contact_history(*same_day, windows=[10], compat=True).orderBy("event_date").collect()
    assert len(got) == 7
    assert [r.call_count_0 for r in got] == [0, 3, 3, 3, 0, 0, 0]
    assert got[-1].call_count_10 == 9


@pytest.mark.parametrize("compat", [False, True])
def test_one_join_equals_two_steps(same_day, compat):
    panel, cases = same_day
    two = counts.add_trailing(counts.add_same_day(panel, cases, compat=compat), windows=[2, 10])
    one = counts.add_contact_history(panel, cases, windows=[2, 10], compat=compat)
    assert sorted(one.select(two.columns).collect()) == sorted(two.collect(), key=tuple) or sorted(
        map(str, one.select(two.columns).collect())
    ) == sorted(map(str, two.collect()))


@pytest.mark.parametrize(
    "days",
    [[day(n, 3, 2022) for n in range(11, 16)], [day(n, 11, 2022) for n in range(4, 10)]],
)
def test_clock_changes_do_not_matter(spark, days):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        rows = spark.createDataFrame([(1, d, 1) for d in days], "account_number long, event_date date, n long")
        got = counts.trailing_sums(rows, "n", [2], "n_").orderBy("event_date").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.n_2 for r in got] == [None, 1] + [2] * (len(days) - 2)


def test_unknown_account_keeps_its_rows(spark):
    panel = spark.createDataFrame(
        [(None, day(1), "a"), (None, day(2), "b"), (1, day(1), "c")],
        "account_number long, event_date date, mac string",
    )
    cases = spark.createDataFrame(
        [(None, day(1)), (1, day(1))], "account_number long, creation_time date"
    )
    got = {r.mac: r for r in counts.add_contact_history(panel, cases, windows=[5]).collect()}
    assert got["a"].call_count_0 == 0  # an unknown account has no cases of its own
    assert got["b"].call_count_5 == 0
    assert got["c"].call_count_0 == 1


def test_two_modems_count_a_case_twice_in_history(spark):
    panel = spark.createDataFrame(
        [(1, day(d), m) for d in (1, 2) for m in "ab"],
        "account_number long, event_date date, mac string",
    )
    cases = spark.createDataFrame([(1, day(1))], "account_number long, creation_time date")
    got = counts.add_contact_history(panel, cases, windows=[5]).where("event_date = '2024-01-02'")
    assert [r.call_count_5 for r in got.collect()] == [2, 2]


@pytest.mark.parametrize("spread", [False, True])
def test_repeat_rows(spark, spread):
    times = [0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 3 * CHUNK + 7, None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(times)], "id long, n long")
    got = dict(repeat_rows(df, "n", spread).groupBy("id").count().collect())
    assert got == {i: n for i, n in enumerate(times) if n}
