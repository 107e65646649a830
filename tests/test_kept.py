import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ringcast.operators.counts import HISTORY_DAYS, add_contact_history
from ringcast.plans import queries
from ringcast.plans.features import point_in_time
from ringcast.plans.kept import KeptState, on_one_day

FIRST = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """Two modems for some accounts, days without rows, cases on such days, a null account."""
    rng = random.Random(4)
    panel, cases = [], []
    for account in ("a", "b", "c", None):
        for k in range(260):
            if rng.random() < (0.5 if account == "a" else 0.06):
                panel += [(account, FIRST + dt.timedelta(k), f"m{i}") for i in range(rng.randint(1, 2))]
            if rng.random() < 0.2:
                cases += [(account, FIRST + dt.timedelta(k))] * rng.randint(1, 3)
    return (
        spark.createDataFrame(panel, "account_number string, event_date date, mac string").cache(),
        spark.createDataFrame(cases, "account_number string, creation_time date").cache(),
    )


def test_totals_equal_the_trailing_frames(spark, tables, tmp_path):
    """Days after the longest window, so that every window has lost days; one is redone."""
    panel, cases = tables
    begun = FIRST + dt.timedelta(236)
    state = KeptState(spark, str(tmp_path / "kept"))
    state.begin_counts(panel, cases, begun)
    framed = add_contact_history(panel, cases).drop("mac").distinct().collect()
    names = [f"call_count_{n}" for n in HISTORY_DAYS]
    for k in (1, 2, 2, 3, 4):
        day = begun + dt.timedelta(k)
        got = {r.account_number: [r[n] for n in names] for r in state.trailing(day).collect()}
        for r in framed:
            if r.event_date == day:
                assert got.get(r.account_number, [None] * 4) == [r[n] for n in names]
        on = panel.where(F.col("event_date") == day)
        state.advance_counts(on, cases.where(F.col("creation_time") == day), day)


def test_kept_state_equals_the_whole_history(spark, feeds, tmp_path):
    day = dt.date(2024, 1, 12)
    state = KeptState(spark, str(tmp_path / "kept"))
    state.begin(feeds, day - dt.timedelta(2))
    state.advance(feeds, day - dt.timedelta(1))
    got, wanted = (
        {r.account_number: r for r in df.collect()}
        for df in (state.features(feeds, day), point_in_time(feeds, day))
    )
    assert got.keys() == wanted.keys() and got
    for key, row in wanted.items():
        for name, value in row.asDict().items():
            if isinstance(value, float):
                assert got[key][name] == pytest.approx(value, rel=1e-9, abs=1e-12)
            else:
                assert got[key][name] == value


def test_a_missing_day_is_refused(spark, tables, tmp_path):
    panel, cases = tables
    state = KeptState(spark, str(tmp_path / "kept"))
    state.begin_counts(panel, cases, FIRST)
    with pytest.raises(FileNotFoundError, match="2024-01-04"):
        state.advance_counts(panel, cases, FIRST + dt.timedelta(4))


def test_sources_are_read_for_one_day(feeds):
    """The day reaches every scan of the panel's sources as an equality."""
    plan = on_one_day(feeds, "2024-01-12").panel()._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("EqualTo(event_date,2024-01-12)" in line for line in pushed)


def test_trailing_counts_of_all_days_meet_their_rows_in_one_join(spark, sf):
    plan = queries.trailing_kept(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
