import uuid

import pytest

from ringcast.operators.panel import modem_panel
from ringcast.sources.bucketed import MODEM_TABLES, bucketed_feeds


@pytest.fixture(scope="module")
def stored(spark, feeds, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bucketed"))
    return bucketed_feeds(feeds, f"t_{uuid.uuid4().hex}", folder, buckets=4)


def joined(feeds):
    return modem_panel(*[getattr(feeds, name) for name in MODEM_TABLES])


def test_the_join_of_stored_tables_moves_no_rows(spark, feeds, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [joined(f)._jdf.queryExecution().executedPlan().toString() for f in (stored, feeds)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plans[0] and plans[0].count("SortMergeJoin") == 4
    assert "Exchange" in plans[1]


def test_the_panel_is_the_same(feeds, stored):
    columns = joined(feeds).columns
    got, wanted = (sorted(map(str, joined(f).select(columns).collect())) for f in (stored, feeds))
    assert got == wanted and got


def test_days_are_appended(spark, feeds, tmp_path):
    day = feeds.accessibility.selectExpr("min(event_date)").first()[0]
    name, folder = f"t_{uuid.uuid4().hex}", str(tmp_path)
    early = feeds.accessibility.where(f"event_date = date '{day}'")
    late = feeds.accessibility.where(f"event_date > date '{day}'")
    from ringcast.sources.bucketed import save_bucketed

    save_bucketed(early, name, folder, 4)
    table = save_bucketed(late, name, folder, 4, mode="append")
    assert table.count() == feeds.accessibility.count()
