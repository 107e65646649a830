import datetime as dt

from pyspark.sql import functions as F

from ringcast.operators import dataset, labels


def day(n):
    return dt.date(2024, 1, n)


def panel(spark, days, account=1, mac="a"):
    return spark.createDataFrame(
        [(account, day(n), mac) for n in days], "account_number long, event_date date, mac string"
    )


def speech(spark):
    conversations = spark.createDataFrame(
        [("1000010CHAN0001", 1, day(1)), ("100002000000007", 2, day(20)), ("999999zzz", 3, day(2))],
        "speech_id string, account_number long, event_date date",
    ).withColumns({"speech_unit": F.expr("left(speech_id, 6)"), "speech_session": F.expr("right(speech_id, 9)")})
    booked = spark.createDataFrame(
        [("000000005", "100001", "1000010CHAN0001"), ("000000007", "100002", "1000020XXXXXXXX")],
        "sid string, unit_num string, speech_id string",
    )
    named = spark.createDataFrame(
        [("000000005", 1), ("000000005", 2), ("000000005", 9), ("000000007", 1)],
        "sid string, category_key long",
    )
    categories = spark.createDataFrame(
        [(1, "Tech"), (2, "Outage"), (9, "Sales")], "category_key long, category_name string"
    )
    return conversations, booked, named, categories


def test_key_rules(spark):
    sources, kept = speech(spark), ["Tech", "Outage"]
    first = labels.call_labels(*sources, kept, rules=["speech_id"]).collect()
    second = labels.call_labels(*sources, kept, rules=["unit_and_session"]).collect()
    both = labels.call_labels(*sources, kept).collect()
    assert {(r[0], r[2]) for r in first} == {(1, "Tech"), (1, "Outage")}
    assert {(r[0], r[2]) for r in second} == {(2, "Tech")}
    assert set(both) == set(first) | set(second)
    assert all(r.called == 1 for r in both)


def test_numeric_session_ids_compare_as_text(spark):
    conversations, booked, named, categories = speech(spark)
    numeric = booked.withColumn("unit_num", F.col("unit_num").cast("long"))
    got = labels.call_labels(conversations, numeric, named, categories, ["Tech"], ["unit_and_session"])
    assert got.count() == 1


def test_hot_session_key_stays_small(spark):
    """Many copies on both sides of a key meet once per category, not pairwise."""
    conversations, booked, named, categories = speech(spark)
    copies = spark.range(300).select(
        F.format_string("%09d", "id").alias("sid"), F.lit("100001").alias("unit_num"),
        F.lit("1000010CHAN0001").alias("speech_id"),
    )
    many = copies.select("sid", F.lit(1).cast("long").alias("category_key"))
    got = labels.call_labels(conversations, copies, many, categories, ["Tech"], ["speech_id"])
    assert [(r[0], r[2]) for r in got.collect()] == [(1, "Tech")]


def test_several_categories(spark):
    tagged = spark.createDataFrame(
        [(1, day(1), c, 1) for c in ("C", "A", "B")],
        "account_number long, event_date date, category_name string, called int",
    )
    attached = labels.attach_label(panel(spark, [1, 2]), tagged)
    assert attached.where("event_date = '2024-01-01'").count() == 3
    assert attached.where("event_date = '2024-01-02'").first().category_name == "no_call"
    one = dataset.one_per_account(attached.where("event_date = '2024-01-01'"))
    assert [r.category_name for r in one.collect()] == ["A"]


def test_forward_label(spark):
    called = panel(spark, range(1, 11)).withColumn(
        "called", F.when(F.dayofmonth("event_date") == 5, 1).otherwise(0)
    )
    got = labels.forward_label(called, days=3).orderBy("event_date").collect()
    assert [r.target for r in got] == [0, 1, 1, 1, 0, 0, 0, 0, 0, 0]
    assert [r.label_complete for r in got] == [True] * 7 + [False] * 3
    assert {r.window for r in got} == {3}


def test_call_on_a_day_without_panel_row_is_missed(spark):
    tagged = spark.createDataFrame(
        [(1, day(2), "A", 1)], "account_number long, event_date date, category_name string, called int"
    )
    attached = labels.attach_label(panel(spark, [1, 3]), tagged)
    assert {r.target for r in labels.forward_label(attached, days=5).collect()} == {0}


def test_given_horizon(spark):
    flags = panel(spark, [1, 5]).withColumn("called", F.lit(0))
    got = labels.forward_label(flags, days=2, horizon_end="2024-01-06").orderBy("event_date").collect()
    assert [r.label_complete for r in got] == [True, False]


def test_case_label_multiplies_by_level_3(spark):
    cases = spark.createDataFrame(
        [(1, day(1), "Internet", "Modem"), (1, day(1), "Internet", "Modem"),
         (1, day(1), "Internet", "RF Signal"), (1, day(2), "TV", "Modem")],
        "account_number long, creation_time date, CASE_TYPE_LVL2 string, CASE_TYPE_LVL3 string",
    )
    got = labels.case_label(panel(spark, [1, 2]), cases).orderBy("event_date").collect()
    assert [r.target_icm for r in got] == [1, 1, 0]


def test_next_day_case(spark):
    cases = spark.createDataFrame(
        [(1, day(2), "Tech", "Ticket"), (1, day(2), "Tech", "Ticket"), (2, day(3), "Tech", "Ticket")],
        "account_number long, creation_time date, CASE_TYPE_LVL1 string, X_CASE_TYPE_LVL5 string",
    )
    got = labels.next_day_case_label(panel(spark, [1, 2]), cases, ["Tech"], ["Ticket"])
    assert [r.target for r in got.orderBy("event_date").collect()] == [1, 0]
