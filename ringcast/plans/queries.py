"""Registered queries: every operator on the test tables, whole."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.functions import scalar
from ringcast.operators import counts, dataset, explain, labels, metrics, models, panel, quality
from ringcast.operators.chats import chat_history, chat_sessions
from ringcast.operators.rolling import cut_ranges, rolling_stats
from ringcast.operators.tree_paths import Node, contributions, group_paths, tree_contributions
from ringcast.plans import inference, training
from ringcast.plans.features import FEATURES, METRICS, Feeds, feature_frame, point_in_time
from ringcast.plans.kept import KeptState
from ringcast.plans.testdata import KEPT, RawTables
from ringcast.session import shared_dir, stage
from ringcast.sources import read as sources
from ringcast.sources import bucketed, publish, sinks, specs
from ringcast.streaming.refresh import batch_writer, on_new_files, rebuild_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORING_DAY = "2024-01-20"
TRAIN = ("2024-01-06", "2024-01-15")
TEST = ("2024-01-16", "2024-01-20")
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """Doubles at a fixed number of digits, for comparison between engines."""
    cut = {c: F.round(F.col(c), digits) for c in columns}
    return df.select(*[cut[c].alias(c) if c in cut else F.col(c) for c in df.columns])


def _fresh(spark: SparkSession, name: str) -> str:
    """Base folder of an output, new on every call."""
    return f"{shared_dir(spark)}/ringcast/{name}-{uuid.uuid4().hex}"


def _feeds(spark: SparkSession, sf: str) -> Feeds:
    return Feeds.read(spark, RawTables(spark, sf), KEPT)


def _read(spark: SparkSession, sf: str, spec: specs.SourceSpec, condition=None) -> DataFrame:
    return sources.read(spark, spec, RawTables(spark, sf), condition)


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return _feeds(spark, sf).panel()


def _modem_days(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of every modem-day: the narrow panel of the count and label queries."""
    return _read(spark, sf, specs.ACCESSIBILITY).select("account_number", "event_date", "mac")


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, specs.SUPPORT_CASES)


def _speech(spark: SparkSession, sf: str) -> list[DataFrame]:
    raw = RawTables(spark, sf)
    wanted = (
        specs.CONVERSATIONS, specs.SESSIONS_BOOKED, specs.SESSIONS_CATEGORIES, specs.CATEGORIES
    )
    return [sources.read(spark, spec, raw) for spec in wanted]


def _call_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.call_labels(*_speech(spark, sf), KEPT)


def _attached(spark: SparkSession, sf: str) -> DataFrame:
    return labels.attach_label(_modem_days(spark, sf), _call_labels(spark, sf))


# --- sources -----------------------------------------------------------------


@query
def scan_projected(spark, sf):
    df = _read(spark, sf, specs.ATTAINABILITY)
    return rounded(df, ["US_SPEED_ATTAINABLE_FULL", "DS_SPEED_ATTAINABLE_FULL",
                        "attainability_pct", "up_gb", "down_gb"])


@query
def scan_filtered(spark, sf):
    df = _read(spark, sf, specs.SERVICE_QUALITY, "channel_number = 0")
    return rounded(df, ["codeword_error_rate", *specs.SERVICE_QUALITY.divided])


@query
def rescale(spark, sf):
    df = _read(spark, sf, specs.SERVICE_QUALITY)
    names = list(specs.SERVICE_QUALITY.divided)
    return rounded(df, names).select("mac", "event_date", "channel_number", *names)


@query
def scan_cases(spark, sf):
    return _cases(spark, sf)


@query
def scan_wifi(spark, sf):
    return rounded(_read(spark, sf, specs.WHIX), ["whix_daily", "daily_wifi_disconnects"])


@query
def scan_usage(spark, sf):
    return _read(spark, sf, specs.USAGE_RANKED)


@query
def scan_distinct(spark, sf):
    return _read(spark, sf, specs.CONVERSATIONS)


@query
def scan_speech_sessions(spark, sf):
    return _read(spark, sf, specs.SESSIONS_BOOKED)


@query
def scan_chat(spark, sf):
    return _read(spark, sf, specs.CHAT_SESSIONS)


@query
def scan_whole(spark, sf):
    return _read(spark, sf, specs.ACCOUNTS, "c_acctbal > 0")


@query
def load_all(spark, sf):
    raw = RawTables(spark, sf)
    sized = []
    families = {"modem": specs.MODEM_HEALTH, "usage": specs.USAGE, "wifi": specs.WIFI,
                "support": specs.SUPPORT, "speech": specs.SPEECH, "chat": specs.CHAT,
                "customers": specs.CUSTOMERS}
    for family, members in families.items():
        for name, df in sources.read_all(spark, members, raw).items():
            sized.append(df.agg(
                F.lit(family).alias("family"), F.lit(name).alias("source"),
                F.lit(len(df.columns)).alias("n_columns"), F.count(F.lit(1)).alias("n_rows"),
            ))
    return reduce(DataFrame.unionByName, sized)


@query
def label_views(spark, sf):
    """The label script: four views over each other, and the table of their join."""
    conversations, booked, session_categories, categories = _speech(spark, sf)
    kept = labels.session_categories(session_categories, categories, KEPT)
    sources.register_views({
        "cat_name": kept,
        "sessions_booked_cleaned": booked.select("speech_id", "sid").distinct(),
        "sum_fct_cleaned": conversations.select("speech_id", "account_number", "event_date").distinct(),
    })
    sources.register_views({
        "inter_table": spark.sql(
            "select * from sum_fct_cleaned join sessions_booked_cleaned using (speech_id)"
        )
    })
    return spark.sql(
        "select account_number, event_date, category_name from inter_table join cat_name using (sid)"
    )


@query
def views(spark, sf):
    raw = RawTables(spark, sf)
    sources.register_views({
        "v_cases": sources.read(spark, specs.SUPPORT_CASES, raw),
        "v_wifi": sources.read(spark, specs.WHIX, raw),
    })
    return spark.sql(
        "select creation_time as event_date, count(*) as n_cases from v_cases "
        "where creation_time in (select event_date from v_wifi) group by creation_time"
    )


# --- panel -------------------------------------------------------------------


@query
def key_normalize(spark, sf):
    df = _read(spark, sf, specs.ACCESSIBILITY)
    return df.select("mac", "event_date", scalar.gateway_mac("mac").alias("gw_mac"))


@query
def panel_inner(spark, sf):
    return _inner(
        _read(spark, sf, specs.ACCESSIBILITY),
        _read(spark, sf, specs.SERVICE_QUALITY, "channel_number = 0"),
        _read(spark, sf, specs.ATTAINABILITY),
        _read(spark, sf, specs.INTERMITTENCY),
        _read(spark, sf, specs.USAGE_RANKED),
    )


def _inner(*tables):
    names = ["account_number", "event_date", "mac", *METRICS[:-3]]
    joined = panel.modem_panel(*tables).select(*names)
    return rounded(joined, [m for m in METRICS[:-3] if m not in INTEGERS])


@query
def panel_bucketed(spark, sf):
    """The same from tables stored by modem and day."""
    name, folder = f"modem_{uuid.uuid4().hex}", _fresh(spark, "bucketed")
    stored = bucketed.bucketed_feeds(_feeds(spark, sf), name, folder, buckets=8)
    return _inner(*[getattr(stored, t) for t in bucketed.MODEM_TABLES])


# metrics that count something
INTEGERS = (
    "outage_count", "transitions", "Offline_counts", "hsi_down_1d_rank", "hsi_up_1d_rank",
    "IPTV_Down_1D_rank", "IPTV_Up_1D_rank", "RHP_Down_1D_rank", "RHP_Up_1D_rank",
    "COUNT_DAILY_GW_WIFI_TOOHOT",
)


@query
def wifi_left_fill(spark, sf):
    joined = panel.add_wifi(
        _modem_days(spark, sf).drop("account_number"), _read(spark, sf, specs.WHIX)
    )
    return rounded(joined.drop("gw_mac"), ["whix_daily", "daily_wifi_disconnects"])


# --- rolling statistics ------------------------------------------------------


def _rolling(spark, sf, stat, metrics_=METRICS, rows=14, parts=None):
    ranged = cut_ranges(_panel(spark, sf), parts=parts)
    keys = ["account_number", "event_date", "mac"]
    out = rolling_stats(ranged, metrics_, [stat], rows, keep=keys)
    return rounded(out, [f"{m}_{stat}" for m in metrics_])


@query
def rolling_avg(spark, sf):
    return _rolling(spark, sf, "avg")


@query
def rolling_var(spark, sf):
    return _rolling(spark, sf, "var")


@query
def rolling_m4(spark, sf):
    return _rolling(spark, sf, "kurtosis")


@query
def rolling_sum(spark, sf):
    return _rolling(spark, sf, "sum")


@query
def rolling_max(spark, sf):
    return _rolling(spark, sf, "max")


@query
def rolling_legacy_frame(spark, sf):
    return _rolling(spark, sf, "avg", rows=20)


@query
def rolling_split_accounts(spark, sf):
    """So many ranges that accounts lie in several."""
    return _rolling(spark, sf, "var", parts=97)


# --- contact counts ----------------------------------------------------------


@query
def same_day_count(spark, sf):
    return counts.add_same_day(_modem_days(spark, sf), _cases(spark, sf))


@query
def same_day_count_compat(spark, sf):
    return counts.add_same_day(_modem_days(spark, sf), _cases(spark, sf), compat=True)


def _order_history(spark, sf, windows, compat=False):
    """Orders as panel rows, urgent orders as contacts: seven years, for long frames."""
    orders = RawTables(spark, sf).load("orders")
    rows = orders.select(
        F.col("o_custkey").alias("account_number"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("o_orderkey").alias("mac"),
    )
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("account_number"),
        F.col("o_orderdate").cast("date").alias("creation_time"),
    )
    return counts.add_contact_history(rows, urgent, windows, compat=compat)


@query
def trailing_10(spark, sf):
    return _order_history(spark, sf, [10])


@query
def trailing_30(spark, sf):
    return _order_history(spark, sf, [30])


@query
def trailing_60(spark, sf):
    return _order_history(spark, sf, [60])


@query
def trailing_120(spark, sf):
    return _order_history(spark, sf, [120])


@query
def trailing_compat(spark, sf):
    return _order_history(spark, sf, [30, 120], compat=True)


@query
def trailing_kept(spark, sf):
    """Trailing counts of every day from kept totals, each moved on by one day."""
    rows, cases = stage(_modem_days(spark, sf), "modem-days"), stage(_cases(spark, sf), "cases")
    state = KeptState(spark, _fresh(spark, "kept"))
    days = [r.event_date for r in rows.select("event_date").distinct().orderBy("event_date").collect()]
    found = []
    for day in [days[0] + dt.timedelta(k) for k in range((days[-1] - days[0]).days + 1)]:
        on = rows.where(F.col("event_date") == day)
        if day == days[0]:
            state.begin_counts(rows, cases, day - dt.timedelta(1))
        found.append(state.trailing(day).withColumn("event_date", F.lit(day)))
        state.advance_counts(on, cases.where(F.col("creation_time") == day), day)
    # one join for all days: a join for each would leave all of them to the tasks of one union
    seen = rows.where(F.col("event_date").isNotNull()).select("account_number", "event_date").distinct()
    trailing = reduce(DataFrame.unionByName, found)
    joined = seen.join(trailing, ["account_number", "event_date"], "left")
    return joined.select("account_number", *trailing.columns[1:-1], "event_date")


@query
def trailing_of_column(spark, sf):
    """Trailing sums of a panel's own column, on two modems per account."""
    staged = stage(_panel(spark, sf).select("account_number", "event_date", "mac", "outage_count"), "outages")
    return counts.add_trailing(staged, "outage_count", [5, 10], "outages_")


# --- labels ------------------------------------------------------------------


@query
def session_category(spark, sf):
    _, _, named, categories = _speech(spark, sf)
    return labels.session_categories(named, categories, KEPT)


@query
def label_key1(spark, sf):
    return labels.call_labels(*_speech(spark, sf), KEPT, rules=["speech_id"])


@query
def label_key2(spark, sf):
    return labels.call_labels(*_speech(spark, sf), KEPT, rules=["unit_and_session"])


@query
def label_union_distinct(spark, sf):
    return _call_labels(spark, sf)


@query
def ground_truth_rule1(spark, sf):
    return labels.ground_truth(*_speech(spark, sf), KEPT)


@query
def ground_truth_table(spark, sf):
    """The same, saved as a catalog table and read back by name."""
    truth = labels.ground_truth(*_speech(spark, sf), KEPT)
    sinks.save_table(truth, "ringcast_ground_truth", "overwrite", _fresh(spark, "table"))
    return sources.read_dataset(spark, "ringcast_ground_truth")


@query
def label_attach(spark, sf):
    return _attached(spark, sf)


@query
def case_label(spark, sf):
    return labels.case_label(_modem_days(spark, sf), _cases(spark, sf))


@query
def next_day_case_label(spark, sf):
    return labels.next_day_case_label(
        _modem_days(spark, sf), _cases(spark, sf), ["Tech"], ["Ticket", "Truck"]
    )


def _labelled(spark, sf):
    return stage(_attached(spark, sf), "labelled")


@query
def forward_label(spark, sf):
    return labels.forward_label(_labelled(spark, sf)).drop("label_complete")


@query
def forward_label_legacy(spark, sf):
    cased = stage(labels.case_label(_modem_days(spark, sf), _cases(spark, sf)), "cased")
    return labels.forward_label(cased, "target_icm", 15).drop("label_complete")


@query
def label_complete(spark, sf):
    done = labels.forward_label(_labelled(spark, sf), days=5)
    return done.select("mac", "event_date", "category_name", "target", "label_complete")


# --- chats -------------------------------------------------------------------


def _chats(spark, sf):
    raw = RawTables(spark, sf)
    return chat_sessions(*[
        sources.read(spark, s, raw)
        for s in (specs.CHAT_SESSIONS, specs.CHAT_ACCOUNTS, specs.CHAT_TRANSCRIPTS)
    ])


@query
def chat_join(spark, sf):
    return _chats(spark, sf)


@query
def chat_case_history(spark, sf):
    return chat_history(_chats(spark, sf), _cases(spark, sf))


@query
def chat_own_history(spark, sf):
    """Chats count earlier chats instead of cases."""
    chats = stage(_chats(spark, sf), "chats")
    return chat_history(chats, chats.select("account_number", "chat_date"), day="chat_date")


@query
def chat_compat(spark, sf):
    return chat_history(_chats(spark, sf), _cases(spark, sf), compat=True)


# --- datasets ----------------------------------------------------------------


@query
def date_split(spark, sf):
    train, test = dataset.time_split(_read(spark, sf, specs.ACCESSIBILITY), TRAIN, TEST)
    keys = ["account_number", "event_date", "mac"]
    return train.select(*keys, F.lit("train").alias("part")).unionByName(
        test.select(*keys, F.lit("test").alias("part"))
    )


def _targets(spark, sf):
    """Narrow labelled rows of the training days."""
    return labels.forward_label(_labelled(spark, sf), days=3).drop("window", "label_complete")


@query
def balance_undersample(spark, sf):
    return dataset.undersample(stage(_targets(spark, sf), "targets"))


@query
def test_cap(spark, sf):
    """500 events of lowest hash: the cut falls inside a hash group."""
    events = RawTables(spark, sf).load("events").select("event_id", "user_id", "event_type")
    return dataset.take_hashed(events, 500, ["event_id"])


@query
def bernoulli_sample(spark, sf):
    return dataset.bernoulli_sample(_targets(spark, sf), 0.5, seed=7)


@query
def stratified_sample(spark, sf):
    return dataset.stratified_sample(_targets(spark, sf), "target", {1: 0.2, 0: 0.05}, seed=7)


@query
def random_split(spark, sf):
    parts = dataset.random_split(_targets(spark, sf), [0.7, 0.1, 0.2], seed=1234)
    return reduce(DataFrame.unionByName, [
        part.select("account_number", "event_date", "mac", "category_name", F.lit(i).alias("part"))
        for i, part in enumerate(parts)
    ])


@query
def legacy_balance(spark, sf):
    """Stratified sample, then half of the negatives, as many as positives."""
    targets = stage(dataset.stratified_sample(_targets(spark, sf), "target", {1: 0.4, 0: 0.4}, seed=1), "strata")
    positives = targets.where("target = 1")
    half = dataset.bernoulli_sample(targets.where("target = 0"), 0.5, seed=2)
    return dataset.take_hashed(half, positives.count()).unionByName(positives)


@query
def class_profile(spark, sf):
    """Rows of both classes in the two parts, and on all days."""
    targets = stage(_targets(spark, sf), "targets")
    train, test = dataset.time_split(targets, TRAIN, TEST)
    return dataset.class_profile({"train": train, "test": test, "all": targets})


def _history(spark, sf):
    """Contact history with NULLs where an account has no earlier rows."""
    return counts.add_contact_history(_modem_days(spark, sf), _cases(spark, sf))


@query
def fill_zero(spark, sf):
    return dataset.fill_zero(_history(spark, sf))


@query
def drop_null(spark, sf):
    return dataset.drop_null(_history(spark, sf))


@query
def dedupe_account(spark, sf):
    rows = _read(spark, sf, specs.ACCESSIBILITY).select(
        "account_number", "event_date", "mac", "outage_count"
    )
    return dataset.one_per_account(labels.attach_label(rows, _call_labels(spark, sf)))


# --- quality -----------------------------------------------------------------


@query
def presence_check(spark, sf):
    """The last day has fewer rows; the day after it has none."""
    checked = _feeds(spark, sf).checked()
    return quality.presence(checked, "2024-01-30").withColumn("day", F.lit("2024-01-30")).unionByName(
        quality.presence(checked, "2024-01-31").withColumn("day", F.lit("2024-01-31"))
    )


@query
def batch_date(spark, sf):
    return quality.batch_date(_read(spark, sf, specs.ACCESSIBILITY)).select(
        "batch_date", scalar.iso_day("batch_date").alias("date_part")
    )


# --- metrics -----------------------------------------------------------------


def _scored_events(spark, sf):
    events = RawTables(spark, sf).load("events")
    return events.select(
        (F.col("event_type") == "error").cast("int").alias("target"),
        F.col("value").alias("score"),
        (F.col("value") > 50).cast("int").alias("pred"),
    )


@query
def precision_recall(spark, sf):
    return rounded(metrics.precision_recall(_scored_events(spark, sf)), ["precision", "recall"], 9)


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_scored_events(spark, sf)), ["roc_auc"], 9)


@query
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(_scored_events(spark, sf)), ["fpr", "tpr"], 9)


@query
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(_scored_events(spark, sf)), ["precision", "recall"], 9)


@query
def score_record(spark, sf):
    record = metrics.score_record(_scored_events(spark, sf), TRAIN, TEST, "2024-02-01")
    return rounded(record, ["AUC", "precision", "recall"], 9)


# --- whole plans -------------------------------------------------------------

CONTINUOUS = tuple(c for c in FEATURES if not c.startswith("call_count_"))


@query
def feature_panel(spark, sf):
    """All 73 columns for every modem-day."""
    return rounded(feature_frame(_feeds(spark, sf)), CONTINUOUS)


@query
def feature_days(spark, sf):
    """The same for some days only, from a slice of the history."""
    return rounded(feature_frame(_feeds(spark, sf), *TEST), CONTINUOUS)


@query
def feature_panel_compat(spark, sf):
    return rounded(feature_frame(_feeds(spark, sf), compat=True, with_mac=True), CONTINUOUS)


@query
def point_in_time_day(spark, sf):
    return rounded(point_in_time(_feeds(spark, sf), SCORING_DAY), CONTINUOUS)


@query
def empty_batch_refused(spark, sf):
    """For every case day, whether the modem rows of that day are refused as an empty batch."""
    rows = stage(_modem_days(spark, sf), "modem-days")
    days = _cases(spark, sf).select("creation_time").distinct().collect()
    found = []
    for day in [r.creation_time for r in days]:
        try:
            quality.require_rows(dataset.on_day(rows, day), str(day))
            found.append((day, False))
        except ValueError:
            found.append((day, True))
    return spark.createDataFrame(found, "event_date date, refused boolean")


@query
def unknown_stat_refused(spark, sf):
    """Which statistics are refused, of the known ones and the table's event types."""
    events = RawTables(spark, sf).load("events").select("event_type").distinct().collect()
    ranged = cut_ranges(_panel(spark, sf).select("account_number", "event_date", "mac", "outage_count"))
    found = []
    for name in [*[r.event_type for r in events], "avg", "var", "kurtosis", "sum", "max"]:
        try:
            rolling_stats(ranged, ["outage_count"], [name])
            found.append((name, False))
        except ValueError:
            found.append((name, True))
    return spark.createDataFrame(found, "stat string, refused boolean")


@query
def scoring_dates(spark, sf):
    """The day that each day of the table stands for as a stamp, and the lag of "Today"."""
    days = _modem_days(spark, sf).select("event_date").distinct().collect()
    lag = (dt.date.today() - scalar.scoring_date("Today")).days
    found = [(r.event_date, scalar.scoring_date(str(r.event_date)), lag) for r in days]
    return spark.createDataFrame(found, "event_date date, scored date, lag int")


@query
def kept_state_day(spark, sf):
    """Features of a day from kept state that was moved on by two days."""
    feeds = _feeds(spark, sf)
    state, day = KeptState(spark, _fresh(spark, "kept")), dt.date.fromisoformat(SCORING_DAY)
    state.begin(feeds, day - dt.timedelta(3))
    for ago in (2, 1):
        state.advance(feeds, day - dt.timedelta(ago))
    return rounded(state.features(feeds, day), CONTINUOUS)


@query
def inference_frame(spark, sf):
    return rounded(inference.inference_frame(_feeds(spark, sf), SCORING_DAY), CONTINUOUS)


def _dataset(spark, sf):
    return training.build_dataset(_feeds(spark, sf), TRAIN, TEST, window=3)


def _labelled_days(spark, sf):
    return stage(training.labelled_frame(_feeds(spark, sf), TRAIN, TEST, window=3), "dataset")


@query
def training_set(spark, sf):
    half = training.training_half(_labelled_days(spark, sf), TRAIN, training.DATASET_COLUMNS)
    return rounded(half, CONTINUOUS)


@query
def testing_set(spark, sf):
    half = training.testing_half(_labelled_days(spark, sf), TEST, training.DATASET_COLUMNS)
    return rounded(half, CONTINUOUS)


# --- models (rows only: fitted values differ between libraries) --------------


def _learning_rows(train_df: DataFrame) -> DataFrame:
    """Training rows as a staged table: a fit passes over them often, and every partition
    of the balanced halves would send statistics of all nodes."""
    return stage(dataset.fill_zero(train_df), "train")


def _train(spark, sf, kind) -> training.Trained:
    train_df, test_df = _dataset(spark, sf)
    return training.train(train_df, test_df, [kind], (*TRAIN, *TEST), "zero")[kind]


@query
def rf_score(spark, sf):
    return _train(spark, sf, "rf").scored


@query
def gbt_score(spark, sf):
    return _train(spark, sf, "gbt").scored


@query
def stack_score(spark, sf):
    return _train(spark, sf, "stack").scored


@query
def training_record(spark, sf):
    return _train(spark, sf, "rf").record


@query
def importances(spark, sf):
    return explain.importances(spark, _train(spark, sf, "rf").model)


@query
def global_surrogate(spark, sf):
    trained = _train(spark, sf, "rf")
    return explain.global_surrogate(trained.scored, models.feature_order(trained.model))


@query
def local_contrib(spark, sf):
    trained = _train(spark, sf, "rf")
    return tree_contributions(trained.scored, trained.model)[0]


@query
def saved_model_score(spark, sf):
    """A model saved under a dated name, loaded and applied."""
    train_df, test_df = _dataset(spark, sf)
    fitted = models.fit(_learning_rows(train_df), "rf")
    path = sinks.save_model(fitted, _fresh(spark, "models"), "rf", dt.date(2024, 2, 1))
    return models.score(test_df, sinks.load_model(path))


# what is exact about fitted models: the rows scored, ranges, agreement, sums


def _score_facts(df: DataFrame) -> DataFrame:
    """Keys of the scored rows, and whether score and class are sound."""
    return df.select(
        "account_number", "event_date", "category_name", "target",
        F.col("score").between(0, 1).alias("in_range"),
        # of a tie either class may be taken
        ((F.col("score") == 0.5) | ((F.col("score") > 0.5) == (F.col("pred") == 1))).alias("agrees"),
    )


@query
def rf_score_facts(spark, sf):
    return _score_facts(_train(spark, sf, "rf").scored)


@query
def gbt_score_facts(spark, sf):
    return _score_facts(_train(spark, sf, "gbt").scored)


@query
def stack_score_facts(spark, sf):
    return _score_facts(_train(spark, sf, "stack").scored)


@query
def saved_model_agrees(spark, sf):
    """Scores of a model saved and loaded, next to those of the model itself."""
    train_df, test_df = _dataset(spark, sf)
    test_df = stage(test_df, "saved-test")
    fitted = models.fit(_learning_rows(train_df), "rf")
    path = sinks.save_model(fitted, _fresh(spark, "models"), "rf", dt.date(2024, 2, 1))
    keys = ["account_number", "event_date", "category_name"]
    scored = [
        models.score(test_df, m).groupBy(*keys).agg(
            F.array_sort(F.collect_list("score")).alias(name)
        )
        for name, m in (("own", fitted), ("loaded", sinks.load_model(path)))
    ]
    same = reduce(lambda a, b: a.join(b, keys, "full"), scored)
    return same.select(*keys, F.col("own").eqNullSafe(F.col("loaded")).alias("same"))


@query
def importance_facts(spark, sf):
    """Importances of a forest and of its surrogate: features named, and their sum."""
    trained = _train(spark, sf, "rf")
    order = models.feature_order(trained.model)
    tables = {
        "model": explain.importances(spark, trained.model),
        "surrogate": explain.global_surrogate(trained.scored, order),
    }
    return reduce(DataFrame.unionByName, [
        df.agg(
            F.lit(name).alias("kind"), F.countDistinct("feature").alias("n_features"),
            F.round(F.sum("importance"), 6).alias("total"),
        )
        for name, df in tables.items()
    ])


@query
def local_contrib_exact(spark, sf):
    """Contributions to a score that is a line in one column plus a part off the line."""
    rows = _modem_days(spark, sf).join(
        _read(spark, sf, specs.ACCESSIBILITY).select("mac", "event_date", "outage_count"),
        ["mac", "event_date"],
    )
    off = F.pmod(F.day("event_date"), F.lit(3)) / 100
    scored = rows.withColumn("score", 0.3 + F.col("outage_count") / 50 + off)
    out = explain.local_contributions(
        scored, ["outage_count"], ["account_number", "event_date", "mac"]
    )
    return rounded(out, ["outage_count"], 4)


@query
def local_contrib_sums(spark, sf):
    """Whether each row's contributions and the base give the score of the forest."""
    trained = _train(spark, sf, "rf")
    keys = ["account_number", "event_date", "category_name", "score"]
    table, base = tree_contributions(trained.scored, trained.model, keys)
    total = sum((F.col(f"`{c}`") for c in models.feature_order(trained.model)), F.lit(base))
    return table.select(*keys[:3], (F.abs(total - F.col("score")) < 1e-9).alias("same"))


@query
def global_explanation(spark, sf):
    """Sizes of path contributions, the surrogate's importances, and its fidelity."""
    trained = _train(spark, sf, "rf")
    return explain.global_explanation(trained.scored, trained.model)


@query
def fidelity_facts(spark, sf):
    """Rows a surrogate was fitted to and held out from, and whether it beats these rows' mean."""
    trained = _train(spark, sf, "rf")
    keys = ["account_number", "event_date", "category_name"]
    found = explain.fidelity(trained.scored, models.feature_order(trained.model), keys)
    return found.select("n_fitted", "n_held_out", ((F.col("r2") > 0) & (F.col("r2") <= 1)).alias("explains"))


@query
def tree_global_exact(spark, sf):
    """Mean sizes of the contributions of ``tree_contrib_exact``."""
    made = explain.mean_contributions(_tree_contributions(spark, sf), ["outage_count", "transitions"])
    return rounded(made, ["mean_abs"], 9)


@query
def tree_contrib_exact(spark, sf):
    return rounded(_tree_contributions(spark, sf), ["outage_count", "transitions"], 9)


def _tree_contributions(spark, sf):
    """Contributions in a tree whose covers and leaves are counts and means of the table."""
    keys = ["mac", "event_date"]
    rows = (
        _read(spark, sf, specs.ACCESSIBILITY).select("account_number", *keys, "outage_count")
        .join(_read(spark, sf, specs.INTERMITTENCY).select(*keys, "transitions"), keys)
    )
    outage, cuts = F.col("outage_count") > 0, {False: 1, True: 2}
    often = F.col("transitions") > F.when(outage, cuts[True]).otherwise(cuts[False])
    leaves = {
        (r.outage, r.often): Node(r.n, r.value)
        for r in rows.groupBy(outage.alias("outage"), often.alias("often")).agg(
            F.count("*").alias("n"), F.avg(F.day("event_date") % 3).alias("value")
        ).collect()
    }
    leaf = [leaves.get((a, b), Node(0)) for a in (False, True) for b in (False, True)]
    below = [leaf[0].cover + leaf[1].cover, leaf[2].cover + leaf[3].cover]
    tree = {
        0: Node(sum(below), 0.0, 0, 0.0, 1, 2),
        1: Node(below[0], 0.0, 1, cuts[False], 3, 4),
        2: Node(below[1], 0.0, 1, cuts[True], 5, 6),
        **dict(enumerate(leaf, 3)),
    }
    features = ["outage_count", "transitions"]
    _, groups = group_paths([tree], [1.0])
    return contributions(rows, features, groups, ["account_number", *keys])


# --- whole jobs --------------------------------------------------------------


@query
def inference_job(spark, sf):
    """Rows of the archives that a scoring run leaves: features, scores, explanations."""
    out = _fresh(spark, "inference")
    train_df, _ = _dataset(spark, sf)
    model = models.fit(_learning_rows(train_df), "rf")
    inference.run_inference(spark, _feeds(spark, sf), model, out, SCORING_DAY)
    found = []
    for name in ("features", "scores", "explanations"):
        for place, path in (("ARCHIVE", f"ARCHIVE/DATE_PART={SCORING_DAY}"), ("LATEST", "LATEST")):
            rows = spark.read.parquet(f"{out}/{name}/{path}")
            found.append(rows.select(
                F.col("account_number").cast("string").alias("account_number"), "event_date",
                F.lit(name).alias("output"), F.lit(place).alias("place"),
                F.lit(len(rows.columns)).alias("n_columns"),
            ))
    return reduce(DataFrame.unionByName, found)


@query
def dataset_job(spark, sf):
    """The written training and test sets, read back."""
    out = _fresh(spark, "dataset")
    training.build_dataset(_feeds(spark, sf), TRAIN, TEST, window=3, out=out)
    parts = [
        spark.read.parquet(f"{out}/{name}").withColumn("part", F.lit(name))
        for name in ("train", "test")
    ]
    return rounded(reduce(DataFrame.unionByName, parts), CONTINUOUS)


@query
def training_job(spark, sf):
    """What a training run leaves: profile, record of scores, surrogate."""
    out, day = _fresh(spark, "training"), dt.date(2024, 2, 1)
    train_df, test_df = _dataset(spark, sf)
    training.train(train_df, test_df, ["rf"], (*TRAIN, *TEST), "zero", out, day)
    profile = spark.read.parquet(f"{out}/profile").select(
        F.concat_ws(" ", F.lit("profile"), "dataset", "target").alias("fact"),
        F.col("n_rows").cast("long").alias("n"),
    )
    record = spark.read.parquet(f"{out}/training_scores/rf/ARCHIVE/DATE_PART={day}")
    sound = reduce(lambda a, b: a & b, [F.col(c).between(0, 1) for c in ("AUC", "precision", "recall")])
    record = record.select(
        F.concat_ws(" ", F.lit("record"), "event_date", "train_start_date", "test_end_date").alias("fact"),
        sound.cast("long").alias("n"),
    )
    surrogate = spark.read.parquet(f"{out}/explanations/rf").agg(
        F.lit("surrogate features").alias("fact"), F.countDistinct("feature").alias("n")
    )
    return profile.unionByName(record).unionByName(surrogate)


# --- sinks and streaming -----------------------------------------------------


def _by_day(spark, sf) -> tuple[DataFrame, list[dt.date]]:
    rows = _read(spark, sf, specs.ACCESSIBILITY).select("account_number", "event_date", "mac", "outage_count")
    staged = stage(rows, "access")
    days = staged.select("event_date").distinct().orderBy("event_date").collect()
    return staged, [r.event_date for r in days]


@query
def latest_archive_roundtrip(spark, sf):
    """Every day archived, the first of them again: LATEST and all partitions read back."""
    base = _fresh(spark, "archive")
    staged, days = _by_day(spark, sf)
    for day in [*days, days[0]]:
        sinks.write_latest_archive(dataset.on_day(staged, day), base, batch_date=day)
    archive = spark.read.parquet(f"{base}/ARCHIVE").withColumn("place", F.lit("ARCHIVE"))
    latest = spark.read.parquet(f"{base}/LATEST").withColumn("DATE_PART", F.lit(None).cast("date"))
    return archive.unionByName(latest.withColumn("place", F.lit("LATEST")))


@query
def published_days(spark, sf):
    """Every day published, the first of them again: it does not hide the latest."""
    base = _fresh(spark, "published")
    staged, days = _by_day(spark, sf)
    for day in [*days, days[0]]:
        on = dataset.on_day(staged, day)
        publish.publish({"rows": on, "accounts": on.groupBy("account_number").count()}, base, day)
    archive = publish.read_archive(spark, base, "rows").withColumn("place", F.lit("ARCHIVE"))
    latest = publish.read_latest(spark, base, "rows").withColumn("DATE_PART", F.lit(None).cast("date"))
    return archive.unionByName(latest.withColumn("place", F.lit("LATEST")))


@query
def metrics_log(spark, sf):
    path = _fresh(spark, "log")
    for day in (SCORING_DAY, TEST[0]):
        on = quality.presence(_feeds(spark, sf).checked(), day).withColumn("day", F.lit(day))
        sinks.log_metrics(on, path)
    return spark.read.parquet(path)


@query
def single_file_write(spark, sf):
    path = _fresh(spark, "single")
    sinks.write_parquet(_read(spark, sf, specs.SUPPORT_CASES), path, rows_per_file=1_000_000)
    return sources.read_dataset(spark, path)


@query
def new_file_refresh(spark, sf):
    """Events stream in as files; each batch adds its case counts."""
    out, checkpoint = _fresh(spark, "refresh"), _fresh(spark, "stream")
    schema = RawTables(spark, sf).load("events").schema

    def cases(rows: DataFrame) -> DataFrame:
        signups = rows.where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("account_number"), F.col("ts").cast("date").alias("creation_time")
        )
        return counts.daily_counts(signups)

    on_new_files(spark, sf, schema, batch_writer(out, cases), checkpoint, pattern="events.parquet")
    return (
        spark.read.parquet(out)
        .groupBy("account_number", "event_date")
        .agg(F.sum("call_count_0").alias("call_count_0"))
    )


@query
def days_refreshed(spark, sf):
    """Case counts by day, kept up to date as files with rows of many days come in."""
    landing, out, checkpoint = (_fresh(spark, n) for n in ("landing", "refreshed", "stream"))
    files = _fresh(spark, "files")
    cases = _cases(spark, sf).select("account_number", F.col("creation_time").alias("event_date"))
    # late rows: each file holds some accounts of all days
    cases.repartition(3, "account_number").write.parquet(files)

    def trailing(landed: DataFrame, days: Sequence[dt.date]) -> DataFrame:
        reach = landed.where(F.col("event_date").between(days[0] - dt.timedelta(10), days[-1]))
        daily = counts.daily_counts(reach, day="event_date")
        sums = counts.trailing_sums(daily, "call_count_0", [10], "call_count_")
        return sums.where(F.col("event_date").isin(list(days)))

    action = rebuild_days(landing, out, trailing, ahead=10)
    on_new_files(spark, files, cases.schema, action, checkpoint, files_per_batch=1)
    return spark.read.parquet(out).drop("DATE_PART")
