"""The registered queries as plain SQL, for an independent engine.

Written row by row from the definitions: windows over the joined rows where the
Spark side aggregates per day, global rankings where it cuts by hash groups.
"""

from __future__ import annotations

import datetime as dt

from ringcast.plans.features import FEATURES, HISTORY_DAYS, METRICS, STATS
from ringcast.plans.queries import CONTINUOUS, INTEGERS, SCORING_DAY, TEST, TRAIN
from ringcast.plans.testdata import KEPT, UNEVEN

# weight of the fractional metrics, as in the test data adapter
W = f"{UNEVEN!r}::double"
KEPT_LIST = ", ".join(f"'{name}'" for name in KEPT)

VIEWS = f"""
ev as (
  select event_id, user_id, event_type, value, cast(ts as date) as event_date,
    'aa-bb-' || lpad(cast(user_id as varchar), 12, '0')
      || case when event_type in ('view', 'click') then '-1' else '-2' end as mac,
    cast(round(value * 100) as bigint) as cents,
    hour(ts) * 60 + minute(ts) as minute_of_day, minute(ts) as minute
  from events),
accessibility as (
  select mac, event_date, min(user_id) as account_number,
    count(*) filter (event_type = 'error') as outage_count,
    ({W} * (count(*) - count(*) filter (event_type = 'error')) / count(*)) / 100::double
      as "ACCESSIBILITY_PERC_FULL_DAY",
    ({W} * count(*) filter (minute_of_day >= 1080) / count(*)) / 100::double
      as "ACCESSIBILITY_PERC_PRIME"
  from ev group by mac, event_date),
quality_all as (
  select mac, event_date, case when value < 60 then 0 else 1 end as channel_number,
    {W} * sum(cents) / (count(*)::double * 100000) as codeword_error_rate,
    {W} * sum(cents) / (count(*)::double * 10000) / 364::double as cmts_cm_us_signal_noise_avg,
    {W} * max(cents) / 10000 / 380::double as cmts_cm_us_signal_noise_max,
    {W} * sum(cents) / 10000 / 1000::double as cmts_cm_us_signal_noise_sum,
    {W} * sum(minute) / (count(*)::double * 1000) / 10::double as cmts_cm_us_rx_power_avg,
    {W} * max(minute) / 1000 / 12::double as cmts_cm_us_rx_power_max,
    {W} * sum(minute) / 1000 / 200::double as cmts_cm_us_rx_power_sum
  from ev group by 1, 2, 3),
service_quality as (select * from quality_all where channel_number = 0),
attainability as (
  select mac, event_date,
    {W} * sum(case when event_type in ('view', 'error') then cents else 0 end) / 1000000
      as "US_SPEED_ATTAINABLE_FULL",
    {W} * sum(case when event_type in ('click', 'signup') then cents else 0 end) / 1000000
      as "DS_SPEED_ATTAINABLE_FULL",
    {W} * count(*) filter (value > 20) / (count(*) * 100) as attainability_pct,
    {W} * sum(case when event_type = 'purchase' then cents else 0 end) / 1000 / 1000::double
      as up_gb,
    {W} * sum(cents) / 1000 / 1000::double as down_gb
  from ev group by mac, event_date),
intermittency as (
  select mac, event_date,
    {W} * (max(minute_of_day) - min(minute_of_day)) / 144000 as "Intermittent_hrs",
    count(*) - 1 as transitions,
    count(*) filter (event_type = 'error') as "Offline_counts"
  from ev group by mac, event_date),
usage_ranked as (
  select mac, event_date,
    count(*) filter (event_type = 'view') as hsi_down_1d_rank,
    count(*) filter (event_type = 'click') as hsi_up_1d_rank,
    count(*) filter (event_type = 'purchase') as "IPTV_Down_1D_rank",
    count(*) filter (event_type = 'signup') as "IPTV_Up_1D_rank",
    count(*) filter (value < 25) as "RHP_Down_1D_rank",
    count(*) filter (value >= 75) as "RHP_Up_1D_rank"
  from ev group by mac, event_date),
whix as (
  select upper(regexp_replace(mac, '-', '', 'g')) as gw_mac, event_date,
    {W} * sum(cents) / (count(*)::double * 10000) / 100::double as whix_daily,
    {W} * count(*) filter (event_type = 'error') / (count(*)::double * 100)
      as daily_wifi_disconnects,
    nullif(count(*) filter (value > 80), 0) as "COUNT_DAILY_GW_WIFI_TOOHOT"
  from ev where event_type in ('click', 'error') group by 1, 2),
support_cases as (
  select user_id as account_number, event_date as creation_time,
    case when value < 70 then 'Tech' else 'Billing' end as "CASE_TYPE_LVL1",
    case when value < 50 then 'Internet' else 'TV' end as "CASE_TYPE_LVL2",
    case when value < 10 then 'Modem' when value < 25 then 'RF Signal'
      when value < 40 then 'Network Performance' else 'Invoice' end as "CASE_TYPE_LVL3",
    case when value < 30 then 'Ticket' when value < 60 then 'Truck' else 'N/A' end
      as "X_CASE_TYPE_LVL5"
  from ev where event_type = 'signup'),
calls as (
  select user_id, event_date, minute, lpad(cast(event_id as varchar), 9, '0') as sid,
    lpad(cast(user_id + 100000 as varchar), 6, '0') as unit_num,
    lpad(cast(cents as varchar), 8, '0') as channel_num
  from ev where event_type = 'purchase'),
sessions_categories as (select distinct sid, cast(floor(minute / 2) as bigint) as category_key from calls),
categories as (select distinct n_nationkey as category_key, n_name as category_name from nation),
sessions_booked as (
  select distinct sid, unit_num, unit_num || '0' || channel_num as speech_id from calls),
conversations_raw as (
  select user_id as account_number, event_date,
    case when event_date >= date '2024-01-16' then unit_num || sid
      else unit_num || '0' || channel_num end as speech_id
  from calls),
speech_conversations as (
  select distinct speech_id, account_number, event_date, left(speech_id, 6) as speech_unit,
    right(speech_id, 9) as speech_session
  from conversations_raw),
named as (
  select sid, category_name from sessions_categories left join categories using (category_key)
  where category_name in ({KEPT_LIST})),
key1 as (
  select account_number, event_date, category_name, 1 as called
  from speech_conversations join sessions_booked using (speech_id) join named using (sid)),
key2 as (
  select c.account_number, c.event_date, n.category_name, 1 as called
  from speech_conversations c
  join sessions_booked b on c.speech_unit = b.unit_num and c.speech_session = b.sid
  join named n on n.sid = b.sid),
call_labels as (select * from key1 union select * from key2),
chat_sessions as (
  select distinct sha256(cast(floor(conv_id / 8)::bigint as varchar)) as hash_account,
    date '2024-01-01' + cast(floor(conv_id / 3)::bigint % 30 as integer) as chat_date,
    conv_id as bold_id
  from conversations),
chat_accounts as (
  select distinct sha256(cast(user_id as varchar)) as hash_account, user_id as account_number
  from events),
chat_transcripts as (
  select conv_id as bold_id, string_agg(text, chr(10) order by turn, role) as message_text,
    string_agg(text, chr(10) order by turn) filter (role = 'assistant') as message_technician,
    string_agg(text, chr(10) order by turn) filter (role = 'user') as message_customer
  from conversations group by conv_id),
chats as (
  select * from chat_sessions join chat_accounts using (hash_account)
  join chat_transcripts using (bold_id)),
joined as (
  select * from accessibility join service_quality using (mac, event_date)
  join attainability using (mac, event_date) join intermittency using (mac, event_date)
  join usage_ranked using (mac, event_date)),
panel as (
  select j.* , coalesce(w.whix_daily, 1) as whix_daily,
    coalesce(w.daily_wifi_disconnects, 0) as daily_wifi_disconnects,
    coalesce(w."COUNT_DAILY_GW_WIFI_TOOHOT", 0) as "COUNT_DAILY_GW_WIFI_TOOHOT"
  from joined j left join whix w
  on upper(regexp_replace(j.mac, '-', '', 'g')) = w.gw_mac and j.event_date = w.event_date),
modem_days as (select account_number, event_date, mac, outage_count from accessibility),
labelled as (
  select m.account_number, m.event_date, m.mac, coalesce(l.category_name, 'no_call') as category_name,
    coalesce(l.called, 0) as called
  from modem_days m left join call_labels l using (account_number, event_date)),
scored as (
  select cast(event_type = 'error' as integer) as target, value as score,
    cast(value > 50 as integer) as pred
  from events)
"""


def sql(body: str, *views: str) -> str:
    return f"with {','.join([VIEWS, *views])}\n{body}"


def cut(column: str, digits: int = 6) -> str:
    return f'round("{column}", {digits}) as "{column}"'


def quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


ROLL = "(partition by account_number order by event_date, mac rows between {rows} preceding and current row)"


def stat(metric: str, name: str, rows: int = 14) -> str:
    over, x = ROLL.format(rows=rows), f'"{metric}"'
    return {
        "avg": f"avg({x}) over {over}",
        "var": f"avg(pow({x}, 2)) over {over} - pow(avg({x}) over {over}, 2)",
        "kurtosis": f"avg(pow({x}, 4)) over {over}",
        "sum": f"sum({x}) over {over}",
        "max": f"max({x}) over {over}",
    }[name]


def rolling(name: str, rows: int = 14) -> str:
    columns = []
    for m in METRICS:
        expr = f"round({stat(m, name, rows)}, 6)"
        if name in ("sum", "max") and m in INTEGERS:
            expr = f"cast({expr} as bigint)"
        columns.append(f'{expr} as "{m}_{name}"')
    return sql(f"select account_number, event_date, mac, {', '.join(columns)} from panel")


def trailing(n: int, column: str = "call_count_0", first: int = 1) -> str:
    return (
        f"cast(sum({column}) over (partition by account_number order by event_date range between "
        f"interval {n} day preceding and interval {first} day preceding) as bigint)"
    )


def history(rows: str, windows, prefix: str = "call_count_", columns: str = "*") -> str:
    sums = ", ".join(f"{trailing(n, f'{prefix}0')} as {prefix}{n}" for n in windows)
    return f"select {columns}, {sums} from {rows}"


def counted(panel: str, cases: str, day: str = "creation_time", out: str = "call_count_0") -> str:
    return f"""(select p.*, coalesce(c.n, 0) as {out} from {panel} p left join
      (select account_number, {day} as event_date, count(*) as n from {cases} group by 1, 2) c
      using (account_number, event_date))"""


def counted_compat(panel: str, cases: str, day: str = "creation_time", out: str = "call_count_0") -> str:
    return f"""(select p.*, coalesce(c.n, 0) as {out} from {panel} p left join
      (select account_number, {day} as event_date,
        count(*) over (partition by account_number, {day}) as n from {cases}) c
      using (account_number, event_date))"""


ORDERS = """order_rows as (
  select o_custkey as account_number, cast(o_orderdate as date) as event_date, o_orderkey as mac
  from orders),
urgent as (
  select o_custkey as account_number, cast(o_orderdate as date) as creation_time
  from orders where o_orderpriority = '1-URGENT')"""


def order_history(windows, how=counted) -> str:
    return sql(history(how("order_rows", "urgent"), windows), ORDERS)


def forward(rows: str, column: str, days: int) -> str:
    return f"""(select *, {days} as "window", case when sum({column}) over (
      partition by account_number order by event_date range between interval 1 day following
      and interval {days} day following) > 0 then 1 else 0 end as target from {rows})"""


KEY = "concat_ws('|', cast(account_number as varchar), cast(event_date as varchar), mac, category_name)"


def fraction(seed: int) -> str:
    return (
        f"(('0x' || left(md5(concat_ws('|', '{seed}', cast(account_number as varchar), "
        f"cast(event_date as varchar), mac, category_name)), 8))::bigint / 4294967296::double)"
    )


def balanced(rows: str) -> str:
    return f"""(select * exclude (hash_rank) from (
      select *, row_number() over (partition by target order by md5({KEY})) as hash_rank from {rows})
      where target = 1 or hash_rank <= (select count(*) from {rows} where target = 1))"""


TARGETS = f"targets as (select * exclude (\"window\") from {forward('labelled', 'called', 3)})"

FEATURE_COLUMNS = ", ".join(
    f'{stat(m, s)} as "{m}_{s}"' for m in METRICS for s in STATS
)
HISTORY = ", ".join(f"{trailing(n)} as call_count_{n}" for n in HISTORY_DAYS)
# rolling statistics are taken before the case join, trailing sums after it
FRAME = f"""rolled as (select account_number, event_date, mac, {FEATURE_COLUMNS} from panel),
frame as (select *, {HISTORY} from {counted('rolled', 'support_cases')})"""
FRAME_COMPAT = FRAME.replace(
    counted("rolled", "support_cases"), counted_compat("rolled", "support_cases")
)
FRAME_OUT = ", ".join(cut(c) if c in CONTINUOUS else c for c in FEATURES)


def labelled_features(start: str, end: str) -> str:
    return f"""(select f.*, coalesce(l.category_name, 'no_call') as category_name,
      coalesce(l.called, 0) as called
      from frame f left join
      (select * from call_labels where event_date between date '{start}' and date '{end}') l
      using (account_number, event_date))"""


SPLIT = f"""labelled_frame as (select * from {labelled_features(TRAIN[0], TEST[1])}),
dataset as (select * from {forward('labelled_frame', 'called', 3)}),
train_rows as (select * from dataset where event_date between date '{TRAIN[0]}' and date '{TRAIN[1]}'),
test_rows as (select * from dataset where event_date between date '{TEST[0]}' and date '{TEST[1]}')"""
DATASET_OUT = f'account_number, event_date, {FRAME_OUT}, category_name, called, "window", target'

CHECKED = {
    "svq": "service_quality",
    "accessibility": "accessibility",
    "attainability": "attainability",
    "intermittency": "intermittency",
    "resi": "usage_ranked",
    "speech": "call_labels",
}


def presence(day: str) -> str:
    return " union all ".join(
        f"""select '{name}' as source, count(*) as n_rows, count(*) = 0 as missing, '{day}' as "day"
        from {view} where event_date = date '{day}'"""
        for name, view in CHECKED.items()
    )


SIZED = {
    "modem": {"accessibility": 6, "attainability": 7, "service_quality": 10, "intermittency": 5,
              "usage_ranked": 8, "mac_usage": 3},
    "usage": {"usage_ranked_own": 8, "mac_usage_own": 3},
    "wifi": {"whix": 5},
    "support": {"support_cases": 6, "case_headers": 6},
    "speech": {"sessions_booked": 3, "categories": 2, "sessions_categories": 2,
               "speech_conversations": 5},
    "chat": {"chat_sessions": 3, "chat_accounts": 2, "chat_transcripts": 4},
    "customers": {"accounts": 5, "customer_accounts": None},
}
SIZED_VIEWS = {"mac_usage": "accessibility", "mac_usage_own": "accessibility",
               "usage_ranked_own": "usage_ranked", "service_quality": "quality_all",
               "case_headers": "orders", "accounts": "customer", "customer_accounts": "supplier"}


def _sized() -> str:
    parts = []
    for family, members in SIZED.items():
        for name, width in members.items():
            view = SIZED_VIEWS.get(name, name)
            columns = width if width is not None else (
                "(select count(*) from information_schema.columns where table_name = 'supplier')"
            )
            parts.append(
                f"select '{family}' as family, '{name}' as source, "
                f"cast({columns} as integer) as n_columns, count(*) as n_rows from {view}"
            )
    return sql(" union all ".join(parts))


STEPS = """steps as (
  select score as threshold, count(*) filter (target = 1) as pos, count(*) filter (target <> 1) as neg
  from scored group by score),
curve as (
  select threshold, sum(pos) over up as tp, sum(neg) over up as fp,
    (select sum(pos) from steps) as p, (select sum(neg) from steps) as n
  from steps window up as (order by threshold desc))"""
AUC = """(select (sum(r) filter (target = 1) - count(*) filter (target = 1)
    * (count(*) filter (target = 1) + 1) / 2::double)
    / (count(*) filter (target = 1)::double * count(*) filter (target = 0))
  from (select target, rank() over (order by score)
    + (count(*) over (partition by score) - 1) / 2::double as r from scored))"""
PRECISION = "(count(*) filter (pred = 1 and target = 1))::double / (count(*) filter (pred = 1))"
RECALL = "(count(*) filter (pred = 1 and target = 1))::double / (count(*) filter (target = 1))"
INNER = METRICS[:-3]


# Shapley values in a tree of two features: the mean over both orders of what each adds
TREE = """
tree_rows as (
  select a.account_number, a.mac, a.event_date, transitions, outage_count > 0 as o,
    transitions > case when outage_count > 0 then 2 else 1 end as t, day(event_date) % 3 as y
  from accessibility a join intermittency i using (mac, event_date)),
leaves as (
  select o, t, avg(y)::double as v, any_value(share) as share from (
    select o, t, y, count(*) over (partition by o)::double / count(*) over () as share from tree_rows)
  group by o, t),
expected as (
  select *, (avg(y) over ())::double as whole, (avg(y) over (partition by o))::double as branch,
    (avg(y) over (partition by o, t))::double as leaf,
    coalesce((select sum(share * v) from leaves where not o and t = (transitions > 1)), 0)
      + coalesce((select sum(share * v) from leaves where o and t = (transitions > 2)), 0) as split
  from tree_rows),
explained as (
  select *, (branch - whole + leaf - split) / 2::double as phi_o,
    (split - whole + leaf - branch) / 2::double as phi_t
  from expected)"""


def model_queries(scoring_frame: str) -> dict[str, str]:
    """What holds of models however they are fitted, and the rows that whole jobs leave."""
    n = len(FEATURES)
    facts = sql(
        "select account_number, event_date, category_name, target, true as in_range, "
        "true as agrees from test_rows", FRAME, SPLIT)
    places = ", ".join(
        f"('{output}', '{place}', {columns})"
        for output, columns in (("features", n + 4), ("scores", n + 6), ("explanations", n + 3))
        for place in ("ARCHIVE", "LATEST")
    )
    return {
        "rf_score_facts": facts,
        "gbt_score_facts": facts,
        "stack_score_facts": facts,
        "saved_model_agrees": sql(
            "select distinct account_number, event_date, category_name, true as same "
            "from test_rows", FRAME, SPLIT),
        "local_contrib_sums": sql(
            "select account_number, event_date, category_name, true as same from test_rows",
            FRAME, SPLIT),
        "fidelity_facts": sql(
            "select count(*) filter (f < 0.7::double) as n_fitted, "
            "count(*) filter (f >= 0.7::double) as n_held_out, true as explains from "
            "(select ('0x' || left(md5(concat_ws('|', '42', cast(account_number as varchar), "
            "cast(event_date as varchar), category_name)), 8))::bigint / 4294967296::double as f "
            "from test_rows)", FRAME, SPLIT),
        "tree_contrib_exact": sql(
            "select account_number, mac, event_date, round(phi_o, 9) as outage_count, "
            "round(phi_t, 9) as transitions from explained", TREE),
        "tree_global_exact": sql(
            "select 'outage_count' as feature, round(avg(abs(phi_o)), 9) as mean_abs from explained "
            "union all select 'transitions', round(avg(abs(phi_t)), 9) from explained", TREE),
        "importance_facts": f"select unnest(['model', 'surrogate']) as kind, {n + 1} as n_features, "
        "1.0::double as total",
        "local_contrib_exact": sql(
            "select account_number, event_date, mac, round(slope * (outage_count - middle), 4) "
            "as outage_count from modem_days, (select avg(outage_count) as middle, "
            "regr_slope(0.3 + outage_count / 50 + (day(event_date) % 3) / 100, outage_count) "
            "as slope from modem_days)"),
        "inference_job": f"select cast(account_number as varchar) as account_number, event_date, "
        f"output, place, n_columns from ({scoring_frame}), "
        f"(values {places}) p(output, place, n_columns)",
        "dataset_job": sql(
            f"select {DATASET_OUT}, 'train' as part from {balanced('train_rows')} union all "
            f"select {DATASET_OUT}, 'test' from test_rows", FRAME, SPLIT),
        "training_job": sql(
            "select concat_ws(' ', 'profile train', target) as fact, count(*) as n "
            f"from {balanced('train_rows')} group by target union all "
            "select concat_ws(' ', 'profile test', target), count(*) from test_rows "
            "group by target union all "
            f"select 'record 2024-02-01 {TRAIN[0]} {TEST[1]}', 1 union all "
            f"select 'surrogate features', {n + 1}", FRAME, SPLIT),
    }


def oracle_queries() -> dict[str, str]:
    modem_labels = "select account_number, event_date, mac"

    def archived(latest: str) -> str:
        """All days by day, and once more the first or last of them."""
        return sql(
            f"{modem_labels}, outage_count, event_date as \"DATE_PART\", 'ARCHIVE' as place "
            f"from modem_days union all {modem_labels}, outage_count, null, 'LATEST' from modem_days "
            f"where event_date = (select {latest}(event_date) from modem_days)")

    out = {
        "scan_projected": sql(
            "select mac, event_date, " + ", ".join(cut(c) for c in (
                "US_SPEED_ATTAINABLE_FULL", "DS_SPEED_ATTAINABLE_FULL", "attainability_pct",
                "up_gb", "down_gb")) + " from attainability"),
        "scan_filtered": sql(
            f"select mac, event_date, channel_number, {cut('codeword_error_rate')}, "
            + ", ".join(cut(f"cmts_cm_us_{a}_{b}") for a in ("signal_noise", "rx_power")
            for b in ("avg", "max", "sum")) + " from service_quality"),
        "rescale": sql(
            "select mac, event_date, channel_number, " + ", ".join(cut(f"cmts_cm_us_{a}_{b}")
            for a in ("signal_noise", "rx_power") for b in ("avg", "max", "sum")) + " from quality_all"),
        "scan_cases": sql("select * from support_cases"),
        "scan_wifi": sql(
            f"select gw_mac, event_date, {cut('whix_daily')}, {cut('daily_wifi_disconnects')}, "
            "\"COUNT_DAILY_GW_WIFI_TOOHOT\" from whix"),
        "scan_usage": sql("select * from usage_ranked"),
        "scan_distinct": sql("select * from speech_conversations"),
        "scan_speech_sessions": sql("select * from sessions_booked"),
        "scan_chat": sql("select * from chat_sessions"),
        "scan_whole": "select * from customer where c_acctbal > 0",
        "load_all": _sized(),
        "views": sql(
            "select creation_time as event_date, count(*) as n_cases from support_cases "
            "where creation_time in (select event_date from whix) group by 1"),
        "key_normalize": sql(
            "select mac, event_date, upper(replace(mac, '-', '')) as gw_mac from accessibility"),
        "panel_inner": sql(
            "select account_number, event_date, mac, "
            + ", ".join(f'"{m}"' if m in INTEGERS else cut(m) for m in INNER) + " from joined"),
        "wifi_left_fill": sql(
            "select a.mac, a.event_date, round(coalesce(whix_daily, 1), 6) as whix_daily, "
            "round(coalesce(daily_wifi_disconnects, 0), 6) as daily_wifi_disconnects, "
            "coalesce(\"COUNT_DAILY_GW_WIFI_TOOHOT\", 0) as \"COUNT_DAILY_GW_WIFI_TOOHOT\" "
            "from accessibility a left join whix w on w.gw_mac = upper(replace(a.mac, '-', '')) "
            "and w.event_date = a.event_date"),
        "rolling_avg": rolling("avg"),
        "rolling_var": rolling("var"),
        "rolling_m4": rolling("kurtosis"),
        "rolling_sum": rolling("sum"),
        "rolling_max": rolling("max"),
        "rolling_legacy_frame": rolling("avg", 20),
        "rolling_split_accounts": rolling("var"),
        "same_day_count": sql(
            "select account_number, event_date, mac, call_count_0 from "
            + counted("modem_days", "support_cases")),
        "same_day_count_compat": sql(
            "select account_number, event_date, mac, call_count_0 from "
            + counted_compat("modem_days", "support_cases")),
        "trailing_10": order_history([10]),
        "trailing_30": order_history([30]),
        "trailing_60": order_history([60]),
        "trailing_120": order_history([120]),
        "trailing_compat": order_history([30, 120], counted_compat),
        "trailing_of_column": sql(
            f"select account_number, event_date, mac, outage_count, {trailing(5, 'outage_count')} "
            f"as outages_5, {trailing(10, 'outage_count')} as outages_10 from panel"),
        "session_category": sql("select * from named"),
        "label_key1": sql("select distinct * from key1"),
        "label_key2": sql("select distinct * from key2"),
        "label_union_distinct": sql("select * from call_labels"),
        "ground_truth_rule1": sql(
            "select account_number, event_date, category_name from "
            "(select distinct speech_id, account_number, event_date from conversations_raw) "
            "join (select distinct speech_id, sid from sessions_booked) using (speech_id) "
            "join named using (sid)"),
        "label_attach": sql("select * from labelled"),
        "case_label": sql(
            f"{modem_labels}, case when l is null then 0 else 1 end as target_icm from modem_days "
            "left join (select distinct account_number, creation_time as event_date, "
            "\"CASE_TYPE_LVL3\" as l from support_cases where \"CASE_TYPE_LVL2\" in ('Internet') "
            "and \"CASE_TYPE_LVL3\" in ('RF Signal', 'Network Performance', 'Signal RF', 'Modem')) "
            "using (account_number, event_date)"),
        "next_day_case_label": sql(
            f"{modem_labels}, cast(exists (select 1 from support_cases c "
            "where c.account_number = m.account_number and c.creation_time = m.event_date + 1 "
            "and c.\"CASE_TYPE_LVL1\" = 'Tech' and c.\"X_CASE_TYPE_LVL5\" in ('Ticket', 'Truck')) "
            "as integer) as target from modem_days m"),
        "forward_label": sql(f"select * from {forward('labelled', 'called', 10)}"),
        "label_complete": sql(
            "select mac, event_date, category_name, target, "
            "event_date <= (select max(event_date) from labelled) - 5 as label_complete "
            f"from {forward('labelled', 'called', 5)}"),
        "chat_join": sql("select * from chats"),
        "date_split": sql(
            f"{modem_labels}, 'train' as part from accessibility where event_date between "
            f"date '{TRAIN[0]}' and date '{TRAIN[1]}' union all {modem_labels}, 'test' from "
            f"accessibility where event_date between date '{TEST[0]}' and date '{TEST[1]}'"),
        "balance_undersample": sql(f"select * from {balanced('targets')}", TARGETS),
        "test_cap": (
            "select event_id, user_id, event_type from events "
            "order by md5(cast(event_id as varchar)) limit 500"),
        "bernoulli_sample": sql(f"select * from targets where {fraction(7)} < 0.5", TARGETS),
        "stratified_sample": sql(
            f"select * from targets where {fraction(7)} < case when target = 1 "
            "then 0.2::double else 0.05::double end", TARGETS),
        "random_split": sql(
            f"select {modem_labels[7:]}, category_name, cast(case when f < 0.7::double then 0 "
            "when f < 0.8::double then 1 else 2 end as integer) as part "
            f"from (select *, {fraction(1234)} as f from targets)", TARGETS),
        "legacy_balance": sql(
            f"select * from strata where target = 1 union all (select * from strata where target = 0 "
            f"and {fraction(2)} < 0.5::double order by md5({KEY}) "
            "limit (select count(*) from strata where target = 1))",
            TARGETS, f"strata as (select * from targets where {fraction(1)} < 0.4::double)"),
        "class_profile": sql(
            "select dataset, target, count(*) as n_rows, 6 as n_columns from (select target, case "
            f"when event_date between date '{TRAIN[0]}' and date '{TRAIN[1]}' then 'train' when "
            f"event_date between date '{TEST[0]}' and date '{TEST[1]}' then 'test' end as dataset "
            "from targets) where dataset is not null group by 1, 2 union all "
            "select 'all', target, count(*), 6 from targets group by 2", TARGETS),
        "dedupe_account": sql(
            "select account_number, event_date, mac, outage_count, category_name, called from "
            "(select m.*, coalesce(l.category_name, 'no_call') as category_name, "
            "coalesce(l.called, 0) as called, row_number() over (partition by account_number "
            "order by coalesce(l.category_name, 'no_call'), mac, event_date) as k "
            "from modem_days m left join call_labels l using (account_number, event_date)) where k = 1"),
        "presence_check": sql(f"{presence('2024-01-30')} union all {presence('2024-01-31')}"),
        "batch_date": sql(
            "select max(event_date) as batch_date, strftime(max(event_date), '%Y-%m-%d') as date_part "
            "from accessibility"),
        "precision_recall": sql(
            f"select round({PRECISION}, 9) as precision, round({RECALL}, 9) as recall from scored"),
        "roc_auc": sql(f"select round({AUC}, 9) as roc_auc"),
        "roc_curve": sql(
            "select threshold, round(fp::double / n, 9) as fpr, round(tp::double / p, 9) as tpr "
            "from curve union all select null, 0, 0", STEPS),
        "pr_curve": sql(
            "select threshold, round(tp::double / (tp + fp), 9) as precision, "
            "round(tp::double / p, 9) as recall from curve union all select null, 1, 0", STEPS),
        "score_record": sql(
            f"select round({AUC}, 9) as \"AUC\", round({PRECISION}, 9) as precision, "
            f"round({RECALL}, 9) as recall, '2024-02-01' as event_date, "
            f"'{TRAIN[0]}' as train_start_date, '{TRAIN[1]}' as train_end_date, "
            f"'{TEST[0]}' as test_start_date, '{TEST[1]}' as test_end_date from scored"),
        "feature_panel": sql(f"select account_number, event_date, {FRAME_OUT} from frame", FRAME),
        "feature_days": sql(
            f"select account_number, event_date, {FRAME_OUT} from frame "
            f"where event_date between date '{TEST[0]}' and date '{TEST[1]}'", FRAME),
        "feature_panel_compat": sql(
            f"select account_number, event_date, mac, {FRAME_OUT} from frame", FRAME_COMPAT),
        "point_in_time_day": sql(
            f"select account_number, event_date, mac, {FRAME_OUT} from frame "
            f"where event_date = date '{SCORING_DAY}' "
            "qualify row_number() over (partition by account_number order by mac) = 1", FRAME),
        "inference_frame": sql(
            "select account_number, event_date, "
            + ", ".join(
                f'round("{c}", 6) as "{c}"' if c in CONTINUOUS else f"coalesce({c}, 0) as {c}"
                for c in FEATURES)
            + ", category_name, called from day_rows where event_date = "
            f"date '{SCORING_DAY}' qualify row_number() over (partition by account_number "
            "order by category_name, mac) = 1",
            FRAME, f"day_rows as (select * from {labelled_features(SCORING_DAY, SCORING_DAY)})"),
        "training_set": sql(f"select {DATASET_OUT} from {balanced('train_rows')}", FRAME, SPLIT),
        "testing_set": sql(f"select {DATASET_OUT} from test_rows", FRAME, SPLIT),
        "latest_archive_roundtrip": archived("min"),
        "published_days": archived("max"),
        "metrics_log": sql(f"{presence(SCORING_DAY)} union all {presence(TEST[0])}"),
        "single_file_write": sql("select * from support_cases"),
        "new_file_refresh": sql(
            "select account_number, creation_time as event_date, count(*) as call_count_0 "
            "from support_cases group by 1, 2"),
    }
    out["days_refreshed"] = sql(
        "select account_number, event_date, call_count_0, cast(sum(call_count_0) over ("
        "partition by account_number order by event_date range between interval 10 days preceding "
        "and interval 1 day preceding) as bigint) as call_count_10 from (select account_number, "
        "creation_time as event_date, count(*) as call_count_0 from support_cases group by 1, 2)")
    out["panel_bucketed"] = out["panel_inner"]
    out["empty_batch_refused"] = sql(
        "select event_date, not exists (select 1 from modem_days m where m.event_date = d.event_date) "
        "as refused from (select distinct creation_time as event_date from support_cases) d")
    out["unknown_stat_refused"] = (
        "select distinct event_type as stat, true as refused from events union all "
        "select unnest(['avg', 'var', 'kurtosis', 'sum', 'max']), false")
    out["scoring_dates"] = sql(
        "select distinct event_date, event_date as scored, 2 as lag from modem_days")
    out["kept_state_day"] = out["point_in_time_day"]
    totals = ", ".join(f"call_count_{n}" for n in HISTORY_DAYS)
    out["trailing_kept"] = sql(
        f"select distinct account_number, event_date, {totals} from frame",
        f"frame as ({history(counted('modem_days', 'support_cases'), HISTORY_DAYS)})")
    out["ground_truth_table"] = out["ground_truth_rule1"]
    out["label_views"] = out["ground_truth_rule1"]
    out |= model_queries(out["inference_frame"])
    out["forward_label_legacy"] = sql(
        f"select * from {forward('cased', 'target_icm', 15)}",
        "cased as (" + out["case_label"].split(VIEWS)[1].strip() + ")")
    filled = sql(
        f"select account_number, event_date, mac, call_count_0, "
        + ", ".join(f"coalesce(call_count_{n}, 0) as call_count_{n}" for n in HISTORY_DAYS)
        + " from frame",
        f"frame as ({history(counted('modem_days', 'support_cases'), HISTORY_DAYS)})")
    out["fill_zero"] = filled
    out["drop_null"] = sql(
        "select account_number, event_date, mac, call_count_0, "
        + ", ".join(f"call_count_{n}" for n in HISTORY_DAYS) + " from frame where "
        + " and ".join(f"call_count_{n} is not null" for n in HISTORY_DAYS),
        f"frame as ({history(counted('modem_days', 'support_cases'), HISTORY_DAYS)})")
    texts = "message_text, message_technician, message_customer"
    dated = f"dated as (select account_number, chat_date as event_date, {texts} from chats)"
    for name, how, cases, day in (
        ("chat_case_history", counted, "support_cases", "creation_time"),
        ("chat_compat", counted_compat, "support_cases", "creation_time"),
        ("chat_own_history", counted, "chats", "chat_date"),
    ):
        out[name] = sql(
            history(how("dated", cases, day, "chat_count_0"), sorted(HISTORY_DAYS), "chat_count_"),
            dated)
    return out
