"""Feed-shaped raw tables derived from the star-schema test tables.

Modem tables come from ``events``: an account is a user, with one modem for
browsing events and one for the others. Grouping by (mac, day) leaves each
table partitioned as the panel joins need it. Sums run over whole cents, so
that both engines see bit-equal inputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Weight of every fractional metric. Plain decimals have means that end exactly
# in a rounding tie, where the last bit of a sum would decide a comparison.
UNEVEN = 10 * math.pi

# category names kept in the label queries
KEPT = tuple(f"NATION_{i}" for i in range(11))


class RawTables(Mapping):
    """Raw tables of one test data folder, each built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        browsing = F.col("event_type").isin("view", "click")
        device = F.when(browsing, "-1").otherwise("-2")
        user = F.lpad(F.col("user_id").cast("string"), 12, "0")
        return self.load("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.col("ts").cast("date").alias("event_date"),
            F.concat(F.lit("aa-bb-"), user, device).alias("mac"),
            F.round(F.col("value") * 100).cast("bigint").alias("cents"),
            (F.hour("ts") * 60 + F.minute("ts")).alias("minute_of_day"),
            F.minute("ts").alias("minute"),
        )

    def _by_modem_day(self, mac: str, *columns: Column, extra: tuple[Column, ...] = ()) -> DataFrame:
        return self.events.groupBy(F.col("mac").alias(mac), "event_date", *extra).agg(*columns)

    @cached_property
    def _builders(self) -> dict:
        return {
            "accessibility": self._accessibility,
            "service_quality": self._service_quality,
            "attainability": self._attainability,
            "intermittency": self._intermittency,
            "usage_ranked": self._usage_ranked,
            "mac_usage": self._mac_usage,
            "usage_ranked_own": self._usage_ranked,
            "mac_usage_own": self._mac_usage,
            "whix": self._whix,
            "support_cases": self._support_cases,
            "case_headers": lambda: self.load("orders"),
            "sessions_categories": self._sessions_categories,
            "categories": self._categories,
            "sessions_booked": self._sessions_booked,
            "speech_conversations": self._speech_conversations,
            "chat_sessions": self._chat_sessions,
            "chat_accounts": self._chat_accounts,
            "chat_transcripts": self._chat_transcripts,
            "accounts": lambda: self.load("customer"),
            "customer_accounts": lambda: self.load("supplier"),
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def _accessibility(self) -> DataFrame:
        n, errors = F.count(F.lit(1)), F.count_if(F.col("event_type") == "error")
        prime = F.count_if(F.col("minute_of_day") >= 18 * 60)
        return self._by_modem_day(
            "mac",
            F.min("user_id").alias("FULL_ACCOUNT_NUMBER"),
            errors.alias("outage_count"),
            (F.lit(UNEVEN) * (n - errors) / n).alias("ACCESSIBILITY_PERC_FULL_DAY"),
            (F.lit(UNEVEN) * prime / n).alias("ACCESSIBILITY_PERC_PRIME"),
        )

    def _service_quality(self) -> DataFrame:
        n, cents = F.count(F.lit(1)).cast("double"), F.lit(UNEVEN) * F.sum("cents")
        minutes = F.lit(UNEVEN) * F.sum("minute")
        channel = F.when(F.col("value") < 60, 0).otherwise(1).alias("channel_number")
        return self._by_modem_day(
            "mac",
            (cents / (n * 100000)).alias("codeword_error_rate"),
            (cents / (n * 10000)).alias("cmts_cm_us_signal_noise_avg"),
            (F.lit(UNEVEN) * F.max("cents") / 10000).alias("cmts_cm_us_signal_noise_max"),
            (cents / 10000).alias("cmts_cm_us_signal_noise_sum"),
            (minutes / (n * 1000)).alias("cmts_cm_us_rx_power_avg"),
            (F.lit(UNEVEN) * F.max("minute") / 1000).alias("cmts_cm_us_rx_power_max"),
            (minutes / 1000).alias("cmts_cm_us_rx_power_sum"),
            extra=(channel,),
        )

    def _attainability(self) -> DataFrame:
        def total(kind: str) -> Column:
            return F.sum(F.when(F.col("event_type") == kind, F.col("cents")).otherwise(0))

        return self._by_modem_day(
            "CM_MAC_ADDR",
            (F.lit(UNEVEN) * (total("view") + total("error")) / 1000000).alias(
                "US_SPEED_ATTAINABLE_FULL"
            ),
            (F.lit(UNEVEN) * (total("click") + total("signup")) / 1000000).alias(
                "DS_SPEED_ATTAINABLE_FULL"
            ),
            (F.lit(UNEVEN) * F.count_if(F.col("value") > 20) / (F.count(F.lit(1)) * 100)).alias(
                "Attainability_Pct"
            ),
            (F.lit(UNEVEN) * total("purchase") / 1000).alias("UP_MBYTES"),
            (F.lit(UNEVEN) * F.sum("cents") / 1000).alias("DOWN_MBYTES"),
        )

    def _intermittency(self) -> DataFrame:
        span = F.lit(UNEVEN) * (F.max("minute_of_day") - F.min("minute_of_day"))
        return self._by_modem_day(
            "cm_mac_addr",
            (span / 144000).alias("Intermittent_hrs"),
            (F.count(F.lit(1)) - 1).alias("transitions"),
            F.count_if(F.col("event_type") == "error").alias("Offline_counts"),
        )

    def _usage_ranked(self) -> DataFrame:
        def events(kind: str) -> Column:
            return F.count_if(F.col("event_type") == kind)

        return self._by_modem_day(
            "cm_mac_addr",
            events("view").alias("hsi_down_1d_rank"),
            events("click").alias("hsi_up_1d_rank"),
            events("purchase").alias("IPTV_Down_1D_rank"),
            events("signup").alias("IPTV_Up_1D_rank"),
            F.count_if(F.col("value") < 25).alias("RHP_Down_1D_rank"),
            F.count_if(F.col("value") >= 75).alias("RHP_Up_1D_rank"),
        )

    def _mac_usage(self) -> DataFrame:
        return self._by_modem_day("mac", F.sum("cents").alias("cents"))

    def _whix(self) -> DataFrame:
        noisy = self.events.where(F.col("event_type").isin("click", "error"))
        n = F.count(F.lit(1)).cast("double")
        hot = F.count_if(F.col("value") > 80)
        gateway = F.upper(F.regexp_replace("mac", "-", "")).alias("GW_MAC_ADDRESS")
        return noisy.groupBy(gateway, "event_date").agg(
            (F.lit(UNEVEN) * F.sum("cents") / (n * 10000)).alias("AVG_DAY_WIFI_HAPPINESS_INDEX"),
            (F.lit(UNEVEN) * F.count_if(F.col("event_type") == "error") / (n * 100)).alias("AVG_DAILY_WIFI_DISCONNECTS"),
            F.when(hot > 0, hot).alias("COUNT_DAILY_GW_WIFI_TOOHOT"),
        )

    def _support_cases(self) -> DataFrame:
        value = F.col("value")
        return self.events.where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("ban"),
            F.col("event_date").alias("creation_time"),
            F.when(value < 70, "Tech").otherwise("Billing").alias("CASE_TYPE_LVL1"),
            F.when(value < 50, "Internet").otherwise("TV").alias("CASE_TYPE_LVL2"),
            F.when(value < 10, "Modem")
            .when(value < 25, "RF Signal")
            .when(value < 40, "Network Performance")
            .otherwise("Invoice")
            .alias("CASE_TYPE_LVL3"),
            F.when(value < 30, "Ticket").when(value < 60, "Truck").otherwise("N/A").alias(
                "X_CASE_TYPE_LVL5"
            ),
        )

    def _calls(self) -> DataFrame:
        padded = F.lpad(F.col("event_id").cast("string"), 9, "0")
        return self.events.where(F.col("event_type") == "purchase").select(
            "user_id",
            "event_date",
            "minute",
            padded.alias("sid"),
            F.lpad((F.col("user_id") + 100000).cast("string"), 6, "0").alias("unit_num"),
            F.lpad(F.col("cents").cast("string"), 8, "0").alias("channel_num"),
        )

    def _sessions_categories(self) -> DataFrame:
        return self._calls().select("sid", F.floor(F.col("minute") / 2).alias("category_key"))

    def _categories(self) -> DataFrame:
        return self.load("nation").select(
            F.col("n_nationkey").alias("category_key"), F.col("n_name").alias("category_name")
        )

    def _sessions_booked(self) -> DataFrame:
        return self._calls().select("sid", "unit_num", "channel_num")

    def _speech_conversations(self) -> DataFrame:
        early = F.concat("unit_num", F.lit("0"), "channel_num")
        late = F.concat("unit_num", "sid")
        switched = F.col("event_date") >= F.lit("2024-01-16").cast("date")
        return self._calls().select(
            F.when(switched, late).otherwise(early).alias("speech_id_verint"),
            F.col("user_id").alias("customer_id"),
            F.col("event_date").alias("conversation_date"),
        )

    def _chat_sessions(self) -> DataFrame:
        account = F.floor(F.col("conv_id") / 8).cast("string")
        ago = F.pmod(F.floor(F.col("conv_id") / 3), F.lit(30)).cast("int")
        return self.load("conversations").select("conv_id").distinct().select(
            F.sha2(account, 256).alias("ecid"),
            F.date_add(F.lit("2024-01-01").cast("date"), ago).alias("date_part"),
            F.col("conv_id").alias("bold_id"),
        )

    def _chat_accounts(self) -> DataFrame:
        return self.load("events").select("user_id").distinct().select(
            F.sha2(F.col("user_id").cast("string"), 256).alias("hash_account"),
            F.col("user_id").alias("account"),
        )

    def _chat_transcripts(self) -> DataFrame:
        def said(role: str | None) -> Column:
            """All texts of a role, or of both, in the order of the turns."""
            turn = F.struct("turn", "role", "text")
            if role is not None:
                turn = F.when(F.col("role") == role, turn)
            turns = F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["text"])
            return F.when(F.size(turns) > 0, F.array_join(turns, "\n"))

        return self.load("conversations").groupBy(F.col("conv_id").alias("session_id")).agg(
            said(None).alias("message_text"),
            said("assistant").alias("message_technician"),
            said("user").alias("message_customer"),
        )
