"""Daily modem panel: one row per modem and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ringcast.functions.scalar import gateway_mac

MODEM_DAY = ["mac", "event_date"]

# A gateway without a Wi-Fi row counts as content and trouble-free.
WIFI_DEFAULTS = {"whix_daily": 1, "daily_wifi_disconnects": 0, "COUNT_DAILY_GW_WIFI_TOOHOT": 0}


def modem_panel(accessibility: DataFrame, *others: DataFrame) -> DataFrame:
    """Inner-join the modem tables on (mac, event_date).

    All joins share one key, so each table is shuffled once; date predicates
    on the result reach every scan.
    """
    return reduce(lambda left, right: left.join(right, MODEM_DAY), others, accessibility)


def add_wifi(panel: DataFrame, whix: DataFrame) -> DataFrame:
    """Left-join Wi-Fi health by gateway address and fill what is missing.

    The fill also covers NULLs inside matched rows.
    """
    keyed = panel.withColumn("gw_mac", gateway_mac("mac"))
    return keyed.join(whix, ["gw_mac", "event_date"], "left").fillna(WIFI_DEFAULTS)
