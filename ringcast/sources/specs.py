"""What each source table offers and how it is projected on read.

The raw column names and divisors are fixed values of the feeds. Table names
are not: each spec has a logical name, and the caller maps it to a catalog
table, a path-backed DataFrame or a view of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class SourceSpec:
    """Projection of one source table; no columns at all means every column."""

    name: str
    kept: tuple[str, ...] = ()
    renamed: Mapping[str, str] = field(default_factory=dict)
    divided: Mapping[str, tuple[str, float]] = field(default_factory=dict)
    derived: Mapping[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ("event_date",)
    distinct: bool = False

    @property
    def whole(self) -> bool:
        return not (self.kept or self.renamed or self.divided or self.derived)


ACCESSIBILITY = SourceSpec(
    "accessibility",
    kept=("mac", "event_date", "outage_count"),
    renamed={"account_number": "FULL_ACCOUNT_NUMBER"},
    divided={
        "ACCESSIBILITY_PERC_FULL_DAY": ("ACCESSIBILITY_PERC_FULL_DAY", 100),
        "ACCESSIBILITY_PERC_PRIME": ("ACCESSIBILITY_PERC_PRIME", 100),
    },
)
SERVICE_QUALITY = SourceSpec(
    "service_quality",
    kept=("mac", "event_date", "channel_number", "codeword_error_rate"),
    divided={
        "cmts_cm_us_signal_noise_avg": ("cmts_cm_us_signal_noise_avg", 364),
        "cmts_cm_us_signal_noise_max": ("cmts_cm_us_signal_noise_max", 380),
        "cmts_cm_us_signal_noise_sum": ("cmts_cm_us_signal_noise_sum", 1000),
        "cmts_cm_us_rx_power_avg": ("cmts_cm_us_rx_power_avg", 10),
        "cmts_cm_us_rx_power_max": ("cmts_cm_us_rx_power_max", 12),
        "cmts_cm_us_rx_power_sum": ("cmts_cm_us_rx_power_sum", 200),
    },
)
ATTAINABILITY = SourceSpec(
    "attainability",
    kept=("event_date", "US_SPEED_ATTAINABLE_FULL", "DS_SPEED_ATTAINABLE_FULL"),
    renamed={"mac": "CM_MAC_ADDR", "attainability_pct": "Attainability_Pct"},
    divided={"up_gb": ("UP_MBYTES", 1000), "down_gb": ("DOWN_MBYTES", 1000)},
)
INTERMITTENCY = SourceSpec(
    "intermittency",
    kept=("event_date", "Intermittent_hrs", "transitions", "Offline_counts"),
    renamed={"mac": "cm_mac_addr"},
)
USAGE_RANKED = SourceSpec(
    "usage_ranked",
    kept=(
        "event_date",
        "hsi_down_1d_rank",
        "hsi_up_1d_rank",
        "IPTV_Down_1D_rank",
        "IPTV_Up_1D_rank",
        "RHP_Down_1D_rank",
        "RHP_Up_1D_rank",
    ),
    renamed={"mac": "cm_mac_addr"},
)
MAC_USAGE = SourceSpec("mac_usage")
# the usage database keeps tables of its own under the same columns
USAGE_RANKED_OWN = replace(USAGE_RANKED, name="usage_ranked_own")
MAC_USAGE_OWN = replace(MAC_USAGE, name="mac_usage_own")
WHIX = SourceSpec(
    "whix",
    kept=("event_date", "COUNT_DAILY_GW_WIFI_TOOHOT"),
    renamed={
        "gw_mac": "GW_MAC_ADDRESS",
        "daily_wifi_disconnects": "AVG_DAILY_WIFI_DISCONNECTS",
    },
    divided={"whix_daily": ("AVG_DAY_WIFI_HAPPINESS_INDEX", 100)},
)
SUPPORT_CASES = SourceSpec(
    "support_cases",
    kept=(
        "creation_time",
        "CASE_TYPE_LVL1",
        "CASE_TYPE_LVL2",
        "CASE_TYPE_LVL3",
        "X_CASE_TYPE_LVL5",
    ),
    renamed={"account_number": "ban"},
    dates=("creation_time",),
)
CASE_HEADERS = SourceSpec("case_headers")
SESSIONS_CATEGORIES = SourceSpec(
    "sessions_categories", kept=("sid", "category_key"), distinct=True
)
CATEGORIES = SourceSpec("categories", kept=("category_key", "category_name"), distinct=True)
SESSIONS_BOOKED = SourceSpec(
    "sessions_booked",
    kept=("sid", "unit_num"),
    derived={"speech_id": "concat(unit_num, '0', channel_num)"},
    distinct=True,
)
CONVERSATIONS = SourceSpec(
    "speech_conversations",
    renamed={
        "speech_id": "speech_id_verint",
        "account_number": "customer_id",
        "event_date": "conversation_date",
    },
    derived={
        "speech_unit": "left(speech_id_verint, 6)",
        "speech_session": "right(speech_id_verint, 9)",
    },
    distinct=True,
)
CHAT_SESSIONS = SourceSpec(
    "chat_sessions",
    kept=("bold_id",),
    renamed={"hash_account": "ecid", "chat_date": "date_part"},
    dates=("chat_date",),
)
CHAT_ACCOUNTS = SourceSpec(
    "chat_accounts", kept=("hash_account",), renamed={"account_number": "account"}
)
CHAT_TRANSCRIPTS = SourceSpec(
    "chat_transcripts",
    kept=("message_text", "message_technician", "message_customer"),
    renamed={"bold_id": "session_id"},
)
ACCOUNTS = SourceSpec("accounts")
CUSTOMER_ACCOUNTS = SourceSpec("customer_accounts")


def _family(*specs: SourceSpec) -> dict[str, SourceSpec]:
    return {spec.name: spec for spec in specs}


MODEM_HEALTH = _family(
    ACCESSIBILITY, ATTAINABILITY, SERVICE_QUALITY, INTERMITTENCY, USAGE_RANKED, MAC_USAGE
)
USAGE = _family(USAGE_RANKED_OWN, MAC_USAGE_OWN)
WIFI = _family(WHIX)
SUPPORT = _family(SUPPORT_CASES, CASE_HEADERS)
SPEECH = _family(SESSIONS_BOOKED, CATEGORIES, SESSIONS_CATEGORIES, CONVERSATIONS)
CHAT = _family(CHAT_SESSIONS, CHAT_ACCOUNTS, CHAT_TRANSCRIPTS)
CUSTOMERS = _family(ACCOUNTS, CUSTOMER_ACCOUNTS)

ALL_SPECS = {**MODEM_HEALTH, **USAGE, **WIFI, **SUPPORT, **SPEECH, **CHAT, **CUSTOMERS}
