"""Chat sessions with account, transcript and contact history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.operators.counts import HISTORY_DAYS, add_contact_history
from ringcast.session import stage

# Output columns before and after the counts.
KEYS = ("account_number", "event_date")
TEXTS = ("message_text", "message_technician", "message_customer")


def chat_sessions(
    sessions: DataFrame, accounts: DataFrame, transcripts: DataFrame
) -> DataFrame:
    """Sessions with their account number and transcript texts."""
    return sessions.join(accounts, "hash_account").join(transcripts, "bold_id")


def chat_history(
    chats: DataFrame,
    contacts: DataFrame,
    day: str = "creation_time",
    windows: Sequence[int] = HISTORY_DAYS,
    compat: bool = False,
    days: DataFrame | None = None,
) -> DataFrame:
    """Chats with same-day and trailing contact counts.

    ``contacts`` are the events counted: support cases, or the chats
    themselves with ``day="chat_date"``. ``days`` may give the chats'
    (account_number, event_date) without their texts, for the day counts;
    without it the chats are staged, as they are read twice.
    """
    dated = chats.withColumnRenamed("chat_date", "event_date")
    if days is None:
        dated = stage(dated, "chats")
    counts = [f"chat_count_{n}" for n in (0, *sorted(windows))]
    return add_contact_history(
        dated, contacts, windows, prefix="chat_count_", day=day, compat=compat, days=days
    ).select(*KEYS, *counts, *TEXTS)
