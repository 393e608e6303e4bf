"""Touchpoints: every touch of every system in one shape, tied to a person and an account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.functions import surrogate_key
from touchledger.operators.membership import Membership
from touchledger.operators.numbering import number_rows

_SHAPE = ["source_record_id", "person_id", "company_id", "touched_at", "channel", "touch_type", "source_system"]


def _touch(df: DataFrame, key: str | None, record: str, at: str, channel: Column, touch_type: Column,
           system: str) -> DataFrame:
    """A feed in touch shape, still to be matched on ``key``."""
    keep = [F.col(key)] if key else [F.col("person_id"), F.col("company_id")]
    return df.select(
        *keep, F.col(record).alias("source_record_id"), F.col(at).alias("touched_at"),
        channel.alias("channel"), touch_type.alias("touch_type"), F.lit(system).alias("source_system"))


def touchpoints(sessions: DataFrame, client_map: DataFrame, email_events: DataFrame, email_map: DataFrame,
                matched_signals: DataFrame, bot: DataFrame, calls: DataFrame,
                cookies: Membership | None = None) -> DataFrame:
    """Web sessions of known cookies, email clicks and replies, matched signals, bot replies, answered calls.

    The three feeds keyed by email address are stacked before the one join that finds person and account. With ``cookies``,
    the known ones, sessions of others are dropped before that of cookies, so that they are not shuffled.
    """
    sessions = cookies.may_hold(sessions, "client_id") if cookies else sessions
    # source_system and touch_type names, which touch ids are derived from.
    web = _touch(sessions, "client_id", "session_id", "started_at", F.col("channel"), F.lit("web_session"), "ga4")
    mails = _touch(email_events.filter(F.col("event_type").isin("click", "reply")), "email", "email_event_id",
                   "event_at", F.col("channel"), F.concat(F.lit("email_"), "event_type"), "smartlead")
    replies = _touch(bot.filter(F.col("bot_replied_at").isNotNull()), "email", "thread_id", "bot_replied_at",
                     F.lit("reply_bot"), F.lit("bot_reply"), "reply_bot")
    answered = _touch(calls.filter(F.col("outcome") != "no_answer"), "email", "call_id", "called_at",
                      F.lit("voice_agent"), F.lit("voice_call"), "voice_agent")
    spotted = _touch(matched_signals, None, "signal_id", "detected_at", F.lit("signal_engine"),
                     F.lit("signal_detected"), "clay")

    by_cookie = web.join(client_map.select("client_id", "person_id", "company_id"), "client_id")
    by_email = mails.unionByName(replies).unionByName(answered).join(email_map, "email")
    every = (by_cookie.select(*_SHAPE).unionByName(by_email.select(*_SHAPE)).unionByName(spotted.select(*_SHAPE)))
    return every.select(
        surrogate_key(F.col("source_system"), F.col("source_record_id")).alias("touchpoint_id"), *_SHAPE)


#: Order in which touches are placed: an account's timeline is a run of it.
TIMELINE = ["company_id", "touched_at", "touchpoint_id", "person_id"]


def account_touches(placed: DataFrame) -> DataFrame:
    """Touches with ``account_seq``, a number that is contiguous along each account's timeline.

    A look-back window is a contiguous run of that timeline. So touch numbers inside any deal follow from
    the first number in the window by subtraction, and no window function ever has to hold a whole deal,
    account or day. ``placed`` is the written table of touches, placed in the order of ``TIMELINE``.
    """
    numbered = number_rows(placed.drop("source_record_id", "source_system"), "account_seq")
    return numbered.filter(F.col("touched_at").isNotNull())
