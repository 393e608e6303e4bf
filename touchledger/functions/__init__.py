"""Column -> Column helpers. All are built-in expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# How a web session's tags and referrer name its channel; the first rule that holds decides.
# A rule is the channel and what the columns have to be; None stands for NULL.
CHANNEL_RULES = (
    ("linkedin_ads", {"utm_source": ("linkedin", "linkedin_ads")}),
    ("google_ads", {"utm_source": ("google",), "utm_medium": ("cpc",)}),
    ("retargeting_ads", {"utm_source": ("adroll",)}),
    ("organic_social", {"referrer": ("linkedin.com",)}),
    ("organic_search", {"referrer": ("google.com", "bing.com")}),
    ("referral", {"referrer": ("g2.com", "capterra.com", "legaltechpartners.io")}),
    ("direct", {"utm_source": None, "referrer": None}),
    ("other", {}),
)


def classify_web_channel(utm_source: Column, utm_medium: Column, referrer: Column) -> Column:
    """Channel of a web session by the first of the rules that holds."""
    given = {"utm_source": utm_source, "utm_medium": utm_medium, "referrer": referrer}

    def holds(conditions: dict) -> Column:
        met = F.lit(True)
        for name, values in conditions.items():
            met = met & (given[name].isNull() if values is None else given[name].isin(*values))
        return met
    return F.coalesce(*[F.when(holds(conditions), F.lit(channel)) for channel, conditions in CHANNEL_RULES])


def surrogate_key(*cols: Column) -> Column:
    """md5 over the text of the columns joined by ``|``, NULL read as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def phone_key(phone: Column) -> Column:
    """Last ten digits of a phone number however it is written."""
    return F.right(F.regexp_replace(phone, r"\D", ""), F.lit(10))


def normal_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from ``earlier`` to ``later``, to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(DAY_MICROS))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Completed days from ``earlier`` to ``later``, cut towards zero."""
    return days_between(later, earlier).cast("int")


def time_bucket(ts: Column, days: int) -> Column:
    """Number of the ``days``-wide bucket the instant falls in."""
    return F.floor(F.unix_micros(ts) / F.lit(float(days * DAY_MICROS)))


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "month")


def settle(value: Column, scale: int, noise: int = 6) -> Column:
    """Round half up after dropping binary noise, so that a tie like x.xx5 goes up as in exact arithmetic."""
    return F.round(F.round(value, max(noise, scale + 4)), scale)


def snap(value: Column, digits: int) -> Column:
    """Half-up rounding of a non-negative double by plain arithmetic.

    For row-level values: ``round`` on doubles goes through text and costs several times as much.
    """
    unit = float(10 ** digits)
    return F.floor(value * F.lit(unit) + F.lit(0.5)) / F.lit(unit)


def exact_sum(value: Column, digits: int = 8) -> Column:
    """Sum of doubles kept to ``digits`` decimals each, as an exact decimal.

    The nearest whole numbers and what is left of each value are added up as two integers. So the sum does
    not depend on the order of the rows, stays exact for totals far beyond what a double can hold, and costs
    a fraction of decimal addition. The remainders lie on both sides of zero, which keeps their sum small.
    """
    whole = F.floor(value + F.lit(0.5))
    rest = F.floor((value - whole) * F.lit(float(10 ** digits)) + F.lit(0.5))
    unit = F.lit(Decimal(1).scaleb(-digits))
    return F.sum(whole).cast("decimal(20,0)") + F.sum(rest).cast("decimal(20,0)") * unit


def safe_ratio(num: Column, den: Column, scale: int) -> Column:
    """num / den rounded to ``scale`` digits; NULL instead of a division by zero."""
    ratio = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return settle(ratio, scale, 10)
