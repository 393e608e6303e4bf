from pyspark.sql import functions as F
import pytest

from touchledger import functions as fn

CHANNEL_CASES = [
    ("linkedin", "cpc", None, "linkedin_ads"), ("linkedin_ads", None, None, "linkedin_ads"),
    ("google", "cpc", None, "google_ads"), ("google", "email", None, "other"), ("google", None, "google.com", "organic_search"),
    ("adroll", "display", "linkedin.com", "retargeting_ads"), (None, None, "linkedin.com", "organic_social"),
    (None, None, "google.com", "organic_search"), (None, None, "bing.com", "organic_search"),
    (None, None, "g2.com", "referral"), (None, None, "capterra.com", "referral"),
    (None, None, "legaltechpartners.io", "referral"), (None, None, None, "direct"), ("", None, None, "other"),
    (None, None, "", "other"), ("newsletter", "email", None, "other"), (None, "cpc", None, "direct"),
    ("newsletter", None, "g2.com", "referral"),
]


@pytest.mark.parametrize("source,medium,referrer,expected", CHANNEL_CASES)
def test_channel_rules(frame, source, medium, referrer, expected):
    df = frame("s string; m string; r string", (source, medium, referrer))
    assert df.select(fn.classify_web_channel(F.col("s"), F.col("m"), F.col("r"))).first()[0] == expected


def test_surrogate_key_reads_null_as_empty(frame):
    import hashlib

    df = frame("a string; b string; c bigint", ("x", None, 7))
    got = df.select(fn.surrogate_key(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert got == hashlib.md5(b"x||7").hexdigest()


def test_phone_key_ignores_spelling(frame):
    df = frame("p string", ("+1 (415) 555-0134",), ("4155550134",), ("555-0134",), (None,), ("n/a",))
    assert [r[0] for r in df.select(fn.phone_key(F.col("p"))).collect()] == [
        "4155550134", "4155550134", "5550134", None, ""]


def test_days_between_keeps_microseconds_and_whole_days_cut_towards_zero(frame):
    df = frame("a timestamp; b timestamp", ("2024-01-02 12:00:00.000001", "2024-01-01 00:00:00"),
               ("2024-01-01 00:00:00", "2024-01-02 12:00:00"))
    got = df.select(fn.days_between(F.col("a"), F.col("b")), fn.whole_days_between(F.col("a"), F.col("b"))).collect()
    assert got[0][0] == pytest.approx(1.5 + 1e-6 / 86400, abs=1e-13) and got[0][1] == 1
    assert got[1][0] == -1.5 and got[1][1] == -1


def test_safe_ratio_guards_zero_and_rounds_half_up(frame):
    df = frame("n double; d double", (1.0, 0.0), (1.0, 8.0), (None, 2.0))
    assert [r[0] for r in df.select(fn.safe_ratio(F.col("n"), F.col("d"), 2)).collect()] == [None, 0.13, None]


def test_settle_treats_binary_noise_as_a_tie(frame):
    df = frame("x double", (30.014999999999997,), (30.0149,))
    assert [r[0] for r in df.select(fn.settle(F.col("x"), 2)).collect()] == [30.02, 30.01]


def test_exact_sum_is_a_decimal_that_no_order_changes(frame, spark):
    from decimal import Decimal

    df = frame("x double", (0.1,), (0.2,), (1e15 + 0.5,), (-3.75,), (None,), (1e-9,))
    for parts in (1, 3):
        assert df.repartition(parts).agg(fn.exact_sum(F.col("x"))).first()[0] == Decimal("999999999999997.05000000")
    assert df.filter("x is null").agg(fn.exact_sum(F.col("x"))).first()[0] is None
    third = spark.range(3_000_00).select((F.lit(100.0) / 3).alias("x")).agg(fn.exact_sum(F.col("x"))).first()[0]
    assert third == Decimal("33.33333333") * 300000


def test_snap_rounds_half_up(frame):
    df = frame("x double", (0.001953125,), (1 / 3,), (1.0,), (None,))
    assert [r[0] for r in df.select(fn.snap(F.col("x"), 8)).collect()] == [0.00195313, 0.33333333, 1.0, None]
