"""As-of lookups against plain windows over whole accounts, with accounts and blocks over several partitions."""

import contextlib
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from world import at, brute_force, chain, credits_of, deal, touch, written

from touchledger.config import AttributionConfig
from touchledger.operators import asof, journeys
from touchledger.operators.numbering import place_rows


@pytest.fixture
def uneven(spark):
    """Partitions stay as they were dealt, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def events(spark, rng, accounts, n):
    times = sorted((rng.choice(accounts), rng.randint(0, 400)) for _ in range(n))
    rows = [(a, t, 0, k + 1, k + 1 if rng.random() < 0.4 else None, None, t // 100, 1.0 + t % 7) for k, (a, t) in enumerate(times)]
    rows += [(rng.choice(accounts), t := rng.randint(-5, 420), 1, None, None, k, t // 100, None) for k in range(120)]
    return spark.createDataFrame(rows, "account int, at bigint, kind int, seq bigint, marked bigint, asked int, block bigint, weight double")


@pytest.mark.parametrize("accounts,n", [([1], 3000), ([1, 1, 1, 2, 3, 4], 1500), (list(range(60)), 300), ([5], 0)])
def test_equal_to_windows_over_whole_accounts(spark, uneven, accounts, n):
    rows = events(spark, random.Random(n), accounts, n)
    placed = written(place_rows(rows, asof.ORDER))
    assert placed.select("_part").distinct().count() > 1
    got = asof.as_of(placed).select("asked", "account", "n", "last_seq", "last_marked", F.round("block_weight", 6).alias("w"))
    every = Window.orderBy(*asof.ORDER).rowsBetween(Window.unboundedPreceding, 0)
    block = Window.partitionBy("account", "block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    want = (rows.withColumn("n", F.count("seq").over(every)).withColumn("last_seq", F.coalesce(F.max("seq").over(every), F.lit(0)))
            .withColumn("last_marked", F.max("marked").over(every)).withColumn("w", F.round(F.coalesce(F.sum("weight").over(block), F.lit(0.0)), 6))
            .where("kind = 1").select("asked", "account", "n", "last_seq", "last_marked", "w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("half_life", [0.02, 1.0, 7.0, 400.0])
def test_credit_of_a_busy_account_over_several_partitions(spark, uneven, half_life):
    rng = random.Random(7)
    touches = [touch(f"t{i:04d}", 1 if i % 3 else 2, at(-rng.random() * 200), rng.choice(["direct", "other", "referral", "linkedin_ads"]))
               for i in range(240)]
    deals = [deal(1, 1, 0), deal(2, 1, -30), deal(3, 2, -95.5), deal(4, 2, 5), deal(5, 9, 0), deal(6, 1, -199)]
    leads = [(1, at(-20)), (2, at(-100)), (4, at(5))]
    cfg = AttributionConfig(half_life_days=half_life)
    if half_life == 0.02:  # of the decay of old touches nothing is left in a double; those near the deal count
        touches += [touch(f"near{d[0]}", d[1], d[3]) for d in deals]
    credit = credits_of(chain(spark, deals, touches, leads, cfg)[3])
    want = {k: v for k, v in brute_force(deals, touches, leads, cfg).items()}
    assert {k for k, v in want.items() if v > 0} == set(credit)
    assert all(credit[k] == pytest.approx(want[k], abs=2e-8) for k in credit)


def test_no_pair_of_a_deal_and_a_touch_in_the_plan(spark):
    touches, deals = [touch("a", 1, at(-1))], [deal(1, 1, 0)]
    opps, anchors, _, _ = chain(spark, deals, touches)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        anchors.explain("simple")
    text = out.getvalue()
    assert "bucket" not in text and "touched_at" not in text and "Generate" not in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    # by partition of the placed table, or over one row per partition
    assert windows and all("_part" in line for line in windows)


def test_window_of_several_blocks(spark):
    assert journeys._blocks(AttributionConfig()) == (1, 90 * 86_400_000_000)
    number, width = journeys._blocks(AttributionConfig(half_life_days=0.02))
    assert number == 9 and number * width >= 90 * 86_400_000_000


def test_both_ways_to_the_landmarks_agree(spark, uneven):
    from pyspark.sql import DataFrame

    rng = random.Random(11)
    touches = [touch(f"t{i:04d}", rng.choice([1, 1, 2, 3]), at(-rng.randint(0, 250) / 2), rng.choice(["direct", "referral"])) for i in range(300)]
    deals = [deal(i, rng.choice([1, 2, 3, 4]), -rng.randint(0, 60)) for i in range(60)] + [(99, None, None, at(0), None, False, False)]
    leads = [(i, at(-rng.randint(0, 120))) for i in range(0, 60, 3)]
    opps, anchors, _, _ = chain(spark, deals, touches, leads)
    from world import TOUCH, timeline

    moments = spark.createDataFrame(leads, "deal_id bigint, lead_at timestamp")
    numbered = timeline(spark.createDataFrame(touches, TOUCH))
    other = journeys.deal_anchors_by_pairs(opps, numbered, moments)
    assert other.dtypes == anchors.dtypes

    def rounded(df: DataFrame):
        return sorted((tuple(r) for r in df.withColumn("decay_total", F.round("decay_total", 9)).collect()), key=str)
    assert rounded(other) == rounded(anchors)
    formed = journeys.candidate_pairs(opps, numbered).first()["pairs"]
    assert formed >= sum(r["touch_count"] or 0 for r in anchors.collect())


def test_dense_accounts_are_looked_up(spark):
    from touchledger.plans.queries import warehouse
    from touchledger.plans.warehouse import Warehouse

    feeds = warehouse(spark, "/root/testdata/sf0.001").feeds
    plans = {}
    for dense in (0.0, 1e9):
        wh = Warehouse(spark, feeds, AttributionConfig(dense_pairs=dense))
        plans[dense] = ("window_probes" in wh.__dict__, sorted(map(str, wh.deal_anchors.drop("decay_total").collect())), "window_probes" in wh.__dict__)
    assert plans[0.0][2] and not plans[1e9][2] and plans[0.0][1] == plans[1e9][1]
