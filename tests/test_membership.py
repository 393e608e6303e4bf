"""Bits of known keys against the keys themselves."""

import pytest
from pyspark.sql import functions as F
from world import written

from touchledger.operators import membership


@pytest.mark.parametrize("known", [0, 1, 300, 5000])
def test_every_known_key_is_held_and_few_others(spark, known):
    keys = spark.range(known).selectExpr("concat('k', id) as client_id").unionAll(spark.range(1).selectExpr("cast(null as string)"))
    bits = membership.bits_for(keys.count() if known else 0)
    held = membership.Membership(written(membership.words(keys, "client_id", bits)), bits)
    rows = spark.range(20_000).selectExpr("concat('k', id) as client_id", "id").unionAll(spark.range(3).selectExpr("cast(null as string)", "id"))
    got = held.may_hold(rows, "client_id")
    assert got.columns == ["client_id", "id"] and got.filter(F.col("client_id").isNull()).count() == 0
    assert got.filter(F.col("id") < known).count() == known
    assert got.count() - known <= 0.12 * (20_000 - known)


def test_bits_are_bounded():
    assert membership.bits_for(0) == 64 and membership.bits_for(1) == 64 and membership.bits_for(5) == 128
    assert membership.bits_for(10**12) == membership.BITS_MOST


def test_a_full_set_of_bits_changes_nothing(spark):
    held = membership.Membership(spark.createDataFrame([(0, -1)], "_slot bigint, _word bigint"), 64)
    assert held.may_hold(spark.range(50).selectExpr("id as client_id"), "client_id").count() == 50
