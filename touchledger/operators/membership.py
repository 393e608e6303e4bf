"""Which rows may have a known key, before anything is shuffled.

The known keys set bits of a table of 64-bit words, in the place that their hash gives. The words, whose number is bounded,
are broadcast; a row whose bit is not set has no known key and goes no further. Some unknown keys share a bit with a known
one, about one in sixteen by default; the join that follows drops them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each known key, and at most: 2^27 bits are two million words.
BITS_EACH, BITS_MOST = 16, 1 << 27


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


@dataclass(frozen=True)
class Membership:
    """Words with the bits of the known keys; slots without a word have none."""

    words: DataFrame
    bits: int

    def may_hold(self, df: DataFrame, col: str) -> DataFrame:
        """The rows whose key may be known; a null key is not."""
        marked = df.filter(F.col(col).isNotNull()).withColumn("_bit", _bit(F.col(col), self.bits))
        hit = F.call_function("getbit", F.col("_word"), F.col("_bit") % 64) == 1
        return (marked.withColumn("_slot", F.floor(F.col("_bit") / 64))
                .join(F.broadcast(self.words), "_slot").filter(hit).drop("_slot", "_bit", "_word"))


def bits_for(keys: int) -> int:
    """Bits for so many keys: a power of two, at least one word."""
    return min(max(1 << (BITS_EACH * keys - 1).bit_length(), 64), BITS_MOST) if keys else 64


def words(keys: DataFrame, col: str, bits: int) -> DataFrame:
    """(_slot, _word) of the known keys. Write the result before it is used."""
    place = keys.filter(F.col(col).isNotNull()).select(_bit(F.col(col), bits).alias("_bit"))
    return (place.groupBy(F.floor(F.col("_bit") / 64).alias("_slot"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_bit") % 64).cast("int"))).alias("_word")))
