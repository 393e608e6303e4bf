"""As-of lookups on a timeline: what is known of an account's events up to a moment, without pairing the two.

Events and the moments that ask about them are sorted together by account and time, over all partitions, and written
(``numbering.place_rows``). Within a partition every answer is a running aggregate. What the partitions before add to it
comes from a table of one row per partition: counts and maxima run on over all of them, sums of one account and time
block only as far as that block reaches. So an account, a day or a block may be spread over any number of partitions, no
group is ever held as a whole, and a moment costs the same however many events its account has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Order in which events (``kind`` 0) and moments (``kind`` 1, so an event of the same time counts) are placed.
ORDER = ["account", "at", "kind", "seq"]


def _group(*names: str) -> Column:
    return F.struct(*[F.col(n) for n in names])


def _parts(placed: DataFrame) -> DataFrame:
    """One row per partition: what comes before it, and the account and block that it begins and ends with."""
    own = placed.groupBy("_part").agg(
        F.count("seq").alias("n"), F.max("seq").alias("seq"), F.max("marked").alias("marked"),
        F.min(_group(*ORDER[:2], "block")).alias("first"), F.max(_group(*ORDER[:2], "block")).alias("last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return own.select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.max("seq").over(before), F.lit(0)).alias("seq_before"), F.max("marked").over(before).alias("marked_before"),
        *[F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in ("account", "block")])


def _carried(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """For each partition: the weight that those before it have of the account and block that it begins with."""
    ends = parts.select("_part", F.col("last_account").alias("account"), F.col("last_block").alias("block"))
    given = (placed.join(F.broadcast(ends), ["_part", "account", "block"])
             .groupBy("_part", "account", "block").agg(F.sum("weight").alias("weight")))
    wanted = parts.select("_part", F.col("first_account").alias("account"), F.col("first_block").alias("block"),
                          F.lit(0.0).alias("weight"), F.lit(0).alias("gives"))
    both = wanted.unionByName(given.withColumn("gives", F.lit(1)))
    # two rows per partition at most, whatever the data
    before = Window.partitionBy("account", "block").orderBy("_part", "gives").rowsBetween(Window.unboundedPreceding, -1)
    return (both.withColumn("carried", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .where("gives = 0").select("_part", "carried"))


def as_of(placed: DataFrame) -> DataFrame:
    """The moments, with what their account's and all earlier events come to at that time.

    ``placed`` is a written table in ``ORDER`` with the columns account, at, kind, seq (of an event, increasing along the
    order), marked (the seq of events that count for ``last_marked``), block (a time block), weight (of an event), and
    whatever else moments carry. Added are ``n``, the number of events up to the moment; ``last_seq`` and
    ``last_marked``, the largest numbers, which may be those of an earlier account; and ``block_weight``, the weights of
    the moment's account within its block.
    """
    parts = _parts(placed)
    offsets = F.broadcast(parts.join(_carried(placed, parts), "_part"))  # one row per partition, whatever the data
    here = Window.partitionBy("_part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    block = Window.partitionBy("_part", "account", "block").orderBy("at", "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    running = (placed.withColumn("n", F.count("seq").over(here)).withColumn("last_seq", F.max("seq").over(here))
               .withColumn("last_marked", F.max("marked").over(here))
               .withColumn("block_weight", F.coalesce(F.sum("weight").over(block), F.lit(0.0)))
               .where("kind = 1"))
    continued = F.col("account").eqNullSafe(F.col("first_account")) & F.col("block").eqNullSafe(F.col("first_block"))
    added = {
        "n": F.col("n") + F.col("n_before"), "last_seq": F.greatest("last_seq", "seq_before"),
        "last_marked": F.greatest("last_marked", "marked_before"),
        "block_weight": F.col("block_weight") + F.when(continued, F.col("carried")).otherwise(0.0)}
    own = [c for c in placed.columns if c not in ("seq", "marked", "weight", "_part", "_row", *added)]
    return running.join(offsets, "_part").select(*own, *[c.alias(n) for n, c in added.items()])
