"""Row numbers in an order, without bringing a group or the whole into one task.

Rows are range-sorted and written with their partition and their place in it. A row's number is that place plus the rows
of the partitions before, a table of one row per partition. Because the order decides the ranges, a group of any size is
spread over as many tasks as its rows need, provided the order has no ties of that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns that a placed table has beside its own.
PLACE = ("_part", "_row")


def place_rows(df: DataFrame, order: list) -> DataFrame:
    """Rows sorted by ``order`` over all partitions, with their place. Write the result before numbering it."""
    return (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_part", F.spark_partition_id())
            .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))


def number_rows(placed: DataFrame, name: str) -> DataFrame:
    """Adds each row's number in the order that a written table was placed in, from 1."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # one row per partition, whatever the data
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_before", *PLACE))
