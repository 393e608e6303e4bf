"""Layers with faults, so that each contract can be seen to find what breaks it.

About one row in eight is spoilt: those whose key has an MD5 that begins with 0 or 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.plans.warehouse import Warehouse


def spoilt(key: str) -> Column:
    return F.md5(F.col(key).cast("string")) < "2"


def doubled(wh: Warehouse, name: str, columns: list[str]) -> DataFrame:
    """Some keys twice; each row is repeated on the spot, for a union would build the layer twice."""
    twice = F.when(spoilt(columns[0]), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return wh.latest(name).select(*columns, F.explode(twice).alias("_copy")).drop("_copy")


def emptied(wh: Warehouse, name: str, columns: list[str]) -> DataFrame:
    """Some cells without a value."""
    return wh.latest(name).select(*[F.when(~spoilt(c), F.col(c)).alias(c) for c in columns])


def strayed(wh: Warehouse, name: str, columns: list[str]) -> DataFrame:
    """Values that no parent and no vocabulary has, beside the right ones: of some numbers, and of every text."""
    df = wh.latest(name).select(*columns)
    value, kind = F.col(columns[0]), df.schema[columns[0]].dataType.simpleString()
    if kind == "string":
        return df.union(df.select(F.concat(F.lit("no "), value)))
    return df.union(df.filter(spoilt(columns[0])).select(-value - 1))


def credit(wh: Warehouse) -> DataFrame:
    """Credit rows that are too high in ``w_shaped``, missing in ``linear`` and later than the deal, for some deals."""
    bad, shaped = spoilt("deal_id"), F.col("model") == "w_shaped"
    return (wh.latest("fct_attribution").filter(~(bad & (F.col("model") == "linear")))
            .withColumn("credit", F.when(bad & shaped, F.col("credit") * 2 + 0.5).otherwise(F.col("credit")))
            .withColumn("credited_won_revenue", F.when(shaped, F.col("credited_won_revenue") * 2)
                        .otherwise(F.col("credited_won_revenue")))
            .withColumn("touched_at", F.when(bad, F.col("touched_at") + F.expr("interval 1000 days"))
                        .otherwise(F.col("touched_at"))))
