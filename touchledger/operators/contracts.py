"""Data contracts: each returns the rows that break it. An empty result is a pass.

Contracts that look at one row at a time can also be counted together, in one pass over their table
(``count_failing``); a run uses that form.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchledger.config import MODELS
from touchledger.functions import exact_sum
from touchledger.operators.attribution import CREDIT_DIGITS, each_model


class ContractViolation(RuntimeError):
    """At least one contract has violations; results must not be published."""


def expect_unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once.

    Surrogate keys, 32 hexadecimal digits, are shuffled as the 16 bytes that they stand for; any other text as it is.
    """
    known, value = df.filter(F.col(col).isNotNull()), F.col(col)
    rows = F.count(F.lit(1)).alias("rows")
    if df.schema[col].dataType != T.StringType():
        return known.groupBy(value.alias("value")).agg(rows).filter(F.col("rows") > 1)
    key = value.rlike(r"^[0-9a-f]{32}\z")
    return (known.groupBy(F.when(key, F.unhex(value)).alias("_key"), F.when(~key, value).alias("_text")).agg(rows)
            .filter(F.col("rows") > 1)
            .select(F.coalesce("_text", F.lower(F.hex("_key"))).alias("value"), "rows"))


def repeated_hashes(columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(contract, hash) of the 64-bit hashes that occur more than once in a column; one shuffle for all columns.

    Only a contract's number and the hash of each value move, not the value.
    """
    names = list(columns)
    stacked = reduce(DataFrame.unionAll, [
        df.filter(F.col(col).isNotNull()).select(F.lit(k).alias("_contract"), F.xxhash64(col).alias("_hash"))
        for k, (df, col) in enumerate(columns.values())])
    twice = stacked.groupBy("_contract", "_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    return twice.select(F.element_at(F.array(*map(F.lit, names)), F.col("_contract") + 1).alias("contract"),
                        F.col("_hash").alias("hash"))


def count_repeated(columns: dict[str, tuple[DataFrame, str]]) -> dict[str, int]:
    """Contract -> number of values that occur more than once, for several columns.

    Two equal values have equal hashes. So a column without a repeated hash is clean, and of another one only the rows
    whose hash is repeated are compared by their values.
    """
    hashes = repeated_hashes(columns)
    suspects = {r["contract"] for r in hashes.select("contract").distinct().collect()}
    out = dict.fromkeys(columns, 0)
    for name in sorted(suspects):
        df, col = columns[name]
        own = hashes.filter(F.col("contract") == name).select("hash")
        rows = df.select(col, F.xxhash64(col).alias("hash")).join(own, "hash", "left_semi")
        out[name] = expect_unique(rows, col).count()
    return out


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(col).isNull())


def expect_relationship(child: DataFrame, ccol: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Child values the parent does not have; a missing child value passes."""
    values = child.filter(F.col(ccol).isNotNull()).groupBy(F.col(ccol).alias("value")).agg(
        F.count(F.lit(1)).alias("rows"))
    return values.join(parent.select(F.col(pcol).alias("value")), "value", "left_anti")


def expect_accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the vocabulary."""
    return (df.filter(~F.col(col).isin(*values)).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("rows")))


def credit_sums_to_one(attribution: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Deals that hand out more or less than one credit in a model.

    Every row's credit is rounded, so each adds up to half a unit of its last digit to the tolerance.
    """
    rounding = F.col("rows") * F.lit(0.5 * 10.0 ** -CREDIT_DIGITS)
    return (attribution.groupBy("deal_id", "model")
            .agg(F.sum("credit").alias("total_credit"), F.count(F.lit(1)).alias("rows"))
            .filter(F.abs(F.col("total_credit") - 1) > F.lit(tolerance) + rounding).drop("rows"))


def count_deal_credit(opps: DataFrame, attribution: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Violations of ``credit_sums_to_one`` and ``every_deal_in_every_model``, from one aggregate by deal.

    Models beyond the known ones are not looked at here; they break the vocabulary of ``model``.
    """
    of = {m: F.col("model") == m for m in MODELS}
    sums = attribution.groupBy("deal_id").agg(
        *[F.sum(F.when(is_m, F.col("credit"))).alias(f"credit_{m}") for m, is_m in of.items()],
        *[F.count_if(is_m).alias(f"rows_{m}") for m, is_m in of.items()])
    known = opps.groupBy("deal_id").agg(F.count(F.lit(1)).alias("deals"))

    def off(m: str) -> Column:
        rounding = F.col(f"rows_{m}") * F.lit(0.5 * 10.0 ** -CREDIT_DIGITS)
        return (F.abs(F.col(f"credit_{m}") - 1) > F.lit(tolerance) + rounding).cast("bigint")

    def absent(m: str) -> Column:
        return F.when(F.coalesce(f"rows_{m}", F.lit(0)) == 0, F.col("deals"))

    def total(part) -> Column:
        return F.coalesce(F.sum(reduce(Column.__add__, [F.coalesce(part(m), F.lit(0)) for m in MODELS])), F.lit(0))

    counts = sums.join(known, "deal_id", "full").agg(total(off).alias("off"), total(absent).alias("absent"))
    return counts.select(F.inline(F.array(
        F.struct(F.lit("credit_sums_to_one").alias("contract"), F.col("off").alias("violations")),
        F.struct(F.lit("every_deal_in_every_model").alias("contract"), F.col("absent").alias("violations")))))


def every_deal_in_every_model(opps: DataFrame, attribution: DataFrame) -> DataFrame:
    """Deal x model pairs without any credit row."""
    expected = opps.select("deal_id").withColumn("model", each_model())
    return expected.join(attribution.select("deal_id", "model").distinct(), ["deal_id", "model"], "left_anti")


def no_credit_after_deal_created(attribution: DataFrame) -> DataFrame:
    """Credit for touches that came after the deal."""
    return attribution.filter(is_late())


def is_late() -> Column:
    return F.col("touched_at") > F.col("deal_created_at")


def credit_in_unit_interval(attribution: DataFrame) -> DataFrame:
    """Credit below zero or above one."""
    return attribution.filter(is_out_of_range())


def is_out_of_range() -> Column:
    return (F.col("credit") < 0) | (F.col("credit") > 1)


def won_revenue_reconciles(attribution: DataFrame, opps: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Models whose credited won revenue is not the won revenue of the CRM."""
    credited = attribution.groupBy("model").agg(exact_sum(F.col("credited_won_revenue")).alias("credited"))
    crm = (opps.filter("is_won").agg(F.sum("amount").alias("crm_won")).withColumn("model", each_model()))
    return (credited.join(crm, "model", "left")
            .filter(F.abs(F.col("credited") - F.col("crm_won")) > tolerance)
            .select("model", "credited", "crm_won"))


def count_failing(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Contract -> number of rows that meet its failure condition; one pass for all conditions."""
    counts = df.agg(*[F.count_if(failed).alias(name) for name, failed in conditions.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("contract"), F.col(f"`{name}`").alias("violations")) for name in conditions
    ])).alias("c")).select("c.*")


def summarise(contracts: dict[str, DataFrame], counted: list[DataFrame] | None = None) -> DataFrame:
    """Contract -> number of violations, one row each; ``counted`` adds results of ``count_failing``."""
    counts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("contract"), "violations")
              for name, df in contracts.items()]
    return reduce(DataFrame.unionByName, [*counts, *(counted or [])])


def contract_gate(contracts: dict[str, DataFrame], counted: list[DataFrame] | None = None,
                  known: dict[str, int] | None = None) -> DataFrame:
    """Summary of all contracts; raises when one is broken, so call it before publishing.

    Only one count per contract reaches the driver. ``known`` are counts that have been taken before, say by writes.
    """
    summary = summarise(contracts, counted)
    found = sorted([*map(tuple, summary.collect()), *(known or {}).items()])
    broken = [f"{name}: {n}" for name, n in found if n]
    if broken:
        raise ContractViolation("; ".join(broken))
    return summary.sparkSession.createDataFrame(found, "contract string, violations bigint")
