"""The contracts every run has to pass before its results are published."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.config import MODELS
from touchledger.operators import contracts as c
from touchledger.operators.identity import empty_phones, multiplying_phones, phone_conflicts, signal_conflicts
from touchledger.plans.rules import ACCEPTED, NOT_NULL, RELATIONSHIPS, UNIQUE, WATCHED, row_checks
from touchledger.plans.warehouse import Warehouse

# A layer's columns, given the warehouse and their names.
Reader = Callable[[Warehouse, str, list[str]], DataFrame]
# Layers several contracts read.
WRITTEN = ("identity_contacts", "identity_email_map", "identity_client_map", "touchpoints", "opportunities", "fct_attribution")


def _table(wh: Warehouse, name: str) -> DataFrame:
    return wh.shared(name) if name in WRITTEN else wh.latest(name)


def _layer(wh: Warehouse, name: str, columns: list[str]) -> DataFrame:
    """What a contract on these columns reads."""
    return _table(wh, name).select(*columns)


def unique(wh: Warehouse, read: Reader = _layer) -> dict[str, DataFrame]:
    return {f"unique:{t}.{col}": c.expect_unique(read(wh, t, [col]), col)
            for t, cols in UNIQUE.items() for col in cols}


def not_null(wh: Warehouse, read: Reader = _layer) -> list[DataFrame]:
    """Counts per table, one pass each."""
    return [c.count_failing(read(wh, t, cols), {f"not_null:{t}.{col}": F.col(col).isNull() for col in cols})
            for t, cols in NOT_NULL.items()]


def relationships(wh: Warehouse, read: Reader = _layer) -> dict[str, DataFrame]:
    return {f"relationship:{t}.{col}": c.expect_relationship(read(wh, t, [col]), col, _table(wh, parent), pcol)
            for t, col, parent, pcol in RELATIONSHIPS}


def accepted_values(wh: Warehouse, read: Reader = _layer) -> dict[str, DataFrame]:
    return {f"accepted_values:{t}.{col}": c.expect_accepted_values(read(wh, t, [col]), col, values)
            for t, col, values in ACCEPTED}


def credit_rows(wh: Warehouse, credit: DataFrame | None = None) -> DataFrame:
    """The two invariants of single credit rows."""
    return c.count_failing(wh.shared("fct_attribution") if credit is None else credit, {
        "no_credit_after_deal_created": c.is_late(), "credit_in_unit_interval": c.is_out_of_range()})


def credit_totals(wh: Warehouse, credit: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three invariants of sums and pairs."""
    credit, opps = wh.shared("fct_attribution") if credit is None else credit, wh.shared("opportunities")
    return {
        "credit_sums_to_one": c.credit_sums_to_one(credit),
        "every_deal_in_every_model": c.every_deal_in_every_model(opps, credit),
        "won_revenue_reconciles": c.won_revenue_reconciles(credit, opps),
    }


def ambiguous(wh: Warehouse) -> dict[str, DataFrame]:
    """Phones, addresses and signal keys that more than one person has."""
    return {"unambiguous_phones": phone_conflicts(wh.latest("stg_contacts")),
            "unambiguous_addresses": c.expect_unique(_table(wh, "identity_email_map"), "email"),
            "unambiguous_signals": signal_conflicts(wh.latest("stg_signals"), wh.latest("identity_people"))}


def check_phones(wh: Warehouse) -> DataFrame:
    """What keeps phones from multiplying contacts, on staging alone: before they are joined. Raises when one is broken.

    The few ambiguous phones that may be left are reported with the other ambiguous keys.
    """
    contacts = wh.latest("stg_contacts")
    return c.contract_gate({"phones_multiply_contacts": multiplying_phones(contacts), "phones_with_digits": empty_phones(contacts)})


def check_unambiguous(wh: Warehouse) -> DataFrame:
    """The contracts that keep a shared key from multiplying rows. Raises when one is broken."""
    return c.contract_gate(ambiguous(wh))


def counted_on_write(wh: Warehouse) -> dict[str, int]:
    """Contracts of single rows and of the won revenue, from what the writes of the layers have counted."""
    seen = wh.workspace.observed
    counts = {name: seen[t][name] for t in WATCHED for name in row_checks(t)}
    won, credited = seen["opportunities"]["won"], [seen["fct_attribution"][f"won:{m}"] for m in MODELS]
    counts["won_revenue_reconciles"] = sum(
        x is not None and won is not None and abs(x - won) > Decimal("0.01") for x in credited)
    return counts


def check_all(wh: Warehouse) -> DataFrame:
    """The 43 contracts, and the ambiguous phones and signal keys. Raises when one is broken.

    The layers are written first, if they are not yet, and their rows are counted on the way.
    """
    wh.materialise(WATCHED)
    known = counted_on_write(wh)
    known |= c.count_repeated({f"unique:{t}.{col}": (wh.shared(t), col) for t, cols in UNIQUE.items() for col in cols})
    keys = {k: v for k, v in ambiguous(wh).items() if k != "unambiguous_addresses"}  # one of the 43
    deals = c.count_deal_credit(wh.shared("opportunities"), wh.shared("fct_attribution"))
    return c.contract_gate({**relationships(wh), **keys}, [deals], known)
