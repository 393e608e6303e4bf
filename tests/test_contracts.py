import pytest
from frames import rows
from pyspark.sql import functions as F

from touchledger.operators import contracts as c


def test_generic_contracts_return_the_violations(frame):
    df = frame("k bigint; v string", (1, "a"), (1, "b"), (2, None), (None, "a"), (None, "z"))
    parent = frame("id string", ("a",), (None,))
    assert rows(c.expect_unique(df, "k")) == [(1, 2)]
    assert c.expect_not_null(df, "k").count() == 2
    assert rows(c.expect_relationship(df, "v", parent, "id"), "value") == [("b", 1), ("z", 1)]
    assert rows(c.expect_accepted_values(df, "v", ["a", "b"])) == [("z", 1)]


CREDIT = ("deal_id bigint; model string; credit double; touched_at timestamp; deal_created_at timestamp; "
          "credited_won_revenue double")


def test_invariants_catch_broken_credit(frame):
    created = "2025-01-10 00:00:00"
    good = [(1, m, 1.0, "2025-01-10 00:00:00", created, 10.0)
            for m in ("first_touch", "last_non_direct", "linear", "w_shaped", "time_decay")]
    opps = frame("deal_id bigint; is_won boolean; amount decimal(12,2)", (1, True, "10.00"))
    fine = frame(CREDIT, *good)
    checks = (lambda f: c.credit_sums_to_one(f), lambda f: c.every_deal_in_every_model(opps, f),
              lambda f: c.no_credit_after_deal_created(f), lambda f: c.credit_in_unit_interval(f),
              lambda f: c.won_revenue_reconciles(f, opps))
    assert [check(fine).count() for check in checks] == [0] * 5
    bad = frame(CREDIT, *good[:4], (1, "linear", -0.5, "2025-01-10 00:00:01", created, 5.0))
    assert [check(bad).count() for check in checks] == [1, 1, 1, 1, 1]
    within = frame(CREDIT, (1, "linear", 0.999995, None, created, 10.009))
    assert c.credit_sums_to_one(within).count() == 0 and c.won_revenue_reconciles(within, opps).count() == 0


def test_gate_raises_on_any_violation(frame):
    df = frame("k bigint", (1,), (1,))
    assert rows(c.contract_gate({"filled": c.expect_not_null(df, "k")})) == [("filled", 0)]
    with pytest.raises(c.ContractViolation, match="unique: 1"):
        c.contract_gate({"filled": c.expect_not_null(df, "k"), "unique": c.expect_unique(df, "k")})


def test_row_contracts_are_counted_in_one_pass(frame):
    df = frame("k bigint; v string", (1, None), (None, None), (3, "x"))
    counted = c.count_failing(df, {"not_null:t.k": F.col("k").isNull(), "not_null:t.v": F.col("v").isNull()})
    assert rows(counted, "contract") == [("not_null:t.k", 1), ("not_null:t.v", 2)]
    with pytest.raises(c.ContractViolation, match="not_null:t.k: 1; not_null:t.v: 2"):
        c.contract_gate({}, [counted])


@pytest.mark.parametrize("touches", [3000, 7000, 1_000_000])
def test_rounded_credit_of_many_touches_adds_up_to_one(spark, touches):
    from touchledger.config import MODELS
    from touchledger.functions import snap
    from touchledger.operators.attribution import CREDIT_DIGITS

    # the widest spread of weights a model can have, for each of them
    weights = {m: w for m, w in zip(MODELS, ("if(id = 0, 1.0, 0.0)", "if(id = 1, 1.0, 0.0)", f"1D / {touches}",
                                             f"if(id < 3, 0.3D, 0.1D / ({touches} - 3))", f"(id + 1) * 2D / {touches} / ({touches} + 1)"))}
    rows_ = spark.range(touches).selectExpr("1L as deal_id", f"stack({len(MODELS)}, " + ", ".join(
        f"'{m}', cast({w} as double)" for m, w in weights.items()) + ") as (model, weight)")
    credit = rows_.filter("weight > 0").withColumn("credit", snap(F.col("weight"), CREDIT_DIGITS))
    assert c.credit_sums_to_one(credit).count() == 0
    off = credit.withColumn("credit", F.when(F.col("model") == "w_shaped", F.col("credit") * 1.05).otherwise(F.col("credit")))
    assert [r["model"] for r in c.credit_sums_to_one(off).collect()] == ["w_shaped"]


def test_a_thousandth_too_much_is_reported(frame):
    bad = frame("deal_id bigint; model string; credit double", (1, "linear", 0.501), (1, "linear", 0.5))
    assert c.credit_sums_to_one(bad).count() == 1


def test_repeated_values_of_many_columns_are_found_by_their_hashes(spark, frame):
    clean = spark.range(500).selectExpr("id", "concat('v', id) as name")
    broken = frame("k bigint; v string", (1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, None), (3, None))
    columns = {"clean.id": (clean, "id"), "clean.name": (clean, "name"), "broken.k": (broken, "k"), "broken.v": (broken, "v")}
    assert c.count_repeated(columns) == {"clean.id": 0, "clean.name": 0, "broken.k": 1, "broken.v": 1}
    text = c.repeated_hashes(columns)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_values_that_share_a_hash_are_no_repeats(frame, monkeypatch):
    monkeypatch.setattr(c.F, "xxhash64", lambda col: F.length(col).cast("bigint"))
    df = frame("v string", ("a",), ("b",), ("cc",), ("dd",), ("dd",))
    assert c.count_repeated({"v": (df, "v")}) == {"v": 1}


def test_both_deal_contracts_come_from_one_aggregate(frame):
    from touchledger.config import MODELS

    opps = frame("deal_id bigint", (1,), (2,), (3,))
    credit = frame("deal_id bigint; model string; credit double", *[(1, m, 0.5) for m in MODELS for _ in range(2)],
                   *[(2, m, 1.0) for m in MODELS[1:]], (9, "linear", 0.7), (9, "nobody", 0.2))
    got = dict(rows(c.count_deal_credit(opps, credit)))
    assert got == {"credit_sums_to_one": c.credit_sums_to_one(credit.filter("model <> 'nobody'")).count(),
                   "every_deal_in_every_model": c.every_deal_in_every_model(opps, credit).count()}
    assert got == {"credit_sums_to_one": 1, "every_deal_in_every_model": 6}
    assert dict(rows(c.count_deal_credit(opps.limit(0), credit.limit(0)))) == {"credit_sums_to_one": 0, "every_deal_in_every_model": 0}


def test_a_write_takes_counts_along(spark, frame, tmp_path):
    from touchledger.plans.workspace import Workspace

    workspace = Workspace(spark, str(tmp_path))
    df = frame("k bigint; v string", (1, None), (None, None), (3, "x"))
    again = workspace.settle(df, "t", {"no_k": F.count_if(F.col("k").isNull()), "sum": F.sum("k")})
    assert workspace.observed == {"t": {"no_k": 1, "sum": 4}} and again.count() == 3
    workspace.settle(df.repartition(3).limit(0), "none", {"n": F.count("k")})
    assert workspace.observed["none"] == {"n": 0}


def test_repeated_keys_are_shuffled_as_bytes_and_given_as_text(frame):
    key = "0123456789abcdef" * 2
    values = [key, key, key.upper(), key.upper(), key + "\n", key + "\n", key[:-1], "x", "x", "x", "", "", None, None, "f" * 32]
    found = c.expect_unique(frame("k string", *[(v,) for v in values]), "k")
    assert found.dtypes == [("value", "string"), ("rows", "bigint")]
    assert sorted(map(tuple, found.collect())) == sorted([(key, 2), (key.upper(), 2), (key + "\n", 2), ("x", 3), ("", 2)])
    assert "unhex" in found._jdf.queryExecution().executedPlan().toString()
    assert c.expect_unique(frame("k bigint", (1,), (1,), (2,)), "k").collect() == [(1, 2)]
