"""Constraint rules on hand rows, fused-run equivalence, rounding property."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlens.operators import quality, rules
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.testing import micro_tables

D = dt.date
P = Params()


def test_rules_null_semantics(spark):
    t = micro_tables(
        spark,
        customers=[(1, "a@x.com", "A", "A", D(2024, 1, 1), "IN", None), (1, None, "B", "B", D(2024, 1, 1), "IN", None),
                   (2, None, "C", "C", D(2024, 1, 1), "IN", None)],
        orders=[(10, None, D(2024, 1, 1), "s", "p", "IN", 1, None), (11, 99, D(2024, 1, 1), "s", "p", "IN", 1, None)],
        order_items=[(1, 10, 5, 0, 10, None), (2, 10, 5, 2, 10, 101)],
        promotions=[(1, "X", "bogus", 5, D(2024, 1, 2), D(2024, 1, 1), None, None)])
    pk = {(r.tbl, r.row_key, r.value) for r in rules.validate(t, rules.PK_RULES).collect()}
    assert ("customers", "1", "2") in pk
    uq = rules.validate(t, rules.UNIQUE_RULES).collect()
    assert uq == []  # NULL e-mails may repeat
    fk = {(r.tbl, r.row_key, r.value) for r in rules.validate(t, rules.FK_RULES).collect()}
    assert ("orders", "11", "99") in fk and not any(r[1] == "10" and r[0] == "orders" for r in fk)
    ck = {(r.tbl, r.col, r.row_key) for r in rules.validate(t, rules.CHECK_RULES).collect()}
    # quantity 0 fails, a NULL discount passes, 101 fails, start after end fails
    assert ("order_items", "quantity_positive", "1") in ck
    assert ("order_items", "discount_range", "2") in ck and ("order_items", "discount_range", "1") not in ck
    assert ("promotions", "start_before_end", "1") in ck
    av = rules.validate(t, rules.ACCEPTED_RULES).collect()
    assert [r.value for r in av] == ["bogus"]
    d = rules.rule_default(t, P).collect()[0]
    assert (d.max_uses, d.times_used) == (1, 0)


def test_fused_run_equals_per_check_run(spark):
    t = RetailTables.from_fixture(spark, "/root/testdata/sf0.001")
    p = Params.fixture()
    a = sorted(map(tuple, quality.dq_run_all(t, p).collect()))
    b = sorted(map(tuple, quality.dq_run_all_by_check(t, p).collect()))
    assert a == b


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=-10**7, max_value=10**7), st.integers(min_value=1, max_value=10**4),
       st.integers(min_value=0, max_value=4))
def test_rnd_matches_exact_half_up(spark_session_for_props, num, den, n):
    from martlens.functions.exprs import ratio, rnd
    got = spark_session_for_props.range(1).select(rnd(ratio(F.lit(num), F.lit(den)), n).alias("r")).collect()[0].r
    exact = (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP)
    assert got == float(exact)


def test_literal_and_intent_variants_differ_on_fixture(spark):
    import __spark_entry__ as E
    q = E.queries()
    sf = "/root/testdata/sf0.01"  # the survey's fixture scale for this property
    pairs = [("dq_c", "dq_c_intent"), ("b03_mom_growth", "b03_mom_growth_exact"),
             ("b20_dead_stock", "b20_dead_stock_intent"), ("al_today_high", "al_today_urgent"),
             ("q26_retention_curve", "q26_by_cohort")]
    for lit, intent in pairs:
        a = sorted(map(tuple, q[lit](spark, sf).collect()), key=str)
        b = sorted(map(tuple, q[intent](spark, sf).collect()), key=str)
        assert a != b, (lit, intent)
