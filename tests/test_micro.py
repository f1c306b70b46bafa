"""Hand-row fixtures for the semantics that are easy to get wrong."""

import datetime as dt
from decimal import Decimal

import pytest

from martlens.operators import cleaning, quality
from martlens.operators.analytics import customers, orders, products, promos, sales
from martlens.params import Params
from martlens.testing import micro_tables

D = dt.date
P = Params()


def dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def order(oid, cid, day, ft=100, status="Delivered", pay="UPI", country="IN", total=100):
    return (oid, cid, day, status, pay, country, total, dec(ft))


def test_second_order_same_day_and_retention(spark):
    t = micro_tables(spark, customers=[(1, "a@x.com", "A", "A", D(2024, 1, 1), "IN", None),
                                       (2, "b@x.com", "B", "B", D(2024, 1, 1), "IN", None)],
                     orders=[order(10, 1, D(2024, 1, 5)), order(11, 1, D(2024, 1, 5)),
                             order(20, 2, D(2024, 1, 1)), order(21, 2, D(2024, 3, 1)), order(22, 2, D(2024, 5, 1)),
                             order(30, None, None)])
    assert customers.q08_days_to_second(t, P).collect()[0][0] == 30.0
    r = customers.q26_retention_curve(t, P).collect()[0].asDict()
    assert r == {"customers_30_days": 1, "customers_60_days": 2, "customers_90_days": 2}


def test_top_products_tie_at_cutoff(spark):
    prods = [(i, f"p{i}", "C", "s", 1, 2, D(2024, 1, 1), True) for i in range(1, 13)]
    # revenue: product i sells 100 - i units, except 10 and 11 tie
    qty = {i: 100 - i for i in range(1, 13)}
    qty[11] = qty[10]
    items = [(i, 1, i, qty[i], 1, 0) for i in range(1, 13)]
    t = micro_tables(spark, products=prods, order_items=items)
    rows = sales.q02_top_products(t, P).collect()
    assert len(rows) == 10
    assert [r.product_id for r in rows] == list(range(1, 11))
    assert rows[-1].revenue_rank == 10


def test_mom_growth_uses_previous_present_month(spark):
    t = micro_tables(spark, orders=[order(1, 1, D(2024, 1, 10), ft=100), order(2, 1, D(2024, 3, 10), ft=150),
                                    order(3, 1, None, ft=50)])
    rows = {r.month_year: r for r in sales.q25_mom_growth(t, P).collect()}
    assert rows["2024-01"].previous_month_revenue == 0.0 and rows["2024-01"].growth_rate_percent is None
    assert rows["2024-03"].previous_month_revenue == 100.0 and rows["2024-03"].growth_rate_percent == 50.0
    # the NULL month sorts last (after March) and is averaged with the two months before it
    assert rows[None].previous_month_revenue == 150.0
    assert rows[None].three_month_moving_average == 100.0


def test_promo_double_usage_counts_order_twice(spark):
    t = micro_tables(spark,
                     orders=[order(1, 1, D(2024, 1, 1), ft=100), order(2, 1, D(2024, 1, 2), ft=300)],
                     order_items=[(1, 1, 7, 1, 100, 0), (2, 2, 7, 1, 300, 0)],
                     promotion_usage=[(1, 1, 1, True, D(2024, 1, 1)), (2, 2, 1, True, D(2024, 1, 1))])
    rows = promos.q23_promo_effectiveness(t, P).collect()
    assert {r.promotion_id for r in rows} == {1, 2}
    # order 1 counted once per usage: (100 + 100) / 2; order 2 has no promotion
    assert rows[0].avg_with_promotion == 100.0 and rows[0].avg_without_promotion == 300.0
    assert rows[0].most_popular_product == 7


def test_lifecycle_month_end_launch(spark):
    p = Params(q27_ref=D(2024, 12, 31))
    t = micro_tables(spark,
                     products=[(1, "p", "C", "s", 1, 2, D(2024, 1, 31), True)],
                     orders=[order(1, 1, D(2024, 2, 29)), order(2, 1, D(2024, 3, 31)), order(3, 1, D(2024, 4, 30))],
                     order_items=[(1, 1, 1, 1, 10, 0), (2, 2, 1, 1, 20, 0), (3, 3, 1, 1, 40, 0)])
    r = products.q27_product_lifecycle(t, p).collect()[0]
    # Feb 29 is 29 days after Jan 31 (month 1); Mar 31 is 2 months (month 3); Apr 30 is past the window
    assert (r.m1, r.m2, r.m3) == (10.0, 0.0, 20.0)
    assert r.days_since_launch == 335


def test_check_c_literal_differs_from_intent(spark):
    t = micro_tables(spark,
                     orders=[order(1, 100, D(2024, 1, 1)), order(2, 200, D(2024, 1, 1))],
                     order_items=[(1, 1, 5, 1, 10, 0), (2, 2, 5, 1, 10, 0)],
                     customer_reviews=[(1, 5, 100, 4, "ok", D(2024, 1, 5), True),
                                       (2, 6, 100, 4, "ok", D(2024, 1, 6), True)])
    lit = quality.check_op("c")(t, P).collect()[0]
    intent = quality.check_op("c", intent=True)(t, P).collect()[0]
    # literal: review 1 x the other buyer's item (1) + review 2 of a never-sold product (1)
    assert lit.row_count == 2 and lit.sample_ids == "5|100,6|100"
    assert intent.row_count == 1 and intent.sample_ids == "6|100"


def test_sample_is_first_ten_and_null_key_dropped(spark):
    emails = [(i, f"d{i % 3}@x.com", "f", "l", D(2024, 1, 1), "IN", None) for i in range(1, 10)]
    emails += [(20, None, "f", "l", D(2024, 1, 1), "IN", None), (21, None, "f", "l", D(2024, 1, 1), "IN", None)]
    t = micro_tables(spark, customers=emails)
    g = quality.check_op("g")(t, P).collect()[0]
    assert g.row_count == 4  # three duplicated addresses and the NULL group
    assert g.sample_ids == "d0@x.com,d1@x.com,d2@x.com"
    ords = [order(i, 1, D(2024, 1, 1), ft=None) for i in range(30, 0, -1)]
    h = quality.check_op("h")(t.replace(orders=micro_tables(spark, orders=ords).orders), P).collect()[0]
    assert h.row_count == 30 and h.sample_ids == ",".join(str(i) for i in range(1, 11))


def test_zero_denominators_give_null(spark):
    t = micro_tables(spark, products=[(1, "p", "FREE", "s", 0, 0, D(2024, 1, 1), True)])
    r = products.q14_category_margin(t, P).collect()[0]
    assert r.profit_margin_percent is None
    assert customers.q07_repeat_rate(micro_tables(spark), P).collect()[0][0] is None


def test_best_seller_keeps_ties(spark):
    t = micro_tables(spark,
                     products=[(1, "a", "C", "s", 1, 2, D(2024, 1, 1), True), (2, "b", "C", "s", 1, 2, D(2024, 1, 1), True),
                               (3, "c", "C", "s", 1, 2, D(2024, 1, 1), True)],
                     order_items=[(1, 1, 1, 2, 10, 0), (2, 1, 2, 1, 20, 0), (3, 1, 3, 1, 5, 0)])
    assert sorted(r.product_id for r in products.q15_best_seller(t, P).collect()) == [1, 2]


def test_heal_is_idempotent_for_orphans(spark):
    t = micro_tables(spark,
                     customers=[(1, "a@x.com", "A", "A", D(2024, 1, 1), "IN", None)],
                     orders=[order(1, None, D(2024, 1, 1), ft=None), order(2, 1, D(2024, 1, 1), ft=5)],
                     order_items=[(1, 1, 9, 1, 10, None), (2, 2, 9, 1, 10, 10)])
    healed, audit = cleaning.heal(t, P)
    assert cleaning.heal_orphan_orders_count(t, P).collect()[0][0] == 1
    assert cleaning.heal_order_totals_count(t, P).collect()[0][0] == 2
    assert {r.check_name for r in audit.collect()} == {"orders_invalid_customer", "orders_total_mismatch"}
    assert cleaning.heal_orphan_orders_count(healed, P).collect()[0][0] == 0
    assert cleaning.heal_order_totals_count(healed, P).collect()[0][0] == 0
    ids = {r.customer_id for r in healed.customers.collect()}
    assert ids == {1, -1}
    again = cleaning.heal_ghost_customer(healed, P)
    assert again.count() == 2
    totals = {r.order_id: r.final_total for r in healed.orders.collect()}
    assert totals == {1: Decimal("10.00"), 2: Decimal("9.00")}
    # the view keeps a NULL discount as NULL: check D still flags order 1 after healing
    d = quality.check_op("d")(healed, P).collect()
    assert d and d[0].sample_ids == "1"


def test_not_in_fix_and_verified_flag(spark):
    t = micro_tables(spark,
                     customers=[(1, "a@x.com", "A", "A", D(2024, 1, 1), "IN", None)],
                     orders=[order(1, 1, D(2024, 1, 1)), order(2, 77, D(2024, 1, 1)), order(3, None, D(2024, 1, 1))],
                     order_items=[(1, 1, 5, 1, 10, 0)],
                     customer_reviews=[(1, 5, 1, 4, None, D(2024, 1, 2), False), (2, 6, 1, 4, None, D(2024, 1, 2), True)])
    fixed = {r.order_id: r.customer_id for r in cleaning.fix_null_invalid_customer(t, P).collect()}
    assert fixed == {1: 1, 2: None, 3: None}
    assert cleaning.fix_null_invalid_customer_count(t, P).collect()[0][0] == 1
    flags = {r.review_id: r.is_verified_purchase for r in cleaning.fix_verified_flag(t, P).collect()}
    assert flags == {1: True, 2: False}


def test_status_share_and_payment_ties(spark):
    t = micro_tables(spark, orders=[order(1, 1, D(2024, 1, 1), pay="UPI"), order(2, 1, D(2024, 1, 1), pay="COD"),
                                    order(3, 1, D(2024, 1, 1), pay="UPI", status="Pending"),
                                    order(4, 1, D(2024, 1, 1), pay="COD", status="Pending")])
    pays = sorted(r.payment_method for r in orders.q18_payment_by_country(t, P).collect())
    assert pays == ["COD", "UPI"]
    shares = {r.order_status: r.status_percentage for r in orders.q16_status_share(t, P).collect()}
    assert shares == {"Delivered": 50.0, "Pending": 50.0}


@pytest.mark.parametrize("value,expected", [(0.125, 0.13), (1.005, 1.01), (2.675, 2.68), (-0.125, -0.13)])
def test_round_half_away_from_zero(spark, value, expected):
    from pyspark.sql import functions as F

    from martlens.functions.exprs import rnd
    assert spark.range(1).select(rnd(F.lit(value), 2)).collect()[0][0] == expected
