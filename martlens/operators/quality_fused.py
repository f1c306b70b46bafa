"""The nightly heal -> 18-check run as a few fused passes.

Per-check operators (``quality.check_op``) each plan their own scans.  The full
run instead evaluates the checks that share a key in one pass over it:

* orders and customers: orders with their item totals (which also serve the total
  heal) meet the customers, one row an id, in one full outer join: A is an order
  without customer, J a customer without order; D, H, K, O are predicates of the order;
* items: one join to the product key set (B) plus row rules M and P;
* products and inventory: one row a product on either side, full outer joined: E, I, Q;
* reviews: one grouping-sets pass over items and orders counts items per product and per
  (product, customer); reviews look both up in one join for check C; L is a row rule;
* customers by e-mail (G) and by id (R): one pass that deals each row to both keys;
* promotions and their usage, one row a promotion on either side: F, N.

Rows that stand for several equal violations carry a weight. The violation rows then go
through ``quality.summarize_violations``.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.exprs import lit_date, lit_ts, net_amount, pg_concat
from martlens.operators import quality as Q
from martlens.operators.cleaning import GHOST
from martlens.params import Params
from martlens.plans.tables import RetailTables

SEQ = {c.letter: i for i, c in enumerate(Q.CHECKS)}


def _hit(letter: str, cond, sample, sort_n=None, sort_d=None, sort_s=None, sort_n2=None, sort_n3=None,
         weight=None):
    def typed(x, typ):
        return F.lit(None).cast(typ) if x is None else (F.col(x) if isinstance(x, str) else x).cast(typ)
    row = F.struct(F.lit(SEQ[letter]).alias("seq"), typed(sort_d, "date").alias("sort_d"),
                   typed(sort_s, "string").alias("sort_s"), typed(sort_n, "bigint").alias("sort_n"),
                   typed(sort_n2, "bigint").alias("sort_n2"), typed(sort_n3, "bigint").alias("sort_n3"),
                   typed(sample, "string").alias("sample"),
                   (F.lit(1) if weight is None else typed(weight, "bigint")).cast("bigint").alias("weight"))
    return F.when(cond, row)


def _explode(df: DataFrame, hits) -> DataFrame:
    arr = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return df.select(F.explode(arr).alias("v")).select("v.*")


def healed_orders(t: RetailTables, p: Params) -> DataFrame:
    """Healed orders with their item totals (both maths) and item counts attached."""
    ghost = F.lit(p.ghost_customer_id).cast("bigint")
    per_order = t.order_items.groupBy("order_id").agg(
        F.sum(net_amount()).alias("calc_view"),
        F.round(F.sum(net_amount(coalesce_discount=True)), 2).cast("decimal(18,2)").alias("calc_heal"),
        F.count(F.lit(1)).alias("n_items"))
    ft = F.col("final_total")
    change = F.col("n_items").isNotNull() & (ft.isNull() | (F.coalesce(ft, F.lit(0)) != F.col("calc_heal")))
    return t.orders.join(per_order, "order_id", "left").select(
        "order_id", F.coalesce("customer_id", ghost).alias("customer_id"), "order_date",
        F.when(F.coalesce(change, F.lit(False)), F.col("calc_heal")).otherwise(ft).cast("decimal(18,2)").alias("final_total"),
        "calc_view", "n_items")


def _orders_and_customers(t: RetailTables, p: Params) -> DataFrame:
    """A, D, H, J, K, O."""
    orders = healed_orders(t, p)
    # the ghost is a customer after the heal, if it was not one before
    ids = t.customers.select("customer_id", F.lit(1).alias("own"), F.lit(0).alias("ghost")).unionByName(
        t.spark.range(1).select(F.lit(p.ghost_customer_id).cast("bigint").alias("customer_id"), F.lit(0).alias("own"), F.lit(1).alias("ghost")))
    ids = ids.groupBy(F.col("customer_id").alias("known_id")).agg(
        F.when(F.sum("own") > 0, F.sum("own")).otherwise(F.max("ghost")).alias("n_customers"))
    o = orders.withColumn("is_order", F.lit(True)).join(ids, F.col("customer_id") == F.col("known_id"), "full")
    ft, is_order = F.col("final_total"), F.col("is_order").isNotNull()
    return _explode(o, [
        _hit("a", is_order & F.col("n_customers").isNull(), "order_id", sort_n="order_id"),
        _hit("d", F.col("n_items").isNotNull()
             & (F.coalesce(ft, F.lit(0)) != F.round(F.coalesce("calc_view", F.lit(0)), 2)), "order_id", sort_n="order_id"),
        _hit("h", is_order & (F.col("customer_id").isNull() | F.col("order_date").isNull() | ft.isNull()), "order_id",
             sort_n="order_id"),
        _hit("j", ~is_order, "known_id", sort_n="known_id", weight="n_customers"),
        _hit("k", F.col("order_date") > lit_date(p.dq_as_of), "order_id", sort_n="order_id", sort_d="order_date"),
        _hit("o", is_order & F.col("n_items").isNull(), "order_id", sort_n="order_id"),
    ])


def _items(t: RetailTables) -> DataFrame:
    """B, M, P."""
    known = t.products.select("product_id").distinct().withColumn("_p", F.lit(True))
    i = t.order_items.select("order_item_id", "product_id", "quantity", "unit_price", "discount_percent") \
        .join(known, "product_id", "left")
    d = F.col("discount_percent")
    return _explode(i, [
        _hit("b", F.col("_p").isNull(), "order_item_id", sort_n="order_item_id"),
        _hit("m", (F.col("quantity") <= 0) | (F.col("unit_price") < 0), "order_item_id", sort_n="order_item_id"),
        _hit("p", (d < 0) | (d > 100), "order_item_id", sort_n="order_item_id"),
    ])


def _customers(t: RetailTables, p: Params) -> DataFrame:
    """G, R: each customer counts for its e-mail and, if that is malformed, for its id."""
    email, ghost_id = F.col("email"), F.lit(p.ghost_customer_id).cast("bigint")
    none = F.lit(None)

    def row(kind, email, customer_id, own, there, ghost):
        return F.struct(F.lit(kind).alias("kind"), email.cast("string").alias("email"), customer_id.cast("bigint").alias("customer_id"),
                        F.lit(own).alias("own"), F.lit(there).alias("there"), F.lit(ghost).alias("ghost"))

    ghost_mail = F.lit(GHOST["email"])
    dealt = F.array(row("g", email, none, 1, 0, 0),
                    F.when(email.isNotNull() & ~email.rlike("(?i)" + Q.EMAIL_PATTERN), row("r", none, F.col("customer_id"), 1, 0, 0)),
                    # the ghost's row is added to its e-mail unless its id is there under any e-mail
                    F.when(F.col("customer_id") == ghost_id, row("g", ghost_mail, none, 0, 1, 0)))
    rows = t.customers.select(F.explode(F.filter(dealt, lambda x: x.isNotNull())).alias("c")).unionByName(
        t.spark.range(1).select(row("g", ghost_mail, none, 0, 0, 1).alias("c")))
    n = rows.groupBy("c.kind", "c.email", "c.customer_id").agg(
        (F.sum("c.own") + F.when(F.max("c.there") == 0, F.max("c.ghost")).otherwise(F.lit(0))).alias("n"))
    return _explode(n, [
        _hit("g", (F.col("kind") == "g") & (F.col("n") > 1), "email", sort_s="email"),
        _hit("r", F.col("kind") == "r", "customer_id", sort_n="customer_id", weight="n"),
    ])


def _products(t: RetailTables) -> DataFrame:
    """E, I, Q."""
    products = t.products.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("selling_price") < F.col("unit_cost")).alias("n_below"))
    stock = t.inventory.groupBy(F.col("product_id").alias("stocked_id")).agg(F.sum("stock_quantity").alias("stock"), F.lit(True).alias("is_stocked"))
    both = products.join(stock, F.col("product_id") == F.col("stocked_id"), "full")
    return _explode(both, [
        _hit("e", F.col("n_below") > 0, "product_id", sort_n="product_id", weight="n_below"),
        _hit("i", F.col("n").isNotNull() & F.col("is_stocked").isNull(), "product_id", sort_n="product_id", weight="n"),
        _hit("q", F.col("stock") < 0, "stocked_id", sort_n="stocked_id"),
    ])


def _reviews(t: RetailTables, p: Params) -> DataFrame:
    """C (pair counts as weights) and L."""
    orders = t.orders.select("order_id", F.coalesce("customer_id", F.lit(p.ghost_customer_id).cast("bigint")).alias("customer_id"))
    sold = (t.order_items.select("order_id", "product_id").join(orders, "order_id", "left")
            .groupingSets([["product_id"], ["product_id", "customer_id"]], "product_id", "customer_id")
            .agg(F.count(F.lit(1)).alias("n"), F.grouping("customer_id").alias("of_product")))
    verified, rating = F.col("is_verified_purchase") == F.lit(True), ~F.col("rating").between(1, 5)
    own = ["review_id", "product_id", "customer_id", "review_date", "verified", "bad_rating"]
    r = (t.customer_reviews.select("review_id", "product_id", "customer_id", "review_date", F.coalesce(verified, F.lit(False)).alias("verified"),
                                   F.coalesce(rating, F.lit(False)).alias("bad_rating"))
         .where("verified or bad_rating").groupBy(*own).agg(F.count(F.lit(1)).alias("times")))
    # a review looks up its product, and its product with its reviewer
    asked = r.withColumn("of_product", F.explode(F.array(F.lit(1), F.lit(0)).cast("array<tinyint>"))).withColumn(
        "buyer", F.when(F.col("of_product") == 0, F.col("customer_id")))
    sold = sold.select(F.col("product_id").alias("sold_id"), F.col("customer_id").alias("sold_to"), F.col("of_product").alias("sold_kind"), "n")
    same = (F.col("product_id") == F.col("sold_id")) & (F.col("of_product") == F.col("sold_kind")) & (
        F.coalesce("buyer", F.lit(0)) == F.coalesce("sold_to", F.lit(0))) & (F.col("buyer").isNull() == F.col("sold_to").isNull())
    # a review without reviewer has bought nothing, also where an item's order has no buyer
    same = same & ((F.col("of_product") == 1) | F.col("buyer").isNotNull())
    counted = asked.join(sold, same, "left").groupBy(*own, "times").agg(
        F.max(F.when(F.col("of_product") == 1, F.col("n"))).alias("n_items"), F.max(F.when(F.col("of_product") == 0, F.col("n"))).alias("n_bought"))
    pairs = F.when(F.col("n_items").isNull(), F.lit(1)).otherwise(F.col("n_items") - F.coalesce("n_bought", F.lit(0))) * F.col("times")
    return _explode(counted.withColumn("pairs", pairs), [
        _hit("c", F.col("verified") & (F.col("pairs") > 0), pg_concat("product_id", F.lit("|"), "customer_id"),
             sort_d="review_date", sort_n="product_id", sort_n2="customer_id", sort_n3="review_id", weight="pairs"),
        _hit("l", F.col("bad_rating"), "review_id", sort_d="review_date", sort_n="review_id", weight="times"),
    ])


def _promotions(t: RetailTables) -> DataFrame:
    """F, N."""
    own = t.promotions.groupBy("promotion_id").agg(F.count_if(F.col("times_used") > F.col("max_uses")).alias("n_over"))
    used = t.promotion_usage.groupBy(F.col("promotion_id").alias("used_id")).agg(F.count(F.lit(1)).alias("n_used"))
    return _explode(own.join(used, F.col("promotion_id") == F.col("used_id"), "full"), [
        _hit("f", F.col("n_over") > 0, "promotion_id", sort_n="promotion_id", weight="n_over"),
        _hit("n", F.col("n_used").isNotNull() & F.col("n_over").isNull(), "used_id", sort_n="used_id", weight="n_used"),
    ])


def fused_violations(t: RetailTables, p: Params) -> DataFrame:
    parts = [_orders_and_customers(t, p), _items(t), _customers(t, p), _products(t), _reviews(t, p), _promotions(t)]
    return functools.reduce(DataFrame.unionByName, parts)


def run_all_fused(t: RetailTables, p: Params, detected_at: dt.datetime | None = None) -> DataFrame:
    ts = detected_at or dt.datetime.combine(p.dq_as_of, dt.time())
    issues = Q.summarize_violations(fused_violations(t, p), Q.CHECKS)
    # at most 18 rows: a single-partition window is bounded
    return issues.select(
        F.row_number().over(Window.orderBy("seq")).cast("bigint").alias("id"),
        "check_name", "severity", F.col("row_count").cast("bigint").alias("row_count"), "sample_ids", "details",
        lit_ts(ts).alias("detected_at"))
