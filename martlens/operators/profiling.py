"""Profiling / exploratory validation: each operator returns the offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.exprs import gross_amount
from martlens.params import Params
from martlens.plans.tables import RetailTables


def null_counts(df: DataFrame) -> DataFrame:
    """One row: ``null_<column>`` = number of NULLs, for every column (one scan)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"null_{c}") for c in df.columns])


def prof_null_counts(t: RetailTables, p: Params) -> DataFrame:
    return null_counts(t.orders)


def prof_null_counts_promotion_usage(t: RetailTables, p: Params) -> DataFrame:
    return null_counts(t.promotion_usage)


def prof_null_counts_promotions(t: RetailTables, p: Params) -> DataFrame:
    return null_counts(t.promotions)


def prof_orphan_orders(t: RetailTables, p: Params) -> DataFrame:
    return (t.orders.select("order_id", "customer_id")
            .join(t.customers.select("customer_id").distinct(), "customer_id", "left_anti")
            .select("order_id", "customer_id"))


def prof_orphan_items(t: RetailTables, p: Params) -> DataFrame:
    return (t.order_items.select("product_id").join(t.products.select("product_id").distinct(), "product_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("orphan_items")))


def prof_unverified_reviews(t: RetailTables, p: Params) -> DataFrame:
    return t.customer_reviews.filter(F.col("is_verified_purchase") == F.lit(False))


def prof_review_purchase_match(t: RetailTables, p: Params) -> DataFrame:
    """Per review: the first order of that customer holding that product (NULL if
    none) and how many such purchases exist.  Purchases are aggregated per
    (customer, product) before the join, so the result has one row per review."""
    o = t.orders.select("order_id", "customer_id")
    bought = (t.order_items.select("order_id", "product_id").join(o, "order_id")
              .groupBy("customer_id", "product_id")
              .agg(F.min("order_id").alias("matched_order"), F.count(F.lit(1)).alias("n_matches")))
    return (t.customer_reviews.select("review_id", "customer_id", "product_id")
            .join(bought, ["customer_id", "product_id"], "left")
            .select("review_id", "customer_id", "product_id", "matched_order",
                    F.coalesce("n_matches", F.lit(0)).alias("n_matches")))


def _int_net_per_order(t: RetailTables) -> DataFrame:
    # the integer-division variant: discount_percent/100 truncates (A-5)
    q = F.col("quantity").cast("bigint") * F.col("unit_price") * (F.lit(1) - F.expr("discount_percent div 100"))
    return t.order_items.groupBy("order_id").agg(F.sum(q).alias("_s"))


def prof_total_vs_items_int(t: RetailTables, p: Params) -> DataFrame:
    o = t.orders.select("order_id", "total_amount").join(_int_net_per_order(t), "order_id", "left")
    qty = F.coalesce("_s", F.lit(0))
    return (o.filter(F.col("total_amount") != qty)
            .select("order_id", "total_amount", qty.alias("qty_sum"),
                    (F.col("total_amount") - qty).alias("difference")))


def prof_final_vs_items_int(t: RetailTables, p: Params) -> DataFrame:
    o = t.orders.select("order_id", "final_total").join(_int_net_per_order(t), "order_id", "left")
    qty = F.coalesce("_s", F.lit(0))
    return (o.filter(F.col("final_total") != qty)
            .select("order_id", F.col("final_total").cast("double").alias("final_total"), qty.alias("qty_sum"),
                    (F.col("final_total") - qty).cast("double").alias("difference")))


def prof_price_below_cost(t: RetailTables, p: Params) -> DataFrame:
    return (t.products.filter(F.col("selling_price").isNotNull() & F.col("unit_cost").isNotNull()
                              & (F.col("selling_price") < F.col("unit_cost")))
            .select("product_id", "selling_price", "unit_cost"))


def prof_promo_overuse(t: RetailTables, p: Params) -> DataFrame:
    return (t.promotions.filter(F.col("times_used").isNotNull() & F.col("max_uses").isNotNull()
                                & (F.col("times_used") > F.col("max_uses")))
            .select("promotion_id", "times_used", "max_uses",
                    (F.col("max_uses") - F.col("times_used")).alias("times_left")))


def prof_dup_email_trim(t: RetailTables, p: Params) -> DataFrame:
    return (t.customers.groupBy(F.lower(F.trim("email")).alias("mail"))
            .agg(F.count(F.trim("email")).alias("mail_count")).filter(F.col("mail_count") > 1))


def prof_dup_email_nospace(t: RetailTables, p: Params) -> DataFrame:
    norm = F.replace(F.lower(F.trim("email")), F.lit(" "), F.lit(""))
    return (t.customers.groupBy(norm.alias("email_norm")).agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def prof_dup_email_regex(t: RetailTables, p: Params) -> DataFrame:
    norm = F.regexp_replace(F.lower("email"), r"[\s]+", "")
    return (t.customers.groupBy(norm.alias("email_norm")).agg(F.count(F.lit(1)).alias("cnt"))
            .filter(F.col("cnt") > 1))


def prof_no_inventory(t: RetailTables, p: Params) -> DataFrame:
    return t.products.select("product_id").join(t.inventory.select("product_id").distinct(), "product_id", "left_anti")


def prof_no_orders(t: RetailTables, p: Params) -> DataFrame:
    return t.customers.select("customer_id").join(t.orders.select("customer_id").distinct(), "customer_id", "left_anti")


def prof_max_order_date(t: RetailTables, p: Params) -> DataFrame:
    return t.orders.agg(F.max("order_date").alias("last_order_date"))


def prof_bad_rating(t: RetailTables, p: Params) -> DataFrame:
    return t.customer_reviews.filter(~F.col("rating").between(1, 5)).select("review_id", "rating")


def prof_nonpositive_price(t: RetailTables, p: Params) -> DataFrame:
    return (t.products.filter((F.col("unit_cost") <= 0) | (F.col("selling_price") <= 0))
            .select("product_id", "product_name", "unit_cost", "selling_price"))


def prof_nonpositive_stock(t: RetailTables, p: Params) -> DataFrame:
    # LEFT JOIN + filter on the right side = inner join
    return (t.products.select("product_id")
            .join(t.inventory.select("product_id", "stock_quantity"), "product_id")
            .filter(F.col("stock_quantity") <= 0))


def prof_null_total(t: RetailTables, p: Params) -> DataFrame:
    o = t.orders.filter(F.col("total_amount").isNull()).select("order_id")
    g = t.order_items.groupBy("order_id").agg(F.sum(gross_amount()).alias("total_amount"))
    return o.join(g, "order_id", "left")


def prof_null_review_text(t: RetailTables, p: Params) -> DataFrame:
    return t.customer_reviews.filter(F.col("review_text").isNull())


def prof_total_above_gross(t: RetailTables, p: Params) -> DataFrame:
    g = t.order_items.groupBy("order_id").agg(F.sum(gross_amount()).alias("gross"))
    diff = F.col("final_total") - F.col("gross")
    return (t.orders.select("order_id", "final_total").join(g, "order_id", "left")
            .filter(diff > 0)
            .orderBy(diff.desc())
            .select("order_id", F.col("final_total").cast("double").alias("final_total"),
                    F.col("gross").alias("total_without_discount"), diff.cast("double").alias("difference")))


def prof_inactive(t: RetailTables, p: Params) -> DataFrame:
    from martlens.operators.cleaning import fix_is_active
    cu = t.customers if "is_active" in t.customers.columns else fix_is_active(t, p)
    return cu.filter(F.col("is_active") == F.lit(False))


OPS = {k: v for k, v in globals().items() if k.startswith("prof_") and callable(v)}
