"""Order questions: q16-q20."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.exprs import dbl, discount_amount, gross_amount, ratio, rnd
from martlens.functions.joins import with_scalar
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_order_items, base_orders


def q16_status_share(t: RetailTables, p: Params) -> DataFrame:
    o = base_orders(t)
    by_status = o.groupBy("order_status").agg(F.count(F.lit(1)).alias("status_count"))
    total = by_status.agg(F.sum("status_count").alias("total_count"))  # of the few groups, not of the orders again
    return (with_scalar(by_status, total)
            .select("order_status", "status_count",
                    rnd(ratio(F.col("status_count") * 100, "total_count"), 2).alias("status_percentage"))
            .orderBy(F.col("status_percentage").desc()))


def q17_items_per_order(t: RetailTables, p: Params) -> DataFrame:
    per_order = base_order_items(t).groupBy("order_id").agg(F.sum("quantity").alias("q"))
    return per_order.agg(rnd(ratio(F.sum("q"), F.count("q")), 2).alias("avg_items_per_order"))


def q18_payment_by_country(t: RetailTables, p: Params) -> DataFrame:
    use = base_orders(t).groupBy("shipping_country", "payment_method").agg(
        F.count(F.lit(1)).alias("usage_count"))
    w = Window.partitionBy("shipping_country").orderBy(F.col("usage_count").desc())
    return (use.withColumn("_rk", F.dense_rank().over(w)).filter(F.col("_rk") == 1)
            .orderBy(F.col("shipping_country").asc_nulls_last())
            .select("shipping_country", "payment_method", "usage_count"))


def q19_promo_orders(t: RetailTables, p: Params) -> DataFrame:
    used = t.promotion_usage.groupBy("order_id").agg(F.max("used_date").alias("promotion_used_date"))
    return (base_orders(t).join(used, "order_id")
            .orderBy(F.col("order_date").asc_nulls_last())
            .select("order_id", "order_date", "order_status", "shipping_country",
                    dbl("final_total").alias("final_total"), F.lit(True).alias("promotion_used"),
                    "promotion_used_date"))


def q20_avg_discount(t: RetailTables, p: Params) -> DataFrame:
    per_order = base_order_items(t).groupBy("order_id").agg(
        F.sum(gross_amount()).alias("gross"), F.sum(discount_amount()).alias("disc"))
    pct = ratio("disc", "gross") * 100
    return per_order.agg(rnd(ratio(F.sum(pct), F.count(pct)), 2).alias("avg_discount_percent_per_order"))
