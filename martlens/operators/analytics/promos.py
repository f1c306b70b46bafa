"""Promotion question q23."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.exprs import dbl, discount_amount, ratio, rnd
from martlens.functions.joins import with_scalar
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_order_items, base_orders


def q23_promo_effectiveness(t: RetailTables, p: Params) -> DataFrame:
    pu = t.promotion_usage.select("promotion_id", "order_id")
    items = base_order_items(t)
    # one item aggregate per (order, product) serves both the money totals and
    # the product popularity; with items bucketed by order_id it needs no shuffle.
    # Joined per usage row, an order used with two promotions counts for each.
    pairs = items.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(discount_amount()).alias("disc"), F.sum("net_amount").alias("net"))
    used = pu.join(pairs, "order_id")
    times = pu.groupBy("promotion_id").agg(F.count("order_id").alias("times_used"))
    # most popular product per promotion: max of (count, -product_id) is a plain
    # aggregate (partial on the map side), ties go to the smallest product_id
    sold = (used.groupBy("promotion_id", "product_id")
            .agg(F.sum("n").alias("cnt"), F.sum("disc").alias("disc"), F.sum("net").alias("net"))
            .groupBy("promotion_id")
            .agg(F.round(F.sum("disc"), 2).alias("disc"), F.sum("net").alias("rev"),
                 F.max(F.struct(F.col("cnt"), (-F.col("product_id")).alias("neg_pid"))).alias("best"))
            .select("promotion_id", "disc", "rev", (-F.col("best.neg_pid")).alias("most_popular_product")))
    flagged = base_orders(t).select("order_id", "final_total").join(
        pu.select("order_id", F.lit(1).alias("has")), "order_id", "left")
    has = F.col("has").isNotNull()
    avg = flagged.agg(
        rnd(ratio(F.sum(F.when(has, F.col("final_total"))), F.count(F.when(has, F.col("final_total")))), 2)
        .alias("avg_with_promotion"),
        rnd(ratio(F.sum(F.when(~has, F.col("final_total"))), F.count(F.when(~has, F.col("final_total")))), 2)
        .alias("avg_without_promotion"))
    out = times.join(sold, "promotion_id", "left")
    return (with_scalar(out, avg)
            .select("promotion_id", "times_used", dbl("disc").alias("total_discount_given"),
                    "most_popular_product", "avg_with_promotion", "avg_without_promotion",
                    rnd(ratio(F.col("rev") - F.col("disc"), "disc"), 2).alias("roi"))
            .orderBy("promotion_id"))
