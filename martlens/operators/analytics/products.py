"""Product questions: q11-q15, q22, q27."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.exprs import age_month_number, dbl, lit_date, ratio, rnd
from martlens.operators.analytics.common import item_dates, items_per_product
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_inventory, base_products, base_reviews


def q11_low_stock(t: RetailTables, p: Params) -> DataFrame:
    inv = base_inventory(t).filter(F.col("current_stock") < p.low_stock)
    return (base_products(t).select("product_id", "product_name").join(inv, "product_id")
            .select("product_id", "product_name", "current_stock",
                    F.when(F.col("current_stock") < p.low_stock, "reorder_alert")
                     .otherwise("enough_stock").alias("stock_status")))


def _rating_stats(t: RetailTables) -> DataFrame:
    return (base_reviews(t).groupBy("product_id")
            .agg(F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n"),
                 F.count(F.lit(1)).alias("review_count")))


def q12_avg_rating(t: RetailTables, p: Params) -> DataFrame:
    return (base_products(t).select("product_id", "product_name").join(_rating_stats(t), "product_id")
            .select("product_id", "product_name", rnd(ratio("rating_sum", "rating_n"), 2).alias("avg_rating")))


def _last_sale(t: RetailTables) -> DataFrame:
    return item_dates(t).groupBy("product_id").agg(F.max("order_date").alias("last_order_date"))


def q13_no_recent_sales(t: RetailTables, p: Params) -> DataFrame:
    cutoff = F.date_sub(lit_date(p.q13_ref), p.q13_days)
    last = F.col("last_order_date")
    return (base_products(t).select("product_id", "product_name")
            .join(_last_sale(t), "product_id", "left")
            .filter(last.isNull() | (last < cutoff))
            .select("product_id", "product_name", "last_order_date"))


def q14_category_margin(t: RetailTables, p: Params) -> DataFrame:
    g = base_products(t).groupBy("category").agg(
        ratio(F.sum("selling_price"), F.count("selling_price")).alias("avg_price"),
        ratio(F.sum("unit_cost"), F.count("unit_cost")).alias("avg_cost"))
    return (g.select("category",
                     rnd(ratio(F.col("avg_price") - F.col("avg_cost"), "avg_price") * 100, 2)
                     .alias("profit_margin_percent"))
            .orderBy(F.col("profit_margin_percent").desc_nulls_first()))


def _top_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows whose value is the group's maximum (ties kept, NULL values last).

    ``dense_rank() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so a group holding most rows only forwards its leaders."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn("_rk", F.dense_rank().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def q15_best_seller(t: RetailTables, p: Params) -> DataFrame:
    sales = (items_per_product(t).select("product_id", F.col("revenue").alias("total_sales"))
             .join(base_products(t).select("product_id", "product_name", "category"), "product_id"))
    return (_top_per_group(sales, "category", "total_sales")
            .orderBy(F.col("total_sales").desc_nulls_first())
            .select("category", "product_id", "product_name", dbl("total_sales").alias("total_sales")))


def q22_product_dashboard(t: RetailTables, p: Params) -> DataFrame:
    sales = item_dates(t).groupBy("product_id").agg(
        F.sum("net_amount").alias("rev"), F.sum("quantity").alias("units"),
        F.max("order_date").alias("last_sale_date"))
    reviews = _rating_stats(t)
    units = F.coalesce(F.col("units"), F.lit(0))
    status = (F.when(units >= p.q22_hot, "Hot")
              .when(units.between(p.q22_moderate, p.q22_hot - 1), "Moderate").otherwise("Slow"))
    return (base_products(t).select("product_id")
            .join(sales, "product_id", "left")
            .join(reviews, "product_id", "left")
            .join(base_inventory(t).select("product_id", "current_stock"), "product_id", "left")
            .select("product_id",
                    dbl(F.coalesce("rev", F.lit(0))).alias("total_revenue"),
                    units.cast("bigint").alias("total_units_sold"),
                    F.coalesce(rnd(ratio("rating_sum", "rating_n"), 2), F.lit(0.0)).alias("avg_rating"),
                    F.coalesce("review_count", F.lit(0)).cast("bigint").alias("review_count"),
                    F.coalesce("current_stock", F.lit(0)).cast("bigint").alias("current_inventory"),
                    "last_sale_date", status.alias("product_status")))


def q27_product_lifecycle(t: RetailTables, p: Params) -> DataFrame:
    prod = base_products(t).select("product_id", "product_name", "launch_date")
    # a row per product and day before the join: a hot product's items never meet in one task
    sales = item_dates(t).groupBy("product_id", "order_date").agg(F.sum("net_amount").alias("net_amount"))
    od, ld = F.col("order_date"), F.col("launch_date")
    # equi-join on product_id with the launch window as a residual predicate
    win = (sales.join(prod, "product_id")
           .filter((od >= ld) & (od < F.add_months(ld, p.q27_months)))
           .withColumn("mn", age_month_number(od, ld)))
    piv = win.groupBy("product_id", "product_name", "launch_date").agg(
        *[rnd(F.coalesce(F.sum(F.when(F.col("mn") == i, F.col("net_amount"))), F.lit(0)), 2).alias(f"m{i}")
          for i in (1, 2, 3)])
    m1, m2, m3 = F.col("m1"), F.col("m2"), F.col("m3")
    trend = (F.when((m1 < m2) & (m2 < m3), "Increasing")
             .when((m1 > m2) & (m2 > m3), "Declining").otherwise("Stable"))
    return (piv.select("product_id", "product_name", "launch_date",
                       F.datediff(lit_date(p.q27_ref), ld).alias("days_since_launch"),
                       "m1", "m2", "m3", trend.alias("sales_trend"))
            .orderBy("product_id"))
