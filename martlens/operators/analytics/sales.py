"""Revenue questions: q01-q03, q25, q28a-c."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.dates import in_dates
from martlens.functions.exprs import dbl, pg_dow, ratio, rnd
from martlens.functions.joins import with_scalar
from martlens.operators.analytics.common import items_per_product
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_orders, base_products


def q01_monthly_revenue(t: RetailTables, p: Params) -> DataFrame:
    # the range reaches the parquet scan (PushedFilters, and PartitionFilters on a table stored by month)
    o = base_orders(t.replace(orders=in_dates(t.orders, start=p.q01_start, before=p.q01_end)))
    return (o.groupBy("order_month").agg(F.sum("final_total").alias("total_sales"))
            .orderBy("order_month")
            .select(F.date_format("order_month", "yyyy-MM").alias("month"),
                    dbl("total_sales").alias("total_sales")))


def q02_top_products(t: RetailTables, p: Params, k: int = 10) -> DataFrame:
    rev = (items_per_product(t).select("product_id", F.coalesce("revenue", F.lit(0)).alias("total_revenue"))
           .filter(F.col("total_revenue") > 0))
    named = rev.join(base_products(t).select("product_id", "product_name"), "product_id")
    # Distributed top-k first (TakeOrderedAndProject), then rank the k rows:
    # every row ranked above the cut-off is inside the k, so the dense rank equals
    # the global one.  product_id breaks ties at the cut-off deterministically.
    top = named.orderBy(F.col("total_revenue").desc(), F.col("product_id").asc()).limit(k)
    w = Window.orderBy(F.col("total_revenue").desc())
    return (top.withColumn("revenue_rank", F.dense_rank().over(w))
            .orderBy("revenue_rank", "product_id")
            .select("product_id", "product_name", rnd("total_revenue", 2).alias("total_revenue"),
                    "revenue_rank"))


def q03_category_share(t: RetailTables, p: Params) -> DataFrame:
    per_cat = (base_products(t).select("product_id", "category")
               .join(items_per_product(t).select("product_id", "revenue"), "product_id", "left")
               .groupBy("category").agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("rev")))
    total = per_cat.agg(F.sum("rev").alias("all_rev"))
    return (with_scalar(per_cat, total)
            .select("category", rnd("rev", 2).alias("total_revenue"),
                    rnd(ratio(dbl("rev") * 100, "all_rev"), 2).alias("percent_of_total"))
            .orderBy(F.col("total_revenue").desc()))


def q25_mom_growth(t: RetailTables, p: Params) -> DataFrame:
    monthly = base_orders(t).groupBy("order_month").agg(F.sum("final_total").alias("rev"))
    # One row per calendar month: the un-partitioned windows below run over a
    # naturally bounded set (months), never over raw rows.
    w = Window.orderBy(F.col("order_month").asc_nulls_last())
    w3 = w.rowsBetween(-2, 0)
    prev = F.lag("rev").over(w)
    mavg = ratio(F.sum("rev").over(w3), F.count("rev").over(w3))
    return (monthly.select(
                "order_month",
                F.date_format("order_month", "yyyy-MM").alias("month_year"),
                dbl("rev").alias("total_revenue"),
                dbl(F.coalesce(prev, F.lit(0))).alias("previous_month_revenue"),
                rnd(ratio(dbl(F.col("rev") - prev), prev) * 100, 2).alias("growth_rate_percent"),
                rnd(mavg, 2).alias("three_month_moving_average"))
            .orderBy(F.col("order_month").asc_nulls_last()).drop("order_month"))


DAY_CASE = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _dow_name(dow) -> F.Column:
    expr = None
    for i, name in enumerate(DAY_CASE):
        expr = (F.when(dow == i, name) if expr is None else expr.when(dow == i, name))
    return expr


def q28a_day_of_week(t: RetailTables, p: Params) -> DataFrame:
    o = base_orders(t).withColumn("dow", pg_dow("order_date"))
    return (o.groupBy("dow").agg(F.count("order_id").alias("total_orders"),
                                 F.sum("final_total").alias("total_sales"))
            .orderBy(((F.col("dow") + 6) % 7).asc_nulls_last())
            .select(_dow_name(F.col("dow")).alias("day_of_week"), "total_orders",
                    dbl("total_sales").alias("total_sales")))


def q28b_monthly_season(t: RetailTables, p: Params) -> DataFrame:
    return (base_orders(t).groupBy("order_month")
            .agg(F.count("order_id").alias("total_orders"), F.sum("final_total").alias("total_sales"))
            .orderBy(F.col("order_month").asc_nulls_last())
            .select(F.date_format("order_month", "yyyy-MM").alias("year_month"), "total_orders",
                    dbl("total_sales").alias("total_sales")))


def q28c_holiday(t: RetailTables, p: Params) -> DataFrame:
    day_type = F.when(pg_dow("order_date") == 0, "Holiday").otherwise("Non-Holiday")
    return (base_orders(t).groupBy(day_type.alias("day_type"))
            .agg(F.count("order_id").alias("total_orders"),
                 dbl(F.sum("final_total")).alias("total_sales")))
