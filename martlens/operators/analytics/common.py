"""Per-key pre-aggregates shared by several questions.

Aggregating the fact table on its join key *before* joining to the dimension
keeps the join one-row-per-key on the aggregated side: a hot customer or
product is absorbed by the map-side partial aggregation instead of fanning
out inside one join task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.plans.tables import RetailTables
from martlens.plans.views import base_order_items, base_orders


def orders_per_customer(t: RetailTables) -> DataFrame:
    """customer_id -> n_orders, spend (NULL if all totals NULL), last/first order date."""
    return (base_orders(t).groupBy("customer_id")
            .agg(F.count("order_id").alias("n_orders"),
                 F.sum("final_total").alias("spend"),
                 F.max("order_date").alias("last_order_date")))


def items_per_product(t: RetailTables) -> DataFrame:
    """product_id -> net revenue (NULL when every net amount is NULL), units."""
    return (base_order_items(t).groupBy("product_id")
            .agg(F.sum("net_amount").alias("revenue"), F.sum("quantity").alias("units")))


def item_dates(t: RetailTables) -> DataFrame:
    """Order items with their order's date (items LEFT JOIN orders)."""
    o = base_orders(t).select("order_id", "order_date")
    return base_order_items(t).join(o, "order_id", "left")


def first_two_orders(t: RetailTables, tie_break: bool = True) -> DataFrame:
    """customer_id -> first and second order date by (order_date NULLS LAST[, order_id]).

    ``row_number() <= 2`` lets Spark place a partial WindowGroupLimit before
    the shuffle, so a customer owning a third of all orders still sends at
    most two rows per map task.
    """
    from pyspark.sql import Window
    order = [F.col("order_date").asc_nulls_last()]
    if tie_break:
        order.append(F.col("order_id").asc())
    w = Window.partitionBy("customer_id").orderBy(*order)
    ranked = (base_orders(t).select("customer_id", "order_id", "order_date")
              .withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= 2))
    return (ranked.groupBy("customer_id")
            .agg(F.max(F.when(F.col("rk") == 1, F.col("order_date"))).alias("first_order_date"),
                 F.max(F.when(F.col("rk") == 2, F.col("order_date"))).alias("second_order_date")))
