"""The six base views: the semantic layer every business question reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.dates import MONTH
from martlens.functions.exprs import month_start, net_amount
from martlens.plans.tables import RetailTables


def base_orders(t: RetailTables) -> DataFrame:
    # a table stored by month has the month as its partition column
    month = F.col(MONTH) if MONTH in t.orders.columns else month_start("order_date").alias(MONTH)
    return t.orders.select("order_id", "customer_id", "order_date", month,
                           "order_status", "payment_method", "shipping_country", "final_total")


def base_order_items(t: RetailTables) -> DataFrame:
    return t.order_items.select("order_item_id", "order_id", "product_id", "quantity",
                                "unit_price", "discount_percent",
                                net_amount().alias("net_amount"))


def base_products(t: RetailTables) -> DataFrame:
    return t.products.select("product_id", "product_name", "category", "subcategory",
                             "unit_cost", "selling_price", "launch_date", "is_active")


def base_customers(t: RetailTables, with_active: bool = False) -> DataFrame:
    cols = ["customer_id", "signup_date", "country", "customer_tier"]
    # is_active is a stored column, which the table has once cleaning.fix_is_active is applied
    return t.customers.select(*cols, *(["is_active"] if with_active else []))


def base_reviews(t: RetailTables) -> DataFrame:
    return (t.customer_reviews.filter(F.col("is_verified_purchase") == F.lit(True))
            .select("product_id", "customer_id", "rating", "review_date"))


def base_inventory(t: RetailTables) -> DataFrame:
    return (t.inventory.groupBy("product_id")
            .agg(F.sum("stock_quantity").alias("current_stock"),
                 F.max("last_updated").alias("last_updated")))
