"""Retail tables derived from the provided TPC-H-like tables.

The deterministic mapping (FIXTURES.md) injects the defects the checks look
for by key arithmetic.  Each builder is lazy; a caller that wants to scan the
derived tables many times should write them once with ``sources.lake``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.exprs import lit_date
from martlens.functions.windows import number_rows
from martlens.sources.tpch import read_raw

EPOCH = dt.date(1995, 1, 1)


def _days_after_epoch(n) -> F.Column:
    return F.date_add(lit_date(EPOCH), n.cast("int"))


class FixtureBuilder:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ customers
    def customers(self) -> DataFrame:
        cu = self.raw("customer")
        na = self.raw("nation").select("n_nationkey", "n_name")
        k = F.col("c_custkey")
        email = (F.when(k % 97 == 5, F.lit(None).cast("string"))
                 .when(k % 89 == 3, F.concat(F.lit("not-an-email-"), k.cast("string")))
                 .when(k % 53 == 0, F.concat(F.lit("shared"), (k % 5).cast("string"), F.lit("@example.com")))
                 .when(k % 61 == 0, F.lit(" Shared1@Example.com "))
                 .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com"))))
        tier = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Gold")
                .when(F.col("c_mktsegment") == "BUILDING", "Silver")
                .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None).cast("string"))
                .otherwise("Bronze"))
        return (cu.join(na, cu.c_nationkey == na.n_nationkey)
                .select(k.cast("bigint").alias("customer_id"),
                        email.alias("email"),
                        F.concat(F.lit("First"), k.cast("string")).alias("first_name"),
                        F.col("c_name").alias("last_name"),
                        _days_after_epoch((k * 37) % 2400).alias("signup_date"),
                        F.when(k % 101 == 7, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country"),
                        tier.alias("customer_tier")))

    # ------------------------------------------------------------------ products
    def products(self) -> DataFrame:
        k = F.col("p_partkey")
        price = F.col("p_retailprice")
        unit_cost = F.when(k % 50 == 9, F.floor(price) + 25).otherwise(F.floor(price * (F.lit(40) + k % 40) / 100))
        return self.raw("part").select(
            k.cast("bigint").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.when(k % 180 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("subcategory"),
            unit_cost.cast("int").alias("unit_cost"),
            F.floor(price).cast("int").alias("selling_price"),
            _days_after_epoch((k * 53) % 2400).alias("launch_date"),
            (k % 10 != 0).alias("is_active"))

    # ------------------------------------------------------------------ order items
    def order_items(self) -> DataFrame:
        order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_shipdate"]
        # lines are numbered through all orders, so ids never meet however long an order is
        li = number_rows(self.raw("lineitem").select(*order), order, out="order_item_id")
        x = li.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("pk"),
            F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("ext"),
            F.col("l_discount").alias("disc"), "order_item_id")
        oid, pk = F.col("order_item_id"), F.col("pk")
        return x.select(
            oid.cast("bigint").alias("order_item_id"),
            F.col("order_id").cast("bigint").alias("order_id"),
            F.when(oid % 983 == 0, F.lit(9000000)).when(pk % 40 == 0, pk + 1).otherwise(pk)
             .cast("bigint").alias("product_id"),
            F.when(oid % 977 == 0, F.lit(0)).otherwise(F.col("qty")).cast("int").alias("quantity"),
            F.floor(F.col("ext") / F.col("qty")).cast("int").alias("unit_price"),
            F.when(oid % 41 == 0, F.lit(None)).when(oid % 991 == 0, F.lit(130))
             .otherwise(F.round(F.col("disc") * 100)).cast("int").alias("discount_percent"))

    # ------------------------------------------------------------------ orders
    def orders_base(self) -> DataFrame:
        """Orders without final_total (no dependency on order items)."""
        o = self.raw("orders")
        cu = self.raw("customer").select("c_custkey", "c_nationkey")
        na = self.raw("nation").select("n_nationkey", "n_name")
        k, ck = F.col("o_orderkey"), F.col("o_custkey")
        cust = (F.when(k % 211 == 0, F.lit(None))
                .when(k % 223 == 0, F.lit(9000000) + k)
                .when(ck % 25 == 0, ck + 1).otherwise(ck))
        status = (F.when(F.col("o_orderstatus") == "F", "Delivered")
                  .when(F.col("o_orderstatus") == "O", "Pending").otherwise("Shipped"))
        pay = (F.when(k % 4 == 0, "UPI").when(k % 4 == 1, "Card")
               .when(k % 4 == 2, "COD").otherwise("NetBanking"))
        return (o.join(cu, o.o_custkey == cu.c_custkey).join(na, F.col("c_nationkey") == na.n_nationkey)
                .select(k.cast("bigint").alias("order_id"),
                        cust.cast("bigint").alias("customer_id"),
                        F.when(k % 997 == 1, F.lit(None)).otherwise(F.col("o_orderdate").cast("date"))
                         .cast("date").alias("order_date"),
                        status.alias("order_status"), pay.alias("payment_method"),
                        F.col("n_name").alias("shipping_country"),
                        F.when(k % 301 == 0, F.lit(None)).otherwise(F.floor(F.col("o_totalprice")))
                         .cast("int").alias("total_amount")))

    def orders(self, items: DataFrame | None = None) -> DataFrame:
        items = items if items is not None else self.order_items()
        hundredths = F.col("quantity").cast("bigint") * F.col("unit_price") * (
            F.lit(100) - F.coalesce(F.col("discount_percent"), F.lit(0)))
        net = (items.groupBy("order_id")
               .agg((F.sum(hundredths).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)"))
                    .cast("decimal(18,2)").alias("net")))
        k = F.col("order_id")
        ft = (F.when(k % 19 == 4, F.lit(None))
              .when(k % 17 == 3, F.col("net") + 1).otherwise(F.col("net")))
        return (self.orders_base().join(net, "order_id", "left")
                .select("order_id", "customer_id", "order_date", "order_status", "payment_method",
                        "shipping_country", "total_amount", ft.cast("decimal(18,2)").alias("final_total")))

    # ------------------------------------------------------------------ inventory
    def inventory(self) -> DataFrame:
        k = F.col("p_partkey")
        w = F.col("w")
        # two warehouses per part: generated with explode, not a cross join
        return (self.raw("part").select("p_partkey").filter(k % 60 != 0)
                .withColumn("w", F.explode(F.array(F.lit(0), F.lit(1))))
                .select((k * 2 + w).cast("bigint").alias("inventory_id"),
                        k.cast("bigint").alias("product_id"),
                        F.when(w == 0, "North").otherwise("South").alias("warehouse_location"),
                        F.when(k % 70 == 11, F.lit(-8))
                         .otherwise(((k * 7919 + w * 31) % 60).cast("int") - 6).cast("int").alias("stock_quantity"),
                        F.lit("2001-07-01 00:00:00").cast("timestamp_ntz").alias("last_updated")))

    # ------------------------------------------------------------------ reviews
    def customer_reviews(self, items: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
        items = items if items is not None else self.order_items()
        orders = orders if orders is not None else self.orders_base()
        i = items.filter(F.col("order_item_id") % 13 == 0).select("order_item_id", "product_id", "order_id")
        o = orders.select("order_id", "customer_id", "order_date")
        oid = F.col("order_item_id")
        return (i.join(o, "order_id")
                .select(oid.alias("review_id"), "product_id",
                        F.when(oid % 5 == 0, F.col("customer_id") + 7).otherwise(F.col("customer_id"))
                         .cast("bigint").alias("customer_id"),
                        F.when(oid % 403 == 0, F.lit(7)).otherwise(F.lit(1) + oid % 5).cast("int").alias("rating"),
                        F.when(oid % 11 == 0, F.lit(None).cast("string")).otherwise(F.lit("review text")).alias("review_text"),
                        F.date_add(F.col("order_date"), 10).alias("review_date"),
                        (oid % 3 != 0).alias("is_verified_purchase")))

    # ------------------------------------------------------------------ promotions
    def promotions(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.raw("nation").select(
            (n + 1).cast("int").alias("promotion_id"),
            F.concat(F.lit("PROMO"), n.cast("string")).alias("promotion_code"),
            F.when(n % 2 == 0, "percentage").otherwise("fixed_amount").alias("discount_type"),
            (F.lit(5) + n % 20).cast("int").alias("discount_value"),
            _days_after_epoch(n * 80).alias("start_date"),
            _days_after_epoch(n * 80 + 60).alias("end_date"),
            (F.lit(50) + n).cast("int").alias("max_uses"),
            F.when(n % 6 == 1, F.lit(90)).otherwise(F.lit(20)).cast("int").alias("times_used"))

    def promotion_usage(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_orderdate")
        k = F.col("o_orderkey")
        first = o.filter(k % 7 == 0).select(
            (k * 2).alias("usage_id"), (F.lit(1) + k % 30).cast("int").alias("promotion_id"),
            k.alias("order_id"), F.lit(True).alias("discount_applied"),
            F.col("o_orderdate").cast("date").alias("used_date"))
        second = o.filter(k % 35 == 0).select(
            (k * 2 + 1).alias("usage_id"), (F.lit(1) + (k + 11) % 30).cast("int").alias("promotion_id"),
            k.alias("order_id"), F.lit(True).alias("discount_applied"),
            F.col("o_orderdate").cast("date").alias("used_date"))
        return first.unionByName(second).select(
            F.col("usage_id").cast("bigint"), "promotion_id", F.col("order_id").cast("bigint"),
            "discount_applied", "used_date")

    # ------------------------------------------------------------------ dq history
    def dq_issues(self) -> DataFrame:
        ev = self.raw("events").filter(F.col("event_type") == "error")
        e = F.col("event_id")
        sev = (F.when(e % 4 == 0, "HIGH").when(e % 4 == 1, "High")
               .when(e % 4 == 2, "MEDIUM").otherwise("CRITICAL"))
        return ev.select(
            e.cast("bigint").alias("id"),
            F.concat(F.lit("check_"), (F.col("user_id") % 7).cast("string")).alias("check_name"),
            sev.alias("severity"), (e % 50).cast("bigint").alias("row_count"),
            e.cast("string").alias("sample_ids"),
            F.concat(F.lit("detail "), (e % 3).cast("string")).alias("details"),
            F.col("ts").cast("timestamp_ntz").alias("detected_at"))

    def data_fix_audit(self) -> DataFrame:
        ev = self.raw("events").filter((F.col("event_type") == "signup") & (F.col("user_id") % 7 < 3))
        return ev.select(
            F.col("event_id").cast("bigint").alias("audit_id"),
            F.concat(F.lit("check_"), (F.col("user_id") % 7).cast("string")).alias("check_name"),
            F.col("ts").cast("timestamp_ntz").alias("fix_date"),
            F.lit("SYSTEM_AUTO_HEAL").alias("fixed_by"),
            F.lit(None).cast("string").alias("sql_executed"),
            F.lit(None).cast("string").alias("notes"))
