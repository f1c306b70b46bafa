"""Cleaning and healing: UPDATE statements re-expressed as DataFrame -> DataFrame.

Every fix returns the corrected table; ``*_count`` companions return the
number of rows the fix changes (the UPDATE ... RETURNING count).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.exprs import gross_amount, lit_date, lit_ts, net_amount
from martlens.functions.joins import with_scalar
from martlens.params import Params
from martlens.plans.tables import RetailTables

# The ghost customer the heal step files orphaned orders under.
GHOST = dict(email="system.orphan@example.com", first_name="Unknown", last_name="Customer",
             country="Unknown", customer_tier="None")
AUTO = "SYSTEM_AUTO_HEAL"


def _count(df: DataFrame, cond, name: str = "changed_rows") -> DataFrame:
    return df.filter(cond).agg(F.count(F.lit(1)).alias(name))  # a filter reaches the scan


# --------------------------------------------------------------------------- fixes
def _dangling_customer(t: RetailTables) -> DataFrame:
    keys = t.customers.select("customer_id").distinct().withColumn("_known", F.lit(True))
    return t.orders.join(keys, "customer_id", "left")


def fix_null_invalid_customer(t: RetailTables, p: Params) -> DataFrame:
    o = _dangling_customer(t)
    return o.select(*[F.when(F.col("_known"), F.col("customer_id")).alias("customer_id") if c == "customer_id"
                      else F.col(c) for c in t.orders.columns])


def fix_null_invalid_customer_count(t: RetailTables, p: Params) -> DataFrame:
    o = _dangling_customer(t)
    return _count(o, F.col("customer_id").isNotNull() & F.col("_known").isNull())


def purchases(t: RetailTables) -> DataFrame:
    """Distinct (customer_id, product_id) pairs actually bought."""
    o = t.orders.select("order_id", "customer_id")
    return (t.order_items.select("order_id", "product_id").join(o, "order_id")
            .select("customer_id", "product_id").distinct())


def fix_verified_flag(t: RetailTables, p: Params) -> DataFrame:
    bought = purchases(t).withColumn("_bought", F.lit(True))
    r = t.customer_reviews.join(bought, ["customer_id", "product_id"], "left")
    return r.select(*[F.coalesce(F.col("_bought"), F.lit(False)).alias(c) if c == "is_verified_purchase"
                      else F.col(c) for c in t.customer_reviews.columns])


def fix_default_subcategory(t: RetailTables, p: Params) -> DataFrame:
    return t.products.withColumn("subcategory", F.coalesce("subcategory", F.lit("General")))


def fix_fill_total_amount(t: RetailTables, p: Params) -> DataFrame:
    gross = t.order_items.groupBy("order_id").agg(
        F.coalesce(F.sum(gross_amount()), F.lit(0)).alias("_gross"))
    o = t.orders.join(gross, "order_id", "left")
    return o.select(*[F.coalesce(F.col("total_amount"), F.col("_gross").cast("int")).alias(c)
                      if c == "total_amount" else F.col(c) for c in t.orders.columns])


def order_net_totals(items: DataFrame) -> DataFrame:
    """order_id -> ROUND(SUM(net with NULL discount as 0), 2): the healing math."""
    return items.groupBy("order_id").agg(
        F.round(F.sum(net_amount(coalesce_discount=True)), 2).cast("decimal(18,2)").alias("_calc"))


def fix_final_total(t: RetailTables, p: Params) -> DataFrame:
    o = t.orders.join(order_net_totals(t.order_items).withColumn("_has", F.lit(True)), "order_id", "left")
    return o.select(*[F.when(F.col("_has"), F.col("_calc")).otherwise(F.col("final_total"))
                      .cast("decimal(18,2)").alias(c) if c == "final_total" else F.col(c)
                      for c in t.orders.columns])


def fix_is_active(t: RetailTables, p: Params | None = None) -> DataFrame:
    ordered = (t.orders.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
               .withColumn("_ordered", F.lit(True)))
    cu = t.customers
    prior = F.coalesce(F.col("is_active"), F.lit(False)) if "is_active" in cu.columns else F.lit(False)
    cols = [c for c in cu.columns if c != "is_active"]
    return (cu.join(ordered, "customer_id", "left")
            .select(*cols, (prior | F.coalesce(F.col("_ordered"), F.lit(False))).alias("is_active")))


def fix_clamp_stock(t: RetailTables, p: Params) -> DataFrame:
    s = F.col("stock_quantity")
    return t.inventory.withColumn("stock_quantity", F.when(s < 0, F.lit(0)).otherwise(s).cast("int"))


def alter_add_column(df: DataFrame, name: str, default=None, dtype: str = "string") -> DataFrame:
    """ALTER TABLE ADD COLUMN [DEFAULT]: existing rows get the default (or NULL)."""
    return df.withColumn(name, F.lit(default).cast(dtype))


# --------------------------------------------------------------------------- heals
def heal_ghost_customer(t: RetailTables, p: Params) -> DataFrame:
    cu = t.customers
    vals = {"customer_id": F.lit(p.ghost_customer_id).cast("bigint"),
            "signup_date": lit_date(p.ghost_signup), "is_active": F.lit(False)}
    vals.update({k: F.lit(v) for k, v in GHOST.items()})
    ghost = t.spark.range(1).select(*[vals.get(c, F.lit(None)).cast(cu.schema[c].dataType).alias(c)
                                      for c in cu.columns])
    # INSERT ... ON CONFLICT DO NOTHING: only if the id is absent; one row tells, however often it is there
    there = cu.filter(F.col("customer_id") == F.lit(p.ghost_customer_id)).select("customer_id").limit(1)
    return cu.unionByName(ghost.join(there, "customer_id", "left_anti"))


def heal_orphan_orders(t: RetailTables, p: Params) -> DataFrame:
    return t.orders.withColumn("customer_id", F.coalesce("customer_id", F.lit(p.ghost_customer_id).cast("bigint")))


def heal_orphan_orders_count(t: RetailTables, p: Params) -> DataFrame:
    return _count(t.orders, F.col("customer_id").isNull())


def _totals_to_heal(t: RetailTables) -> DataFrame:
    calc = order_net_totals(t.order_items).withColumn("_has", F.lit(True))
    o = t.orders.join(calc, "order_id", "left")
    ft = F.col("final_total")
    change = F.col("_has") & (ft.isNull() | (F.coalesce(ft, F.lit(0)) != F.col("_calc")))
    return o.withColumn("_change", F.coalesce(change, F.lit(False)))


def heal_order_totals(t: RetailTables, p: Params) -> DataFrame:
    o = _totals_to_heal(t)
    return o.select(*[F.when(F.col("_change"), F.col("_calc")).otherwise(F.col("final_total"))
                      .cast("decimal(18,2)").alias(c) if c == "final_total" else F.col(c)
                      for c in t.orders.columns])


def heal_order_totals_count(t: RetailTables, p: Params) -> DataFrame:
    return _count(_totals_to_heal(t), F.col("_change"))


# Audit texts written by the two automatic heals.
AUDIT_ORPHANS = ("orders_invalid_customer", "UPDATE orders SET customer_id = -1",
                 "Reassigned {n} orphaned orders to Ghost Customer (-1).")
AUDIT_TOTALS = ("orders_total_mismatch", "UPDATE orders SET final_total = sub.calculated_total",
                "Auto-calculated and fixed {n} missing/incorrect order totals.")


def audit_rows(counts: DataFrame, ts: dt.datetime, after_id: int = 0) -> DataFrame:
    """One audit row per heal that changed a row, from one row (n_orphans, n_totals); ids follow ``after_id``."""
    rows = None
    for i, (col, (name, sql, note)) in enumerate((("n_orphans", AUDIT_ORPHANS), ("n_totals", AUDIT_TOTALS))):
        pre, post = note.split("{n}")
        part = counts.select(F.lit(i).alias("seq"), F.lit(name).alias("check_name"), F.col(col).alias("n"),
                             F.lit(sql).alias("sql_executed"),
                             F.concat(F.lit(pre), F.col(col).cast("string"), F.lit(post)).alias("notes"))
        rows = part if rows is None else rows.unionByName(part)
    place = F.row_number().over(Window.orderBy("seq")).cast("bigint")  # over two rows at most
    return rows.filter(F.col("n") > 0).select(
        (F.lit(after_id).cast("bigint") + place).alias("audit_id"), "check_name", lit_ts(ts).alias("fix_date"),
        F.lit(AUTO).alias("fixed_by"), "sql_executed", "notes")


def flagged_heal(t: RetailTables, p: Params) -> DataFrame:
    """Healed orders and, in two more columns, which heal changed the row."""
    o = _totals_to_heal(t)
    healed = {"customer_id": F.coalesce("customer_id", F.lit(p.ghost_customer_id).cast("bigint")),
              "final_total": F.when(F.col("_change"), F.col("_calc")).otherwise(F.col("final_total")).cast("decimal(18,2)")}
    return o.select(*[healed.get(c, F.col(c)).alias(c) for c in t.orders.columns],
                    F.col("customer_id").isNull().alias("_was_orphan"), F.col("_change").alias("_was_wrong"))


def heal_counts(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if("_was_orphan").alias("n_orphans"), F.count_if("_was_wrong").alias("n_totals"))


def heal_audit_log(t: RetailTables, p: Params, fix_date: dt.datetime | None = None) -> DataFrame:
    """One audit row per heal that changed at least one row; one pass over orders counts both."""
    return audit_rows(heal_counts(flagged_heal(t, p)), fix_date or dt.datetime.combine(p.dq_as_of, dt.time()))


def heal_manual_audit(spark, check_name: str, fixed_by: str, sql_executed: str, notes: str,
                      fix_date: dt.datetime) -> DataFrame:
    """A hand-entered audit row, in the audit table's shape (append it with sinks.append)."""
    from martlens import schemas
    return spark.createDataFrame([(None, check_name, fix_date, fixed_by, sql_executed, notes)],
                                 schemas.DATA_FIX_AUDIT)


def heal(t: RetailTables, p: Params) -> tuple[RetailTables, DataFrame]:
    """Ghost customer -> orphaned orders -> order totals; returns healed tables and audit rows."""
    audit = heal_audit_log(t, p)
    customers = heal_ghost_customer(t, p)
    orders1 = heal_orphan_orders(t, p)
    t1 = t.replace(customers=customers, orders=orders1)
    orders2 = heal_order_totals(t1, p)
    return t1.replace(orders=orders2), audit


OPS = {
    "fix_null_invalid_customer": fix_null_invalid_customer,
    "fix_null_invalid_customer_count": fix_null_invalid_customer_count,
    "fix_verified_flag": fix_verified_flag,
    "fix_default_subcategory": fix_default_subcategory,
    "fix_fill_total_amount": fix_fill_total_amount,
    "fix_final_total": fix_final_total,
    "fix_is_active": fix_is_active,
    "fix_clamp_stock": fix_clamp_stock,
    "heal_ghost_customer": heal_ghost_customer,
    "heal_orphan_orders": heal_orphan_orders,
    "heal_orphan_orders_count": heal_orphan_orders_count,
    "heal_order_totals": heal_order_totals,
    "heal_order_totals_count": heal_order_totals_count,
    "heal_audit_log": heal_audit_log,
}


# --------------------------------------------------------------------------- change counts
def fix_verified_flag_count(t, p):
    old = F.col("is_verified_purchase").alias("_old")
    r = t.customer_reviews
    fixed = fix_verified_flag(t.replace(customer_reviews=r.select("*", old)), p)
    return _count(fixed, ~F.col("_old").eqNullSafe(F.col("is_verified_purchase")))


def fix_default_subcategory_count(t, p):
    return _count(t.products, F.col("subcategory").isNull())


def fix_fill_total_amount_count(t, p):
    o = t.orders
    fixed = fix_fill_total_amount(t.replace(orders=o.select("*", F.col("total_amount").alias("_old"))), p)
    return _count(fixed, ~F.col("_old").eqNullSafe(F.col("total_amount")))


def fix_final_total_count(t, p):
    """UPDATE ... FROM counts every order with items, changed value or not."""
    has = t.order_items.select("order_id").distinct()
    return t.orders.select("order_id").join(has, "order_id", "left_semi").agg(
        F.count(F.lit(1)).cast("bigint").alias("changed_rows"))


def fix_is_active_count(t, p):
    """Customers set to TRUE (the UPDATE touches every customer that ordered)."""
    return _count(fix_is_active(t, p), F.col("is_active"))


def fix_clamp_stock_count(t, p):
    return _count(t.inventory, F.col("stock_quantity") < 0)


# --------------------------------------------------------------------------- fixtures
# The scenario seeding block (order-id ranges, customer ranges,
# start dates and day spans).  A deterministic hash of order_id stands in for
# random() so that reruns and other engines agree.
SCENARIOS = [
    (1, 1000, 1, 150, dt.date(2026, 2, 1), 26),
    (1001, 2500, 151, 300, dt.date(2026, 1, 15), 40),
    (2501, 3500, 451, 200, dt.date(2025, 9, 1), 60),
]


def unit_hash(key, salt: int) -> F.Column:
    """A value in [0, 1) from an integer key (no overflow for 64-bit keys)."""
    return (((key % 1000003) * 7919 + salt) % 1000003) / F.lit(1000003.0)


def fx_seed_scenarios(t: RetailTables, p: Params) -> DataFrame:
    o = t.orders
    oid = F.col("order_id")
    cust, day = F.col("customer_id"), F.col("order_date")
    for lo, hi, c0, n, start, span in reversed(SCENARIOS):
        inr = oid.between(lo, hi)
        cust = F.when(inr, F.floor(unit_hash(oid, 13) * n + c0).cast("bigint")).otherwise(cust)
        day = F.when(inr, F.date_add(lit_date(start), F.round(unit_hash(oid, 29) * span).cast("int"))).otherwise(day)
    return o.withColumn("customer_id", cust).withColumn("order_date", day).select(*o.columns)


def fx_manual_issue(spark, check_name: str, severity: str, details: str, detected_at: dt.datetime,
                    issue_id: int | None = None, row_count: int = 0, sample_ids: str | None = None) -> DataFrame:
    """A hand-inserted (drill) issue row in the issues table's shape."""
    from martlens import schemas
    return spark.createDataFrame([(issue_id, check_name, severity, row_count, sample_ids, details, detected_at)],
                                 schemas.DQ_ISSUES)


OPS.update({
    "fix_verified_flag_count": fix_verified_flag_count,
    "fix_default_subcategory_count": fix_default_subcategory_count,
    "fix_fill_total_amount_count": fix_fill_total_amount_count,
    "fix_final_total_count": fix_final_total_count,
    "fix_is_active_count": fix_is_active_count,
    "fix_clamp_stock_count": fix_clamp_stock_count,
    "fx_seed_scenarios": fx_seed_scenarios,
})
