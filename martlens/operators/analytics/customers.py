"""Customer questions: q04-q10, q21, q24, q26."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.exprs import dbl, lit_date, ratio, rnd
from martlens.operators.analytics.common import first_two_orders, orders_per_customer
from martlens.operators.cleaning import heal_ghost_customer, heal_orphan_orders
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_customers


def _customer_orders(t: RetailTables) -> DataFrame:
    """Every customer with its order aggregates (customers LEFT JOIN orders)."""
    return base_customers(t).join(orders_per_customer(t), "customer_id", "left")


def people(t: RetailTables, p: Params) -> RetailTables:
    """The tables as the customer questions read them: without the ghost customer if ``exclude_ghost`` asks for it."""
    if not p.exclude_ghost:
        return t
    ghost = F.col("customer_id").eqNullSafe(F.lit(p.ghost_customer_id).cast("bigint"))
    return t.replace(customers=t.customers.where(~ghost))


def q04_country_aov(t: RetailTables, p: Params) -> DataFrame:
    per_country = (_customer_orders(people(t, p)).filter(F.col("country").isNotNull())
                   .groupBy("country")
                   .agg(F.sum("spend").alias("spend"),
                        F.coalesce(F.sum("n_orders"), F.lit(0)).alias("n_orders")))
    return (per_country.select("country", rnd(ratio("spend", "n_orders"), 2).alias("avg_order_value"))
            .orderBy(F.col("avg_order_value").desc_nulls_first()))


def q05_signups_by_month(t: RetailTables, p: Params) -> DataFrame:
    t = people(t, p)
    m = F.trunc("signup_date", "MM")
    return (t.customers.groupBy(m.alias("m")).agg(F.count("customer_id").alias("total_signup_customers"))
            .orderBy(F.col("m").asc_nulls_last())
            .select(F.date_format("m", "yyyy-MM").alias("signup_month"), "total_signup_customers"))


def q06_customer_ltv(t: RetailTables, p: Params) -> DataFrame:
    return (_customer_orders(people(t, p))
            .select("customer_id", dbl(F.coalesce("spend", F.lit(0))).alias("customer_lifetime_value"))
            .orderBy("customer_id"))


def q07_repeat_rate(t: RetailTables, p: Params) -> DataFrame:
    n = F.coalesce("n_orders", F.lit(0))
    counts = _customer_orders(t).agg(F.count(F.lit(1)).alias("total"),
                                     F.count_if(n >= 2).alias("r2"), F.count_if(n >= 3).alias("r3"))
    return counts.select(rnd(ratio("r2", "total") * 100, 2).alias("repeat_purchase_rate_2_plus"),
                         rnd(ratio("r3", "total") * 100, 2).alias("repeat_purchase_rate_3_plus"))


def q08_days_to_second(t: RetailTables, p: Params) -> DataFrame:
    fs = first_two_orders(t).filter(F.col("second_order_date").isNotNull())
    gap = F.datediff("second_order_date", "first_order_date")
    return fs.agg(rnd(ratio(F.sum(gap), F.count(gap)), 2).alias("avg_days_until_second_order"))


def q09_churn_90(t: RetailTables, p: Params) -> DataFrame:
    days = F.datediff(lit_date(p.q09_ref), F.col("last_order_date"))
    return (base_customers(t).select("customer_id")
            .join(orders_per_customer(t).select("customer_id", "last_order_date"), "customer_id")
            .filter(F.col("last_order_date").isNotNull() & (days > p.q09_days))
            .select("customer_id", days.alias("days_since_last_order")))


def _tier(spend, gold, silver) -> F.Column:
    return F.when(spend >= gold, "Gold").when(spend >= silver, "Silver").otherwise("Bronze")


def q10_tier_distribution(t: RetailTables, p: Params) -> DataFrame:
    spend = F.coalesce("spend", F.lit(0))
    return (_customer_orders(t).groupBy(_tier(spend, p.q10_gold, p.q10_silver).alias("customer_tier"))
            .agg(F.count(F.lit(1)).alias("customer_count"))
            .orderBy(F.col("customer_count").desc()))


def q21_cohort_compare(t: RetailTables, p: Params) -> DataFrame:
    cu = base_customers(t).select("customer_id", "signup_date")
    cohorts = None
    for label, start, end in p.q21_cohorts:
        part = (cu.filter((F.col("signup_date") >= lit_date(start)) & (F.col("signup_date") < lit_date(end)))
                .select("customer_id", F.lit(label).alias("cohort")))
        cohorts = part if cohorts is None else cohorts.unionByName(part)
    m = cohorts.join(orders_per_customer(t), "customer_id", "left").select(
        "cohort", "customer_id", "last_order_date",
        F.coalesce("n_orders", F.lit(0)).alias("order_count"),
        F.coalesce("spend", F.lit(0)).alias("revenue"))
    active = F.when(F.col("last_order_date") >= F.date_sub(lit_date(p.q21_ref), p.q21_days), 1).otherwise(0)
    g = m.groupBy("cohort").agg(
        F.count("customer_id").alias("total_customers"),
        F.sum(active).alias("active_customers_last_30d"),
        F.sum("order_count").alias("total_orders"),
        F.sum("revenue").alias("rev"),
        F.count("order_count").alias("n_cnt"), F.count("revenue").alias("n_rev"))
    aov = F.when(F.col("total_orders") == 0, F.lit(0.0)).otherwise(ratio("rev", "total_orders"))
    return (g.select(
                "cohort", "total_customers", F.col("active_customers_last_30d").cast("bigint").alias("active_customers_last_30d"),
                rnd(ratio("total_orders", "n_cnt"), 2).alias("avg_orders_per_customer"),
                "total_orders",
                rnd("rev", 2).alias("total_revenue"),
                rnd(ratio("rev", "n_rev"), 2).alias("avg_revenue_per_customer"),
                rnd(aov, 2).alias("avg_order_value"),
                rnd(ratio("active_customers_last_30d", "total_customers"), 4).alias("pct_active"))
            .orderBy("cohort"))


def q24_rfm(t: RetailTables, p: Params) -> DataFrame:
    c = _customer_orders(people(t, p)).select(
        "customer_id",
        F.datediff(lit_date(p.q24_ref), F.col("last_order_date")).alias("recency_days"),
        F.coalesce("n_orders", F.lit(0)).alias("frequency"),
        F.coalesce("spend", F.lit(0)).alias("money"))
    r, f, m = F.col("recency_days"), F.col("frequency"), F.col("money")
    seg = (F.when((r <= p.q24_recent_days) & (f >= p.q24_freq_high) & (m >= p.q24_spend), "Champions")
           .when((r > p.q24_recent_days) & (f >= p.q24_freq_high) & (m >= p.q24_spend), "Loyal")
           .when((r > p.q24_lapsed_days) & (f >= p.q24_freq_mid), "At Risk")
           .otherwise("Lost"))
    return c.select("customer_id", "recency_days", "frequency", dbl(m).alias("monetary"), seg.alias("segment"))


def _retention_counts(df: DataFrame, *keys) -> DataFrame:
    s, f = F.col("second_order_date"), F.col("first_order_date")
    aggs = [F.count_if(s <= F.date_add(f, d)).alias(f"customers_{d}_days") for d in (30, 60, 90)]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def q26_retention_curve(t: RetailTables, p: Params) -> DataFrame:
    fs = first_two_orders(t, tie_break=False).filter(F.col("second_order_date").isNotNull())
    return _retention_counts(fs)


def q26_by_cohort(t: RetailTables, p: Params) -> DataFrame:
    """Per acquisition month (month of the first order): customers acquired and
    how many placed a second order within 30/60/90 days."""
    fs = first_two_orders(t, tie_break=False).filter(F.col("first_order_date").isNotNull())
    s, f = F.col("second_order_date"), F.col("first_order_date")
    return (fs.groupBy(F.trunc("first_order_date", "MM").alias("m"))
            .agg(F.count(F.lit(1)).alias("acquired_customers"),
                 *[F.count_if(s <= F.date_add(f, d)).alias(f"customers_{d}_days") for d in (30, 60, 90)])
            .orderBy("m")
            .select(F.date_format("m", "yyyy-MM").alias("acquisition_month"), "acquired_customers",
                    "customers_30_days", "customers_60_days", "customers_90_days"))


def _after_heal(question):
    """A question on healed customers and orders, with the ghost left out again."""
    def op(t: RetailTables, p: Params) -> DataFrame:
        healed = t.replace(customers=heal_ghost_customer(t, p), orders=heal_orphan_orders(t, p))
        return question(healed, dataclasses.replace(p, exclude_ghost=True))
    return op


OPS = {f"no_ghost_{q.__name__}": _after_heal(q) for q in (q04_country_aov, q05_signups_by_month, q06_customer_ltv, q24_rfm)}
