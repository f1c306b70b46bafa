"""KPI brief: one-value metrics over the base tables (total_amount based).

Scan sharing: the orders-level metrics (report date, daily topline, month
over month, best weekday, top status, top payment) are all derived from one
small pre-aggregate of orders by (order_date, order_status, payment_method),
whose size is bounded by days x statuses x methods, not by orders.  The
per-customer metrics share one per-customer aggregate.  ``b28_brief_row``
is built from the mergeable rollups of ``brief_rollup``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.dates import in_dates
from martlens.functions.exprs import day_name, gross_amount, lit_date, net_amount, discount_amount, ratio
from martlens.functions.joins import with_scalar
from martlens.operators import brief_rollup
from martlens.params import Params
from martlens.plans.tables import RetailTables


def rnd_even(x, n: int) -> F.Column:
    """Half-to-even rounding (the brief's Python ``round``) on the decimal value."""
    return F.bround(F.col(x).cast("double").cast("decimal(38,9)") if isinstance(x, str)
                    else x.cast("double").cast("decimal(38,9)"), n).cast("double")


def rnd(x, n: int) -> F.Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.round(c.cast("double").cast("decimal(38,9)"), n).cast("double")


def _daily(t: RetailTables) -> DataFrame:
    return t.memo("brief_daily", lambda: _daily_build(t))


def _daily_build(t: RetailTables) -> DataFrame:
    return (t.orders.groupBy("order_date", "order_status", "payment_method")
            .agg(F.count("order_id").alias("n"), F.sum("total_amount").alias("rev")))


def _report_date(t: RetailTables) -> DataFrame:
    return t.memo("brief_report_date", lambda: _report_date_build(t))


def _report_date_build(t: RetailTables) -> DataFrame:
    return _daily(t).agg(F.max("order_date").alias("report_date"))


def b01_report_date(t, p):
    return _report_date(t)


def b02_topline(t, p):
    d = _report_date(t)
    day = (with_scalar(_daily(t), d)
           .agg(F.sum(F.when(F.col("order_date") == F.col("report_date"), F.col("rev"))).alias("r_today"),
                F.sum(F.when(F.col("order_date") == F.col("report_date"), F.col("n"))).alias("o_today"),
                F.sum(F.when(F.col("order_date") == F.date_sub("report_date", 1), F.col("rev"))).alias("r_yest")))
    # the report day's orders are few: filter them first, then join their items
    items = (t.order_items.select("order_id", "quantity")
             .join(in_dates(t.orders, on=d.scalar()).select("order_id"), "order_id")
             .agg(F.sum("quantity").alias("q_today")))
    x = day.crossJoin(F.broadcast(items))
    rt, ry = F.coalesce("r_today", F.lit(0)), F.coalesce("r_yest", F.lit(0))
    ot, qt = F.coalesce("o_today", F.lit(0)), F.coalesce("q_today", F.lit(0))
    return x.select(
        rt.cast("bigint").alias("rev_today"), ry.cast("bigint").alias("rev_yest"),
        ot.cast("bigint").alias("orders_today"), qt.cast("bigint").alias("items_today"),
        F.when(ry > 0, (rt - ry).cast("double") / ry.cast("double") * 100).otherwise(F.lit(0.0)).alias("rev_change"),
        F.when(ot > 0, rnd_even(qt.cast("double") / ot.cast("double"), 1)).otherwise(F.lit(0.0)).alias("avg_items"),
        F.when(ot > 0, rnd_even(rt.cast("double") / ot.cast("double"), 0)).otherwise(F.lit(0.0)).alias("aov"))


def _month_sums(t, p):
    cur = F.trunc(lit_date(p.brief_as_of), "MM")
    prev = F.trunc(F.add_months(lit_date(p.brief_as_of), -1), "MM")
    m = F.trunc("order_date", "MM")
    return _daily(t).agg(F.sum(F.when(m == cur, F.col("rev")).otherwise(0)).alias("cur"),
                         F.sum(F.when(m == prev, F.col("rev")).otherwise(0)).alias("prev"))


def b03_mom_growth(t, p):
    # literal: bigint / bigint is an integer division, so growth moves in steps of 100 %
    g = F.when(F.col("prev") != 0, F.expr("(cur - prev) div prev") * 100)
    return _month_sums(t, p).select(F.coalesce(rnd(g, 1), F.lit(0.0)).alias("mom_growth"))


def b03_mom_growth_exact(t, p):
    g = ratio(F.col("cur") - F.col("prev"), "prev") * 100
    return _month_sums(t, p).select(F.coalesce(rnd(g, 1), F.lit(0.0)).alias("mom_growth_exact"))


def _best(df: DataFrame, value: str, key: str, value_nulls_first: bool = False):
    """Column struct of the row with the largest ``value`` (ties: smallest ``key``,
    NULL keys last; NULL values last unless ``value_nulls_first``).

    A global ``min(struct)`` aggregate: partial per partition, and exactly one
    row even when ``df`` is empty."""
    v, k = F.col(value), F.col(key)
    null_rank = v.isNotNull() if value_nulls_first else v.isNull()
    return F.min(F.struct(null_rank.alias("_vn"), (-v).alias("_nv"), k.isNull().alias("_kn"),
                          k.alias("key"), v.alias("value")))


def _mode(df: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, cnt) of the heaviest key; ties go to the smallest key."""
    g = df.groupBy(key).agg(F.sum(weight).alias("cnt"))
    return g.agg(_best(g, "cnt", key).alias("b")).select(F.col("b.key").alias(key), F.col("b.value").alias("cnt"))


def b04_best_day(t, p):
    d = _daily(t).select(day_name("order_date").alias("best_day"), "n")
    return _mode(d, "best_day", "n").select("best_day", F.col("cnt").cast("bigint").alias("best_day_orders"))


def b05_top_status(t, p):
    return _mode(_daily(t), "order_status", "n").select(
        F.col("order_status").alias("top_status"), F.col("cnt").cast("bigint").alias("top_status_count"))


def b26_top_payment(t, p):
    return _mode(_daily(t), "payment_method", "n").select(
        F.col("payment_method").alias("top_payment"), F.col("cnt").cast("bigint").alias("top_payment_count"))


def b06_top_category(t, p):
    x = (_items_per_product(t).select("product_id", F.col("gross").alias("g"))
         .join(t.products.select("product_id", "category"), "product_id"))
    return _mode(x, "category", "g").select(F.col("category").alias("top_category"),
                                           F.col("cnt").cast("bigint").alias("top_category_revenue"))


def _per_customer(t: RetailTables) -> DataFrame:
    return t.memo("brief_per_customer", lambda: _per_customer_build(t))


def _per_customer_build(t: RetailTables) -> DataFrame:
    return (t.orders.groupBy("customer_id")
            .agg(F.count("order_id").alias("freq"), F.max("order_date").alias("last"),
                 F.sum("total_amount").alias("ltv"), F.count("total_amount").alias("n_total")))


def _items_per_product(t: RetailTables) -> DataFrame:
    return t.memo("brief_items_per_product", lambda: _items_per_product_build(t))


def _items_per_product_build(t: RetailTables) -> DataFrame:
    """Per-product gross, net and units; consumers prune it to what they read."""
    return t.order_items.groupBy("product_id").agg(
        F.sum(gross_amount()).alias("gross"), F.sum(net_amount(coalesce_discount=True)).alias("net0"),
        F.sum("quantity").alias("qty"))


def _items_per_order(t: RetailTables) -> DataFrame:
    return t.memo("brief_items_per_order", lambda: _items_per_order_build(t))


def _items_per_order_build(t: RetailTables) -> DataFrame:
    """Per-order net and discount (NULL discount as 0) for the promotion ROI."""
    return t.order_items.groupBy("order_id").agg(
        F.sum(net_amount(coalesce_discount=True)).alias("net0"),
        F.sum(discount_amount(coalesce_discount=True)).alias("disc0"))


def _product_sale_dates(t: RetailTables) -> DataFrame:
    return t.memo("brief_product_sale_dates", lambda: _product_sale_dates_build(t))


def _product_sale_dates_build(t: RetailTables) -> DataFrame:
    """product_id -> earliest / latest order date of its items and how many of its
    items have no dated order (items LEFT JOIN orders)."""
    od = t.orders.select("order_id", "order_date")
    return (t.order_items.select("product_id", "order_id").join(od, "order_id", "left")
            .groupBy("product_id")
            .agg(F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"),
                 F.count_if(F.col("order_date").isNull()).alias("n_undated")))


def b07_rfm_ltv(t, p):
    c = with_scalar(_per_customer(t), _report_date(t))
    rec = F.datediff("report_date", "last")
    return c.agg(
        F.count_if((rec <= p.brief_champ_days) & (F.col("freq") >= p.brief_champ_freq)).alias("champions"),
        F.count_if((rec > p.brief_risk_days) & (F.col("freq") >= p.brief_risk_freq)).alias("at_risk"),
        F.coalesce(rnd(ratio(F.sum("ltv"), F.count("ltv")), 0), F.lit(0.0)).alias("avg_ltv"))


def b08_repeat_pct(t, p):
    n = F.coalesce("freq", F.lit(0))
    c = t.customers.select("customer_id").join(_per_customer(t).select("customer_id", "freq"), "customer_id", "left")
    return c.agg(F.coalesce(rnd(ratio(F.count_if(n >= 2), F.count(F.lit(1))) * 100, 1), F.lit(0.0))
                 .alias("repeat_pct"))


def b09_churn90(t, p):
    c = with_scalar(_per_customer(t), _report_date(t))
    return c.agg(F.count_if(F.datediff("report_date", "last") > p.brief_churn_days).alias("churn90"))


def b10_top_tier(t, p):
    c = t.customers.filter(F.col("customer_tier").isNotNull()).withColumn("_w", F.lit(1))
    return _mode(c, "customer_tier", "_w").select(F.col("customer_tier").alias("top_tier"),
                                                  F.col("cnt").cast("bigint").alias("top_tier_count"))


def b11_new_customers(t, p):
    new = t.customers.filter(F.col("signup_date") >= lit_date(p.brief_as_of.replace(day=1)))
    return new.agg(F.count(F.lit(1)).alias("new_customers"))


def b12_country_aov(t, p):
    x = (_per_customer(t).select("customer_id", F.col("ltv").alias("s"), F.col("n_total").alias("c"))
         .join(t.customers.select("customer_id", "country"), "customer_id")
         .groupBy("country").agg(rnd(ratio(F.sum("s"), F.sum("c")), 0).alias("aov")))
    return x.agg(_best(x, "aov", "country", value_nulls_first=True).alias("b")).select(
        F.col("b.key").alias("top_country"), F.col("b.value").alias("top_country_aov"))


def _first_second(t: RetailTables) -> DataFrame:
    return t.memo("brief_first_second", lambda: _first_second_build(t))


def _first_second_build(t: RetailTables) -> DataFrame:
    # NULL customer ids never meet in the reference's self join: drop them first.
    # row_number() <= 2 gets a partial WindowGroupLimit before the shuffle.
    w = Window.partitionBy("customer_id").orderBy(F.col("order_date").asc_nulls_last())
    r = (t.orders.select("customer_id", "order_date").filter(F.col("customer_id").isNotNull())
         .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= 2))
    return (r.groupBy("customer_id")
            .agg(F.max(F.when(F.col("r") == 1, F.col("order_date"))).alias("d1"),
                 F.max(F.when(F.col("r") == 2, F.col("order_date"))).alias("d2"),
                 F.max(F.when(F.col("r") == 2, F.lit(1))).alias("has2")))


def b13_days_to_second(t, p):
    gap = F.datediff("d2", "d1")
    v = rnd(ratio(F.sum(gap), F.count(gap)), 1)
    return _first_second(t).agg(F.when(v != 0, v).alias("days_to_second"))


def b15_retention_30d(t, p):
    gap = F.datediff("d2", "d1")
    return _first_second(t).agg(F.count_if(gap <= p.brief_retention_days).alias("retention_30d"))


def b14_active_30d_pct(t, p):
    cutoff = F.date_sub(lit_date(p.brief_as_of), p.brief_active_days)
    # a customer has an order on/after the cut-off iff its latest order is
    per = (_per_customer(t).filter(F.col("customer_id").isNotNull())
           .select(F.when(F.col("last") >= cutoff, 1).otherwise(0).alias("a")))
    return per.agg(F.coalesce(rnd(ratio(F.sum("a"), F.count(F.lit(1))) * 100, 1), F.lit(0.0))
                   .alias("active_30d_pct"))


def b16_top_product(t, p):
    x = (_items_per_product(t).select("product_id", F.col("net0").alias("v"))
         .join(t.products.select("product_id", "product_name"), "product_id"))
    return _mode(x, "product_name", "v").select(F.col("product_name").alias("top_product"),
                                               F.col("cnt").cast("double").alias("top_product_revenue"))


def b17_top_margin(t, p):
    g = t.products.groupBy("category").agg(
        ratio(F.sum("selling_price"), F.count("selling_price")).alias("ap"),
        ratio(F.sum("unit_cost"), F.count("unit_cost")).alias("ac"))
    m = g.select("category", rnd(ratio(F.col("ap") - F.col("ac"), "ap") * 100, 1).alias("m"))
    return m.agg(_best(m, "m", "category", value_nulls_first=True).alias("b")).select(
        F.col("b.key").alias("top_margin_category"), F.col("b.value").alias("top_margin"))


def b18_low_stock(t, p, k: int = 3):
    s = (t.inventory.groupBy("product_id").agg(F.sum("stock_quantity").alias("s"))
         .join(t.products.select("product_id", "product_name"), "product_id")
         .groupBy("product_name").agg(F.sum("s").alias("s"))
         .filter(F.col("s") < p.low_stock))
    # a 3-item list is the feature: distributed top-3 by name, then text
    top = s.orderBy(F.col("product_name").asc_nulls_last()).limit(k)
    lst = top.agg(F.array_sort(F.collect_list(F.struct("product_name", "s"))).alias("l"))
    txt = F.array_join(F.transform("l", lambda x: F.concat(x["product_name"], F.lit(" ("),
                                                             x["s"].cast("string"), F.lit(")"))), ", ")
    return lst.select(F.when(F.size("l") > 0, txt).otherwise(F.lit("None")).alias("low_stock"))


def b19_avg_rating(t, p):
    return t.customer_reviews.agg(
        F.coalesce(rnd(ratio(F.sum("rating"), F.count("rating")), 1), F.lit(0.0)).alias("avg_rating"))


def b20_dead_stock(t, p):
    """Literal: products with any sale older than the cut-off, any item without a
    dated order, or no items at all (counted once per product)."""
    cutoff = F.date_sub(lit_date(p.brief_as_of), p.brief_dead_days)
    x = t.products.select("product_id").distinct().join(_product_sale_dates(t), "product_id", "left")
    dead = F.col("first_sale").isNull() | (F.col("first_sale") < cutoff) | (F.col("n_undated") > 0)
    return x.agg(F.count_if(F.col("product_id").isNotNull() & dead).alias("dead_stock"))


def b20_dead_stock_intent(t, p):
    cutoff = F.date_sub(lit_date(p.brief_as_of), p.brief_dead_days)
    x = t.products.select("product_id").join(_product_sale_dates(t), "product_id", "left")
    last = F.col("last_sale")
    return x.agg(F.count_if(last.isNull() | (last < cutoff)).alias("dead_stock_intent"))


def b21_category_mover(t, p):
    x = (_items_per_product(t).select("product_id", F.col("qty").alias("q"))
         .join(t.products.select("product_id", "category", "product_name"), "product_id")
         .groupBy("category", "product_name").agg(F.sum("q").alias("q")))
    # leader per category = min of (-units, name): a plain aggregate, no window
    lead = x.groupBy("category").agg(F.min(F.struct((-F.col("q")).alias("nq"), F.col("product_name").alias("nm")))
                                     .alias("b"))
    first = lead.agg(F.min(F.struct(F.col("category").isNull().alias("_cn"), F.col("category").alias("category"),
                                    F.col("b.nm").alias("nm"))).alias("f"))
    return first.select(F.col("f.nm").alias("mover_product"), F.col("f.category").alias("mover_category"))


def b22_hot_products(t, p):
    x = _items_per_product(t)
    return x.agg(F.count_if(F.col("qty") >= p.brief_hot_units).alias("hot_products"))


def b23_new_launches(t, p):
    since = p.brief_as_of - dt.timedelta(days=p.brief_launch_days)
    return t.products.filter(F.col("launch_date") >= lit_date(since)).agg(F.count(F.lit(1)).alias("new_launches"))


def b24_promo_roi(t, p):
    per_order = _items_per_order(t).select("order_id", F.col("net0").alias("r"), F.col("disc0").alias("d"))
    x = t.promotion_usage.select("order_id").join(per_order, "order_id").agg(
        F.sum("r").alias("r"), F.sum("d").alias("d"))
    return x.select(F.coalesce(rnd(ratio(F.col("r") - F.col("d"), "d") * 100, 1), F.lit(0.0)).alias("promo_roi"))


def b25_avg_discount(t, p):
    x = t.order_items.filter(F.col("discount_percent") > 0)
    return x.agg(F.coalesce(rnd(ratio(F.sum("discount_percent"), F.count("discount_percent")), 1), F.lit(0.0))
                 .alias("avg_discount"))


def b27_promo_penetration(t, p):
    used = t.promotion_usage.select("order_id").distinct().withColumn("_u", F.lit(1))
    x = t.orders.select("order_id").distinct().join(used, "order_id", "left")
    return x.agg(rnd(ratio(F.count("_u"), F.count(F.lit(1))) * 100, 1).alias("promo_penetration"))


def b29_revenue_status(t, p):
    return b02_topline(t, p).select(
        F.when(F.col("rev_change") >= 0, "Yield Positive").otherwise("Contraction").alias("revenue_status"))


METRICS = [b01_report_date, b02_topline, b03_mom_growth, b03_mom_growth_exact, b04_best_day, b05_top_status,
           b06_top_category, b07_rfm_ltv, b08_repeat_pct, b09_churn90, b10_top_tier, b11_new_customers,
           b12_country_aov, b13_days_to_second, b14_active_30d_pct, b15_retention_30d, b16_top_product,
           b17_top_margin, b18_low_stock, b19_avg_rating, b20_dead_stock, b20_dead_stock_intent,
           b21_category_mover, b22_hot_products, b23_new_launches, b24_promo_roi, b25_avg_discount,
           b26_top_payment, b27_promo_penetration]


def b28_brief_row(t: RetailTables, p: Params) -> DataFrame:
    """Every metric as one wide row, from mergeable rollups of the facts (``brief_rollup``)."""
    return brief_rollup.brief_row(brief_rollup.partials(t), t, p)


OPS = {m.__name__: m for m in METRICS}
OPS["b28_brief_row"] = b28_brief_row
OPS["b29_revenue_status"] = b29_revenue_status
