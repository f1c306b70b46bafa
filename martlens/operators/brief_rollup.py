"""The brief row from mergeable rollups: a few passes over the facts, or one new day on top of stored ones.

Three partial aggregates hold all that the row needs of the facts:

* by_day: orders with their items and promotion uses, per date, status and payment method;
* by_customer: orders, spend, last date and the two earliest dates per customer;
* by_product: items with their order dates per product.

``partials`` computes them from any part of the facts that holds whole orders (an order with its items
and uses), ``merge`` adds two such sets up, and ``brief_row`` folds one set and the dimensions into the row,
each rollup in one chain: deal its rows to the keys of the metrics, sum per key, one global aggregate.
``fold_batch`` keeps the merged set in the lake as versions (``sources.versions``), with the batches that are in
it, so that the row after a new day reads that day's facts and the rollups only. Order ids are unique, as the
primary key has it; an order, once folded in, does not change.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.functions.dates import in_dates
from martlens.functions.exprs import day_name, discount_amount, gross_amount, lit_date, net_amount, ratio
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.session import work_dir
from martlens.sources import versions

DAY_KEYS = ["order_date", "order_status", "payment_method"]
NAMES = ("by_day", "by_customer", "by_product")
ROW = ["report_date", "rev_today", "rev_yest", "orders_today", "items_today", "rev_change", "avg_items", "aov", "mom_growth", "mom_growth_exact",
       "best_day", "best_day_orders", "top_status", "top_status_count", "top_category", "top_category_revenue", "champions", "at_risk", "avg_ltv",
       "repeat_pct", "churn90", "top_tier", "top_tier_count", "new_customers", "top_country", "top_country_aov", "days_to_second",
       "active_30d_pct", "retention_30d", "top_product", "top_product_revenue", "top_margin_category", "top_margin", "low_stock", "avg_rating",
       "dead_stock", "dead_stock_intent", "mover_product", "mover_category", "hot_products", "new_launches", "promo_roi", "avg_discount",
       "top_payment", "top_payment_count", "promo_penetration"]


# --------------------------------------------------------------------------- partial aggregates
def partials(t: RetailTables) -> dict[str, DataFrame]:
    """The three rollups of the facts in ``t``."""
    percent = F.when(F.col("discount_percent") > 0, F.col("discount_percent"))
    per_order = t.order_items.groupBy(F.col("order_id").alias("item_order")).agg(
        F.sum("quantity").alias("qty"), F.sum(percent).alias("disc_sum"), F.count(percent).alias("disc_n"),
        F.sum(net_amount(coalesce_discount=True)).alias("net0"), F.sum(discount_amount(coalesce_discount=True)).alias("disc0"))
    uses = t.promotion_usage.groupBy(F.col("order_id").alias("used_order")).agg(F.count(F.lit(1)).alias("uses"))
    orders = t.orders.select("order_id", "customer_id", *DAY_KEYS, "total_amount")
    sold = (orders.join(per_order, F.col("order_id") == F.col("item_order"), "full")
            .withColumn("own_id", F.coalesce("order_id", "item_order")))
    by_day = (sold.join(uses, F.col("own_id") == F.col("used_order"), "left").groupBy(*DAY_KEYS).agg(
        F.count("order_id").alias("n"), F.count("order_id").alias("n_ids"), F.sum("total_amount").alias("rev"),
        # items of no order count for discounts and promotions only
        F.sum(F.when(F.col("order_id").isNotNull(), F.col("qty"))).alias("qty"),
        F.sum("disc_sum").alias("disc_sum"), F.sum("disc_n").alias("disc_n"),
        F.sum(F.col("net0") * F.col("uses")).alias("promo_r"), F.sum(F.col("disc0") * F.col("uses")).alias("promo_d"),
        F.count_if(F.col("order_id").isNotNull() & F.col("uses").isNotNull()).alias("n_used")))
    visits = orders.groupBy("customer_id", "order_date").agg(
        F.count("order_id").alias("n"), F.sum("total_amount").alias("ltv"), F.count("total_amount").alias("n_total"), F.count(F.lit(1)).alias("rows"))
    # a customer's distinct dates are at most the days there are
    days = F.array_sort(F.collect_set("order_date"))
    second = F.when(F.min_by("rows", "order_date") > 1, F.min("order_date")).otherwise(F.get(days, F.lit(1)))
    by_customer = visits.groupBy("customer_id").agg(
        F.sum("n").alias("freq"), F.sum("ltv").alias("ltv"), F.sum("n_total").alias("n_total"), F.max("order_date").alias("last"),
        F.min("order_date").alias("d1"), second.alias("d2"))
    dated = t.orders.select("order_id", "order_date")
    by_product = t.order_items.join(dated, "order_id", "left").groupBy("product_id").agg(
        F.sum(gross_amount()).alias("gross"), F.sum(net_amount(coalesce_discount=True)).alias("net0"), F.sum("quantity").alias("qty"),
        F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"), F.count_if(F.col("order_date").isNull()).alias("n_undated"))
    return {"by_day": by_day, "by_customer": by_customer, "by_product": by_product}


def merge(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rollups of both parts together; the types stay those of ``a``."""
    def typed(df: DataFrame, like: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields])

    def summed(name: str, keys: list[str], mins: tuple = (), maxs: tuple = ()) -> DataFrame:
        both = a[name].unionByName(typed(b[name], a[name]))
        aggs = [(F.min(c) if c in mins else F.max(c) if c in maxs else F.sum(c)).alias(c) for c in a[name].columns if c not in keys]
        return typed(both.groupBy(*keys).agg(*aggs), a[name])
    # two states of a customer: the earliest dates of four, smallest first, nulls left out
    both = a["by_customer"].unionByName(typed(b["by_customer"], a["by_customer"]))
    dates = F.array_sort(F.array_compact(F.flatten(F.collect_list(F.array("d1", "d2")))))
    by_customer = both.groupBy("customer_id").agg(
        F.sum("freq").alias("freq"), F.sum("ltv").alias("ltv"), F.sum("n_total").alias("n_total"), F.max("last").alias("last"),
        F.get(dates, F.lit(0)).alias("d1"), F.get(dates, F.lit(1)).alias("d2"))
    return {"by_day": summed("by_day", DAY_KEYS), "by_customer": typed(by_customer, a["by_customer"]),
            "by_product": summed("by_product", ["product_id"], ("first_sale",), ("last_sale",))}


# --------------------------------------------------------------------------- one row of a rollup
def _rnd(x: Column, n: int) -> Column:
    return F.round(x.cast("double").cast("decimal(38,9)"), n).cast("double")


def _rnd_even(x: Column, n: int) -> Column:
    return F.bround(x.cast("double").cast("decimal(38,9)"), n).cast("double")


def _first(when: Column, value: Column, key: Column, value_nulls_first: bool = False) -> Column:
    """The row of the largest value among the rows ``when``: ties to the smallest key, null keys last."""
    null = value.isNotNull() if value_nulls_first else value.isNull()
    return F.min(F.when(when, F.struct(null.alias("no_value"), (-value).alias("less"), key.isNull().alias("no_key"),
                                       key.alias("key"), value.alias("value"))))


def _dealt(df: DataFrame, kinds: dict[str, tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Rows dealt to (kind, key) with the kind's values, summed per key; a null condition leaves a row out."""
    names = {n: c for _, values in kinds.values() for n, c in values.items()}
    types = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in names.items()]).schema.fields}
    rows = []
    for kind, (key, values) in kinds.items():
        rows.append(F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"),
                             *[(values[n] if n in values else F.lit(None)).cast(types[n]).alias(n) for n in names]))
    return df.select(F.explode(F.array(*rows)).alias("r")).groupBy("r.kind", "r.key").agg(*[F.sum(f"r.{n}").alias(n) for n in names])


def _day_row(by_day: DataFrame, p: Params) -> DataFrame:
    day, n = F.col("order_date"), F.col("n")
    month = F.trunc(day, "MM")
    cur, prev = F.trunc(lit_date(p.brief_as_of), "MM"), F.trunc(F.add_months(lit_date(p.brief_as_of), -1), "MM")
    g = _dealt(by_day, {
        "day": (day, {"rev": F.col("rev"), "n": n, "qty": F.col("qty"), "there": F.lit(1)}),
        "next": (F.date_add(day, 1), {"rev": F.col("rev")}),
        "weekday": (day_name("order_date"), {"n": n}), "status": (F.col("order_status"), {"n": n}), "payment": (F.col("payment_method"), {"n": n}),
        "all": (F.lit(None), {"cur": F.when(month == cur, F.col("rev")), "prev": F.when(month == prev, F.col("rev")),
                              **{c: F.col(c) for c in ("disc_sum", "disc_n", "promo_r", "promo_d", "n_used", "n_ids")}})})
    # a day and the day before it under one date, then the latest date that has orders
    kind = F.col("kind")
    is_day = (kind == "day") & F.col("key").isNotNull()
    g = (g.withColumn("date", F.when(kind.isin("day", "next"), F.to_date("key")))
         .groupBy(F.when(kind.isin("day", "next"), F.lit("day")).otherwise(kind).alias("kind"), F.when(kind.isin("day", "next"), F.lit(None)).otherwise(F.col("key")).alias("key"), "date")
         .agg(F.max(F.when(is_day, F.struct("rev", "n", "qty"))).alias("today"), F.max(F.when(kind == "next", F.col("rev"))).alias("yest"),
              *[F.max(F.when(kind != "next", F.col(c))).alias(c) for c in ("n", "cur", "prev", "disc_sum", "disc_n", "promo_r", "promo_d", "n_used", "n_ids", "there")]))
    kind = F.col("kind")
    report = F.when((kind == "day") & (F.col("there") > 0), F.col("date"))
    one = g.agg(F.max(report).alias("report_date"), F.max_by(F.struct("today", "yest"), report).alias("d"),
                *[_first((kind == k) & (F.col("n").isNotNull()), F.col("n"), F.col("key")).alias(k) for k in ("weekday", "status", "payment")],
                *[F.sum(F.when(kind == "all", F.col(c))).alias(c) for c in ("cur", "prev", "disc_sum", "disc_n", "promo_r", "promo_d", "n_used", "n_ids")])
    zero = F.lit(0)
    rt, ry, ot, qt = (F.coalesce(F.col(c), zero) for c in ("d.today.rev", "d.yest", "d.today.n", "d.today.qty"))
    cur, prev = F.coalesce("cur", zero), F.coalesce("prev", zero)
    one = one.withColumns({"cur": cur, "prev": prev})
    growth = F.when(F.col("prev") != 0, F.expr("(cur - prev) div prev") * 100)
    return one.select(
        "report_date", rt.cast("bigint").alias("rev_today"), ry.cast("bigint").alias("rev_yest"), ot.cast("bigint").alias("orders_today"),
        qt.cast("bigint").alias("items_today"),
        F.when(ry > 0, (rt - ry).cast("double") / ry.cast("double") * 100).otherwise(F.lit(0.0)).alias("rev_change"),
        F.when(ot > 0, _rnd_even(qt.cast("double") / ot.cast("double"), 1)).otherwise(F.lit(0.0)).alias("avg_items"),
        F.when(ot > 0, _rnd_even(rt.cast("double") / ot.cast("double"), 0)).otherwise(F.lit(0.0)).alias("aov"),
        F.coalesce(_rnd(growth, 1), F.lit(0.0)).alias("mom_growth"),
        F.coalesce(_rnd(ratio(F.col("cur") - F.col("prev"), "prev") * 100, 1), F.lit(0.0)).alias("mom_growth_exact"),
        F.col("weekday.key").alias("best_day"), F.col("weekday.value").cast("bigint").alias("best_day_orders"),
        F.col("status.key").alias("top_status"), F.col("status.value").cast("bigint").alias("top_status_count"),
        F.col("payment.key").alias("top_payment"), F.col("payment.value").cast("bigint").alias("top_payment_count"),
        F.coalesce(_rnd(ratio("disc_sum", "disc_n"), 1), F.lit(0.0)).alias("avg_discount"),
        F.coalesce(_rnd(ratio(F.col("promo_r") - F.col("promo_d"), "promo_d") * 100, 1), F.lit(0.0)).alias("promo_roi"),
        _rnd(ratio("n_used", "n_ids") * 100, 1).alias("promo_penetration"))


def _customer_row(by_customer: DataFrame, t: RetailTables, p: Params) -> DataFrame:
    cu = t.customers.select(F.col("customer_id").alias("known_id"), "signup_date", "country", "customer_tier", F.lit(1).alias("is_customer"))
    c = by_customer.withColumn("ordered", F.lit(1)).join(cu, F.col("customer_id") == F.col("known_id"), "full")
    freq, gap, known = F.coalesce("freq", F.lit(0)), F.datediff("d2", "d1"), F.col("customer_id").isNotNull()
    both = F.col("ordered").isNotNull() & F.col("is_customer").isNotNull()
    active = F.col("last") >= F.date_sub(lit_date(p.brief_as_of), p.brief_active_days)

    def count(cond: Column) -> Column:
        return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    # customers by their last date: the report date, the latest of these, is known in the end only
    g = _dealt(c, {
        "last": (F.when(F.col("ordered").isNotNull(), F.col("last")), {
            "n_champ": count(F.col("freq") >= p.brief_champ_freq), "n_risk": count(F.col("freq") >= p.brief_risk_freq), "n_last": count(F.col("ordered").isNotNull())}),
        "country": (F.col("country"), {"spend": F.when(both, F.col("ltv")), "spend_n": F.when(both, F.col("n_total")), "in_country": count(both)}),
        "tier": (F.col("customer_tier"), {"in_tier": count(F.col("customer_tier").isNotNull())}),
        "all": (F.lit(None), {
            "ltv": F.col("ltv"), "ltv_n": count(F.col("ltv").isNotNull()), "repeats": count(F.col("is_customer").isNotNull() & (freq >= 2)),
            "customers": F.col("is_customer").cast("bigint"), "fresh": count(F.col("signup_date") >= lit_date(p.brief_as_of.replace(day=1))),
            "active": count(F.col("ordered").isNotNull() & known & active), "buyers": count(F.col("ordered").isNotNull() & known),
            "gap": F.when(known, gap).cast("bigint"), "gaps": count(known & gap.isNotNull()), "kept": count(known & (gap <= p.brief_retention_days))})})
    kind, key = F.col("kind"), F.col("key")
    aov = _rnd(ratio("spend", "spend_n"), 0)
    sums = ("ltv", "ltv_n", "repeats", "customers", "fresh", "active", "buyers", "gap", "gaps", "kept")
    # one entry a day at most
    days = F.collect_list(F.when((kind == "last") & key.isNotNull(), F.struct(F.to_date("key").alias("date"), "n_champ", "n_risk", "n_last")))
    one = g.agg(days.alias("days"), _first((kind == "country") & (F.col("in_country") > 0), aov, key, value_nulls_first=True).alias("country"),
                _first((kind == "tier") & (F.col("in_tier") > 0), F.col("in_tier"), key).alias("tier"),
                *[F.sum(F.when(kind == "all", F.col(x))).alias(x) for x in sums])
    one = one.withColumn("report", F.array_max(F.transform("days", lambda d: d["date"])))

    def total(name: str, cond) -> Column:
        # on or off the days since the report date
        return F.aggregate("days", F.lit(0).cast("bigint"), lambda n, d: n + F.when(cond(F.datediff(F.col("report"), d["date"])), d[name]).otherwise(F.lit(0)))
    mean_gap = _rnd(ratio("gap", "gaps"), 1)
    return one.select(
        total("n_champ", lambda x: x <= p.brief_champ_days).alias("champions"), total("n_risk", lambda x: x > p.brief_risk_days).alias("at_risk"),
        F.coalesce(_rnd(ratio("ltv", "ltv_n"), 0), F.lit(0.0)).alias("avg_ltv"),
        F.coalesce(_rnd(ratio("repeats", "customers") * 100, 1), F.lit(0.0)).alias("repeat_pct"),
        total("n_last", lambda x: x > p.brief_churn_days).alias("churn90"),
        F.col("tier.key").alias("top_tier"), F.col("tier.value").cast("bigint").alias("top_tier_count"), F.coalesce("fresh", F.lit(0)).cast("bigint").alias("new_customers"),
        F.col("country.key").alias("top_country"), F.col("country.value").alias("top_country_aov"),
        F.when(mean_gap != 0, mean_gap).alias("days_to_second"),
        F.coalesce(_rnd(ratio("active", "buyers") * 100, 1), F.lit(0.0)).alias("active_30d_pct"), F.coalesce("kept", F.lit(0)).cast("bigint").alias("retention_30d"))


def _product_row(by_product: DataFrame, t: RetailTables, p: Params) -> DataFrame:
    pr = t.products.select(F.col("product_id").alias("known_id"), "product_name", "category", "selling_price", "unit_cost", "launch_date", F.lit(1).alias("is_product"))
    x = by_product.withColumn("sold", F.lit(1)).join(pr, F.col("product_id") == F.col("known_id"), "full")
    cutoff = F.date_sub(lit_date(p.brief_as_of), p.brief_dead_days)
    is_product, both = F.col("is_product").isNotNull(), F.col("is_product").isNotNull() & F.col("sold").isNotNull()
    dead = F.col("first_sale").isNull() | (F.col("first_sale") < cutoff) | (F.col("n_undated") > 0)
    last = F.col("last_sale")
    since = p.brief_as_of - dt.timedelta(days=p.brief_launch_days)
    g = x.groupBy("category", "product_name", both.alias("both"), is_product.alias("is_product")).agg(
        F.sum("gross").alias("gross"), F.sum("net0").alias("net0"), F.sum("qty").alias("qty"),
        *[F.sum(F.when(is_product, F.col(c))).alias(c) for c in ("selling_price", "unit_cost")],
        *[F.count(F.when(is_product, F.col(c))).alias(f"n_{c}") for c in ("selling_price", "unit_cost")],
        F.count_if(F.col("known_id").isNotNull() & dead).alias("dead"),
        F.count_if(is_product & (last.isNull() | (last < cutoff))).alias("dead_intent"),
        F.count_if(F.col("qty") >= p.brief_hot_units).alias("hot"), F.count_if(F.col("launch_date") >= lit_date(since)).alias("launched"))
    mover = F.min(F.when(F.col("both"), F.struct(F.col("category").isNull().alias("none"), F.col("category").alias("category"),
                                                 (-F.col("qty")).alias("less"), F.col("product_name").alias("name"))))
    totals = {"dead": "dead_stock", "dead_intent": "dead_stock_intent", "hot": "hot_products", "launched": "new_launches"}
    # names over all categories, categories over all names
    d = g.select(F.explode(F.array(F.lit("name"), F.lit("category"))).alias("kind"), "*")
    d = d.groupBy("kind", F.when(F.col("kind") == "name", F.col("product_name")).otherwise(F.col("category")).alias("key"),
                  ).agg(F.sum(F.when(F.col("both"), F.col("gross"))).alias("gross"), F.sum(F.when(F.col("both"), F.col("net0"))).alias("net0"),
                        F.max("both").alias("both"), F.max("is_product").alias("is_product"), mover.alias("mover"),
                        *[F.sum(c).alias(c) for c in ("selling_price", "unit_cost", "n_selling_price", "n_unit_cost", *totals)])
    price, cost = ratio("selling_price", "n_selling_price"), ratio("unit_cost", "n_unit_cost")
    margin = _rnd(ratio(price - cost, price) * 100, 1)
    name, category = F.col("kind") == "name", F.col("kind") == "category"
    one = d.agg(_first(category & F.col("both"), F.col("gross"), F.col("key")).alias("cat"), _first(name & F.col("both"), F.col("net0"), F.col("key")).alias("prod"),
                _first(category & F.col("is_product"), margin, F.col("key"), value_nulls_first=True).alias("margin"),
                F.min(F.when(category, F.col("mover"))).alias("mover"), *[F.sum(F.when(category, F.col(c))).alias(n) for c, n in totals.items()])
    return one.select(
        F.col("cat.key").alias("top_category"), F.col("cat.value").cast("bigint").alias("top_category_revenue"),
        F.col("prod.key").alias("top_product"), F.col("prod.value").cast("double").alias("top_product_revenue"),
        F.col("margin.key").alias("top_margin_category"), F.col("margin.value").alias("top_margin"),
        F.col("mover.name").alias("mover_product"), F.col("mover.category").alias("mover_category"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in totals.values()])


def brief_row(rollups: dict[str, DataFrame], t: RetailTables, p: Params) -> DataFrame:
    """The row from rollups and the dimensions of ``t``; its facts are not read."""
    from martlens.operators.brief import b18_low_stock, b19_avg_rating
    parts = [_day_row(rollups["by_day"], p), _customer_row(rollups["by_customer"], t, p), _product_row(rollups["by_product"], t, p),
             b18_low_stock(t, p), b19_avg_rating(t, p)]
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.max(c).alias(c) for c in ROW])
    return row.withColumn("revenue_status", F.when(F.col("rev_change") >= 0, "Yield Positive").otherwise("Contraction"))


# --------------------------------------------------------------------------- stored rollups
def stored(spark: SparkSession, root: str, entry: dict | None = None) -> tuple[dict[str, DataFrame] | None, list[str]]:
    """The rollups of the current version and the batches folded into them; (None, []) before the first."""
    entry = entry or versions.current(spark, root)
    if entry is None:
        return None, []
    return {n: spark.read.parquet(f"{root}/{entry['data']}/{n}") for n in NAMES}, entry["batches"]


def fold_batch(spark: SparkSession, root: str, batch: RetailTables, batch_id: str) -> int | None:
    """Merge the facts of ``batch`` (whole orders that no earlier batch held, a day's as a rule) into the
    stored rollups; None if that batch is in them already. Reads the batch and the rollups. If another
    writer folds a batch meanwhile, the merge is made again on top of it."""
    def build(last: dict | None) -> dict | None:
        rollups, batches = stored(spark, root, last) if last else (None, [])
        if batch_id in batches:
            return None
        new = partials(batch)
        merged = new if rollups is None else merge(rollups, new)
        folder = versions.new_folder(root)
        for name in NAMES:
            merged[name].write.parquet(f"{folder}/{name}")
        return {"data": folder.rsplit("/", 1)[1], "batches": [*batches, batch_id]}
    done = versions.commit(spark, root, build)
    return done and done["version"]


def facts_between(t: RetailTables, start: dt.date | None = None, before: dt.date | None = None, rest: bool = False) -> RetailTables:
    """``t`` with the facts of the orders from one date up to, not including, another: whole orders with their
    items and uses. ``rest`` adds orders without a date, and the items and uses of no order."""
    orders = in_dates(t.orders, start=start, before=before)
    if rest and (start or before):
        orders = orders.unionByName(t.orders.where(F.col("order_date").isNull()))
    ids = orders.select("order_id").distinct()
    facts = {"orders": orders}
    for name in ("order_items", "promotion_usage"):
        own = t[name].join(ids, "order_id", "left_semi")
        facts[name] = own.unionByName(t[name].join(t.orders.select("order_id").distinct(), "order_id", "left_anti")) if rest else own
    return t.replace(**facts)


def facts_split(t: RetailTables, start: dt.date, folder: str) -> tuple[RetailTables, RetailTables]:
    """``facts_between`` before a date, with the rest, and from it on. One pass a table writes both parts, each into files of
    its own, so that no rollup splits the facts again."""
    def split(name: str, df: DataFrame) -> DataFrame:
        df = df.select(*t[name].columns, "late")
        df.write.partitionBy("late").parquet(f"{folder}/{name}")
        return t.spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    parts = {"orders": split("orders", t.orders.withColumn("late", F.coalesce(F.col("order_date") >= lit_date(start), F.lit(False))))}
    # an id that orders of both parts have takes its items and uses into both; what has no order is the rest
    ids = parts["orders"].groupBy("order_id").agg(F.min("late").alias("least"), F.max("late").alias("most"))
    for name in ("order_items", "promotion_usage"):
        both = F.when(F.col("least") == F.col("most"), F.array("least")).otherwise(F.array("least", "most"))
        own = t[name].join(ids, "order_id", "left").withColumn("late", F.explode(F.when(F.col("least").isNull(), F.array(F.lit(False))).otherwise(both)))
        parts[name] = split(name, own)
    return tuple(t.replace(**{n: df.where(F.col("late") == late).drop("late") for n, df in parts.items()}) for late in (False, True))


def b28_from_rollups(t: RetailTables, p: Params) -> DataFrame:
    """The row from stored rollups: all before the month of ``brief_as_of`` is folded in first, then that month."""
    root = work_dir(t.spark, f"rollups-{uuid.uuid4().hex[:12]}")
    t.store(f"{root}/tables", "order_items")
    history, month = facts_split(t, p.brief_as_of.replace(day=1), f"{root}/facts")
    fold_batch(t.spark, root, history, "history")
    fold_batch(t.spark, root, month, "month")
    return brief_row(stored(t.spark, root)[0], t, p)


OPS = {"b28_from_rollups": b28_from_rollups}
