"""Data-quality checks A-R, the heal -> check run, and their summaries.

A check yields *violation rows* in one shared shape

    sort_d date, sort_s string, sort_n long, sort_n2 long, sort_n3 long,
    sample string, weight long

(``weight`` > 1 stands for several identical violations, used by check C).
``summarize`` turns them into issue rows ``check_name, severity, row_count,
sample_ids, details``: each task folds its violations into a count and the
first 10 rows by (sort_d, sort_s, sort_n), nulls last, per check, and only
these states are shuffled and merged.  No group is ever collected whole.

Anti joins always take a *distinct* key set on the right: a key repeated by a
third of the rows is collapsed by the map-side partial aggregate instead of
landing in one join task (AQE cannot split the build side of an anti join).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.functions.dates import in_dates
from martlens.functions.exprs import lit_ts, pg_concat
from martlens.functions.topk import smallest_and_total
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import (base_customers, base_inventory, base_order_items, base_orders,
                                  base_products)

SAMPLE_SIZE = 10

# Fixed value: the e-mail format rule of check R, case-insensitive.  ``\z``
# anchors at the very end of the text, as the reference's regex end anchor does.
EMAIL_PATTERN = r"^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\z"


def violations(df: DataFrame, sample, sort_n=None, sort_d=None, sort_s=None, weight=None,
               sort_n2=None, sort_n3=None) -> DataFrame:
    def col(x, typ):
        if x is None:
            return F.lit(None).cast(typ)
        return (F.col(x) if isinstance(x, str) else x).cast(typ)
    return df.select(col(sort_d, "date").alias("sort_d"), col(sort_s, "string").alias("sort_s"),
                     col(sort_n, "bigint").alias("sort_n"), col(sort_n2, "bigint").alias("sort_n2"),
                     col(sort_n3, "bigint").alias("sort_n3"), col(sample, "string").alias("sample"),
                     (F.lit(1) if weight is None else F.col(weight) if isinstance(weight, str) else weight)
                     .cast("bigint").alias("weight"))


# ----------------------------------------------------------------------------- checks
def v_a(t, p):
    o = base_orders(t).select("order_id", "customer_id")
    return violations(o.join(base_customers(t).select("customer_id").distinct(), "customer_id", "left_anti"),
                      "order_id", sort_n="order_id")


def v_b(t, p):
    i = base_order_items(t).select("order_item_id", "product_id")
    return violations(i.join(base_products(t).select("product_id").distinct(), "product_id", "left_anti"),
                      "order_item_id", sort_n="order_item_id")


def _purchases(t, reviews: DataFrame) -> DataFrame:
    """(product_id, customer_id, n_bought): items of a product in that customer's orders, for the pairs that
    ``reviews`` ask for; the semi join keeps all other purchases out of the aggregate."""
    o = base_orders(t).select("order_id", "customer_id")
    asked = reviews.select("product_id", "customer_id").distinct()
    return (base_order_items(t).select("order_id", "product_id").join(o, "order_id")
            .join(asked, ["product_id", "customer_id"], "left_semi")
            .groupBy("product_id", "customer_id").agg(F.count(F.lit(1)).alias("n_bought")))


def v_c(t, p):
    """Literal check C: review x item-of-that-product pairs whose order is not the
    reviewer's (a review with no item of its product counts once).

    Counted without materialising the pairs: per review,
    ``n_items(product) - n_items(product, reviewer)`` or 1 when the product was
    never sold; the pair list only matters for the 10-entry sample, which is
    expanded from the first 10 reviews in ``summarize``."""
    r = t.customer_reviews.filter(F.col("is_verified_purchase") == F.lit(True)).select(
        "review_id", "product_id", "customer_id", "review_date")
    per_product = base_order_items(t).groupBy("product_id").agg(F.count(F.lit(1)).alias("n_items"))
    j = (r.join(per_product, "product_id", "left").join(_purchases(t, r), ["product_id", "customer_id"], "left")
         .withColumn("w", F.when(F.col("n_items").isNull(), F.lit(1))
                     .otherwise(F.col("n_items") - F.coalesce("n_bought", F.lit(0))))
         .filter(F.col("w") > 0))
    return violations(j, pg_concat("product_id", F.lit("|"), "customer_id"), sort_d="review_date",
                      sort_n="product_id", sort_n2="customer_id", sort_n3="review_id", weight="w")


def v_c_intent(t, p):
    """Intent of check C: verified reviews whose reviewer never bought the product."""
    r = t.customer_reviews.filter(F.col("is_verified_purchase") == F.lit(True)).select(
        "review_id", "product_id", "customer_id", "review_date")
    bought = _purchases(t, r).select("product_id", "customer_id")
    j = r.join(bought, ["product_id", "customer_id"], "left_anti")
    return violations(j, pg_concat("product_id", F.lit("|"), "customer_id"), sort_d="review_date",
                      sort_n="product_id", sort_n2="customer_id", sort_n3="review_id")


def v_d(t, p):
    calc = base_order_items(t).groupBy("order_id").agg(F.sum("net_amount").alias("calc"))
    o = base_orders(t).select("order_id", "final_total").join(calc, "order_id")
    bad = o.filter(F.coalesce("final_total", F.lit(0)) != F.round(F.coalesce("calc", F.lit(0)), 2))
    return violations(bad, "order_id", sort_n="order_id")


def v_e(t, p):
    pr = base_products(t).filter(F.col("selling_price") < F.col("unit_cost"))
    return violations(pr, "product_id", sort_n="product_id")


def v_f(t, p):
    pr = t.promotions.filter(F.col("times_used") > F.col("max_uses"))
    return violations(pr, "promotion_id", sort_n="promotion_id")


def v_g(t, p):
    dup = t.customers.groupBy("email").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return violations(dup, "email", sort_s="email")


def v_h(t, p):
    o = base_orders(t).filter(F.col("customer_id").isNull() | F.col("order_date").isNull()
                              | F.col("final_total").isNull())
    return violations(o, "order_id", sort_n="order_id")


def v_i(t, p):
    pr = base_products(t).select("product_id").join(base_inventory(t).select("product_id").distinct(),
                                                    "product_id", "left_anti")
    return violations(pr, "product_id", sort_n="product_id")


def v_j(t, p):
    cu = base_customers(t).select("customer_id").join(base_orders(t).select("customer_id").distinct(),
                                                     "customer_id", "left_anti")
    return violations(cu, "customer_id", sort_n="customer_id")


def v_k(t, p):
    o = base_orders(t.replace(orders=in_dates(t.orders, after=p.dq_as_of)))
    return violations(o, "order_id", sort_d="order_date", sort_n="order_id")


def v_l(t, p):
    r = t.customer_reviews.filter(~F.col("rating").between(1, 5))
    return violations(r, "review_id", sort_d="review_date", sort_n="review_id")


def v_m(t, p):
    i = base_order_items(t).filter((F.col("quantity") <= 0) | (F.col("unit_price") < 0))
    return violations(i, "order_item_id", sort_n="order_item_id")


def v_n(t, p):
    u = t.promotion_usage.select("usage_id", "promotion_id").join(
        t.promotions.select("promotion_id").distinct(), "promotion_id", "left_anti")
    return violations(u, "promotion_id", sort_n="promotion_id")


def v_o(t, p):
    o = base_orders(t).select("order_id").join(base_order_items(t).select("order_id").distinct(), "order_id", "left_anti")
    return violations(o, "order_id", sort_n="order_id")


def v_p(t, p):
    i = base_order_items(t).filter((F.col("discount_percent") < 0) | (F.col("discount_percent") > 100))
    return violations(i, "order_item_id", sort_n="order_item_id")


def v_q(t, p):
    inv = base_inventory(t).filter(F.col("current_stock") < 0)
    return violations(inv, "product_id", sort_n="product_id")


def v_r(t, p):
    cu = t.customers.filter(F.col("email").isNotNull() & ~F.col("email").rlike("(?i)" + EMAIL_PATTERN))
    return violations(cu, "customer_id", sort_n="customer_id")


@dataclasses.dataclass(frozen=True)
class Check:
    letter: str
    name: str
    severity: str
    details: str
    rows: Callable[[RetailTables, Params], DataFrame]


# Check names, severities and messages of the 18 checks, in run order.
CHECKS = [
    Check("a", "orders_invalid_customer", "HIGH", "orders reference non-existing customers", v_a),
    Check("b", "order_items_invalid_product", "HIGH", "order_items reference non-existing products", v_b),
    Check("c", "reviews_without_purchase", "MEDIUM", "reviews exist without matching customer purchase", v_c),
    Check("d", "orders_total_mismatch", "CRITICAL", "final_total differs from sum of order_items", v_d),
    Check("e", "products_price_below_cost", "HIGH", "selling_price lower than unit_cost", v_e),
    Check("f", "promotion_overuse", "HIGH", "promotion usage exceeded max_uses", v_f),
    Check("g", "duplicate_customer_email", "MEDIUM", "duplicate customer emails detected", v_g),
    Check("h", "orders_missing_critical_fields", "CRITICAL", "orders contain NULLs in critical columns", v_h),
    Check("i", "products_missing_inventory", "HIGH", "products have no inventory record", v_i),
    Check("j", "inactive_customers", "LOW", "customers without any orders", v_j),
    Check("k", "orders_future_date", "HIGH", "orders dated in the future", v_k),
    Check("l", "invalid_review_rating", "MEDIUM", "ratings outside valid range 1–5", v_l),
    Check("m", "negative_quantity_or_price", "CRITICAL", "negative or zero quantities/prices detected", v_m),
    Check("n", "promotion_usage_invalid", "HIGH", "promotion_usage references missing promotions", v_n),
    Check("o", "orders_without_items", "CRITICAL", "orders have no order_items", v_o),
    Check("p", "invalid_discount_percent", "HIGH", "discount_percent outside 0–100 range", v_p),
    Check("q", "negative_inventory", "HIGH", "warehouse inventory count is negative", v_q),
    Check("r", "invalid_email_format", "LOW", "customers have invalid email format", v_r),
]
C_INTENT = Check("c", "reviews_without_purchase", "MEDIUM",
                 "reviews exist without matching customer purchase", v_c_intent)
BY_LETTER = {c.letter: c for c in CHECKS}


SORT_KEYS = ["sort_d", "sort_s", "sort_n", "sort_n2", "sort_n3"]


def summarize_violations(v: DataFrame, checks: list[Check]) -> DataFrame:
    """Issue rows from violation rows tagged with ``seq`` (index into ``checks``).

    Each task keeps, per check, a count and the SAMPLE_SIZE smallest violations
    (``functions.topk``); only these cross the network, and every violation is
    produced once."""
    found = smallest_and_total(v, "seq", [*SORT_KEYS, "sample"], "weight", SAMPLE_SIZE)
    # expand repeated violations (weight) only inside the <= 10 retained entries
    expanded = F.flatten(F.transform(
        "top", lambda x: F.array_repeat(x["sample"], F.least(x["weight"], F.lit(SAMPLE_SIZE)).cast("int"))))
    joined = found.select("seq", F.col("total").alias("row_count"),
                          F.array_join(F.slice(expanded, 1, SAMPLE_SIZE), ",").alias("sample_ids"))

    # check metadata by position: literal arrays, no join
    def pick(attr):
        return F.array(*[F.lit(getattr(c, attr)) for c in checks])[F.col("seq")]
    return (joined.filter(F.col("row_count") > 0)
            .select("seq", pick("name").alias("check_name"), pick("severity").alias("severity"),
                    F.col("row_count").cast("bigint").alias("row_count"), "sample_ids",
                    pick("details").alias("details")))


def summarize(t: RetailTables, p: Params, checks: list[Check]) -> DataFrame:
    """Issue rows (seq, check_name, severity, row_count, sample_ids, details) for
    the checks with at least one violation."""
    v = None
    for i, c in enumerate(checks):
        part = c.rows(t, p).withColumn("seq", F.lit(i))
        v = part if v is None else v.unionByName(part)
    return summarize_violations(v, checks)


def check_op(letter: str, intent: bool = False):
    chk = C_INTENT if intent else BY_LETTER[letter]

    def op(t: RetailTables, p: Params) -> DataFrame:
        return summarize(t, p, [chk]).drop("seq")
    op.__name__ = f"dq_{letter}" + ("_intent" if intent else "")
    return op


def dq_q_oversold(t: RetailTables, p: Params) -> DataFrame:
    """Ad-hoc check Q: products whose sold quantity exceeds their current stock
    (one row per oversold product)."""
    sold = base_order_items(t).groupBy("product_id").agg(F.sum("quantity").alias("sold_quantity"))
    inv = base_inventory(t).select("product_id", "current_stock")
    return (base_products(t).select("product_id").join(inv, "product_id").join(sold, "product_id")
            .filter(F.col("sold_quantity") > F.col("current_stock"))
            .select("product_id", "current_stock", "sold_quantity"))


def run_checks(t: RetailTables, p: Params, detected_at: dt.datetime | None = None) -> DataFrame:
    """The 18 checks on ``t`` as dq_issues rows; ids restart at 1 (wipe & replace)."""
    ts = detected_at or dt.datetime.combine(p.dq_as_of, dt.time())
    issues = summarize(t, p, CHECKS)
    # at most 18 rows: a single-partition window is bounded
    return issues.select(
        F.row_number().over(Window.orderBy("seq")).cast("bigint").alias("id"),
        "check_name", "severity", "row_count", "sample_ids", "details",
        lit_ts(ts).alias("detected_at"))


def dq_run_all_by_check(t: RetailTables, p: Params) -> DataFrame:
    """Reference shape of the run: heal, then every check planned on its own."""
    from martlens.operators.cleaning import heal
    healed, _audit = heal(t, p)
    return run_checks(healed, p)


def dq_run_all(t: RetailTables, p: Params) -> DataFrame:
    """Heal -> wipe -> 18 checks, evaluated in fused per-table passes."""
    from martlens.operators.quality_fused import run_all_fused
    return run_all_fused(t, p)


def notifications(issues: DataFrame) -> DataFrame:
    """One ``check_name|row_count`` payload per issue (the notify channel, kept as rows)."""
    return issues.select(F.lit("dq_channel").alias("channel"),
                         F.concat_ws("|", "check_name", F.col("row_count").cast("string")).alias("payload"),
                         "detected_at")


def dq_notifications(t: RetailTables, p: Params) -> DataFrame:
    return notifications(dq_run_all(t, p))


OPS = {f"dq_{c.letter}": check_op(c.letter) for c in CHECKS}
OPS.update({"dq_c_intent": check_op("c", intent=True), "dq_q_oversold": dq_q_oversold,
            "dq_run_all": dq_run_all, "snk_notify": dq_notifications})
