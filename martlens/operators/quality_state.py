"""The 18 checks from a stored state that a night's changes update: no table is checked again as a whole.

A change set holds the rows that changed as they were (``before``) and as they are (``after``): for orders and their
items all rows of every order of which any row changed, for the other tables the changed rows. Most of what the checks
need adds up, so the state holds signed sums, and an update adds what ``after`` gives and takes away what ``before`` gave:

* rows: the violations that one row, or one order with its items, has by itself (D, E, F, H, K, L, M, O, P, R);
* customers, products, promotions, emails: how many rows refer to a key and how many rows have it (G, I, J, N, Q);
* lost_orders, lost_items: the rows whose customer or product is unknown, which A and B name;
* reviews, pairs: verified reviews, and how often their reviewers bought the product (C).

Facts are read outside the change set in two cases only, and then for the keys in question only: a customer or product
that is referred to was deleted (who refers to it?), and a pair got its first review (was it bought?).
``fold_changes`` keeps the state as versions (``sources.versions``), with the change sets that are in it.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.functions.exprs import lit_ts
from martlens.operators import quality as Q
from martlens.operators.cleaning import heal
from martlens.params import Params
from martlens.plans.tables import RetailTables, empty
from martlens.session import work_dir
from martlens.sources import versions

SEQ = {c.letter: i for i, c in enumerate(Q.CHECKS)}
CHANGED = ("customers", "products", "orders", "order_items", "inventory", "customer_reviews", "promotions", "promotion_usage")
#: Checks of one row, or of one order with its items.
OWN = "defhklmopr"
COUNTED = {"customers": ("customer_id", ["n_orders", "n_customers"]), "products": ("product_id", ["n_items", "n_products", "n_stocked", "stock"]),
           "promotions": ("promotion_id", ["n_uses", "n_promotions"]), "emails": ("email", ["n_customers"])}
State = dict[str, DataFrame]


@dataclasses.dataclass(frozen=True)
class Changes:
    """Rows that changed, by table; an absent table has none."""
    before: dict[str, DataFrame]
    after: dict[str, DataFrame]

    def side(self, spark: SparkSession, name: str) -> RetailTables:
        frames = getattr(self, name)
        return RetailTables.from_frames(spark, {n: frames[n] if n in frames else empty(spark, n) for n in CHANGED})


def _signed(ch: dict[int, RetailTables], build) -> DataFrame:
    """What ``build`` gives for the rows as they are, and for the rows as they were, with the sign in _sign."""
    return functools.reduce(DataFrame.unionByName, [build(t).withColumn("_sign", F.lit(sign).cast("bigint")) for sign, t in ch.items()])


def _own_violations(t: RetailTables, p: Params) -> DataFrame:
    parts = [Q.BY_LETTER[x].rows(t, p).withColumn("seq", F.lit(SEQ[x])) for x in OWN]
    return functools.reduce(DataFrame.unionByName, parts)


def _counts(t: RetailTables, name: str) -> DataFrame:
    """Rows (key, column, how much) that add up to one table of ``COUNTED``."""
    key, one = COUNTED[name][0], F.lit(1).cast("bigint")
    rows = {"customers": [(t.orders, "n_orders", one), (t.customers, "n_customers", one)],
            "products": [(t.order_items, "n_items", one), (t.products, "n_products", one), (t.inventory, "n_stocked", one),
                         (t.inventory, "stock", F.coalesce(F.col("stock_quantity").cast("bigint"), F.lit(0)))],
            "promotions": [(t.promotion_usage, "n_uses", one), (t.promotions, "n_promotions", one)],
            "emails": [(t.customers, "n_customers", one)]}[name]
    kind = "string" if key == "email" else "bigint"
    return functools.reduce(DataFrame.unionByName, [df.select(F.col(key).cast(kind).alias(key), F.lit(col).alias("what"), amount.alias("amount"))
                                                    for df, col, amount in rows])


def _updated_counts(old: DataFrame | None, ch: dict[int, RetailTables], name: str) -> DataFrame:
    """The counts after the changes."""
    key, cols = COUNTED[name]
    delta = _signed(ch, lambda t: _counts(t, name))
    new = delta.select(key, *[F.when(F.col("what") == c, F.col("amount") * F.col("_sign")).otherwise(0).alias(c) for c in cols])
    if old is not None:
        new = old.select(key, *cols).unionByName(new)
    new = new.groupBy(key).agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
    return new.where(functools.reduce(lambda a, b: a | b, [F.col(c) != 0 for c in cols]))


def _lost(old: DataFrame | None, was: DataFrame | None, ch: dict[int, RetailTables], counts: DataFrame, key: str, refs: str, rows: str, pick, facts) -> DataFrame:
    """(key, row id, times): rows that refer to an unknown key. ``was`` and ``counts`` are the counts before and after."""
    known = counts.where(F.col(key).isNotNull() & (F.col(rows) > 0)).select(key)
    now = _signed(ch, pick).select(key, "id", F.col("_sign").alias("times"))
    if old is not None:
        # keys that were known and no longer are: all their rows are asked for, what the change set says of them is in those
        dropped = counts.where(F.col(key).isNotNull() & (F.col(rows) <= 0) & (F.col(refs) > 0)).select(key).join(
            was.where(F.col(rows) > 0).select(key), key, "left_semi")
        now = old.unionByName(now)
        if not dropped.isEmpty():
            now = now.join(dropped, key, "left_anti").unionByName(
                facts().join(dropped, key, "left_semi").select(key, "id", F.lit(1).cast("bigint").alias("times")))
    return now.join(known, key, "left_anti").groupBy(key, "id").agg(F.sum("times").cast("bigint").alias("times")).where("times > 0")


def _bought(items: DataFrame, orders: DataFrame) -> DataFrame:
    """(product_id, customer_id) of each item."""
    return items.select("order_id", "product_id").join(orders.select("order_id", "customer_id"), "order_id").select("product_id", "customer_id")


def update(spark: SparkSession, old: State | None, changes: Changes, facts: RetailTables, p: Params,
           keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> State:
    """The state after ``changes``. ``facts`` are the tables as they are now; they are read for the keys named above only,
    and not at all for a first state, whose change set holds every row in ``after``. ``keep`` may write a part of the
    state and give it back as it is read from there: parts that are made from others then do not make these again."""
    ch = {1: changes.side(spark, "after")} | ({-1: changes.side(spark, "before")} if changes.before else {})
    part = lambda name: None if old is None else old[name]
    new: State = {}
    rows = _signed(ch, lambda t: _own_violations(t, p)).withColumn("weight", F.col("weight") * F.col("_sign")).drop("_sign")
    if old is not None:
        rows = rows.unionByName(old["rows"])
    rows = rows.groupBy("seq", *Q.SORT_KEYS, "sample").agg(F.sum("weight").cast("bigint").alias("weight")).where("weight <> 0")
    new["rows"] = keep("rows", rows)
    for name in COUNTED:
        new[name] = keep(name, _updated_counts(part(name), ch, name))
    new["lost_orders"] = keep("lost_orders", _lost(
        part("lost_orders"), part("customers"), ch, new["customers"], "customer_id", "n_orders", "n_customers",
        lambda t: t.orders.select("customer_id", F.col("order_id").alias("id")),
        lambda: facts.orders.select("customer_id", F.col("order_id").alias("id"))))
    new["lost_items"] = keep("lost_items", _lost(
        part("lost_items"), part("products"), ch, new["products"], "product_id", "n_items", "n_products",
        lambda t: t.order_items.select("product_id", F.col("order_item_id").alias("id")),
        lambda: facts.order_items.select("product_id", F.col("order_item_id").alias("id"))))
    of_review = ["review_id", "product_id", "customer_id", "review_date"]
    reviews = _signed(ch, lambda t: t.customer_reviews.where(F.col("is_verified_purchase") == F.lit(True)).select(*of_review)).withColumnRenamed("_sign", "times")
    if old is not None:
        reviews = reviews.unionByName(old["reviews"])
    new["reviews"] = keep("reviews", reviews.groupBy(*of_review).agg(F.sum("times").cast("bigint").alias("times")).where("times <> 0"))
    pair = ["product_id", "customer_id"]
    asked = new["reviews"].select(*pair).where("product_id is not null and customer_id is not null").distinct()
    if old is None:
        # only purchases that a review asks for are counted
        counted = _bought(ch[1].order_items, ch[1].orders).join(asked, pair, "left_semi").groupBy(*pair).agg(F.count(F.lit(1)).alias("n_bought"))
        pairs = asked.join(counted, pair, "left").select(*pair, F.coalesce("n_bought", F.lit(0)).cast("bigint").alias("n_bought"))
    else:
        moved = _signed(ch, lambda t: _bought(t.order_items, t.orders)).withColumnRenamed("_sign", "n_bought")
        held = old["pairs"].unionByName(moved.join(old["pairs"].select(*pair), pair, "left_semi")).groupBy(*pair).agg(F.sum("n_bought").cast("bigint").alias("n_bought"))
        held = held.join(asked, pair, "left_semi")
        first = asked.join(old["pairs"].select(*pair), pair, "left_anti")
        if not first.isEmpty():
            counted = _bought(facts.order_items, facts.orders).join(first, pair, "left_semi").groupBy(*pair).agg(F.count(F.lit(1)).alias("n_bought"))
            held = held.unionByName(first.join(counted, pair, "left").select(*pair, F.coalesce("n_bought", F.lit(0)).cast("bigint").alias("n_bought")))
        pairs = held
    new["pairs"] = keep("pairs", pairs)
    return new


def violations(s: State) -> DataFrame:
    """The violation rows of all checks, in the shape of ``quality.violations``, with their check in seq."""
    def keyed(letter: str, df: DataFrame, sample, weight, **sort) -> DataFrame:
        return Q.violations(df, sample, weight=weight, **sort).withColumn("seq", F.lit(SEQ[letter]))

    def without(name: str, has: str, lacks: str):
        """Keys that rows have, and that no row of the other kind has; a null key matches nothing."""
        key = COUNTED[name][0]
        return s[name].where((F.col(has) > 0) & ((F.col(lacks) <= 0) | F.col(key).isNull()))
    items = s["products"].where("n_items > 0").select("product_id", "n_items")
    reviews = s["reviews"].join(items, "product_id", "left").join(s["pairs"], ["product_id", "customer_id"], "left")
    pairs = F.col("times") * F.when(F.col("n_items").isNull(), F.lit(1)).otherwise(F.col("n_items") - F.coalesce("n_bought", F.lit(0)))
    reviews = reviews.withColumn("pairs", pairs).where("pairs > 0")
    parts = [
        s["rows"],
        keyed("a", s["lost_orders"], "id", "times", sort_n="id"),
        keyed("b", s["lost_items"], "id", "times", sort_n="id"),
        keyed("c", reviews, Q.pg_concat("product_id", F.lit("|"), "customer_id"), "pairs", sort_d="review_date", sort_n="product_id", sort_n2="customer_id", sort_n3="review_id"),
        keyed("g", s["emails"].where("n_customers > 1"), "email", None, sort_s="email"),
        keyed("i", without("products", "n_products", "n_stocked"), "product_id", "n_products", sort_n="product_id"),
        keyed("j", without("customers", "n_customers", "n_orders"), "customer_id", "n_customers", sort_n="customer_id"),
        keyed("n", without("promotions", "n_uses", "n_promotions"), "promotion_id", "n_uses", sort_n="promotion_id"),
        keyed("q", s["products"].where("n_stocked > 0 and stock < 0"), "product_id", None, sort_n="product_id")]
    return functools.reduce(DataFrame.unionByName, parts)


def issues(s: State, p: Params, detected_at: dt.datetime | None = None) -> DataFrame:
    """Issue rows as ``quality.run_checks`` gives them."""
    ts = detected_at or dt.datetime.combine(p.dq_as_of, dt.time())
    found = Q.summarize_violations(violations(s), Q.CHECKS)
    place = F.row_number().over(Window.orderBy("seq")).cast("bigint")  # over 18 rows at most
    return found.select(place.alias("id"), "check_name", "severity", "row_count", "sample_ids", "details", lit_ts(ts).alias("detected_at"))


# --------------------------------------------------------------------------- stored state
STATE = ("rows", *COUNTED, "lost_orders", "lost_items", "reviews", "pairs")


def stored(spark: SparkSession, root: str, entry: dict | None = None) -> tuple[State | None, list[str]]:
    """The current state and the change sets folded into it; (None, []) before the first."""
    entry = entry or versions.current(spark, root)
    if entry is None:
        return None, []
    return {n: spark.read.parquet(f"{root}/{entry['data']}/{n}") for n in STATE}, entry["folded"]


def fold_changes(spark: SparkSession, root: str, changes: Changes, facts: RetailTables, p: Params, name: str) -> int | None:
    """Update the stored state by a change set; None if it is in there already."""
    def build(last: dict | None) -> dict | None:
        old, folded = stored(spark, root, last) if last else (None, [])
        if name in folded:
            return None
        folder = versions.new_folder(root)

        def keep(table: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{folder}/{table}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{table}")
        update(spark, old, changes, facts, p, keep)
        return {"data": folder.rsplit("/", 1)[1], "folded": [*folded, name]}
    done = versions.commit(spark, root, build)
    return done and done["version"]


def dq_run_incremental(t: RetailTables, p: Params) -> DataFrame:
    """The healed tables in two steps: a state of all orders before the month of the latest check date, and a change set
    with that month's orders and items; then the issues from the state. Healed orders, and items, are written once, in
    a part a change set, and the many steps of the updates read them from there."""
    spark, root = t.spark, work_dir(t.spark, f"dq-state-{uuid.uuid4().hex[:12]}")
    t.store(f"{root}/tables", "order_items", "customer_reviews")
    healed, _ = heal(t, p)

    def parted(name: str, df: DataFrame) -> DataFrame:
        df = df.select(*healed[name].columns, "late")
        df.write.partitionBy("late").parquet(f"{root}/changes/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/changes/{name}")
    late = F.coalesce(F.col("order_date") >= F.lit(p.dq_as_of.replace(day=1)), F.lit(False))
    orders = parted("orders", healed.orders.withColumn("late", late))
    ids = orders.where("late").select("order_id", "late").distinct()
    items = parted("order_items", healed.order_items.join(ids, "order_id", "left").withColumn("late", F.coalesce("late", F.lit(False))))
    healed = healed.replace(orders=orders.drop("late"), order_items=items.drop("late"))
    first = {n: healed[n] for n in CHANGED} | {"orders": orders.where("not late").drop("late"), "order_items": items.where("not late").drop("late")}
    fold_changes(spark, root, Changes({}, first), healed, p, "first")
    fold_changes(spark, root, Changes({}, {"orders": orders.where("late").drop("late"), "order_items": items.where("late").drop("late")}), healed, p, "late")
    return issues(stored(spark, root)[0], p)


OPS = {"dq_run_incremental": dq_run_incremental}
