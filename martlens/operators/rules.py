"""Declarative constraints as reusable data-quality rules.

``validate(tables, rules)`` returns one violations DataFrame
``rule, tbl, col, row_key, value`` (strings) for any mix of rules; lake tables
carry no constraints, so these are how the declared ones are enforced.
"""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from martlens import schemas
from martlens.params import Params
from martlens.plans.tables import RetailTables

OUT = ("rule", "tbl", "col", "row_key", "value")


def _out(df: DataFrame, rule: str, tbl: str, col: str, row_key, value) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(tbl).alias("tbl"), F.lit(col).alias("col"),
                     row_key.cast("string").alias("row_key"), value.cast("string").alias("value"))


@dataclasses.dataclass(frozen=True)
class PrimaryKey:
    tbl: str
    col: str

    def run(self, t: RetailTables) -> DataFrame:
        df = t[self.tbl]
        dup = (df.groupBy(self.col).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col(self.col).isNull() | (F.col("n") > 1)))
        return _out(dup, "primary_key", self.tbl, self.col, F.col(self.col), F.col("n"))


@dataclasses.dataclass(frozen=True)
class Unique:
    tbl: str
    col: str

    def run(self, t: RetailTables) -> DataFrame:
        dup = (t[self.tbl].filter(F.col(self.col).isNotNull()).groupBy(self.col)
               .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
        return _out(dup, "unique", self.tbl, self.col, F.col(self.col), F.col("n"))


@dataclasses.dataclass(frozen=True)
class ForeignKey:
    tbl: str
    col: str
    parent: str
    parent_col: str


@dataclasses.dataclass(frozen=True)
class NotNull:
    tbl: str
    col: str

    def hit(self):
        return F.col(self.col).isNull(), "not_null", self.col, F.lit(None)


@dataclasses.dataclass(frozen=True)
class Check:
    tbl: str
    name: str
    expr: str  # SQL boolean expression; a NULL result passes, as a CHECK does

    def hit(self):
        return F.expr(self.expr) == F.lit(False), "check", self.name, F.lit(self.expr)


@dataclasses.dataclass(frozen=True)
class AcceptedValues:
    tbl: str
    col: str
    values: tuple

    def hit(self):
        return ~F.col(self.col).isin(*self.values), "accepted_values", self.col, F.col(self.col)


def _row_rules(t: RetailTables, tbl: str, rules: list) -> DataFrame:
    """All single-row rules of a table in one pass: rows that break any of them, one row a breach."""
    key = F.col(schemas.PRIMARY_KEYS[tbl]).cast("string")
    hits, any_bad = [], F.lit(False)
    for bad, rule, col, value in (r.hit() for r in rules):
        any_bad = any_bad | bad
        hits.append(F.when(bad, F.struct(F.lit(rule).alias("rule"), F.lit(tbl).alias("tbl"), F.lit(col).alias("col"),
                                         key.alias("row_key"), value.cast("string").alias("value"))))
    return (t[tbl].filter(any_bad).select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
            .select(*[F.col(f"hit.{c}").alias(c) for c in OUT]))


def _narrow(t: RetailTables, columns) -> str:
    """The type in which columns, given with their tables, meet: bigint where all are whole numbers, which their text then
    tells apart as well, else string."""
    return "bigint" if all(isinstance(t[tbl].schema[col].dataType, IntegralType) for tbl, col in columns) else "string"


def _foreign_keys(t: RetailTables, rules: list[ForeignKey]) -> DataFrame:
    """All foreign keys in one join: each child is read once and gives a reference a key, each parent is read
    once and gives its keys; a NULL reference is legal. Rows are sent with the numbers of their rule and parent key, and
    whole-number keys as numbers: names and texts come back for the breaches only. A task holds its share of the distinct
    parent keys in a hash table and lets the references, which are many times more, pass by it unsorted."""
    parents = list(dict.fromkeys((r.parent, r.parent_col) for r in rules))
    kind = _narrow(t, [(r.tbl, r.col) for r in rules] + parents)
    of_row = _narrow(t, [(r.tbl, schemas.PRIMARY_KEYS[r.tbl]) for r in rules])
    refs, keys = [], []
    for tbl in dict.fromkeys(r.tbl for r in rules):
        own = [F.when(F.col(r.col).isNotNull(), F.struct(F.lit(n).cast("tinyint").alias("rule"), F.lit(parents.index((r.parent, r.parent_col))).cast("tinyint").alias("parent"),
                                                         F.col(r.col).cast(kind).alias("ref"))) for n, r in enumerate(rules) if r.tbl == tbl]
        refs.append(t[tbl].select(F.col(schemas.PRIMARY_KEYS[tbl]).cast(of_row).alias("row_key"),
                                  F.explode(F.array_compact(F.array(*own))).alias("r")).select("row_key", "r.*"))
    for n, (parent, col) in enumerate(parents):
        keys.append(t[parent].select(F.lit(n).cast("tinyint").alias("parent"), F.col(col).cast(kind).alias("ref")))
    known = functools.reduce(DataFrame.unionByName, keys)
    # a fixed number of partitions, on the other side of the join too: else they are merged by their packed size, and the tables grow
    known = known.repartition(int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")), "parent", "ref").distinct()
    bad = functools.reduce(DataFrame.unionByName, refs).join(known.hint("shuffle_hash"), ["parent", "ref"], "left_anti")

    def of_rule(attr: str):
        return F.array(*[F.lit(getattr(r, attr)) for r in rules])[F.col("rule").cast("int")].alias(attr)
    return bad.select(of_rule("tbl"), of_rule("col"), F.col("row_key").cast("string").alias("row_key"), F.col("ref").cast("string").alias("value")).select(
        F.lit("foreign_key").alias("rule"), "tbl", "col", "row_key", "value")


def validate(t: RetailTables, rules) -> DataFrame:
    parts, by_table = [], {}
    foreign = [r for r in rules if isinstance(r, ForeignKey)]
    if foreign:
        parts.append(_foreign_keys(t, foreign))
    for r in rules:
        if r in foreign:
            continue
        if hasattr(r, "hit"):
            by_table.setdefault(r.tbl, []).append(r)
        else:
            parts.append(r.run(t))
    parts += [_row_rules(t, tbl, own) for tbl, own in by_table.items()]
    out = parts[0]
    for v in parts[1:]:
        out = out.unionByName(v)
    return out


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column defaults on ingest: a missing column is added, a NULL is filled."""
    for col, val in defaults.items():
        df = (df.withColumn(col, F.coalesce(F.col(col), F.lit(val))) if col in df.columns
              else df.withColumn(col, F.lit(val)))
    return df


# The constraints declared on the operational tables.
PK_RULES = [PrimaryKey(tb, c) for tb, c in schemas.PRIMARY_KEYS.items()]
UNIQUE_RULES = [Unique("customers", "email"), Unique("promotions", "promotion_code")]
FK_RULES = [ForeignKey(*fk) for fk in schemas.FOREIGN_KEYS]
NOT_NULL_RULES = [NotNull("products", "product_name"), NotNull("products", "category"),
                  NotNull("customer_reviews", "rating"), NotNull("customer_reviews", "is_verified_purchase"),
                  NotNull("promotions", "start_date"), NotNull("promotions", "end_date"),
                  NotNull("dq_issues", "check_name"), NotNull("dq_issues", "severity"),
                  NotNull("dq_issues", "row_count"), NotNull("data_fix_audit", "check_name")]
CHECK_RULES = [Check("products", "price_not_below_cost", "selling_price >= unit_cost"),
               Check("order_items", "quantity_positive", "quantity > 0"),
               Check("order_items", "discount_range", "discount_percent BETWEEN 0 AND 100"),
               Check("customer_reviews", "rating_range", "rating BETWEEN 1 AND 5"),
               Check("promotions", "value_positive", "discount_value > 0"),
               Check("promotions", "start_before_end", "start_date <= end_date")]
ACCEPTED_RULES = [AcceptedValues("promotions", "discount_type", ("percentage", "fixed_amount"))]
DEFAULTS = {"promotions": {"max_uses": 1, "times_used": 0},
            "customer_reviews": {"is_verified_purchase": False},
            "customers": {"is_active": False}}


def rule_default(t: RetailTables, p: Params) -> DataFrame:
    return apply_defaults(t.promotions, DEFAULTS["promotions"])


OPS = {
    "rule_primary_key": lambda t, p: validate(t, PK_RULES),
    "rule_unique": lambda t, p: validate(t, UNIQUE_RULES),
    "rule_foreign_key": lambda t, p: validate(t, FK_RULES),
    "rule_not_null": lambda t, p: validate(t, NOT_NULL_RULES),
    "rule_check": lambda t, p: validate(t, CHECK_RULES),
    "rule_accepted_values": lambda t, p: validate(t, ACCEPTED_RULES),
    "rule_default": rule_default,
}
