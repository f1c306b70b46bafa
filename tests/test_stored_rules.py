"""Stored column defaults, rules tested while writing, and the ghost customer left out on demand."""

import dataclasses
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from martlens.operators import cleaning, rules
from martlens.operators.analytics import customers
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.plans.views import base_customers
from martlens.sources import checked, lake, versions

P = Params.fixture()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return RetailTables.from_fixture(spark, SF)


@pytest.fixture()
def promotions(spark, tmp_path):
    spark.sql(f"CREATE DATABASE martlens_defaults LOCATION '{tmp_path}/db'")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, code string")
    df.repartition(2).write.format("parquet").saveAsTable("martlens_defaults.promos")
    yield "martlens_defaults.promos"
    spark.sql("DROP DATABASE martlens_defaults CASCADE")


def files(spark, table):
    return sorted(spark.table(table).inputFiles())


def test_old_files_read_with_the_default_and_stay(spark, promotions):
    before = files(spark, promotions)
    stamps = [os.stat(f.removeprefix("file:")).st_mtime_ns for f in before]
    lake.add_column(spark, promotions, "max_uses", "int", 1)
    lake.add_column(spark, promotions, "note", "string", "it's \\ new")
    lake.add_column(spark, promotions, "since", "date", dt.date(2001, 2, 3))
    lake.add_column(spark, promotions, "plain", "string")
    assert files(spark, promotions) == before and [os.stat(f.removeprefix("file:")).st_mtime_ns for f in before] == stamps
    assert [tuple(r) for r in spark.table(promotions).orderBy("id").collect()] == [(k, c, 1, "it's \\ new", dt.date(2001, 2, 3), None) for k, c in ((1, "a"), (2, "b"))]
    assert spark.table(promotions).where("max_uses = 1").count() == 2 and spark.table(promotions).where("max_uses <> 1").count() == 0
    # new rows: left out, given, given as NULL
    lake.insert(spark.createDataFrame([(3, "c")], "id bigint, code string"), promotions)
    lake.insert(spark.createDataFrame([(4, "d", 9), (5, "e", None)], "id bigint, code string, max_uses int"), promotions)
    assert {r.id: r.max_uses for r in spark.table(promotions).collect()} == {1: 1, 2: 1, 3: 1, 4: 9, 5: None}
    # another default is for rows from now on
    lake.set_default(spark, promotions, "max_uses", 50)
    lake.insert(spark.createDataFrame([(6, "f")], "id bigint, code string"), promotions)
    assert {r.id: r.max_uses for r in spark.table(promotions).collect()} == {1: 1, 2: 1, 3: 1, 4: 9, 5: None, 6: 50}
    assert set(before) < set(files(spark, promotions))


def test_defaults_of_the_operational_tables(spark, tmp_path):
    """The declared defaults on stored tables: rows that leave the columns out get them."""
    spark.sql(f"CREATE DATABASE martlens_declared LOCATION '{tmp_path}/db'")
    try:
        t = RetailTables.from_fixture(spark, SF)
        lake.write_catalog(t, "martlens_declared", str(tmp_path / "db"), 2, names=["promotions", "customer_reviews"])
        for table in ("promotions", "customer_reviews"):
            for col, value in rules.DEFAULTS[table].items():
                lake.set_default(spark, f"martlens_declared.{table}", col, value)
        lake.insert(t.promotions.drop("max_uses", "times_used").withColumn("promotion_id", F.col("promotion_id") + 1000), "martlens_declared.promotions")
        lake.insert(t.customer_reviews.limit(1).select(F.lit(10**9).cast("int").alias("review_id") if t.customer_reviews.schema["review_id"].dataType.simpleString() == "int" else F.lit(10**9).cast("bigint").alias("review_id"), "rating"), "martlens_declared.customer_reviews")
        new = spark.table("martlens_declared.promotions").where("promotion_id > 1000")
        assert {(r.max_uses, r.times_used) for r in new.collect()} == {(1, 0)} and new.count() == t.promotions.count()
        assert spark.table("martlens_declared.customer_reviews").where(f"review_id = {10**9}").first().is_verified_purchase is False
    finally:
        spark.sql("DROP DATABASE martlens_declared CASCADE")


def products(spark, rows):
    return spark.createDataFrame(rows, "product_id bigint, product_name string, category string, selling_price int, unit_cost int, comment string")


def test_one_pass_gives_table_counts_and_quarantine(spark, tmp_path):
    root = str(tmp_path / "products")
    rows = [(1, "p", "c", 5, 2, "fine"), (2, None, "c", 5, 9, "two breaches"), (3, "q", None, None, 9, "one"), (4, "r", "c", None, 1, "null price passes"), (1, "p", "c", 5, 2, "fine")]
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    df = products(spark, rows)
    load = checked.write_checked(df.mapInArrow(counted, df.schema), root, "products")
    assert reads.value == len(rows)  # the input is read once
    assert load == checked.Load(1, 5, 2, {"not_null:product_name": 1, "not_null:category": 1, "check:price_not_below_cost": 1})
    assert sorted(r.product_id for r in checked.read_accepted(spark, root).collect()) == [1, 1, 4]
    assert checked.read_accepted(spark, root).columns == df.columns
    held = {r.product_id: [b.col for b in r["_breaches"]] for r in checked.read_quarantined(spark, root).collect()}
    assert held == {2: ["product_name", "price_not_below_cost"], 3: ["category"]}
    own = [r for r in checked.ROW_RULES if r.tbl == "products"]
    t = RetailTables.from_frames(spark, {"products": df})
    assert sorted(map(tuple, checked.breaches(spark, root).collect()), key=str) == sorted(map(tuple, rules.validate(t, own).collect()), key=str)


def test_a_load_with_too_many_breaches_is_not_committed(spark, tmp_path):
    root = str(tmp_path / "products")
    good, bad = products(spark, [(1, "p", "c", 5, 2, "")]), products(spark, [(2, None, "c", 5, 2, ""), (3, None, "c", 5, 2, "")])
    checked.write_checked(good, root, "products", most_quarantined=0)
    with pytest.raises(checked.TooManyBreaches):
        checked.write_checked(bad, root, "products", most_quarantined=1)
    assert [r.product_id for r in checked.read_accepted(spark, root).collect()] == [1] and len(versions.committed(spark, root)) == 1
    assert checked.write_checked(bad, root, "products", most_quarantined=2).version == 2 and checked.read_accepted(spark, root).count() == 0


def test_empty_loads_and_tables_without_rules(spark, tmp_path):
    load = checked.write_checked(products(spark, []), str(tmp_path / "a"), "products")
    assert (load.rows, load.quarantined, set(load.breaches.values())) == (0, 0, {0}) and checked.read_accepted(spark, str(tmp_path / "a")).count() == 0
    df = spark.createDataFrame([(1, "x")], "inventory_id bigint, v string")
    assert checked.write_checked(df, str(tmp_path / "b"), "inventory").breaches == {}
    assert checked.read_accepted(spark, str(tmp_path / "b")).collect() == df.collect()


def test_foreign_keys_read_each_table_once(spark, tables, tmp_path):
    lake.write_lake(tables, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = rules.validate(RetailTables.from_lake(spark, str(tmp_path)), rules.FK_RULES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    children, parents = {r.tbl for r in rules.FK_RULES}, {r.parent for r in rules.FK_RULES}
    # Spark may push the join below the union, an anti join a child against one key set that is computed once
    assert text.count("FileScan ") == len(children) + len(parents) and len(re.findall(r"LeftAnti", text)) <= len(children)


def test_the_customer_view_is_a_projection(spark, tables):
    t = tables.replace(customers=cleaning.fix_is_active(tables))
    frozen = t.replace(customers=spark.createDataFrame(t.customers.limit(5).collect(), t.customers.schema))
    plan = base_customers(frozen, with_active=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(Exception):
        base_customers(tables, with_active=True).collect()


def test_the_ghost_customer_is_left_out_on_demand(spark, tables):
    healed = tables.replace(customers=cleaning.heal_ghost_customer(tables, P), orders=cleaning.heal_orphan_orders(tables, P))
    without = dataclasses.replace(P, exclude_ghost=True)
    for q in (customers.q04_country_aov, customers.q05_signups_by_month, customers.q06_customer_ltv, customers.q24_rfm):
        rows = [sorted(map(str, q(t, p).collect())) for t, p in ((tables, P), (healed, without), (healed, P))]
        assert rows[0] == rows[1] != rows[2], q.__name__


def test_foreign_keys_sort_no_references(spark, tables, tmp_path):
    """References pass a hash table of the parents' keys as numbers; they are neither sorted nor sent with names."""
    lake.write_lake(tables, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = rules.validate(RetailTables.from_lake(spark, str(tmp_path)), rules.FK_RULES)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text and "Sort [" not in text


def test_foreign_keys_of_text_and_of_other_whole_numbers(spark):
    """Whole numbers of any width meet as numbers, other keys as texts; the rows say which reference is broken."""
    t = RetailTables.from_frames(spark, {
        "orders": spark.createDataFrame([("a", 1, "x"), ("b", 2, "01"), ("c", None, None)], "order_id string, customer_id int, promotion_id string"),
        "customers": spark.createDataFrame([(1,), (1,), (None,)], "customer_id bigint"),
        "promotions": spark.createDataFrame([("x",), ("1",)], "promotion_id string")})
    own = [rules.ForeignKey("orders", "customer_id", "customers", "customer_id"), rules.ForeignKey("orders", "promotion_id", "promotions", "promotion_id")]
    want = {("foreign_key", "orders", "customer_id", "b", "2"), ("foreign_key", "orders", "promotion_id", "b", "01")}
    assert set(map(tuple, rules.validate(t, own).collect())) == want
    assert set(map(tuple, rules.validate(t, own[:1]).collect())) == {r for r in want if r[2] == "customer_id"}
