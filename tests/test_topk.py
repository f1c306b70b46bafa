"""The k-smallest state of the check summaries: exact at any split of the rows, and small on the network."""

import random
import re

import pytest
from pyspark.sql import functions as F

from martlens.functions.topk import fold, smallest_and_total
from martlens.operators import quality
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake
from martlens.testing import micro_tables

P = Params.fixture()
SF = "/root/testdata/sf0.001"


def expected(rows, k):
    out = {}
    for g in {r[0] for r in rows}:
        own = {}
        for _, a, b, w in (r for r in rows if r[0] == g):
            own[a, b] = own.get((a, b), 0) + w
        keys = sorted(own, key=lambda x: tuple((v is None, v) for v in x))[:k]
        out[g] = (sum(own.values()), [(*x, own[x]) for x in keys])
    return out


@pytest.mark.parametrize("parts, k", [(1, 10), (7, 10), (40, 3), (3, 1)])
def test_equal_to_brute_force_at_any_split(spark, parts, k):
    rng = random.Random(parts)
    rows = [(rng.randrange(4), rng.choice([None, *range(12)]), rng.choice([None, "a", "B", "ß", "", "zz"]), rng.randint(1, 5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, a bigint, b string, w bigint").repartition(parts)
    got = {r.g: (r.total, [(x.a, x.b, x.w) for x in r.top]) for r in smallest_and_total(df, "g", ["a", "b"], "w", k).collect()}
    assert got == expected(rows, k)


def test_no_rows_give_no_groups(spark):
    df = spark.createDataFrame([], "g int, a bigint, w bigint").repartition(3)
    assert smallest_and_total(df, "g", ["a"], "w", 10).count() == 0


def test_a_task_sends_ten_rows_and_a_total_a_check(spark):
    """One check has a third of a million violations; a task's state stays at its bound."""
    rows = spark.range(300_000).select((F.col("id") % 3).cast("int").alias("g"), F.hash("id").cast("bigint").alias("a"), F.lit(1).cast("bigint").alias("w"))
    out = [b for b in fold(rows.toArrow().to_batches(max_chunksize=10_000), "g", ["a"], "w", 10)]
    assert sum(b.num_rows for b in out) == 3 * 11
    assert sorted(n for b in out for n, total in zip(b.column("w").to_pylist(), b.column("is_total").to_pylist()) if total) == [100_000] * 3


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("topk"))
    lake.write_lake(RetailTables.from_fixture(spark, SF), f"{root}/lake")
    lake.write_catalog(RetailTables.from_fixture(spark, SF), "martlens_topk", f"{root}/catalog", 4)
    yield {"lake": RetailTables.from_lake(spark, f"{root}/lake"), "bucketed": RetailTables.from_catalog(spark, "martlens_topk")}
    spark.sql("DROP DATABASE martlens_topk CASCADE")


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("layout", ["lake", "bucketed"])
@pytest.mark.parametrize("check, scans", [("d", 2), ("h", 1), ("k", 1), ("o", 2), ("m", 1)])
def test_violations_are_produced_once_and_folded_before_the_shuffle(spark, stored, layout, check, scans):
    text = static_plan(spark, quality.check_op(check)(stored[layout], P))
    assert text.count("FileScan ") == scans and text.count("MapInArrow") == 1
    above = text[:text.index("MapInArrow")]
    assert len(re.findall(r"Exchange hashpartitioning", above)) == 2  # merge of equal rows, then of a check's states
    below = text[text.index("MapInArrow"):]
    if check in "hkm" or layout == "bucketed" and check != "m":
        assert "Exchange hashpartitioning" not in below


def test_the_whole_run_reads_each_table_a_few_times(spark, stored):
    text = static_plan(spark, quality.dq_run_all(stored["bucketed"], P))
    scans = {n: len(re.findall(rf"FileScan parquet spark_catalog\.martlens_topk\.{n}\[", text)) for n in
             ("orders", "order_items", "customers", "products", "inventory", "customer_reviews", "promotions", "promotion_usage")}
    assert scans == {"orders": 2, "order_items": 3, "customers": 2, "products": 2, "inventory": 1, "customer_reviews": 1, "promotions": 1, "promotion_usage": 1}


def test_the_whole_run_equals_the_checks_one_by_one(spark, stored):
    """Also with repeated keys on every side, a ghost that is there already, and null keys."""
    def rows(df):
        return sorted((r.check_name, r.row_count, r.sample_ids) for r in df.collect())
    assert rows(quality.dq_run_all(stored["lake"], P)) == rows(quality.dq_run_all_by_check(stored["lake"], P))
    import datetime as dt
    from decimal import Decimal
    day = dt.date(2001, 1, 1)
    for ghost in ([], [(P.ghost_customer_id, "other@example.com", "U", "C", day, "X", "None")], [(P.ghost_customer_id, "bad mail", "U", "C", day, "X", "None")]):
        t = micro_tables(
            spark,
            customers=[(1, "a@x.com", "A", "A", day, "IN", None), (1, "a@x.com", "A", "A", day, "IN", None), (2, "not a mail", "B", "B", day, "IN", None),
                       (None, None, "N", "N", day, "IN", None), (5, "system.orphan@example.com", "C", "C", day, "IN", None), *ghost],
            products=[(7, "p", "C", "s", 5, 2, day, True), (7, "p", "C", "s", 5, 9, day, True), (8, "q", "C", "s", 1, 2, day, True), (None, "n", "C", "s", 3, 2, day, True)],
            orders=[(10, 1, day, "Delivered", "UPI", "IN", 1, Decimal(1)), (11, None, day, "Delivered", "UPI", "IN", 1, None), (12, 99, None, "Delivered", "UPI", "IN", 1, Decimal(3)),
                    (13, 2, dt.date(2030, 1, 1), "Delivered", "UPI", "IN", 1, Decimal(1)), (13, 2, dt.date(2030, 1, 1), "Delivered", "UPI", "IN", 1, Decimal(1))],
            order_items=[(1, 10, 7, 1, 1, None), (2, 10, 7, 0, -1, 120), (3, 11, 7, 1, 4, 0), (4, 999, 7, 1, 1, 0), (5, None, 6, 1, 1, 0), (6, 12, None, 1, 3, 0)],
            inventory=[(7, 1, -3, day), (7, 2, 1, day), (9, 1, -1, day), (None, 1, -1, day)][:0],
            customer_reviews=[(1, 7, 1, 9, "x", day, True), (2, 7, 2, 4, "x", day, True), (2, 7, 2, 4, "x", day, True), (3, 6, 1, 4, "x", day, True), (4, 5, None, 0, "x", None, None),
                              (5, 7, None, 3, "x", day, True), (6, 7, P.ghost_customer_id, 3, "x", day, True)],
            promotion_usage=[(1, 10, 3, True, day), (2, 10, 3, True, day), (3, 10, None, True, day)])
        assert rows(quality.dq_run_all(t, P)) == rows(quality.dq_run_all_by_check(t, P))
