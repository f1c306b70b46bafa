"""The brief from stored rollups: a new day is folded in alone and gives the full computation's row."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from martlens.operators import brief_rollup
from martlens.operators.brief import METRICS, b28_brief_row
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake, versions
from martlens.testing import micro_tables

P = Params.fixture()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("rollup-lake"))
    lake.write_lake(RetailTables.from_fixture(spark, SF), root)
    return RetailTables.from_lake(spark, root)


def parts_of(t, cond_of_orders, orphans):
    """The facts of some orders, and the items and uses of no order if ``orphans``."""
    o = t.orders.where(cond_of_orders)
    ids, all_ids = o.select("order_id").distinct(), t.orders.select("order_id").distinct()
    facts = {"orders": o}
    for name in ("order_items", "promotion_usage"):
        own = t[name].join(ids, "order_id", "left_semi")
        facts[name] = own.unionByName(t[name].join(all_ids, "order_id", "left_anti")) if orphans else own
    return t.replace(**facts)


def test_row_has_every_metric(spark, tables):
    row = b28_brief_row(tables, P).collect()[0].asDict()
    for metric in METRICS:
        own = metric(tables, P).collect()[0].asDict()
        assert {k: row[k] for k in own} == own, metric.__name__


def test_new_days_on_top_of_stored_rollups_equal_the_full_row(spark, tables, tmp_path):
    root = str(tmp_path / "rollups")
    last = tables.orders.agg(F.max("order_date")).first()[0]
    days = [(f"day {k}", F.col("order_date") == F.lit(last - dt.timedelta(days=k))) for k in (1, 0)]
    before = F.coalesce(F.col("order_date") < F.lit(last - dt.timedelta(days=1)), F.lit(True))
    assert brief_rollup.fold_batch(spark, root, parts_of(tables, before, True), "history") == 1
    for n, (name, cond) in enumerate(days, 2):
        assert brief_rollup.fold_batch(spark, root, parts_of(tables, cond, False), name) == n
    assert brief_rollup.fold_batch(spark, root, parts_of(tables, days[1][1], False), "day 0") is None
    rollups, batches = brief_rollup.stored(spark, root)
    assert batches == ["history", "day 1", "day 0"]
    assert brief_rollup.brief_row(rollups, tables, P).collect() == b28_brief_row(tables, P).collect()


def test_a_day_is_folded_without_reading_the_other_days(spark, tables, tmp_path):
    """Each day's facts lie in a folder of their own; the fold and the row after it read one of them."""
    last = tables.orders.agg(F.max("order_date")).first()[0]
    for name, cond in (("old", F.coalesce(F.col("order_date") < F.lit(last), F.lit(True))), ("new", F.col("order_date") == F.lit(last))):
        part = parts_of(tables, cond, name == "old")
        for table in ("orders", "order_items", "promotion_usage"):
            part[table].write.parquet(str(tmp_path / name / table))
    def read(name):
        return tables.replace(**{x: spark.read.schema(tables[x].schema).parquet(str(tmp_path / name / x)) for x in ("orders", "order_items", "promotion_usage")})
    root = str(tmp_path / "rollups")
    brief_rollup.fold_batch(spark, root, read("old"), "old")
    for table in ("orders", "order_items", "promotion_usage"):  # the old facts are not there any more
        (tmp_path / "old" / table).rename(tmp_path / f"gone-{table}")
    brief_rollup.fold_batch(spark, root, read("new"), "new")
    row = brief_rollup.brief_row(brief_rollup.stored(spark, root)[0], tables, P)
    scans = row._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "new") not in scans and "gone" not in scans
    assert row.collect() == b28_brief_row(tables, P).collect()


def test_random_splits_merge_to_one_state(spark, tables):
    whole = brief_rollup.partials(tables)
    k = F.pmod(F.hash("order_id"), F.lit(3))
    parts = [brief_rollup.partials(parts_of(tables, k == i, i == 2)) for i in range(3)]
    merged = brief_rollup.merge(brief_rollup.merge(parts[0], parts[1]), parts[2])
    other = brief_rollup.merge(parts[2], brief_rollup.merge(parts[1], parts[0]))
    for name in brief_rollup.NAMES:
        rows = [sorted(map(str, df.select(whole[name].columns).collect())) for df in (merged[name], other[name])]
        assert rows[0] == rows[1]
        cols = [c for c in whole[name].columns if c != "n_undated"]  # items of orders in another part count as undated there
        keep = whole[name].columns if name != "by_product" else cols
        assert sorted(map(str, merged[name].select(keep).collect())) == sorted(map(str, whole[name].select(keep).collect())), name


def test_two_writers_lose_no_batch(spark, tables, tmp_path):
    root = str(tmp_path / "rollups")
    k = F.pmod(F.hash("order_id"), F.lit(2))
    threads = [threading.Thread(target=brief_rollup.fold_batch, args=(spark, root, parts_of(tables, k == i, i == 0), f"part {i}")) for i in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rollups, batches = brief_rollup.stored(spark, root)
    assert sorted(batches) == ["part 0", "part 1"] and len(versions.committed(spark, root)) == 2
    assert brief_rollup.brief_row(rollups, tables, P).collect() == b28_brief_row(tables, P).collect()


def test_empty_tables_and_null_keys(spark):
    def agree(t):
        row = b28_brief_row(t, P).collect()
        assert len(row) == 1
        for metric in METRICS:
            own = metric(t, P).collect()[0].asDict()
            assert {k: row[0][k] for k in own} == own, metric.__name__
    agree(micro_tables(spark))
    day = dt.date(2001, 6, 1)
    agree(micro_tables(
        spark,
        customers=[(1, "a@x.com", "A", "A", day, None, None), (2, None, "B", "B", None, "IN", "Gold"), (None, None, "C", "C", day, "US", "Gold")],
        products=[(7, "p", None, "s", 5, 0, day, True), (8, None, "C", "s", 1, 2, day, True), (None, "n", "C", "s", None, 2, day, True)],
        orders=[(10, 1, day, None, "UPI", "IN", 100, None), (11, None, day, "Paid", None, "IN", None, None), (12, 1, day, "Paid", "UPI", "IN", 40, None),
                (13, 2, None, "Paid", "UPI", "IN", 5, None), (14, 99, dt.date(2001, 5, 31), "Paid", "UPI", "IN", 7, None)],
        order_items=[(1, 10, 7, 1, 1, None), (2, 10, None, 2, 3, 20), (3, 999, 7, 1, 4, 10), (4, None, 8, 1, 1, 0), (5, 13, 55, 900, 1, 0)],
        inventory=[(1, 7, 3, "W", None, None)][:0],
        promotion_usage=[(1, 1, 10, True, day), (2, 1, 10, True, day), (3, 2, 999, True, day), (4, 2, None, True, day)]))


def test_facts_are_split_as_by_joins_in_one_pass(spark, tmp_path):
    """Ids that orders of both parts have, null ids and dates, and items and uses of no order."""
    day, month = dt.date(2001, 6, 1), dt.date(2001, 7, 1)
    t = micro_tables(
        spark, orders=[(1, 1, day, "s", "p", "IN", 1, None), (1, 1, month, "s", "p", "IN", 2, None), (2, 1, None, "s", "p", "IN", 3, None), (2, 1, None, "s", "p", "IN", 3, None),
                       (3, 1, dt.date(2001, 7, 9), "s", "p", "IN", 4, None), (None, 1, month, "s", "p", "IN", 5, None), (4, 1, dt.date(2001, 6, 30), "s", "p", "IN", 6, None)],
        order_items=[(k, o, 7, 1, 1, None) for k, o in enumerate([1, 1, 2, 3, 4, None, 99])], promotion_usage=[(k, 1, o, True, day) for k, o in enumerate([1, 2, 3, None, 99])])
    want = brief_rollup.facts_between(t, before=month, rest=True), brief_rollup.facts_between(t, start=month)
    got = brief_rollup.facts_split(t, month, str(tmp_path / "facts"))
    for a, b in zip(want, got):
        for name in ("orders", "order_items", "promotion_usage"):
            assert sorted(map(str, a[name].select(t[name].columns).collect())) == sorted(map(str, b[name].collect())), name


def counted_items(spark):
    """Tables whose items say how many rows of them were made."""
    t, made = RetailTables.from_fixture(spark, SF), spark.sparkContext.accumulator(0)
    items = t._builders["order_items"]()

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    t._builders["order_items"] = lambda: items.mapInArrow(counted, items.schema)
    return t, made, items.count()


def test_the_row_from_rollups_derives_the_items_once(spark, tables):
    t, made, n = counted_items(spark)
    got = brief_rollup.b28_from_rollups(t, P).collect()
    assert made.value == n and got == b28_brief_row(tables, P).collect()
