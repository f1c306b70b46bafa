"""Orders stored by month: date questions open the files of their months only, and give the same rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from martlens import session
from martlens.functions.dates import MONTH, in_dates
from martlens.operators import brief, brief_rollup, cleaning, quality
from martlens.operators.analytics import sales
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake
from martlens.testing import micro_tables

P = Params.fixture()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    t = RetailTables.from_fixture(spark, SF)
    lake.write_lake(t, f"{root}/plain")
    lake.write_lake(t, f"{root}/months", by_month=True)
    lake.write_catalog(t, "martlens_months", f"{root}/catalog", 2, by_month=True)
    yield {"plain": RetailTables.from_lake(spark, f"{root}/plain"), "months": RetailTables.from_lake(spark, f"{root}/months"),
           "buckets": RetailTables.from_catalog(spark, "martlens_months")}
    spark.sql("DROP DATABASE martlens_months CASCADE")


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def orders_scans(df):
    """(plan text, files read) of each scan of orders after the query has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves, out = plan.collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        text = leaf.toString()
        if "FileScan" in text and re.search(r"ReadSchema: struct<.*order_id|final_total|ReadSchema: struct<order_date|total_amount", text) and "order_month" in text:
            out.append((text, leaf.metrics().apply("numFiles").value()))
    return out


@pytest.mark.parametrize("layout", ["months", "buckets"])
def test_literal_ranges_prune(spark, stored, static, layout):
    t = stored[layout]
    everything = orders_scans(t.orders)[0][1]
    [(text, files)] = orders_scans(sales.q01_monthly_revenue(t, P))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month#\d+ >= 2000-01-01[^\]]*order_month#\d+ < 2001-01-01", text), text
    assert 0 < files <= everything * 13 / 70
    [(text, files)] = orders_scans(quality.check_op("k")(t, P))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month#\d+ >= 2001-07-01", text) and files <= everything * 4 / 70


def test_the_report_date_prunes_at_run_time(spark, stored, static):
    t = stored["months"]
    scans = orders_scans(brief.b02_topline(t, P))
    assert any("PartitionFilters: [isnotnull(order_month" in text and "Subquery" in text for text, _ in scans)
    assert min(files for _, files in scans) <= 3 < max(files for _, files in scans)


def test_same_rows_in_every_layout(spark, stored):
    for op in (sales.q01_monthly_revenue, sales.q25_mom_growth, sales.q28b_monthly_season, quality.check_op("k"), quality.check_op("h"), brief.b02_topline, brief.b28_brief_row,
               quality.dq_run_all, cleaning.heal_audit_log):
        rows = [sorted(map(str, op(t, P).collect())) for t in stored.values()]
        assert rows[0] == rows[1] == rows[2], op.__name__
    undated = [t.orders.where("order_date is null").count() for t in stored.values()]
    assert undated[0] == undated[1] == undated[2] > 0


def test_months_do_not_break_bucket_joins(spark, stored, static):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = cleaning.heal_order_totals(stored["buckets"], P)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_a_month_of_facts_for_the_rollups_prunes(spark, stored, static):
    part = brief_rollup.facts_between(stored["months"], start=dt.date(2001, 7, 1))
    [(text, files)] = orders_scans(part.orders)
    assert "order_month" in text.split("PartitionFilters")[1].split("]")[0] and files <= 4


@pytest.mark.parametrize("bounds, days", [
    (dict(start=dt.date(2001, 1, 31)), {31, 32, 60}), (dict(before=dt.date(2001, 2, 1)), {1, 31}), (dict(before=dt.date(2001, 2, 2)), {1, 31, 32}),
    (dict(after=dt.date(2001, 1, 31)), {32, 60}), (dict(on=dt.date(2001, 2, 1)), {32}), (dict(start=dt.date(2001, 1, 2), before=dt.date(2001, 3, 1)), {31, 32})])
def test_bounds(spark, tmp_path, bounds, days):
    rows = [(n, 1, dt.date(2000, 12, 31) + dt.timedelta(days=n), "s", "p", "c", 1, None) for n in (1, 31, 32, 60)] + [(99, 1, None, "s", "p", "c", 1, None)]
    t = micro_tables(spark, orders=rows)
    lake.write_lake(t, str(tmp_path), names=["orders"], by_month=True)
    stored = lake.read_table(spark, str(tmp_path), "orders")
    assert MONTH in stored.columns
    columns = {k: F.lit(v) for k, v in bounds.items()}
    for orders in (in_dates(t.orders, **bounds), in_dates(stored, **bounds), in_dates(stored, **columns)):
        assert {r.order_id for r in orders.collect()} == days


def test_size_rule():
    assert session.by_month(100 << 40, 84, 4096) and not session.by_month(10 << 30, 84, 16) and session.by_month(10 << 30, 84)
