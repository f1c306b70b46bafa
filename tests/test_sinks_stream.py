"""Sinks (snapshot / append / wipe-replace / lake), streaming monitor, metamorphic checks."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from martlens.operators import quality
from martlens.operators.analytics import sales
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake, versions
from martlens.streaming import dq_monitor

SF = "/root/testdata/sf0.001"
P = Params.fixture()


@pytest.fixture(scope="module")
def tables(spark):
    return RetailTables.from_fixture(spark, SF)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="martlens-test-")


def test_snapshot_refuses_overwrite(spark, tables, scratch):
    path = os.path.join(scratch, "orders_backup")
    lake.snapshot(tables.orders, path)
    with pytest.raises(Exception):
        lake.snapshot(tables.orders, path)
    assert spark.read.parquet(path).count() == tables.orders.count()


def test_append_and_wipe_replace(spark, tables, scratch):
    path = os.path.join(scratch, "dq_issues")
    issues = quality.dq_run_all(tables, P)
    lake.append(issues, path)
    lake.append(issues, path)
    assert spark.read.parquet(path).count() == 2 * issues.count()
    lake.wipe_replace(issues.filter(F.col("row_count") > 50), path + "_cur", order_cols=["check_name"])
    ids = [r.id for r in versions.read_table(spark, path + "_cur").orderBy("id").collect()]
    assert ids == list(range(1, len(ids) + 1))


def test_lake_roundtrip_keeps_schema(spark, tables, scratch):
    lake.write_lake(tables, scratch, names=["orders", "customers"])
    back = RetailTables.from_lake(spark, scratch)
    types = lambda sch: [(f.name, f.dataType) for f in sch.fields]
    assert types(back.orders.schema) == types(lake.conform(tables.orders, "orders").schema)
    a = sales.q28b_monthly_season(back, P).collect()
    b = sales.q28b_monthly_season(tables, P).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_stream_monitor_two_batches_equals_batch(spark, tables, scratch):
    src = os.path.join(scratch, "src")
    tables.orders.repartition(2).write.parquet(src)
    q = dq_monitor.start_dq_monitor(spark, "orders", src, os.path.join(scratch, "sink"),
                                    os.path.join(scratch, "ckpt"), P, max_files_per_trigger=1)
    q.awaitTermination()
    got = {(r.check_name, r.row_count) for r in dq_monitor.monitor_totals(spark, os.path.join(scratch, "sink")).collect()}
    batch = quality.summarize(tables, P, [quality.BY_LETTER["h"], quality.BY_LETTER["k"]]).collect()
    assert got == {(r.check_name, r.row_count) for r in batch}
    n_batches = spark.read.parquet(os.path.join(scratch, "sink", "issues")).select("batch_id").distinct().count()
    assert n_batches == 2
    # replay: the commit of the last batch is lost, so a restart delivers it again
    before = sorted(map(tuple, dq_monitor.monitor_issues(spark, os.path.join(scratch, "sink")).collect()))
    os.remove(os.path.join(scratch, "ckpt", "commits", "1"))
    if os.path.exists(crc := os.path.join(scratch, "ckpt", "commits", ".1.crc")):
        os.remove(crc)
    q = dq_monitor.start_dq_monitor(spark, "orders", src, os.path.join(scratch, "sink"),
                                    os.path.join(scratch, "ckpt"), P, max_files_per_trigger=1)
    q.awaitTermination()
    assert os.path.exists(os.path.join(scratch, "ckpt", "commits", "1"))
    assert sorted(map(tuple, dq_monitor.monitor_issues(spark, os.path.join(scratch, "sink")).collect())) == before


def test_metamorphic_totals(spark, tables):
    pct = sum(r.percent_of_total for r in sales.q03_category_share(tables, P).collect())
    assert abs(pct - 100.0) < 0.05
    m25 = {r.month_year: r.total_revenue for r in sales.q25_mom_growth(tables, P).collect()}
    m28 = {r.year_month: r.total_sales for r in sales.q28b_monthly_season(tables, P).collect()}
    assert m25 == m28
    n_orders = tables.orders.count()
    with_items = tables.orders.join(tables.order_items.select("order_id").distinct(), "order_id").count()
    o = quality.check_op("o")(tables, P).collect()[0].row_count
    assert o + with_items == n_orders


def test_issue_ids_restart_and_follow_check_order(spark, tables):
    rows = quality.dq_run_all(tables, P).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    order = [c.name for c in quality.CHECKS]
    assert [r.check_name for r in rows] == [n for n in order if n in {r.check_name for r in rows}]
    assert all(r.detected_at == dt.datetime(2001, 7, 15) for r in rows)


def test_alter_add_column_and_manual_rows(spark, tables, scratch):
    from martlens.operators import cleaning
    cu = cleaning.alter_add_column(tables.customers, "is_active", False, "boolean")
    assert cu.filter("is_active").count() == 0 and "is_active" in cu.columns
    audit = cleaning.heal_manual_audit(spark, "orders_total_mismatch", "analyst", "Yes", "Done",
                                       dt.datetime(2024, 1, 1, 12, 0))
    drill = cleaning.fx_manual_issue(spark, "test_check_drill", "High", "test_failure_inserted_manually",
                                     dt.datetime(2024, 1, 28, 9, 0), issue_id=19)
    lake.append(audit, os.path.join(scratch, "audit"))
    lake.append(drill, os.path.join(scratch, "issues"))
    assert spark.read.parquet(os.path.join(scratch, "audit")).count() == 1
    back = spark.read.parquet(os.path.join(scratch, "issues")).collect()[0]
    assert back.check_name == "test_check_drill" and back.severity == "High"


def test_seed_scenarios_populate_segments(spark, tables):
    from martlens.operators import brief, cleaning
    seeded = cleaning.fx_seed_scenarios(tables, P)
    t2 = tables.replace(orders=seeded)
    r = seeded.filter("order_id between 1 and 1000").agg(F.min("customer_id"), F.max("customer_id"),
                                                         F.min("order_date"), F.max("order_date")).collect()[0]
    assert 1 <= r[0] and r[1] <= 150 and r[2] >= dt.date(2026, 2, 1) and r[3] <= dt.date(2026, 2, 27)
    row = brief.b07_rfm_ltv(t2, P).collect()[0]
    assert row.champions > 0


def test_data_quality_job_publishes_and_is_rerunnable(spark, tables, scratch, monkeypatch):
    from martlens.operators import dq_job
    from martlens.operators.alerts import al_outstanding
    night = dt.datetime(2001, 7, 15, 12, 55)
    assert dq_job.current_snapshot(spark, scratch, tables) is tables

    def die(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:  # the run dies after its issues are written
        m.setattr(dq_job, "notifications", die)
        with pytest.raises(RuntimeError):
            dq_job.run_data_quality_job(spark, tables, P, scratch, run_at=night)
    assert dq_job.published(spark, scratch) == []
    r1 = dq_job.run_data_quality_job(spark, tables, P, scratch, run_at=night)
    folder = dq_job.run_folder(spark, scratch, r1)
    # healed tables and results only: the unchanged tables are not copied
    assert sorted(os.listdir(folder)) == ["customers", "data_fix_audit", "dq_issues", "dq_notifications", "orders"]
    issues = spark.read.parquet(os.path.join(folder, "dq_issues"))
    expected = {(r.check_name, r.row_count) for r in quality.dq_run_all(tables, P).collect()}
    assert {(r.check_name, r.row_count) for r in issues.collect()} == expected
    assert [r.id for r in issues.orderBy("id").collect()] == list(range(1, issues.count() + 1))
    snap = dq_job.current_snapshot(spark, scratch, tables)
    assert snap.orders.filter("customer_id is null").count() == 0 and "_was_orphan" not in snap.orders.columns
    assert dq_job.run_data_quality_job(spark, tables, P, scratch, run_at=night) == r1  # again: adds nothing
    assert dq_job.current_snapshot(spark, scratch, tables).dq_issues.count() == issues.count()
    # a second night over the healed snapshot: orphans are gone, the history grows under new ids
    r2 = dq_job.run_data_quality_job(spark, snap, P, scratch, run_at=night + dt.timedelta(days=1))
    after = dq_job.current_snapshot(spark, scratch, tables)
    n = after.dq_issues.count()
    assert n > issues.count() and [r.id for r in after.dq_issues.orderBy("id").collect()] == list(range(1, n + 1))
    second = spark.read.parquet(os.path.join(dq_job.run_folder(spark, scratch, r2), "data_fix_audit"))
    assert second.filter("check_name = 'orders_invalid_customer'").count() == 0
    # the alerts run on the job's own output: all is open but what the heals fixed at the last sighting
    import dataclasses
    alerts = dataclasses.replace(P, alert_as_of=dt.date(2001, 7, 17), alert_cap=100)
    open_ = {r.check_name for r in al_outstanding(after, alerts).collect()}
    assert open_ and open_ <= {r.check_name for r in after.dq_issues.collect()}


def test_stream_monitor_on_order_items(spark, tables, scratch):
    src = os.path.join(scratch, "items_src")
    tables.order_items.write.parquet(src)
    q = dq_monitor.start_dq_monitor(spark, "order_items", src, os.path.join(scratch, "isink"),
                                    os.path.join(scratch, "ickpt"), P)
    q.awaitTermination()
    got = {(r.check_name, r.row_count) for r in dq_monitor.monitor_totals(spark, os.path.join(scratch, "isink")).collect()}
    batch = quality.summarize(tables, P, [quality.BY_LETTER["m"], quality.BY_LETTER["p"]]).collect()
    assert got == {(r.check_name, r.row_count) for r in batch} and got
    notes = spark.read.parquet(os.path.join(scratch, "isink", "notifications")).collect()
    assert {n.payload.split("|")[0] for n in notes} == {c for c, _ in got}


def test_the_job_derives_the_items_once(spark):
    from martlens.operators.dq_job import fn_run_checks
    t, made = RetailTables.from_fixture(spark, SF), spark.sparkContext.accumulator(0)
    items = t._builders["order_items"]()

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    t._builders["order_items"] = lambda: items.mapInArrow(counted, items.schema)
    assert fn_run_checks(t, P).count() > 0 and made.value == items.count()
