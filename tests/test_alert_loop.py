"""The alert loop: a fix entered by hand clears an issue; a clean stream has no totals; day filters are pushed."""

import datetime as dt

import pytest

from martlens import schemas
from martlens.operators.alerts import al_outstanding, al_today_high
from martlens.operators.cleaning import heal_ghost_customer, heal_manual_audit
from martlens.params import Params
from martlens.session import ensure_checkpoint_dir
from martlens.streaming.dq_monitor import monitor_totals, start_dq_monitor
from martlens.testing import micro_tables

P = Params.fixture()


def issues(spark, tmp_path=None):
    seen = dt.datetime.combine(P.alert_as_of - dt.timedelta(days=2), dt.time(8))
    return micro_tables(spark, dq_issues=[(1, "k", "HIGH", 3, "1,2,3", "late", seen)])


def test_manual_fix_clears_an_outstanding_issue(spark):
    t = issues(spark)
    assert [r["check_name"] for r in al_outstanding(t, P).collect()] == ["k"]
    fix = heal_manual_audit(spark, "k", "me", "update", "done", dt.datetime.combine(P.alert_as_of, dt.time()))
    assert al_outstanding(t.replace(data_fix_audit=fix), P).collect() == []


def test_day_filter_reaches_the_scan(spark, tmp_path):
    t = issues(spark)
    t.dq_issues.write.parquet(f"{tmp_path}/issues")
    stored = t.replace(dq_issues=spark.read.parquet(f"{tmp_path}/issues"))
    df = al_today_high(stored, P)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(detected_at" in plan and "LessThan(detected_at" in plan


def test_monitor_on_a_stream_without_violations(spark, tmp_path):
    spark.createDataFrame([], schemas.TABLES["orders"]).write.parquet(f"{tmp_path}/in")
    start_dq_monitor(spark, "orders", f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", P).awaitTermination()
    (tmp_path / "out" / "issues").mkdir(parents=True, exist_ok=True)
    assert monitor_totals(spark, f"{tmp_path}/out").collect() == []


def test_repeated_ghost_customer_is_not_added_again(spark):
    row = {"customer_id": P.ghost_customer_id}
    cols = schemas.TABLES["customers"]
    rows = [tuple(row.get(f.name) for f in cols)] * 2
    t = micro_tables(spark, customers=rows)
    assert heal_ghost_customer(t, P).count() == 2


def test_checkpoint_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
