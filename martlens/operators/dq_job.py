"""The nightly data-quality job with its side effects.

Below ``root``, a shared folder, every attempt at a run writes one folder of its own: healed customers and
orders, the issues (ids from 1), notifications and audit rows. The tables that no heal touches are read where
they are and never copied. A numbered commit (``sources.versions``) publishes all of it at once and
hands out the ids of the histories: it starts them after the highest ids of the version before it. Data
files hold ids from 1 and readers add the start, so a run that loses the race for a number only commits
again. Readers look at published runs only: an attempt that dies has no effect, and its run may be started
again, also while the first attempt still writes. A run id that is published already does nothing.
The order of the versions, not of the dates, decides which tables are current: a run for an earlier date
adds its issues under that date.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlens import schemas
from martlens.functions.joins import with_scalar
from martlens.operators.cleaning import (audit_rows, flagged_heal, fx_manual_issue, heal_counts, heal_ghost_customer,
                                         heal_manual_audit)
from martlens.operators.quality import dq_run_all, notifications
from martlens.operators.quality_fused import run_all_fused
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.session import work_dir
from martlens.sources import lake, versions

HEALED = ("customers", "orders")
RUN = "run_id string, first_issue_id bigint, first_audit_id bigint"


def published(spark: SparkSession, root: str) -> list[dict]:
    """Versions of the published runs in the order of their commits: one a night, so the driver reads them."""
    return versions.committed(spark, root)


def run_folder(spark: SparkSession, root: str, run_id: str) -> str:
    """The folder of a published run."""
    return next(f"{root}/{e['data']}" for e in published(spark, root) if e["run_id"] == run_id)


def publish(spark: SparkSession, root: str, run_id: str, run_at: dt.datetime, folder: str, n_issues: int, n_audits: int) -> dict | None:
    """Commit a written folder; None if its run is published already."""
    def build(last: dict | None) -> dict | None:
        if any(e["run_id"] == run_id for e in published(spark, root)):
            return None
        issue, audit = (last["last_issue_id"], last["last_audit_id"]) if last else (0, 0)
        return {"run_id": run_id, "run_at": run_at.isoformat(), "data": folder.rsplit("/", 1)[1], "first_issue_id": issue + 1,
                "last_issue_id": issue + n_issues, "first_audit_id": audit + 1, "last_audit_id": audit + n_audits}
    return versions.commit(spark, root, build)


def run_data_quality_job(spark: SparkSession, t: RetailTables, p: Params, root: str,
                         run_at: dt.datetime | None = None, run_id: str | None = None) -> str:
    run_at = run_at or dt.datetime.combine(p.dq_as_of, dt.time())
    run_id = run_id or run_at.strftime("%Y%m%dT%H%M%S")
    if any(e["run_id"] == run_id for e in published(spark, root)):
        return run_id
    folder = versions.new_folder(root)

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(lake.table_path(folder, name))
        return spark.read.schema(df.schema).parquet(lake.table_path(folder, name))

    lake.write_lake(t.replace(customers=heal_ghost_customer(t, p)), folder, names=["customers"])
    # one heal pass: the flags that count the changes lie beside the healed columns, and readers skip them
    flagged = write(flagged_heal(t, p).sortWithinPartitions(*lake.SORT_WITHIN["orders"]), "orders")
    audit = write(audit_rows(heal_counts(flagged), run_at).withColumn("run_id", F.lit(run_id)), "data_fix_audit")
    checked = t.replace(**{n: lake.read_table(spark, folder, n) for n in HEALED})
    issues = write(run_all_fused(checked, p, detected_at=run_at).withColumn("run_id", F.lit(run_id)), "dq_issues")
    write(notifications(issues), "dq_notifications")
    publish(spark, root, run_id, run_at, folder, issues.count(), audit.count())
    return run_id


def _history(spark: SparkSession, root: str, name: str, runs: list[dict]) -> DataFrame:
    """The rows of all published runs under the ids of the history: one read of all folders, and the start
    of each run's ids, a row a run, broadcast."""
    id_col, first = schemas.PRIMARY_KEYS[name], {"dq_issues": "first_issue_id", "data_fix_audit": "first_audit_id"}[name]
    schema = schemas.TABLES[name]
    stored = spark.read.schema(StructType([*schema.fields, StructField("run_id", StringType())])).parquet(
        *[lake.table_path(f"{root}/{e['data']}", name) for e in runs])
    starts = spark.createDataFrame([(e["run_id"], e["first_issue_id"], e["first_audit_id"]) for e in runs], RUN)
    return stored.join(F.broadcast(starts), "run_id").select(
        *[(F.col(first) + F.col(c) - 1).alias(c) if c == id_col else F.col(c) for c in schema.fieldNames()])


def current_snapshot(spark: SparkSession, root: str, base: RetailTables) -> RetailTables:
    """``base`` with the customers and orders of the last published run, and the issues and audit rows of
    all published runs, which the alerts read; ``base`` itself before the first run."""
    runs = published(spark, root)
    if not runs:
        return base
    return base.replace(**{n: lake.read_table(spark, f"{root}/{runs[-1]['data']}", n) for n in HEALED},
                        dq_issues=_history(spark, root, "dq_issues", runs),
                        data_fix_audit=_history(spark, root, "data_fix_audit", runs))


def run_records(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """What one run wrote besides the healed tables: issues, audit rows and notifications as text rows."""
    read = lambda n: spark.read.parquet(lake.table_path(run_folder(spark, root, run_id), n))
    parts = [read("dq_issues").select(F.lit("issue").alias("record"), "id",
                                      F.concat_ws("|", "check_name", "severity", "row_count", "sample_ids", "details").alias("content")),
             read("data_fix_audit").select(F.lit("audit"), "audit_id", F.concat_ws("|", "check_name", "fixed_by", "sql_executed", "notes")),
             read("dq_notifications").select(F.lit("notification"), F.lit(None).cast("bigint"), F.concat_ws("|", "channel", "payload"))]
    return functools.reduce(DataFrame.union, parts)


def _new_folder(t: RetailTables, name: str) -> str:
    return work_dir(t.spark, f"{name}-{uuid.uuid4().hex[:12]}")


def fn_run_checks(t: RetailTables, p: Params) -> DataFrame:
    """The procedure with its side effects: runs the job in a folder of its own, returns what it wrote."""
    root = _new_folder(t, "dq-run")
    t.store(_new_folder(t, "dq-run-tables"), "order_items")  # read by the heal and by most checks
    return run_records(t.spark, root, run_data_quality_job(t.spark, t, p, root))


# --------------------------------------------------------------------------- sinks: write, then read back
def snk_snapshot(t: RetailTables, p: Params) -> DataFrame:
    path = _new_folder(t, "snapshot")
    lake.snapshot(t.customers, path)
    return t.spark.read.schema(t.customers.schema).parquet(path)


def snk_append(t: RetailTables, p: Params) -> DataFrame:
    """The issue history in two appends, by severity."""
    path = _new_folder(t, "append")
    urgent = F.lower("severity").isin("high", "critical")
    for part in (t.dq_issues.filter(urgent), t.dq_issues.filter(~urgent | F.col("severity").isNull())):
        lake.append(part, path)
    return t.spark.read.schema(t.dq_issues.schema).parquet(path)


def snk_wipe_replace(t: RetailTables, p: Params) -> DataFrame:
    """The issues of a run take the place of the history, with ids from 1."""
    path = _new_folder(t, "wipe-replace")
    issues = dq_run_all(t, p)
    lake.wipe_replace(t.dq_issues, path, order_cols=["id"])
    lake.wipe_replace(issues, path, order_cols=["id"])
    return versions.read_table(t.spark, path)


def _append_by_hand(t: RetailTables, name: str, row: DataFrame) -> DataFrame:
    """Append one row to a history under its next id, as a serial column gives it, and read the history back."""
    path = _new_folder(t, f"by-hand-{name}")
    id_col, schema = schemas.PRIMARY_KEYS[name], schemas.TABLES[name]
    lake.append(lake.conform(t[name], name), path)
    stored = t.spark.read.schema(schema).parquet(path)
    last = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("last"))  # one row
    lake.append(with_scalar(row, last).withColumn(id_col, F.coalesce(id_col, F.col("last") + 1)).select(*schema.fieldNames()), path)
    return t.spark.read.schema(schema).parquet(path)


def heal_manual_audit_appended(t: RetailTables, p: Params) -> DataFrame:
    row = heal_manual_audit(t.spark, "orders_total_mismatch", "analyst", "Yes", "Done", dt.datetime.combine(p.alert_as_of, dt.time()))
    return _append_by_hand(t, "data_fix_audit", row)


def fx_manual_issue_appended(t: RetailTables, p: Params) -> DataFrame:
    row = fx_manual_issue(t.spark, "test_check_drill", "High", "test_failure_inserted_manually", dt.datetime.combine(p.alert_as_of, dt.time()))
    return _append_by_hand(t, "dq_issues", row)


def alter_add_column_stored(t: RetailTables, p: Params) -> DataFrame:
    """Customers as a catalog table that gets a column with a stored default; no file is written for it."""
    database, root = f"martlens_alter_{uuid.uuid4().hex[:12]}", _new_folder(t, "alter")
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    try:
        lake.conform(t.customers, "customers").write.format("parquet").option("path", f"{root}/customers").saveAsTable(f"{database}.customers")
        lake.add_column(t.spark, f"{database}.customers", "is_active", "boolean", False)
        return t.spark.table(f"{database}.customers")
    finally:  # the files are not the catalog's: the frame reads them on
        t.spark.sql(f"DROP DATABASE {database} CASCADE")


OPS = {"fn_run_checks": fn_run_checks, "snk_snapshot": snk_snapshot, "snk_append": snk_append,
       "snk_wipe_replace": snk_wipe_replace, "heal_manual_audit": heal_manual_audit_appended, "fx_manual_issue": fx_manual_issue_appended,
       "alter_add_column": alter_add_column_stored}
