"""Alert report over the issue history and the fix audit trail."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.functions.exprs import lit_ts
from martlens.params import Params
from martlens.plans.tables import RetailTables

ISSUE_COLS = ["check_name", "severity", "row_count", "sample_ids", "details", "detected_at"]


def _today(t: RetailTables, p: Params) -> DataFrame:
    day = dt.datetime.combine(p.alert_as_of, dt.time())  # a range, so that it reaches the scan
    return t.dq_issues.filter((F.col("detected_at") >= lit_ts(day)) & (F.col("detected_at") < lit_ts(day + dt.timedelta(days=1))))


def al_today_high(t: RetailTables, p: Params) -> DataFrame:
    """Today's issues whose severity is 'high' in any letter case (CRITICAL excluded)."""
    return _today(t, p).filter(F.lower("severity") == "high").select(*ISSUE_COLS)


def al_today_urgent(t: RetailTables, p: Params) -> DataFrame:
    """Today's HIGH and CRITICAL issues (what the alert's wording asks for)."""
    return _today(t, p).filter(F.lower("severity").isin("high", "critical")).select(*ISSUE_COLS)


def al_alert_count(t: RetailTables, p: Params) -> DataFrame:
    return al_today_high(t, p).agg(F.count(F.lit(1)).alias("alert_count"))


def al_outstanding(t: RetailTables, p: Params) -> DataFrame:
    """Issues seen in the window before today with no fix recorded at or after
    their last sighting; newest ``alert_cap`` first.

    The reference's theta anti join (same check, fix_date >= last_seen) only
    needs each check's latest fix, so the audit side is reduced to one row per
    check before the join: no hot check can swamp a join task."""
    start = dt.datetime.combine(p.alert_as_of - dt.timedelta(days=p.alert_window_days), dt.time())
    end = dt.datetime.combine(p.alert_as_of, dt.time())
    recent = (t.dq_issues.filter((F.col("detected_at") >= lit_ts(start)) & (F.col("detected_at") < lit_ts(end)))
              .groupBy("check_name", "severity", "details").agg(F.max("detected_at").alias("last_seen")))
    # a fix entered by hand counts before the table has given it an id
    last_fix = (t.data_fix_audit.groupBy("check_name").agg(F.max("fix_date").alias("last_fix")))
    open_ = (recent.join(last_fix, "check_name", "left")
             .filter(F.col("last_fix").isNull() | (F.col("last_fix") < F.col("last_seen"))))
    return (open_.orderBy(F.col("last_seen").desc(), "check_name", "severity", "details").limit(p.alert_cap)
            .select("check_name", "severity", "details", F.to_date("last_seen").alias("last_seen")))


OPS = {"al_today_high": al_today_high, "al_today_urgent": al_today_urgent,
       "al_alert_count": al_alert_count, "al_outstanding": al_outstanding}
