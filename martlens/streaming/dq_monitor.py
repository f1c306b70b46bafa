"""Streaming data-quality monitor.

``readStream`` over an append-only parquet table -> ``foreachBatch`` applies
the stateless row rules of that table (checks E, F, H, K, L, M, P, R) to each
micro-batch and writes the batch's issue rows and notification payloads into
``batch_id`` partitions.  A replayed batch (after a failure, the checkpoint
re-delivers the same batch id) overwrites its own partition only, so the
sink stays exactly-once without a transactional table format.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens import schemas
from martlens.functions.exprs import lit_ts
from martlens.operators.dq_job import HEALED
from martlens.operators.quality import BY_LETTER, notifications, summarize
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.session import work_dir
from martlens.sources import lake

# Which row-level checks apply to which table.
ROW_RULES = {"orders": ("h", "k"), "order_items": ("m", "p"), "products": ("e",), "promotions": ("f",),
             "customer_reviews": ("l",), "customers": ("r",)}
# The columns that these checks read; a stream's files may hold no others.
RULE_COLUMNS = {"orders": ("order_id", "customer_id", "order_date", "final_total"),
                "order_items": ("order_item_id", "quantity", "unit_price", "discount_percent"),
                "products": ("product_id", "selling_price", "unit_cost"),
                "promotions": ("promotion_id", "times_used", "max_uses"),
                "customer_reviews": ("review_id", "rating", "review_date"), "customers": ("customer_id", "email")}
ISSUES = "check_name string, severity string, row_count bigint, sample_ids string, details string, batch_id bigint"


def batch_issues(spark: SparkSession, table: str, batch: DataFrame, p: Params, batch_id: int,
                 detected_at: dt.datetime) -> DataFrame:
    t = RetailTables.from_frames(spark, {table: batch})
    checks = [BY_LETTER[x] for x in ROW_RULES[table]]
    return (summarize(t, p, checks).drop("seq")
            .withColumn("detected_at", lit_ts(detected_at))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint")))


def start_dq_monitor(spark: SparkSession, table: str, source_path: str, sink_root: str, checkpoint: str,
                     p: Params, available_now: bool = True, max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(schemas.TABLES[table])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    detected_at = dt.datetime.combine(p.dq_as_of, dt.time())

    # an empty write leaves the folder, so that a stream that finds nothing can be read
    spark.createDataFrame([], ISSUES).write.mode("append").partitionBy("batch_id").parquet(f"{sink_root}/issues")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        issues = batch_issues(spark, table, batch, p, batch_id, detected_at).persist()  # few rows, two sinks
        (issues.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{sink_root}/issues"))
        (notifications(issues).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{sink_root}/notifications"))
        issues.unpersist()

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_run_monitor(spark: SparkSession, job_root: str, sink_root: str, checkpoint: str, p: Params,
                      available_now: bool = True, runs_per_trigger: int = 1):
    """Row rules over the tables of each published run, as the nightly job left them: the stream reads the job's
    commits (``sources.versions``), and each commit names the folder whose files are checked where they are.
    A batch writes partitions of its own, so a replayed one writes the same again."""
    stream = (spark.readStream.schema("run_id string, data string").option("maxFilesPerTrigger", runs_per_trigger)
              .json(f"{job_root}/_versions"))
    detected_at = dt.datetime.combine(p.dq_as_of, dt.time())
    spark.createDataFrame([], ISSUES).write.mode("append").partitionBy("batch_id").parquet(f"{sink_root}/issues")

    def per_batch(runs: DataFrame, batch_id: int) -> None:
        found = [batch_issues(spark, table, lake.read_table(spark, f"{job_root}/{r['data']}", table), p, batch_id, detected_at)
                 for r in runs.where("data is not null").collect() for table in HEALED]  # a few runs
        if found:
            (functools.reduce(DataFrame.unionByName, found).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{sink_root}/issues"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def monitor_issues(spark: SparkSession, sink_root: str) -> DataFrame:
    """The issues of every batch, with samples and details; the schema is stated for a run that found nothing."""
    return spark.read.schema(ISSUES).parquet(f"{sink_root}/issues")


def monitor_totals(spark: SparkSession, sink_root: str) -> DataFrame:
    """Issue counts summed over all processed batches."""
    return (monitor_issues(spark, sink_root).groupBy("check_name", "severity", "details")
            .agg(F.sum("row_count").cast("bigint").alias("row_count"))
            .select("check_name", "severity", "row_count", "details"))


def stream_dq_monitor(t: RetailTables, p: Params) -> DataFrame:
    """Run a monitor over each of the six tables that have row rules and return the summed issue counts.

    A stored table is streamed from its own files. A table that is derived has none: the columns that the
    rules need are written as the stream's source and removed again when the stream has read them; the sinks stay."""
    spark = t.spark
    root = work_dir(spark, f"stream-dq-{uuid.uuid4().hex[:12]}")
    streams = []
    for table, cols in RULE_COLUMNS.items():
        if table not in t.paths:
            t[table].select(*cols).write.parquet(f"{root}/source/{table}")
        streams.append(start_dq_monitor(spark, table, t.paths.get(table, f"{root}/source/{table}"), f"{root}/sink/{table}",
                                        f"{root}/checkpoint/{table}", p))
    for q in streams:
        q.awaitTermination()
    lake.remove(spark, f"{root}/source")
    return functools.reduce(DataFrame.unionByName, [monitor_totals(spark, f"{root}/sink/{table}") for table in RULE_COLUMNS])


OPS = {"stream_dq_monitor": stream_dq_monitor}
