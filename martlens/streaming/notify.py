"""The notification channel: a consumer of published runs with offsets of its own.

Every published run is one small file in the job's ``_versions`` folder, put in place whole and never changed. A
consumer is a structured stream over that folder: its checkpoint is its place in the channel, so any number
of consumers listen to one job at their own pace, and one that was down catches up. A batch names new runs;
their payload rows are read from the runs' folders and handed to the receiver with the run's version. Delivery is
at least once: a batch whose receiver fails, or whose commit is lost, is delivered again under the same versions.
A receiver that keys on the version, as ``table_receiver`` does, therefore neither loses nor doubles a payload.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.operators.dq_job import run_data_quality_job
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.session import work_dir
from martlens.sources import lake

PAYLOADS = "channel string, payload string, detected_at timestamp_ntz"
DELIVERED = PAYLOADS + ", run_id string, version bigint"


def published_payloads(spark: SparkSession, root: str, runs: DataFrame) -> DataFrame:
    """The payloads of some runs (version, run_id, data): a run is a row, and a batch a few of them."""
    parts = [spark.read.schema(PAYLOADS).parquet(lake.table_path(f"{root}/{r['data']}", "dq_notifications"))
             .withColumns({"run_id": F.lit(r["run_id"]), "version": F.lit(r["version"]).cast("bigint")}) for r in runs.collect()]
    none = spark.createDataFrame([], DELIVERED)
    return functools.reduce(DataFrame.unionByName, parts, none)


def table_receiver(path: str) -> Callable[[DataFrame], None]:
    """Payloads in a table, a partition a version: the same delivery again writes the same partition again."""
    def receive(payloads: DataFrame) -> None:
        (payloads.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))
    return receive


def start_consumer(spark: SparkSession, root: str, checkpoint: str, receive: Callable[[DataFrame], None],
                   runs_per_batch: int = 10, available_now: bool = True):
    """Deliver the payloads of all runs published below ``root`` that this checkpoint has not delivered yet."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).cast("bigint")
    stream = (spark.readStream.schema("run_id string, data string").option("maxFilesPerTrigger", runs_per_batch).json(f"{root}/_versions")
              .select("run_id", "data", number.alias("version")))

    def deliver(runs: DataFrame, batch_id: int) -> None:
        payloads = published_payloads(spark, root, runs.where("data is not null"))
        if not payloads.isEmpty():
            receive(payloads)
    w = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """What a ``table_receiver`` has got; none before the first payload."""
    return spark.read.schema(DELIVERED).parquet(path) if lake.exists(spark, path) else spark.createDataFrame([], DELIVERED)


def stream_notify(t: RetailTables, p: Params) -> DataFrame:
    """A nightly run publishes, and a consumer of its channel delivers: the payloads as they were received."""
    root = work_dir(t.spark, f"notify-{uuid.uuid4().hex[:12]}")
    run_data_quality_job(t.spark, t, p, f"{root}/job")
    start_consumer(t.spark, f"{root}/job", f"{root}/checkpoint", table_receiver(f"{root}/delivered")).awaitTermination()
    return delivered(t.spark, f"{root}/delivered").select("channel", "payload", "detected_at")


OPS = {"stream_notify": stream_notify}
