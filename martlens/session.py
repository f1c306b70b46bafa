"""Spark session helpers shared by tests, the bench and the driver entry."""

from __future__ import annotations

import os
import tempfile
import time
import zipfile

from pyspark.sql import SparkSession

# Settings the operators rely on: UTC for date/timestamp parity with the oracle,
# AQE for runtime coalescing / skew-join splitting, ANSI arithmetic (default on).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of shared intermediates are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "martlens", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None,
                total_cores: int = 1) -> SparkSession:
    """A session with the settings above; ``input_bytes`` and ``total_cores`` size it for a cluster run."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    for k, v in (cluster_conf(input_bytes, total_cores) if input_bytes else {}).items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is provided by the deployment and must point at a
    shared file system; only when it is unset (local tests) do we create one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="martlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return f"{_work_root(spark)}/{name}"


def _work_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/martlens-work"


def clean_work(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Remove intermediate tables that nothing has been written to for so long; returns their names. For a
    deployment to call between runs: frames that still read such a table would lose it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_work_root(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    before, gone = (time.time() - 3600 * older_than_hours) * 1000, []
    for found in fs.listStatus(path):
        if found.getModificationTime() < before and fs.delete(found.getPath(), True):
            gone.append(found.getPath().getName())
    return sorted(gone)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once an application, as --py-files would: Python tasks import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp()), "martlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Sizing for a cluster run over ``input_bytes`` of parquet on ``total_cores``.

    Scan splits and post-shuffle partitions aim at ``target_partition_mb`` so a
    task's working set fits executor memory (Tungsten spills beyond it); AQE
    starts from enough shuffle partitions and coalesces small ones, and splits
    a skewed join partition over several tasks.
    """
    target = target_partition_mb << 20
    parts = max(total_cores * 2, input_bytes // target + 1)
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def by_month(table_bytes: int, months: int, n_buckets: int = 1, least_mb: int = 64) -> bool:
    """Whether orders of this size give month partitions (times buckets) files of at least ``least_mb``."""
    return table_bytes >= months * n_buckets * (least_mb << 20)


def bucket_count(table_bytes: int, bucket_mb: int = 1024, minimum: int = 8) -> int:
    """Buckets for a bucketed fact table: about ``bucket_mb`` per bucket, a power of two."""
    n = max(minimum, table_bytes // (bucket_mb << 20) + 1)
    return 1 << (int(n) - 1).bit_length()
