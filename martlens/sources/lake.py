"""Parquet lake of the retail tables: fixed-schema reads and the sinks.

Writes go to a new folder and are published by the caller (write then swap a
pointer); nothing here relies on machine-local temporary storage.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens import schemas
from martlens.functions.dates import MONTH, with_month
from martlens.functions.windows import number_rows
from martlens.sources import versions


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.TABLES[name]).parquet(table_path(root, name))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that the caller has written itself."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project and cast ``df`` to the declared schema of table ``name``."""
    sch = schemas.TABLES[name]
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in sch.fields])


# Rows of the big tables are sorted inside each file: the date range of a row group
# lets date questions skip it, and per-order aggregates read sorted runs.
SORT_WITHIN = {"orders": ["order_date", "order_id"], "order_items": ["order_id"]}


def write_lake(tables, root: str, names=None, mode: str = "overwrite", by_month: bool = False) -> None:
    """Parquet folders, one a table. ``by_month``: orders in a folder a month (``session.by_month`` tells
    whether a table is large enough for that); a month of any size is split over tasks by date."""
    for name in names or schemas.TABLES:
        df = conform(tables[name], name)
        if by_month and name == "orders":
            df = with_month(df)
            df = df.repartitionByRange(MONTH, *SORT_WITHIN[name]).sortWithinPartitions(MONTH, *SORT_WITHIN[name])
            df.write.mode(mode).partitionBy(MONTH).parquet(table_path(root, name))
            continue
        if name in SORT_WITHIN:
            df = df.sortWithinPartitions(*SORT_WITHIN[name])
        df.write.mode(mode).parquet(table_path(root, name))


def snapshot(df: DataFrame, path: str) -> None:
    """CREATE TABLE backup AS SELECT: fails if the target already exists."""
    df.write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """INSERT rows (audit / issues history)."""
    df.write.mode("append").parquet(path)


def wipe_replace(df: DataFrame, path: str, id_col: str = "id", order_cols=None) -> int:
    """TRUNCATE ... RESTART IDENTITY then refill: ids renumbered from 1; returns the table's new version.

    The new rows are written beside the old ones and take their place in one step (``sources.versions``):
    read the table with ``versions.read_table``."""
    order_cols = order_cols or [c for c in df.columns if c != id_col]
    # numbered over all tasks, so that any table may be replaced
    cols = list(dict.fromkeys([*order_cols, *df.columns]))
    out = number_rows(df.select(cols), cols, out="_new_id")
    return versions.replace_table(out.select(F.col("_new_id").alias(id_col), *[c for c in df.columns if c != id_col]), path)


# Bucketed layout: orders and order items share the bucket count on order_id,
# so items JOIN orders and every per-order aggregate need no shuffle.
BUCKETS = {"orders": "order_id", "order_items": "order_id"}


def write_catalog(tables, database: str, location: str, n_buckets: int, names=None, by_month: bool = False) -> None:
    """Write the tables as catalog tables under ``location`` (a shared folder);
    orders and order items are bucketed and sorted by order_id. ``by_month``: each bucket of
    orders has a file a month, so date ranges prune months and joins still need no shuffle."""
    spark = tables.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name in names or schemas.TABLES:
        df = conform(tables[name], name)
        if name in BUCKETS:
            # same hash as the bucket id: each task writes exactly one bucket file
            df = df.repartition(n_buckets, BUCKETS[name])
            parted = by_month and name == "orders"
            w = (with_month(df) if parted else df).write.mode("overwrite").format("parquet")
            w = (w.partitionBy(MONTH) if parted else w).bucketBy(n_buckets, BUCKETS[name]).sortBy(BUCKETS[name])
        else:
            w = df.write.mode("overwrite").format("parquet")
        w.saveAsTable(f"{database}.{name}")


def read_catalog(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


# --------------------------------------------------------------------------- stored column defaults
def sql_literal(value) -> str:
    """A constant as SQL text."""
    if value is None or isinstance(value, bool):
        return "NULL" if value is None else str(value).lower()
    if isinstance(value, dt.date):
        return f"{'TIMESTAMP_NTZ' if isinstance(value, dt.datetime) else 'DATE'} '{value}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def add_column(spark: SparkSession, table: str, name: str, dtype: str, default=None) -> None:
    """ALTER TABLE ADD COLUMN [DEFAULT] on a catalog table: the default is kept in the table's metadata. Files that
    are there already are not rewritten and read with it; later inserts that leave the column out get it."""
    stored = "" if default is None else f" DEFAULT {sql_literal(default)}"
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {dtype}{stored})")


def set_default(spark: SparkSession, table: str, name: str, default) -> None:
    """ALTER COLUMN SET DEFAULT: for inserts from now on; rows that are there stay as they are."""
    spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}` SET DEFAULT {sql_literal(default)}")


def insert(df: DataFrame, table: str) -> None:
    """INSERT BY NAME: columns that ``df`` leaves out get their stored defaults; a NULL that it gives stays NULL."""
    df.sparkSession.sql("INSERT INTO " + table + " BY NAME SELECT * FROM {rows}", rows=df)
