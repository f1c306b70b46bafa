"""Row numbers that no single task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOCAL = (1 << 33) - 1  # Spark's increasing ids: partition in the high bits, place in it in the low 33


def number_rows(df: DataFrame, order_cols: list[str], out: str = "rn", partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by order_cols)`` as BIGINT, spread over all tasks.

    Rows are range-partitioned on ``order_cols``, so a key of any size is split in sort order; each row
    takes its place in its partition plus the number of rows in earlier partitions (a running sum over one
    row per partition, which is also all that is broadcast). ``order_cols`` has to name every column of
    ``df``: then only equal rows can tie, and both uses of the ranged rows read one exchange."""
    assert set(order_cols) == set(df.columns), "order by every column"
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true") != "true":
        raise ValueError("row numbers need spark.sql.exchange.reuse: rows and their counts must come from one exchange")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order_cols)
    ranged = (dealt.sortWithinPartitions(*order_cols)
              .withColumn("_at", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright("_at", 33)))
    # counted as they come: only the numbered rows are sorted
    sizes = dealt.groupBy(F.spark_partition_id().cast("bigint").alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit(_LOCAL)) + 1)
            .drop("_part", "_at", "_before"))
