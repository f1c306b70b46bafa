"""number_rows numbers like one global window, with no key's rows in one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlens.functions.windows import number_rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_match_a_global_window_with_a_hot_key(spark, partitions):
    rows = [(1, i % 7, i) for i in range(1500)] + [(k, j, j) for k in range(2, 40) for j in range(3)]
    rows += [(1, 3, 17), (1, 3, 17), (None, 1, 1), (None, None, 2)]  # repeated rows and null keys
    df = spark.createDataFrame(rows, "k long, a int, b int")
    got = number_rows(df, ["k", "a", "b"], partitions=partitions)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "a", "b")).cast("long"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert dict(got.dtypes)["rn"] == "bigint"


def test_both_uses_read_one_exchange(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 3).alias("a"))
    got = number_rows(df, ["k", "a"], partitions=5).agg(F.max("rn"))
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_all_columns_are_needed(spark):
    with pytest.raises(AssertionError):
        number_rows(spark.range(3).withColumn("x", F.lit(1)), ["id"])


def test_numbering_refuses_to_run_without_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        with pytest.raises(ValueError, match="reuse"):
            number_rows(spark.range(5).toDF("a"), ["a"])
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
