"""Readers for the provided TPC-H-like parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Column pruning and filters are pushed into this scan by Catalyst.
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
