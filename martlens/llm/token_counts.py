"""Token counts: an exact histogram of encoded lengths and its sums for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlens.llm.common import materialize
from martlens.llm.tokens import with_token_counts

#: Lengths are summed in ranges of so many; ranges are then summed among themselves.
RANGE = 1024


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens, docs): how many documents encode to each length; null and empty texts to 0."""
    return with_token_counts(docs.select(text), text, "n_tokens", path).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """One row for every length that occurs, taken as a context limit:

    context_limit; docs (of just that length); docs_at_most and tokens_at_most (documents that fit
    and their tokens); docs_over (truncated at this limit); tokens_truncated (tokens kept of all
    documents at this limit); tokens_lost; quantile (share of documents that fit: the limit is that
    quantile of the lengths). For a limit between two rows, docs_over and tokens_at_most are those
    of the row below. Suffix sums run within ranges of RANGE lengths and then over the ranges, so
    no task holds all lengths. An empty histogram gives no rows.
    """
    h = (histogram.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))
         .withColumn("part", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("docs") * F.col("n_tokens")))
    h = materialize(h, "lengths")
    above = W.orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    ranges = (h.groupBy("part").agg(F.sum("docs").alias("range_docs"), F.sum("tokens").alias("range_tokens"))
              .withColumn("docs_above", F.coalesce(F.sum("range_docs").over(above), F.lit(0)))
              .withColumn("tokens_above", F.coalesce(F.sum("range_tokens").over(above), F.lit(0)))
              .select("part", "docs_above", "tokens_above"))
    all_ = h.agg(F.sum("docs").alias("all_docs"), F.sum("tokens").alias("all_tokens"))
    within = W.partitionBy("part").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, -1)
    return (h.withColumn("docs_within", F.coalesce(F.sum("docs").over(within), F.lit(0)))
            .withColumn("tokens_within", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
            .join(ranges, "part").crossJoin(F.broadcast(all_))
            .withColumn("docs_over", F.col("docs_within") + F.col("docs_above"))
            .withColumn("tokens_over", F.col("tokens_within") + F.col("tokens_above"))
            .select(F.col("n_tokens").alias("context_limit"), "docs",
                    (F.col("all_docs") - F.col("docs_over")).alias("docs_at_most"),
                    (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_at_most"), "docs_over",
                    (F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
                    (F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")).alias("tokens_lost"),
                    ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile")))
