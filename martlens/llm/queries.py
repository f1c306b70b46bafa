"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import (alignment, ann, decontamination, embedding_dedup, language, lexical, mixing, ngram_join, packing,
                          sharding, substring, token_counts, toxicity)
from martlens.llm.common import n_words

CATEGORIES = ["quality", "toxic"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cyclic_weights(names: list[str | None]) -> list[float]:
    """1, 2, 3, repeating, over the sorted names."""
    return [1.0 + k % 3 for k in range(len(names))]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.train(docs.where(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, report = mixing.mix(docs, n_words("text"), F.array("source"), cyclic_weights, ["doc_id", "text"])
    sources = spark.createDataFrame([(r["source"], r["size"], r["target"]) for r in report],
                                    "name string, source_size long, target double")
    return (mixed.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name")), "left")
            .select("doc_id", F.col("mix_size").alias("size"), "source_size", "target",
                    (F.col("mix_copies") * F.col("mix_size")).alias("taken")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle_into_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), F.col("doc_id"), keep={"ids_crc32": F.crc32("ids")})
    return packed.select(F.col("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_table(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents")).drop("text_hash", "group_id")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.classify(docs, chain, CATEGORIES).drop("text")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents")).drop("kept_text", "text_hash")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return alignment.with_link_counts(aligned).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_embedding_near_dedup, op3_mixing, op4_sharding, op5_packing, op6_token_counts,
                            op7_ngram_jaccard_join, op8_nearest_neighbours, op9_toxicity, op10_substring_dedup,
                            op11_benchmark_decontamination, op12_ranked_lexical_search, op13_cross_tokenizer_alignment)}
