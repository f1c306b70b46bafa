"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before it kept, and
returns the columns of documents; the last returns the packed pieces. ``run`` writes every stage
as Parquet in the shared checkpoint folder and rereads it, so a lost executor repeats no stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import mixing, ngram_join, packing, substring, toxicity
from martlens.llm.common import materialize, n_words
from martlens.llm.queries import CATEGORIES, cyclic_weights, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words that a passage must repeat to be cut; shorter runs are common lines and phrases.
PASSAGE_WORDS = 25


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on ``labels``, does not reject."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.classify(docs.select(COLUMNS), chain, CATEGORIES).where(~F.col("rejected")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, of the smallest id; rows without id come after all
    others. Texts without words are in no group and stay."""
    # documents without id take part under numbers above all ids, different texts under one number apart
    stand_in = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    own = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("own_id"), F.xxhash64("text").alias("text_hash"))
    key = ["own_id", "text_hash"]
    texts = materialize(ngram_join.similar_groups(own, "own_id").where("group_id is not null")
                        .groupBy(*key).agg(F.min("group_id").alias("group_id"), F.count("*").alias("n")), "texts")
    chosen = texts.groupBy("group_id").agg(F.min(F.struct(*key)).alias("first"), F.count("*").alias("many"))
    first = chosen.where("many > 1").select("first.*")
    others = materialize(texts.join(chosen.where("many > 1").select("group_id"), "group_id", "left_semi").select(*key)
                         .join(first, key, "left_anti"), "others")
    repeated = materialize(texts.where("n > 1").select(*key).join(others, key, "left_anti"), "repeated")
    once = own.join(repeated, key, "left_semi").dropDuplicates(key)
    return own.join(others.unionByName(repeated), key, "left_anti").unionByName(once).select(COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages of at least PASSAGE_WORDS words that a smaller id holds are cut. The
    text of a document that loses nothing stays as it is; one that loses all words is empty."""
    cleaned = substring.deduplicate(docs, window=PASSAGE_WORDS)
    changed = materialize(cleaned.where("n_removed > 0").select("doc_id", "text_hash", "kept_text").dropDuplicates(["doc_id", "text_hash"]), "changed")
    own = docs.select(COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    joined = own.join(changed, ["doc_id", "text_hash"], "left")
    return joined.select("doc_id", F.coalesce("kept_text", "text").alias("text"), "lang", "source",
                         F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    mixed, _ = mixing.mix(docs.select(COLUMNS), n_words("text"), F.array("source"), cyclic_weights, ["doc_id", "text"])
    return (mixed.where("mix_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
            .select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    packed = packing.pack(docs, F.col("doc_id"), keep={"ids_crc32": F.crc32("ids")})
    return packed.select(F.col("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates), ("substring_dedup", cut_repeated_passages),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Trained classifiers, seeded hashes and BPE are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
