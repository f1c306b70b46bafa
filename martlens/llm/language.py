"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import columns, materialize, ready

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Bound of the training sample: expected documents per language, drawn by a hash of id and text.
TRAIN_DOCS_PER_LANG = 4000
#: Languages of one broadcast matrix, which has at most BUCKETS x GROUP_LANGS cells; more languages are learned and
#: scored in several groups, a pass over the documents each.
GROUP_LANGS = 256
#: Grams whose matrix rows are gathered at a time when a batch is scored.
GATHER = 1 << 13
SMOOTHING = 0.5
UNDETERMINED = "und"
_CHUNK = 1 << 19
_SPACE = 32
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def normalized(text: str | None) -> np.ndarray:
    """Code points in lower case, every run of other characters one blank, a blank at either end;
    empty if the text is null or has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype="<u4")
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.empty(0, dtype=np.uint64)
    codes = np.where(is_letter, codes, _SPACE)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    return np.concatenate(([_SPACE], codes[keep], [_SPACE] * bool(is_letter[-1]))).astype(np.uint64)


def gram_buckets(codes: np.ndarray, starts: int) -> np.ndarray:
    """Buckets of the n-grams of all orders that begin at the first ``starts`` places; a blank
    alone is no gram."""
    found = []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = min(starts, len(codes) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint64)
            for k in range(n):
                h = (h * np.uint64(0x100000001B3)) ^ codes[k:m + k]
            h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            found.append(h[codes[:m] != _SPACE] if n == 1 else h)
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, dtype=np.int64)


def _pieces(codes: np.ndarray):
    """The buckets of a text, slice by slice; each gram is in the slice where it begins."""
    for at in range(0, len(codes), _CHUNK):
        yield gram_buckets(codes[at:at + _CHUNK + max(ORDERS) - 1], _CHUNK)


def _count(batches):
    """(lang, bucket, n) of a task's rows, which come sorted by language: one language is held at a time."""
    lang, held = None, np.zeros(BUCKETS, dtype=np.int64)

    def flush():
        at = np.flatnonzero(held)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(held[at])],
                                          names=["lang", "bucket", "n"])

    for batch in batches:
        for own, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if own != lang:
                if lang is not None:
                    yield flush()
                lang = own
                held[:] = 0
            for grams in _pieces(normalized(text)):
                held += np.bincount(grams, minlength=BUCKETS)
    if lang is not None:
        yield flush()


class Model:
    """Log-probability matrices [bucket, language], one a group of languages, and their log priors; in a list."""

    def __init__(self, langs: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.langs, self.matrix, self.prior = langs, matrix, prior


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
          docs_per_lang: int = TRAIN_DOCS_PER_LANG, group: int = GROUP_LANGS) -> list[Model]:
    """The models of all languages, ``group`` languages in each, those with most documents first.

    Documents without a language or text are left out. The sample is bounded by
    ``docs_per_lang`` expected documents per language, chosen by a hash of id and text; repeated rows of an id
    and text count once. The n-gram counts of the sample are summed in Spark and reach the driver as one array a
    language, a group at a time.
    """
    spark = docs.sparkSession
    ready(spark)
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = labelled.groupBy(F.col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").collect()  # a row a language
    if not sizes:
        return []
    shares = spark.createDataFrame([(r["lang"], min(1.0, docs_per_lang / r["count"])) for r in sizes],
                                   "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit(11), F.col(id_col), F.col(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # a language's sample is dealt to a few tasks, and each task counts one language after another
    sample = (labelled.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
              .join(F.broadcast(shares), "lang").where("draw < share").dropDuplicates(["id", "lang", "text"]).select("lang", "text")
              .repartition("lang", F.pmod(F.xxhash64("text"), F.lit(8))).sortWithinPartitions("lang"))
    counted = materialize(sample.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
                          .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("grams")), "grams")
    total = sum(r["count"] for r in sizes)
    models = []
    for at in range(0, len(sizes), group):
        own = sizes[at:at + group]
        langs = [r["lang"] for r in own]
        place = {v: k for k, v in enumerate(langs)}
        matrix = np.full((BUCKETS, len(langs)), SMOOTHING)
        names = spark.createDataFrame([(v,) for v in langs], "lang string")
        got = counted.join(F.broadcast(names), "lang").select("lang", F.col("grams.bucket").alias("bucket"), F.col("grams.n").alias("n")).toArrow()
        for v, bucket, n in zip(got.column("lang").to_pylist(), got.column("bucket"), got.column("n")):
            matrix[bucket.values.to_numpy(), place[v]] += n.values.to_numpy()
        models.append(Model(langs, np.log(matrix / matrix.sum(axis=0)).astype(np.float32), np.log(np.array([r["count"] for r in own]) / total)))
    return models


def batch_scores(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(log posterior up to a constant [text, language], whether a text has a letter): the batch's sparse counts
    (text, bucket, n) times the matrix, GATHER entries at a time."""
    out = np.zeros((len(texts), len(model.langs)))
    lettered = np.zeros(len(texts), dtype=bool)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def add():
        rows, buckets, counts = (np.concatenate(x) for x in zip(*held))
        for at in range(0, len(rows), GATHER):
            part = slice(at, at + GATHER)
            heads = np.flatnonzero(np.append(True, rows[part][1:] != rows[part][:-1]))
            out[rows[part][heads]] += np.add.reduceat(counts[part, None] * model.matrix[buckets[part]], heads, axis=0)
        held.clear()

    for k, text in enumerate(texts):
        codes = normalized(text)
        lettered[k] = len(codes) > 0
        for grams in _pieces(codes):
            buckets, counts = np.unique(grams, return_counts=True)
            held.append((np.full(len(buckets), k), buckets, counts.astype(np.float64)))
            size += len(buckets)
        if size >= GATHER:
            add()
            size = 0
    if held:
        add()
    return out + model.prior, lettered


def predict(docs: DataFrame, models: list[Model], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (posterior probability of that language).

    The whole text is scored, in slices, so memory does not grow with its length. The models, groups of
    languages, are applied one after another, each carrying the best language so far and the sum of all posteriors.
    A null text, a text without letters or an empty model gives ``und`` with score 0; ties go to the language
    with more training documents. Columns of ``docs`` are kept, those named lang_pred or score are
    replaced.
    """
    ready(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    own = columns(docs)
    scored = docs.withColumn("llm_scored", F.lit(None).cast("struct<lang:string,best:double,total:double>"))
    for k, model in enumerate(models):
        if k:
            scored = materialize(scored, "scored")  # one matrix in memory at a time
        scored = _with_group(scored, text, model)
    lang, best, total = (F.col(f"llm_scored.{x}") for x in ("lang", "best", "total"))
    return scored.select(*own, F.coalesce(lang, F.lit(UNDETERMINED)).alias("lang_pred"),
                         F.when(lang.isNotNull(), F.least(F.exp(best - total), F.lit(1.0))).otherwise(F.lit(0.0)).alias("score"))


def _with_group(scored: DataFrame, text: str, model: Model) -> DataFrame:
    """llm_scored brought up to date with one group: best language, its log posterior, log of the sum of all."""
    shared = scored.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,best:double,total:double>")
    def best_of(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        found, lettered = batch_scores(texts.tolist(), model)
        at = found.argmax(axis=1)
        best = found.max(axis=1)
        total = best + np.log(np.exp(found - best[:, None]).sum(axis=1))
        old, old_total = (before[c].to_numpy(dtype=np.float64, na_value=-np.inf) for c in ("best", "total"))
        lang = np.where(old >= best, before["lang"].to_numpy(dtype=object), np.array(model.langs, dtype=object)[at])
        return pd.DataFrame({"lang": np.where(lettered, lang, None), "best": np.where(lettered, np.maximum(old, best), np.nan),
                             "total": np.where(lettered, np.logaddexp(old_total, total), np.nan)})

    return scored.withColumn("llm_scored", best_of(F.col(text), F.col("llm_scored")))


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))
