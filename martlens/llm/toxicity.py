"""Toxicity: a classifier chain of linear models over hashed words and word beginnings."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlens.llm.common import columns, list_arrays, materialize, ready

BUCKETS = 1 << 18
#: A word counts as itself and as its beginnings of so many characters, which its inflections share.
STEMS = (4, 5, 6, 7)
#: Bounds of the training sample, drawn from the labelled rows by a hash of the id: rows (one a different text of
#: an id), and features of all rows together, which the driver holds (8 bytes each).
TRAIN_ROWS = 12_000
TRAIN_FEATURES = 1 << 25
FOLDS = 5
EPOCHS = 8
RATE, DECAY = 1.0, 1e-6
#: Clean rows outnumber toxic ones ten to one and score far lower; at this cut about one clean row in ten thousand is rejected.
THRESHOLD = 0.1
_CACHE_WORDS = 200_000
_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    """Distinct words of a whole text in lower case."""
    return set(_WORD.findall(text.lower())) if text else set()


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings that are shorter than the word."""
    parts = (f"={word}", *(word[:n] for n in STEMS if n < len(word)))
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class LinearModel:
    """Logistic regression on feature counts and the probabilities of earlier categories."""

    def __init__(self, earlier: int):
        self.weights = np.zeros(BUCKETS, dtype=np.float32)
        self.chain = np.zeros(earlier)
        self.bias = 0.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], earlier: np.ndarray, labels: np.ndarray, seed: int) -> "LinearModel":
        """AdaGrad over the rows in seeded order."""
        rng, squares = np.random.default_rng(seed), np.full(BUCKETS, 3.0, dtype=np.float32)
        dense = np.full(1 + earlier.shape[1], 1e-2)
        for _ in range(EPOCHS):
            for k in rng.permutation(len(rows)):
                at, n = rows[k]
                z = float(self.weights[at] @ n) + self.bias + float(self.chain @ earlier[k])
                error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[k]
                if abs(error) < 1e-3:
                    continue
                slope = error * n / np.sqrt(n.sum() + 1) + DECAY * self.weights[at]
                squares[at] += slope ** 2
                self.weights[at] -= RATE * slope / np.sqrt(squares[at])
                slope = error * np.concatenate(([1.0], earlier[k]))
                dense += slope ** 2
                step = RATE * slope / np.sqrt(dense)
                self.bias -= step[0]
                self.chain -= step[1:]
        return self

    def predict(self, rows: list[tuple[np.ndarray, np.ndarray]], earlier: np.ndarray) -> np.ndarray:
        z = np.array([float(self.weights[at] @ n) for at, n in rows]) + self.bias + earlier @ self.chain
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, folds: np.ndarray) -> list[LinearModel]:
    """One model a category, in order. A later model trains on the earlier categories' out-of-fold
    probabilities, so it sees them as uncertain as they will be on new rows."""
    chain: list[LinearModel] = []
    earlier = np.zeros((len(rows), 0))
    for c in range(labels.shape[1]):
        chain.append(LinearModel(c).fit(rows, earlier, labels[:, c], 100 + c))
        if c + 1 < labels.shape[1]:
            out = np.zeros(len(rows))
            for f in range(FOLDS):
                inside, outside = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
                if len(inside) and len(outside):
                    model = LinearModel(c).fit([rows[k] for k in inside], earlier[inside], labels[inside, c], 100 + c)
                    out[outside] = model.predict([rows[k] for k in outside], earlier[outside])
            earlier = np.column_stack((earlier, out))
    return chain


def _features(batches):
    """The distinct features of each text and how many of its words have them."""
    for batch in batches:
        names = [c for c in batch.schema.names if c != "text"]
        found, counts = [], []
        for text in batch.column("text").to_pylist():
            own = sorted(words(text), key=lambda w: zlib.crc32(w.encode("utf-8", "surrogatepass")))
            at, n = np.unique(np.array([f for w in own for f in word_features(w)], dtype=np.int32), return_counts=True)
            found.append(at)
            counts.append(n.astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
            names=[*names, "features", "counts"])


def train(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text: str = "text",
          max_rows: int = TRAIN_ROWS, max_features: int = TRAIN_FEATURES) -> list[LinearModel]:
    """The chain for the 0/1 columns ``categories`` of ``labels``, in that order.

    At most ``max_rows`` different texts of labelled ids are used, those of the ids with the smallest hash, and all
    distinct words of each; of these rows, in the order of the hash, as many as have ``max_features`` features together.
    Repeated rows count once. Rows with a null id, label or text, and of several labels of one id all but the largest, are left out.
    Folds follow the text, so copies of a document share one. Without rows the chain is empty.
    """
    spark = docs.sparkSession
    ready(spark)
    known = labels.where(F.col(id_col).isNotNull())
    for c in categories:
        known = known.where(F.col(c).isNotNull())
    drawn = (known.groupBy(F.col(id_col).alias("id")).agg(*[F.max(F.col(c).cast("int")).alias(f"label_{k}") for k, c in enumerate(categories)])
             .join(docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
             .orderBy(F.xxhash64(F.lit(29), "id"), "id").limit(max_rows))
    names = [f"label_{k}" for k in range(len(categories))]
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id").where("text is not null")
              .withColumn("key", F.sha2(F.col("text").cast("binary"), 256)).dropDuplicates(["id", "key"])
              .select("id", "key", *names, F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(FOLDS)).cast("int").alias("fold"), "text"))
    kind = drawn.schema["id"].dataType.simpleString()
    counted = materialize(sample.mapInArrow(_features, f"id {kind}, key string{''.join(f', {n} int' for n in names)}, fold int, features array<int>, counts array<float>"), "sample")
    # the ids are bounded, their rows are not: both bounds hold for the rows, chosen by their keys alone
    order = [F.xxhash64(F.lit(29), "id"), F.col("id"), F.col("key")]
    kept = counted.select("id", "key", F.size("features").alias("n")).orderBy(*order).limit(max_rows)
    kept = kept.withColumn("upto", F.sum("n").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))).where(F.col("upto") <= max_features)
    got = counted.join(F.broadcast(kept.select("id", "key")), ["id", "key"]).orderBy("id", "key").toArrow()
    if not got.num_rows:
        return []
    (at, ends), (n, _) = (list_arrays(got.column(c)) for c in ("features", "counts"))
    rows = list(zip(np.split(at, ends[:-1]), np.split(n, ends[:-1])))
    y = np.column_stack([got.column(n).to_numpy() for n in names]).astype(np.float64)
    return fit_chain(rows, y, got.column("fold").to_numpy())


class _WordScores(dict):
    """Each word's weight in every model of a chain, looked up once."""

    def __init__(self, chain: list[LinearModel]):
        super().__init__()
        self.chain = chain
        self.weights = np.stack([m.weights for m in chain]) if chain else None
        self.table = np.zeros((_CACHE_WORDS + 1, len(chain)))

    def __missing__(self, word: str) -> int:
        k = len(self) % len(self.table)
        self.table[k] = self.weights[:, word_features(word)].sum(axis=1, dtype=np.float64)
        self[word] = k
        return k

    def probabilities(self, own: set[str]) -> list[float]:
        """Of the categories in order; all 0 for a document without words."""
        if not own:
            return [0.0] * len(self.chain)
        total, parts = np.zeros(len(self.chain)), list(own)
        for at in range(0, len(parts), _CACHE_WORDS):
            some = parts[at:at + _CACHE_WORDS]
            if len(self) + len(some) > _CACHE_WORDS:
                self.clear()
            total += self.table[np.fromiter(map(self.__getitem__, some), dtype=np.int64, count=len(some))].sum(axis=0)
        p: list[float] = []
        for z, model in zip(total, self.chain):
            z += model.bias + float(model.chain @ np.array(p))
            p.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return p


def classify(docs: DataFrame, chain: list[LinearModel], categories: list[str], text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with p_<category> for each category and ``rejected``, whether the last one reaches
    ``threshold``. Categories are predicted in order, each fed the probabilities before it, from
    all distinct words of the whole text. Null and empty texts, and an empty chain, give
    probability 0 and are not rejected. Columns of ``docs`` are kept."""
    spark = docs.sparkSession
    ready(spark)
    names = [f"p_{c}" for c in categories]
    docs = docs.drop("rejected", *names)
    shared = spark.sparkContext.broadcast(chain)

    @F.pandas_udf("array<double>")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chain = shared.value
        known = _WordScores(chain)  # kept from batch to batch
        for texts in batches:
            yield pd.Series([known.probabilities(words(t)) if chain else [0.0] * len(names) for t in texts], dtype=object)

    scored = docs.select(*columns(docs), scores(F.col(text)).alias("llm_scores"))
    return scored.select(*columns(docs), *[F.col("llm_scores")[k].alias(n) for k, n in enumerate(names)],
                         (F.col("llm_scores")[len(names) - 1] >= threshold).alias("rejected"))
