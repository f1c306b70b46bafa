"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.session import work_dir

#: Words are the runs between these characters, in every operator that counts words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ready(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches small enough that a batch of long texts fits a Python worker, and the
    package sent to the executors once an application, as --py-files would."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp()), "martlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def columns(df: DataFrame) -> list[Column]:
    """All columns, also those whose names hold dots or other special characters."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: the lineage
    ends there, so a lost executor costs a re-read and not the work before it."""
    path = work_dir(df.sparkSession, f"llm-{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column | str) -> Column:
    """Number of words, 0 for a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; bytes.split() cuts at exactly the six ASCII blanks."""
    return text.split() if text else []


#: Lower case for A-Z; digits, letters and all bytes of longer characters as they are; a blank for the rest.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The runs of ASCII letters and digits and all other characters beyond ASCII, A-Z in lower case."""
    return text.translate(_TERM_BYTES).split() if text else []


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words, each hashed once; forgets all when it holds ``most`` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most, self.table = most, np.empty(1024, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        k = len(self)
        if k == len(self.table):
            self.table = np.concatenate((self.table, np.empty(k, dtype=np.uint64)))
        self.table[k] = xxhash.xxh64_intdigest(word)
        self[word] = k
        return k

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return self.table[at]  # read after the lookups, which may replace the table


def list_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column without null elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()).cumsum()


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) for each run of equal integer keys in a sorted partition; one run at a time
    is held in memory."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n - 1, dtype=bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for i, j in zip(cuts, cuts[1:]):
            key = tuple(int(c[i]) for c in cols)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
            held_key = key
    if held:
        yield held_key, pa.Table.from_batches(held)


def batches_of(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches from dictionaries of arrays, flushed every ``size`` rows."""
    held: list[pa.RecordBatch] = []
    n = 0
    for row in rows:
        batch = pa.RecordBatch.from_arrays([pa.array(row[f.name], type=f.type) for f in schema], schema=schema)
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def deal_pairs(rows: DataFrame, keys: list[str], row_id: str, limit: int,
               weight: Column | None = None) -> DataFrame:
    """Deal the rows of every key to cells in which each pair of rows of a key meets once.

    A key whose rows weigh up to ``limit`` is one cell. A heavier key is cut by the hash of
    ``row_id`` into blocks of about that weight, and each pair of blocks is a cell of its own,
    so no task holds more than two blocks whatever the size of the key. Adds block_i, block_j
    (the cell) and block (the row's own); the result is partitioned and sorted by the cell.
    """
    sized = rows.groupBy(*keys).agg(F.sum(weight if weight is not None else F.lit(1)).alias("cell_weight"))
    heavy = materialize(sized.where(F.col("cell_weight") > limit)
                        .withColumn("blocks", F.ceil(F.col("cell_weight") / limit).cast("int"))
                        .drop("cell_weight"), "heavy")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64(F.lit(7), row_id), blocks).cast("int")
    dealt = (rows.join(heavy, keys, "left")
             .withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("block_i", F.least("block", "other")).withColumn("block_j", F.greatest("block", "other"))
             .drop("blocks", "other"))
    cell = [*keys, "block_i", "block_j"]
    return dealt.repartition(*cell).sortWithinPartitions(*cell)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes over the links a[k] - b[k]."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label
        apart = label[a] != label[b]
        if not apart.any():
            while (label != label[label]).any():
                label = label[label]
            return label
    return label
