"""N-gram Jaccard join: MinHash bands, Bayesian pruning of candidates, exact verification."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import (WordHashes, batches_of, deal_pairs, list_arrays, local_components, materialize, ready, runs, utf8,
                                 words_of)
from martlens.llm.components import connected_components

NGRAM = 5
THRESHOLD = 0.8
#: A pair exactly at the threshold shares one of BANDS bands of ROWS values but for a chance of 4e-6.
BANDS, ROWS = 24, 4
VALUES = BANDS * ROWS
#: Signatures are compared so many values at a time; a pair goes when the posterior probability that
#: its similarity reaches the threshold falls below the tolerance.
STEP = 16
TOLERANCE = 1e-5
BLOCK_ROWS = 1024
#: Shingles that one block of the exact check may hold.
BLOCK_SHINGLES = 600_000
SEED = 1301
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def shingles(text: bytes | None, known: WordHashes, ngram: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; all words are one gram if there are fewer
    than ``ngram``. ``known`` caches word hashes."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = known.of(words)
    n = min(ngram, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            out = (out ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return np.unique(out)


@lru_cache(maxsize=1)
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, VALUES, dtype=np.uint64))


def signature(grams: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of 32 bits."""
    out = np.full(VALUES, np.iinfo(np.uint32).max, dtype=np.uint32)
    scale, shift = _mixers()
    with np.errstate(over="ignore"):
        for at in range(0, len(grams), 4096):
            part = grams[at:at + 4096]
            for k in range(VALUES):
                low = ((part * scale[k] + shift[k]) >> np.uint64(32)).min()
                out[k] = min(out[k], np.uint32(low))
    return out


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones to go on): below it, under a uniform prior, the posterior
    probability of a similarity of at least ``threshold`` is under ``tolerance``."""
    def posterior(equal: int, of: int) -> float:
        # 1 - I_t(equal + 1, of - equal + 1), a binomial tail
        return sum(math.comb(of + 1, j) * threshold ** j * (1 - threshold) ** (of + 1 - j) for j in range(equal + 1))
    return [(n, next(k for k in range(n + 1) if posterior(k, n) >= tolerance)) for n in range(STEP, VALUES + 1, STEP)]


def _signed(batches, ngram: int):
    known = WordHashes()
    for batch in batches:
        sets, signs = [], []
        for text in utf8(batch.column("text")):
            grams = shingles(text, known, ngram)
            sets.append(xxhash.xxh128_digest(grams.tobytes()) if len(grams) else None)
            signs.append(signature(grams).tobytes() if len(grams) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(sets, pa.binary()), pa.array(signs, pa.binary())],
            names=["doc_id", "text_hash", "gram_set", "signature"])


def _bands(batches):
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u4").reshape(-1, BANDS, ROWS)
        keys = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(signs), 1), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(ROWS):
                keys = (keys ^ signs[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(29)
        ids = batch.column("class_id").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, BANDS)), pa.array(keys.ravel().view(np.int64))],
                                         names=["class_id", "band"])


def _tied(ids: np.ndarray, a: list, b: list) -> dict | None:
    """The links that connect each group of a cell to its smallest id."""
    a, b = np.concatenate([*a, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*b, np.empty(0, np.int64)]).astype(np.int64)
    if not len(a):
        return None
    order = np.argsort(ids, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(ids))
    root = ids[order][local_components(len(ids), place[a], place[b])]
    tied = np.flatnonzero(root != ids[order])
    return {"a": ids[order][tied], "b": root[tied], "n": np.zeros(len(tied), dtype=np.int64)}


def _pruned(batches, threshold: float, tolerance: float):
    """Links among candidates that outlast the pruning; pairs already connected in the cell need none."""
    steps = least_matches(threshold, tolerance)
    for (_, i, j), rows in runs(batches, ["band", "block_i", "block_j"]):
        if rows.num_rows < 2:
            continue
        ids, side = rows.column("class_id").to_numpy(), rows.column("block").to_numpy()
        signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), dtype="<u4").reshape(-1, VALUES)
        group, a, b = np.arange(len(ids)), [], []
        right = np.flatnonzero(side == j)
        for x in np.flatnonzero(side == i):
            y = right[right > x] if i == j else right
            y = y[group[y] != group[x]]
            equal = np.zeros(len(y), dtype=np.int64)
            for n, least in steps:
                equal += (signs[y, n - STEP:n] == signs[x, n - STEP:n]).sum(axis=1)
                y, equal = y[equal >= least], equal[equal >= least]
                if not len(y):
                    break
            if len(y):
                a.append(np.full(len(y), x))
                b.append(y)
                joined = np.unique(group[np.append(y, x)])
                group[np.isin(group, joined)] = joined[0]
        if found := _tied(ids, a, b):
            yield found


def _verified(batches, threshold: float):
    """Exact similarities within a cell: each row's linked copies, and links that connect its groups."""
    for (_, i, j), rows in runs(batches, ["part", "block_i", "block_j"]):
        if rows.num_rows < 2:
            continue
        ids, first = np.unique(rows.column("class_id").to_numpy(), return_index=True)
        rows = rows.take(pa.array(first))  # repeated rows of one document
        side, copies = rows.column("block").to_numpy(), rows.column("copies").to_numpy()
        grams, ends = list_arrays(rows.column("grams"))
        sizes = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(ids)), sizes)
        # grams of one row alone are in no intersection
        _, place, times = np.unique(grams, return_inverse=True, return_counts=True)
        shared = times[place] > 1
        owner, place = owner[shared], place[shared]
        kept = np.cumsum(times > 1) - 1
        place = kept[place]
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        row_of, col_of = np.full(len(ids), -1), np.full(len(ids), -1)
        row_of[left], col_of[right] = np.arange(len(left)), np.arange(len(right))
        width = max(256, (1 << 22) // len(ids))
        total = int(place[-1]) + 1 if len(place) else 0
        for at in range(0, total, width):
            lo, hi = np.searchsorted(place, (at, at + width))
            m = np.zeros((len(ids), min(width, total - at)), dtype=np.float32)
            m[owner[lo:hi], place[lo:hi] - at] = 1
            both += m[left] @ m[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - both
        x, y = np.nonzero(both >= threshold * union - 1e-6)
        # exact in integers and doubles: intersections are whole numbers below 2^24
        meet, span = both[x, y].astype(np.int64), union[x, y].astype(np.int64)
        exact = (meet > 0) & (meet / np.maximum(span, 1) >= threshold)
        x, y = left[x[exact]], right[y[exact]]
        if i == j:
            x, y = x[x < y], y[x < y]
        links = np.zeros(len(ids), dtype=np.int64)
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        some = np.flatnonzero(links)
        if len(some):
            yield {"a": ids[some], "b": pa.nulls(len(some), pa.int64()), "n": links[some]}
            yield _tied(ids, [x], [y])


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ngram: int = NGRAM,
                   threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: id, class_id, n_links, component_id, kept, text_hash, group_id.

    Two documents are linked if their sets of word n-grams have Jaccard similarity of at least
    ``threshold``. Documents with equal sets are one class (class_id its smallest id), so copies
    cost one row. Classes that share a band of MinHash values are candidates; these are compared
    STEP values at a time and dropped when the posterior falls below ``tolerance``. Classes joined
    by what is left form parts, and within a part every pair is verified on the whole sets, in
    cells of bounded size. n_links counts the linked documents, copies included; component_id is
    the smallest id reached by links; kept is whether that is the document's own.

    The expected loss is the pairs that share no band (4e-6 at the threshold, less above it) and
    those pruned wrongly (up to ``tolerance`` a comparison), unless others connect their part.
    Texts that are null or without words link with nothing. A row without id is not kept, has no
    links and a null component. Repeated rows count as documents. No rows give no rows. Different
    texts under one id are documents of their own: text_hash (xxhash64) tells them apart, and
    group_id their components, which may share the smallest id; it is null without id or words.
    """
    spark = docs.sparkSession
    ready(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    signed = materialize(rows.mapInArrow(lambda b: _signed(b, ngram), "doc_id long, text_hash long, gram_set binary, signature binary"), "signed")
    usable = F.col("doc_id").isNotNull() & F.col("gram_set").isNotNull()
    classes = materialize(signed.where(usable).groupBy("gram_set")
                          .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("copies"),
                               F.min("signature").alias("signature"))
                          .select("gram_set", F.col("first.doc_id").alias("low_id"), F.col("first.text_hash").alias("text_hash"), "copies", "signature"), "named")
    # a class goes by its smallest id; classes that share one, as two texts under it, go by their sets
    clashes = materialize(classes.groupBy("low_id").count().where("count > 1").select("low_id", F.lit(True).alias("clash")), "clashes")
    clashing = not clashes.isEmpty()
    if clashing:
        classes = materialize(classes.join(clashes, "low_id", "left")
                              .withColumn("class_id", F.when(F.col("clash"), F.xxhash64("gram_set")).otherwise(F.col("low_id"))).drop("clash"), "classes")
    else:
        classes = classes.withColumn("class_id", F.col("low_id"))
    bands = materialize(classes.select("class_id", "signature").mapInArrow(_bands, "class_id long, band long"), "bands")
    member = F.xxhash64("class_id").cast("decimal(20,0)")
    buckets = (bands.groupBy("band").agg(F.count("*").alias("n"), F.min("class_id").alias("low"), F.sum(member).alias("members"))
               .where("n > 1"))
    # bands with the same members say the same: one of them is enough
    buckets = buckets.groupBy("n", "low", "members").agg(F.min("band").alias("band")).select("band")
    candidates = bands.join(buckets, "band").join(classes.select("class_id", "signature"), "class_id")
    cells = deal_pairs(candidates, ["band"], "class_id", BLOCK_ROWS)
    likely = materialize(cells.mapInArrow(
        lambda b: batches_of(_pruned(b, threshold, tolerance), _FOUND), "a long, b long, n long").select("a", "b"), "likely")
    parts = connected_components(likely).select(F.col("node").alias("class_id"), F.col("component").alias("part"))
    parted = parts.join(classes.select("gram_set", "class_id", F.col("low_id").alias("doc_id"), "text_hash", "copies"), "class_id")
    # both sides are dealt by id at any size: the parts grow with the documents
    sets = materialize(rows.join(materialize(parted, "parts").hint("merge"), ["doc_id", "text_hash"]).mapInArrow(
        lambda b: _sets(b, ngram), "class_id long, part long, copies long, weight long, grams array<long>"), "sets")
    cells = deal_pairs(sets, ["part"], "class_id", BLOCK_SHINGLES, F.col("weight"))
    found = materialize(cells.mapInArrow(
        lambda b: batches_of(_verified(b, threshold), _FOUND), "a long, b long, n long"), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("outer_links"))
    groups = connected_components(found.where("b is not null")).withColumnRenamed("node", "class_id")
    labelled = (classes.select("gram_set", "class_id", "low_id", "copies").join(links, "class_id", "left").join(groups, "class_id", "left")
                .withColumn("group_id", F.coalesce("component", "class_id")))
    if clashing:  # the smallest name in a component need not be its smallest id
        lows = labelled.where("component is not null").groupBy("group_id").agg(F.min("low_id").alias("low"))
        labelled = labelled.join(lows, "group_id", "left").withColumn("component", F.coalesce("low", "low_id"))
    own = signed.select("doc_id", "text_hash", F.when(usable, F.col("gram_set")).alias("gram_set")).join(labelled, "gram_set", "left")
    return (own.select(F.col("doc_id").cast(kind).alias(id_col), F.coalesce("low_id", "doc_id").alias("class_id"),
                       F.coalesce(F.col("copies") - 1 + F.coalesce("outer_links", F.lit(0)), F.lit(0)).alias("n_links"),
                       F.coalesce("component", "low_id", "doc_id").alias("component_id"), "text_hash", "group_id")
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))


def _sets(batches, ngram: int):
    """The gram sets of the documents that stand for their class, once a task."""
    known = WordHashes()
    seen: set[int] = set()
    for batch in batches:
        keep, sets = [], []
        for row, (own, wanted, text) in enumerate(zip(batch.column("class_id").to_pylist(), batch.column("gram_set").to_pylist(),
                                                      utf8(batch.column("text")))):
            if own in seen:
                continue
            grams = shingles(text, known, ngram)
            if xxhash.xxh128_digest(grams.tobytes()) == wanted:  # not another text of the same id and hash
                seen.add(own)
                keep.append(row)
                sets.append(grams.view(np.int64))
        ends = np.cumsum([0, *map(len, sets)])
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [kept.column("class_id"), kept.column("part"), kept.column("copies"),
             # a row weighs at least what keeps a block's table of pairs small
             pa.array(np.maximum(np.diff(ends), BLOCK_SHINGLES // BLOCK_ROWS)),
             pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))],
            names=["class_id", "part", "copies", "weight", "grams"])
