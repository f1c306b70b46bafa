"""Substring dedup: FM-indexes over anchored passages give each window its first document."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import WordHashes, list_arrays, materialize, ready, runs, utf8, words_of
from martlens.llm.fm_index import FMIndex

WINDOW = 13
#: Words of one FM-index, but for a single anchor with more.
SHARD_WORDS = 250_000
#: An anchor with more different passages than this is split into its windows.
ANCHOR_PASSAGES = 20_000
#: Anchors that a task gathers before it sends them on.
GATHER = 1_500_000
#: Places of one packed row of anchors that a task knows to be shared.
PACKED = 1 << 15
_PASSAGE = ["doc_id", "text_key", "place", "anchor", "passage"]
_PASSAGE_SCHEMA = "doc_id long, text_key long, place long, anchor long, passage binary"


def anchor_gram(window: int) -> int:
    """Words of an anchor: short enough that a window has many to choose from, long enough to be rare."""
    return max(1, window // 2 + 1)


def window_anchors(words: list[bytes], window: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(anchor place of each window, hash of the gram at each place). The anchor of a window is its
    first gram with the least hash, so equal windows have equal anchors."""
    n, gram = len(words), anchor_gram(window)
    if n < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    h = known.of(words)
    with np.errstate(over="ignore"):
        grams = np.full(n - gram + 1, gram, dtype=np.uint64)
        for k in range(gram):
            grams = (grams ^ h[k:n - gram + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
    return first_least(grams, window - gram + 1), grams


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value in every run of ``width`` values, by runs of doubled width."""
    at, held = np.arange(len(values)), 1
    while held < width:
        step = min(held, width - held)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        held += step
    return at


def _text_key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _text_check(text: bytes) -> int:
    """64 bits more of a text: key and check together tell copies."""
    return xxhash.xxh64_intdigest(text, seed=0x5EED) - (1 << 63)


def _rows(batches, window: int):
    """Per document: hash, key and check of its text, words, digest of its words."""
    for batch in batches:
        keys, checks, n, digests = [], [], [], []
        for text in utf8(batch.column("text")):
            words = words_of(text)
            keys.append(_text_key(text) if len(words) >= window else None)
            checks.append(_text_check(text) if len(words) >= window else None)
            n.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), pa.array(n, pa.int64()), pa.array(digests)],
            names=["doc_id", "text_hash", "text_key", "text_check", "n_words", "sha256"])


_GATHERED = pa.schema([("bucket", pa.int32()), ("anchor", pa.list_(pa.int64())), ("text_key", pa.list_(pa.int64())),
                       ("place", pa.list_(pa.int32())), ("shared", pa.list_(pa.bool_()))])


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


def _shared_groups(anchor: np.ndarray, text: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by anchor, heads of its groups, and for each group whether two texts hold it."""
    order = np.argsort(anchor, kind="stable")
    heads = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
    texts = text[order]
    shared = (np.minimum.reduceat(texts, heads) != np.maximum.reduceat(texts, heads)) | np.logical_or.reduceat(told[order], heads)
    return order, heads, shared


def _gathered(batches, window: int, buckets: int):
    """The anchors of a task's texts, packed by bucket. An anchor that two texts of the task share is
    known to be shared: its places go to bucket -1 and one of them to the others, for their sake, so
    an anchor sends a task's places once whatever number of texts holds it. Copies of a text are
    gathered once a task."""
    known = WordHashes()
    gathered: set[bytes] = set()
    held: list[tuple[np.ndarray, int, np.ndarray]] = []
    n = 0

    def flush():
        anchor = np.concatenate([a for a, _, _ in held])
        text = np.concatenate([np.full(len(a), t, dtype=np.int64) for a, t, _ in held])
        place = np.concatenate([p for _, _, p in held]).astype(np.int32)
        order, heads, shared = _shared_groups(anchor, text, np.zeros(len(anchor), dtype=bool))
        known_here = np.zeros(len(anchor), dtype=bool)
        known_here[order] = np.repeat(shared, np.diff(np.append(heads, len(order))))
        head = np.zeros(len(anchor), dtype=bool)
        head[order[heads]] = True
        if known_here.any():
            at = np.flatnonzero(known_here)
            at = at[np.lexsort((place[at], text[at]))]
            for i in range(0, len(at), PACKED):  # dealt on, a part here and a part there
                own = at[i:i + PACKED]
                yield -1, anchor[own], text[own], place[own], np.ones(len(own), dtype=bool)
        send = np.flatnonzero(~known_here | head)
        bucket = ((anchor[send] >> 20) % buckets).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        send, bucket = send[by], bucket[by]
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        for i, j in zip(cuts[:-1], cuts[1:]):
            at = send[i:j]
            yield int(bucket[i]), anchor[at], text[at], place[at], known_here[at]

    def batch_of(parts):
        parts = list(parts)
        cuts = np.cumsum([0, *(len(p[1]) for p in parts)])
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in parts], pa.int32()), *(_lists(np.concatenate([p[k] for p in parts]), cuts) for k in (1, 2, 3, 4))],
            schema=_GATHERED)

    for batch in batches:
        for text in utf8(batch.column("text")):
            if not text or (digest := xxhash.xxh3_128_digest(text)) in gathered:
                continue
            gathered.add(digest)
            at, grams = window_anchors(words_of(text), window, known)
            if not len(at):
                continue
            places = at[np.append(True, at[1:] != at[:-1])]
            held.append((grams[places].view(np.int64), _text_key(text), places))
            n += len(places)
            if n >= GATHER:
                yield batch_of(flush())
                held, n = [], 0
    if held:
        yield batch_of(flush())


def _met(batches):
    """Of each bucket, the places whose anchor lies in two texts, as (text_key, places)."""
    for (bucket,), rows in runs(batches, ["bucket"]):
        anchor, text, place, told = (list_arrays(rows.column(c))[0] for c in ("anchor", "text_key", "place", "shared"))
        if bucket >= 0:
            order, heads, shared = _shared_groups(anchor, text, told)
            use = np.zeros(len(anchor), dtype=bool)
            use[order] = np.repeat(shared, np.diff(np.append(heads, len(order))))
            text, place = text[use], place[use]
        if not len(text):
            continue
        by = np.lexsort((place, text))
        text, place = text[by], place[by]
        new = np.append(True, (text[1:] != text[:-1]) | (place[1:] != place[:-1]))
        text, place = text[new], place[new]
        cuts = np.append(np.flatnonzero(np.append(True, text[1:] != text[:-1])), len(text))
        yield pa.RecordBatch.from_arrays([pa.array(text[cuts[:-1]]), _lists(place, cuts)], names=["text_key", "places"])


def _united(batches):
    """Sorted by text: its places, each once. What is held of a text stays below its words and one more list,
    whatever number of tasks has met copies of it."""
    key, held, n = None, [], 0
    out: tuple[list, list] = ([], [])

    def settle():
        return np.unique(np.concatenate(held))

    def packed():
        cuts = np.cumsum([0, *map(len, out[1])])
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), _lists(np.concatenate(out[1]), cuts)], names=["text_key", "places"])

    size = 0
    for batch in batches:
        flat, ends = list_arrays(batch.column("places"))
        starts = np.append(0, ends)[:-1]
        for own, i, j in zip(batch.column("text_key").to_pylist(), starts.tolist(), ends.tolist()):
            if own != key:
                if key is not None:
                    out[0].append(key)
                    out[1].append(settle())
                    size += len(out[1][-1])
                    if size > PACKED:
                        yield packed()
                        out, size = ([], []), 0
                key, held, n = own, [], 0
            held.append(flat[i:j])
            n += j - i
            if len(held) > 64 and n > 2 * len(held[0]):
                held = [settle()]
                n = len(held[0])
    if key is not None:
        out[0].append(key)
        out[1].append(settle())
        yield packed()


def _passages(batches, window: int):
    """The windows of each shared anchor as one passage of words, for one document a text."""
    known = WordHashes()
    for batch in batches:
        out = ([], [], [], [], [])
        for doc, key, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(),
                                          utf8(batch.column("text")), batch.column("places")):
            words = words_of(text)
            at, grams = window_anchors(words, window, known)
            wanted = np.zeros(len(grams), dtype=bool)
            own = places.values.to_numpy()
            wanted[own[own < len(grams)]] = True
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            tails = np.append(heads[1:], len(at)) + window - 1
            use = wanted[at[heads]]
            heads, tails = heads[use], tails[use]
            joined, begins = b" ".join(words), np.cumsum([0, *(len(w) + 1 for w in words)])
            for column, v in zip(out, (np.full(len(heads), doc), np.full(len(heads), key), heads, grams[at[heads]].view(np.int64))):
                column.append(v)
            out[4].extend([joined[i:j] for i, j in zip(begins[heads].tolist(), (begins[tails] - 1).tolist())])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(np.concatenate([*c, np.empty(0, np.int64)])) for c in out[:4]), pa.array(out[4], pa.binary())], names=_PASSAGE)


def _windows(batches, window: int):
    """Passages as single windows, each an anchor of its own."""
    for batch in batches:
        out = ([], [], [], [], [])
        for doc, key, place, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "place", "passage"))):
            words = text.split()
            for k in range(len(words) - window + 1):
                part = b" ".join(words[k:k + window])
                for column, v in zip(out, (doc, key, place + k, _text_key(part), part)):
                    column.append(v)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], names=_PASSAGE)


class _Numbers(dict):
    """Numbers from 1 in order of first use."""

    def __missing__(self, word: bytes) -> int:
        return self.setdefault(word, len(self) + 1)


def _numbered(passages: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all passages as numbers from 1, each passage closed by a 0, and its words. The
    words of one chunk are held at a time, and each different word once."""
    number = _Numbers()
    ids, sizes = [], []
    for chunk in passages.chunks:
        for text in chunk.to_pylist():
            words = text.split()
            own = np.zeros(len(words) + 1, dtype=np.int32)
            own[:-1] = [number[w] for w in words]
            ids.append(own)
            sizes.append(len(words))
    return np.concatenate(ids), np.array(sizes, dtype=np.int64)


def _searched(batches, window: int):
    """FM-indexes over the passages of a partition, whole anchors at a time; every passage is
    streamed through its shard's index for the first document of each of its windows."""
    held: list[pa.RecordBatch] = []
    n, last = 0, None

    def search():
        rows = pa.Table.from_batches(held)
        ids, sizes = _numbered(rows.column("passage"))
        end = np.cumsum(sizes + 1) - 1
        begin = end - sizes
        owner = np.repeat(rows.column("first_doc").to_numpy(), sizes + 1)
        found, cuts = FMIndex(ids, owner, window).matches(ids, begin, end)
        return pa.RecordBatch.from_arrays(
            [rows.column("anchor").combine_chunks(), rows.column("passage_key").combine_chunks(), _lists(found, cuts)],
            names=["anchor", "passage_key", "firsts"])

    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        size = np.cumsum(batch.column("size").to_numpy())
        new = np.flatnonzero(anchor != np.append(anchor[0] if last is None else last, anchor[:-1]))
        at, before = 0, 0.0
        for i in new.tolist():  # an index ends before a new anchor
            upto = size[i - 1] if i else 0.0
            if n + upto - before > SHARD_WORDS and (held or i > at):
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield search()
                held, n, at, before = [], 0, i, upto
        held.append(batch.slice(at))
        n, last = n + size[-1] - before, anchor[-1]
    if held:
        yield search()


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, texts, starts).

    documents: doc_id, text_hash, text_key (null under ``window`` words), n_words, sha256 of the words,
    first_doc (the smallest id with the same text). texts: doc_id and text of the documents that may
    share a window with another text. starts: doc_id and places of the windows that also start in a
    document with a smaller id, for the first document of each text; the others repeat it whole.

    Every window has an anchor, its word gram with the least hash. Anchors go packed to buckets, and
    those found in one text only are settled. Passages (the windows of an anchor) that more texts
    share are collapsed by content and dealt to shards by anchor; the FM-index of a shard answers,
    for every window of the passages streamed through it, the smallest document it occurs in.
    """
    spark = docs.sparkSession
    ready(spark, 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # a row without id is neither earlier nor later than another
    listed = materialize(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lambda b: _rows(b, window), "doc_id long, text_hash long, text_key long, text_check long, n_words long, sha256 string"), "rows")
    firsts = (listed.where("text_key is not null and doc_id is not null").groupBy("text_key", "text_check")
              .agg(F.min("doc_id").alias("first_doc")))
    documents = listed.join(firsts, ["text_key", "text_check"], "left")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.where("doc_id is not null").select("text").mapInArrow(
        lambda b: _gathered(b, window, buckets), "bucket int, anchor array<long>, text_key array<long>, place array<int>, shared array<boolean>")
    # what a task knows to be shared needs no meeting: it stays where it is dealt at random
    spread = F.when(F.col("bucket") < 0, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col("bucket").cast("long"))
    met = (sent.withColumn("dealt", spread).repartition("dealt").sortWithinPartitions("bucket")
           .mapInArrow(_met, "text_key long, places array<int>"))
    # a place of a text is listed once, whatever number of tasks has met copies of the text: no list outgrows its text
    places = met.repartition("text_key").sortWithinPartitions("text_key").mapInArrow(_united, "text_key long, places array<int>")
    wanted = materialize(places.join(firsts, "text_key").select(F.col("first_doc").alias("doc_id"), "text_key", "places"), "places")
    texts = materialize(rows.join(wanted, "doc_id").mapInArrow(_own_text, "doc_id long, text_key long, text string, places array<int>"), "texts")
    passages = materialize(texts.mapInArrow(lambda b: _passages(b, window), _PASSAGE_SCHEMA), "passages")
    crowded = materialize(passages.groupBy("anchor").agg(F.approx_count_distinct("passage").alias("n"))
                          .where(F.col("n") > ANCHOR_PASSAGES).select("anchor"), "crowded")
    split = passages
    if not crowded.isEmpty():
        windows = materialize(passages.join(crowded, "anchor", "left_semi").mapInArrow(lambda b: _windows(b, window), _PASSAGE_SCHEMA), "windows")
        split = windows.unionByName(passages.join(crowded, "anchor", "left_anti"))
    split = split.withColumn("passage_key", F.md5("passage"))
    content = (split.groupBy("anchor", "passage_key").agg(F.min("doc_id").alias("first_doc"), F.min("passage").alias("passage"))
               .withColumn("size", F.length("passage") / 4))
    found = (content.repartition("anchor").sortWithinPartitions("anchor")
             .mapInArrow(lambda b: _searched(b, window), "anchor long, passage_key string, firsts array<long>"))
    found = materialize(found, "firsts")
    repeats = F.filter(F.transform("firsts", lambda first, k: F.when(first < F.col("doc_id"), F.col("place") + k)), lambda p: p.isNotNull())
    starts = (split.drop("passage").join(found, ["anchor", "passage_key"])
              .select("doc_id", "text_key", repeats.alias("starts")).where(F.size("starts") > 0)
              .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("starts")).alias("starts")))
    return documents, texts.select("doc_id", "text_key", "text"), starts


def _own_text(batches):
    """The wanted text of each document, once a task: not another text under the same id."""
    seen: set[tuple] = set()
    for batch in batches:
        keep = []
        for row, (doc, key, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), utf8(batch.column("text")))):
            if (doc, key) not in seen and _text_key(text or b"") == key:
                seen.add((doc, key))
                keep.append(row)
        kept = batch.take(pa.array(keep, pa.int64()))
        yield kept.select(["doc_id", "text_key", "text", "places"])


def removed_words(n: int, starts: list[int], window: int) -> np.ndarray:
    """Which of n words a window from one of the starts covers."""
    edges = np.zeros(n + 1, dtype=np.int64)
    at = np.unique(np.array(starts, dtype=np.int64))
    edges[at] += 1
    edges[at + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def _cleaned(batches, window: int):
    for batch in batches:
        out = ([], [], [])
        for text, starts in zip(utf8(batch.column("text")), batch.column("starts").to_pylist()):
            words = words_of(text)
            gone = removed_words(len(words), starts, window)
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
            for column, v in zip(out, (int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest())):
                column.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
            names=["doc_id", "text_key", "n_removed", "kept_text", "kept_sha256"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text, kept_sha256, text_hash.

    Words covered by a window of ``window`` words that also starts in a document with a smaller id
    are removed; windows are judged on the input. kept_text joins the kept words by blanks and is
    null where nothing was removed (the text stays as it is). A document whose whole text a smaller
    id holds loses all words, if it has a window at all. Null and empty texts have no words. A row
    without id keeps its words and counts as no earlier document. Repeated rows of one id and text
    are equal; two texts under one id are cleaned each by its own windows, and text_hash (xxhash64
    of the text) tells them apart. No rows give no rows.
    """
    documents, texts, starts = repeated_windows(docs, id_col, text, window)
    cleaned = texts.join(starts, ["doc_id", "text_key"]).mapInArrow(
        lambda b: _cleaned(b, window), "doc_id long, text_key long, n_removed long, kept_text string, kept_sha256 string")
    kind = docs.schema[id_col].dataType.simpleString()
    copy = F.col("first_doc") < F.col("doc_id")
    return (documents.join(cleaned, ["doc_id", "text_key"], "left")
            .select(F.col("doc_id").cast(kind).alias(id_col), "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
                    F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
                    "text_hash"))
