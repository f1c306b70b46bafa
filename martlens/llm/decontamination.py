"""Benchmark decontamination: a broadcast hash set of the benchmark's n-grams, scanned over whole documents.

Words are the runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A
window is ``window`` consecutive words of an item; an item of fewer words is one window of all its
words. Documents are read once where they lie: a task hashes every run of as many words, looks the
hashes up in the broadcast set and compares the words of each hit, so equal hashes alone never count.

The broadcast is bounded: items go to the driver in slices of SLICE_WORDS words (or one item, if it
is longer), and documents are scanned once a slice. Nothing is shuffled.

Odd cases: a null text, and one without words, has no words, no hits and no items, and as an item no
windows. Repeated documents each get their row. Repeated item ids count once; an item without id
marks words, but is in no list of items. Tables without rows give no hits. Columns of ``docs`` that are
named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martlens.llm.common import WordHashes, columns, materialize, ready, terms_of, utf8

WINDOW = 10
#: Bound of the broadcast: words of benchmark items in one scan of the documents.
SLICE_WORDS = 1 << 19
#: One bit a hash bucket tells most windows of documents apart from the benchmark's before they are looked up.
_FILTER_BITS = 22
_STEP = 0x9E3779B97F4A7C15
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
RESULTS = ["n_words", "spans", "item_ids", "n_hit", "contaminated", "clean_text"]


def window_hashes(words: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, hash of each run of k words) for k from 1 to ``longest``, from the hashes of the words."""
    total, factor = np.zeros(len(words), dtype=np.uint64), 1
    with np.errstate(over="ignore"):
        for k in range(1, min(longest, len(words)) + 1):
            total = total[:len(words) - k + 1] + words[k - 1:] * np.uint64(factor)
            factor = factor * _STEP % (1 << 64)
            yield k, total


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


class Windows:
    """The windows of some items: the ids of the items that hold each, and its hash by length."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        hashes, by_length = WordHashes(), {}
        self.items: dict[bytes, set[str]] = {}
        for item, words in items:
            k = min(window, len(words))
            for length, found in window_hashes(hashes.of(words), k):
                if length == k:
                    by_length.setdefault(k, []).append(found)
            for i in range(len(words) - k + 1) if k else ():
                self.items.setdefault(b" ".join(words[i:i + k]), set()).update(() if item is None else (item,))
        self.hashes = {k: np.unique(np.concatenate(v)) for k, v in by_length.items()}
        self.filters = {}
        for k, v in self.hashes.items():
            self.filters[k] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self.filters[k][_bits(v)] = True

    def find(self, words: list[bytes], hashes: WordHashes) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (from, to) that occurring windows cover, in order and apart, and their items."""
        if not self.hashes:
            return [], set()
        spans, items = [], set()
        for k, found in window_hashes(hashes.of(words), max(self.hashes)):
            if k not in self.hashes:
                continue
            at = np.flatnonzero(self.filters[k][_bits(found)])
            known = self.hashes[k]
            place = np.minimum(np.searchsorted(known, found[at]), len(known) - 1)
            for i in at[known[place] == found[at]].tolist():
                held = self.items.get(b" ".join(words[i:i + k]))
                if held is not None:
                    spans.append((i, i + k))
                    items |= held
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans as spans in order that neither meet nor touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without its words of these spans and what lies between the words of a span."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def item_slices(items: DataFrame, item_id: str, text: str, most: int = SLICE_WORDS) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """(id as text, words) of the items that have words, in lists of ``most`` words at most or one item."""
    held, n = [], 0
    rows = items.select(F.col(item_id).cast("string"), F.col(text).cast("binary")).where(F.col(text).isNotNull())
    for item, raw in rows.toLocalIterator():
        words = terms_of(bytes(raw))
        if held and n + len(words) > most:
            yield held
            held, n = [], 0
        if words:
            held.append((item, words))
            n += len(words)
    if held:
        yield held


def _scan(docs: DataFrame, text: str, windows: Windows) -> DataFrame:
    """``docs`` with llm_found brought up to date with these windows."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    @F.arrow_udf("struct<n_words:long,spans:array<struct<start:long,end:long>>,item_ids:array<string>>")
    def found(texts, spans, items):
        hashes, n, all_spans, all_items = WordHashes(), [], [], []
        for raw, old_spans, old_items in zip(utf8(texts), spans.to_pylist(), items.to_pylist()):
            words = terms_of(raw)
            new_spans, new_items = shared.value.find(words, hashes)
            n.append(len(words))
            all_spans.append([{"start": a, "end": b} for a, b in merged(new_spans + [(s["start"], s["end"]) for s in old_spans])])
            all_items.append(sorted(new_items.union(old_items), key=str.encode))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(all_spans, _SPAN), pa.array(all_items, pa.list_(pa.string()))],
                                          names=["n_words", "spans", "item_ids"])

    # not deterministic in Spark's sense only: a filter on a result must not run the scan a second time
    return docs.withColumn("llm_found", found.asNondeterministic()(F.col(text), F.col("llm_found.spans"), F.col("llm_found.item_ids")))


@F.arrow_udf(StringType())
def _without(texts, spans):
    return pa.array([None if raw is None else cut(raw, [(s["start"], s["end"]) for s in own]).decode("utf-8", "replace")
                     for raw, own in zip(utf8(texts), spans.to_pylist())], pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``docs`` with n_words; spans (start, end: the hit words, in order, apart, end not included);
    item_ids (items with occurring windows, sorted as text); n_hit (hit words); contaminated; and
    clean_text, the text without the hit words: with spans without hits it is the text itself. To
    remove documents instead of spans, filter on contaminated."""
    ready(docs.sparkSession)
    own = [c for c, n in zip(columns(docs), docs.columns) if n not in RESULTS]
    start = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
                     F.array().cast("array<string>").alias("item_ids"))
    scanned = docs.select(*own, F.col(text).alias("llm_text"), start.alias("llm_found"))
    slices = item_slices(items, item_id, item_text, slice_words)
    part = next(slices, [])
    while True:
        scanned, part = _scan(scanned, "llm_text", Windows(part, window)), next(slices, None)
        if part is None:
            break
        scanned = materialize(scanned, "scanned")  # one set of windows in memory at a time
    n_hit: Column = F.aggregate("llm_found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = scanned.select("*", "llm_found.*").withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0)
    clean = F.when(F.col("contaminated"), _without(F.when(F.col("contaminated"), F.col("llm_text")), F.col("spans"))).otherwise(F.col("llm_text"))
    return out.withColumn("clean_text", clean).drop("llm_text", "llm_found")
