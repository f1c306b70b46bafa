"""Cross-tokenizer alignment: token groups that two vocabularies cut at the same bytes.

A is a byte-level BPE vocabulary, B a piece vocabulary with byte fallback; both read a blank and the
whole text. Where a token of A and one of B end at the same byte, a group ends. The tokens of all texts of
a batch lie in one array a side, and lanes (texts, or pieces of long texts between places where both sides
end) are merged in lockstep: one step moves the pointers of all lanes at once, emits the group of each lane
that has reached a common end, and drops the lanes that are done.

A pair's count is the number of documents that hold it linked, over the whole corpus. ``align`` writes a
row a document with its distinct linked pairs, Spark counts them, and ``with_link_counts`` reads
the written rows again with the counts. Those are broadcast in slices of whole A ids with at most SLICE_PAIRS
pairs (or one A id's pairs, bounded by B's vocabulary); each slice is a pass over the rows, so no
pair of a document is shuffled a second time.

Odd cases: null and empty texts, and texts whose tokens do not spell them (a vocabulary that normalises),
have no tokens: zeros, and '' for the hash. Repeated rows are documents of their own. Strings of special
tokens are plain text. A group of many tokens links them all; it is counted by distinct ids, never
expanded token by token. Empty tables give no rows. Columns of ``docs`` named like the results are replaced.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.common import columns, list_arrays, materialize, ready
from martlens.llm.tokens import encoder, vocabulary_path

#: Tokens of A in a lane, about; longer texts are cut into lanes at common ends.
LANE = 256
#: Characters of text that are tokenised and merged at a time, or one text.
BATCH_BYTES = 1 << 20
#: Groups of more links than this are counted by distinct ids.
LARGE_GROUP = 64
#: Bound of the broadcast: pairs with their counts in one pass (17 bytes each).
SLICE_PAIRS = 1 << 22
RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_STRUCT = "struct<n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string,pair_a:array<int>,pair_b:array<int>,links:array<long>>"


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The bytes of each token, flat."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of tokens."""
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


class Tokenizers:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = Vocabulary([self.a.fast.decode_single_token_bytes(i) if i in self.a.known else b"" for i in range(self.a.fast.n_vocab)])
        self.bytes_b = Vocabulary([_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())])
        most = max(len(self.bytes_a.sizes), len(self.bytes_b.sizes))
        #: each id as text, followed by a comma, a bar or a semicolon
        self.written = [b"%d%c" % (i, c) for i in range(most) for c in b",|;"]


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


# ----------------------------------------------------------------------------- lockstep merge
def lanes(ends_a: np.ndarray, ends_b: np.ndarray, doc_a: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin: token places on either side. doc_a: places in A where documents begin.

    From every ``lane`` tokens of A inside a document on, the next common end is tried token by token, all at
    once; one that is not found before the next lane is left out, so its lane is longer."""
    sizes = np.diff(np.append(doc_a, len(ends_a)))
    inner = np.maximum(sizes - 2, 0) // lane
    first = np.repeat(doc_a, inner)
    last = np.repeat(doc_a + sizes, inner) - 1
    nth = np.arange(len(first)) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    place = first + nth * lane
    limit = np.minimum(place + lane, last)
    found = []
    while len(place):
        at = np.searchsorted(ends_b, ends_a[place])
        hit = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[place]
        found.append(place[hit] + 1)
        place, limit = place[~hit] + 1, limit[~hit]
        open_ = place < limit
        place, limit = place[open_], limit[open_]
    begin = np.unique(np.concatenate([doc_a, *found]))
    offsets = np.append(0, ends_a)[begin]
    return begin, np.searchsorted(ends_b, offsets, side="right")


def merge(ends_a: np.ndarray, ends_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups as (from, to) places in A and (from, to) places in B, in order; lanes begin at these places.

    ``ends_*`` are byte offsets over all texts; every lane ends on both sides at the same byte."""
    i, j = begin_a.copy(), begin_b.copy()
    from_a, from_b = begin_a.copy(), begin_b.copy()
    stop = np.append(begin_a[1:], len(ends_a))
    open_ = i < stop
    if not open_.all():
        i, j, from_a, from_b, stop = (x[open_] for x in (i, j, from_a, from_b, stop))
    out: list[tuple[np.ndarray, ...]] = []
    while len(i):
        end_a, end_b = ends_a[i], ends_b[j]
        i += end_a <= end_b
        j += end_b <= end_a
        cut = np.flatnonzero(end_a == end_b)
        if not len(cut):
            continue
        to_a, to_b = i[cut], j[cut]
        out.append((from_a[cut], to_a, from_b[cut], to_b))
        from_a[cut], from_b[cut] = to_a, to_b
        done = to_a == stop[cut]
        if done.any():
            keep = np.ones(len(i), dtype=bool)
            keep[cut[done]] = False
            i, j, from_a, from_b, stop = (x[keep] for x in (i, j, from_a, from_b, stop))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 4
    groups = [np.concatenate(x) for x in zip(*out)]
    order = np.argsort(groups[0], kind="stable")
    return tuple(x[order] for x in groups)


def _spread(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each n."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, groups: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, id of A, id of B, links) of the distinct pairs of each document, sorted; doc: of each group."""
    from_a, to_a, from_b, to_b = groups
    p, q = to_a - from_a, to_b - from_b
    large = p * q > LARGE_GROUP
    small = ~large
    n = (p * q)[small]
    at = _spread(n)
    each = np.repeat(q[small], n)
    a = ids_a[np.repeat(from_a[small], n) + at // each]
    b = ids_b[np.repeat(from_b[small], n) + at % each]
    keys = [(np.repeat(doc[small], n) << 32) | (a << 16) | b]
    weights = [np.ones(len(at), dtype=np.int64)]
    for g in np.flatnonzero(large).tolist():
        own_a, times_a = np.unique(ids_a[from_a[g]:to_a[g]], return_counts=True)
        own_b, times_b = np.unique(ids_b[from_b[g]:to_b[g]], return_counts=True)
        keys.append(((int(doc[g]) << 32) | (own_a[:, None] << 16) | own_b[None, :]).ravel())
        weights.append((times_a[:, None] * times_b[None, :]).ravel())
    key, weight = np.concatenate(keys), np.concatenate(weights)
    if len(keys) == 1:  # all weights are 1
        key, links = np.unique(key, return_counts=True)
    else:
        key, inverse = np.unique(key, return_inverse=True)
        links = np.zeros(len(key), dtype=np.int64)
        np.add.at(links, inverse, weight)
    return key >> 32, (key >> 16) & 0xFFFF, key & 0xFFFF, links


def written_groups(ids_a: np.ndarray, ids_b: np.ndarray, groups: tuple[np.ndarray, ...], written: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All tokens as text in the order a1,a2|b1;... , and where each group begins."""
    from_a, to_a, from_b, to_b = groups
    p, q = to_a - from_a, to_b - from_b
    first = np.cumsum(p + q) - (p + q)
    order = np.empty(int((p + q).sum()), dtype=np.int64)
    order[np.repeat(first, p) + _spread(p)] = 3 * ids_a
    order[np.repeat(first + p, q) + _spread(q)] = 3 * ids_b
    order[first + p - 1] += 1  # a bar after A's tokens
    order[first + p + q - 1] += 2  # a semicolon after B's
    return list(map(written.__getitem__, order.tolist())), first


# ----------------------------------------------------------------------------- a batch of texts
def _align_texts(texts: list[str], t: Tokenizers) -> dict[str, list]:
    """Results of texts that are neither null nor empty."""
    raw = [b" " + x.encode() for x in texts]
    ids_a = [np.array(t.a.encode_plain(" " + x), dtype=np.int64) for x in texts]
    ids_b = [np.array(x, dtype=np.int64) for x in t.b.encode(texts, num_threads=1)]
    good = np.array([t.bytes_a.sizes[a].sum() == len(r) == t.bytes_b.sizes[b].sum() for a, b, r in zip(ids_a, ids_b, raw)], dtype=bool)
    for k in np.flatnonzero(good).tolist():
        own = np.frombuffer(raw[k], dtype=np.uint8)
        good[k] = np.array_equal(t.bytes_a.spelled(ids_a[k]), own) and np.array_equal(t.bytes_b.spelled(ids_b[k]), own)
    n = len(texts)
    out: dict[str, list] = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "n_links": [0] * n, "groups_sha256": [""] * n}
    none = (np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
    pairs = [none] * n
    kept = np.flatnonzero(good)
    if len(kept):
        sizes_a, sizes_b = (np.array([len(x[k]) for k in kept]) for x in (ids_a, ids_b))
        flat_a, flat_b = (np.concatenate([x[k] for k in kept]) for x in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(t.bytes_a.sizes[flat_a]), np.cumsum(t.bytes_b.sizes[flat_b])
        doc_a = np.cumsum(sizes_a) - sizes_a
        groups = merge(ends_a, ends_b, *lanes(ends_a, ends_b, doc_a))
        first_group = np.searchsorted(groups[0], np.append(doc_a, len(flat_a)))
        n_links = np.add.reduceat((groups[1] - groups[0]) * (groups[3] - groups[2]), first_group[:-1])
        pieces, first = written_groups(flat_a, flat_b, groups, t.written)
        first = np.append(first, len(pieces))[first_group].tolist()
        doc, a, b, links = linked_pairs(flat_a, flat_b, groups, np.repeat(np.arange(len(kept)), np.diff(first_group)))
        cuts = np.searchsorted(doc, np.arange(len(kept) + 1)).tolist()
        a, b = a.astype(np.int32), b.astype(np.int32)
        for at, k in enumerate(kept.tolist()):
            out["n_a"][k], out["n_b"][k] = int(sizes_a[at]), int(sizes_b[at])
            out["n_groups"][k], out["n_links"][k] = int(first_group[at + 1] - first_group[at]), int(n_links[at])
            out["groups_sha256"][k] = hashlib.sha256(b"".join(pieces[first[at]:first[at + 1]])[:-1]).hexdigest()
            own = slice(cuts[at], cuts[at + 1])
            pairs[k] = (a[own], b[own], links[own])
    for name, at in (("pair_a", 0), ("pair_b", 1), ("links", 2)):
        out[name] = [p[at] for p in pairs]
    return out


def align(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``docs`` without its text, but with n_a, n_b (tokens), n_groups, n_links (pairs of an A and a B token
    of one group), groups_sha256 (of the groups written as ids), and the distinct linked id pairs pair_a,
    pair_b with their links in the document. Written to the shared folder."""
    ready(docs.sparkSession)

    def aligned(texts):
        t = tokenizers(path_a or vocabulary_path(), path_b or piece_path())
        n = len(texts)
        out: dict[str, list] = {}
        place: list[int] = []
        held: list[str] = []
        size = 0

        def flush():
            for name, values in _align_texts(held, t).items():
                out.setdefault(name, [None] * n)
                for k, v in zip(place, values):
                    out[name][k] = v
            place.clear()
            held.clear()

        for k in range(n):
            value = texts[k].as_py()
            if value:
                place.append(k)
                held.append(value)
                size += len(value)
            if size > BATCH_BYTES or (k == n - 1 and held):
                flush()
                size = 0
        numbers = [pa.array([v or 0 for v in out.get(c, [0] * n)], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        hashes = pa.array([v or "" for v in out.get("groups_sha256", [""] * n)], pa.string())
        lists = []
        for name, kind in (("pair_a", pa.int32()), ("pair_b", pa.int32()), ("links", pa.int64())):
            values = [v if v is not None else () for v in out.get(name, [()] * n)]
            flat = [v for v in values if len(v)]
            lists.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()),
                                                  pa.array(np.concatenate(flat) if flat else [], kind)))
        return pa.StructArray.from_arrays([*numbers, hashes, *lists],
                                          names=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair_a", "pair_b", "links"])

    own = [c for c, n in zip(columns(docs), docs.columns) if n not in (*RESULTS, text, "pair_a", "pair_b", "links")]
    return materialize(docs.select(*own, F.arrow_udf(aligned, _STRUCT)(F.col(text)).alias("llm_aligned")).select(*own, "llm_aligned.*"), "aligned")


# ----------------------------------------------------------------------------- corpus-wide counts
def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents a pair is linked, and whether no other pair of a has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p")).groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    return materialize(pairs.agg(F.count("*").alias("docs"))
                       .withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a"))), "pairs")


def count_slices(counts: DataFrame, most: int = SLICE_PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs as a * 65536 + b, documents, best), sorted, for ranges of A ids with at most ``most`` pairs or one A id."""
    sizes = counts.groupBy("a").count().orderBy("a").collect()  # at most a row an id of the vocabulary
    begin, n = 0, 0
    for k, r in enumerate(sizes):
        n += r["count"]
        if k + 1 == len(sizes) or n + sizes[k + 1]["count"] > most:
            part = counts.where(F.col("a").between(sizes[begin]["a"], r["a"])).toArrow()
            a, b, docs = (part.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "docs"))
            key = a << 16 | b
            order = np.argsort(key)
            yield key[order], docs[order], part.column("best").to_numpy(zero_copy_only=False)[order]
            begin, n = k + 1, 0


def with_link_counts(aligned: DataFrame, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """``aligned`` with count_sum (the counts of its links, summed) and n_best (its links whose count is the
    highest of their A id), and without the pairs themselves."""
    spark = aligned.sparkSession
    ready(spark)
    base = [c for c, n in zip(columns(aligned), aligned.columns) if n not in ("n_best", "count_sum")]
    zero = F.lit(0).cast("long")
    rows = aligned.select(*base, F.struct(zero.alias("n_best"), zero.alias("count_sum")).alias("llm_sums"))
    slices = count_slices(pair_counts(aligned), slice_pairs)
    part = next(slices, None)
    while part is not None:
        rows, part = _summed(rows, part), next(slices, None)
        if part is not None:
            rows = materialize(rows, "summed")  # one slice of counts in memory at a time
    return rows.select("*", "llm_sums.*").drop("llm_sums", "pair_a", "pair_b", "links")


def _summed(rows: DataFrame, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    @F.arrow_udf("struct<n_best:long,count_sum:long>")
    def summed(pair_a, pair_b, links, n_best, count_sum):
        key, docs, best = shared.value
        a, ends = list_arrays(pair_a)
        b, links = list_arrays(pair_b)[0], list_arrays(links)[0]
        own = a.astype(np.int64) << 16 | b
        at = np.minimum(np.searchsorted(key, own), len(key) - 1)
        weight = np.where(key[at] == own, links, 0)
        sums = []
        for values, before in ((weight * best[at], n_best), (weight * docs[at], count_sum)):
            running = np.append(0, np.cumsum(values))
            ends_of = np.append(0, ends)
            sums.append(pa.array(running[ends_of[1:]] - running[ends_of[:-1]] + before.to_numpy(), pa.int64()))
        return pa.StructArray.from_arrays(sums, names=["n_best", "count_sum"])

    return rows.withColumn("llm_sums", summed("pair_a", "pair_b", "links", "llm_sums.n_best", "llm_sums.count_sum"))
