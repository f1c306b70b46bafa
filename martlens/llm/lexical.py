"""Ranked lexical search: exact top documents of each item by sparse inner product, with ball trees.

A document is a sparse vector of integers: for each term, div(10^9 tf, 1000 tf + 12 m), where m grows
with its length. An item is a sparse vector of term weights times repeats, and the score is their
inner product in 64-bit integers. Only terms of the items matter to a score, so documents are first
reduced to those (one scan of the whole texts, which also yields every corpus count); the reduced
table is written to the shared folder. Each task then cuts its rows into blocks, builds a ball tree on
a block and searches it for every item, best node first. The bound of a node is <q, centroid> +
|q| radius, with |q| over the terms that occur below the node, in coordinates scaled by the root
of the weights, and rounded up; a node whose bound is below the item's k-th score so far is dropped with
all its documents. Leaves are scored exactly. A task returns at most k rows an item, which Spark merges.

The items are the broadcast side. They go to the driver in slices whose terms times items stay
below SLICE_CELLS (or one item), and each slice is a pass of its own over the documents.

Odd cases: null and empty texts, and texts without terms, are no documents to any count and never
returned; such items return nothing. Every row is a document of its own, also under a repeated
id; equal scores go by ascending id, a null id last. Items under one id are ranked each by itself.
Terms that no document holds add nothing. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.common import materialize, ready, terms_of, utf8

#: Bound of the broadcast: distinct terms times items of one pass (8 bytes each).
SLICE_CELLS = 1 << 22
#: Documents of one ball tree, and its entries: what a task holds at a time.
BLOCK_DOCS = 4096
BLOCK_ENTRIES = 1 << 21
LEAF_DOCS = 64
#: The merge of the tasks' rows runs in so many parts an item first.
MERGE_PARTS = 32


# ----------------------------------------------------------------------------- items
def item_slices(items: DataFrame, item_id: str, text: str, cells: int) -> Iterator[tuple[list, list[Counter]]]:
    """(ids, term counts) of the items that have terms, in slices of terms x items <= ``cells`` or one item."""
    ids, counts, terms = [], [], set()
    for own_id, raw in items.select(F.col(item_id), F.col(text).cast("binary")).where(F.col(text).isNotNull()).toLocalIterator():
        own = Counter(terms_of(bytes(raw)))
        if not own:
            continue
        if ids and (len(ids) + 1) * len(terms.union(own)) > cells:
            yield ids, counts
            ids, counts, terms = [], [], set()
        ids.append(own_id)
        counts.append(own)
        terms.update(own)
    if ids:
        yield ids, counts


# ----------------------------------------------------------------------------- documents
def term_table(docs: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): length in terms, and the vocabulary's terms with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("struct<n:long,terms:array<int>,tfs:array<int>>")
    def counted(texts):
        place = shared.value.get
        n, ends, terms, tfs = [], [0], [], []
        for raw in utf8(texts):
            words = terms_of(raw)
            known = np.array([k for k in map(place, words) if k is not None], dtype=np.int32)
            own, tf = np.unique(known, return_counts=True)
            n.append(len(words))
            ends.append(ends[-1] + len(own))
            terms.append(own)
            tfs.append(tf.astype(np.int32))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x) if x else [], pa.int32())) for x in (terms, tfs)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), *lists], names=["n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), counted(F.col(text)).alias("c")).select("doc_id", "c.*")


class Balls:
    """Ball tree over sparse rows, with rows in tree order: node -> rows lo..hi, children, centroid, radius, support."""

    def __init__(self, start: np.ndarray, cols: np.ndarray, x: np.ndarray, width: int, leaf: int):
        self.lo, self.hi, self.left, self.right = [], [], [], []
        centroids, radii, supports, self.order = [], [], [], np.empty(len(start) - 1, dtype=np.int64)
        placed = 0
        todo = [(-1, False, np.arange(len(start) - 1), np.diff(start), cols, x)]
        while todo:
            parent, is_right, rows, sizes, cols, x = todo.pop()
            begin = np.cumsum(sizes) - sizes
            mass = np.bincount(cols, weights=x, minlength=width)
            centre = mass / len(rows)
            square = np.add.reduceat(x * x, begin)
            own = (centre * centre).sum()
            far = np.maximum(square - 2 * np.add.reduceat(x * centre[cols], begin) + own, 0)
            node = len(self.lo)
            centroids.append(centre)
            radii.append(math.sqrt((far + 1e-10 * (square + own)).max()))  # never below the true distance
            supports.append(np.bincount(cols, minlength=width) > 0)
            self.lo.append(placed)
            self.hi.append(placed + len(rows))
            self.left.append(-1)
            self.right.append(-1)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            if len(rows) <= leaf:
                self.order[placed:placed + len(rows)] = rows
                placed += len(rows)
                continue
            # the two ends: the row farthest from the centre, and the row farthest from that one
            one = _row(int(far.argmax()), begin, sizes, cols, x, width)
            other = _row(int((square - 2 * np.add.reduceat(x * one[cols], begin)).argmax()), begin, sizes, cols, x, width)
            along = np.add.reduceat(x * (one - other)[cols], begin)
            near = np.zeros(len(rows), dtype=bool)
            near[np.argpartition(along, len(rows) // 2)[:len(rows) // 2]] = True
            for right, side in ((True, ~near), (False, near)):  # the left child is taken next, so rows lie in tree order
                entry = np.repeat(side, sizes)
                todo.append((node, right, rows[side], sizes[side], cols[entry], x[entry]))
        self.centroids, self.radii, self.supports = np.array(centroids), np.array(radii), np.array(supports, dtype=np.float64)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """[item, node]: no row below the node has a larger inner product with the item."""
        reach = np.sqrt((q * q) @ self.supports.T) * self.radii
        return (q @ self.centroids.T + reach) * (1 + 1e-9) + 1e-6


def _row(k: int, begin, sizes, cols, x, width: int) -> np.ndarray:
    out = np.zeros(width)
    at = slice(begin[k], begin[k] + sizes[k])
    out[cols[at]] = x[at]
    return out


class Best:
    """The k best rows of an item so far, by score downwards, then id upwards, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least)
        if not len(at):
            return
        self.rows += zip((-scores[at]).tolist(), null[at].tolist(), ids[at].tolist())
        self.rows = heapq.nsmallest(self.k, self.rows)
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def search_block(best: list[Best], q: np.ndarray, scaled: np.ndarray, scale: np.ndarray, ids, null, start, cols, values, leaf: int = LEAF_DOCS) -> int:
    """Search a block's ball tree for every item; returns how many (item, document) pairs were scored.

    q: integer weights [item, term]; scaled: q / scale; rows of the block hold ``values`` at ``cols``."""
    balls = Balls(start, cols, values * scale[cols], q.shape[1], leaf)
    sizes = np.diff(start)[balls.order]
    begin = np.cumsum(sizes) - sizes
    entry = np.repeat(start[balls.order] - begin, sizes) + np.arange(sizes.sum())
    cols, values, ids, null = cols[entry], values[entry], ids[balls.order], null[balls.order]
    ends = np.append(begin, len(cols))
    scored = 0
    for own, weights, bound in zip(best, q, balls.bounds(scaled)):
        queue = [(-bound[0], 0)]
        while queue:
            least, node = heapq.heappop(queue)
            if -least < own.least:
                break  # a bound that equals the k-th score may hide a smaller id
            if balls.left[node] < 0:
                lo, hi = balls.lo[node], balls.hi[node]
                at = slice(ends[lo], ends[hi])
                own.add(np.add.reduceat(values[at] * weights[cols[at]], begin[lo:hi] - ends[lo]), ids[lo:hi], null[lo:hi])
                scored += hi - lo
            else:
                for child in (balls.left[node], balls.right[node]):
                    if bound[child] >= own.least:
                        heapq.heappush(queue, (-bound[child], child))
    return scored


def _blocks(batches) -> Iterator[pa.Table]:
    held, docs, entries = [], 0, 0
    for batch in batches:
        held.append(batch)
        docs += batch.num_rows
        entries += len(batch.column("terms").flatten())
        if docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
            yield pa.Table.from_batches(held)
            held, docs, entries = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def _top_of_task(table: DataFrame, q: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best rows of each task and item."""
    shared = table.sparkSession.sparkContext.broadcast(q)

    def searched(batches):
        q = shared.value
        # coordinates scaled by the root of a term's mean weight: documents up, items down
        scale = np.sqrt(q.sum(axis=0) / np.maximum((q > 0).sum(axis=0), 1))
        scaled = q / np.where(scale > 0, scale, 1)
        best = [Best(k) for _ in q]
        for block in _blocks(batches):
            block = block.combine_chunks()
            terms, tfs = (block.column(c).chunk(0) for c in ("terms", "tfs"))
            start = terms.offsets.to_numpy().astype(np.int64)
            start -= start[0]
            cols, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, tfs))
            m = np.array([75 + 25 * n * n_docs // n_terms for n in block.column("n").to_pylist()], dtype=np.int64)
            values = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, np.diff(start)))
            ids = block.column("doc_id").chunk(0)
            search_block(best, q, scaled, scale, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), start, cols, values)
        rows = [(item, None if null else own, -score) for item, b in enumerate(best) for score, null, own in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                         names=["item", "doc_id", "score"])

    return table.mapInArrow(searched, "item int, doc_id long, score long")


def _search_slice(docs: DataFrame, ids: list, counts: list[Counter], id_type, doc_id: str, text: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    table = materialize(term_table(docs, doc_id, text, vocabulary), "terms")
    n_docs, n_terms = table.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    q = np.zeros((len(ids), len(vocabulary)), dtype=np.int64)
    for row, own in enumerate(counts):
        for term, n in own.items():
            q[row, vocabulary[term]] = n * weight[vocabulary[term]]
    found = _top_of_task(table.where(F.size("terms") > 0), q, n_docs, n_terms, k)
    for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id " + id_type.simpleString())
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", cells: int = SLICE_CELLS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 of each item."""
    ready(docs.sparkSession)
    id_type = items.schema[item_id].dataType
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = []
    for ids, counts in item_slices(items, item_id, item_text, cells):
        part = _search_slice(docs, ids, counts, id_type, "doc_id", "text", k)
        parts.append(part if not parts else materialize(part, "ranked"))
    none = docs.sparkSession.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, parts) if parts else none
