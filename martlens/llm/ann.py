"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking, and exact search of
the queries whose probes find too few rows."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import batches_of, ready, list_arrays, materialize, runs
from martlens.llm.embedding_dedup import is_valid

TABLES = 4
#: Width of a hash cell in standard deviations of the projections.
CELL_WIDTH = 2.0
BUCKET_ROWS = 64
BLOCK_ROWS = 4096
#: Bounds of the fit: rows drawn by a hash of the id, and those of them that serve as queries.
FIT_ROWS, FIT_QUERIES = 4096, 128
#: Share of the true neighbours of the fit's queries that the probes must visit.
RECALL = 0.97
MAX_PROBES = 4096
#: A query whose probes visit a smaller share of its own nearest rows in the sample is compared with all rows.
SEEN = 0.5
STEPS = np.arange(-2, 3)
#: The exact search: bytes of a broadcast block of queries, and rows and queries whose products a task holds at a time.
QUERY_BYTES = 1 << 26
SCAN_ROWS, SCAN_QUERIES = 4096, 512
SEED = 977
_NEAR = pa.schema([("query_id", pa.int64()), ("near", pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))])


def probe_order(place: np.ndarray, probes: int) -> np.ndarray:
    """Per query, the steps of its first ``probes`` buckets, [query, probe, projection].

    ``place`` is each query's position inside its own cell, 0 to 1 per projection. A step to a
    neighbouring cell costs the squared distance to its border, in cells; less cost means likelier
    success. Costs add up over the projections, so the best sets of any number of projections
    extend the best sets of one projection less.
    """
    n, m = place.shape
    near = np.where(STEPS > 0, STEPS - place[..., None], np.where(STEPS < 0, place[..., None] - STEPS - 1, 0.0))
    cost, steps = np.zeros((n, 1)), np.zeros((n, 1, 0), dtype=np.int64)
    for k in range(m):
        total = (cost[:, :, None] + near[:, None, k] ** 2).reshape(n, -1)
        keep = np.argsort(total, axis=1, kind="stable")[:, :probes]
        cost = np.take_along_axis(total, keep, axis=1)
        held = np.take_along_axis(steps, (keep // len(STEPS))[:, :, None], axis=1)
        steps = np.concatenate((held, STEPS[keep % len(STEPS)][:, :, None]), axis=2)
    return steps


class Index:
    """Projections of all tables, cell widths and the number of probes, fitted on a sample."""

    def __init__(self, sample: np.ndarray, rows: int, k: int):
        width = sample.shape[1]
        self.dim, self.sample = width, sample
        self.m = min(10, max(3, round(math.log2(max(rows, 2) / BUCKET_ROWS) / 1.6)))
        rng = np.random.default_rng([SEED, width])
        self.lines = rng.standard_normal((TABLES, width, self.m))
        spread = np.array([max((sample @ line).std(axis=0).mean(), 1e-300) for line in self.lines])
        self.cell = CELL_WIDTH * spread
        self.shift = rng.uniform(0, 1, (TABLES, self.m))
        self.probes, self.enough = self._fit(sample, k)

    def cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and position inside it."""
        at = vectors @ self.lines[table] / self.cell[table] + self.shift[table]
        low = np.floor(np.clip(at, -2.0 ** 31, 2.0 ** 31))
        return low.astype(np.int64), np.clip(at - low, 0.0, 1.0)

    def seen(self, queries: np.ndarray, buckets: list[np.ndarray], k: int) -> np.ndarray:
        """Share of each query's nearest rows in the sample that lie in its ``buckets``, per table
        [query, probe]; the first is left out, as it may be the query itself."""
        square = (self.sample ** 2).sum(axis=1) - 2 * queries @ self.sample.T
        near = np.argsort(square, axis=1)[:, 1:k + 1]
        hit = np.zeros(near.shape, dtype=bool)
        for t in range(TABLES):
            held = _hash(self.cells(self.sample[near.ravel()], t)[0]).reshape(near.shape)
            for q in range(len(queries)):
                hit[q] |= np.isin(held[q], buckets[t][q])
        return hit.mean(axis=1)

    def _fit(self, sample: np.ndarray, k: int) -> tuple[int, bool]:
        """Fewest probes per table that visit RECALL of the queries' neighbours in the sample, and
        whether any number of probes within the bounds does."""
        queries = sample[:FIT_QUERIES]
        most = min(MAX_PROBES, len(STEPS) ** self.m)
        if len(sample) < 3:
            return most, False
        square = ((queries[:, None, :] - sample[None, :, :]) ** 2).sum(axis=2) if len(sample) * len(queries) * self.dim < 1 << 22 \
            else (queries ** 2).sum(axis=1)[:, None] + (sample ** 2).sum(axis=1) - 2 * queries @ sample.T
        square[np.arange(len(queries)), np.arange(len(queries))] = np.inf
        true = np.argsort(square, axis=1)[:, :min(k, len(sample) - 1)]
        first = np.full(true.shape, most)
        for t in range(TABLES):
            own, place = self.cells(queries, t)
            every, _ = self.cells(sample, t)
            for q in range(len(queries)):
                order = probe_order(place[q:q + 1], most)[0]
                rank = {tuple(s): r for r, s in enumerate(order.tolist())}
                for c, v in enumerate(true[q]):
                    first[q, c] = min(first[q, c], rank.get(tuple((every[v] - own[q]).tolist()), most))
        reached = np.sort(first.ravel())
        last = reached[min(len(reached) - 1, math.ceil(RECALL * len(reached)) - 1)]
        return int(min(most, last + 1)), bool(last < most)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each query by Euclidean distance.

    Every row is indexed in each table under its p-stable bucket. A query visits its buckets in
    order of estimated success, as many per table as a bounded sample needs for RECALL. A crowded
    bucket is dealt to blocks that are all visited. Each visit returns its k nearest by exact
    distance in double precision; these are merged across buckets and tables. A query that found
    fewer than k rows, or whose probes would visit less than SEEN of its own nearest rows in the
    sample, is compared with every row, and so are all queries if no number of probes within the
    bounds reaches RECALL on the sample. That search is exact and scans the rows once a block of queries, without a
    shuffle of rows; its work is such queries times rows.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without id,
    take no part. Vectors of each length are searched by themselves, with an index of their own. A
    query is no candidate of its own id. Ties go to the smaller id; repeated rows of one id count once.
    No queries or rows give no rows; fewer than k candidates give all of them.
    """
    spark = vectors.sparkSession
    ready(spark, 4096)
    rows = (vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("vec_id").isNotNull() & is_valid("vec")))
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("vec").alias("vec"))
    found = None
    for width, n in sorted(map(tuple, rows.groupBy(F.size("vec")).count().collect())):
        own = F.size("vec") == width
        near = _of_width(rows.where(own), asked.where(own), n, width, k)
        found = near if found is None else found.unionByName(near)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if found is None else found


def _of_width(rows: DataFrame, asked: DataFrame, n: int, dim: int, k: int) -> DataFrame:
    """The search among the ``n`` rows of one length."""
    spark = rows.sparkSession
    drawn = rows.select("vec").orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(FIT_ROWS).collect()
    index = Index(np.array([r["vec"] for r in drawn]), n, k)
    if not index.enough:
        return _merge(_exact(rows, asked, k, dim), k)
    shared = spark.sparkContext.broadcast(index)
    vec = "vec array<double>"
    stored = rows.select("vec_id", "vec").mapInArrow(
        lambda batches: _placed(batches, shared.value), f"vec_id long, table int, bucket long, {vec}")
    sizes = materialize(stored.groupBy("table", "bucket")
                        .agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "buckets")
    crowded = materialize(sizes.where("blocks > 1"), "crowded")
    block = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.coalesce("blocks", F.lit(1))).cast("int")
    stored = (stored.join(crowded, ["table", "bucket"], "left")
              .select("table", "bucket", block.alias("block"), F.lit(1).alias("side"), "vec_id", "vec"))
    visits = (asked.mapInArrow(lambda batches: _visits(batches, shared.value, k),
                               "vec_id long, table int, bucket long")
              .join(sizes, ["table", "bucket"])
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .join(asked, "vec_id")
              .select("table", "bucket", "block", F.lit(0).alias("side"), "vec_id", "vec"))
    cell = ["table", "bucket", "block"]
    found = materialize(_merge(_met(stored.unionByName(visits), k, dim), k), "found")
    short = materialize(asked.join(found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    whole = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return whole.unionByName(_merge(_exact(rows, short, k, dim), k))


def _exact(rows: DataFrame, asked: DataFrame, k: int, dim: int) -> DataFrame:
    """Every query's k nearest of all rows. Queries go to the tasks in broadcast blocks of QUERY_BYTES, and each block
    is one scan of the rows where they lie: a row is never sent anywhere, and a task returns k rows a query."""
    spark = rows.sparkSession
    size, parts, held = max(1, QUERY_BYTES // (8 * dim)), [], []

    def scan() -> DataFrame:
        shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in held], dtype=np.int64), np.array([r["vec"] for r in held], dtype=np.float64)))
        return materialize(rows.select("vec_id", "vec").mapInArrow(lambda batches: batches_of(_scanned(batches, *shared.value, k, dim), _NEAR),
                                                                   "query_id long, near array<struct<score:double,vec_id:long>>"), "scanned")

    for row in asked.select("vec_id", "vec").toLocalIterator():
        held.append(row)
        if len(held) == size:
            parts.append(scan())
            held = []
    if held:
        parts.append(scan())
    return functools.reduce(DataFrame.unionByName, parts)


def _scanned(batches, ids: np.ndarray, queries: np.ndarray, k: int, dim: int):
    """One task's k nearest rows of each query. A block of products tells which rows can be among them, but for rounding;
    these are compared exactly."""
    square = (queries ** 2).sum(axis=1)
    # the k best so far of each query, worst last; empty places are infinitely far
    best = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
    for batch in batches:
        flat = list_arrays(batch.column("vec"))[0].reshape(-1, dim)
        names = batch.column("vec_id").to_numpy()
        for r in range(0, len(names), SCAN_ROWS):
            stored, own = flat[r:r + SCAN_ROWS], names[r:r + SCAN_ROWS]
            length = (stored ** 2).sum(axis=1)
            for q in range(0, len(ids), SCAN_QUERIES):
                part = slice(q, q + SCAN_QUERIES)
                about = square[part, None] + length[None, :] - 2 * (queries[part] @ stored.T)
                about[ids[part, None] == own[None, :]] = np.inf
                slack = 1e-9 * (square[part] + length.max())  # far above the rounding of the products
                bound = best[0][part, -1] ** 2
                if len(own) > k and len(np.unique(own)) == len(own):
                    bound = np.minimum(bound, np.partition(about, k - 1, axis=1)[:, k - 1])
                x, y = np.nonzero(about <= np.where(np.isfinite(bound), bound + 2 * slack, np.finfo(float).max)[:, None])
                for at in range(0, len(x), max(1, (1 << 22) // dim)):
                    cut = slice(at, at + max(1, (1 << 22) // dim))
                    score = np.sqrt(((stored[y[cut]] - queries[q + x[cut]]) ** 2).sum(axis=1))
                    _keep(best, q + x[cut], score, own[y[cut]], k)
    for q in range(0, len(ids), 1024):
        near = [[{"score": s, "vec_id": v} for s, v in zip(a, b) if s < np.inf] for a, b in zip(best[0][q:q + 1024].tolist(), best[1][q:q + 1024].tolist())]
        yield {"query_id": ids[q:q + 1024], "near": near}


def _keep(best: tuple[np.ndarray, np.ndarray], query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Merge candidates into the k best of their queries; ties go to the smaller id, an id counts once."""
    asked = np.unique(query)
    query = np.concatenate((np.repeat(asked, k), query))
    score, ids = np.concatenate((best[0][asked].ravel(), score)), np.concatenate((best[1][asked].ravel(), ids))
    order = np.lexsort((score, ids, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])) | np.isinf(score)
    query, score, ids = query[first], score[first], ids[first]
    order = np.lexsort((ids, score, query))
    query, score, ids = query[order], score[order], ids[order]
    heads = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    place = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
    use = place < k
    best[0][asked], best[1][asked] = np.inf, np.iinfo(np.int64).max
    best[0][query[use], place[use]], best[1][query[use], place[use]] = score[use], ids[use]


def _met(rows: DataFrame, k: int, dim: int) -> DataFrame:
    """Per cell, the k nearest stored rows (side 1) of each query (side 0)."""
    cell = ["table", "bucket", "block"]
    return (rows.repartition(*cell).sortWithinPartitions(*cell, "side")
            .mapInArrow(lambda batches: batches_of(_visited(batches, k, dim), _NEAR),
                        "query_id long, near array<struct<score:double,vec_id:long>>"))


def _merge(near: DataFrame, k: int) -> DataFrame:
    return (near.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(lambda batches: _merged(batches, k), "query_id long, rank int, vec_id long, score double"))


def _hash(cells: np.ndarray) -> np.ndarray:
    """64-bit key of a bucket; rows of two buckets that share a key are reranked together."""
    h = np.zeros(len(cells), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in cells.T.astype(np.uint64):
            h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _placed(batches, index: Index):
    """Each row's bucket per table with its vector."""
    for batch in batches:
        ids = batch.column("vec_id")
        flat = list_arrays(batch.column("vec"))[0]
        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * index.dim), pa.array(flat))
        for t in range(TABLES):
            low, _ = index.cells(flat.reshape(-1, index.dim), t)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(ids), t, dtype=np.int32)), pa.array(_hash(low)), vec],
                                             names=["vec_id", "table", "bucket", "vec"])


def _visits(batches, index: Index, k: int):
    """The buckets that each query visits per table; none for a query that they would not serve."""
    step = max(1, min(256, (1 << 18) // (index.probes * len(STEPS))))
    for batch in batches:
        ids = batch.column("vec_id").to_numpy()
        vectors = list_arrays(batch.column("vec"))[0].reshape(len(ids), index.dim)
        for at in range(0, len(ids), step):
            own, v, buckets = ids[at:at + step], vectors[at:at + step], []
            for t in range(TABLES):
                low, place = index.cells(v, t)
                low = (low[:, None, :] + probe_order(place, index.probes)).reshape(-1, index.m)
                buckets.append(_hash(low).reshape(len(own), -1))
            sure = index.seen(v, buckets, k) >= SEEN
            for t, found in enumerate(buckets):
                n = found[sure].size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own[sure], found.shape[1])), pa.array(np.full(n, t, dtype=np.int32)), pa.array(found[sure].ravel())],
                    names=["vec_id", "table", "bucket"])


def _nearest(score: np.ndarray, ids: np.ndarray, k: int) -> list[dict]:
    """The k smallest by (score, id), one entry an id."""
    found: dict[int, float] = {}
    for at in np.lexsort((ids, score)):
        if len(found) == k:
            break
        found.setdefault(int(ids[at]), float(score[at]))
    return [{"score": s, "vec_id": v} for v, s in found.items()]


def _visited(batches, k: int, dim: int):
    for _, rows in runs(batches, ["table", "bucket", "block"]):
        asking = int((rows.column("side").to_numpy() == 0).sum())
        if not asking or asking == rows.num_rows:
            continue
        ids = rows.column("vec_id").to_numpy()
        vectors = list_arrays(rows.column("vec"))[0].reshape(-1, dim)
        queries, stored = vectors[:asking], vectors[asking:]
        names, out, near = ids[asking:], [], []
        repeated = len(np.unique(names)) < len(names)
        for q in range(asking):
            score = np.sqrt(((stored - queries[q]) ** 2).sum(axis=1))
            usable = names != ids[q]
            score, own = score[usable], names[usable]
            if not repeated and len(score) > 4 * k:  # the k-th smallest score bounds what can be chosen
                close = score <= np.partition(score, k - 1)[k - 1]
                score, own = score[close], own[close]
            out.append(int(ids[q]))
            near.append(_nearest(score, own, k))
        yield {"query_id": out, "near": near}


def _merged(batches, k: int):
    """Sorted by query: its k best over all visits."""
    held: dict[int, float] = {}
    query = None

    def result():
        best = sorted((s, v) for v, s in held.items())[:k]
        return pa.RecordBatch.from_arrays(
            [pa.array([query] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()),
             pa.array([v for _, v in best], pa.int64()), pa.array([s for s, _ in best], pa.float64())],
            names=["query_id", "rank", "vec_id", "score"])

    for batch in batches:
        for own, near in zip(batch.column("query_id").to_pylist(), batch.column("near").to_pylist()):
            if own != query:
                if held:
                    yield result()
                query, held = own, {}
            for found in near:
                held[found["vec_id"]] = min(found["score"], held.get(found["vec_id"], math.inf))
            if len(held) > 8 * k:
                held = {v: s for s, v in sorted((s, v) for v, s in held.items())[:k]}
    if held:
        yield result()
