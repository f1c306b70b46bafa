"""Near-duplicate embeddings: random-hyperplane sign hashing, exact cosine, connected components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import batches_of, ready, deal_pairs, list_arrays, local_components, materialize, runs
from martlens.llm.components import connected_components

THRESHOLD = 0.9
#: Chance that a pair exactly at the threshold shares a bucket in some table; closer pairs do more often.
RECALL = 1 - 1e-5
#: Large buckets need few bits, so fewer tables, each of which sends every vector once more.
BUCKET_ROWS = 256
MIN_BITS, MAX_BITS = 4, 16
BLOCK_ROWS = 1024
SEED = 20240607
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def is_valid(vector: Column | str) -> Column:
    """Whether a vector can be compared: not null or empty, all components finite, not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def table_plan(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): buckets of about BUCKET_ROWS rows, tables for the recall at the threshold."""
    bits = min(MAX_BITS, max(MIN_BITS, round(math.log2(max(rows, 2) / BUCKET_ROWS))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def sign_codes(vectors: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Per row and table, the sign pattern against that table's hyperplanes."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def unit_rows(flat: np.ndarray, width: int) -> np.ndarray:
    v = flat.astype(np.float64).reshape(-1, width)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Equal vectors are one class first, so copies cost one row. Every class is hashed in each table
    to its sign pattern; classes that share a bucket are compared by exact cosine in double
    precision, in cells of bounded size. A pair that meets in several tables counts in the first.
    A cell returns each row's number of links and only the links that connect its groups. The
    expected loss is the pairs that share no bucket, 1e-5 at the threshold and less above it.

    A vector that is null, empty, zero or holds null or non-finite components links with nothing;
    vectors of different lengths neither. A row without id has n_links 0, a null component and is
    not kept. Repeated rows count as vectors of their own. No rows give no rows.
    """
    spark = vectors.sparkSession
    ready(spark, 4096)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = F.col("vec_id").isNotNull() & is_valid("vec")
    classes = materialize(rows.where(usable).groupBy("vec")
                          .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")), "vectors")
    bits, tables = table_plan(classes.count(), threshold, recall)

    def code(batches):
        for batch in batches:
            flat, ends = list_arrays(batch.column("vec"))
            widths = np.diff(ends, prepend=0)
            codes = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                pick = (ends[at] - width)[:, None] + np.arange(width)
                codes[at] = sign_codes(unit_rows(flat[pick], width), bits, tables)
            lists = pa.ListArray.from_arrays(np.arange(len(codes) + 1) * tables, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), batch.column("copies"), batch.column("vec"), lists],
                names=["class_id", "copies", "vec", "codes"])

    coded = classes.mapInArrow(code, f"class_id long, copies long, vec {classes.schema['vec'].dataType.simpleString()}, "
                                     "codes array<int>")
    bucketed = coded.select("*", F.size("vec").alias("width"), F.posexplode("codes").alias("probe", "code"))
    cells = deal_pairs(bucketed, ["width", "probe", "code"], "class_id", BLOCK_ROWS)

    def compare(batches):
        yield from batches_of(_compared(batches, threshold), _FOUND)

    found = materialize(cells.mapInArrow(compare, "a long, b long, n long"), "pairs")
    links = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("outer_links"))
    groups = connected_components(found.where("b is not null")).withColumnRenamed("node", "class_id")
    labelled = (classes.join(links, "class_id", "left").join(groups, "class_id", "left")
                .select("vec", "copies", F.coalesce("outer_links", F.lit(0)).alias("outer_links"),
                        F.coalesce("component", "class_id").alias("component")))
    vec = F.when(usable, F.col("vec"))
    return (rows.select("vec_id", vec.alias("vec")).join(labelled, "vec", "left")
            .select(F.col("vec_id").alias(id_col),
                    F.coalesce(F.col("copies") - 1 + F.col("outer_links"), F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))


def _compared(batches, threshold: float):
    for (width, probe, _, i, j), rows in runs(batches, ["width", "probe", "code", "block_i", "block_j"]):
        if rows.num_rows < 2:
            continue
        ids, copies = (rows.column(c).to_numpy() for c in ("class_id", "copies"))
        unit = unit_rows(list_arrays(rows.column("vec"))[0], width)
        codes = list_arrays(rows.column("codes"))[0].reshape(len(ids), -1)[:, :probe]
        side = rows.column("block").to_numpy()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        links = np.zeros(len(ids), dtype=np.int64)
        a, b = [], []
        for at in range(0, len(left), 128):
            part = left[at:at + 128]
            cosine = unit[part] @ unit[right].T
            x, y = np.nonzero(cosine >= threshold - 1e-9)
            x, y = part[x], right[y]
            if i == j:
                x, y = x[x < y], y[x < y]
            exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            x, y = x[exact], y[exact]
            a.append(x)
            b.append(y)
            first = np.ones(len(x), dtype=bool)
            for t in range(probe):
                first &= codes[x, t] != codes[y, t]
            np.add.at(links, x[first], copies[y[first]])
            np.add.at(links, y[first], copies[x[first]])
        a, b = np.concatenate(a), np.concatenate(b)
        if not len(a):
            continue
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(ids))
        root = ids[order][local_components(len(ids), place[a], place[b])]
        tied = np.flatnonzero(root != ids[order])
        some = np.flatnonzero(links)
        yield {"a": np.concatenate((ids[some], ids[order][tied])),
               "b": pa.array([None] * len(some) + root[tied].tolist(), pa.int64()),
               "n": np.concatenate((links[some], np.zeros(len(tied), dtype=np.int64)))}
