"""Sharding: a uniform random permutation into shards of exact sizes, by a hypergeometric
communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlens.llm.common import columns

SEED = 90210
#: Standard deviations around the mode that a draw covers; beyond lies less than 1e-40.
_REACH = 14


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good ones among ``draws`` without replacement, by inversion around the mode; numpy's
    own stops at 1e9 items."""
    low, high = max(0, draws - bad), min(draws, good)
    if low >= high:
        return low
    total = good + bad
    mean = draws * good / total
    spread = (mean * (bad / total) * (total - draws) / max(total - 1, 1)) ** 0.5
    a, b = max(low, int(mean - _REACH * spread - 20)), min(high, int(mean + _REACH * spread + 20))
    x = np.arange(a, b, dtype=np.float64)
    steps = np.log(good - x) + np.log(draws - x) - np.log(x + 1) - np.log(bad - draws + x + 1)
    weight = np.concatenate(([0.0], np.cumsum(steps)))
    upto = np.cumsum(np.exp(weight - weight.max()))
    return a + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


def communication_matrix(partitions: list[int], shards: list[int], seed: int = SEED) -> np.ndarray:
    """Rows of each partition that go to each shard: the law of a uniform permutation of all rows."""
    rng = np.random.default_rng(seed)
    room, out = list(shards), np.zeros((len(partitions), len(shards)), dtype=np.int64)
    for p, n in enumerate(partitions):
        left, behind = n, sum(room)
        for s in range(len(room)):
            behind -= room[s]
            out[p, s] = hypergeometric(rng, room[s], behind, left)
            left -= out[p, s]
            room[s] -= int(out[p, s])
    return out


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """``docs`` with shard (0 to shards - 1) and slot (its place there, gapless from 0).

    Rows are dealt to partitions by a keyed hash of all their columns and ordered there by it, a
    local random permutation that a recomputed task repeats. The matrix says how many of each
    partition go to each shard; they are the next ones in that order. After the exchange a second
    keyed hash permutes every shard: it is cut into parts by that hash, numbered part by part and
    shifted by the parts before, so that no task holds a shard. Shard sizes differ by one at most.

    Equal rows are interchangeable; nulls hash like any value; equal texts are not kept together
    (a group may be larger than a shard). Columns of ``docs`` are kept, those named shard or slot
    are replaced. No rows give no rows. The matrix has one row per shuffle partition.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    subs = max(1, parts // shards)
    first, second = (F.xxhash64(F.lit(seed + k), *columns(docs)) for k in (0, 1))
    keyed = docs.withColumns({"llm_first": first, "llm_second": second})
    keyed = keyed.withColumn("llm_part", F.pmod(F.xxhash64(F.lit(seed + 2), "llm_first"), F.lit(parts)).cast("int"))
    sizes = {r["llm_part"]: r["count"] for r in keyed.groupBy("llm_part").count().collect()}
    total = sum(sizes.values())
    wanted = [total // shards + (s < total % shards) for s in range(shards)]
    order = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in order], wanted, seed)
    cuts = spark.createDataFrame([(p, row.cumsum()[:-1].tolist()) for p, row in zip(order, matrix)],
                                 "llm_part int, llm_cuts array<long>")

    def sharded(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("llm_part").orderBy("llm_first", "llm_second"))
        shard = F.size(F.filter("llm_cuts", lambda c: c < F.col("llm_rank")))
        sub = F.pmod(F.shiftright("llm_second", 7), F.lit(subs)).cast("int")
        return (rows.withColumn("llm_rank", rank).join(F.broadcast(cuts), "llm_part")
                .withColumns({"shard": shard.cast("int"), "llm_sub": sub}))

    counts = (sharded(keyed.select("llm_part", "llm_first", "llm_second")).groupBy("shard", "llm_sub").count()
              .orderBy("shard", "llm_sub").collect())
    starts, at = [], {}
    for r in counts:
        starts.append((r["shard"], r["llm_sub"], at.get(r["shard"], 0)))
        at[r["shard"]] = at.get(r["shard"], 0) + r["count"]
    begin = spark.createDataFrame(starts, "shard int, llm_sub int, llm_start long")
    place = F.row_number().over(W.partitionBy("shard", "llm_sub").orderBy("llm_second", "llm_first"))
    return (sharded(keyed).withColumn("llm_place", place).join(F.broadcast(begin), ["shard", "llm_sub"])
            .withColumn("slot", F.col("llm_start") + F.col("llm_place") - 1)
            .select(*columns(docs), "shard", "slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, its rows in slot order within each file."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
