"""Mixing sources to target weights: min-cost flow over membership patterns, seeded selection."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlens.llm.common import columns, materialize

#: A document is taken at most this often.
MAX_EPOCHS = 3
#: Cost of a word the first, second and third time: each repetition costs more than the last.
EPOCH_COSTS = (0, 1, 3)
#: The sources and their membership patterns are a catalogue that one machine holds: beyond this number the mix
#: fails with an error (the flow on the driver takes one shortest path an edge that fills up).
MAX_PATTERNS = 100_000
SEED = 4711


def water_fill(sizes: list[int], weights: list[float], most: float = MAX_EPOCHS) -> list[float]:
    """Targets that share the sum of sizes by weight, none above ``most`` times its size; the
    excess goes to the others by weight until none is above."""
    targets = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in full or open_:
            targets[i] = most * float(sizes[i]) if full else weights[i] * unit
        if not full:
            break
        left -= sum(targets[i] for i in full)
        open_ -= set(full)
    return targets


def min_cost_flow(sizes: list[int], members: list[list[int]], quotas: list[float]) -> list[dict[int, float]]:
    """Words that each pattern gives to each of its sources: as much of the quotas as can be met,
    at the least cost of repetitions. Successive shortest paths with potentials, each path filled
    to its narrowest edge."""
    n, m = len(sizes), len(quotas)
    source, sink = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to, room, cost = [], [], []

    def edge(u: int, v: int, capacity: float, price: float) -> None:
        for a, b, c, p in ((u, v, capacity, price), (v, u, 0.0, -price)):
            graph[a].append(len(to))
            to.append(b)
            room.append(c)
            cost.append(p)

    for p in range(n):
        for price in EPOCH_COSTS:
            edge(source, p, float(sizes[p]), price)
        for s in members[p]:
            edge(p, n + s, float("inf"), 0.0)
    for s in range(m):
        edge(n + s, sink, quotas[s], 0.0)
    least = 1e-9 * max([1.0, *quotas])
    level = [0.0] * len(graph)
    while True:
        far, came = [float("inf")] * len(graph), [-1] * len(graph)
        far[source] = 0.0
        queue = [(0.0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in graph[u]:
                if room[e] > least:
                    next_ = d + cost[e] + level[u] - level[to[e]]
                    if next_ < far[to[e]] - 1e-12:
                        far[to[e]], came[to[e]] = next_, e
                        heapq.heappush(queue, (next_, to[e]))
        if came[sink] < 0:
            break
        level = [h + (d if d < float("inf") else 0.0) for h, d in zip(level, far)]
        path, at = [], sink
        while at != source:
            path.append(came[at])
            at = to[came[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    flows: list[dict[int, float]] = [{} for _ in range(n)]
    for p in range(n):
        for e in graph[p]:
            if e % 2 == 0 and room[e ^ 1] > least:
                flows[p][to[e] - n] = room[e ^ 1]
    return flows


def mix(docs: DataFrame, size: Column, sources: Column, weights, key: list[str], seed: int = SEED) -> tuple[DataFrame, list[dict]]:
    """(``docs`` with mix_size, mix_pattern and mix_copies, per-source report).

    ``sources`` is an array of the names of the sources that hold a document (a null name is a
    source of its own; a null or empty array is none). ``weights`` maps the sorted list of names,
    null last, to their weights. Documents are aggregated by membership pattern; a source's size
    is the sum over its patterns, its target a weighted share of all words, at most MAX_EPOCHS
    times its size. The flow gives each pattern the words to take: whole epochs of all its
    documents, and of the rest those with the smallest seeded hash of ``key``; rows that share the
    last hash (repeated rows) are numbered as they are written and cut among themselves in the same way. The
    last row is taken if that leaves the sum closer. mix_copies is between 0 and MAX_EPOCHS.

    The cut of a pattern is found in two rounds of sums over 4096 hash ranges, then among the rows
    of one range in 16 million: no pattern, and no group of equal rows, is ever sorted whole.
    Documents of size null count 0; documents without source or
    words are taken 0 times. No rows give no rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("mix_size", "mix_pattern", "mix_copies")
    marked = docs.select(
        "*", F.coalesce(size, F.lit(0)).cast("long").alias("mix_size"),
        F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))).alias("mix_pattern"))
    hashed = F.xxhash64(F.lit(seed), *key)
    slim = materialize(marked.where("mix_size > 0 and size(mix_pattern) > 0")
                       .select("mix_pattern", "mix_size", hashed.alias("h")), "mix")
    patterns = (slim.groupBy("mix_pattern").agg(F.sum("mix_size").alias("words")).orderBy("mix_pattern")
                .limit(MAX_PATTERNS + 1).collect())
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    held = (marked.select(F.explode(F.array_distinct("mix_pattern")).alias("s")).distinct()
            .limit(MAX_PATTERNS + 1).collect())
    if len(held) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    names = sorted((r["s"] for r in held if r["s"] is not None)) + [None] * any(r["s"] is None for r in held)
    place = {s: k for k, s in enumerate(names)}
    members = [[place[s] for s in r["mix_pattern"]] for r in patterns]
    words = [r["words"] for r in patterns]
    sizes = [sum(w for w, m in zip(words, members) if k in m) for k in range(len(names))]
    total = sum(words)
    quotas = water_fill(sizes, weights(names))
    if sum(sizes) > total:  # overlapping sources: shares of the words there are
        quotas = [q * total / sum(sizes) for q in quotas]
    flows = min_cost_flow(words, members, quotas)
    report = [{"source": s, "size": sizes[k], "target": quotas[k], "flow": sum(f.get(k, 0.0) for f in flows)}
              for k, s in enumerate(names)]
    wanted = [(r["mix_pattern"], min(int(sum(f.values()) // w), MAX_EPOCHS), sum(f.values()))
              for r, w, f in zip(patterns, words, flows)]
    wanted = [(p, e, max(0.0, f - e * w) if e < MAX_EPOCHS else 0.0) for (p, e, f), w in zip(wanted, words)]
    plan = spark.createDataFrame(wanted, "mix_pattern array<string>, epochs int, rest double")
    pattern = F.to_json(F.struct("mix_pattern"))
    cuts = _cuts(slim.select(pattern.alias("p"), "mix_size", "h"),
                 plan.select(pattern.alias("p"), "rest")).select("p", F.col("cut").alias("llm_cut"), F.col("rest").alias("llm_rest"))
    wanted = plan.select(pattern.alias("p"), F.col("epochs").alias("llm_epochs")).join(cuts, "p", "left")
    wanted = materialize(wanted.withColumnRenamed("p", "llm_pattern"), "wanted")  # a row a pattern
    placed = (marked.withColumn("llm_hash", hashed).join(F.broadcast(wanted), pattern == F.col("llm_pattern"), "left")
              .withColumn("llm_last", F.coalesce((F.col("llm_hash") == F.col("llm_cut")) & (F.col("mix_size") > 0), F.lit(False))))
    # rows at the cut get numbers that stay, as they are written; a second cut by the hash of the number parts equal rows
    last = materialize(placed.where("llm_last").withColumn("llm_number", F.xxhash64(F.lit(seed), F.monotonically_increasing_id())), "last")
    among = _cuts(last.select(F.col("llm_pattern").alias("p"), "mix_size", F.col("llm_number").alias("h")),
                  wanted.where("llm_cut is not null").select(F.col("llm_pattern").alias("p"), F.col("llm_rest").alias("rest")))
    # the row in which the sum passes the target is taken if that is closer
    closer = (F.col("words") - F.col("rest") < F.col("rest")).alias("llm_closer")
    among = materialize(among.select(F.col("p").alias("llm_among"), F.col("cut").alias("llm_number_cut"), closer), "among")
    last = last.join(F.broadcast(among), F.col("llm_pattern") == F.col("llm_among"), "left").withColumn(
        "llm_more", F.coalesce((F.col("llm_number") < F.col("llm_number_cut")) | ((F.col("llm_number") == F.col("llm_number_cut")) & F.col("llm_closer")), F.lit(False)))
    rest = placed.where(~F.col("llm_last")).withColumn("llm_more", F.coalesce(F.col("llm_hash") < F.col("llm_cut"), F.lit(False)))
    copies = F.when(F.col("mix_size") > 0, F.coalesce("llm_epochs", F.lit(0)) + F.col("llm_more").cast("int")).otherwise(0).alias("mix_copies")
    result = [*columns(docs), F.col("mix_size"), F.col("mix_pattern"), copies]
    return rest.select(*result).unionByName(last.select(*result)), report


def _cuts(rows: DataFrame, want: DataFrame) -> DataFrame:
    """(p, cut, rest, words): per pattern the hash in whose rows the sum of mix_size, by ascending hash, passes ``rest``
    of ``want`` (p, rest), how much of it those rows have to give, and their words; no row if the sum never passes."""
    rest = want
    for shift in (52, 40):
        part = F.shiftright("h", shift)
        sums = (rows.groupBy("p", part.alias("part")).agg(F.sum("mix_size").alias("words"))
                .withColumn("upto", F.sum("words").over(W.partitionBy("p").orderBy("part"))))
        edge = (sums.join(F.broadcast(rest), "p").where("upto - words <= rest and rest < upto")
                .select("p", "part", (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest")))
        edge = materialize(edge, "edge")
        rows = rows.join(F.broadcast(edge.select("p", F.col("part").alias("edge"))), "p").where(part == F.col("edge")).drop("edge")
        rest = edge.select("p", "rest")
    each = rows.groupBy("p", "h").agg(F.sum("mix_size").alias("words"))
    return (each.withColumn("upto", F.sum("words").over(W.partitionBy("p").orderBy("h")))
            .join(F.broadcast(rest), "p").where("upto - words <= rest and rest < upto")
            .select("p", F.col("h").alias("cut"), (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest"), "words"))
