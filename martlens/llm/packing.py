"""Packing: cutting-stock column generation over the histogram of piece lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlens.llm.common import materialize
from martlens.llm.tokens import cut_tokens

SEQUENCE = 2048
END_ID = 1
#: The linear program sees lengths rounded up to a multiple of this.
GRAIN = 4
#: Columns are priced until the bound shows the program within this share of its optimum.
GAP = 1e-3
MAX_COLUMNS = 6000
#: Pieces of one length are numbered in this many parts per shuffle partition.
SALTS = 1


def price_pattern(duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern (copies of each size 1..capacity) by unbounded knapsack."""
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        value = duals[:c] + best[c - 1::-1][:c]
        at = int(value.argmax())
        if value[at] > best[c - 1]:
            best[c], took[c] = value[at], at + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(capacity, dtype=np.int64), capacity
    while c > 0:
        if took[c]:
            pattern[took[c] - 1] += 1
            c -= took[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def solve_patterns(demand: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(patterns, how often each is used) of the linear program: fewest sequences that hold
    ``demand[s - 1]`` pieces of each size s. Revised simplex whose columns are priced by knapsack;
    a pattern only lists sizes with demand."""
    capacity = len(demand)
    kinds = np.flatnonzero(demand > 0)
    if not len(kinds):
        return [], np.zeros(0)
    m = len(kinds)
    basis = [np.zeros(m, dtype=np.int64) for _ in range(m)]
    for k, size in enumerate(kinds):
        basis[k][k] = capacity // (size + 1)
    per = np.array([basis[k][k] for k in range(m)], dtype=np.float64)
    inverse = np.diag(1 / per)
    used = demand[kinds] / per
    slack = [False] * m
    for step in range(MAX_COLUMNS):
        if step % 400 == 399:  # fresh factors against rounding
            inverse = np.linalg.inv(np.array([-b if s else b for b, s in zip(basis, slack)], dtype=np.float64).T)
            used = np.maximum(inverse @ demand[kinds], 0)
        costs = np.array([0.0 if s else 1.0 for s in slack])
        duals = costs @ inverse
        low = int(duals.argmin())
        if duals[low] < -1e-9:  # one piece more than asked for is worth a surplus column
            column, entering, is_slack = -inverse[:, low], np.eye(m, dtype=np.int64)[low], True
        else:
            full = np.full(capacity, -1.0)
            full[kinds] = duals
            value, pattern = price_pattern(full, capacity)
            if value <= 1 + GAP:
                break
            entering, is_slack = pattern[kinds], False
            column = inverse @ entering
        grows = column > 1e-9
        if not grows.any():
            break
        ratio = np.where(grows, used / np.where(grows, column, 1), np.inf)
        leave = int(ratio.argmin())
        amount = ratio[leave]
        used = np.maximum(used - amount * column, 0)
        used[leave] = amount
        inverse[leave] /= column[leave]
        others = np.flatnonzero(np.abs(column) > 1e-12)
        others = others[others != leave]
        inverse[others] -= np.outer(column[others], inverse[leave])
        basis[leave], slack[leave] = entering, is_slack
    out, times = [], []
    for b, s, x in zip(basis, slack, used):
        if not s and x > 1e-9:
            pattern = np.zeros(capacity, dtype=np.int64)
            pattern[kinds] = b
            out.append(pattern)
            times.append(x)
    return out, np.array(times)


def plan_sequences(lengths: dict[int, int], sequence: int = SEQUENCE) -> tuple[np.ndarray, int]:
    """(table, sequences) for pieces shorter than a sequence: rows (length, first rank, copies per
    sequence, first sequence, offset). Piece ``rank`` of a length, from the row with the largest
    first rank not above it, lies in sequence first + d // copies at offset + d % copies * length,
    d = rank - first rank. Patterns are used their whole times; what is left, at most about one
    sequence a pattern, goes best-fit-decreasing."""
    grain = GRAIN if sequence % GRAIN == 0 else 1
    capacity = sequence // grain
    demand = np.zeros(capacity, dtype=np.int64)
    for length, n in lengths.items():
        demand[-(-length // grain) - 1] += n
    patterns, times = solve_patterns(demand)
    left = dict(lengths)
    by_size: dict[int, list[int]] = {}
    for length in sorted(lengths, reverse=True):
        by_size.setdefault(-(-length // grain), []).append(length)
    rows, taken, sequences = [], dict.fromkeys(lengths, 0), 0

    def use(lengths_: list[int], n: int) -> None:
        nonlocal sequences
        offset = 0
        for length in sorted(set(lengths_), reverse=True):
            copies = lengths_.count(length)
            rows.append((length, taken[length], copies, sequences, offset))
            taken[length] += n * copies
            left[length] -= n * copies
            offset += copies * length
        sequences += n

    for pattern, x in sorted(zip(patterns, times), key=lambda p: -p[1]):
        wanted = int(x + 1e-6)
        while wanted > 0:  # a size stands for up to GRAIN lengths: fill the pattern with those that remain
            chosen: list[int] = []
            for at in np.flatnonzero(pattern):
                for _ in range(int(pattern[at])):
                    held = max(by_size.get(int(at) + 1, ()), key=lambda v: left[v] - chosen.count(v), default=None)
                    if held is not None and left[held] > chosen.count(held):
                        chosen.append(held)
            if not chosen:
                break
            n = min([wanted, *(left[v] // chosen.count(v) for v in set(chosen))])
            use(chosen, n)
            wanted -= n
    room: list[list] = []  # the rest, one by one
    gaps: dict[int, list[int]] = {}
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            fit = next((g for g in range(length, sequence + 1) if gaps.get(g)), None)
            at = gaps[fit].pop() if fit is not None else len(room)
            if fit is None:
                room.append([])
                fit = sequence
            room[at].append(length)
            gaps.setdefault(fit - length, []).append(at)
    for chosen in room:
        use(chosen, 1)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5), sequences


def pack(docs: DataFrame, key: Column, text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID,
         keep: dict[str, Column] | None = None, path: str | None = None) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, and the columns of
    ``keep``, expressions over the piece's ``ids`` (``{"ids": F.col("ids")}`` keeps the ids).

    A document is its token ids and the end id, cut every ``sequence`` ids; a null text is empty.
    Whole pieces are sequences of their own. The others are counted by length, the patterns that
    hold them with fewest sequences come from the linear program on that histogram (its size does
    not depend on the rows), and each piece finds its place by its rank among those of its length.
    Ranks are drawn in parts of a length by a hash of the piece, so a length that a third of the
    pieces share is numbered in many tasks. The cut pieces are written once to the shared folder.
    Repeated rows are packed each; which of two equal ones comes first is open. No rows give no rows.
    """
    spark = docs.sparkSession
    pieces = cut_tokens(docs, key, text, sequence, end_id, path)
    extra = keep or {}
    # a number per piece, made once and stored, also tells repeated rows apart
    pieces = materialize(pieces.select("key", "start", "length", "doc_tokens", *[c.alias(n) for n, c in extra.items()],
                                       F.monotonically_increasing_id().alias("piece")), "pieces")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * SALTS
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(F.lit(3), "piece"), F.lit(parts)).cast("int"))
    counts = materialize(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    whole = lengths.pop(sequence, 0)
    table, packed = plan_sequences(lengths, sequence)
    if whole:  # whole pieces come after the packed ones, one a sequence
        table = np.concatenate((table, [[sequence, 0, 1, packed, 0]]))
    starts = counts.withColumn("begin", F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n"))
    rank = F.row_number().over(W.partitionBy("salt", "length").orderBy("piece"))
    ranked = (salted.withColumn("within", rank).join(starts.select("length", "salt", "begin"), ["length", "salt"])
              .withColumn("rank", F.col("begin") + F.col("within") - 1))
    shared = spark.sparkContext.broadcast(table)
    names = ["key", "start", "length", "doc_tokens", *extra]

    def place(batches):
        table = shared.value
        firsts = table[:, 0] * (1 << 40) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(firsts, length * (1 << 40) + rank, side="right") - 1]
            d = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(row[:, 3] + d // row[:, 2]),
                 pa.array(row[:, 4] + d % row[:, 2] * length)], names=[*names, "sequence_id", "offset"])

    fields = [f for f in pieces.schema if f.name != "piece"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
