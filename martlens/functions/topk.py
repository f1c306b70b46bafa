"""A mergeable state of the k smallest rows per group, kept where the rows are.

Spark's ``row_number() <= k`` cuts groups before a shuffle, but a count beside it needs all rows a second
time, or all rows over the network. Here each task folds its rows, batch by batch, into at most k rows a
group and one total a group; only these are shuffled, merged by the same rule in two more steps. A row that
stands for several equal ones has a weight; equal rows are one row whose weights are summed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.session import ship_package


def _k_smallest(rows: pa.Table, group: str, order: list[str], weight: str, k: int) -> pa.Table:
    """The k smallest distinct rows of each group with their weights summed; nulls last."""
    keys = [group, *order]
    rows = rows.group_by(keys, use_threads=False).aggregate([(weight, "sum")]).rename_columns([*keys, weight])
    rows = rows.sort_by([(c, "ascending") for c in keys])
    own = rows.column(group).to_numpy()
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    return rows.filter(pa.array(place < k))


def fold(batches: Iterable[pa.RecordBatch], group: str, order: list[str], weight: str, k: int) -> Iterator[pa.RecordBatch]:
    """One task's state: at most k rows a group, and after them a row a group with is_total and the weight of all."""
    held: pa.Table | None = None
    totals: dict[int, int] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.table({c: batch.column(c) for c in [group, *order, weight]})
        for g, n in zip(*(c.to_pylist() for c in rows.group_by(group, use_threads=False).aggregate([(weight, "sum")]).select([group, f"{weight}_sum"]).columns)):
            totals[g] = totals.get(g, 0) + n
        rows = rows if held is None else pa.concat_tables([held, rows])
        held = _k_smallest(rows, group, order, weight, k).combine_chunks()
    if held is None:
        return
    ends = pa.table({group: pa.array(list(totals), held.schema.field(group).type), weight: pa.array(list(totals.values()), pa.int64())})
    for rows, total in ((held, False), (ends, True)):
        full = [rows.column(c) if c in rows.column_names else pa.nulls(rows.num_rows, held.schema.field(c).type) for c in [group, *order, weight]]
        out = pa.table(full, names=[group, *order, weight]).append_column("is_total", pa.array([total] * rows.num_rows))
        yield from out.combine_chunks().to_batches()


def smallest_and_total(df: DataFrame, group: str, order: list[str], weight: str, k: int) -> DataFrame:
    """(group, total, top): the summed weight of each group, and its k smallest rows as an array of
    (rn, the ``order`` columns, weight) in order, nulls last.

    ``group`` is an integer column without nulls, ``weight`` a bigint, and ``order`` names every other column
    that tells rows apart. A task sends at most k rows and one total a group; rows are produced once,
    however the input is partitioned."""
    ship_package(df.sparkSession)
    cols = [group, *order, weight]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(cols).schema.fields)
    state = df.select(cols).mapInArrow(lambda batches: fold(batches, group, order, weight, k), f"{fields}, is_total boolean")
    merged = state.groupBy(group, "is_total", *order).agg(F.sum(weight).alias(weight))
    # the total is the first row of its group: k + 1 rows a group and task reach the last step
    place = Window.partitionBy(group).orderBy(F.desc("is_total"), *[F.col(c).asc_nulls_last() for c in order])
    ranked = merged.withColumn("rn", F.row_number().over(place)).where(F.col("rn") <= k + 1)
    row = F.when(~F.col("is_total"), F.struct((F.col("rn") - 1).alias("rn"), *order, weight))
    return ranked.groupBy(group).agg(F.max(F.when(F.col("is_total"), F.col(weight))).alias("total"),
                                     F.array_sort(F.collect_list(row)).alias("top"))
