"""Join helpers.

Broadcast policy: only relations with a proven bound get an explicit broadcast
hint (one-row scalar aggregates, the <= 18-row check metadata).  Everything else is left to the planner: AQE converts a sort-merge join
to a broadcast join at runtime only when the measured shuffle side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join stays a
shuffle join, and AQE skew handling splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (global agg, no GROUP BY) to
    every row. The right side is exactly one row, so the broadcast is bounded."""
    return df.crossJoin(F.broadcast(one_row))
