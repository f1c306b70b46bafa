"""Date ranges over orders that also prune the month partitions of a stored table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.functions.exprs import lit_date

#: Partition column of stored orders: the first day of the order's month.
MONTH = "order_month"


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, F.trunc("order_date", "MM"))


def in_dates(orders: DataFrame, start: dt.date | Column | None = None, before: dt.date | Column | None = None,
             after: dt.date | Column | None = None, on: dt.date | Column | None = None) -> DataFrame:
    """Orders from ``start`` on, ``before`` (not on) a date, ``after`` (not on) a date, ``on`` a date.

    A bound is a date, or a column such as a scalar subquery. If the table has the month as a partition column, the same
    bounds are put on it, rounded to months: other months' files are neither listed for a scan nor opened. Orders
    without a date are in no range."""
    day, month = F.col("order_date"), F.col(MONTH)
    tests = [(start, lambda b: day >= b, lambda m: month >= m), (before, lambda b: day < b, lambda m: month <= m),
             (after, lambda b: day > b, lambda m: month >= m), (on, lambda b: day == b, lambda m: month == m)]
    for bound, exact, rounded in tests:
        if bound is None:
            continue
        fixed = isinstance(bound, dt.date)
        orders = orders.where(exact(lit_date(bound) if fixed else bound))
        if MONTH in orders.columns:
            if fixed and exact is tests[1][1] and bound.day == 1:  # before the first of a month: that month has none
                orders = orders.where(month < lit_date(bound))
            else:
                orders = orders.where(rounded(lit_date(bound.replace(day=1)) if fixed else F.trunc(bound, "MM")))
    return orders
