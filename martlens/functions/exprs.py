"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F



def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def net_amount(q="quantity", p="unit_price", d="discount_percent", coalesce_discount=False) -> Column:
    """quantity * unit_price * (1 - discount/100), exact, DECIMAL with 2 places.

    With ``coalesce_discount`` a NULL discount counts as 0 (healing math);
    otherwise a NULL discount yields NULL (view math).
    """
    disc = F.coalesce(c(d), F.lit(0)) if coalesce_discount else c(d)
    hundredths = c(q).cast("bigint") * c(p) * (F.lit(100) - disc)
    return hundredths.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def discount_amount(q="quantity", p="unit_price", d="discount_percent", coalesce_discount=False) -> Column:
    """quantity * unit_price * discount/100, exact DECIMAL with 2 places."""
    disc = F.coalesce(c(d), F.lit(0)) if coalesce_discount else c(d)
    return (c(q).cast("bigint") * c(p) * disc).cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def gross_amount(q="quantity", p="unit_price") -> Column:
    return c(q).cast("bigint") * c(p)


def dbl(x) -> Column:
    return c(x).cast("double")


def rnd(x, n: int) -> Column:
    """ROUND(x, n), half away from zero, returned as DOUBLE.

    The value is first fixed to 9 decimal places and then rounded as a
    decimal, so an exact tie such as 0.125 (a ratio of two exact numbers)
    rounds up as PostgreSQL's NUMERIC does, independent of how the double
    happens to approximate it.
    """
    return F.round(c(x).cast("double").cast("decimal(38,9)"), n).cast("double")


def ratio(num, den) -> Column:
    """num / NULLIF(den, 0) as double (no ANSI divide-by-zero error)."""
    den_d = c(den).cast("double")
    return F.when(den_d != 0, c(num).cast("double") / den_d)


def pg_concat(*parts) -> Column:
    """PostgreSQL CONCAT: NULL arguments are treated as empty strings."""
    return F.concat(*[F.coalesce(c(p).cast("string"), F.lit("")) for p in parts])


def pg_dow(d) -> Column:
    """EXTRACT(DOW): Sunday=0 .. Saturday=6."""
    return F.dayofweek(c(d)) - 1


def day_name(d) -> Column:
    """Full English weekday name (TO_CHAR(d,'Day') with padding stripped)."""
    return F.date_format(c(d), "EEEE")


def month_start(d) -> Column:
    return F.trunc(c(d), "MM")


def age_month_number(later, earlier) -> Column:
    """EXTRACT(MONTH FROM AGE(later, earlier)) + 1 for 0 <= AGE < 1 year."""
    later, earlier = c(later), c(earlier)
    months = ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
              - F.when(F.dayofmonth(later) < F.dayofmonth(earlier), 1).otherwise(0))
    return (months % 12) + 1


def lit_ts(ts: dt.datetime) -> Column:
    """Wall-clock timestamp literal (TIMESTAMP_NTZ): no session or process zone applies."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
