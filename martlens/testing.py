"""Helpers shared by the tests and tools: oracle comparison and micro fixtures."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from pyspark.sql import DataFrame, SparkSession

from martlens import schemas
from martlens.plans.tables import RETAIL, RetailTables

RAW = ("region nation customer supplier part orders lineitem events documents embeddings "
       "pages benchmark labels conversations").split()


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def digest(cols, rows) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir: str):
    import os

    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in RAW:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df: DataFrame, con, sql: str) -> tuple[bool, str]:
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    ok = sorted(df.columns) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
    msg = ""
    if not ok:
        s1, s2 = set(l1), set(l2)
        msg = (f"spark {len(rows)} {sorted(df.columns)} / oracle {len(orows)} {sorted(ocols)}; "
               f"spark-only {sorted(s1 - s2)[:3]} oracle-only {sorted(s2 - s1)[:3]}")
    return ok, msg


def micro_tables(spark: SparkSession, **rows) -> RetailTables:
    """RetailTables from hand rows (tuples in declared column order); absent tables are empty."""
    frames = {}
    for name in RETAIL:
        sch = schemas.TABLES[name]
        if name == "customers" and rows.get(name) and len(rows[name][0]) == len(schemas.CUSTOMERS_ACTIVE):
            sch = schemas.CUSTOMERS_ACTIVE
        frames[name] = spark.createDataFrame(rows.get(name, []), sch)
    return RetailTables.from_frames(spark, frames)
