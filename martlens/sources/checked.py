"""Rules evaluated while a table is written: one pass gives the table, the breach counts and the quarantined rows.

Every row is tested against the row rules of its table as it is written. Rows that break none go to the ``accepted``
partition, the others, with the names of the rules they break, to the other one; counts per rule are observed in the
same pass (``Observation``), so the input is read once. The counts and the folder are committed as a version: readers
see a load whole or not at all, and a load with more breaches than allowed is not committed.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from martlens import schemas
from martlens.operators.rules import ACCEPTED_RULES, CHECK_RULES, NOT_NULL_RULES, OUT
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.session import work_dir
from martlens.sources import lake, versions

ROW_RULES = [*NOT_NULL_RULES, *CHECK_RULES, *ACCEPTED_RULES]


class TooManyBreaches(ValueError):
    """The load was written, but not committed."""


@dataclasses.dataclass(frozen=True)
class Load:
    version: int
    rows: int
    quarantined: int
    breaches: dict[str, int]


def write_checked(df: DataFrame, root: str, table: str, rules: list | None = None, most_quarantined: int | None = None) -> Load:
    """Write ``df`` as a load of ``table``, testing the row rules of that table on the way.

    A rule that is NULL for a row passes, as a CHECK does. ``most_quarantined``: with more quarantined rows the load
    is not committed."""
    rules = [r for r in (ROW_RULES if rules is None else rules) if r.tbl == table]
    tests = [(f"{rule}:{col}", F.coalesce(bad, F.lit(False)), value) for bad, rule, col, value in (r.hit() for r in rules)]
    key = F.col(schemas.PRIMARY_KEYS[table]).cast("string")
    hits = [F.when(bad, F.struct(F.lit(name.split(":")[0]).alias("rule"), F.lit(table).alias("tbl"), F.lit(name.split(":")[1]).alias("col"),
                                 key.alias("row_key"), value.cast("string").alias("value"))) for name, bad, value in tests]
    none = F.array().cast("array<struct<rule:string,tbl:string,col:string,row_key:string,value:string>>")
    tested = df.withColumn("_breaches", F.array_compact(F.array(*hits)) if hits else none)
    tested = tested.withColumn("accepted", F.size("_breaches") == 0)
    seen = Observation(f"load-{uuid.uuid4().hex}")
    counted = tested.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("accepted")).alias("quarantined"),
                             *[F.count_if(bad).alias(f"breach {k}") for k, (_, bad, _) in enumerate(tests)])
    folder = versions.new_folder(root)
    counted.write.partitionBy("accepted").parquet(folder)
    found = seen.get
    counts = {name: int(found[f"breach {k}"]) for k, (name, _, _) in enumerate(tests)}
    rows, quarantined = int(found["rows"]), int(found["quarantined"])
    if most_quarantined is not None and quarantined > most_quarantined:
        raise TooManyBreaches(f"{table}: {quarantined} of {rows} rows break rules: {counts}")
    entry = versions.commit(df.sparkSession, root, lambda _: {"data": folder.rsplit("/", 1)[1], "schema": df.schema.json(), "rows": rows,
                                                               "quarantined": quarantined, "breaches": counts})
    return Load(entry["version"], rows, quarantined, counts)


def _part(spark: SparkSession, root: str, accepted: bool) -> tuple[DataFrame, dict]:
    found = versions.current(spark, root)
    schema = versions.schema_of(found)
    breach = StructType([StructField(c, StringType()) for c in OUT])
    stored = spark.read.schema(schema.add("_breaches", ArrayType(breach)).add("accepted", BooleanType())).parquet(f"{root}/{found['data']}")
    return stored.where(F.col("accepted") == F.lit(accepted)), found


def read_accepted(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the current load that break no rule."""
    return _part(spark, root, True)[0].drop("_breaches", "accepted")


def read_quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The other rows, with the rules they break in ``_breaches``."""
    return _part(spark, root, False)[0].drop("accepted")


def breaches(spark: SparkSession, root: str) -> DataFrame:
    """One row a breach, as ``rules.validate`` gives them."""
    return read_quarantined(spark, root).select(F.explode("_breaches").alias("b")).select(*[F.col(f"b.{c}").alias(c) for c in OUT])


def rule_checked_write(t: RetailTables, p: Params) -> DataFrame:
    """Products, order items, reviews and promotions written through their rules: per table and rule what was counted
    on the way, and how many breaches the quarantined rows hold."""
    spark, out = t.spark, None
    for table in ("products", "order_items", "customer_reviews", "promotions"):
        root = work_dir(spark, f"checked-{table}-{uuid.uuid4().hex[:12]}")
        load = write_checked(lake.conform(t[table], table), root, table)
        counted = spark.createDataFrame([(table, *name.split(":"), n, load.rows, load.quarantined) for name, n in load.breaches.items()],
                                        "tbl string, rule string, col string, n_counted bigint, n_rows bigint, n_quarantined bigint")
        held = breaches(spark, root).groupBy("rule", "col").agg(F.count(F.lit(1)).alias("n_held"))
        part = counted.join(F.broadcast(held), ["rule", "col"], "left").select(  # a row a rule
            "tbl", "rule", "col", "n_counted", F.coalesce("n_held", F.lit(0)).cast("bigint").alias("n_held"), "n_rows", "n_quarantined")
        out = part if out is None else out.unionByName(part)
    return out


OPS = {"rule_checked_write": rule_checked_write}
