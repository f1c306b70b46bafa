"""The set of retail tables an operator reads, as lazily built DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlens import schemas

RETAIL = ("customers", "products", "orders", "order_items", "inventory", "customer_reviews",
          "promotions", "promotion_usage", "dq_issues", "data_fix_audit")


class RetailTables:
    """Name -> DataFrame, built on first access and memoised per instance.

    Memoising the DataFrame object (not its data) lets several operators that
    run in one plan share identical sub-plans, so Spark can reuse exchanges.
    """

    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._builders = dict(builders)
        self._cache: dict[str, DataFrame] = {}
        #: Folders of the tables that are stored as they are read: a stream may read them directly.
        self.paths: dict[str, str] = {}
        #: Tables that are computed from others each time they are read.
        self.derived: set[str] = set()

    def store(self, root: str, *names: str) -> None:
        """Write those of the named tables that are derived, in the order given, and read them from their files from
        now on, also where tables that are built later derive from them. Tables that are stored are not copied."""
        from martlens.sources.lake import read_table, write_lake
        for name in names:
            if name in self.derived:
                write_lake(self, root, names=[name])
                self._cache[name] = read_table(self.spark, root, name)
                self.derived.discard(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        return self[name]

    def memo(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived DataFrame built once per table set: operators sharing it then
        share one sub-plan object (cheaper to build, and its exchanges are reused)."""
        memo = self.__dict__.setdefault("_memo", {})
        if key not in memo:
            memo[key] = build()
        return memo[key]

    def replace(self, **dfs: DataFrame) -> "RetailTables":
        """A new table set where some tables are swapped (e.g. healed versions)."""
        out = RetailTables(self.spark, self._builders)
        out._cache = dict(self._cache)
        out._cache.update(dfs)
        out.paths = {k: v for k, v in self.paths.items() if k not in dfs}
        out.derived = self.derived - set(dfs)
        for k, v in dfs.items():
            out._builders[k] = (lambda v=v: v)
        return out

    # ---------------------------------------------------------------- sources
    @staticmethod
    def from_fixture(spark: SparkSession, sf_dir: str) -> "RetailTables":
        from martlens.sources.fixtures import FixtureBuilder
        fb = FixtureBuilder(spark, sf_dir)
        t: RetailTables

        def orders():
            return fb.orders(items=t["order_items"])

        def reviews():
            return fb.customer_reviews(items=t["order_items"], orders=fb.orders_base())

        t = RetailTables(spark, {
            "customers": fb.customers, "products": fb.products, "orders": orders,
            "order_items": fb.order_items, "inventory": fb.inventory,
            "customer_reviews": reviews, "promotions": fb.promotions,
            "promotion_usage": fb.promotion_usage, "dq_issues": fb.dq_issues,
            "data_fix_audit": fb.data_fix_audit,
        })
        t.derived = {"orders", "order_items", "customer_reviews"}
        return t

    @staticmethod
    def from_lake(spark: SparkSession, root: str) -> "RetailTables":
        """Read tables written by ``sources.lake.write_lake`` with fixed schemas."""
        from martlens.sources.lake import read_table, table_path
        t = RetailTables(spark, {n: (lambda n=n: read_table(spark, root, n)) for n in RETAIL})
        t.paths = {n: table_path(root, n) for n in RETAIL}
        return t

    @staticmethod
    def from_catalog(spark: SparkSession, database: str) -> "RetailTables":
        """Read tables written by ``sources.lake.write_catalog`` (bucketed facts)."""
        from martlens.sources.lake import read_catalog
        return RetailTables(spark, {n: (lambda n=n: read_catalog(spark, database, n)) for n in RETAIL})

    @staticmethod
    def from_frames(spark: SparkSession, frames: dict[str, DataFrame]) -> "RetailTables":
        return RetailTables(spark, {n: (lambda df=df: df) for n, df in frames.items()})


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.TABLES[name])
