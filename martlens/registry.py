
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlens.params import Params
from martlens.plans.tables import RetailTables

Op = Callable[[RetailTables, Params], DataFrame]


def operators() -> dict[str, Op]:
    from martlens.operators.analytics import customers, orders, products, promos, sales
    ops: dict[str, Op] = {}
    for mod in (sales, customers, products, orders, promos):
        for name in dir(mod):
            if name[:1] == "q" and name[1:3].isdigit():
                ops[name] = getattr(mod, name)
    for extra in _extra_modules():
        ops.update(extra.OPS)
    return dict(sorted(ops.items()))


def _extra_modules():
    import importlib
    mods = []
    for name in ("martlens.operators.analytics.customers", "martlens.operators.views_ops", "martlens.operators.profiling",
                 "martlens.operators.cleaning", "martlens.operators.rules",
                 "martlens.operators.quality", "martlens.operators.brief", "martlens.operators.brief_rollup",
                 "martlens.operators.alerts", "martlens.operators.dq_job", "martlens.streaming.dq_monitor", "martlens.streaming.notify",
                 "martlens.sources.checked", "martlens.operators.quality_state"):
        try:
            mod = importlib.import_module(name)
        except ModuleNotFoundError as e:
            if e.name != name:
                raise
            continue
        if hasattr(mod, "OPS"):
            mods.append(mod)
    return mods


def tables_for(spark: SparkSession, sf_dir: str) -> RetailTables:
    """Tables over the files as they are now: nothing is kept from an earlier call."""
    return RetailTables.from_fixture(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    p = Params.fixture()
    return {k: (lambda spark, sf_dir, op=op: op(tables_for(spark, sf_dir), p))
            for k, op in operators().items()}
