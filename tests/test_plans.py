"""Physical-plan properties the operators are designed for."""

import tempfile

import pytest

from martlens.operators import quality
from martlens.operators.analytics import customers, products, sales
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake

SF = "/root/testdata/sf0.001"
P = Params.fixture()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake_tables(spark):
    root = tempfile.mkdtemp(prefix="martlens-lake-")
    lake.write_lake(RetailTables.from_fixture(spark, SF), root)
    return RetailTables.from_lake(spark, root)


def test_date_filter_and_pruning_reach_scan(spark, lake_tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(sales.q01_monthly_revenue(lake_tables, P))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in text
    assert "ReadSchema: struct<order_date:date,final_total:decimal(18,2)>" in text


def test_first_two_orders_limit_before_shuffle(spark, lake_tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(customers.q08_days_to_second(lake_tables, P))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the partial limit runs map-side, below the shuffle on customer_id
    partial = text.index("row_number(), 2, Partial")
    shuffle = text.index("Exchange hashpartitioning(customer_id")
    assert shuffle < partial


def test_best_seller_group_limit(spark, lake_tables):
    assert "WindowGroupLimit" in plan(products.q15_best_seller(lake_tables, P))


def test_check_samples_are_bounded(spark, lake_tables):
    text = plan(quality.dq_run_all(lake_tables, P))
    assert "WindowGroupLimit" in text
    assert "CartesianProduct" not in text


def test_no_cartesian_in_questions(spark, lake_tables):
    from martlens.registry import operators
    for key, op in operators().items():
        if key.startswith("q"):
            assert "CartesianProduct" not in plan(op(lake_tables, P)), key


def test_bucketed_facts_join_without_shuffle(spark):
    from martlens.operators import cleaning
    loc = tempfile.mkdtemp(prefix="martlens-cat-")
    lake.write_catalog(RetailTables.from_fixture(spark, SF), "martlens_test_cat", loc, 4,
                       names=["orders", "order_items"])
    t = RetailTables.from_catalog(spark, "martlens_test_cat")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(cleaning.heal_order_totals(t, P))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def _non_equi_joins_bounded(jplan):
    """Yield (bounded, description) for every join without equality keys."""
    stack = [jplan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Join":
            cond = node.condition()
            has_equi = cond.isDefined() and "=" in cond.get().sql() and " = " in cond.get().sql()
            if not has_equi:
                sides = [node.left().maxRows(), node.right().maxRows()]
                bounded = any(s.isDefined() and s.get() <= 1 for s in sides)
                yield bounded, node.simpleString(200)
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))


def test_joins_without_keys_have_a_one_row_side(spark, lake_tables):
    from martlens.registry import operators
    for key, op in operators().items():
        if key.startswith(("stream_", "snk_")) or key in ("fn_run_checks", "b28_from_rollups", "dq_run_incremental", "rule_checked_write", "alter_add_column"):  # these write
            continue
        jplan = op(lake_tables, P)._jdf.queryExecution().optimizedPlan()
        for bounded, desc in _non_equi_joins_bounded(jplan):
            assert bounded, (key, desc)


def test_building_the_brief_runs_no_job(spark, lake_tables):
    from martlens.operators.brief import OPS
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("brief-build", "brief")
    try:
        for op in OPS.values():
            op(lake_tables, P)
        assert len(tracker.getJobIdsForGroup("brief-build")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_brief_row_follows_changed_files(spark):
    from martlens.operators.brief import b28_brief_row
    root = tempfile.mkdtemp(prefix="martlens-brief-")
    lake.write_lake(RetailTables.from_fixture(spark, SF), root)
    first = b28_brief_row(RetailTables.from_lake(spark, root), P).collect()[0]
    lake.write_lake(RetailTables.from_fixture(spark, SF).replace(
        orders=RetailTables.from_fixture(spark, SF).orders.filter("order_id % 2 = 0")), root, names=["orders"])
    second = b28_brief_row(RetailTables.from_lake(spark, root), P).collect()[0]
    assert second.top_status_count < first.top_status_count
