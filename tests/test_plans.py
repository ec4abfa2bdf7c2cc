"""Plans stay as they should be at scale: what is read, moved and broadcast."""

from __future__ import annotations

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan_of(spark, name: str) -> str:
    """The physical plan with table sizes that rule out size-based broadcasts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        frame = queries()[name](spark, SF)
        return frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_kpis_read_few_columns_of_the_window(spark):
    plan = plan_of(spark, "monthly_kpis")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    # Items and customers play no part in the KPIs.
    assert "l_suppkey" not in plan and "c_custkey" not in plan
    # Orders, payments and reviews move once each, by order; then 60 months.
    assert plan.count("Exchange hashpartitioning(order_id") == 3


def test_detection_leaves_payments_out(spark):
    plan = plan_of(spark, "delivery_issues")
    assert "l_extendedprice" not in plan and "l_linenumber" not in plan
    assert plan.count("Exchange hashpartitioning(order_id") == 2


def test_drill_down_broadcasts_only_the_issue_months(spark):
    for name in ("issue_periods", "issue_states_all", "issue_sellers_all"):
        plan = plan_of(spark, name)
        assert plan.count("BroadcastExchange") == 1, name
        assert "BroadcastHashJoin [purchase_month" in plan
        # The ranking keeps at most the top rows of each issue per task.
        if name != "issue_periods":
            assert plan.count("WindowGroupLimit") == 2


def test_impact_needs_no_child_table(spark):
    plan = plan_of(spark, "issue_impact")
    assert "lineitem" not in plan and "customer.parquet" not in plan


def test_single_sellers_need_no_distinct_count(spark):
    plan = plan_of(spark, "single_seller_orders")
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_order_facts_move_orders_twice_and_no_item_in_copies(spark):
    plan = plan_of(spark, "order_facts")
    assert plan.count("Exchange hashpartitioning(customer_id") == 2
    # Orders; items by product, by seller and by order; payments by word and order; reviews.
    assert plan.count("Exchange hashpartitioning(order_id#") == 7
    assert "Expand" not in plan


def test_payments_are_read_for_the_sequences_and_for_the_records(spark):
    plan = plan_of(spark, "payment_flags")
    assert plan.count("Scan parquet") == 2 and "BroadcastExchange" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:bigint>" in plan or "l_linenumber:int>" in plan


def test_rules_keys_and_references_read_each_table_once(spark):
    for name in ("constraint_report", "dq_report"):
        plan = plan_of(spark, name)
        assert plan.count("lineitem.parquet") == 3  # items, payments and reviews
        assert plan.count("/orders.parquet") == plan.count("/customer.parquet") == 1
        # Beside the counts' own exchanges only the sources' lookups move rows.
        assert plan.count("Exchange hashpartitioning(domain") == 2
