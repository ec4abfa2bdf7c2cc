from __future__ import annotations

import itertools
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dispatchlens.operators import decision, documents, investigation
from dispatchlens.plans import reports
from dispatchlens.plans.analysis import Analysis, Investigation
from dispatchlens.settings import Settings
from tests.helpers import by
from tests.test_detection import MONTHS, compared

PREVIOUS, CURRENT = date(2018, 1, 1), date(2018, 2, 1)

ORDERS = """issue_id string, previous_month date, current_month date,
    issue_change_pp decimal(20,2), issue_severity string, period_label string,
    purchase_month date, order_id string, is_delivery_kpi_eligible boolean,
    is_handling_time_eligible boolean, is_late_delivery boolean, delivery_days decimal(14,6),
    late_delivery_days decimal(14,6), promise_window_days decimal(14,6),
    approval_to_carrier_days decimal(14,6), carrier_to_customer_days decimal(14,6),
    customer_state string, single_seller_id string, review_record_count bigint,
    average_review_score decimal(10,4)"""


def orders_of(spark, groups):
    """Groups of (period, state, seller, eligible orders, late ones, days)."""
    frames = []
    for n, (period, state, seller, eligible, late, days) in enumerate(groups):
        month = PREVIOUS if period == "previous" else CURRENT
        rows = spark.range(eligible).select(
            F.lit("delivery-2018-02").alias("issue_id"),
            F.lit(PREVIOUS).alias("previous_month"),
            F.lit(CURRENT).alias("current_month"),
            F.lit(Decimal("-9.43")).cast("decimal(20,2)").alias("issue_change_pp"),
            F.lit("High").alias("issue_severity"),
            F.lit(period).alias("period_label"),
            F.lit(month).alias("purchase_month"),
            F.concat(F.lit(f"{n}-"), F.col("id").cast("string")).alias("order_id"),
            F.lit(True).alias("is_delivery_kpi_eligible"),
            F.lit(True).alias("is_handling_time_eligible"),
            (F.col("id") < late).alias("is_late_delivery"),
            F.lit(days).cast("decimal(14,6)").alias("delivery_days"),
            F.lit(0).cast("decimal(14,6)").alias("late_delivery_days"),
            F.lit(20).cast("decimal(14,6)").alias("promise_window_days"),
            F.lit(2).cast("decimal(14,6)").alias("approval_to_carrier_days"),
            F.lit(days).cast("decimal(14,6)").alias("carrier_to_customer_days"),
            F.lit(state).cast("string").alias("customer_state"),
            F.lit(seller).cast("string").alias("single_seller_id"),
            F.lit(1).cast("bigint").alias("review_record_count"),
            F.lit(4).cast("decimal(10,4)").alias("average_review_score"),
        )
        frames.append(rows)
    frame = frames[0]
    for other in frames[1:]:
        frame = frame.unionByName(other)
    return frame


def sellers_of(spark, *ids):
    return spark.createDataFrame([(s, "SP") for s in ids], "seller_id string, seller_state string")


def test_published_impact_and_states(spark):
    """Counts behind the published figures of one issue."""
    groups = [
        ("previous", "RJ", None, 850, 125, 10), ("current", "RJ", None, 879, 316, 16),
        ("previous", "SP", None, 2975, 118, 10), ("current", "SP", None, 2632, 227, 11),
        ("previous", "MG", None, 846, 32, 10), ("current", "MG", None, 790, 83, 10),
        ("previous", "XX", None, 2398, 189, 10), ("current", "XX", None, 2254, 422, 10),
    ]
    orders = orders_of(spark, groups).cache()
    impact = investigation.issue_impact(orders).first()
    assert (impact.previous_late_orders, impact.current_late_orders) == (464, 1048)
    assert (impact.previous_late_rate_pct, impact.current_late_rate_pct) == (
        Decimal("6.56"), Decimal("15.99"),
    )
    assert impact.expected_current_late_orders == Decimal("430.26")
    assert impact.excess_late_orders == Decimal("617.74")
    states = by(investigation.issue_states(orders, Settings()), "customer_state")
    rates = ["previous_on_time_rate_pct", "current_on_time_rate_pct", "on_time_change_pp", "excess_late_orders"]
    got = {s: [str(r[c]) for c in rates] for s, r in states.items() if s != "XX"}
    assert got == {
        "RJ": ["85.29", "64.05", "-21.24", "186.74"],
        "SP": ["96.03", "91.38", "-4.65", "122.60"],
        "MG": ["96.22", "89.49", "-6.73", "53.12"],
    }
    assert states["RJ"].average_delivery_days_change == Decimal("6.00")


def test_minimum_sizes_hold_in_both_periods(spark):
    orders = orders_of(
        spark,
        [
            ("previous", "AA", "a", 50, 0, 1), ("current", "AA", "a", 50, 1, 1),
            ("previous", "BB", "b", 49, 0, 1), ("current", "BB", "b", 80, 9, 1),
            ("previous", "CC", "c", 20, 0, 1), ("current", "CC", "c", 19, 9, 1),
            ("previous", "DD", "d", 20, 0, 1), ("current", "DD", "d", 20, 9, 1),
            ("current", "EE", "e", 90, 9, 1),
        ],
    ).cache()
    states = investigation.issue_states(orders, Settings()).collect()
    assert [r.customer_state for r in states] == ["AA"]
    sellers = investigation.issue_sellers(orders, sellers_of(spark, *"abcde"), Settings())
    assert sorted(r.seller_id for r in sellers.collect()) == ["a", "b", "d"]


def test_ranking_is_signed_and_deterministic(spark):
    groups = []
    for n in range(20):
        state = f"S{n:02d}"
        groups += [("previous", state, state, 60, 10, 1), ("current", state, state, 60, n, 1)]
    # Equal excess: the state with more orders first, then by name.
    groups += [("previous", "TA", "TA", 60, 10, 1), ("current", "TA", "TA", 60, 19, 1)]
    orders = orders_of(spark, groups).cache()
    top = investigation.issue_states(orders, Settings()).orderBy("contributor_rank").collect()
    assert [r.customer_state for r in top][:3] == ["S19", "TA", "S18"]
    assert len(top) == 15 and top[-1].excess_late_orders == Decimal("-4.00")
    # A seller unknown to the seller table does not take a place in the ranking.
    known = sellers_of(spark, *[f"S{n:02d}" for n in range(19)])
    sellers = investigation.issue_sellers(orders, known, Settings()).orderBy("contributor_rank")
    assert [r.seller_id for r in sellers.collect()][0] == "S18"
    assert sellers.count() == 15


def test_all_levels_at_once_equal_each_alone(spark):
    groups = [("previous", None, "a", 30, 3, 10), ("current", None, "a", 40, 9, 12), ("current", "AA", None, 70, 7, 5)]
    groups += [(p, s, q, 60, n, n) for n, (p, s, q) in enumerate(itertools.product(("previous", "current"), "AB", "ab"))]
    orders = orders_of(spark, groups)
    odd = F.col("order_id").endswith("3")
    orders = orders.withColumns(
        {
            "is_delivery_kpi_eligible": ~odd, "is_late_delivery": F.when(~odd, F.col("is_late_delivery")),
            "is_handling_time_eligible": ~F.col("order_id").endswith("4"),
            "review_record_count": F.when(F.col("order_id").endswith("5"), 0).otherwise(1).cast("long"),
        }
    ).cache()
    settings, known = Settings(min_region_orders=1, min_seller_orders=1), sellers_of(spark, "a", "b")
    measured = investigation.drill_down(orders, investigation.LEVELS)
    plan = measured._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
    pairs = [
        (investigation.periods_of(measured), investigation.issue_periods(orders)),
        (investigation.impact_of(measured), investigation.issue_impact(orders)),
        (investigation.coverage_of(measured), investigation.issue_seller_coverage(orders)),
        (investigation.states_of(measured, settings), investigation.issue_states(orders, settings)),
        (investigation.sellers_of(measured, known, settings), investigation.issue_sellers(orders, known, settings)),
    ]
    for fused, alone in pairs:
        assert fused.schema == alone.schema or fused.columns == alone.columns
        assert sorted(map(str, fused.collect())) == sorted(map(str, alone.collect()))
    periods = by(pairs[0][0], "period_label")
    assert periods["current"].all_orders == 350 and periods["previous"].all_orders == 270
    # Groups without a state or a single seller count as a whole and under no name.
    names = {(r.level, r.member) for r in measured.collect()}
    assert {("all", None), ("state", "A"), ("state", None), ("seller", "b"), ("seller", None)} <= names
    assert {r.customer_state for r in pairs[3][0].collect()} == {"A", "B"}
    empty = investigation.drill_down(orders.limit(0), investigation.LEVELS)
    assert investigation.periods_of(empty).count() == investigation.impact_of(empty).count() == 0


def test_changes_round_once_from_unrounded_means(spark):
    # Means 1.004 and 2.0055 differ by 1.0015; their roundings by 1.01.
    orders = orders_of(
        spark,
        [
            ("previous", "AA", "a", 50, 5, "1.004"), ("current", "AA", "a", 50, 5, "2.0055"),
        ],
    )
    row = investigation.issue_states(orders, Settings()).first()
    assert row.average_delivery_days_change == Decimal("1.00")
    periods = by(investigation.issue_periods(orders), "period_label")
    assert periods["current"].average_delivery_days == Decimal("2.01")
    assert periods["previous"].average_delivery_days == Decimal("1.00")


def test_previous_period_without_eligible_orders(spark):
    orders = orders_of(
        spark, [("previous", "AA", "a", 5, 0, 1), ("current", "AA", "a", 5, 2, 1)]
    ).withColumn(
        "is_delivery_kpi_eligible",
        F.col("is_delivery_kpi_eligible") & (F.col("period_label") == "current"),
    )
    impact = investigation.issue_impact(orders).first()
    assert impact.previous_eligible_orders == 0 and impact.current_late_orders == 2
    assert impact.previous_late_rate_pct is None and impact.excess_late_orders is None


def test_a_month_may_be_current_and_previous(spark):
    settings = Settings()
    comparisons = compared(spark, MONTHS)
    schema = """order_id string, order_purchase_timestamp timestamp_ntz, purchase_month date,
        is_delivery_kpi_eligible boolean, is_on_time_delivery boolean,
        order_estimated_delivery_date timestamp_ntz, order_delivered_carrier_date timestamp_ntz,
        order_delivered_customer_date timestamp_ntz"""
    rows = []
    for month in (1, 2, 3, 4):
        day = f"2018-0{month}-05 00:00:00"
        rows.append((f"o{month}", day, date(2018, month, 1), True, month == 1, day, day, day))
    orders = spark.createDataFrame(
        rows, schema.replace("timestamp_ntz", "string")
    ).selectExpr(
        "order_id", "cast(order_purchase_timestamp as timestamp_ntz) order_purchase_timestamp",
        "purchase_month", "is_delivery_kpi_eligible", "is_on_time_delivery",
        "cast(order_estimated_delivery_date as timestamp_ntz) order_estimated_delivery_date",
        "cast(order_delivered_carrier_date as timestamp_ntz) order_delivered_carrier_date",
        "cast(order_delivered_customer_date as timestamp_ntz) order_delivered_customer_date",
    )
    issues = investigation.issue_keys(comparisons)
    got = investigation.investigation_orders(orders, issues, settings).collect()
    roles = sorted((r.order_id, r.issue_id, r.period_label, r.is_late_delivery) for r in got)
    assert roles == [
        ("o1", "delivery-2018-02", "previous", False),
        ("o2", "delivery-2018-02", "current", True),
        ("o2", "delivery-2018-03", "previous", True),
        ("o3", "delivery-2018-03", "current", True),
    ]


@pytest.fixture(scope="module")
def one_issue(spark):
    """An investigation with every kind of result, from one drill-down."""
    groups = []
    for n, state in enumerate(["RJ", "SP", "M|G", "BA"]):
        groups += [
            ("previous", state, f"s{n}", 60, 3, 10), ("current", state, f"s{n}", 60, 30 - 5 * n, 12)
        ]
    groups.append(("current", "ZZ", None, 10, 0, 12))
    analysis = Analysis({}, Settings())
    comparisons = compared(spark, MONTHS)
    analysis.delivery_comparisons = comparisons.filter("current_month = DATE '2018-02-01'")
    analysis.sellers = sellers_of(spark, "s0", "s1", "s2", "s3")
    issues = investigation.issue_keys(analysis.delivery_comparisons)
    measured = investigation.drill_down(orders_of(spark, groups), investigation.LEVELS)
    return Investigation(analysis, issues, measured.cache())


def test_result_contract(spark, one_issue):
    results = one_issue.results()
    investigation.check_results(results)
    with pytest.raises(ValueError, match="holds no rows"):
        investigation.check_results(results | {"states": results["states"].limit(0)})
    with pytest.raises(ValueError, match="expected the results"):
        investigation.check_results({"periods": results["periods"]})
    counts = [f.count() for f in results.values()]
    assert counts == [2, 1, 4, 2, 4]


def test_coverage(one_issue):
    got = by(one_issue.coverage, "period_label")
    current = got["current"]
    assert (current.delivery_eligible_orders, current.single_seller_eligible_orders) == (250, 240)
    assert current.single_seller_coverage_pct == Decimal("96.00")


def test_diagnosis(one_issue):
    row = reports.diagnosis(one_issue).first()
    assert row.issue_severity == "High"
    assert row.delivery_days_change == Decimal("2.00")
    assert row.handling_days_change == Decimal("0.00")
    assert row.stage_diagnosis == "after carrier handoff"
    assert row.promise_diagnosis == "not narrowed"
    assert row.focus_states == "RJ, SP, M|G"
    assert row.late_order_change == 90 - 12
    # Excess: 90 - 250 * 12 / 240 = 77.5; leading states 27 and 22.
    assert row.excess_late_orders == Decimal("77.50")
    assert row.top_two_state_share_pct == Decimal("63.2")


def test_brief_lists_and_escapes(one_issue):
    text = reports.brief(one_issue).first().brief
    assert "Period: January 2018 to February 2018. Severity: High." in text
    assert "On-time change: -9.43 pp (threshold -5 pp). Excess late orders: 77.50." in text
    assert "- concentration: two states (63.2%)" in text
    assert "- look at RJ, SP, M|G\n- compare transit times by route" in text
    assert "delivery dates are estimated" not in text
    assert "| M\\|G | 60 | 20 |" in text
    assert "| Eligible orders | 240 | 250 | +10 |" in text
    assert "| s0 | SP | 60 | 30 |" in text
    assert text == reports.brief(one_issue).first().brief


def test_kpi_table_and_documents(one_issue):
    rows = decision.issue_kpi_table(one_issue.periods).orderBy("metric_number").collect()
    assert [r.metric_number for r in rows] == list(range(1, 9))
    assert rows[1].change == Decimal("-9.43")
    document = reports.overview_document(one_issue).first()
    assert [p.period_label for p in document.periods] == ["previous", "current"]
    assert document.issue.on_time_delivery_change_pp == Decimal("-9.43")
    assert document.impact.current_late_orders == 90
    states = reports.states_document(one_issue).first().states
    assert [s.customer_state for s in states] == ["RJ", "SP", "M|G", "BA"]
    empty = documents.issue_states_document(
        one_issue.analysis.delivery_comparisons, one_issue.states.limit(0)
    )
    assert documents.as_json(empty).first().document.endswith('"states":[]}')
