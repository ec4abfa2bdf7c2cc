"""SQL of the diagnosis and of the brief's tables."""

from __future__ import annotations

from oracle.tables import KEYS

CENT = "/ 100.0::DOUBLE"


def _delta(measure: str) -> str:
    def cents(period: str) -> str:
        return f"CAST(round(max({measure}) FILTER (WHERE period_label = '{period}') * 100) AS BIGINT)"

    return f"({cents('current')} - {cents('previous')}) / 100.0::DOUBLE"


EXCESS_CENTS = "CAST(round(excess_late_orders * 100) AS BIGINT)"
_TOP_TWO_C = f"coalesce(sum({EXCESS_CENTS}) FILTER (WHERE contributor_rank <= 2), 0)"
# Tenths of a percent, half to even.
_TENTHS = "1000 * abs(top_two) // abs(excess)"
_REST = f"2 * (1000 * abs(top_two) - ({_TENTHS}) * abs(excess))"
_SHARE = f"""CASE WHEN excess = 0 THEN 0.0::DOUBLE ELSE
    (CASE WHEN (top_two < 0) <> (excess < 0) THEN -1 ELSE 1 END) * CAST(({_TENTHS})
    + CASE WHEN {_REST} > abs(excess) OR ({_REST} = abs(excess) AND ({_TENTHS}) % 2 = 1)
           THEN 1 ELSE 0 END AS BIGINT) / 10.0::DOUBLE END"""

DIAGNOSIS = f"""
SELECT *, CASE WHEN carrier_days_change >= 1 AND abs(handling_days_change) <= 0.5
        THEN 'after carrier handoff' ELSE 'not isolated' END AS stage_diagnosis,
    CASE WHEN promise_window_change < 0 THEN 'narrowed' ELSE 'not narrowed' END AS promise_diagnosis
FROM (
    SELECT issue_id, previous_month, current_month, issue_change_pp, issue_severity,
        delivery_days_change, handling_days_change, carrier_days_change, promise_window_change,
        review_score_change, late_order_change, eligible_order_change,
        excess {CENT} AS excess_late_orders, {_SHARE} AS top_two_state_share_pct, focus_states
    FROM (SELECT * REPLACE (coalesce(top_two, 0) AS top_two, coalesce(focus_states, '') AS focus_states)
    FROM (SELECT {KEYS}, {_delta("average_delivery_days")} AS delivery_days_change,
            {_delta("average_handling_days")} AS handling_days_change,
            {_delta("average_carrier_to_customer_days")} AS carrier_days_change,
            {_delta("average_promise_window_days")} AS promise_window_change,
            {_delta("average_order_review_score")} AS review_score_change,
            max(late_orders) FILTER (WHERE period_label = 'current')
                - max(late_orders) FILTER (WHERE period_label = 'previous') AS late_order_change,
            max(delivery_eligible_orders) FILTER (WHERE period_label = 'current')
                - max(delivery_eligible_orders) FILTER (WHERE period_label = 'previous')
                AS eligible_order_change
          FROM periods_t GROUP BY ALL HAVING count(*) = 2)
    JOIN (SELECT issue_id, {EXCESS_CENTS} AS excess FROM impact_t) USING (issue_id)
    LEFT JOIN (SELECT issue_id, CAST({_TOP_TWO_C} AS BIGINT) AS top_two,
            string_agg(customer_state, ', ' ORDER BY contributor_rank)
                FILTER (WHERE contributor_rank <= 3) AS focus_states
          FROM states_t GROUP BY issue_id) USING (issue_id)))"""

_KPI_ROWS = [
    ("Eligible orders", "delivery_eligible_orders", "orders"),
    ("On-time rate", "on_time_delivery_rate_pct", "pct"),
    ("Late orders", "late_orders", "orders"),
    ("Days to delivery", "average_delivery_days", "days"),
    ("Days of handling", "average_handling_days", "days"),
    ("Days with the carrier", "average_carrier_to_customer_days", "days"),
    ("Days promised", "average_promise_window_days", "days"),
    ("Review score", "average_order_review_score", "score"),
]


def _kpi_table() -> str:
    def row(number: int, name: str, measure: str, unit: str) -> str:
        value = "CAST(max({m}) FILTER (WHERE period_label = '{p}') AS DOUBLE)"
        change = "issue_change_pp" if unit == "pct" else _delta(measure)
        return (
            f"SELECT {KEYS}, CAST({number} AS BIGINT) AS metric_number, '{name}' AS metric, "
            f"'{unit}' AS unit, {value.format(m=measure, p='previous')} AS previous_value, "
            f"{value.format(m=measure, p='current')} AS current_value, {change} AS change "
            "FROM periods_t GROUP BY ALL HAVING count(*) = 2"
        )

    return " UNION ALL ".join(row(i, *r) for i, r in enumerate(_KPI_ROWS, 1))


KPI_TABLE = _kpi_table()

TOP_ROWS = """
SELECT issue_id, 'state' AS contributor_kind, contributor_rank, customer_state AS contributor,
    customer_state AS contributor_state, current_eligible_orders, current_late_orders,
    on_time_change_pp, excess_late_orders, average_delivery_days_change,
    promise_window_days_change AS stage_days_change
FROM states_t WHERE contributor_rank <= 5
UNION ALL
SELECT issue_id, 'seller', contributor_rank, CAST(seller_id AS VARCHAR), seller_state,
    current_eligible_orders, current_late_orders, on_time_change_pp, excess_late_orders,
    average_delivery_days_change, average_handling_days_change
FROM sellers_ranked_t WHERE contributor_rank <= 5"""
