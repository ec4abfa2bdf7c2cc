"""SQL of the nested documents and of the text brief."""

from __future__ import annotations

from oracle.diagnosis import DIAGNOSIS, KPI_TABLE, TOP_ROWS


def _struct(fields: str) -> str:
    """Struct of columns; ``name:m`` is a measure with two digits."""
    parts = []
    for field in fields.split():
        name, _, kind = field.partition(":")
        parts.append(f"'{name}': {f'CAST({name} AS DECIMAL(20, 2))' if kind else name}")
    return "{" + ", ".join(parts) + "}"


_ISSUE = _struct(
    """previous_month current_month current_order_count current_delivery_kpi_order_count
    current_on_time_delivery_count current_on_time_delivery_rate_pct:m
    previous_on_time_delivery_rate_pct:m on_time_delivery_change_pp:m
    current_average_delivery_days:m average_delivery_days_change:m
    current_average_order_review_score:m average_review_score_change:m"""
)
_ISSUES = f"""(SELECT 'delivery-' || strftime(current_month, '%Y-%m') AS issue_id, {_ISSUE} AS issue
    FROM comparisons_t WHERE is_delivery_issue)"""

_PERIOD = _struct(
    """period_label all_orders delivery_eligible_orders late_orders on_time_delivery_rate_pct:m
    average_delivery_days:m average_late_days_among_late_orders:m average_promise_window_days:m
    handling_eligible_orders average_handling_days:m carrier_transport_eligible_orders
    average_carrier_to_customer_days:m reviewed_orders average_order_review_score:m"""
)
_IMPACT = _struct(
    """previous_eligible_orders previous_late_orders previous_late_rate_pct:m
    current_eligible_orders current_late_orders current_late_rate_pct:m
    expected_current_late_orders:m excess_late_orders:m"""
)
_RATES = """previous_eligible_orders current_eligible_orders previous_on_time_rate_pct:m
    current_on_time_rate_pct:m on_time_change_pp:m current_late_orders excess_late_orders:m"""
_STATE = _struct(
    f"customer_state {_RATES} average_delivery_days_change:m promise_window_days_change:m"
)
_COVERAGE = _struct(
    """period_label delivery_eligible_orders single_seller_eligible_orders
    single_seller_coverage_pct:m"""
)
_SELLER = _struct(
    f"""seller_id seller_state {_RATES} average_handling_days_change:m
    average_delivery_days_change:m average_review_score_change:m"""
)


def _array(name: str, struct: str, table: str, order: str) -> str:
    return (
        f"LEFT JOIN (SELECT issue_id, list({struct} ORDER BY {order}) AS {name} "
        f"FROM {table} GROUP BY issue_id) USING (issue_id)"
    )


OVERVIEW_DOCUMENT = f"""
SELECT issue_id, CAST(to_json({{'issue': issue, 'periods': coalesce(periods, []), 'impact': impact}})
    AS VARCHAR) AS document
FROM {_ISSUES} {_array("periods", _PERIOD, "periods_t", "period_month")}
LEFT JOIN (SELECT issue_id, {_IMPACT} AS impact FROM impact_t) USING (issue_id)"""

STATES_DOCUMENT = f"""
SELECT issue_id, CAST(to_json({{'issue': issue, 'states': coalesce(states, [])}}) AS VARCHAR) AS document
FROM {_ISSUES} {_array("states", _STATE, "states_t", "contributor_rank")}"""

SELLERS_DOCUMENT = f"""
SELECT issue_id, CAST(to_json({{'issue': issue, 'coverage': coalesce(coverage, []),
    'sellers': coalesce(sellers, [])}}) AS VARCHAR) AS document
FROM {_ISSUES} {_array("coverage", _COVERAGE, "coverage_t", "period_month")}
{_array("sellers", _SELLER, "sellers_ranked_t", "contributor_rank")}"""


def _number(value: str, digits: int = 2) -> str:
    if digits == 0:
        return f"format('{{:,}}', CAST({value} AS BIGINT))"
    return f"format('{{:,.{digits}f}}', {value})"


def _signed(value: str, digits: int = 2, suffix: str = "") -> str:
    return f"(CASE WHEN {value} > 0 THEN '+' ELSE '' END || {_number(value, digits)} || '{suffix}')"


def _line(*cells: str) -> str:
    texts = [f"coalesce(replace({c}, '|', '\\|'), 'n/a')" for c in cells]
    return "'| ' || " + " || ' | ' || ".join(texts) + " || ' |'"


_BREAK = "chr(10)"


def _table(*header: str) -> str:
    first, second = " | ".join(header), " | ".join("---" for _ in header)
    return f"'| {first} |' || {_BREAK} || '| {second} |'"


def _or_na(value: str) -> str:
    return f"coalesce({value}, 'n/a')"


def _value(column: str) -> str:
    return (
        f"CASE unit WHEN 'orders' THEN {_number(column, 0)} WHEN 'pct' THEN {_number(column)} || '%' "
        f"ELSE {_number(column)} END"
    )


_KPI_LINE = _line(
    "metric",
    _value("previous_value"),
    _value("current_value"),
    f"""CASE unit WHEN 'orders' THEN {_signed("change", 0)} WHEN 'pct' THEN {_signed("change", 2, " pp")}
        WHEN 'days' THEN {_signed("change", 2, " days")} ELSE {_signed("change")} END""",
)
_COMMON = [
    _number("current_eligible_orders", 0),
    _number("current_late_orders", 0),
    _signed("on_time_change_pp", 2, " pp"),
    _number("excess_late_orders"),
]
_DELIVERY = _signed("average_delivery_days_change", 2, " days")
_STAGE = _signed("stage_days_change", 2, " days")
_STATE_LINE = _line("contributor", *_COMMON, _DELIVERY, _STAGE)
_SELLER_LINE = _line("contributor", "contributor_state", *_COMMON, _STAGE, _DELIVERY)


def _lines(name: str, line: str, source: str, order: str) -> str:
    return (
        f"LEFT JOIN (SELECT issue_id, string_agg({line}, {_BREAK} ORDER BY {order}) AS {name} "
        f"FROM ({source}) GROUP BY issue_id) USING (issue_id)"
    )


_FINDINGS = f"""'- stage: ' || stage_diagnosis
    || ' (carrier ' || {_or_na(_signed("carrier_days_change", 2, " days"))}
    || ', handling ' || {_or_na(_signed("handling_days_change", 2, " days"))} || ')' || {_BREAK}
    || '- promise: ' || promise_diagnosis
    || ' (' || {_or_na(_signed("promise_window_change", 2, " days"))} || ')' || {_BREAK}
    || '- concentration: '
    || CASE WHEN coalesce(top_two_state_share_pct, 0) >= 50 THEN 'two states' ELSE 'spread' END
    || ' (' || {_or_na(_number("top_two_state_share_pct", 1))} || '%)' || {_BREAK}
    || '- reviews: ' || {_or_na(_signed("review_score_change"))}"""
_ACTIONS = f"""CASE WHEN coalesce(top_two_state_share_pct, 0) >= 50 THEN '- look at ' || focus_states
        ELSE '- sample late orders of all states' END
    || CASE WHEN stage_diagnosis = 'after carrier handoff'
        THEN {_BREAK} || '- compare transit times by route' ELSE '' END
    || CASE WHEN promise_diagnosis = 'narrowed'
        THEN {_BREAK} || '- check how delivery dates are estimated' ELSE '' END
    || CASE WHEN single_seller_coverage_pct < 90
        THEN {_BREAK} || '- attribute orders of several sellers first' ELSE '' END"""
_PARAGRAPHS = [
    "'# Delivery issue brief'",
    "'Period: ' || strftime(previous_month, '%B %Y') || ' to ' || strftime(current_month, '%B %Y') "
    "|| '. Severity: ' || issue_severity || '.'",
    f"'On-time change: ' || {_or_na(_signed('issue_change_pp', 2, ' pp'))} "
    f"|| ' (threshold -5 pp). Excess late orders: ' || {_or_na(_number('excess_late_orders'))} || '.'",
    "'## Measures'",
    f"{_table('Measure', 'Previous', 'Current', 'Change')} || coalesce({_BREAK} || kpi_lines, '')",
    "'## States'",
    f"{_table('State', 'Eligible', 'Late', 'On-time', 'Excess late', 'Delivery', 'Promise')} "
    f"|| coalesce({_BREAK} || state_lines, '')",
    "'## Sellers'",
    f"'Single-seller coverage: ' || {_or_na(_number('single_seller_coverage_pct'))} || '%.'",
    f"{_table('Seller', 'State', 'Eligible', 'Late', 'On-time', 'Excess late', 'Handling', 'Delivery')} "
    f"|| coalesce({_BREAK} || seller_lines, '')",
    "'## Findings'",
    _FINDINGS,
    "'## To do'",
    _ACTIONS,
    "'Least eligible orders in both months: 2 per state, 1 per seller.'",
]

BRIEF = f"""
SELECT issue_id, current_month, {f" || {_BREAK} || {_BREAK} || ".join(_PARAGRAPHS)} AS brief
FROM ({DIAGNOSIS})
{_lines("kpi_lines", _KPI_LINE, KPI_TABLE, "metric_number")}
{_lines("state_lines", _STATE_LINE, f"SELECT * FROM ({TOP_ROWS}) WHERE contributor_kind = 'state'", "contributor_rank")}
{_lines("seller_lines", _SELLER_LINE, f"SELECT * FROM ({TOP_ROWS}) WHERE contributor_kind = 'seller'", "contributor_rank")}
LEFT JOIN (SELECT issue_id, single_seller_coverage_pct FROM coverage_t WHERE period_label = 'current')
    USING (issue_id)"""
