"""Shared SQL: the derived tables, the cleaned tables and the drill-down.

Rates and means are rounded with integers only (half away from zero on the exact
quotient), so they do not depend on how an engine divides decimals.
"""

from __future__ import annotations

import re

WINDOW_START, WINDOW_END = "TIMESTAMP '1996-01-01'", "TIMESTAMP '2001-01-01'"
MIN_REGION, MIN_SELLER, TOP = 2, 1, 15


def ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    """numerator / denominator of integers, rounded half away from zero."""
    n, d, scale = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**digits
    return (
        f"(CASE WHEN {d} = 0 OR {n} IS NULL THEN NULL ELSE "
        f"CAST((CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * "
        f"((2 * {scale} * abs({n}) + {d}) // (2 * {d})) AS BIGINT) / {float(scale)!r}::DOUBLE END)"
    )


def pct(part: str, whole: str) -> str:
    return ratio(f"100 * ({part})", whole)


def mean_days(value: str, where: str = "TRUE") -> str:
    """Mean of a micro-day column over the rows that satisfy ``where``."""
    kept = f"FILTER (WHERE ({where}) AND {value} IS NOT NULL)"
    return ratio(f"(sum({value}) {kept})", f"1000000 * (count(*) {kept})")


def mean_days_change(value: str, where: str = "TRUE", unit: int = 1_000_000) -> str:
    """Change of the exact mean between the periods, rounded once."""

    def part(function: str, period: str) -> str:
        return (
            f"CAST({function} FILTER (WHERE ({where}) AND {value} IS NOT NULL "
            f"AND period_label = '{period}') AS HUGEINT)"
        )

    s1, s0 = part(f"sum({value})", "current"), part(f"sum({value})", "previous")
    n1, n0 = part("count(*)", "current"), part("count(*)", "previous")
    return ratio(f"({s1} * {n0} - {s0} * {n1})", f"{unit} * {n1} * {n0}")


def _micro_days(later: str, earlier: str) -> str:
    us = f"(epoch_us({later}) - epoch_us({earlier}))"
    return (
        f"(CASE WHEN {us} < 0 THEN -1 ELSE 1 END) * ((2 * abs({us}) + 86400) // 172800)"
    )


def _shift(base: str, seconds: str) -> str:
    return f"{base} + to_seconds({seconds})"


def _double(micro: str) -> str:
    return f"{micro} / 1000000.0::DOUBLE"


def _place(prefix: str, table: str, key: str, nation: str, factor: int, city: str) -> str:
    return f"""
    SELECT {key} AS {prefix}_id, CAST(({factor} * {key}) % 100000 AS INTEGER) AS zip,
           {city} AS city, n_name AS state
    FROM {table} LEFT JOIN nation ON n_nationkey = {nation}"""


TABLES: dict[str, str] = {
    "customers_t": f"""
    SELECT *, CASE WHEN customer_id % 10 = 1 THEN customer_id - 1 ELSE customer_id END AS person
    FROM ({_place("customer", "customer", "c_custkey", "c_nationkey", 37, "c_mktsegment")})""",
    "sellers_t": _place("seller", "supplier", "s_suppkey", "s_nationkey", 131, "s_name"),
    "items_t": """
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c,
           CASE WHEN l_tax = 0 THEN 0 ELSE CAST(round(l_quantity * 100) AS BIGINT) END AS freight_c
    FROM lineitem""",
    "payments_t": """
    SELECT l_orderkey AS order_id, l_linenumber AS seq,
           CASE l_linenumber % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'boleto'
                WHEN 2 THEN 'voucher' WHEN 3 THEN 'debit_card' ELSE 'not_defined' END AS kind,
           CAST(l_quantity AS INTEGER) % 4 AS installments,
           CASE WHEN l_linenumber % 5 = 2 AND l_discount = 0 THEN 0
                ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS value_c
    FROM lineitem""",
    "reviews_t": """
    SELECT l_partkey AS review_id, l_orderkey AS order_id, 1 + l_partkey % 5 AS score,
           CASE WHEN l_returnflag = 'R' THEN 'Returned' END AS title,
           CASE WHEN l_returnflag <> 'N' THEN 'line status ' || l_linestatus END AS message,
           l_shipdate AS created, l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS answered
    FROM lineitem""",
    "products_t": """
    SELECT p_partkey AS product_id, CASE WHEN p_size <> 50 THEN p_type END AS category,
           length(p_name) AS name_length, 10 * length(p_name) AS description_length,
           p_partkey % 6 AS photos, 100 * (p_size - 1) AS weight, p_size AS len,
           CAST(round(p_retailprice * 100) AS BIGINT) / 100.0::DOUBLE AS height,
           p_size % 7 - 1 AS width
    FROM part""",
    "translation_t": """
    SELECT category, lower(category) AS english FROM (
        SELECT DISTINCT p_type AS category FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')
        UNION ALL SELECT r_name FROM region)""",
    "products_c": """
    SELECT p.*, coalesce(t.english, CASE WHEN p.category = 'PROMO' THEN 'promo' END) AS english,
           CASE WHEN p.category IS NULL THEN 'missing' WHEN t.english IS NOT NULL THEN 'official'
                WHEN p.category = 'PROMO' THEN 'manual' END AS source
    FROM products_t p LEFT JOIN translation_t t ON t.category = p.category""",
    "orders_t": f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
             WHEN o_orderkey % 2 = 0 THEN 'shipped' ELSE 'canceled' END AS status,
        o_orderdate AS purchase,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL
             ELSE {_shift("o_orderdate", "a * 86400 + (31 * o_orderkey) % 86400")} END AS approved,
        CASE WHEN o_orderkey % 53 = 0 THEN o_orderdate - INTERVAL 1 DAY
             WHEN o_orderkey % 127 = 0 THEN NULL
             ELSE {_shift("o_orderdate", "(a + h) * 86400 + (97 * o_orderkey + o_custkey) % 86400")}
             END AS carrier,
        CASE WHEN o_orderstatus NOT IN ('F', 'O') OR o_orderkey % 211 = 0 THEN NULL
             WHEN o_orderkey % 71 = 0 THEN o_orderdate - INTERVAL 2 DAY
             ELSE {_shift("o_orderdate", "(a + h + t + s) * 86400 + (89 * o_orderkey + 13 * o_custkey) % 86400")}
             END AS customer,
        CASE WHEN o_orderkey % 307 = 0 THEN o_orderdate - INTERVAL 1 DAY
             ELSE {_shift("o_orderdate", "(16 + o_custkey % 5) * 86400")} END AS promised
    FROM (SELECT *, o_orderkey % 3 AS a, 1 + (7 * o_orderkey + o_custkey) % 5 AS h,
                 3 + (13 * o_orderkey + 5 * o_custkey) % 12 AS t,
                 CASE WHEN month(o_orderdate) IN (2, 8, 11)
                      THEN (o_orderkey + o_custkey) % 14 ELSE 0 END AS s
          FROM orders)""",
    "flags_t": f"""
    SELECT *, CAST(date_trunc('month', purchase) AS DATE) AS month,
        coalesce(purchase >= {WINDOW_START} AND purchase < {WINDOW_END}, FALSE) AS in_window,
        status = 'delivered' AND (approved IS NULL OR carrier IS NULL OR customer IS NULL)
            AS missing_stamp,
        status = 'delivered' AND (coalesce(approved < purchase, FALSE)
            OR coalesce(carrier < purchase, FALSE) OR coalesce(carrier < approved, FALSE)
            OR coalesce(customer < purchase, FALSE) OR coalesce(customer < carrier, FALSE)
            OR coalesce(promised < purchase, FALSE)) AS chronology,
        status = 'delivered' AND coalesce(customer >= purchase AND promised >= purchase, FALSE)
            AS eligible,
        coalesce(approved >= purchase AND carrier >= purchase AND carrier >= approved
            AND (customer IS NULL OR customer >= carrier), FALSE) AS handled
    FROM orders_t""",
    "timed_t": f"""
    SELECT *, CASE WHEN eligible THEN customer <= promised END AS on_time,
        CASE WHEN eligible THEN {_micro_days("customer", "purchase")} END AS days_m,
        CASE WHEN eligible THEN {_micro_days("customer", "promised")} END AS delay_m,
        CASE WHEN eligible THEN greatest({_micro_days("customer", "promised")}, 0) END AS late_m,
        CASE WHEN handled THEN {_micro_days("carrier", "approved")} END AS handling_m,
        CASE WHEN eligible THEN {_micro_days("promised", "purchase")} END AS promise_m,
        CASE WHEN customer >= carrier THEN {_micro_days("customer", "carrier")} END AS transport_m
    FROM flags_t""",
    "item_sums": """
    SELECT order_id, count(*) AS item_count, count(DISTINCT product_id) AS product_count,
           count(DISTINCT seller_id) AS seller_count, sum(price_c) AS price_c,
           sum(freight_c) AS freight_c, min(seller_id) AS seller_id
    FROM items_t GROUP BY order_id""",
    "sequences": """
    SELECT order_id, count(*) AS n, min(seq) AS lo, max(seq) AS hi, count(DISTINCT seq) AS seen
    FROM payments_t GROUP BY order_id""",
    "payment_sums": """
    SELECT order_id, count(*) AS records, sum(value_c) AS value_c,
           bool_or(installments <= 0) AS bad_installment, bool_or(value_c = 0) AS zero_value,
           min(seq) > 1 AS start_missing,
           count(DISTINCT seq) <> max(seq) - min(seq) + 1 AS gap
    FROM payments_t GROUP BY order_id""",
    "review_sums": f"""
    SELECT order_id, count(*) AS records,
           CAST(round({ratio("sum(score)", "count(*)", 4)} * 10000) AS BIGINT) AS score_m
    FROM reviews_t GROUP BY order_id""",
    "facts_t": """
    SELECT o.*, c.person, c.city, c.state, coalesce(i.item_count, 0) AS item_count,
        coalesce(i.product_count, 0) AS product_count, coalesce(i.seller_count, 0) AS seller_count,
        i.price_c, i.freight_c, coalesce(p.records, 0) AS payment_records, p.value_c,
        coalesce(p.bad_installment, FALSE) AS bad_installment,
        coalesce(p.zero_value, FALSE) AS zero_value,
        coalesce(p.start_missing, FALSE) AS start_missing, coalesce(p.gap, FALSE) AS gap,
        i.order_id IS NOT NULL AS has_items, p.order_id IS NOT NULL AS has_payment,
        coalesce(r.records, 0) AS review_records, r.score_m,
        CASE WHEN i.seller_count = 1 THEN i.seller_id END AS single_seller
    FROM timed_t o LEFT JOIN customers_t c USING (customer_id)
    LEFT JOIN item_sums i USING (order_id) LEFT JOIN payment_sums p USING (order_id)
    LEFT JOIN review_sums r USING (order_id)""",
    "kpis_t": f"""
    SELECT month AS purchase_month, count(*) AS order_count,
        count(*) FILTER (WHERE payment_records > 0) AS orders_with_payment_records,
        CAST(sum(value_c) AS BIGINT) / 100.0::DOUBLE AS recorded_payment_value,
        {ratio("sum(value_c) FILTER (WHERE payment_records > 0)",
               "100 * count(value_c) FILTER (WHERE payment_records > 0)")} AS average_order_value,
        count(*) FILTER (WHERE eligible) AS delivery_kpi_order_count,
        count(*) FILTER (WHERE eligible AND on_time) AS on_time_delivery_count,
        {pct("count(*) FILTER (WHERE eligible AND on_time)", "count(*) FILTER (WHERE eligible)")}
            AS on_time_delivery_rate_pct,
        {mean_days("days_m", "eligible")} AS average_delivery_days,
        count(*) FILTER (WHERE review_records > 0) AS reviewed_order_count,
        {ratio("sum(score_m) FILTER (WHERE review_records > 0)",
               "10000 * count(score_m) FILTER (WHERE review_records > 0)")}
            AS average_order_review_score
    FROM facts_t WHERE in_window GROUP BY month""",
}

_COMPARED = [
    "order_count", "delivery_kpi_order_count", "on_time_delivery_count",
    "on_time_delivery_rate_pct", "average_delivery_days", "reviewed_order_count",
    "average_order_review_score",
]


def _change(column: str) -> str:
    """Difference of two values with two digits, exact."""
    return f"(CAST(round({column} * 100) AS BIGINT) - CAST(round(p_{column} * 100) AS BIGINT)) / 100.0::DOUBLE"


TABLES["lagged_t"] = f"""
    SELECT *, lag(purchase_month) OVER w AS previous_month,
        {", ".join(f"lag({c}) OVER w AS p_{c}" for c in _COMPARED)}
    FROM kpis_t WINDOW w AS (ORDER BY purchase_month)"""
TABLES["comparison_t"] = f"""
    SELECT purchase_month AS current_month, previous_month,
        previous_month = CAST(purchase_month - INTERVAL 1 MONTH AS DATE) AS is_consecutive_month,
        {pct("order_count - p_order_count", "p_order_count")} AS order_volume_change_pct,
        {", ".join(f"{c} AS current_{c}, p_{c} AS previous_{c}" for c in _COMPARED)},
        {_change("on_time_delivery_rate_pct")} AS on_time_delivery_change_pp,
        {_change("average_delivery_days")} AS average_delivery_days_change,
        {_change("average_order_review_score")} AS average_review_score_change
    FROM lagged_t WHERE previous_month IS NOT NULL"""
TABLES["comparisons_t"] = """
    SELECT *, is_consecutive_month AND on_time_delivery_change_pp <= -5.0 AS is_delivery_issue,
        CASE WHEN is_consecutive_month AND on_time_delivery_change_pp <= -8.0 THEN 'High'
             WHEN is_consecutive_month AND on_time_delivery_change_pp <= -5.0 THEN 'Moderate'
             END AS issue_severity
    FROM comparison_t"""
TABLES["issues_t"] = """
    SELECT 'delivery-' || strftime(current_month, '%Y-%m') AS issue_id, previous_month,
        current_month, on_time_delivery_change_pp AS issue_change_pp, issue_severity,
        row_number() OVER (ORDER BY on_time_delivery_change_pp,
            current_delivery_kpi_order_count DESC, current_month) AS severity_rank
    FROM comparisons_t WHERE is_delivery_issue"""
TABLES["inv_t"] = """
    SELECT i.issue_id, i.previous_month, i.current_month, i.issue_change_pp, i.issue_severity,
        CASE WHEN f.month = i.previous_month THEN 'previous' ELSE 'current' END AS period_label,
        CASE WHEN f.eligible THEN NOT f.on_time END AS late, f.*
    FROM facts_t f JOIN issues_t i ON f.month IN (i.previous_month, i.current_month)"""
KEYS = "issue_id, previous_month, current_month, issue_change_pp, issue_severity"
TABLES["periods_t"] = f"""
    SELECT {KEYS}, period_label, count(*) AS all_orders,
        count(*) FILTER (WHERE eligible) AS delivery_eligible_orders,
        count(*) FILTER (WHERE eligible AND late) AS late_orders,
        {pct("count(*) FILTER (WHERE eligible AND NOT late)", "count(*) FILTER (WHERE eligible)")}
            AS on_time_delivery_rate_pct,
        {mean_days("days_m", "eligible")} AS average_delivery_days,
        {mean_days("late_m", "eligible AND late")} AS average_late_days_among_late_orders,
        {mean_days("promise_m", "eligible")} AS average_promise_window_days,
        count(*) FILTER (WHERE handled) AS handling_eligible_orders,
        {mean_days("handling_m", "handled")} AS average_handling_days,
        count(transport_m) AS carrier_transport_eligible_orders,
        {mean_days("transport_m")} AS average_carrier_to_customer_days,
        count(*) FILTER (WHERE review_records > 0) AS reviewed_orders,
        {ratio("sum(score_m) FILTER (WHERE review_records > 0)",
               "10000 * count(score_m) FILTER (WHERE review_records > 0)")}
            AS average_order_review_score,
        min(month) AS period_month
    FROM inv_t GROUP BY ALL"""


def _late_counts(where: str = "TRUE") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE eligible AND period_label = '{p}') AS {p}_eligible_orders, "
        f"count(*) FILTER (WHERE eligible AND late AND period_label = '{p}') AS {p}_late_orders"
        for p in ("previous", "current")
    )


_EXCESS = ratio(
    "CAST(current_late_orders AS HUGEINT) * previous_eligible_orders "
    "- CAST(current_eligible_orders AS HUGEINT) * previous_late_orders",
    "previous_eligible_orders",
)
TABLES["impact_t"] = f"""
    SELECT {KEYS}, previous_eligible_orders, previous_late_orders,
        {pct("previous_late_orders", "previous_eligible_orders")} AS previous_late_rate_pct,
        current_eligible_orders, current_late_orders,
        {pct("current_late_orders", "current_eligible_orders")} AS current_late_rate_pct,
        {ratio("CAST(current_eligible_orders AS HUGEINT) * previous_late_orders",
               "previous_eligible_orders")} AS expected_current_late_orders,
        {_EXCESS} AS excess_late_orders
    FROM (SELECT {KEYS}, {_late_counts()} FROM inv_t GROUP BY ALL)"""


def _contributors(group: str, extra: str, source: str, minimum: int, select: str) -> str:
    return f"""
    SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY excess_late_orders DESC,
               current_eligible_orders DESC, {group}) AS contributor_rank
    FROM (
        SELECT {KEYS}, {select}, previous_eligible_orders, current_eligible_orders,
            previous_rate AS previous_on_time_rate_pct, current_rate AS current_on_time_rate_pct,
            (CAST(round(current_rate * 100) AS BIGINT) - CAST(round(previous_rate * 100) AS BIGINT))
                / 100.0::DOUBLE AS on_time_change_pp,
            current_late_orders, excess_late_orders, {", ".join(extra.split())}
        FROM (SELECT *, {pct("previous_eligible_orders - previous_late_orders", "previous_eligible_orders")} AS previous_rate,
                     {pct("current_eligible_orders - current_late_orders", "current_eligible_orders")} AS current_rate,
                     {_EXCESS} AS excess_late_orders
              FROM ({source})
              WHERE previous_eligible_orders >= {minimum} AND current_eligible_orders >= {minimum}) g
        {"JOIN sellers_t s USING (seller_id)" if group == "seller_id" else ""})
    QUALIFY contributor_rank <= {TOP}"""


TABLES["states_t"] = _contributors(
    "customer_state",
    "average_delivery_days_change promise_window_days_change",
    f"""SELECT {KEYS}, state AS customer_state, {_late_counts()},
            {mean_days_change("days_m", "eligible")} AS average_delivery_days_change,
            {mean_days_change("promise_m", "eligible")} AS promise_window_days_change
        FROM inv_t GROUP BY ALL""",
    MIN_REGION,
    "customer_state",
)
TABLES["coverage_t"] = f"""
    SELECT {KEYS}, period_label, count(*) FILTER (WHERE eligible) AS delivery_eligible_orders,
        count(*) FILTER (WHERE eligible AND single_seller IS NOT NULL)
            AS single_seller_eligible_orders,
        {pct("count(*) FILTER (WHERE eligible AND single_seller IS NOT NULL)",
             "count(*) FILTER (WHERE eligible)")} AS single_seller_coverage_pct,
        min(month) AS period_month
    FROM inv_t GROUP BY ALL"""
TABLES["sellers_ranked_t"] = _contributors(
    "seller_id",
    "average_handling_days_change average_delivery_days_change average_review_score_change",
    f"""SELECT {KEYS}, single_seller AS seller_id, {_late_counts()},
            {mean_days_change("handling_m", "handled")} AS average_handling_days_change,
            {mean_days_change("days_m")} AS average_delivery_days_change,
            {mean_days_change("score_m", "review_records > 0", 10_000)} AS average_review_score_change
        FROM inv_t WHERE eligible AND single_seller IS NOT NULL GROUP BY ALL""",
    MIN_SELLER,
    "seller_id, s.state AS seller_state",
)


def sql(body: str) -> str:
    """``body`` preceded by the shared tables it needs, in their order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in words & TABLES.keys() - needed:
            needed.add(name)
            todo.append(TABLES[name])
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in TABLES if n in needed)
    return f"WITH {ctes}\n{body}"
