"""One SQL statement per registered query, with the same column names."""

from __future__ import annotations

from oracle.documents import (
    BRIEF,
    OVERVIEW_DOCUMENT,
    SELLERS_DOCUMENT,
    STATES_DOCUMENT,
)
from oracle.diagnosis import DIAGNOSIS, EXCESS_CENTS, KPI_TABLE, TOP_ROWS
from oracle.fingerprints import repeated_run
from oracle.tables import KEYS, TOP, WINDOW_END, WINDOW_START, ratio, sql

_ISSUE_ROW = """previous_month, current_month, current_order_count,
    current_delivery_kpi_order_count, current_on_time_delivery_count,
    current_on_time_delivery_rate_pct, previous_on_time_delivery_rate_pct,
    on_time_delivery_change_pp, current_average_delivery_days, average_delivery_days_change,
    current_average_order_review_score, average_review_score_change"""

_CENT = "/ 100.0::DOUBLE"
_MICRO = "/ 1000000.0::DOUBLE"

_ORDER_COLUMNS = f"""status AS order_status, purchase AS order_purchase_timestamp,
    approved AS order_approved_at, carrier AS order_delivered_carrier_date,
    customer AS order_delivered_customer_date, promised AS order_estimated_delivery_date,
    in_window AS is_primary_analysis_window, missing_stamp AS has_missing_operational_timestamp,
    chronology AS has_operational_chronology_issue, eligible AS is_delivery_kpi_eligible,
    on_time AS is_on_time_delivery, days_m {_MICRO} AS delivery_days,
    delay_m {_MICRO} AS delivery_delay_days, late_m {_MICRO} AS late_delivery_days,
    handled AS is_handling_time_eligible, handling_m {_MICRO} AS approval_to_carrier_days"""

_ITEM_COLUMNS = f"""CAST(order_id AS VARCHAR) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
    CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
    shipping_limit_date, price_c {_CENT} AS price, freight_c {_CENT} AS freight_value,
    (price_c + freight_c) {_CENT} AS item_total"""

# The columns of the cleaned tables that are fingerprinted.
CLEAN_COLUMNS = {
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
        "freight_value", "item_total",
    ],
    "payments": [
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
        "is_invalid_installment", "is_zero_value_payment", "payment_sequence_start_missing",
        "payment_sequence_internal_gap",
    ],
    "reviews": [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
}

_SCORE = "score_m / 10000.0::DOUBLE AS average_review_score"


_WINDOW_MONTHS = "(SELECT count(DISTINCT date_trunc('month', purchase)) FROM timed_t WHERE in_window)"


def _long(table: str, metrics: dict[str, str], where: str = "TRUE") -> str:
    """(metric, value) rows from one table."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST({expression} AS BIGINT) AS value FROM {table} WHERE {where}"
        for name, expression in metrics.items()
    )


def _count(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


# Text tables: keys, full column lists and null conditions of the raw files.
_RAW = {
    "customers": (
        "customers_t",
        {
            "customer_id": "customer_id",
            "customer_unique_id": "person",
            "customer_zip_code_prefix": "zip",
            "customer_city": "CASE WHEN state NOT IN ('NATION_0', 'NATION_7', 'NATION_5') THEN city END",
            "customer_state": "state",
        },
        ["customer_id"],
    ),
    "orders": (
        "orders_t",
        {
            "order_id": "order_id",
            "customer_id": "customer_id",
            "order_status": "status",
            "order_purchase_timestamp": "purchase",
            "order_approved_at": "approved",
            "order_delivered_carrier_date": "carrier",
            "order_delivered_customer_date": "customer",
            "order_estimated_delivery_date": "promised",
        },
        ["order_id"],
    ),
    "order_items": (
        "items_t",
        {
            c: c
            for c in (
                "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            )
        }
        | {"price": "price_c", "freight_value": "freight_c"},
        ["order_id", "order_item_id"],
    ),
    "products": (
        "products_t",
        {
            "product_id": "product_id",
            "product_category_name": "category",
            "product_name_lenght": "name_length",
            "product_description_lenght": "description_length",
            "product_photos_qty": "photos",
            "product_weight_g": "weight",
            "product_length_cm": "len",
            "product_height_cm": "height",
            "product_width_cm": "width",
        },
        ["product_id"],
    ),
    "sellers": (
        "sellers_t",
        {
            "seller_id": "seller_id",
            "seller_zip_code_prefix": "zip",
            "seller_city": "city",
            "seller_state": "state",
        },
        ["seller_id"],
    ),
    "payments": (
        "payments_t",
        {
            "order_id": "order_id",
            "payment_sequential": "seq",
            "payment_type": "kind",
            "payment_installments": "installments",
            "payment_value": "value_c",
        },
        ["order_id", "payment_sequential"],
    ),
    "reviews": (
        "reviews_t",
        {
            "review_id": "review_id",
            "order_id": "order_id",
            "review_score": "score",
            "review_comment_title": "title",
            "review_comment_message": "message",
            "review_creation_date": "created",
            "review_answer_timestamp": "answered",
        },
        ["review_id", "order_id"],
    ),
    "category_translation": (
        "translation_t",
        {"product_category_name": "category", "product_category_name_english": "english"},
        ["product_category_name"],
    ),
}


def _raw_select(name: str) -> str:
    table, columns, _ = _RAW[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table}"


def _table_profile() -> str:
    parts = []
    for name, (_, columns, key) in _RAW.items():
        missing = " OR ".join(f"{k} IS NULL" for k in key)
        keys, everything = ", ".join(key), ", ".join(columns)
        parts.append(f"""
        SELECT '{name}' AS table_name, row_count, CAST({len(columns)} AS BIGINT) AS column_count,
            missing_key_rows, row_count - keys AS duplicate_key_rows,
            row_count - variants AS exact_duplicate_rows,
            CASE WHEN missing_key_rows = 0 AND row_count = keys THEN 'OK' ELSE 'FAIL' END AS status
        FROM (SELECT count(*) AS row_count, count(*) FILTER (WHERE {missing}) AS missing_key_rows,
                (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ({_raw_select(name)}))) AS keys,
                (SELECT count(*) FROM (SELECT DISTINCT {everything} FROM ({_raw_select(name)}))) AS variants
              FROM ({_raw_select(name)}))""")
    return " UNION ALL ".join(parts)


def _missing_values() -> str:
    parts = [
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, "
        f"{_count(f'({expression}) IS NULL')} AS missing FROM {table}"
        for name, (table, columns, _) in _RAW.items()
        for column, expression in columns.items()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE missing > 0"


_NUMERIC = {
    "order_items": ["price", "freight_value"],
    "products": ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "payments": ["payment_sequential", "payment_installments", "payment_value"],
    "reviews": ["review_score"],
}
_STAMPS = {
    "orders": list(_RAW["orders"][1])[3:],
    "order_items": ["shipping_limit_date"],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}
_ENTRY_ERRORS = {
    ("order_items", "freight_value"): "freight_c = 0",
    ("payments", "payment_installments"): "kind = 'not_defined'",
    ("orders", "order_approved_at"): "status = 'canceled'",
    ("orders", "order_delivered_carrier_date"): "day(carrier) = 1",
}


def _invalid_values() -> str:
    parts = []
    for kind, columns in (("number", _NUMERIC), ("timestamp", _STAMPS)):
        for table, names in columns.items():
            for name in names:
                bad = _ENTRY_ERRORS.get((table, name), "FALSE")
                parts.append(
                    f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
                    f"'{kind}' AS expected_type, {_count(bad)} AS invalid FROM {_RAW[table][0]}"
                )
    return " UNION ALL ".join(parts)


def _key_violations() -> str:
    parts = []
    for name, (_, _, key) in _RAW.items():
        missing = " OR ".join(f"{k} IS NULL" for k in key)
        parts.append(f"""
        SELECT '{name}' AS table_name, '{", ".join(key)}' AS key_columns,
            CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS missing_key_rows,
            CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_key_rows
        FROM (SELECT {", ".join(key)}, count(*) AS n FROM ({_raw_select(name)}) GROUP BY ALL)""")
    return " UNION ALL ".join(parts)


_RULES = [
    ("order_items", "price is positive", "items_t", "price_c <= 0"),
    ("order_items", "freight is not negative", "items_t", "freight_c < 0"),
    ("payments", "sequence starts at one", "payments_t", "seq < 1"),
    ("payments", "value is not negative", "payments_t", "value_c < 0"),
    ("reviews", "score lies between one and five", "reviews_t", "score NOT BETWEEN 1 AND 5"),
]


def _rule_violations() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, {_count(bad)} AS failing FROM {source}"
        for t, rule, source, bad in _RULES
    )


_RELATIONS = [
    ("orders.customer_id -> customers.customer_id", "orders_t", "customer_id", "customers_t"),
    ("order_items.order_id -> orders.order_id", "items_t", "order_id", "orders_t"),
    ("order_items.product_id -> products.product_id", "items_t", "product_id", "products_t"),
    ("order_items.seller_id -> sellers.seller_id", "items_t", "seller_id", "sellers_t"),
    ("payments.order_id -> orders.order_id", "payments_t", "order_id", "orders_t"),
    ("reviews.order_id -> orders.order_id", "reviews_t", "order_id", "orders_t"),
]


def _fk_orphans() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS relationship, count(DISTINCT c.{key}) AS orphan_keys FROM {child} c "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
        for name, child, key, parent in _RELATIONS
    )


_CHILDREN = {"items": "items_t", "payments": "payments_t", "reviews": "reviews_t"}
_MEASURED = {
    "product_weight_g": ("weight", 4),
    "product_length_cm": ("len", 0),
    "product_height_cm": ("height", 0),
    "product_width_cm": ("width", 0),
}


def _measurement_profile() -> str:
    parts = [
        f"SELECT '{name}' AS column_name, {_count(f'{c} IS NULL')} AS missing, "
        f"{_count(f'{c} = 0')} AS zero, {_count(f'{c} < 0')} AS negative, "
        f"{_count(f'{c} <= 0')} AS non_positive, CAST({n} AS BIGINT) AS expected_non_positive, "
        f"{_count(f'{c} <= 0')} = {n} AS as_expected FROM products_t"
        for name, (c, n) in _MEASURED.items()
    ]
    anywhere = " OR ".join(f"coalesce({c} <= 0, FALSE)" for c, _ in _MEASURED.values())
    parts.append(
        "SELECT 'any measurement', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), "
        f"CAST(NULL AS BIGINT), {_count(anywhere)}, CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN) "
        "FROM products_t"
    )
    return " UNION ALL ".join(parts)


_CATEGORY_COVERAGE = """
SELECT category, CASE WHEN category = 'PROMO' THEN 'manual mapping' ELSE 'unexpected' END AS finding
FROM (SELECT DISTINCT category FROM products_t WHERE category IS NOT NULL)
WHERE category NOT IN (SELECT category FROM translation_t)
UNION ALL
SELECT category, 'unused' FROM translation_t
WHERE category NOT IN (SELECT category FROM products_t WHERE category IS NOT NULL)"""


def _dq_report() -> str:
    findings = " UNION ALL ".join(
        [
            f"SELECT 'key is present' AS check_name, table_name AS subject, missing_key_rows AS failing FROM ({_key_violations()})",
            f"SELECT 'key is unique', table_name, duplicate_key_rows FROM ({_key_violations()})",
            f"SELECT 'parent exists', relationship, orphan_keys FROM ({_fk_orphans()})",
            f"SELECT rule, table_name, failing FROM ({_rule_violations()})",
            "SELECT 'non-positive measurements are as known', column_name, "
            f"abs(non_positive - expected_non_positive) FROM ({_measurement_profile()}) "
            "WHERE expected_non_positive IS NOT NULL",
            f"SELECT 'categories are translated', 'products', {_count('finding = ' + repr('unexpected'))} FROM ({_CATEGORY_COVERAGE})",
        ]
    )
    return f"""
    SELECT check_name, subject, CAST(failing AS BIGINT) AS failing,
        CASE WHEN failing = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM ({findings})
    UNION ALL
    SELECT 'overall', 'all', {_count("failing > 0")},
        CASE WHEN {_count("failing > 0")} = 0 THEN 'OK' ELSE 'FAIL' END FROM ({findings})"""


def _row_conditions() -> dict[str, tuple[str, dict[str, str]]]:
    """Per table its source and, per row rule, the condition that must not be false."""

    def length(column: str, size: int = 3) -> str:
        return f"length(CAST({column} AS VARCHAR)) = {size}"

    required = {
        "customers": {
            "customer_id": "customer_id", "customer_unique_id": "person",
            "customer_zip_code_prefix": "zip", "customer_city": "city", "customer_state": "state",
        },
        "products": {"product_id": "product_id", "category_translation_source": "source"},
        "sellers": {
            "seller_id": "seller_id", "seller_zip_code_prefix": "zip", "seller_city": "city",
            "seller_state": "state",
        },
        "orders": {
            "order_id": "order_id", "customer_id": "customer_id", "order_status": "status",
            "order_purchase_timestamp": "purchase", "order_estimated_delivery_date": "promised",
            "has_order_items": "has_items", "has_payment": "has_payment",
            "is_primary_analysis_window": "in_window",
            "has_missing_operational_timestamp": "missing_stamp",
            "has_operational_chronology_issue": "chronology",
            "is_delivery_kpi_eligible": "eligible", "is_handling_time_eligible": "handled",
        },
        "order_items": {
            "order_id": "order_id", "order_item_id": "order_item_id", "product_id": "product_id",
            "seller_id": "seller_id", "shipping_limit_date": "shipping_limit_date",
            "price": "price_c", "freight_value": "freight_c", "item_total": "price_c + freight_c",
        },
        "payments": {
            "order_id": "order_id", "payment_sequential": "seq", "payment_type": "kind",
            "payment_installments": "installments", "payment_value": "value_c",
            "is_invalid_installment": "installments <= 0", "is_zero_value_payment": "value_c = 0",
            "payment_sequence_start_missing": "seq", "payment_sequence_internal_gap": "seq",
        },
        "reviews": {
            "review_id": "review_id", "order_id": "order_id", "review_score": "score",
            "review_creation_date": "created", "review_answer_timestamp": "answered",
        },
    }
    measured = "on_time IS NOT NULL AND days_m IS NOT NULL AND delay_m IS NOT NULL AND late_m IS NOT NULL"
    unmeasured = "on_time IS NULL AND days_m IS NULL AND delay_m IS NULL AND late_m IS NULL"
    rules = {
        "customers": {
            "customer_id length": length("customer_id"),
            "customer_unique_id length": length("person"),
            "zip code range": "zip BETWEEN 0 AND 99999",
            "state length": "length(trim(state)) = 8",
        },
        "products": {
            "product_id length": length("product_id"),
            "product_name_length not negative": "name_length >= 0",
            "product_description_length not negative": "description_length >= 0",
            "product_photos_qty not negative": "photos >= 0",
            **{
                f"{name} positive": f"CASE WHEN {c} > 0 THEN TRUE END"
                for name, (c, _) in _MEASURED.items()
            },
            "translation source code": "source IN ('official', 'manual', 'missing')",
            "translation source fits category":
                "(source = 'missing' AND category IS NULL AND english IS NULL) OR "
                "(source IN ('official', 'manual') AND category IS NOT NULL AND english IS NOT NULL)",
        },
        "sellers": {
            "seller_id length": length("seller_id"),
            "zip code range": "zip BETWEEN 0 AND 99999",
            "state length": "length(trim(state)) = 8",
        },
        "orders": {
            "order_id length": length("order_id"),
            "customer_id length": length("customer_id"),
            "status code": "status IN ('created', 'approved', 'invoiced', 'processing', 'shipped', "
            "'delivered', 'unavailable', 'canceled')",
            "window flag": f"in_window = (purchase >= {WINDOW_START} AND purchase < {WINDOW_END})",
            "missing timestamp flag": "missing_stamp = (status = 'delivered' AND "
            "(approved IS NULL OR carrier IS NULL OR customer IS NULL))",
            "chronology flag only if delivered": "NOT chronology OR status = 'delivered'",
            "eligibility is justified": "NOT eligible OR (status = 'delivered' AND customer IS NOT NULL "
            "AND promised IS NOT NULL AND customer >= purchase AND promised >= purchase)",
            "delivery measures fit eligibility":
                f"(eligible AND {measured}) OR (NOT eligible AND {unmeasured})",
            "on-time flag": "on_time = (customer <= promised)",
            "delivery days not negative": "days_m >= 0",
            "late days not negative": "late_m >= 0",
            "handling time fits eligibility": "(handled AND handling_m IS NOT NULL AND handling_m >= 0) "
            "OR (NOT handled AND handling_m IS NULL)",
        },
        "order_items": {
            "order_id length": length("order_id"),
            "product_id length": length("product_id"),
            "seller_id length": length("seller_id"),
            "item number from one": "order_item_id >= 1",
            "price positive": "price_c > 0",
            "freight not negative": "freight_c >= 0",
            "total adds up": "total_c = price_c + freight_c",
        },
        "payments": {
            "order_id length": length("order_id"),
            "sequence from one": "seq >= 1",
            "payment type code": "kind IN ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')",
            "installments not negative": "installments >= 0",
            "value not negative": "value_c >= 0",
            "installment flag": "unpaid = (installments <= 0)",
            "zero value flag": "worthless = (value_c = 0)",
        },
        "reviews": {
            "review_id length": length("review_id"),
            "order_id length": length("order_id"),
            "score range": "score BETWEEN 1 AND 5",
        },
    }
    sources = {
        "customers": "customers_t", "products": "products_c", "sellers": "sellers_t",
        "orders": "facts_t",
        "order_items": "(SELECT *, CAST(round((price_c / 100.0 + freight_c / 100.0) * 100) AS BIGINT) "
        "AS total_c FROM items_t)",
        "payments": "(SELECT *, installments < 1 AS unpaid, NOT (value_c > 0 OR value_c < 0) AS worthless "
        "FROM payments_t)",
        "reviews": "reviews_t",
    }
    return {
        table: (
            source,
            {f"{n} required": f"({e}) IS NOT NULL" for n, e in required[table].items()} | rules[table],
        )
        for table, source in sources.items()
    }


def _quarantined_rows() -> str:
    parts = []
    for table, (source, conditions) in _row_conditions().items():
        key = ", ".join(_RAW[table][1][c] for c in _RAW[table][2])
        named = ", ".join(
            f"CASE WHEN NOT coalesce({condition}, TRUE) THEN '{rule}' END"
            for rule, condition in conditions.items()
        )
        parts.append(
            f"SELECT '{table}' AS table_name, concat_ws('|', {key}) AS row_key, "
            f"concat_ws('; ', {named}) AS failed_rules FROM {source}"
        )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE failed_rules <> ''"


def _constraints() -> str:
    parts = []
    for table, (source, conditions) in _row_conditions().items():
        for rule, condition in conditions.items():
            parts.append(
                f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
                f"{_count(f'NOT coalesce({condition}, TRUE)')} AS failing, 'row' AS kind FROM {source}"
            )
    parts.append(
        "SELECT table_name, 'unique key ' || key_columns, duplicate_key_rows, 'key' "
        f"FROM ({_key_violations()}) WHERE table_name <> 'category_translation'"
    )
    parts.append(
        "SELECT split_part(relationship, '.', 1), relationship, orphan_keys, 'reference' "
        f"FROM ({_fk_orphans()})"
    )
    return " UNION ALL ".join(parts)


_CLEANING_SUMMARY = " UNION ALL ".join(
    [
        _long(
            "facts_t",
            {
                "rows of orders": "count(*)",
                "orders in the window": _count("in_window"),
                "orders without items": _count("NOT has_items"),
                "orders without payments": _count("NOT has_payment"),
                "delivered orders": _count("status = 'delivered'"),
                "missing operational timestamps": _count("missing_stamp"),
                "chronology issues": _count("chronology"),
                "carrier before purchase": _count("status = 'delivered' AND carrier < purchase"),
                "carrier before approval": _count("status = 'delivered' AND carrier < approved"),
                "delivery before carrier": _count("status = 'delivered' AND customer < carrier"),
                "orders eligible for delivery KPIs": _count("eligible"),
                "delivered orders eligible for handling time":
                    _count("status = 'delivered' AND handled"),
                "orders whose payments start above one": _count("start_missing"),
                "orders with payment gaps": _count("gap"),
                "orders with several reviews": _count("review_records > 1"),
                "orders without reviews": _count("review_records = 0"),
            },
        ),
        _long(
            "products_c",
            {
                "rows of products": "count(*)",
                "products translated by hand": _count("source = 'manual'"),
                "products without category": _count("category IS NULL"),
                "categories translated by hand":
                    "count(DISTINCT category) FILTER (WHERE source = 'manual')",
            },
        ),
        _long(
            "payments_t",
            {
                "rows of payments": "count(*)",
                "invalid installments": _count("installments <= 0"),
                "zero-value payments": _count("value_c = 0"),
            },
        ),
        _long("reviews_t", {"rows of reviews": "count(*)"}),
        _long("customers_t", {"rows of customers": "count(*)"}),
        _long("sellers_t", {"rows of sellers": "count(*)"}),
        _long("items_t", {"rows of order_items": "count(*)"}),
        _long(
            "(SELECT person, count(*) AS n FROM customers_t GROUP BY person)",
            {"repeated customer identities": _count("n > 1")},
        ),
    ]
)


def _counts() -> str:
    pairs = {
        "customers": ("customers_t", "customer"), "products": ("products_c", "part"),
        "sellers": ("sellers_t", "supplier"), "orders": ("facts_t", "orders"),
        "order_items": ("items_t", "lineitem"), "payments": ("payments_t", "lineitem"),
        "reviews": ("reviews_t", "lineitem"),
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {made}) AS actual_rows, "
        f"(SELECT count(*) FROM {stored}) AS expected_rows"
        for n, (made, stored) in pairs.items()
    )


_STATUS = "CASE WHEN actual_rows = expected_rows THEN 'OK' ELSE 'FAIL' END AS status"

_PREFLIGHT = [
    ("customers", "customer",
     "customer_city, customer_id, customer_state, customer_unique_id, customer_zip_code_prefix",
     "c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey"),
    ("orders", "orders",
     "customer_id, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, "
     "order_estimated_delivery_date, order_id, order_purchase_timestamp, order_status",
     "o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice"),
    ("order_items", "items_t", "", ""),
    ("products", "products_t", "", ""),
    ("sellers", "sellers_t", "", ""),
    ("payments", "payments_t", "", ""),
    ("reviews", "reviews_t", "", ""),
    ("category_translation", "translation_t", "", ""),
]

_PARSE_MONTHS = """
SELECT request, month, month IS NOT NULL AS is_valid, count(*) AS requests FROM (
    SELECT request, CASE WHEN regexp_full_match(request, '[0-9]{4}-[0-9]{2}')
        THEN try_cast(request || '-01' AS DATE) END AS month
    FROM (SELECT CASE o_custkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m')
            WHEN 1 THEN year(o_orderdate) || '-' || month(o_orderdate)
            WHEN 2 THEN year(o_orderdate) || '-' || (month(o_orderdate) + 12)
            WHEN 3 THEN strftime(o_orderdate, '%y') || '-' || month(o_orderdate)
            ELSE strftime(o_orderdate, '%B-%Y') END AS request FROM orders))
GROUP BY request, month"""

_FACTS = f"""
SELECT order_id, customer_id, person AS customer_unique_id, city AS customer_city,
    state AS customer_state, CAST(purchase AS DATE) AS purchase_date, month AS purchase_month,
    {_ORDER_COLUMNS}, has_items AS has_order_items, has_payment, item_count, product_count,
    seller_count, CAST(price_c AS BIGINT) {_CENT} AS merchandise_value,
    CAST(freight_c AS BIGINT) {_CENT} AS freight_value,
    CAST(price_c + freight_c AS BIGINT) {_CENT} AS item_total_value,
    payment_records AS payment_record_count, CAST(value_c AS BIGINT) {_CENT} AS recorded_payment_value,
    bad_installment AS has_invalid_installment, zero_value AS has_zero_value_payment,
    start_missing AS has_payment_sequence_start_missing,
    gap AS has_payment_sequence_internal_gap, review_records AS review_record_count, {_SCORE}
FROM facts_t"""

_WORST = "issue_id = (SELECT issue_id FROM issues_t WHERE severity_rank = 1)"


def _export_contract() -> str:
    def check(name: str, source: str, group: str, key: str) -> str:
        return f"""
        SELECT '{name}' AS dataset, CAST(sum(n) AS BIGINT) AS row_count,
            CAST(sum(n - keys) AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS identifying_columns,
            {_count(f"n > {TOP}")} AS overfull_groups,
            CASE WHEN sum(n) > 0 AND sum(n - keys) = 0 AND {_count(f"n > {TOP}")} = 0
                THEN 'OK' ELSE 'FAIL' END AS status
        FROM (SELECT {group}, count(*) AS n, count(DISTINCT {key}) AS keys FROM {source} GROUP BY {group})"""

    return " UNION ALL ".join(
        [
            check("monthly_kpis", "kpis_t", "purchase_month", "purchase_month"),
            check("delivery_comparisons", "comparisons_t", "current_month", "current_month"),
            check("delivery_issue_states", "states_t", "issue_id", "customer_state"),
            check("delivery_issue_sellers", "sellers_ranked_t", "issue_id", "seller_id"),
        ]
    )


_CARDS = f"""
SELECT current_month, current_on_time_delivery_rate_pct, on_time_delivery_change_pp, late AS current_late_orders,
    {ratio("CAST(late AS HUGEINT) * previous - CAST(now AS HUGEINT) * late_before", "previous")}
        AS excess_late_orders
FROM (SELECT *, current_delivery_kpi_order_count AS now, previous_delivery_kpi_order_count AS previous,
        current_delivery_kpi_order_count - current_on_time_delivery_count AS late,
        previous_delivery_kpi_order_count - previous_on_time_delivery_count AS late_before
      FROM comparisons_t WHERE is_delivery_issue)"""

_STAR = f"""
SELECT c.current_month, is_delivery_issue, c.issue_severity, coalesce(state_rows, 0) AS state_rows,
    state_excess, coalesce(seller_rows, 0) AS seller_rows, seller_excess
FROM comparisons_t c
LEFT JOIN (SELECT current_month, count(*) AS state_rows, CAST(sum({EXCESS_CENTS}) AS BIGINT) {_CENT} AS state_excess
           FROM states_t GROUP BY current_month) s USING (current_month)
LEFT JOIN (SELECT current_month, count(*) AS seller_rows, CAST(sum({EXCESS_CENTS}) AS BIGINT) {_CENT} AS seller_excess
           FROM sellers_ranked_t GROUP BY current_month) l USING (current_month)"""


def oracle_sql() -> dict[str, str]:
    statements = {
        "header_contract": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS records, '{missing}' AS missing_columns, "
            f"'{unexpected}' AS unexpected_columns, '{'FAIL' if missing else 'OK'}' AS status FROM {source}"
            for t, source, missing, unexpected in _PREFLIGHT
        ),
        "row_count_contract": f"SELECT *, {_STATUS} FROM ({_counts()})",
        "load_state": f"""
            SELECT *, CASE WHEN empty_tables = tables THEN 'empty'
                WHEN complete_tables = tables THEN 'loaded' ELSE 'partial' END AS state
            FROM (SELECT count(*) AS tables, {_count("actual_rows = 0")} AS empty_tables,
                    {_count("actual_rows = expected_rows")} AS complete_tables FROM ({_counts()}))""",
        "view_row_counts": f"""
            SELECT *, {_STATUS} FROM (
                SELECT 'order_facts' AS table_name, (SELECT count(*) FROM facts_t) AS actual_rows,
                    (SELECT count(*) FROM orders) AS expected_rows
                UNION ALL SELECT 'monthly_kpis', (SELECT count(*) FROM kpis_t), {_WINDOW_MONTHS}
                UNION ALL SELECT 'monthly_delivery_comparison', (SELECT count(*) FROM comparison_t),
                    greatest({_WINDOW_MONTHS} - 1, 0))""",
        "normalize_strings": """
            SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(person AS VARCHAR) AS customer_unique_id,
                CAST(zip AS VARCHAR) AS customer_zip_code_prefix, state AS customer_state,
                CASE WHEN state NOT IN ('NATION_0', 'NATION_5', 'NATION_7') THEN city END AS customer_city
            FROM customers_t""",
        "clean_customers": """
            SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(person AS VARCHAR) AS customer_unique_id,
                CAST(zip AS BIGINT) AS customer_zip_code_prefix, state AS customer_state,
                CASE WHEN state NOT IN ('NATION_0', 'NATION_5', 'NATION_7') THEN city END AS customer_city
            FROM customers_t""",
        "clean_sellers": """
            SELECT CAST(seller_id AS VARCHAR) AS seller_id, CAST(zip AS BIGINT) AS seller_zip_code_prefix,
                city AS seller_city, state AS seller_state FROM sellers_t""",
        "typed_order_items": f"SELECT {_ITEM_COLUMNS} FROM items_t",
        "clean_products": """
            SELECT CAST(product_id AS VARCHAR) AS product_id, category AS product_category_name,
                CAST(name_length AS BIGINT) AS product_name_length,
                CAST(description_length AS BIGINT) AS product_description_length,
                CAST(photos AS BIGINT) AS product_photos_qty,
                CAST(CASE WHEN weight > 0 THEN weight END AS DOUBLE) AS product_weight_g,
                CAST(CASE WHEN len > 0 THEN len END AS DOUBLE) AS product_length_cm,
                CASE WHEN height > 0 THEN height END AS product_height_cm,
                CAST(CASE WHEN width > 0 THEN width END AS DOUBLE) AS product_width_cm,
                english AS product_category_name_english, source AS category_translation_source
            FROM products_c""",
        "untranslated_categories": """
            SELECT DISTINCT category AS product_category_name FROM products_c
            WHERE category IS NOT NULL AND english IS NULL""",
        "clean_reviews": """
            SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(order_id AS VARCHAR) AS order_id,
                CAST(score AS BIGINT) AS review_score, title AS review_comment_title,
                message AS review_comment_message, created AS review_creation_date,
                answered AS review_answer_timestamp FROM reviews_t""",
        "payment_sequences": """
            SELECT order_id, n AS payment_rows, CAST(lo AS BIGINT) AS minimum_sequence,
                CAST(hi AS BIGINT) AS maximum_sequence, seen AS observed_sequences,
                CAST(hi - lo + 1 AS BIGINT) AS expected_sequences,
                lo > 1 AS payment_sequence_start_missing,
                seen <> hi - lo + 1 AS payment_sequence_internal_gap FROM sequences""",
        "payment_flags": f"""
            SELECT CAST(p.order_id AS VARCHAR) AS order_id, CAST(p.seq AS BIGINT) AS payment_sequential,
                p.kind AS payment_type, CAST(p.installments AS BIGINT) AS payment_installments,
                p.value_c {_CENT} AS payment_value, p.installments <= 0 AS is_invalid_installment,
                p.value_c = 0 AS is_zero_value_payment, s.lo > 1 AS payment_sequence_start_missing,
                s.seen <> s.hi - s.lo + 1 AS payment_sequence_internal_gap
            FROM payments_t p JOIN sequences s USING (order_id)""",
        "clean_orders": f"""
            SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
                {_ORDER_COLUMNS}, order_id IN (SELECT order_id FROM items_t) AS has_order_items,
                order_id IN (SELECT order_id FROM payments_t) AS has_payment FROM timed_t""",
        "cleaning_summary": _CLEANING_SUMMARY,
        "table_profile": _table_profile(),
        "missing_values": _missing_values(),
        "invalid_values": _invalid_values(),
        "key_violations": _key_violations(),
        "rule_violations": _rule_violations(),
        "fk_orphans": _fk_orphans(),
        "order_coverage": " UNION ALL ".join(
            f"SELECT 'orders without {n}' AS metric, count(*) AS value FROM orders_t "
            f"WHERE order_id NOT IN (SELECT order_id FROM {t})"
            for n, t in _CHILDREN.items()
        ),
        "customer_identity": " UNION ALL ".join(
            [
                _long("customers_t", {"distinct customer ids": "count(DISTINCT customer_id)"}),
                _long(
                    "(SELECT person, count(*) AS n FROM customers_t GROUP BY person)",
                    {
                        "distinct identities": "count(*)",
                        "repeated identities": _count("n > 1"),
                        "most records of one identity": "max(n)",
                    },
                ),
            ]
        ),
        "review_validation": " UNION ALL ".join(
            [
                _long(
                    "reviews_t",
                    {
                        "missing scores": _count("score IS NULL"),
                        "scores out of range": _count("score NOT BETWEEN 1 AND 5"),
                        "lowest score": "min(score)",
                        "highest score": "max(score)",
                    },
                ),
                _long(
                    "(SELECT order_id, count(*) AS n FROM reviews_t GROUP BY order_id)",
                    {
                        "orders with several reviews": _count("n > 1"),
                        "most reviews of one order": "max(n)",
                    },
                ),
                _long(
                    "(SELECT review_id, count(DISTINCT order_id) AS n FROM reviews_t GROUP BY review_id)",
                    {"review ids on several orders": _count("n > 1")},
                ),
            ]
        ),
        "score_distribution": """
            SELECT CAST(score AS BIGINT) AS review_score, count(*) AS reviews FROM reviews_t GROUP BY score""",
        "measurement_profile": _measurement_profile(),
        "category_coverage": _CATEGORY_COVERAGE,
        "payment_validation": " UNION ALL ".join(
            [
                _long(
                    "payments_t",
                    {
                        "installments not positive": _count("installments <= 0"),
                        "zero value": _count("value_c = 0"),
                        "negative value": _count("value_c < 0"),
                    },
                ),
                _long(
                    "sequences",
                    {
                        "sequences starting above one": _count("lo > 1"),
                        "sequences with gaps": _count("seen <> hi - lo + 1"),
                    },
                ),
            ]
        ),
        "item_validation": f"""
            SELECT min(price_c) {_CENT} AS lowest_price, max(price_c) {_CENT} AS highest_price,
                min(freight_c) {_CENT} AS lowest_freight, max(freight_c) {_CENT} AS highest_freight,
                {_count("price_c <= 0")} AS non_positive_prices, {_count("freight_c < 0")} AS negative_freight,
                {_count("freight_c = 0")} AS zero_freight FROM items_t""",
        "purchase_coverage": f"""
            SELECT min(purchase) AS first_purchase, max(purchase) AS last_purchase,
                {_count("in_window")} AS window_orders,
                {", ".join(f"CAST(0 AS BIGINT) AS invalid_{c}" for c in _STAMPS["orders"])} FROM flags_t""",
        "dq_report": _dq_report(),
        "constraint_report": _constraints(),
        "quarantined_rows": _quarantined_rows(),
        "item_summary": f"""
            SELECT order_id, item_count, product_count, seller_count,
                CAST(price_c AS BIGINT) {_CENT} AS merchandise_value,
                CAST(freight_c AS BIGINT) {_CENT} AS freight_value,
                CAST(price_c + freight_c AS BIGINT) {_CENT} AS item_total_value FROM item_sums""",
        "payment_summary": f"""
            SELECT order_id, records AS payment_record_count,
                CAST(value_c AS BIGINT) {_CENT} AS recorded_payment_value,
                bad_installment AS has_invalid_installment, zero_value AS has_zero_value_payment,
                start_missing AS has_payment_sequence_start_missing,
                gap AS has_payment_sequence_internal_gap FROM payment_sums""",
        "review_summary": f"SELECT order_id, records AS review_record_count, {_SCORE} FROM review_sums",
        "order_facts": _FACTS,
        "monthly_kpis": "SELECT * FROM kpis_t",
        "monthly_comparison": "SELECT * FROM comparison_t",
        "delivery_comparisons": "SELECT * FROM comparisons_t",
        "delivery_issues": f"SELECT {_ISSUE_ROW} FROM comparisons_t WHERE is_delivery_issue",
        "delivery_issue_by_month": f"""
            SELECT {_ISSUE_ROW} FROM comparisons_t
            WHERE is_delivery_issue AND current_month = DATE '1997-02-01'""",
        "worst_issue": f"""
            SELECT {_ISSUE_ROW} FROM comparisons_t
            WHERE current_month = (SELECT current_month FROM issues_t WHERE severity_rank = 1)""",
        "parse_months": _PARSE_MONTHS,
        "investigation_orders": f"""
            SELECT {KEYS}, period_label, order_id, late AS is_late_delivery,
                promise_m {_MICRO} AS promise_window_days, transport_m {_MICRO} AS carrier_to_customer_days
            FROM inv_t""",
        "single_seller_orders": """
            SELECT order_id, min(seller_id) AS seller_id FROM items_t
            GROUP BY order_id HAVING count(DISTINCT seller_id) = 1""",
        "issue_periods": "SELECT * FROM periods_t",
        "issue_impact": "SELECT * FROM impact_t",
        "issue_states": f"SELECT * FROM states_t WHERE {_WORST}",
        "issue_seller_coverage": "SELECT * FROM coverage_t",
        "issue_sellers": "SELECT * FROM sellers_ranked_t WHERE current_month = DATE '1997-02-01'",
        "issue_states_all": "SELECT * EXCLUDE (contributor_rank) FROM states_t",
        "issue_states_stored": "SELECT * EXCLUDE (contributor_rank) FROM states_t",
        "issue_sellers_all": "SELECT * EXCLUDE (contributor_rank) FROM sellers_ranked_t",
        "issue_diagnosis": DIAGNOSIS,
        "issue_kpi_table": KPI_TABLE,
        "issue_top5": TOP_ROWS,
        "issue_brief": BRIEF,
        "issue_document": OVERVIEW_DOCUMENT,
        "issue_states_document": STATES_DOCUMENT,
        "issue_sellers_document": SELLERS_DOCUMENT,
        "export_contract": _export_contract(),
        "bi_issue_cards": _CARDS,
        "bi_issue_star": _STAR,
    }
    statements["repeated_run"] = repeated_run(
        {
            name: (statements[query], CLEAN_COLUMNS[name])
            for name, query in {
                "sellers": "clean_sellers",
                "order_items": "typed_order_items", "payments": "payment_flags",
                "reviews": "clean_reviews",
            }.items()
        }
    )
    statements["fact_store_refresh"] = f"""
        SELECT purchase_month, count(*) AS orders,
            CASE WHEN purchase_month = DATE '1997-02-01' THEN 'written' ELSE 'kept' END AS action
        FROM ({_FACTS}) GROUP BY purchase_month"""
    return {name: sql(body) for name, body in statements.items()}
