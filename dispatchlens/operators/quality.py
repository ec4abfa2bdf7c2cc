"""Profiles and data-quality checks.

A check counts its failures instead of raising, and reports them as rows, so
that all findings of a run are seen together.  Aggregations are decomposable or
deduplicate before the shuffle, so a value that most rows share stays cheap.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.functions import text as tx
from dispatchlens.functions.measures import count_where, never_null
from dispatchlens.operators.audit import Reference, audit, key_text
from dispatchlens.operators.cleaning import in_window, normalize_strings
from dispatchlens.schemas import FOREIGN_KEYS, KEYS, PRODUCT_MEASUREMENTS, RAW_COLUMNS
from dispatchlens.settings import Settings

PASSED, FAILED = "OK", "FAIL"

# Non-positive measurements of the published product table.
EXPECTED_NON_POSITIVE = {
    "product_weight_g": 4,
    "product_length_cm": 0,
    "product_height_cm": 0,
    "product_width_cm": 0,
}


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _status(ok: Column) -> Column:
    return F.when(ok, PASSED).otherwise(FAILED)


def _rows(name: str, value: str, values: dict[str, Column]) -> Column:
    """Turn one row of named columns into rows of (``name``, ``value``)."""
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(n).alias(name), c.cast("long").alias(value))
                for n, c in values.items()
            ]
        )
    )


def _metrics(frame: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """One pass over ``frame``; each aggregate becomes a (metric, value) row."""
    one_row = frame.agg(*[c.alias(n) for n, c in aggregates.items()])
    return one_row.select(_rows("metric", "value", {n: F.col(n) for n in aggregates}))


# Headers and row counts


def source_preflight(
    frames: Mapping[str, DataFrame], contract: dict[str, list[str]] = RAW_COLUMNS
) -> DataFrame:
    """Per source: records, and header columns that are missing or unexpected."""

    def check(table: str, frame: DataFrame) -> DataFrame:
        expected, found = set(contract[table]), set(frame.columns)
        missing, unexpected = sorted(expected - found), sorted(found - expected)
        return frame.agg(F.count("*").alias("records")).select(
            F.lit(table).alias("table_name"),
            "records",
            F.lit(", ".join(missing)).alias("missing_columns"),
            F.lit(", ".join(unexpected)).alias("unexpected_columns"),
            _status(F.lit(not missing and not unexpected)).alias("status"),
        )

    return union_all(check(t, f) for t, f in frames.items())


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        f.agg(F.count("*").alias("actual_rows")).select(
            F.lit(name).alias("table_name"), "actual_rows"
        )
        for name, f in frames.items()
    )


def expected_counts(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """``counts`` with the fixed number of rows each table should have."""
    wanted = F.lit(None).cast("long")
    for name, rows in expected.items():
        wanted = F.when(F.col("table_name") == name, F.lit(rows).cast("long")).otherwise(wanted)
    return counts.withColumn("expected_rows", wanted)


def row_count_contract(counts: DataFrame) -> DataFrame:
    """Status of (table_name, actual_rows, expected_rows)."""
    return counts.withColumn(
        "status", _status(F.col("actual_rows").eqNullSafe(F.col("expected_rows")))
    )


def counts_against(frames: Mapping[str, DataFrame], sources: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of tables next to those of the sources they were made from."""
    expected = row_counts(sources).withColumnRenamed("actual_rows", "expected_rows")
    return row_counts(frames).join(expected, "table_name", "left")


def load_state(counts: DataFrame) -> DataFrame:
    """One row: is the set of tables empty, loaded, or something in between?"""
    rows, expected = F.col("actual_rows"), F.col("expected_rows")
    return counts.agg(
        F.count("*").alias("tables"),
        count_where(rows == 0).alias("empty_tables"),
        count_where(rows == expected).alias("complete_tables"),
    ).withColumn(
        "state",
        F.when(F.col("empty_tables") == F.col("tables"), "empty")
        .when(F.col("complete_tables") == F.col("tables"), "loaded")
        .otherwise("partial"),
    )


# Profiles


def table_profile(frames: Mapping[str, DataFrame], keys: dict[str, list[str]] = KEYS) -> DataFrame:
    """Rows, columns, missing keys, repeated keys and repeated rows per table.

    Rows are compared by the SHA-256 of all their columns, which differs for different
    rows as far as anyone knows.  Equal digests are counted first and equal keys among
    them second, so every table is scanned once, repeated rows collapse before the
    shuffle, and what moves of a row is its key and 32 bytes.
    """

    def profile(table: str, frame: DataFrame) -> DataFrame:
        key = keys[table]
        data = normalize_strings(frame)
        missing = reduce(Column.__or__, [F.col(c).isNull() for c in key])
        digest = F.unhex(F.sha2(key_text(data.columns), 256))
        per_row = data.groupBy(*key, digest.alias("_digest")).agg(F.count("*").alias("_copies"))
        per_key = per_row.groupBy(*key).agg(
            F.sum("_copies").alias("_copies"), F.count("*").alias("_variants")
        )
        return per_key.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(missing, F.col("_copies"))), F.lit(0)).alias("missing_key_rows"),
            F.count("*").alias("_keys"),
            F.coalesce(F.sum("_variants"), F.lit(0)).alias("_variants"),
        ).select(
            F.lit(table).alias("table_name"),
            "row_count",
            F.lit(len(data.columns)).cast("long").alias("column_count"),
            "missing_key_rows",
            (F.col("row_count") - F.col("_keys")).alias("duplicate_key_rows"),
            (F.col("row_count") - F.col("_variants")).alias("exact_duplicate_rows"),
            _status((F.col("missing_key_rows") == 0) & (F.col("row_count") == F.col("_keys"))).alias(
                "status"
            ),
        )

    return union_all(profile(t, f) for t, f in frames.items())


def missing_values(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with missing values, one scan per table."""

    def count(table: str, frame: DataFrame) -> DataFrame:
        data = normalize_strings(frame)
        counts = data.agg(*[count_where(F.col(c).isNull()).alias(c) for c in data.columns])
        columns = {c: F.col(c) for c in data.columns}
        return counts.select(
            F.lit(table).alias("table_name"), _rows("column_name", "missing", columns)
        )

    return union_all(count(t, f) for t, f in frames.items()).filter("missing > 0")


NUMERIC_COLUMNS = {
    "order_items": ["price", "freight_value"],
    "products": PRODUCT_MEASUREMENTS,
    "payments": ["payment_sequential", "payment_installments", "payment_value"],
    "reviews": ["review_score"],
}

TIMESTAMP_COLUMNS = {
    "orders": [
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}


def invalid_values(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Text values that are no number or no timestamp, counted per column."""
    exact = T.DecimalType(38, 18)

    def count(table: str, frame: DataFrame) -> DataFrame:
        checks: dict[str, tuple[str, Column]] = {}
        for c in NUMERIC_COLUMNS.get(table, []):
            text = tx.normalize(F.col(c))
            checks[c] = ("number", tx.is_invalid(text, tx.parse_number(text, exact)))
        for c in TIMESTAMP_COLUMNS.get(table, []):
            text = tx.normalize(F.col(c))
            checks[c] = ("timestamp", tx.is_invalid(text, tx.parse_timestamp(text)))
        counts = frame.agg(*[count_where(bad).alias(c) for c, (_, bad) in checks.items()])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(kind).alias("expected_type"),
                    F.col(c).alias("invalid"),
                )
                for c, (kind, _) in checks.items()
            ]
        )
        return counts.select(F.lit(table).alias("table_name"), F.inline(rows))

    checked = set(NUMERIC_COLUMNS) | set(TIMESTAMP_COLUMNS)
    return union_all(count(t, f) for t, f in frames.items() if t in checked)


# Keys, rules and relations


def key_violations(
    frames: Mapping[str, DataFrame], keys: dict[str, list[str]] = KEYS
) -> DataFrame:
    """Rows without a complete key, and rows that repeat a key."""

    def count(table: str, frame: DataFrame) -> DataFrame:
        key = keys[table]
        missing = reduce(Column.__or__, [F.col(c).isNull() for c in key])
        per_key = frame.groupBy(*key).agg(F.count("*").alias("_rows"))
        return per_key.agg(
            F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("missing_key_rows"),
            F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_key_rows"),
        ).select(
            F.lit(table).alias("table_name"),
            F.lit(", ".join(key)).alias("key_columns"),
            "missing_key_rows",
            "duplicate_key_rows",
        )

    return union_all(count(t, f) for t, f in frames.items())


def rules_failing(table: str, frame: DataFrame, failing: dict[str, Column]) -> DataFrame:
    """Rows per rule for which the failing condition holds; unknown passes."""
    counts = frame.agg(*[count_where(never_null(bad)).alias(n) for n, bad in failing.items()])
    rules = {name: F.col(f"`{name}`") for name in failing}
    return counts.select(F.lit(table).alias("table_name"), _rows("rule", "failing", rules))


def demanded_rules() -> dict[str, dict[str, Column]]:
    """Per table, when a row breaks a rule that cleaning demands."""
    return {
        "order_items": {
            "price is positive": F.col("price") <= 0,
            "freight is not negative": F.col("freight_value") < 0,
        },
        "payments": {
            "sequence starts at one": F.col("payment_sequential") < 1,
            "value is not negative": F.col("payment_value") < 0,
        },
        "reviews": {"score lies between one and five": ~F.col("review_score").between(1, 5)},
    }


def rule_violations(
    items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """The row rules that cleaning demands."""
    frames = {"order_items": items, "payments": payments, "reviews": reviews}
    return union_all(rules_failing(t, frames[t], rules) for t, rules in demanded_rules().items())


def _distinct_key(frame: DataFrame, column: str) -> DataFrame:
    key = frame.select(F.col(column).alias("key")).filter(F.col("key").isNotNull())
    return key.distinct()


def fk_orphans(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct child keys without a parent, for every relation."""

    def count(child: str, column: str, parent: str, parent_column: str) -> DataFrame:
        keys = _distinct_key(frames[child], column)
        orphans = keys.join(_distinct_key(frames[parent], parent_column), "key", "left_anti")
        return orphans.agg(F.count("*").alias("orphan_keys")).select(
            F.lit(f"{child}.{column} -> {parent}.{parent_column}").alias("relationship"),
            "orphan_keys",
        )

    return union_all(count(*relation) for relation in FOREIGN_KEYS)


def order_coverage(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Orders that have no items, no payments, no reviews.

    The three lookups share the partitioning of the orders.
    """
    keys = _distinct_key(orders, "order_id")
    children = {"items": items, "payments": payments, "reviews": reviews}
    for name, child in children.items():
        present = _distinct_key(child, "order_id").withColumn(name, F.lit(True))
        keys = keys.join(present, "key", "left")
    return _metrics(keys, {f"orders without {n}": count_where(F.col(n).isNull()) for n in children})


# Single-table checks


def customer_identity(customers: DataFrame) -> DataFrame:
    """Customer records and the people behind them."""
    ids = _metrics(
        _distinct_key(customers, "customer_id"), {"distinct customer ids": F.count("*")}
    )
    people = (
        customers.filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.count("*").alias("records"))
    )
    return ids.unionByName(
        _metrics(
            people,
            {
                "distinct identities": F.count("*"),
                "repeated identities": count_where(F.col("records") > 1),
                "most records of one identity": F.max("records"),
            },
        )
    )


def review_validation(reviews: DataFrame) -> DataFrame:
    """Range of the scores, and how reviews and orders repeat."""
    score = F.col("review_score")
    scores = _metrics(
        reviews,
        {
            "missing scores": count_where(score.isNull()),
            "scores out of range": count_where(never_null(~score.between(1, 5))),
            "lowest score": F.min(score),
            "highest score": F.max(score),
        },
    )
    per_order = (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("*").alias("reviews"))
    )
    per_review = (
        reviews.filter(F.col("review_id").isNotNull())
        .groupBy("review_id")
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    return union_all(
        [
            scores,
            _metrics(
                per_order,
                {
                    "orders with several reviews": count_where(F.col("reviews") > 1),
                    "most reviews of one order": F.max("reviews"),
                },
            ),
            _metrics(
                per_review, {"review ids on several orders": count_where(F.col("orders") > 1)}
            ),
        ]
    )


def score_distribution(reviews: DataFrame) -> DataFrame:
    scored = reviews.filter(F.col("review_score").isNotNull())
    return scored.groupBy("review_score").agg(F.count("*").alias("reviews")).orderBy("review_score")


def measurement_profile(
    products: DataFrame, expected: dict[str, int] = EXPECTED_NON_POSITIVE
) -> DataFrame:
    """Missing, zero and negative measurements against the known numbers.

    The row ``any measurement`` counts products with any non-positive value.
    """
    anywhere = reduce(Column.__or__, [never_null(F.col(c) <= 0) for c in expected])
    aggregates = [count_where(anywhere).alias("_any")]
    for c in expected:
        value = F.col(c)
        aggregates += [
            count_where(value.isNull()).alias(f"{c}_missing"),
            count_where(value == 0).alias(f"{c}_zero"),
            count_where(value < 0).alias(f"{c}_negative"),
            count_where(value <= 0).alias(f"{c}_non_positive"),
        ]
    unknown = F.lit(None).cast("long")

    def row(name: str, counts: list[Column], wanted: Column) -> Column:
        names = ["missing", "zero", "negative", "non_positive"]
        return F.struct(
            F.lit(name).alias("column_name"),
            *[c.alias(n) for n, c in zip(names, counts, strict=True)],
            wanted.alias("expected_non_positive"),
            (counts[3] == wanted).alias("as_expected"),
        )

    rows = [
        row(
            c,
            [F.col(f"{c}_{n}") for n in ("missing", "zero", "negative", "non_positive")],
            F.lit(wanted).cast("long"),
        )
        for c, wanted in expected.items()
    ]
    rows.append(row("any measurement", [unknown, unknown, unknown, F.col("_any")], unknown))
    return products.agg(*aggregates).select(F.inline(F.array(*rows)))


def category_coverage(
    products: DataFrame, translation: DataFrame, known_manual: Iterable[str]
) -> DataFrame:
    """Categories without a translation and translations without a product."""
    used = _distinct_key(products, "product_category_name")
    translated = _distinct_key(translation, "product_category_name")
    finding = F.when(F.col("key").isin(*known_manual), "manual mapping").otherwise("unexpected")
    lacking = used.join(translated, "key", "left_anti").withColumn("finding", finding)
    unused = translated.join(used, "key", "left_anti").withColumn("finding", F.lit("unused"))
    return lacking.unionByName(unused).withColumnRenamed("key", "category")


def payment_validation(payments: DataFrame, sequences: DataFrame) -> DataFrame:
    records = _metrics(
        payments,
        {
            "installments not positive": count_where(F.col("payment_installments") <= 0),
            "zero value": count_where(F.col("payment_value") == 0),
            "negative value": count_where(F.col("payment_value") < 0),
        },
    )
    return records.unionByName(
        _metrics(
            sequences,
            {
                "sequences starting above one": count_where(
                    F.col("payment_sequence_start_missing")
                ),
                "sequences with gaps": count_where(F.col("payment_sequence_internal_gap")),
            },
        )
    )


def item_validation(items: DataFrame) -> DataFrame:
    price, freight = F.col("price"), F.col("freight_value")
    return items.agg(
        F.min(price).alias("lowest_price"),
        F.max(price).alias("highest_price"),
        F.min(freight).alias("lowest_freight"),
        F.max(freight).alias("highest_freight"),
        count_where(price <= 0).alias("non_positive_prices"),
        count_where(freight < 0).alias("negative_freight"),
        count_where(freight == 0).alias("zero_freight"),
    )


def purchase_coverage(orders: DataFrame, settings: Settings) -> DataFrame:
    """Range of purchase times, orders in the window, unreadable timestamps."""
    parsed = {}
    for c in TIMESTAMP_COLUMNS["orders"]:
        if isinstance(orders.schema[c].dataType, T.StringType):
            text = tx.normalize(F.col(c))
            parsed[c] = (text, tx.parse_timestamp(text))
        else:
            parsed[c] = (F.col(c), F.col(c))
    purchase = parsed["order_purchase_timestamp"][1]
    return orders.agg(
        F.min(purchase).alias("first_purchase"),
        F.max(purchase).alias("last_purchase"),
        count_where(in_window(purchase, settings)).alias("window_orders"),
        *[
            count_where(tx.is_invalid(raw, value)).alias(f"invalid_{c}")
            for c, (raw, value) in parsed.items()
        ],
    )


# Reports


def cleaning_summary(tables: Mapping[str, DataFrame], sequences: DataFrame) -> DataFrame:
    """Rows of every cleaned table, and the defects that cleaning flagged.

    ``sequences`` are the payment sequences per order; with them the payments
    need not carry their order's flags.
    """
    delivered = F.col("order_status") == "delivered"
    purchase = F.col("order_purchase_timestamp")
    approved = F.col("order_approved_at")
    carrier = F.col("order_delivered_carrier_date")
    customer = F.col("order_delivered_customer_date")
    orders = _metrics(
        tables["orders"],
        {
            "rows of orders": F.count("*"),
            "orders in the window": count_where(F.col("is_primary_analysis_window")),
            "orders without items": count_where(~F.col("has_order_items")),
            "orders without payments": count_where(~F.col("has_payment")),
            "delivered orders": count_where(delivered),
            "missing operational timestamps": count_where(
                F.col("has_missing_operational_timestamp")
            ),
            "chronology issues": count_where(F.col("has_operational_chronology_issue")),
            "carrier before purchase": count_where(delivered & (carrier < purchase)),
            "carrier before approval": count_where(delivered & (carrier < approved)),
            "delivery before carrier": count_where(delivered & (customer < carrier)),
            "orders eligible for delivery KPIs": count_where(F.col("is_delivery_kpi_eligible")),
            "delivered orders eligible for handling time": count_where(
                delivered & F.col("is_handling_time_eligible")
            ),
        },
    )
    products = tables["products"]
    manual = F.col("category_translation_source") == "manual"
    categories = products.filter(manual).select("product_category_name").distinct()
    payments = tables["payments"]
    reviews = tables["reviews"]
    reviews_per_order = reviews.groupBy("order_id").agg(F.count("*").alias("reviews"))
    people = tables["customers"].groupBy("customer_unique_id").agg(F.count("*").alias("records"))
    unreviewed = _distinct_key(tables["orders"], "order_id").join(
        _distinct_key(reviews, "order_id"), "key", "left_anti"
    )
    known = F.col("order_id").isNotNull()
    return union_all(
        [
            orders,
            _metrics(
                products,
                {
                    "rows of products": F.count("*"),
                    "products translated by hand": count_where(manual),
                    "products without category": count_where(
                        F.col("product_category_name").isNull()
                    ),
                },
            ),
            _metrics(categories, {"categories translated by hand": F.count("*")}),
            _metrics(
                payments,
                {
                    "rows of payments": F.count("*"),
                    "invalid installments": count_where(F.col("is_invalid_installment")),
                    "zero-value payments": count_where(F.col("is_zero_value_payment")),
                },
            ),
            _metrics(
                sequences.filter(known),
                {
                    "orders whose payments start above one": count_where(
                        F.col("payment_sequence_start_missing")
                    ),
                    "orders with payment gaps": count_where(
                        F.col("payment_sequence_internal_gap")
                    ),
                },
            ),
            _metrics(reviews, {"rows of reviews": F.count("*")}),
            _metrics(
                reviews_per_order.filter(known),
                {"orders with several reviews": count_where(F.col("reviews") > 1)},
            ),
            _metrics(unreviewed, {"orders without reviews": F.count("*")}),
            _metrics(
                people.filter(F.col("customer_unique_id").isNotNull()),
                {"repeated customer identities": count_where(F.col("records") > 1)},
            ),
            _metrics(tables["customers"], {"rows of customers": F.count("*")}),
            _metrics(tables["sellers"], {"rows of sellers": F.count("*")}),
            _metrics(tables["order_items"], {"rows of order_items": F.count("*")}),
        ]
    )


def dq_report(
    raw: Mapping[str, DataFrame],
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    known_manual: Iterable[str],
    expected_non_positive: dict[str, int] = EXPECTED_NON_POSITIVE,
) -> DataFrame:
    """All findings of the inspection, and a last row with the verdict.

    Each table is read once: items, payments and reviews as typed, the others as they are,
    normalised.
    """
    category = "product_category_name"
    tables = {name: normalize_strings(frame) for name, frame in raw.items()}
    tables |= {"order_items": items, "payments": payments, "reviews": reviews}
    measured = {c: F.col(c) <= 0 for c in expected_non_positive}
    translated = Reference("products", category, "category_translation", category, tuple(known_manual))
    found = audit(
        tables,
        demanded_rules() | {"products": measured},
        {name: KEYS[name] for name in raw},
        [*(Reference(*relation) for relation in FOREIGN_KEYS), translated],
    )
    kind, rule, table = F.col("kind"), F.col("rule"), F.col("table_name")
    is_measure = (kind == "row") & (table == "products")
    is_category = rule == translated.name
    expected = F.lit(0).cast("long")
    for name, count in expected_non_positive.items():
        expected = F.when(rule == name, F.lit(count).cast("long")).otherwise(expected)
    findings = found.select(
        F.when(is_measure, "non-positive measurements are as known")
        .when(kind == "row", rule)
        .when(kind == "missing", "key is present")
        .when(kind == "key", "key is unique")
        .when(is_category, "categories are translated")
        .otherwise("parent exists")
        .alias("check_name"),
        F.when(is_measure | ((kind == "reference") & ~is_category), rule).otherwise(table).alias("subject"),
        F.when(is_measure, F.abs(F.col("failing") - expected)).otherwise(F.col("failing")).alias("failing"),
    )
    # The verdict is the grand total, from the same pass over the findings.
    check, subject = F.col("check_name"), F.col("subject")
    total = F.col("_is_total") == 1
    return (
        findings.groupingSets([[check, subject], []], check, subject)
        .agg(
            F.sum("failing").alias("_failing"),
            count_where(F.col("failing") > 0).alias("_failed_checks"),
            F.grouping(check).alias("_is_total"),
        )
        .select(
            F.when(total, "overall").otherwise(check).alias("check_name"),
            F.when(total, "all").otherwise(subject).alias("subject"),
            F.when(total, F.col("_failed_checks")).otherwise(F.col("_failing")).alias("failing"),
        )
        .withColumn("status", _status(F.col("failing") == 0))
    )
