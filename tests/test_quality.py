from __future__ import annotations

import pytest

from dispatchlens.operators import cleaning, quality
from dispatchlens.plans import reports
from dispatchlens.settings import Settings
from tests.helpers import by, order, text_table
from tests.test_cleaning import payments_of
from tests.test_facts import items_of, reviews_of


def metrics(frame):
    return {r.metric: r.value for r in frame.collect()}


def test_profile_counts_missing_repeated_and_equal_rows(spark):
    sellers = text_table(
        spark,
        "sellers",
        [
            {"seller_id": "a", "seller_state": "SP"},
            {"seller_id": " a ", "seller_state": "SP"},
            {"seller_id": "a", "seller_state": "RJ"},
            {"seller_id": None, "seller_state": "SP"},
            {"seller_id": "", "seller_state": "RJ"},
            {"seller_id": "b"},
        ],
    )
    row = quality.table_profile({"sellers": sellers}).first()
    # Rows after the first of a key count as repeated; missing keys are equal.
    assert (row.row_count, row.column_count, row.missing_key_rows) == (6, 4, 2)
    assert (row.duplicate_key_rows, row.exact_duplicate_rows) == (3, 1)
    assert row.status == "FAIL"
    violations = quality.key_violations({"sellers": cleaning.normalize_strings(sellers)}).first()
    assert (violations.missing_key_rows, violations.duplicate_key_rows) == (2, 3)
    clean = text_table(spark, "sellers", [{"seller_id": "a"}, {"seller_id": "b"}])
    assert quality.table_profile({"sellers": clean}).first().status == "OK"
    empty = quality.table_profile({"sellers": clean.limit(0)}).first()
    assert (empty.row_count, empty.duplicate_key_rows, empty.status) == (0, 0, "OK")
    missing = {r.column_name: r.missing for r in quality.missing_values({"sellers": clean}).collect()}
    assert missing == {"seller_zip_code_prefix": 2, "seller_city": 2, "seller_state": 2}


def test_invalid_values_count_what_is_present_but_unreadable(spark):
    payments = text_table(
        spark,
        "payments",
        [
            {"order_id": "a", "payment_value": "1.00", "payment_installments": "x"},
            {"order_id": "b", "payment_value": "1,00", "payment_installments": None},
        ],
    )
    orders = text_table(spark, "orders", [order("a", order_approved_at="soon"), order("b")])
    got = {
        (r.table_name, r.column_name): r.invalid
        for r in quality.invalid_values({"payments": payments, "orders": orders}).collect()
        if r.invalid
    }
    assert got == {
        ("payments", "payment_value"): 1, ("payments", "payment_installments"): 1,
        ("orders", "order_approved_at"): 1,
    }


def test_orphans_and_coverage(spark):
    orders = spark.createDataFrame(
        [("a", "c1"), ("b", "c9"), ("c", "c9"), ("d", None)], "order_id string, customer_id string"
    )
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    items = spark.createDataFrame(
        [("a", "p1", "s1"), ("z", "p1", "s1"), ("z", "p2", "s2"), ("y", None, "s2")],
        "order_id string, product_id string, seller_id string",
    )
    products = spark.createDataFrame([("p1",)], "product_id string")
    sellers = spark.createDataFrame([("s1",)], "seller_id string")
    payments = spark.createDataFrame([("a",), ("b",), (None,)], "order_id string")
    reviews = spark.createDataFrame([("x",)], "order_id string")
    got = {
        r.relationship.split(" ")[0]: r.orphan_keys
        for r in quality.fk_orphans(
            {
                "orders": orders, "customers": customers, "order_items": items,
                "products": products, "sellers": sellers, "payments": payments, "reviews": reviews,
            }
        ).collect()
    }
    assert got == {
        "orders.customer_id": 1, "order_items.order_id": 2, "order_items.product_id": 1,
        "order_items.seller_id": 1, "payments.order_id": 0, "reviews.order_id": 1,
    }
    assert metrics(quality.order_coverage(orders, items, payments, reviews)) == {
        "orders without items": 3, "orders without payments": 2, "orders without reviews": 4,
    }


def test_rules_pass_on_unknown_values(spark):
    items = items_of(spark, ("a", "p", "s", "0.00"), ("a", "p", "s", "5.00"), ("a", "p", "s", None))
    payments = payments_of(spark, ("a", 0, 1, "-1.00"), ("a", 1, 1, "0.00"))
    reviews = reviews_of(spark, ("a", 6), ("a", 0), ("a", 5))
    got = {r.rule: r.failing for r in quality.rule_violations(items, payments, reviews).collect()}
    assert got == {
        "price is positive": 1, "freight is not negative": 0, "sequence starts at one": 1,
        "value is not negative": 1, "score lies between one and five": 2,
    }


def test_reviews_customers_and_payments(spark):
    reviews = reviews_of(spark, ("a", 5), ("a", 4), ("b", 6)).unionByName(
        reviews_of(spark, ("c", 5))
    )
    got = metrics(quality.review_validation(reviews))
    # The last review repeats the id of the first on another order.
    assert got == {
        "missing scores": 0, "scores out of range": 1, "lowest score": 4, "highest score": 6,
        "orders with several reviews": 1, "most reviews of one order": 2,
        "review ids on several orders": 1,
    }
    scores = quality.score_distribution(reviews).collect()
    assert [(r.review_score, r.reviews) for r in scores] == [(4, 1), (5, 2), (6, 1)]
    customers = spark.createDataFrame(
        [("1", "u"), ("2", "u"), ("3", "u"), ("4", "v"), ("5", None)],
        "customer_id string, customer_unique_id string",
    )
    assert metrics(quality.customer_identity(customers)) == {
        "distinct customer ids": 5, "distinct identities": 2, "repeated identities": 1,
        "most records of one identity": 3,
    }
    payments = payments_of(
        spark, ("a", 2, 0, "0.00"), ("b", 1, 1, "1.00"), ("b", 3, 1, "-1.00")
    )
    checked = quality.payment_validation(payments, cleaning.payment_sequences(payments))
    assert metrics(checked) == {
        "installments not positive": 1, "zero value": 1, "negative value": 1,
        "sequences starting above one": 1, "sequences with gaps": 1,
    }


def test_categories_and_measurements(spark):
    products = text_table(
        spark,
        "products",
        [
            {"product_id": "1", "product_category_name": "x", "product_weight_g": "0"},
            {"product_id": "2", "product_category_name": "y", "product_weight_g": "-1",
             "product_width_cm": "0"},
            {"product_id": "3", "product_category_name": "z"},
            {"product_id": "4"},
        ],
    )
    lookup = text_table(
        spark,
        "category_translation",
        [{"product_category_name": c, "product_category_name_english": c} for c in ("x", "q")],
    )
    found = {
        r.category: r.finding for r in quality.category_coverage(products, lookup, ["y"]).collect()
    }
    assert found == {"y": "manual mapping", "z": "unexpected", "q": "unused"}
    typed = products.withColumns(
        {c: products[c].cast("decimal(12,2)") for c in quality.EXPECTED_NON_POSITIVE}
    )
    profile = by(quality.measurement_profile(typed), "column_name")
    weight = profile["product_weight_g"]
    assert (weight.missing, weight.zero, weight.negative, weight.non_positive) == (2, 1, 1, 2)
    assert weight.as_expected is False and profile["product_length_cm"].as_expected is True
    assert profile["any measurement"].non_positive == 2


@pytest.mark.parametrize(
    ("actual", "state"),
    [
        ({"orders": 0, "sellers": 0}, "empty"),
        ({"orders": 3, "sellers": 2}, "loaded"),
        ({"orders": 3, "sellers": 0}, "partial"),
        ({"orders": 3, "sellers": 1}, "partial"),
    ],
)
def test_load_state(spark, actual, state):
    counts = spark.createDataFrame(list(actual.items()), "table_name string, actual_rows bigint")
    expected = quality.expected_counts(counts, {"orders": 3, "sellers": 2})
    assert quality.load_state(expected).first().state == state
    contract = by(quality.row_count_contract(expected), "table_name")
    assert contract["orders"].status == ("OK" if actual["orders"] == 3 else "FAIL")


def test_preflight_names_the_columns(spark):
    good = text_table(spark, "sellers", [{"seller_id": "a"}])
    bad = good.drop("seller_city").withColumnRenamed("seller_state", "state")
    row = quality.source_preflight({"sellers": bad}).first()
    assert (row.records, row.missing_columns, row.unexpected_columns, row.status) == (
        1, "seller_city, seller_state", "state", "FAIL",
    )
    assert quality.source_preflight({"sellers": good}).first().status == "OK"


def test_export_contract(spark):
    states = spark.createDataFrame(
        [("i1", "RJ"), ("i1", "RJ"), ("i2", "SP")], "issue_id string, customer_state string"
    )
    row = reports.export_contract({"delivery_issue_states": states}).first()
    assert (row.row_count, row.repeated_keys, row.overfull_groups, row.status) == (3, 1, 0, "FAIL")
    many = spark.range(16).selectExpr("'i1' issue_id", "cast(id as string) seller_id", "1 order_id")
    row = reports.export_contract({"delivery_issue_sellers": many}).first()
    assert (row.overfull_groups, row.identifying_columns) == (1, 1)
    empty = reports.export_contract({"delivery_issue_states": states.limit(0)}).first()
    assert (empty.row_count, empty.status) == (0, "FAIL")


def test_report_verdict(spark):
    orders = spark.createDataFrame([("a", "c1")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    items = items_of(spark, ("a", "p", "s", "1.00"))
    payments = payments_of(spark, ("a", 1, 1, "1.00"))
    reviews = reviews_of(spark, ("a", 5))
    products = text_table(
        spark, "products", [{"product_id": "p", "product_category_name": "x"}]
    )
    typed = products.withColumns(
        {c: products[c].cast("decimal(12,2)") for c in quality.EXPECTED_NON_POSITIVE}
    )
    raw = {
        "orders": orders, "customers": customers, "order_items": items, "payments": payments,
        "reviews": reviews, "products": typed,
        "sellers": spark.createDataFrame([("s",)], "seller_id string"),
        "category_translation": text_table(
            spark, "category_translation", [{"product_category_name": "x"}]
        ),
    }

    def verdict(frames, expected):
        report = quality.dq_report(frames, items, payments, reviews, [], expected)
        return by(report, "check_name")["overall"]

    none = dict.fromkeys(quality.EXPECTED_NON_POSITIVE, 0)
    good = verdict(raw, none)
    assert (good.failing, good.status) == (0, "OK")
    bad = verdict(raw | {"customers": customers.limit(0)}, none | {"product_weight_g": 4})
    assert (bad.failing, bad.status) == (2, "FAIL")


def test_cleaning_summary(spark):
    settings = Settings()
    items = items_of(spark, ("a", "p", "s", "1.00"))
    payments = payments_of(spark, ("a", 2, 0, "0.00"), ("a", 4, 1, "1.00"))
    orders = cleaning.clean_orders(
        text_table(
            spark,
            "orders",
            [order("a"), order("b", order_delivered_carrier_date="2018-01-09 00:00:00")],
        ),
        items, payments, settings,
    )
    lookup = text_table(spark, "category_translation", [])
    products = cleaning.clean_products(
        text_table(
            spark, "products", [{"product_id": "p", "product_category_name": "pc_gamer"}, {"product_id": "q"}]
        ),
        lookup,
    )
    got = metrics(
        quality.cleaning_summary(
            {
                "orders": orders, "order_items": items, "payments": payments, "products": products,
                "reviews": reviews_of(spark, ("a", 5), ("a", 4)),
                "customers": spark.createDataFrame(
                    [("1", "u"), ("2", "u")], "customer_id string, customer_unique_id string"
                ),
                "sellers": spark.createDataFrame([("s",)], "seller_id string"),
            },
            cleaning.payment_sequences(payments),
        )
    )
    assert len(got) == 28
    assert {k: v for k, v in got.items() if not k.startswith("rows of")} == {
        "orders in the window": 2, "orders without items": 1, "orders without payments": 1,
        "delivered orders": 2, "missing operational timestamps": 0, "chronology issues": 1,
        "carrier before purchase": 1, "carrier before approval": 1, "delivery before carrier": 0,
        "orders eligible for delivery KPIs": 2, "delivered orders eligible for handling time": 1,
        "products translated by hand": 1, "products without category": 1,
        "categories translated by hand": 1, "invalid installments": 1, "zero-value payments": 1,
        "orders whose payments start above one": 1, "orders with payment gaps": 1,
        "orders with several reviews": 1, "orders without reviews": 1,
        "repeated customer identities": 1,
    }
