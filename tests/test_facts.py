from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

from dispatchlens.operators import cleaning, facts, investigation
from dispatchlens.settings import Settings
from tests.helpers import by, order, text_table
from tests.test_cleaning import payments_of

SETTINGS = Settings()


def items_of(spark, *records):
    rows = [
        {
            "order_id": o, "order_item_id": str(n), "product_id": p, "seller_id": s,
            "shipping_limit_date": "2018-01-12 00:00:00", "price": price, "freight_value": "1.00",
        }
        for n, (o, p, s, price) in enumerate(records, 1)
    ]
    return cleaning.clean_order_items(text_table(spark, "order_items", rows))


def reviews_of(spark, *records):
    rows = [
        {
            "review_id": f"r{n}", "order_id": o, "review_score": str(score),
            "review_creation_date": "2018-02-01 00:00:00",
            "review_answer_timestamp": "2018-02-02 00:00:00",
        }
        for n, (o, score) in enumerate(records)
    ]
    return cleaning.clean_reviews(text_table(spark, "reviews", rows))


def test_items_of_a_hot_order_and_of_none(spark):
    rng, rows = random.Random(5), []
    for n in range(1500):
        name = "hot" if n % 3 == 0 else f"o{rng.randint(1, 300)}"
        rows.append((name, f"p{rng.randint(1, 9)}", f"s{rng.randint(1, 40)}", f"{rng.randint(1, 999)}.25"))
    rows += [("bare", None, None, "2.00"), ("half", "p1", None, None), (None, "p1", "s1", "1.00")]
    items = items_of(spark, *rows)
    got = by(facts.item_summary(items), "order_id")
    assert set(got) == {r[0] for r in rows}
    for name, row in got.items():
        mine = [r for r in rows if r[0] == name]
        assert row.item_count == len(mine)
        assert row.product_count == len({r[1] for r in mine} - {None})
        assert row.seller_count == len({r[2] for r in mine} - {None})
        prices = [Decimal(r[3]) for r in mine if r[3]]
        assert row.merchandise_value == (sum(prices) if prices else None)
        assert row.freight_value == len(mine)
    plan = facts.item_summary(items)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("partial_sum") >= 3


def test_order_facts_count_every_child_once(spark):
    orders = text_table(
        spark, "orders", [order("a", customer_id="c1"), order("b", customer_id="c1")]
    )
    customers = spark.createDataFrame(
        [("c1", "u1", 12345, "town", "SP"), ("c2", "u2", 1, "x", "RJ")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string",
    )
    items = items_of(
        spark, ("a", "p1", "s1", "10.00"), ("a", "p1", "s2", "5.50"), ("a", "p2", "s1", "1.00")
    )
    payments = payments_of(spark, ("a", 2, 0, "10.00"), ("a", 4, 1, "0.00"))
    reviews = reviews_of(spark, ("a", 5), ("a", 4), ("a", 4))
    timed = cleaning.order_timing(orders, SETTINGS)
    got = by(facts.order_facts(timed, customers, items, payments, reviews), "order_id")
    a, b = got["a"], got["b"]
    assert list(a.asDict()) == facts.FACT_COLUMNS
    assert (a.item_count, a.product_count, a.seller_count) == (3, 2, 2)
    assert (a.merchandise_value, a.freight_value, a.item_total_value) == (
        Decimal("16.50"), Decimal("3.00"), Decimal("19.50"),
    )
    assert (a.payment_record_count, a.recorded_payment_value) == (2, Decimal("10.00"))
    assert a.has_invalid_installment and a.has_zero_value_payment
    assert a.has_payment_sequence_start_missing and a.has_payment_sequence_internal_gap
    assert (a.review_record_count, a.average_review_score) == (3, Decimal("4.3333"))
    assert (a.purchase_date, a.purchase_month) == (date(2018, 1, 10), date(2018, 1, 1))
    assert (b.item_count, b.payment_record_count, b.review_record_count) == (0, 0, 0)
    assert b.merchandise_value is None and b.recorded_payment_value is None
    assert b.has_invalid_installment is False and b.average_review_score is None
    assert a.has_order_items and not b.has_order_items and not b.has_payment


def test_monthly_kpis_average_the_right_orders(spark):
    late = {"order_delivered_customer_date": "2018-01-21 00:00:00"}
    orders = text_table(
        spark,
        "orders",
        [
            order("a"), order("b", **late), order("c", order_status="canceled"),
            order("out", "2018-09-01 00:00:00"),
        ],
    )
    timed = cleaning.order_timing(orders, SETTINGS)
    # Order a has reviews 5 and 4, order b one review 1: each order weighs the same.
    measures = facts.order_measures(
        timed,
        items_of(spark, ("a", "p", "s", "1.00")),
        payments_of(spark, ("a", 1, 1, "10.00"), ("a", 2, 1, "5.00"), ("b", 1, 1, "0.01")),
        reviews_of(spark, ("a", 5), ("a", 4), ("b", 1)),
    )
    rows = facts.monthly_kpis(measures, SETTINGS).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.order_count, row.orders_with_payment_records) == (3, 2)
    assert row.recorded_payment_value == Decimal("15.01")
    # 15.01 / 2 = 7.505, half away from zero.
    assert row.average_order_value == Decimal("7.51")
    assert (row.delivery_kpi_order_count, row.on_time_delivery_count) == (2, 1)
    assert row.on_time_delivery_rate_pct == Decimal("50.00")
    assert row.average_delivery_days == Decimal("8.25")
    assert (row.reviewed_order_count, row.average_order_review_score) == (2, Decimal("2.75"))


def test_single_seller_orders(spark):
    items = items_of(
        spark,
        ("one", "p", "s1", "1.00"), ("one", "q", "s1", "1.00"),
        ("two", "p", "s1", "1.00"), ("two", "p", "s2", "1.00"),
        ("unknown", "p", None, "1.00"),
    )
    got = investigation.single_seller_orders(items).collect()
    assert [(r.order_id, r.seller_id) for r in got] == [("one", "s1")]
