from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dispatchlens.operators import cleaning, constraints, facts
from dispatchlens.settings import Settings
from tests.helpers import by, order, stamp, text_table

SETTINGS = Settings()


def timing(spark, *rows):
    return by(cleaning.order_timing(text_table(spark, "orders", list(rows)), SETTINGS), "order_id")


def test_window_is_half_open(spark):
    got = timing(
        spark,
        order("before", "2016-12-31 23:59:59"),
        order("first", "2017-01-01 00:00:00"),
        order("last", "2018-08-31 23:59:59"),
        order("end", "2018-09-01 00:00:00"),
        order("none", None),
    )
    inside = {k: r.is_primary_analysis_window for k, r in got.items()}
    assert inside == {
        "before": False, "first": True, "last": True, "end": False, "none": False,
    }


def test_on_time_limits_and_durations(spark):
    got = timing(
        spark,
        order("equal", order_delivered_customer_date="2018-01-20 00:00:00"),
        order("late", order_delivered_customer_date="2018-01-20 00:00:01"),
        order("not delivered", order_status="shipped"),
    )
    assert got["equal"].is_on_time_delivery is True
    assert got["equal"].late_delivery_days == Decimal("0.000000")
    assert got["late"].is_on_time_delivery is False
    # One second is 0.0000115740... days.
    assert got["late"].delivery_delay_days == Decimal("0.000012")
    assert got["late"].delivery_days == Decimal("10.000012")
    assert got["equal"].approval_to_carrier_days == Decimal("1.000000")
    skipped = got["not delivered"]
    assert skipped.is_delivery_kpi_eligible is False
    assert skipped.is_on_time_delivery is None and skipped.delivery_days is None
    assert skipped.late_delivery_days is None
    # Handling time does not ask for a delivery.
    assert skipped.is_handling_time_eligible is True


@pytest.mark.parametrize(
    "changes",
    [
        {"order_approved_at": "2018-01-09 00:00:00"},
        {"order_delivered_carrier_date": "2018-01-09 00:00:00"},
        {"order_delivered_carrier_date": "2018-01-10 05:00:00"},
        {"order_delivered_customer_date": "2018-01-09 00:00:00"},
        {"order_delivered_customer_date": "2018-01-11 05:00:00"},
        {"order_estimated_delivery_date": "2018-01-09 00:00:00"},
    ],
)
def test_each_chronology_rule(spark, changes):
    got = timing(
        spark, order("bad", **changes), order("shipped", order_status="shipped", **changes), order("ok")
    )
    assert got["bad"].has_operational_chronology_issue is True
    assert got["shipped"].has_operational_chronology_issue is False
    assert got["ok"].has_operational_chronology_issue is False


def test_missing_timestamps(spark):
    got = timing(
        spark,
        order("no approval", order_approved_at=None),
        order("no carrier", order_delivered_carrier_date=""),
        order("no delivery", order_delivered_customer_date="NA"),
        order("no promise", order_estimated_delivery_date=None),
        order("no status", order_status=None),
    )
    flags = {k: r.has_missing_operational_timestamp for k, r in got.items()}
    assert flags == {
        "no approval": True, "no carrier": True, "no delivery": True, "no promise": False,
        "no status": False,
    }
    assert got["no approval"].is_delivery_kpi_eligible is True
    assert got["no approval"].is_handling_time_eligible is False
    assert got["no delivery"].is_delivery_kpi_eligible is False
    assert got["no delivery"].has_operational_chronology_issue is False
    assert got["no promise"].is_delivery_kpi_eligible is False
    assert got["no status"].is_delivery_kpi_eligible is False


def test_presence_flags(spark):
    raw = text_table(spark, "orders", [order("a"), order("b"), order("c")])
    items = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "order_id string")
    payments = spark.createDataFrame([("b",)], "order_id string")
    got = by(cleaning.clean_orders(raw, items, payments, SETTINGS), "order_id")
    assert {k: (r.has_order_items, r.has_payment) for k, r in got.items()} == {
        "a": (True, False), "b": (True, True), "c": (False, False),
    }
    assert list(got["a"].asDict()) == cleaning.ORDER_COLUMNS


@pytest.mark.parametrize(
    "bad", [{"price": "free"}, {"order_item_id": "1.5"}, {"shipping_limit_date": "soon"}]
)
def test_unreadable_values_fail_the_job(spark, bad):
    row = {
        "order_id": "a", "order_item_id": "1.0", "product_id": "p", "seller_id": "s",
        "shipping_limit_date": "2018-01-01 00:00:00", "price": " 10.10 ", "freight_value": "0.05",
    }
    fine = cleaning.clean_order_items(text_table(spark, "order_items", [row])).first()
    assert fine.order_item_id == 1 and fine.item_total == Decimal("10.15")
    with pytest.raises(PySparkException, match="order_items"):
        cleaning.clean_order_items(text_table(spark, "order_items", [row | bad])).collect()


def test_products(spark):
    rows = [
        {"product_id": "1", "product_category_name": "beleza", "product_weight_g": "0"},
        {"product_id": "2", "product_category_name": "pc_gamer", "product_weight_g": "-1"},
        {"product_id": "3", "product_weight_g": "2.50"},
        {"product_id": "4", "product_category_name": "novo", "product_photos_qty": "2"},
    ]
    lookup = text_table(
        spark,
        "category_translation",
        [{"product_category_name": "beleza", "product_category_name_english": "beauty"}],
    )
    products = cleaning.clean_products(text_table(spark, "products", rows), lookup)
    got = by(products, "product_id")
    english = {k: (r.product_category_name_english, r.category_translation_source) for k, r in got.items()}
    assert english == {
        "1": ("beauty", "official"), "2": ("pc_gamer", "manual"), "3": (None, "missing"),
        "4": (None, None),
    }
    weights = [got[k].product_weight_g for k in "123"]
    assert weights == [None, None, Decimal("2.50")]
    assert [r[0] for r in cleaning.untranslated_categories(products).collect()] == ["novo"]


def test_a_category_translated_twice_fails(spark):
    twice = [{"product_category_name": "x", "product_category_name_english": e} for e in "ab"]
    lookup = text_table(spark, "category_translation", twice)
    products = text_table(spark, "products", [{"product_id": "1", "product_category_name": "x"}])
    with pytest.raises(PySparkException, match="repeats x"):
        cleaning.clean_products(products, lookup).collect()


def payments_of(spark, *records):
    rows = [
        {
            "order_id": o, "payment_sequential": str(n), "payment_type": "voucher",
            "payment_installments": str(i), "payment_value": v,
        }
        for o, n, i, v in records
    ]
    return cleaning.clean_payments(text_table(spark, "payments", rows))


def test_payment_flags(spark):
    payments = payments_of(
        spark,
        ("late start", 2, 0, "1.00"), ("late start", 3, 1, "0.00"),
        ("gap", 1, 1, "1.00"), ("gap", 3, 1, "1.00"),
        ("fine", 1, 1, "1.00"),
        ("repeated", 1, 1, "1.00"), ("repeated", 1, 1, "1.00"), ("repeated", 2, 1, "1.00"),
    )
    flagged = cleaning.payment_flags(payments).collect()
    assert len(flagged) == 8
    got = {(r.order_id, r.payment_sequence_start_missing, r.payment_sequence_internal_gap) for r in flagged}
    assert got == {
        ("late start", True, False), ("gap", False, True), ("fine", False, False),
        ("repeated", False, False),
    }
    odd = {(r.order_id, r.payment_sequential): (r.is_invalid_installment, r.is_zero_value_payment) for r in flagged}
    assert odd["late start", 2] == (True, False) and odd["late start", 3] == (False, True)


def test_payment_numbers_in_several_words(spark):
    rng = random.Random(3)
    orders = {
        "long": list(range(1, 200)), "long gap": [*range(1, 64), *range(66, 130)], "edge": [63, 64, 65], "far": [1, 32000],
        "hot": [n % 150 + 1 for n in range(5000)], "below": [-65, -64, -63, 0, 1], "one": [128],
    }
    orders |= {f"r{k}": [rng.randint(1, 140) for _ in range(rng.randint(1, 200))] for k in range(20)}
    payments = payments_of(spark, *[(o, n, 1, "1.00") for o, numbers in orders.items() for n in numbers])
    payments = payments.union(payments.limit(1).withColumn("order_id", F.lit(None).cast("string")))
    payments = payments.union(payments.limit(1).withColumn("payment_sequential", F.lit(None).cast("short")))
    got = by(cleaning.payment_sequences(payments), "order_id")
    summary = by(facts.payment_summary(payments), "order_id")
    for name, numbers in orders.items():
        row, extra = got[name], name == "long"
        seen, span = set(numbers), max(numbers) - min(numbers) + 1
        assert (row.payment_rows, row.observed_sequences) == (len(numbers) + extra, len(seen))
        assert (row.minimum_sequence, row.maximum_sequence, row.expected_sequences) == (min(seen), max(seen), span)
        assert row.payment_sequence_start_missing == (min(seen) > 1) == summary[name].has_payment_sequence_start_missing
        assert row.payment_sequence_internal_gap == (len(seen) != span) == summary[name].has_payment_sequence_internal_gap
        assert summary[name].payment_record_count == len(numbers) + extra
    flagged = cleaning.payment_flags(payments).collect()
    assert len(flagged) == payments.count()
    assert {r.payment_sequence_internal_gap for r in flagged if r.order_id is None} == {False}


def test_constraints_on_clean_and_broken_rows(spark):
    raw = text_table(
        spark, "orders", [order("a" * 32, customer_id="c" * 32), order("b", order_status="lost")]
    )
    orders = cleaning.clean_orders(
        raw, raw.select("order_id"), raw.select("order_id").limit(0), SETTINGS
    )
    rules = constraints.row_rules(SETTINGS)["orders"]

    def failing(frame):
        from dispatchlens.operators.quality import rules_failing

        report = rules_failing("orders", frame, {n: ~constraints.kept(r) for n, r in rules.items()})
        return {r.rule: r.failing for r in report.collect() if r.failing}

    assert failing(orders) == {"order_id length": 1, "customer_id length": 1, "status code": 1}
    broken = orders.filter("order_status = 'delivered'").withColumns(
        {
            "is_on_time_delivery": F.lit(False),
            "delivery_days": F.lit(None).cast("decimal(14,6)"),
            "approval_to_carrier_days": F.lit(-1).cast("decimal(14,6)"),
            "is_primary_analysis_window": F.lit(False),
            "has_missing_operational_timestamp": F.lit(True),
            "late_delivery_days": F.lit(-1).cast("decimal(14,6)"),
            "order_estimated_delivery_date": F.lit(stamp("2018-01-20")).cast("timestamp_ntz"),
        }
    )
    assert failing(broken) == {
        "window flag": 1, "missing timestamp flag": 1, "delivery measures fit eligibility": 1,
        "on-time flag": 1, "late days not negative": 1, "handling time fits eligibility": 1,
    }
    # A rule about a missing value is not broken by it; only "required" is.
    unknown = orders.filter("order_status = 'delivered'").withColumn(
        "order_status", F.lit(None).cast("string")
    )
    assert "status code" not in failing(unknown)
    assert failing(unknown)["order_status required"] == 1
