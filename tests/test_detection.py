from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from dispatchlens.operators import decision, detection
from dispatchlens.settings import Settings
from tests.helpers import by

# Published monthly figures (month, orders, eligible, on time,
# rate, days, reviewed orders, score).
MONTHS = """
2017-01 800 750 727 96.93 12.65 790 4.06
2017-02 1780 1653 1600 96.79 13.17 1768 4.02
2017-03 2682 2546 2404 94.42 12.95 2661 4.07
2017-04 2404 2303 2122 92.14 14.92 2387 4.05
2017-05 3700 3545 3417 96.39 11.32 3666 4.14
2017-06 3245 3135 3014 96.14 12.01 3218 4.15
2017-07 4026 3872 3739 96.57 11.59 3990 4.18
2017-08 4331 4193 4054 96.68 11.15 4298 4.24
2017-09 4285 4150 3934 94.80 11.85 4251 4.19
2017-10 4631 4478 4241 94.71 11.86 4593 4.12
2017-11 7544 7288 6245 85.69 15.16 7480 3.91
2017-12 5673 5513 5051 91.62 15.39 5612 4.02
2018-01 7269 7069 6605 93.44 14.08 7201 4.04
2018-02 6728 6555 5507 84.01 16.95 6672 3.83
2018-03 7211 7003 5507 78.64 16.30 7148 3.75
2018-04 6939 6798 6437 94.69 11.50 6883 4.16
2018-05 6873 6749 6193 91.76 11.42 6839 4.19
2018-06 6167 6096 6013 98.64 9.24 6141 4.28
2018-07 6292 6156 5880 95.52 8.96 6247 4.26
2018-08 6512 6351 5691 89.61 7.73 6485 4.26
"""

SCHEMA = """purchase_month date, order_count bigint, delivery_kpi_order_count bigint,
    on_time_delivery_count bigint, on_time_delivery_rate_pct decimal(20,2),
    average_delivery_days decimal(20,2), reviewed_order_count bigint,
    average_order_review_score decimal(20,2)"""


def kpis(spark, lines):
    def row(line):
        m, orders, eligible, on_time, rate, days, reviewed, score = line.split()
        return (
            date.fromisoformat(m + "-01"), int(orders), int(eligible), int(on_time),
            Decimal(rate), Decimal(days), int(reviewed), Decimal(score),
        )

    return spark.createDataFrame([row(x) for x in lines.strip().splitlines()], SCHEMA)


def compared(spark, lines, settings=Settings()):
    return detection.delivery_comparisons(
        detection.monthly_comparison(kpis(spark, lines)), settings
    )


def test_published_months_give_the_published_issues(spark):
    comparisons = compared(spark, MONTHS).cache()
    assert comparisons.count() == 19
    issues = detection.delivery_issues(comparisons).collect()
    assert [(f"{r.current_month:%Y-%m}", r.on_time_delivery_change_pp) for r in issues] == [
        ("2018-02", Decimal("-9.43")), ("2017-11", Decimal("-9.02")),
        ("2018-08", Decimal("-5.91")), ("2018-03", Decimal("-5.37")),
    ]
    assert list(issues[0].asDict()) == detection.ISSUE_COLUMNS
    levels = {r.current_month: r.issue_severity for r in comparisons.collect() if r.issue_severity}
    assert sorted(levels.values()) == ["High", "High", "Moderate", "Moderate"]
    cards = by(decision.bi_issue_cards(comparisons), "current_month")
    got = {f"{m:%Y-%m}": (c.current_late_orders, c.excess_late_orders) for m, c in cards.items()}
    assert got == {
        "2018-02": (1048, Decimal("617.74")), "2017-11": (1043, Decimal("657.28")),
        "2018-08": (660, Decimal("375.26")), "2018-03": (1496, Decimal("376.37")),
    }
    second = by(comparisons, "current_month")[date(2017, 2, 1)]
    assert second.order_volume_change_pct == Decimal("122.50")
    assert second.average_delivery_days_change == Decimal("0.52")
    assert second.average_review_score_change == Decimal("-0.04")


def test_worst_and_requested_issue(spark):
    comparisons = compared(spark, MONTHS).cache()
    assert detection.worst_issue(comparisons).first().current_month == date(2018, 2, 1)
    asked = detection.worst_issue(comparisons, "2018-03").first()
    assert asked.on_time_delivery_change_pp == Decimal("-5.37")
    assert detection.delivery_issue_by_month(comparisons, date(2018, 4, 1)).isEmpty()
    with pytest.raises(ValueError):
        detection.require_issue(detection.worst_issue(comparisons, "2018-04"))


def test_thresholds_are_inclusive_and_need_consecutive_months(spark):
    lines = """
    2017-01 10 10 10 90.00 1.00 1 4.00
    2017-02 10 10 10 85.00 1.00 1 4.00
    2017-03 10 10 10 80.01 1.00 1 4.00
    2017-04 10 10 10 72.01 1.00 1 4.00
    2017-06 10 10 10 60.00 1.00 1 4.00
    2017-07 10 10 10 52.01 1.00 1 4.00
    """
    got = by(compared(spark, lines), "current_month")
    flags = {m.month: (r.is_consecutive_month, r.is_delivery_issue, r.issue_severity) for m, r in got.items()}
    assert flags == {
        2: (True, True, "Moderate"),
        3: (True, False, None),
        4: (True, True, "High"),
        6: (False, False, None),
        7: (True, True, "Moderate"),
    }


def test_ties_go_to_the_larger_then_the_earlier_month(spark):
    lines = """
    2017-01 10 100 10 90.00 1.00 1 4.00
    2017-02 10 100 10 80.00 1.00 1 4.00
    2017-03 10 200 10 70.00 1.00 1 4.00
    2017-04 10 200 10 60.00 1.00 1 4.00
    """
    got = [r.current_month.month for r in detection.delivery_issues(compared(spark, lines)).collect()]
    assert got == [3, 4, 2]


def test_months_without_eligible_orders_are_no_issue(spark):
    frame = spark.createDataFrame(
        [
            (date(2017, 1, 1), 5, 5, 5, Decimal("100.00"), Decimal("1.00"), 0, None),
            (date(2017, 2, 1), 5, 0, 0, None, None, 0, None),
        ],
        SCHEMA,
    )
    row = detection.delivery_comparisons(detection.monthly_comparison(frame), Settings()).first()
    assert row.on_time_delivery_change_pp is None
    assert not row.is_delivery_issue and row.issue_severity is None
