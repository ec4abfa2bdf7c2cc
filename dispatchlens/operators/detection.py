"""Month-over-month comparison and the months it singles out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from dispatchlens.functions.measures import per_count, rounded
from dispatchlens.functions.months import month_argument, parse_month
from dispatchlens.settings import Settings

# Measures of a month and the name of their month-over-month difference.
_COMPARED = {
    "order_count": None,
    "delivery_kpi_order_count": None,
    "on_time_delivery_count": None,
    "on_time_delivery_rate_pct": "on_time_delivery_change_pp",
    "average_delivery_days": "average_delivery_days_change",
    "reviewed_order_count": None,
    "average_order_review_score": "average_review_score_change",
}


def monthly_comparison(kpis: DataFrame) -> DataFrame:
    """Each month next to the month before it in the data.

    Rates, days and scores change by the difference of their published (rounded)
    values.  The window has no partition key: its input is one row per month.
    """
    by_month = Window.orderBy("purchase_month")
    names = ["purchase_month", *_COMPARED]
    paired = kpis.select(
        *names, *[F.lag(c).over(by_month).alias(f"_before_{c}") for c in names]
    ).filter(F.col("_before_purchase_month").isNotNull())

    month, before = F.col("purchase_month"), F.col("_before_purchase_month")
    orders, orders_before = F.col("order_count"), F.col("_before_order_count")
    growth = per_count((100 * (orders - orders_before)).cast("decimal(20,0)"), orders_before)
    columns: list[Column] = [
        month.alias("current_month"),
        before.alias("previous_month"),
        (before == F.add_months(month, -1)).alias("is_consecutive_month"),
    ]
    for name, change in _COMPARED.items():
        columns += [
            F.col(name).alias(f"current_{name}"),
            F.col(f"_before_{name}").alias(f"previous_{name}"),
        ]
        if name == "order_count":
            columns.append(rounded(growth).alias("order_volume_change_pct"))
        if change:
            difference = F.col(name) - F.col(f"_before_{name}")
            columns.append(rounded(difference).alias(change))
    return paired.select(*columns)


def severity(change: Column, settings: Settings) -> Column:
    return F.when(change <= F.lit(settings.high_change_pp), "High").when(
        change <= F.lit(settings.issue_change_pp), "Moderate"
    )


def delivery_comparisons(comparison: DataFrame, settings: Settings) -> DataFrame:
    """The comparison with the issue flag and the severity."""
    consecutive = F.col("is_consecutive_month")
    change = F.col("on_time_delivery_change_pp")
    return comparison.withColumns(
        {
            "is_delivery_issue": consecutive & (change <= F.lit(settings.issue_change_pp)),
            "issue_severity": F.when(consecutive, severity(change, settings)),
        }
    )


# The columns of an issue row, in their published order.
ISSUE_COLUMNS = [
    "previous_month", "current_month", "current_order_count",
    "current_delivery_kpi_order_count", "current_on_time_delivery_count",
    "current_on_time_delivery_rate_pct", "previous_on_time_delivery_rate_pct",
    "on_time_delivery_change_pp", "current_average_delivery_days",
    "average_delivery_days_change", "current_average_order_review_score",
    "average_review_score_change",
]


def worst_first() -> list[Column]:
    """Largest deterioration, then more eligible orders, then earlier month."""
    return [
        F.col("on_time_delivery_change_pp").asc(),
        F.col("current_delivery_kpi_order_count").desc(),
        F.col("current_month").asc(),
    ]


def detected_issues(comparisons: DataFrame) -> DataFrame:
    """Rows of ``delivery_comparisons`` that are issues."""
    return comparisons.filter("is_delivery_issue")


def delivery_issues(comparisons: DataFrame) -> DataFrame:
    """All issues, worst first."""
    return detected_issues(comparisons).select(*ISSUE_COLUMNS).orderBy(*worst_first())


def delivery_issue_by_month(comparisons: DataFrame, month: str | date) -> DataFrame:
    """The issue of one month; empty if the month is no issue."""
    wanted = F.col("current_month") == F.lit(month_argument(month))
    return detected_issues(comparisons).filter(wanted).select(*ISSUE_COLUMNS)


def worst_issue(comparisons: DataFrame, month: str | date | None = None) -> DataFrame:
    """The worst issue, or the requested one."""
    if month is not None:
        return delivery_issue_by_month(comparisons, month)
    return delivery_issues(comparisons).limit(1)


def require_issue(issue: DataFrame) -> DataFrame:
    """``issue`` itself, or an error if it is empty (a top-one driver check)."""
    if issue.isEmpty():
        raise ValueError("no qualifying delivery issue was detected")
    return issue


def parse_months(requests: DataFrame, column: str) -> DataFrame:
    """Requested months: the text, its first day, and whether it is valid."""
    month = parse_month(F.col(column))
    return requests.select(
        F.col(column).alias("request"), month.alias("month"), month.isNotNull().alias("is_valid")
    )

