"""Drill-down into detected issues: all issues in one job.

An issue compares two months.  The issue table is turned into one row per issue
and period and joined to the orders by month, so an order that is "current" for
one issue and "previous" for the next takes part in both.  Every result is keyed
by the issue; investigating a single issue is a filter on the issue table.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispatchlens.functions.measures import (
    count_where,
    days_between,
    excess_late,
    expected_late,
    per_count,
    percent,
    rounded,
)
from dispatchlens.operators.detection import detected_issues
from dispatchlens.operators.keyed import broadcast_months
from dispatchlens.settings import Settings

ISSUE_KEYS = ["issue_id", "previous_month", "current_month", "issue_change_pp", "issue_severity"]
PERIODS = ("previous", "current")


def issue_keys(comparisons: DataFrame) -> DataFrame:
    """The dimensions that every detail row of an issue carries."""
    month = F.date_format("current_month", "yyyy-MM")
    return detected_issues(comparisons).select(
        F.concat(F.lit("delivery-"), month).alias("issue_id"),
        "previous_month",
        "current_month",
        F.col("on_time_delivery_change_pp").alias("issue_change_pp"),
        "issue_severity",
    )


def issue_periods_to_read(issues: DataFrame, settings: Settings) -> DataFrame:
    """Two rows per issue: which month plays which part.

    At most one issue per month of the window, so the table is broadcast.
    """
    periods = F.array(
        *[
            F.struct(F.col(f"{p}_month").alias("purchase_month"), F.lit(p).alias("period_label"))
            for p in PERIODS
        ]
    )
    rows = issues.select(*ISSUE_KEYS, F.inline(periods))
    return broadcast_months(rows, 2 * settings.window_months)


def _in_window_months(settings: Settings) -> Column:
    """Purchases in a month the window touches, and thus in any issue's month."""
    purchase = F.col("order_purchase_timestamp")
    first = settings.window_start.replace(day=1)
    last = settings.window_end.replace(day=1)
    after = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    return (purchase >= F.lit(first).cast("timestamp_ntz")) & (
        purchase < F.lit(after).cast("timestamp_ntz")
    )


def investigation_orders(orders: DataFrame, issues: DataFrame, settings: Settings) -> DataFrame:
    """Orders of the issues' months with the measures only the drill-down uses.

    The months are known only at run time; the window they lie in is known
    before, and restricts the scan.
    """
    eligible = F.col("is_delivery_kpi_eligible")
    promised, purchase = F.col("order_estimated_delivery_date"), F.col("order_purchase_timestamp")
    carrier = F.col("order_delivered_carrier_date")
    customer = F.col("order_delivered_customer_date")
    candidates = orders.filter(_in_window_months(settings))
    return candidates.join(issue_periods_to_read(issues, settings), "purchase_month").withColumns(
        {
            "is_late_delivery": F.when(eligible, ~F.col("is_on_time_delivery")),
            "promise_window_days": F.when(eligible, days_between(promised, purchase)),
            "carrier_to_customer_days": F.when(
                customer >= carrier, days_between(customer, carrier)
            ),
        }
    )


def single_seller_orders(items: DataFrame) -> DataFrame:
    """Orders all of whose items come from one seller.

    Exactly one distinct seller means that the least and the greatest agree,
    which needs no distinct aggregation.
    """
    return (
        items.groupBy("order_id")
        .agg(F.min("seller_id").alias("seller_id"), F.max("seller_id").alias("_last"))
        .filter(F.col("seller_id") == F.col("_last"))
        .select("order_id", "seller_id")
    )


def with_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the state they go to, null where the customer is unknown."""
    return orders.join(customers.select("customer_id", "customer_state"), "customer_id", "left")


def with_single_seller(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their only seller, null where there are none or several."""
    return with_seller(orders, single_seller_orders(items))


def with_seller(orders: DataFrame, single: DataFrame) -> DataFrame:
    """Orders with their seller of ``single_seller_orders``."""
    seller = single.withColumnRenamed("seller_id", "single_seller_id")
    return orders.join(seller, "order_id", "left")


# What a level of the drill-down groups by, beside issue and period.
LEVELS: dict[str, str | None] = {"all": None, "state": "customer_state", "seller": "single_seller_id"}

# Averaged measures: the column, and the orders it is averaged over.
_AVERAGED = {
    "delivery": ("delivery_days", "eligible"),
    "lateness": ("late_delivery_days", "late"),
    "promise": ("promise_window_days", "eligible"),
    "handling": ("approval_to_carrier_days", "handled"),
    "transport": ("carrier_to_customer_days", "all"),
    "score": ("average_review_score", "reviewed"),
    # Sellers are judged by their eligible orders alone.
    "eligible_handling": ("approval_to_carrier_days", "eligible handled"),
    "eligible_score": ("average_review_score", "eligible reviewed"),
}


def _measures(orders: DataFrame, levels: Iterable[str]) -> list[Column]:
    """Counts and sums of a group of orders, which the results are made of.

    A measure whose column the orders do not carry is left out, as no result of the
    levels asked for shows it.
    """
    eligible = F.col("is_delivery_kpi_eligible")
    kept = {
        "all": F.lit(True),
        "eligible": eligible,
        "late": eligible & F.col("is_late_delivery"),
        "on_time": eligible & ~F.col("is_late_delivery"),
        "handled": F.col("is_handling_time_eligible"),
    }
    if "average_review_score" in orders.columns:
        kept["reviewed"] = F.col("review_record_count") > 0
    if "single_seller_id" in orders.columns:
        kept["single"] = eligible & F.col("single_seller_id").isNotNull()
    columns = [count_where(condition).alias(f"{name}_orders") for name, condition in kept.items()]
    for name, (column, where) in _AVERAGED.items():
        if column in orders.columns and set(where.split()) <= set(kept):
            condition = reduce(Column.__and__, [kept[w] for w in where.split()])
            value = F.when(condition, F.col(column))
            columns += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count")]
    return [*columns, F.min("purchase_month").alias("period_month")]


def drill_down(orders: DataFrame, levels: Iterable[str]) -> DataFrame:
    """Measures per issue, period and level: all orders, by customer state, by single seller.

    One pass over the orders of the issues' months gives all levels; what leaves it has a
    row per issue, period and member.  ``orders`` carry state and seller as the levels need
    them, and review scores if a result shows them.
    """
    levels = list(levels)
    keys = [*ISSUE_KEYS, "period_label"]
    members = [m for m in (LEVELS[level] for level in levels) if m]
    measures = _measures(orders, levels)
    if len(levels) == 1:
        grouped = orders.groupBy(*keys, *members).agg(*measures)
        member = F.col(members[0]).cast("string") if members else F.lit(None).cast("string")
        return grouped.select(
            F.lit(levels[0]).alias("level"), *keys, member.alias("member"),
            *[c for c in grouped.columns if c not in {*keys, *members}],
        )
    sets = [[F.col(c) for c in (*keys, LEVELS[level]) if c] for level in levels]
    flags = {m: F.grouping(m).alias(f"_without_{m}") for m in members}
    # A grouping column is null outside its level, so measures read a copy of the seller.
    columns = [F.col(c) for c in (*keys, *members)]
    grouped = orders.groupingSets(sets, *columns).agg(*measures, *flags.values())
    level, member = F.lit("all"), F.lit(None).cast("string")
    for name in levels:
        if column := LEVELS[name]:
            level = F.when(F.col(f"_without_{column}") == 0, name).otherwise(level)
            member = F.when(F.col(f"_without_{column}") == 0, F.col(column).cast("string")).otherwise(member)
    rest = [c for c in grouped.columns if c not in {*keys, *members} and not c.startswith("_without_")]
    return grouped.select(level.alias("level"), *keys, member.alias("member"), *rest)


def _of_level(measured: DataFrame, level: str) -> DataFrame:
    """Rows of a level; orders that have no state or no single seller have no member."""
    rows = measured.filter(F.col("level") == level)
    return rows if LEVELS[level] is None else rows.filter(F.col("member").isNotNull())


def _mean_of(measure: str, prefix: str = "") -> Column:
    return per_count(F.col(f"{prefix}{measure}_sum"), F.col(f"{prefix}{measure}_count"))


def periods_of(measured: DataFrame) -> DataFrame:
    """Delivery stages per issue and period."""
    return _of_level(measured, "all").select(
        *ISSUE_KEYS,
        "period_label",
        "all_orders",
        F.col("eligible_orders").alias("delivery_eligible_orders"),
        "late_orders",
        rounded(percent(F.col("on_time_orders"), F.col("eligible_orders"))).alias("on_time_delivery_rate_pct"),
        rounded(_mean_of("delivery")).alias("average_delivery_days"),
        rounded(_mean_of("lateness")).alias("average_late_days_among_late_orders"),
        rounded(_mean_of("promise")).alias("average_promise_window_days"),
        F.col("handled_orders").alias("handling_eligible_orders"),
        rounded(_mean_of("handling")).alias("average_handling_days"),
        F.col("transport_count").alias("carrier_transport_eligible_orders"),
        rounded(_mean_of("transport")).alias("average_carrier_to_customer_days"),
        "reviewed_orders",
        rounded(_mean_of("score")).alias("average_order_review_score"),
        "period_month",
    )


def issue_periods(orders: DataFrame) -> DataFrame:
    """Delivery stages per issue and period; ``orders`` carry review scores."""
    return periods_of(drill_down(orders, ["all"]))


def _side_by_side(rows: DataFrame, *averaged: str) -> DataFrame:
    """Both periods of a group in one row: eligible and late orders, sums and counts."""
    columns, zero = [], F.lit(0).cast("long")

    def of(period: str, column: str) -> Column:
        return F.max(F.when(F.col("period_label") == period, F.col(column)))

    for p in PERIODS:
        columns += [F.coalesce(of(p, c), zero).alias(f"{p}_{c}") for c in ("eligible_orders", "late_orders")]
        for name in averaged:
            columns += [of(p, f"{name}_{part}").alias(f"{p}_{name}_{part}") for part in ("sum", "count")]
    return rows.groupBy(*ISSUE_KEYS, "member").agg(*columns)


def _change(measure: str) -> Column:
    """Change of the unrounded mean from the previous to the current period."""
    return _mean_of(measure, "current_") - _mean_of(measure, "previous_")


def impact_of(measured: DataFrame) -> DataFrame:
    """Late orders beyond what the previous period's late rate would give."""
    both = _side_by_side(_of_level(measured, "all"))
    previous_late, previous_all = F.col("previous_late_orders"), F.col("previous_eligible_orders")
    current_late, current_all = F.col("current_late_orders"), F.col("current_eligible_orders")
    return both.select(
        *ISSUE_KEYS,
        previous_all,
        previous_late,
        rounded(percent(previous_late, previous_all)).alias("previous_late_rate_pct"),
        current_all,
        current_late,
        rounded(percent(current_late, current_all)).alias("current_late_rate_pct"),
        rounded(expected_late(current_all, previous_late, previous_all)).alias(
            "expected_current_late_orders"
        ),
        rounded(excess_late(current_late, current_all, previous_late, previous_all)).alias(
            "excess_late_orders"
        ),
    )


def issue_impact(orders: DataFrame) -> DataFrame:
    """Late orders beyond what the previous period's late rate would give."""
    return impact_of(drill_down(orders, ["all"]))


def _contributors(groups: DataFrame, group: list[str], changes: list[str], minimum: int) -> DataFrame:
    """Groups with enough eligible orders in both periods, with their rates."""
    previous, current = F.col("previous_eligible_orders"), F.col("current_eligible_orders")
    previous_late, current_late = F.col("previous_late_orders"), F.col("current_late_orders")
    large_enough = (previous >= minimum) & (current >= minimum)
    return (
        groups.filter(large_enough)
        .withColumns(
            {
                "previous_on_time_rate_pct": rounded(percent(previous - previous_late, previous)),
                "current_on_time_rate_pct": rounded(percent(current - current_late, current)),
                "excess_late_orders": rounded(
                    excess_late(current_late, current, previous_late, previous)
                ),
            }
        )
        .select(
            *ISSUE_KEYS,
            *group,
            "previous_eligible_orders",
            "current_eligible_orders",
            "previous_on_time_rate_pct",
            "current_on_time_rate_pct",
            rounded(
                F.col("current_on_time_rate_pct") - F.col("previous_on_time_rate_pct")
            ).alias("on_time_change_pp"),
            "current_late_orders",
            "excess_late_orders",
            *[rounded(F.col(c)).alias(c) for c in changes],
        )
    )


def _top(contributors: DataFrame, group: str, settings: Settings) -> DataFrame:
    """The largest contributors of each issue, ranked."""
    order = Window.partitionBy("issue_id").orderBy(
        F.col("excess_late_orders").desc(),
        F.col("current_eligible_orders").desc(),
        F.col(group).asc(),
    )
    ranked = contributors.withColumn("contributor_rank", F.row_number().over(order))
    return ranked.filter(F.col("contributor_rank") <= settings.top_contributors)


def states_of(measured: DataFrame, settings: Settings) -> DataFrame:
    """Customer states by their excess late orders.

    Orders without a state count in every other result and in no state.
    """
    states = _side_by_side(_of_level(measured, "state"), "delivery", "promise").withColumns(
        {
            "average_delivery_days_change": _change("delivery"),
            "promise_window_days_change": _change("promise"),
        }
    )
    ranked = _contributors(
        states.withColumnRenamed("member", "customer_state"),
        ["customer_state"],
        ["average_delivery_days_change", "promise_window_days_change"],
        settings.min_region_orders,
    )
    return _top(ranked, "customer_state", settings)


def issue_states(orders: DataFrame, settings: Settings) -> DataFrame:
    """Customer states by their excess late orders; ``orders`` carry the state."""
    return states_of(drill_down(orders, ["state"]), settings)


def coverage_of(measured: DataFrame) -> DataFrame:
    """How many eligible orders have a single seller, per issue and period."""
    return _of_level(measured, "all").select(
        *ISSUE_KEYS,
        "period_label",
        F.col("eligible_orders").alias("delivery_eligible_orders"),
        F.col("single_orders").alias("single_seller_eligible_orders"),
        rounded(percent(F.col("single_orders"), F.col("eligible_orders"))).alias(
            "single_seller_coverage_pct"
        ),
        "period_month",
    )


def issue_seller_coverage(orders: DataFrame) -> DataFrame:
    """How many eligible orders have a single seller; ``orders`` carry it."""
    return coverage_of(drill_down(orders, ["all"]))


def sellers_of(measured: DataFrame, sellers: DataFrame, settings: Settings) -> DataFrame:
    """Single sellers by their excess late orders.

    Orders of several sellers are not attributed to anyone.  A seller without a record of
    its own is not ranked, as nothing is known about it.
    """
    changes = {
        "average_handling_days_change": "eligible_handling",
        "average_delivery_days_change": "delivery",
        "average_review_score_change": "eligible_score",
    }
    groups = _side_by_side(_of_level(measured, "seller"), *changes.values())
    groups = groups.withColumns({name: _change(measure) for name, measure in changes.items()})
    seller = F.col("member").cast(sellers.schema["seller_id"].dataType)
    groups = groups.withColumn("seller_id", seller).drop("member")
    ranked = _contributors(groups, ["seller_id"], list(changes), settings.min_seller_orders)
    located = ranked.join(sellers.select("seller_id", "seller_state"), "seller_id")
    columns = [*ISSUE_KEYS, "seller_id", "seller_state"]
    rest = [c for c in ranked.columns if c not in columns]
    return _top(located.select(*columns, *rest), "seller_id", settings)


def issue_sellers(orders: DataFrame, sellers: DataFrame, settings: Settings) -> DataFrame:
    """Single sellers by their excess late orders.

    ``orders`` carry the single seller and the review score.
    """
    eligible = orders.filter("is_delivery_kpi_eligible AND single_seller_id IS NOT NULL")
    return sellers_of(drill_down(eligible, ["seller"]), sellers, settings)


# The leading column of each of the five investigation results.
RESULT_LEADS = {
    "periods": "period_label",
    "impact": "previous_eligible_orders",
    "states": "customer_state",
    "coverage": "period_label",
    "sellers": "seller_id",
}


def check_results(results: dict[str, DataFrame]) -> None:
    """The five results exist, are keyed by issue, lead as agreed, hold rows."""
    if list(results) != list(RESULT_LEADS):
        raise ValueError(f"expected the results {list(RESULT_LEADS)}, got {list(results)}")
    for name, frame in results.items():
        leading = [c for c in frame.columns if c not in ISSUE_KEYS][0]
        if leading != RESULT_LEADS[name]:
            raise ValueError(f"{name} starts with {leading}, not {RESULT_LEADS[name]}")
        if frame.isEmpty():
            raise ValueError(f"{name} holds no rows")
