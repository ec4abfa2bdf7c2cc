"""One row per order, and one row per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.functions.measures import (
    count_where,
    mean,
    never_null,
    per_count,
    percent,
    rounded,
)
from dispatchlens.operators.cleaning import by_number_word, distinct_numbers, in_window
from dispatchlens.schemas import ORDER_TIMESTAMPS, SCORE
from dispatchlens.settings import Settings


def item_summary(items: DataFrame) -> DataFrame:
    """Items per order.

    Products and sellers are counted from the items grouped by order and product and by
    order and seller, each combined before it moves, instead of copying every item once
    per distinct count; the amounts travel with the products.
    """
    amounts = {"merchandise_value": "price", "freight_value": "freight_value", "item_total_value": "item_total"}
    totals = [F.sum(column).alias(name) for name, column in amounts.items()]
    wanted = items.groupBy().agg(*totals).schema
    products = items.groupBy("order_id", "product_id").agg(F.count("*").alias("item_count"), *totals)
    sellers = items.select("order_id", "seller_id").distinct()
    zero, none = F.lit(0).cast("long"), F.lit(None)
    both = products.select(
        "order_id", "item_count", F.col("product_id").isNotNull().cast("long").alias("product_count"),
        zero.alias("seller_count"), *amounts,
    ).unionByName(
        sellers.select(
            "order_id", zero.alias("item_count"), zero.alias("product_count"),
            F.col("seller_id").isNotNull().cast("long").alias("seller_count"),
            *[none.cast(wanted[name].dataType).alias(name) for name in amounts],
        )
    )
    return both.groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in ("item_count", "product_count", "seller_count")],
        *[F.sum(name).cast(wanted[name].dataType).alias(name) for name in amounts],
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    """Payments per order without the flags, in one aggregation."""
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_record_count"), F.sum("payment_value").alias("recorded_payment_value")
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Payments per order.

    The sequence flags are properties of the whole order, so they come from the
    same aggregation; the records need no flags of their own first.
    """
    words = by_number_word(
        payments,
        F.sum("payment_value").alias("_value"),
        F.bool_or("is_invalid_installment").alias("_invalid"),
        F.bool_or("is_zero_value_payment").alias("_zero"),
    )
    value = words.schema["_value"].dataType
    summary = words.groupBy("order_id").agg(
        F.sum("_rows").alias("payment_record_count"),
        F.sum("_value").cast(value).alias("recorded_payment_value"),
        F.bool_or("_invalid").alias("has_invalid_installment"),
        F.bool_or("_zero").alias("has_zero_value_payment"),
        (F.min("_least") > 1).alias("has_payment_sequence_start_missing"),
        (distinct_numbers() != F.max("_most") - F.min("_least") + 1).alias(
            "has_payment_sequence_internal_gap"
        ),
    )
    flags = [c for c in summary.columns if c.startswith("has_")]
    return summary.withColumns({c: never_null(F.col(c)) for c in flags})


def review_summary(reviews: DataFrame) -> DataFrame:
    """Reviews per order; the order's mean score is kept to four digits."""
    return (
        reviews.groupBy("order_id")
        .agg(
            F.count("*").alias("review_record_count"),
            F.sum("review_score").alias("_total"),
            F.count("review_score").alias("_scores"),
        )
        .select(
            "order_id",
            "review_record_count",
            per_count(F.col("_total").cast("decimal(18,0)"), F.col("_scores"))
            .cast(SCORE)
            .alias("average_review_score"),
        )
    )


def with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    return _with_review_summary(orders, review_summary(reviews))


def _with_review_summary(orders: DataFrame, reviewed: DataFrame) -> DataFrame:
    joined = orders.join(reviewed, "order_id", "left")
    return joined.withColumn(
        "review_record_count", F.coalesce("review_record_count", F.lit(0).cast("long"))
    )


def order_measures(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, flags: bool = True
) -> DataFrame:
    """Order timing joined to its three child summaries, all keyed by order.

    Without ``flags`` the payments bring their number and value alone, which takes one
    aggregation less.

    Each child is reduced to one row per order before the join, so nothing fans
    out, and all four inputs share one partitioning.  Consumers that leave the
    columns of a child unused do not pay for it: the optimizer drops an outer
    join to a side that is unique on the key.
    """
    paid = payment_summary(payments) if flags else payment_totals(payments)
    return with_summaries(orders, item_summary(items), paid, review_summary(reviews))


def with_summaries(orders: DataFrame, items: DataFrame, paid: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Orders joined to the summaries of their items, payments and reviews."""
    zero, no = F.lit(0).cast("long"), F.lit(False)
    counts = ["item_count", "product_count", "seller_count", "payment_record_count"]
    flagged = [c for c in paid.columns if c.startswith("has_")]
    joined = (
        orders.join(items, "order_id", "left")
        .join(paid, "order_id", "left")
        .withColumns(
            {
                "has_order_items": F.col("item_count").isNotNull(),
                "has_payment": F.col("payment_record_count").isNotNull(),
            }
        )
        .withColumns({c: F.coalesce(F.col(c), zero) for c in counts})
        .withColumns({c: F.coalesce(F.col(c), no) for c in flagged})
    )
    return _with_review_summary(joined, reviewed)


# The columns of the order facts, in their published order.
FACT_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
    "order_status", "order_purchase_timestamp", "purchase_date", "purchase_month",
    *ORDER_TIMESTAMPS[1:],
    "has_order_items", "has_payment", "is_primary_analysis_window",
    "has_missing_operational_timestamp", "has_operational_chronology_issue",
    "is_delivery_kpi_eligible", "is_on_time_delivery", "delivery_days",
    "delivery_delay_days", "late_delivery_days", "is_handling_time_eligible",
    "approval_to_carrier_days",
    "item_count", "product_count", "seller_count", "merchandise_value", "freight_value",
    "item_total_value", "payment_record_count", "recorded_payment_value",
    "has_invalid_installment", "has_zero_value_payment",
    "has_payment_sequence_start_missing", "has_payment_sequence_internal_gap",
    "review_record_count", "average_review_score",
]


def order_facts(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """Order measures with the customer's identity and place.

    The customer comes first, while the rows are narrow; the result then stays
    partitioned by order.  An order whose customer is unknown keeps its measures, and
    identity and place are null: every path counts the same orders.
    """
    placed = placed_orders(orders, customers)
    return order_measures(placed, items, payments, reviews).select(*FACT_COLUMNS)


def placed_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the identity and place of their customer and the date of purchase."""
    place = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    return orders.join(place, "customer_id", "left").withColumn(
        "purchase_date", F.to_date("order_purchase_timestamp")
    )


def monthly_kpis(orders: DataFrame, settings: Settings) -> DataFrame:
    """Ten measures per purchase month of the analysis window.

    ``orders`` are order facts or order measures: no customer attribute is
    needed, and facts keep orders of unknown customers, so the join to customers
    can be left out.
    """
    eligible = F.col("is_delivery_kpi_eligible")
    paid = F.col("payment_record_count") > 0
    reviewed = F.col("review_record_count") > 0
    eligible_count = count_where(eligible)
    on_time_count = count_where(eligible & F.col("is_on_time_delivery"))
    return (
        orders.filter(in_window(F.col("order_purchase_timestamp"), settings))
        .groupBy("purchase_month")
        .agg(
            F.count("*").alias("order_count"),
            count_where(paid).alias("orders_with_payment_records"),
            rounded(F.sum("recorded_payment_value")).alias("recorded_payment_value"),
            rounded(mean(F.col("recorded_payment_value"), paid)).alias("average_order_value"),
            eligible_count.alias("delivery_kpi_order_count"),
            on_time_count.alias("on_time_delivery_count"),
            rounded(percent(on_time_count, eligible_count)).alias("on_time_delivery_rate_pct"),
            rounded(mean(F.col("delivery_days"), eligible)).alias("average_delivery_days"),
            count_where(reviewed).alias("reviewed_order_count"),
            rounded(mean(F.col("average_review_score"), reviewed)).alias(
                "average_order_review_score"
            ),
        )
    )
