"""Raw tables to typed, flagged tables.

Every function takes the raw table either as text (raw files: all columns are
strings) or already typed (a typed source).  Text is normalised and parsed
strictly; the columns of a typed source are only cast.  Nothing is filtered: bad
rows are flagged, or stop the job when a value cannot be read at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.functions import text as tx
from dispatchlens.functions.measures import days_between, month_of, never_null
from dispatchlens.schemas import DAYS, MONEY, ORDER_TIMESTAMPS, PRODUCT_MEASUREMENTS
from dispatchlens.settings import Settings

# Translations missing from the official table.
MANUAL_TRANSLATIONS = {
    "pc_gamer": "pc_gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": (
        "portable_kitchen_and_food_preparation_appliances"
    ),
}


def normalize_strings(frame: DataFrame) -> DataFrame:
    """Trim every text column and turn missing values into null."""
    return frame.select(
        *[
            tx.normalize(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def _parse(text: Column, target: T.DataType) -> Column:
    if isinstance(target, T.TimestampNTZType):
        return tx.parse_timestamp(text)
    if isinstance(target, T.IntegralType):
        return tx.parse_integer(text).try_cast(target)
    return tx.parse_number(text, target)


def typed(frame: DataFrame, table: str, types: dict[str, T.DataType | None]) -> DataFrame:
    """Select ``types``' columns with their types; ``None`` keeps an id as it is.

    Each column goes its own way: text is normalised and parsed, a typed column is
    cast.  Text is normalised, parsed and checked in three projections, so that each
    value is normalised and parsed once however often it is referred to.
    """
    of_text = {f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)}
    text = normalize_strings(frame.select(*types)).select(
        *[
            F.col(c).cast(target).alias(c) if target is not None and c not in of_text else F.col(c)
            for c, target in types.items()
        ]
    )
    to_parse = {
        c: target
        for c, target in types.items()
        if target is not None and c in of_text and not isinstance(target, T.StringType)
    }
    parsed = text.withColumns({f"_{c}": _parse(F.col(c), t) for c, t in to_parse.items()})
    return parsed.select(
        *[
            tx.strict(F.col(c), F.col(f"_{c}"), f"{table}.{c}").alias(c)
            if c in to_parse
            else F.col(c)
            for c in types
        ]
    )


_TEXT, _INT, _SHORT, _TIME = T.StringType(), T.IntegerType(), T.ShortType(), T.TimestampNTZType()


def clean_customers(raw: DataFrame) -> DataFrame:
    return typed(
        raw,
        "customers",
        {
            "customer_id": None,
            "customer_unique_id": None,
            "customer_zip_code_prefix": _INT,
            "customer_city": _TEXT,
            "customer_state": _TEXT,
        },
    )


def clean_sellers(raw: DataFrame) -> DataFrame:
    return typed(
        raw,
        "sellers",
        {
            "seller_id": None,
            "seller_zip_code_prefix": _INT,
            "seller_city": _TEXT,
            "seller_state": _TEXT,
        },
    )


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Typed items with their total."""
    items = typed(
        raw,
        "order_items",
        {
            "order_id": None,
            "order_item_id": _SHORT,
            "product_id": None,
            "seller_id": None,
            "shipping_limit_date": _TIME,
            "price": MONEY,
            "freight_value": MONEY,
        },
    )
    total = (F.col("price") + F.col("freight_value")).cast(MONEY)
    return items.withColumn("item_total", total)


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews; an order may keep several."""
    return typed(
        raw,
        "reviews",
        {
            "review_id": None,
            "order_id": None,
            "review_score": _SHORT,
            "review_comment_title": _TEXT,
            "review_comment_message": _TEXT,
            "review_creation_date": _TIME,
            "review_answer_timestamp": _TIME,
        },
    )


def category_lookup(raw: DataFrame) -> DataFrame:
    """Official translation per category; a category listed twice fails the job."""
    category = F.col("product_category_name")
    translations = typed(
        raw,
        "category_translation",
        {"product_category_name": _TEXT, "product_category_name_english": _TEXT},
    )
    repeated = F.raise_error(F.concat(F.lit("category_translation repeats "), category))
    return (
        translations.filter(category.isNotNull())
        .groupBy("product_category_name")
        .agg(F.count("*").alias("_n"), F.min("product_category_name_english").alias("_english"))
        .select(
            "product_category_name",
            F.when(F.col("_n") > 1, repeated).otherwise(F.col("_english")).alias("official"),
        )
    )


def clean_products(
    raw: DataFrame,
    translation: DataFrame,
    manual: dict[str, str] | None = None,
) -> DataFrame:
    """Typed products with positive measurements and a translated category.

    ``category_translation_source`` tells where the translation comes from; it
    is null for a category that neither source translates.  How the lookup is joined is
    left to Spark, which knows its size once it is grouped, and splits a category that
    most products share.
    """
    manual = MANUAL_TRANSLATIONS if manual is None else manual
    products = typed(
        raw,
        "products",
        {
            "product_id": None,
            "product_category_name": _TEXT,
            "product_name_lenght": _INT,
            "product_description_lenght": _INT,
            "product_photos_qty": _INT,
            **{c: MONEY for c in PRODUCT_MEASUREMENTS},
        },
    )
    category = F.col("product_category_name")
    by_hand = F.lit(None).cast("string")
    for name, english in manual.items():
        by_hand = F.when(category == name, english).otherwise(by_hand)
    source = (
        F.when(category.isNull(), "missing")
        .when(F.col("official").isNotNull(), "official")
        .when(by_hand.isNotNull(), "manual")
    )
    translated = products.join(category_lookup(translation), "product_category_name", "left")
    return translated.select(
        "product_id",
        "product_category_name",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in PRODUCT_MEASUREMENTS],
        F.coalesce("official", by_hand).alias("product_category_name_english"),
        source.alias("category_translation_source"),
    )


def untranslated_categories(products: DataFrame) -> DataFrame:
    """Categories of cleaned products that no source translates."""
    lacking = F.col("product_category_name_english").isNull()
    return (
        products.filter(F.col("product_category_name").isNotNull() & lacking)
        .select("product_category_name")
        .distinct()
        .orderBy("product_category_name")
    )


def clean_payments(raw: DataFrame) -> DataFrame:
    """Typed payments with the flags a single record decides."""
    payments = typed(
        raw,
        "payments",
        {
            "order_id": None,
            "payment_sequential": _SHORT,
            "payment_type": _TEXT,
            "payment_installments": _SHORT,
            "payment_value": MONEY,
        },
    )
    return payments.withColumns(
        {
            "is_invalid_installment": F.col("payment_installments") <= 0,
            "is_zero_value_payment": F.col("payment_value") == 0,
        }
    )


def by_number_word(payments: DataFrame, *sums: Column) -> DataFrame:
    """Payments per order and word of 64 payment numbers: rows, range and a bit per number.

    Words are combined before they move, so an order with very many payments sends few
    rows, and merge into counts of distinct numbers without a second look at the records.
    """
    number = F.col("payment_sequential").cast("long")
    bit = F.expr("shiftleft(1L, cast(payment_sequential & 63 as int))")
    return payments.groupBy("order_id", F.shiftright(number, 6).alias("_word")).agg(
        F.count("*").alias("_rows"),
        F.min(number).alias("_least"),
        F.max(number).alias("_most"),
        F.bit_or(bit).alias("_bits"),
        *sums,
    )


def distinct_numbers() -> Column:
    return F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0))


def payment_sequences(payments: DataFrame) -> DataFrame:
    """Per order: range of the payment numbers and what is missing in it."""
    per_order = by_number_word(payments).groupBy("order_id").agg(
        F.sum("_rows").alias("payment_rows"),
        F.min("_least").alias("minimum_sequence"),
        F.max("_most").alias("maximum_sequence"),
        distinct_numbers().alias("observed_sequences"),
    )
    span = F.col("maximum_sequence") - F.col("minimum_sequence") + 1
    return per_order.withColumn("expected_sequences", span).withColumns(
        {
            "payment_sequence_start_missing": F.col("minimum_sequence") > 1,
            "payment_sequence_internal_gap": (
                F.col("observed_sequences") != F.col("expected_sequences")
            ),
        }
    )


def payment_flags(payments: DataFrame) -> DataFrame:
    """Cleaned payments, each record carrying its order's sequence flags.

    Only orders with a flag take part in the join; where they are few, Spark broadcasts
    them at run time, and else it splits the records of an order that has very many.
    """
    start, gap = "payment_sequence_start_missing", "payment_sequence_internal_gap"
    flagged = payment_sequences(payments).select("order_id", start, gap)
    flagged = flagged.filter(F.col("order_id").isNotNull() & (F.col(start) | F.col(gap)))
    joined = payments.join(flagged, "order_id", "left").select(*payments.columns, start, gap)
    return joined.withColumns({f: never_null(F.col(f)) for f in (start, gap)})


def in_window(timestamp: Column, settings: Settings) -> Column:
    """Window membership in terms a Parquet scan understands; never null."""
    start = F.lit(settings.window_start).cast("timestamp_ntz")
    end = F.lit(settings.window_end).cast("timestamp_ntz")
    return timestamp.isNotNull() & (timestamp >= start) & (timestamp < end)


def order_timing(raw: DataFrame, settings: Settings) -> DataFrame:
    """Typed orders with all flags and durations an order row alone decides."""
    orders = typed(
        raw,
        "orders",
        {"order_id": None, "customer_id": None, "order_status": _TEXT}
        | {c: _TIME for c in ORDER_TIMESTAMPS},
    )
    purchase, approved, carrier, customer, promised = (F.col(c) for c in ORDER_TIMESTAMPS)
    delivered = never_null(F.col("order_status") == "delivered")

    out_of_order = [
        approved < purchase,
        carrier < purchase,
        carrier < approved,
        customer < purchase,
        customer < carrier,
        promised < purchase,
    ]
    any_out_of_order = never_null(out_of_order[0])
    for rule in out_of_order[1:]:
        any_out_of_order = any_out_of_order | never_null(rule)

    eligible = delivered & never_null((customer >= purchase) & (promised >= purchase))
    handled = never_null((approved >= purchase) & (carrier >= purchase) & (carrier >= approved))
    handled = handled & never_null(customer.isNull() | (customer >= carrier))

    flagged = orders.withColumns(
        {
            "is_primary_analysis_window": in_window(purchase, settings),
            "has_missing_operational_timestamp": (
                delivered & (approved.isNull() | carrier.isNull() | customer.isNull())
            ),
            "has_operational_chronology_issue": delivered & any_out_of_order,
            "is_delivery_kpi_eligible": eligible,
            "is_handling_time_eligible": handled,
        }
    )
    on_record = F.col("is_delivery_kpi_eligible")
    delay = days_between(customer, promised)
    return flagged.select(
        *orders.columns,
        "is_primary_analysis_window",
        "has_missing_operational_timestamp",
        "has_operational_chronology_issue",
        "is_delivery_kpi_eligible",
        F.when(on_record, customer <= promised).alias("is_on_time_delivery"),
        F.when(on_record, days_between(customer, purchase)).alias("delivery_days"),
        F.when(on_record, delay).alias("delivery_delay_days"),
        F.when(on_record, F.greatest(delay, F.lit(0).cast(DAYS))).alias("late_delivery_days"),
        "is_handling_time_eligible",
        F.when(F.col("is_handling_time_eligible"), days_between(carrier, approved)).alias(
            "approval_to_carrier_days"
        ),
        month_of(purchase).alias("purchase_month"),
    )


# The columns of the cleaned orders, in their published order.
ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", *ORDER_TIMESTAMPS,
    "has_order_items", "has_payment", "is_primary_analysis_window",
    "has_missing_operational_timestamp", "has_operational_chronology_issue",
    "is_delivery_kpi_eligible", "is_on_time_delivery", "delivery_days",
    "delivery_delay_days", "late_delivery_days", "is_handling_time_eligible",
    "approval_to_carrier_days",
]


def order_keys(child: DataFrame) -> DataFrame:
    """Orders that occur in a child table, once each."""
    return child.select("order_id").filter(F.col("order_id").isNotNull()).distinct()


def clean_orders(
    raw: DataFrame, items: DataFrame, payments: DataFrame, settings: Settings
) -> DataFrame:
    """Order timing plus whether the order has items and payments."""
    with_items = order_keys(items).withColumn("has_order_items", F.lit(True))
    with_payment = order_keys(payments).withColumn("has_payment", F.lit(True))
    return (
        order_timing(raw, settings)
        .join(with_items, "order_id", "left")
        .join(with_payment, "order_id", "left")
        .withColumns(
            {
                "has_order_items": never_null(F.col("has_order_items")),
                "has_payment": never_null(F.col("has_payment")),
            }
        )
        .select(*ORDER_COLUMNS)
    )
