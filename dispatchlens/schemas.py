"""Column contracts of the raw files and types of the cleaned tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Header and key of every raw file.  Two product columns are
# misspelt in the source and are renamed by cleaning.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": [
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    ],
    "payments": [
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ],
    "reviews": [
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date",
        "review_answer_timestamp",
    ],
    "category_translation": [
        "product_category_name", "product_category_name_english",
    ],
}

# Keys, references and types of the tables.
KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
    "category_translation": ["product_category_name"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
]

# Only the review file carries free text, which may hold line breaks; the
# other files can be split and read in parallel.
MULTILINE_TABLES = frozenset({"reviews"})

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

PRODUCT_MEASUREMENTS = [
    "product_weight_g", "product_length_cm", "product_height_cm",
    "product_width_cm",
]

MONEY = T.DecimalType(12, 2)
DAYS = T.DecimalType(14, 6)
SCORE = T.DecimalType(10, 4)
# Rounded measures of the report tables.
MEASURE = T.DecimalType(20, 2)


def _struct(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


_TEXT, _INT, _SHORT = T.StringType(), T.IntegerType(), T.ShortType()
_BOOL, _TIME = T.BooleanType(), T.TimestampNTZType()

CLEAN_TABLES: dict[str, T.StructType] = {
    "customers": _struct(
        ("customer_id", _TEXT, False),
        ("customer_unique_id", _TEXT, False),
        ("customer_zip_code_prefix", _INT, False),
        ("customer_city", _TEXT, False),
        ("customer_state", _TEXT, False),
    ),
    "products": _struct(
        ("product_id", _TEXT, False),
        ("product_category_name", _TEXT, True),
        ("product_name_length", _INT, True),
        ("product_description_length", _INT, True),
        ("product_photos_qty", _INT, True),
        ("product_weight_g", MONEY, True),
        ("product_length_cm", MONEY, True),
        ("product_height_cm", MONEY, True),
        ("product_width_cm", MONEY, True),
        ("product_category_name_english", _TEXT, True),
        ("category_translation_source", _TEXT, False),
    ),
    "sellers": _struct(
        ("seller_id", _TEXT, False),
        ("seller_zip_code_prefix", _INT, False),
        ("seller_city", _TEXT, False),
        ("seller_state", _TEXT, False),
    ),
    "orders": _struct(
        ("order_id", _TEXT, False),
        ("customer_id", _TEXT, False),
        ("order_status", _TEXT, False),
        ("order_purchase_timestamp", _TIME, False),
        ("order_approved_at", _TIME, True),
        ("order_delivered_carrier_date", _TIME, True),
        ("order_delivered_customer_date", _TIME, True),
        ("order_estimated_delivery_date", _TIME, False),
        ("has_order_items", _BOOL, False),
        ("has_payment", _BOOL, False),
        ("is_primary_analysis_window", _BOOL, False),
        ("has_missing_operational_timestamp", _BOOL, False),
        ("has_operational_chronology_issue", _BOOL, False),
        ("is_delivery_kpi_eligible", _BOOL, False),
        ("is_on_time_delivery", _BOOL, True),
        ("delivery_days", DAYS, True),
        ("delivery_delay_days", DAYS, True),
        ("late_delivery_days", DAYS, True),
        ("is_handling_time_eligible", _BOOL, False),
        ("approval_to_carrier_days", DAYS, True),
    ),
    "order_items": _struct(
        ("order_id", _TEXT, False),
        ("order_item_id", _SHORT, False),
        ("product_id", _TEXT, False),
        ("seller_id", _TEXT, False),
        ("shipping_limit_date", _TIME, False),
        ("price", MONEY, False),
        ("freight_value", MONEY, False),
        ("item_total", MONEY, False),
    ),
    "payments": _struct(
        ("order_id", _TEXT, False),
        ("payment_sequential", _SHORT, False),
        ("payment_type", _TEXT, False),
        ("payment_installments", _SHORT, False),
        ("payment_value", MONEY, False),
        ("is_invalid_installment", _BOOL, False),
        ("is_zero_value_payment", _BOOL, False),
        ("payment_sequence_start_missing", _BOOL, False),
        ("payment_sequence_internal_gap", _BOOL, False),
    ),
    "reviews": _struct(
        ("review_id", _TEXT, False),
        ("order_id", _TEXT, False),
        ("review_score", _SHORT, False),
        ("review_comment_title", _TEXT, True),
        ("review_comment_message", _TEXT, True),
        ("review_creation_date", _TIME, False),
        ("review_answer_timestamp", _TIME, False),
    ),
}
