"""The integrity rules of the cleaned tables, as data.

A rule holds on a row when its condition is true or unknown.  ``audit`` counts the row,
key and reference rules of all tables together.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.operators.audit import Reference, audit, quarantined
from dispatchlens.operators.cleaning import in_window
from dispatchlens.operators.quality import union_all
from dispatchlens.schemas import CLEAN_TABLES, FOREIGN_KEYS, KEYS
from dispatchlens.settings import Settings

# The admissible codes.
ORDER_STATUSES = [
    "created", "approved", "invoiced", "processing", "shipped", "delivered",
    "unavailable", "canceled",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
TRANSLATION_SOURCES = ["official", "manual", "missing"]
ZIP_RANGE = (0, 99_999)
SCORE_RANGE = (1, 5)


@dataclass(frozen=True)
class Lengths:
    """Characters of an identifier and of a state code; None allows any."""

    identifier: int | None = 32
    state: int | None = 2


def _has_length(column: str, length: int | None, trimmed: bool = False) -> Column:
    if length is None:
        return F.lit(True)
    text = F.col(column).cast("string")
    return F.length(F.trim(text) if trimmed else text) == length


def _both_or_neither(flag: Column, columns: list[str]) -> Column:
    """All columns filled where the flag is set, none where it is not."""
    filled = [F.col(c).isNotNull() for c in columns]
    every, nothing = filled[0], ~filled[0]
    for f in filled[1:]:
        every, nothing = every & f, nothing & ~f
    return (flag & every) | (~flag & nothing)


def _place_rules(prefix: str, ids: list[str], lengths: Lengths) -> dict[str, Column]:
    rules = {f"{c} length": _has_length(c, lengths.identifier) for c in ids}
    rules["zip code range"] = F.col(f"{prefix}_zip_code_prefix").between(*ZIP_RANGE)
    rules["state length"] = _has_length(f"{prefix}_state", lengths.state, trimmed=True)
    return rules


def _product_rules(lengths: Lengths) -> dict[str, Column]:
    source = F.col("category_translation_source")
    names = [F.col("product_category_name"), F.col("product_category_name_english")]
    missing = (source == "missing") & names[0].isNull() & names[1].isNull()
    translated = source.isin("official", "manual") & names[0].isNotNull() & names[1].isNotNull()
    rules = {"product_id length": _has_length("product_id", lengths.identifier)}
    for c in ("product_name_length", "product_description_length", "product_photos_qty"):
        rules[f"{c} not negative"] = F.col(c) >= 0
    for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"):
        rules[f"{c} positive"] = F.col(c) > 0
    rules["translation source code"] = source.isin(TRANSLATION_SOURCES)
    rules["translation source fits category"] = missing | translated
    return rules


def _order_rules(lengths: Lengths, settings: Settings) -> dict[str, Column]:
    status = F.col("order_status")
    delivered = status == "delivered"
    purchase = F.col("order_purchase_timestamp")
    approved = F.col("order_approved_at")
    carrier = F.col("order_delivered_carrier_date")
    customer = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    eligible = F.col("is_delivery_kpi_eligible")
    handled = F.col("is_handling_time_eligible")
    on_time = F.col("is_on_time_delivery")
    incomplete = approved.isNull() | carrier.isNull() | customer.isNull()
    deliverable = (
        delivered
        & customer.isNotNull()
        & promised.isNotNull()
        & (customer >= purchase)
        & (promised >= purchase)
    )
    handling = F.col("approval_to_carrier_days")
    return {
        "order_id length": _has_length("order_id", lengths.identifier),
        "customer_id length": _has_length("customer_id", lengths.identifier),
        "status code": status.isin(ORDER_STATUSES),
        "window flag": F.col("is_primary_analysis_window") == in_window(purchase, settings),
        "missing timestamp flag": (
            F.col("has_missing_operational_timestamp") == (delivered & incomplete)
        ),
        "chronology flag only if delivered": (
            ~F.col("has_operational_chronology_issue") | delivered
        ),
        "eligibility is justified": ~eligible | deliverable,
        "delivery measures fit eligibility": _both_or_neither(
            eligible,
            ["is_on_time_delivery", "delivery_days", "delivery_delay_days", "late_delivery_days"],
        ),
        "on-time flag": on_time == (customer <= promised),
        "delivery days not negative": F.col("delivery_days") >= 0,
        "late days not negative": F.col("late_delivery_days") >= 0,
        "handling time fits eligibility": (
            (handled & handling.isNotNull() & (handling >= 0)) | (~handled & handling.isNull())
        ),
    }


def _item_rules(lengths: Lengths) -> dict[str, Column]:
    price, freight = F.col("price"), F.col("freight_value")
    return {
        **{
            f"{c} length": _has_length(c, lengths.identifier)
            for c in ("order_id", "product_id", "seller_id")
        },
        "item number from one": F.col("order_item_id") >= 1,
        "price positive": price > 0,
        "freight not negative": freight >= 0,
        "total adds up": F.col("item_total") == price + freight,
    }


def _payment_rules(lengths: Lengths) -> dict[str, Column]:
    installments, value = F.col("payment_installments"), F.col("payment_value")
    return {
        "order_id length": _has_length("order_id", lengths.identifier),
        "sequence from one": F.col("payment_sequential") >= 1,
        "payment type code": F.col("payment_type").isin(PAYMENT_TYPES),
        "installments not negative": installments >= 0,
        "value not negative": value >= 0,
        "installment flag": F.col("is_invalid_installment") == (installments <= 0),
        "zero value flag": F.col("is_zero_value_payment") == (value == 0),
    }


def _review_rules(lengths: Lengths) -> dict[str, Column]:
    return {
        "review_id length": _has_length("review_id", lengths.identifier),
        "order_id length": _has_length("order_id", lengths.identifier),
        "score range": F.col("review_score").between(*SCORE_RANGE),
    }


def row_rules(settings: Settings, lengths: Lengths = Lengths()) -> dict[str, dict[str, Column]]:
    """Per table, the condition of every row rule (columns required first)."""
    checks = {
        "customers": _place_rules("customer", ["customer_id", "customer_unique_id"], lengths),
        "products": _product_rules(lengths),
        "sellers": _place_rules("seller", ["seller_id"], lengths),
        "orders": _order_rules(lengths, settings),
        "order_items": _item_rules(lengths),
        "payments": _payment_rules(lengths),
        "reviews": _review_rules(lengths),
    }
    return {
        table: {
            f"{f.name} required": F.col(f.name).isNotNull()
            for f in CLEAN_TABLES[table].fields
            if not f.nullable
        }
        | rules
        for table, rules in checks.items()
    }


def broken_rules(settings: Settings, lengths: Lengths = Lengths()) -> dict[str, dict[str, Column]]:
    """Per table, the condition under which a row breaks each rule."""
    return {
        table: {name: ~kept(rule) for name, rule in rules.items()}
        for table, rules in row_rules(settings, lengths).items()
    }


REFERENCES = [Reference(*relation) for relation in FOREIGN_KEYS]


def constraint_report(
    tables: Mapping[str, DataFrame], settings: Settings, lengths: Lengths = Lengths()
) -> DataFrame:
    """Failures of every rule: rows for row and key rules, keys for references.

    Each table is read once.
    """
    keys = {table: KEYS[table] for table in CLEAN_TABLES}
    found = audit(tables, broken_rules(settings, lengths), keys, REFERENCES)
    rule = F.when(F.col("kind") == "key", F.concat(F.lit("unique key "), "rule")).otherwise(F.col("rule"))
    return found.filter(F.col("kind") != "missing").select("table_name", rule.alias("rule"), "failing", "kind")


def quarantined_rows(
    tables: Mapping[str, DataFrame], settings: Settings, lengths: Lengths = Lengths()
) -> DataFrame:
    """All rows that break a row rule, with their key and the names of the rules."""
    return union_all(
        quarantined(tables[table], table, failing, KEYS[table])
        for table, failing in broken_rules(settings, lengths).items()
    )


def kept(condition: Column) -> Column:
    """A rule that cannot be decided counts as kept."""
    return F.coalesce(condition, F.lit(True))
