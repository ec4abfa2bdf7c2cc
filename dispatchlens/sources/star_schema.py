"""The eight commerce tables derived from a TPC-H-like star schema.

The star schema has no approval, delivery or promise dates and no payments or
reviews.  They follow from keys and dates by integer arithmetic, row by row: no
table needs a shuffle, no row is left out, and the purchase timestamp stays the
plain stored column, so that window filters reach the Parquet scan.

Keys keep their stored integer type, which makes cheaper join keys than text;
:func:`as_text` gives the same tables as the all-text raw files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.schemas import MONEY, RAW_COLUMNS

_DAY = 86_400

# Category without an official translation that the manual map supplies, and
# one that stays untranslated.
MANUAL_CATEGORY = "PROMO"
UNTRANSLATED_CATEGORY = "SMALL"
MANUAL_TRANSLATIONS = {MANUAL_CATEGORY: "promo"}


class Tables(Mapping[str, DataFrame]):
    """Tables by name, each opened when first asked for."""

    def __init__(self, opening: dict[str, Callable[[], DataFrame]]) -> None:
        self._opening = opening
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._opening[name]()
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._opening)

    def __len__(self) -> int:
        return len(self._opening)


def load(spark: SparkSession, folder: str) -> Tables:
    """All eight typed tables."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return Tables(
        {
            "customers": lambda: _customers(table("customer"), table("nation")),
            "orders": lambda: _orders(table("orders")),
            "order_items": lambda: _order_items(table("lineitem")),
            "products": lambda: _products(table("part")),
            "sellers": lambda: _sellers(table("supplier"), table("nation")),
            "payments": lambda: _payments(table("lineitem")),
            "reviews": lambda: _reviews(table("lineitem")),
            "category_translation": lambda: _category_translation(table("part"), table("region")),
        }
    )


def _after(start: Column, days: Column | int, seconds: Column | int = 0) -> Column:
    """``start`` moved by whole days and seconds."""
    shift = F.lit(days) * _DAY + F.lit(seconds)
    return F.timestamp_add("SECOND", shift.cast("long"), start)


def _orders(orders: DataFrame) -> DataFrame:
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    purchase = F.col("o_orderdate")

    delivered = F.col("o_orderstatus").isin("F", "O")
    status = (
        F.when(delivered, "delivered").when(k % 2 == 0, "shipped").otherwise("canceled")
    )
    approval = k % 3
    handling = 1 + (7 * k + u) % 5
    transport = 3 + (13 * k + 5 * u) % 12
    congestion = F.when(F.month(purchase).isin(2, 8, 11), (k + u) % 14).otherwise(0)

    approved_at = F.when(k % 97 != 0, _after(purchase, approval, (31 * k) % _DAY))
    carrier_at = (
        F.when(k % 53 == 0, _after(purchase, -1))
        .when(k % 127 != 0, _after(purchase, approval + handling, (97 * k + u) % _DAY))
    )
    transit = approval + handling + transport + congestion
    delivered_at = (
        F.when(~delivered | (k % 211 == 0), None)
        .when(k % 71 == 0, _after(purchase, -2))
        .otherwise(_after(purchase, transit, (89 * k + 13 * u) % _DAY))
    )
    promised_at = F.when(k % 307 == 0, _after(purchase, -1)).otherwise(
        _after(purchase, 16 + u % 5)
    )
    return orders.select(
        k.alias("order_id"),
        u.alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        approved_at.alias("order_approved_at"),
        carrier_at.alias("order_delivered_carrier_date"),
        delivered_at.alias("order_delivered_customer_date"),
        promised_at.alias("order_estimated_delivery_date"),
    )


def _order_items(lines: DataFrame) -> DataFrame:
    """One item per line.  (order, line number) repeats in this data."""
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        # Tax free lines travel free of charge.
        F.when(F.col("l_tax") == 0, F.lit(0))
        .otherwise(F.col("l_quantity"))
        .cast(MONEY)
        .alias("freight_value"),
    )


def _payments(lines: DataFrame) -> DataFrame:
    """One payment record per line, numbered like the line."""
    kind = F.col("l_linenumber") % 5
    voucher = (kind == 2) & (F.col("l_discount") == 0)
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(kind == 0, "credit_card")
        .when(kind == 1, "boleto")
        .when(kind == 2, "voucher")
        .when(kind == 3, "debit_card")
        .otherwise("not_defined")
        .alias("payment_type"),
        (F.col("l_quantity").cast("int") % 4).alias("payment_installments"),
        F.when(voucher, F.lit(0))
        .otherwise(F.col("l_extendedprice"))
        .cast(MONEY)
        .alias("payment_value"),
    )


def _reviews(lines: DataFrame) -> DataFrame:
    """One review per line; the part reviewed numbers the review."""
    flag = F.col("l_returnflag")
    return lines.select(
        F.col("l_partkey").alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (1 + F.col("l_partkey") % 5).cast("int").alias("review_score"),
        F.when(flag == "R", "Returned").alias("review_comment_title"),
        F.when(flag != "N", F.concat(F.lit("line status "), F.col("l_linestatus"))).alias(
            "review_comment_message"
        ),
        F.col("l_shipdate").alias("review_creation_date"),
        _after(F.col("l_shipdate"), F.col("l_linenumber")).alias("review_answer_timestamp"),
    )


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    u = F.col("c_custkey")
    # Every tenth account belongs to the person of the account before it.
    identity = F.when(u % 10 == 1, u - 1).otherwise(u)
    state = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customer.join(state, "c_nationkey", "left").select(
        u.alias("customer_id"),
        identity.alias("customer_unique_id"),
        ((37 * u) % 100_000).cast("int").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    state = nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return supplier.join(state, "s_nationkey", "left").select(
        s.alias("seller_id"),
        ((131 * s) % 100_000).cast("int").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _products(part: DataFrame) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    name_length = F.length("p_name")
    return part.select(
        k.alias("product_id"),
        F.when(size != 50, F.col("p_type")).alias("product_category_name"),
        name_length.alias("product_name_lenght"),
        (10 * name_length).alias("product_description_lenght"),
        (k % 6).cast("int").alias("product_photos_qty"),
        (100 * (size - 1)).cast(MONEY).alias("product_weight_g"),
        size.cast(MONEY).alias("product_length_cm"),
        F.col("p_retailprice").cast(MONEY).alias("product_height_cm"),
        (size % 7 - 1).cast(MONEY).alias("product_width_cm"),
    )


def _category_translation(part: DataFrame, region: DataFrame) -> DataFrame:
    """Part types but two, and the regions, which no product uses."""
    sold = part.filter(~F.col("p_type").isin(MANUAL_CATEGORY, UNTRANSLATED_CATEGORY))
    names = sold.select(F.col("p_type").alias("product_category_name")).distinct()
    unused = region.select(F.col("r_name").alias("product_category_name"))
    return names.unionByName(unused).select(
        "product_category_name",
        F.lower("product_category_name").alias("product_category_name_english"),
    )


def as_text(tables: Mapping[str, DataFrame]) -> Tables:
    """The tables as raw files hold them: every column text.

    Customer cities get the usual defects of typed-in text: padding, blank
    values and a written-out "no value".
    """

    def text(name: str) -> DataFrame:
        frame = tables[name].select(*[F.col(c).cast("string") for c in RAW_COLUMNS[name]])
        return _with_typing_defects(frame) if name == "customers" else frame

    return Tables({name: partial(text, name) for name in tables})


def _with_typing_defects(customers: DataFrame) -> DataFrame:
    city, state = F.col("customer_city"), F.col("customer_state")
    entered = (
        F.when(state.isin("NATION_0", "NATION_7"), F.lit("  \t "))
        .when(state == "NATION_5", F.lit("N/A"))
        .otherwise(F.concat(F.lit("  "), city, F.lit(" \t")))
    )
    return customers.withColumn("customer_city", entered)


def with_entry_errors(text: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Text tables in which some numbers and dates cannot be parsed.

    Carrier dates are written with ``T``, which can be read, and those of the first of a
    month with a zone, too, which cannot.
    """
    items, payments = text["order_items"], text["payments"]
    carrier = F.replace(F.col("order_delivered_carrier_date"), F.lit(" "), F.lit("T"))
    zoned = F.when(carrier.contains("-01T"), F.concat(carrier, F.lit("Z"))).otherwise(carrier)
    return {
        **text,
        "order_items": items.withColumn(
            "freight_value",
            F.when(F.col("freight_value") == "0.00", "free").otherwise(F.col("freight_value")),
        ),
        "payments": payments.withColumn(
            "payment_installments",
            F.when(F.col("payment_type") == "not_defined", "n/k").otherwise(
                F.col("payment_installments")
            ),
        ),
        "orders": text["orders"].withColumns(
            {
                "order_approved_at": F.when(F.col("order_status") == "canceled", "never").otherwise(
                    F.col("order_approved_at")
                ),
                "order_delivered_carrier_date": zoned,
            }
        ),
    }
