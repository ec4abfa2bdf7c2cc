"""Small hand-made tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from dispatchlens.schemas import RAW_COLUMNS


def text_table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """A raw table; columns that a row leaves out are null."""
    columns = RAW_COLUMNS[name]
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def stamp(text: str) -> datetime:
    return datetime.fromisoformat(text)


def order(order_id: str, purchase: str = "2018-01-10 00:00:00", **fields) -> dict:
    """A delivered order that is on time."""
    return {
        "order_id": order_id,
        "customer_id": f"c{order_id}",
        "order_status": "delivered",
        "order_purchase_timestamp": purchase,
        "order_approved_at": "2018-01-10 06:00:00",
        "order_delivered_carrier_date": "2018-01-11 06:00:00",
        "order_delivered_customer_date": "2018-01-15 12:00:00",
        "order_estimated_delivery_date": "2018-01-20 00:00:00",
    } | fields


def by(frame: DataFrame, key: str) -> dict:
    return {row[key]: row for row in frame.collect()}
