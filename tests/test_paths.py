"""Every path counts the same orders, and every form of a table cleans alike."""

from __future__ import annotations

from pyspark.sql import functions as F

from dispatchlens.functions import text as tx
from dispatchlens.operators import cleaning
from dispatchlens.plans import shared, store
from dispatchlens.plans.analysis import Analysis
from dispatchlens.sources import star_schema

from __spark_entry__ import SETTINGS

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_orders_without_customer_count_alike_on_every_path(spark):
    raw = dict(star_schema.load(spark, SF))
    raw["customers"] = raw["customers"].filter(F.crc32(F.col("customer_id").cast("string")) % 10 > 0)
    a = Analysis(raw, SETTINGS, star_schema.MANUAL_TRANSLATIONS)
    assert a.order_facts.count() == a.orders.count()
    assert a.order_facts.filter("customer_state is null").count() > 0
    path = shared.fresh_path(spark, "facts_without_customers")
    store.write_fact_store(a, path)
    stored = store.read_fact_store(spark, path, raw["sellers"], SETTINGS)
    paths = [a.investigate(), a.investigate_shared(), stored.investigate()]
    for name in paths[0].results():
        lazy, *others = [rows_of(p.results()[name]) for p in paths]
        assert lazy and all(other == lazy for other in others), name


def test_a_typed_column_does_not_switch_off_the_others(spark):
    raw = star_schema.load(spark, SF)["orders"]
    dirty = raw.withColumn("order_status", F.concat(F.lit("  "), "order_status", F.lit("\t")))
    text = star_schema.as_text({"orders": dirty})["orders"]
    typed = cleaning.typed(dirty, "orders", {"order_status": None, "order_purchase_timestamp": cleaning._TIME})
    parsed = cleaning.typed(text, "orders", {"order_status": None, "order_purchase_timestamp": cleaning._TIME})
    assert rows_of(typed) == rows_of(parsed)
    assert typed.filter(F.col("order_status").rlike("^\\s")).isEmpty()


def test_a_zone_after_the_time_is_no_timestamp_without_zone(spark):
    texts = [
        "2017-01-02 10:00:00+05:00", "2017-01-02T10:00:00Z", "2017-01-02 10:00:00 UTC",
        "2017-01-02 10:00:00.5-08", "2017-01-02 10:00:00", "2017-01-02T10:00:00.25", "2017-01-02",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.p is not None for r in frame.select(tx.parse_timestamp(F.col("t")).alias("p")).collect()]
    assert got == [False] * 4 + [True] * 3
