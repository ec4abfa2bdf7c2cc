"""Stored results: the loaded database and the fact store.

The fact store holds one row per order, partitioned by purchase month.  Detection
over a window then reads only the window's partitions, and a drill-down, which
learns its months at run time, only those months' partitions; neither shuffles
orders again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.functions.measures import month_of
from dispatchlens.operators import facts, investigation, quality
from dispatchlens.operators.constraints import Lengths
from dispatchlens.plans import gate, reports
from dispatchlens.plans.analysis import Analysis
from dispatchlens.plans.shared import Steps
from dispatchlens.schemas import CLEAN_TABLES
from dispatchlens.settings import Settings
from dispatchlens.sources import sinks


def fact_rows(analysis: Analysis) -> DataFrame:
    """Order facts and the single seller of the order, if it has one."""
    return investigation.with_single_seller(analysis.order_facts, analysis.order_items)


@contextmanager
def staged_fact_rows(analysis: Analysis) -> Iterator[DataFrame]:
    """``fact_rows`` as a table that lasts as long as the context.

    Its parts are written one after the other, so that the disk holds the shuffle files of
    one of them at a time and the rows can be read again without their shuffles.
    """
    spark = analysis.order_items.sparkSession
    parts, whole = Steps(spark), Steps(spark)
    try:
        items = parts.keep(facts.item_summary(analysis.order_items), "item_summary")
        single = parts.keep(investigation.single_seller_orders(analysis.order_items), "single_seller")
        paid = parts.keep(facts.payment_summary(analysis.payment_records), "payment_summary")
        reviewed = parts.keep(facts.review_summary(analysis.reviews), "review_summary")
        placed = parts.keep(facts.placed_orders(analysis.timed_orders, analysis.customers), "placed_orders")
        rows = facts.with_summaries(placed, items, paid, reviewed).select(*facts.FACT_COLUMNS)
        rows = whole.keep(investigation.with_seller(rows, single), "fact_rows")
        parts.drop()
        yield rows
    finally:
        parts.drop()
        whole.drop()


def write_fact_store(analysis: Analysis, path: str) -> None:
    """Write the fact store under a new path.

    The rebalance brings a month's rows together and splits months that hold
    much more than others, so files are neither tiny nor huge.
    """
    rows = fact_rows(analysis).hint("rebalance", "purchase_month")
    rows.write.mode("errorifexists").partitionBy("purchase_month").parquet(path)


def read_fact_store(
    spark: SparkSession, path: str, sellers: DataFrame, settings: Settings = Settings()
) -> Analysis:
    """An analysis whose orders come from the store, enriched as they are."""
    return analysis_of_facts(spark.read.parquet(path), sellers, settings)


def analysis_of_facts(stored: DataFrame, sellers: DataFrame, settings: Settings = Settings()) -> Analysis:
    """An analysis over rows as ``fact_rows`` gives them."""
    month = F.col("purchase_month")
    # Whole months that the window touches: the partitions any result may need.
    touched = stored.filter(
        (month >= F.lit(settings.window_start.replace(day=1)))
        & (month <= F.lit(settings.window_end))
    )
    analysis = Analysis({"sellers": sellers}, settings)
    analysis.order_facts = stored
    analysis.order_measures = analysis.timed_orders = touched
    return analysis


def existing_tables(spark: SparkSession, database: str) -> set[str]:
    names = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    return names & set(CLEAN_TABLES)


def bootstrap(
    spark: SparkSession,
    analysis: Analysis,
    database: str,
    resume: bool = False,
    lengths: Lengths = Lengths(),
) -> DataFrame:
    """Create, load and check the cleaned tables; returns the row-count report.

    No table is created before the gate has passed the raw tables.  Running it again on a
    loaded database changes nothing.  Tables are filled one after the other; ``versions``
    shows them all at once.  A database with some of its tables missing is an
    error, and so is one loaded in part, unless ``resume``: then the tables that are still
    empty are loaded, and a table with too few or too many rows remains an error.  At the
    end the views are created over the loaded tables and their rows compared, too.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    judged = not existing_tables(spark, database)
    if judged:
        gate.require_clean(analysis, lengths)
        for name, schema in CLEAN_TABLES.items():
            sinks.create_table(spark, f"{database}.{name}", schema)
    missing = set(CLEAN_TABLES) - existing_tables(spark, database)
    if missing:
        raise sinks.LoadError(f"{database} lacks the tables {sorted(missing)}")

    sources = {name: analysis.raw[name] for name in CLEAN_TABLES}

    def counts() -> DataFrame:
        loaded = {name: spark.table(f"{database}.{name}") for name in CLEAN_TABLES}
        return quality.counts_against(loaded, sources)

    state = quality.load_state(counts()).first()["state"]
    if state == "empty" or (state == "partial" and resume):
        if not judged:
            gate.require_clean(analysis, lengths)
        for name, frame in analysis.clean_tables().items():
            schema = CLEAN_TABLES[name]
            if spark.table(f"{database}.{name}").isEmpty():
                sinks.load_table(frame.select(*schema.fieldNames()), f"{database}.{name}", schema)
        state = quality.load_state(counts()).first()["state"]
    if state != "loaded":
        raise sinks.LoadError(f"{database} is loaded in part")
    loaded = loaded_analysis(spark, database, analysis.settings)
    create_views(loaded)
    views = quality.counts_against(loaded.views(), loaded.view_sources())
    return quality.row_count_contract(counts().union(views.select(*counts().columns)))


def loaded_analysis(spark: SparkSession, database: str, settings: Settings = Settings()) -> Analysis:
    """The analysis over the loaded tables."""
    return with_clean_tables({name: spark.table(f"{database}.{name}") for name in CLEAN_TABLES}, settings)


def with_clean_tables(tables: Mapping[str, DataFrame], settings: Settings) -> Analysis:
    """An analysis over tables that are clean already."""
    analysis = Analysis({}, settings)
    for name in CLEAN_TABLES:
        setattr(analysis, name, tables[name])
    analysis.payment_records = analysis.payments
    month = month_of(F.col("order_purchase_timestamp"))
    analysis.timed_orders = analysis.orders.withColumn("purchase_month", month)
    return analysis


def create_views(analysis: Analysis) -> None:
    """Register the analytical views of this session."""
    for name, frame in analysis.views().items():
        frame.createOrReplaceTempView(name)


def export(analysis: Analysis, folder: str) -> dict[str, int]:
    """Write the four BI data sets under a new folder; returns their rows."""
    return {
        name: sinks.write_report(frame, f"{folder}/{name}", reports.export_order(name))
        for name, frame in reports.exports(analysis).items()
    }
