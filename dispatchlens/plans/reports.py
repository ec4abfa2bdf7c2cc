"""Results that combine several parts of the analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.functions.measures import count_where
from dispatchlens.operators import decision, documents
from dispatchlens.operators.quality import FAILED, PASSED
from dispatchlens.plans.analysis import Analysis, Investigation


def diagnosis(inv: Investigation) -> DataFrame:
    return decision.issue_diagnosis(inv.periods, inv.impact, inv.states, inv.analysis.settings)


def top_rows(inv: Investigation) -> DataFrame:
    return decision.issue_top_rows(inv.states, inv.sellers, inv.analysis.settings)


def bi_star(inv: Investigation) -> DataFrame:
    return decision.bi_issue_star(inv.analysis.delivery_comparisons, inv.states, inv.sellers)


def brief(inv: Investigation) -> DataFrame:
    settings = inv.analysis.settings
    return decision.issue_brief(
        diagnosis(inv),
        decision.issue_kpi_table(inv.periods),
        top_rows(inv),
        inv.coverage,
        settings,
    )


def overview_document(inv: Investigation) -> DataFrame:
    return documents.issue_overview(inv.analysis.delivery_comparisons, inv.periods, inv.impact)


def states_document(inv: Investigation) -> DataFrame:
    return documents.issue_states_document(inv.analysis.delivery_comparisons, inv.states)


def sellers_document(inv: Investigation) -> DataFrame:
    return documents.issue_sellers_document(
        inv.analysis.delivery_comparisons, inv.coverage, inv.sellers
    )


def issue_states_export(inv: Investigation) -> DataFrame:
    """Ranked states of every issue; the order replaces the rank."""
    return inv.states.drop("contributor_rank")


def issue_sellers_export(inv: Investigation) -> DataFrame:
    return inv.sellers.drop("contributor_rank")


def exports(analysis: Analysis) -> dict[str, DataFrame]:
    """The four BI data sets."""
    inv = analysis.investigate_shared(levels=["state", "seller"])
    return {
        "monthly_kpis": analysis.monthly_kpis,
        "delivery_comparisons": inv.analysis.delivery_comparisons,
        "delivery_issue_states": issue_states_export(inv),
        "delivery_issue_sellers": issue_sellers_export(inv),
    }


def export_order(name: str) -> list[Column]:
    """Sort keys of a BI data set: by month, and by rank within the month."""
    if name == "monthly_kpis":
        return [F.asc("purchase_month")]
    if name == "delivery_comparisons":
        return [F.asc("current_month")]
    return [
        F.asc("current_month"),
        F.desc("excess_late_orders"),
        F.desc("current_eligible_orders"),
        F.asc(EXPORT_KEYS[name][1]),
    ]


# Columns that identify an order or a person.
IDENTIFYING_COLUMNS = ["order_id", "customer_id", "customer_unique_id", "customer_city"]

EXPORT_KEYS = {
    "monthly_kpis": ["purchase_month"],
    "delivery_comparisons": ["current_month"],
    "delivery_issue_states": ["issue_id", "customer_state"],
    "delivery_issue_sellers": ["issue_id", "seller_id"],
}


def export_contract(frames: dict[str, DataFrame], most_rows: int = 15) -> DataFrame:
    """Per data set: rows, repeated keys, identifying columns, overfull issues."""

    def check(name: str, frame: DataFrame) -> DataFrame:
        key = EXPORT_KEYS[name]
        identifying = len([c for c in frame.columns if c in IDENTIFYING_COLUMNS])
        per_key = frame.groupBy(*key).agg(F.count("*").alias("_rows"))
        per_group = per_key.groupBy(key[0]).agg(
            F.sum("_rows").alias("_rows"), F.sum(F.col("_rows") - 1).alias("_repeated")
        )
        overfull = count_where(F.col("_rows") > most_rows)
        return per_group.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("_repeated"), F.lit(0)).alias("repeated_keys"),
            F.lit(identifying).cast("long").alias("identifying_columns"),
            overfull.alias("overfull_groups"),
        ).select(
            F.lit(name).alias("dataset"),
            "*",
            F.when(
                (F.col("row_count") > 0)
                & (F.col("repeated_keys") == 0)
                & (F.col("identifying_columns") == 0)
                & (F.col("overfull_groups") == 0),
                PASSED,
            )
            .otherwise(FAILED)
            .alias("status"),
        )

    return reduce(DataFrame.unionByName, [check(n, f) for n, f in frames.items()])
