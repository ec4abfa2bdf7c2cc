"""Nested documents per issue: what a read-only service would answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.operators.detection import ISSUE_COLUMNS, detected_issues
from dispatchlens.operators.investigation import ISSUE_KEYS


def _issue(comparisons: DataFrame) -> DataFrame:
    return detected_issues(comparisons).select(
        F.concat(F.lit("delivery-"), F.date_format("current_month", "yyyy-MM")).alias("issue_id"),
        F.struct(*ISSUE_COLUMNS).alias("issue"),
    )


def _fields(frame: DataFrame, skip: list[str]) -> list[str]:
    return [c for c in frame.columns if c not in ISSUE_KEYS and c not in skip]


def _ordered(frame: DataFrame, order: str, skip: list[str], name: str) -> DataFrame:
    """Detail rows of an issue as an ordered array (a ranking or two periods)."""
    entry = F.struct(F.col(order).alias("_order"), F.struct(*_fields(frame, skip)).alias("row"))
    rows: Column = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])
    return frame.groupBy("issue_id").agg(rows.alias(name))


def _attach(issues: DataFrame, details: DataFrame) -> DataFrame:
    """Add the arrays of ``details``; an issue without rows gets empty ones."""
    joined = issues.join(details, "issue_id", "left")
    arrays = [f for f in details.schema.fields if f.name != "issue_id"]
    return joined.withColumns(
        {f.name: F.coalesce(F.col(f.name), F.array().cast(f.dataType)) for f in arrays}
    )


def issue_overview(comparisons: DataFrame, periods: DataFrame, impact: DataFrame) -> DataFrame:
    """Issue, its periods and its impact."""
    stages = _ordered(periods, "period_month", ["period_month"], "periods")
    effect = impact.select("issue_id", F.struct(*_fields(impact, [])).alias("impact"))
    return _attach(_issue(comparisons), stages).join(effect, "issue_id", "left")


def issue_states_document(comparisons: DataFrame, states: DataFrame) -> DataFrame:
    """Issue and its ranked states."""
    ranked = _ordered(states, "contributor_rank", ["contributor_rank"], "states")
    return _attach(_issue(comparisons), ranked)


def issue_sellers_document(
    comparisons: DataFrame, coverage: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Issue, its single-seller coverage and its ranked sellers."""
    covered = _ordered(coverage, "period_month", ["period_month"], "coverage")
    ranked = _ordered(sellers, "contributor_rank", ["contributor_rank"], "sellers")
    return _attach(_attach(_issue(comparisons), covered), ranked)


def as_json(document: DataFrame) -> DataFrame:
    """(issue_id, document): all other columns as one JSON text, nulls kept."""
    body = F.struct(*[c for c in document.columns if c != "issue_id"])
    options = {"ignoreNullFields": "false"}
    return document.select("issue_id", F.to_json(body, options).alias("document"))
