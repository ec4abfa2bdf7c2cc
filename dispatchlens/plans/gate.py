"""The gate before a load: all that is wrong with the raw tables, and a refusal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.operators import cleaning, constraints, quality
from dispatchlens.operators.audit import Reference, audit
from dispatchlens.operators.constraints import Lengths
from dispatchlens.plans.analysis import Analysis
from dispatchlens.schemas import KEYS
from dispatchlens.sources.sinks import LoadError


def unreadable(analysis: Analysis) -> DataFrame:
    """Columns with values that are no number or no timestamp, whoever uses them."""
    text = {
        name: frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
        for name, frame in analysis.raw.items()
        if name in quality.NUMERIC_COLUMNS or name in quality.TIMESTAMP_COLUMNS
    }
    invalid = quality.invalid_values(text).filter("invalid > 0")
    subject = F.concat_ws(".", "table_name", "column_name")
    return invalid.select(
        F.lit("unreadable").alias("check"), subject.alias("subject"), F.col("invalid").alias("rows")
    )


def defects(analysis: Analysis, lengths: Lengths = Lengths()) -> DataFrame:
    """Broken keys, references and row rules, and unmapped categories, as counts.

    The rules are those of the cleaned tables, all of them; each table is read once.
    """
    category = "product_category_name"
    manual = cleaning.MANUAL_TRANSLATIONS if analysis.manual is None else analysis.manual
    mapped = Reference("products", category, "category_translation", category, tuple(manual))
    tables = analysis.clean_tables()
    tables["category_translation"] = cleaning.normalize_strings(analysis.raw["category_translation"])
    found = audit(
        tables, constraints.broken_rules(analysis.settings, lengths), KEYS, [*constraints.REFERENCES, mapped]
    )
    kind, rule, table = F.col("kind"), F.col("rule"), F.col("table_name")
    unmapped = rule == mapped.name
    check = (
        F.when(kind == "missing", "missing key")
        .when(kind == "key", "repeated key")
        .when(kind == "row", "rule")
        .when(unmapped, "unmapped category")
        .otherwise("orphan")
    )
    subject = (
        F.when(kind == "row", F.concat_ws(": ", table, rule))
        .when(unmapped, table)
        .when(kind == "reference", rule)
        .otherwise(F.concat_ws(" ", table, rule))
    )
    return found.filter("failing > 0").select(
        check.alias("check"), subject.alias("subject"), F.col("failing").alias("rows")
    )


def quarantine(analysis: Analysis, lengths: Lengths = Lengths()) -> DataFrame:
    """The rows of the cleaned tables that break a row rule, with the rules' names."""
    return constraints.quarantined_rows(analysis.clean_tables(), analysis.settings, lengths)


def require_clean(analysis: Analysis, lengths: Lengths = Lengths()) -> None:
    """Raise with all findings if the raw tables are not fit to be loaded.

    Values come first: nothing else can be judged before they can be read.
    """
    for found in (unreadable(analysis), defects(analysis, lengths)):
        rows = found.orderBy("check", "subject").collect()  # a row per column or rule
        if rows:
            listed = "; ".join(f"{r.check}: {r.subject} ({r.rows})" for r in rows)
            raise LoadError(f"the tables are not clean: {listed}")
