"""Raw CSV files, read as text under a header contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.schemas import MULTILINE_TABLES, RAW_COLUMNS
from dispatchlens.sources import split_csv

# Quotes inside a quoted field are doubled.
_FORMAT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


@dataclass(frozen=True)
class Problem:
    """What is wrong with a source: with the whole file, or with a column."""

    table_name: str
    column_name: str | None
    problem: str


class HeaderError(ValueError):
    """A file's header breaks its contract."""


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the (first) file; they must be present and distinct."""
    first = spark.read.options(**_FORMAT, header=False, multiLine=False).csv(path).first()
    if first is None:
        raise HeaderError(f"{path} is empty")
    names = [(name or "").removeprefix("﻿") for name in first]
    if any(not name.strip() for name in names):
        raise HeaderError(f"{path} has a column without a name")
    if len(set(names)) != len(names):
        raise HeaderError(f"{path} repeats a column name")
    return names


def read_text(
    spark: SparkSession, path: str, header: list[str], multiline: bool, split: bool = False
) -> DataFrame:
    """All columns as text; every file of ``path`` must have ``header``.

    Only files whose fields may hold line breaks need ``multiline``: it keeps a
    file from being split, so such data should come in many files, or be read with
    ``split``, which finds the records of a large file in many tasks (``split_csv``).
    """
    if multiline and split:
        return split_csv.read_text(spark, path, header, _FORMAT)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    options = {
        **_FORMAT,
        "header": True,
        "multiLine": multiline,
        # Compare the header of each file with the schema instead of trusting it.
        "enforceSchema": False,
        "mode": "FAILFAST",
    }
    return spark.read.schema(schema).options(**options).csv(path)


def header_problems(table: str, header: list[str], expected: list[str]) -> list[Problem]:
    missing = [Problem(table, c, "missing") for c in sorted(set(expected) - set(header))]
    surplus = [Problem(table, c, "unexpected") for c in sorted(set(header) - set(expected))]
    return missing + surplus


def load_raw(
    spark: SparkSession,
    table: str,
    path: str,
    expected: list[str] | None = None,
    split: bool = False,
) -> DataFrame:
    """One raw table in contract order; a broken header raises."""
    expected = RAW_COLUMNS[table] if expected is None else expected
    header = read_header(spark, path)
    problems = header_problems(table, header, expected)
    if problems:
        listed = ", ".join(f"{p.column_name} {p.problem}" for p in problems)
        raise HeaderError(f"{table}: {listed}")
    return read_text(spark, path, header, table in MULTILINE_TABLES, split).select(*expected)


def load_all(
    spark: SparkSession, paths: dict[str, str], split: bool = False
) -> tuple[dict[str, DataFrame], list[Problem]]:
    """All readable tables, and the problems of the others."""
    frames: dict[str, DataFrame] = {}
    problems: list[Problem] = []
    for table, path in paths.items():
        try:
            header = read_header(spark, path)
        except AnalysisException:
            problems.append(Problem(table, None, "file not found"))
            continue
        except HeaderError as error:
            problems.append(Problem(table, None, str(error)))
            continue
        broken = header_problems(table, header, RAW_COLUMNS[table])
        if broken:
            problems += broken
        else:
            multiline = table in MULTILINE_TABLES
            text = read_text(spark, path, header, multiline, split)
            frames[table] = text.select(*RAW_COLUMNS[table])
    return frames, problems


def problems_frame(spark: SparkSession, problems: list[Problem]) -> DataFrame:
    rows = [(p.table_name, p.column_name, p.problem) for p in problems]
    return spark.createDataFrame(rows, "table_name string, column_name string, problem string")


def count_records(frame: DataFrame) -> int:
    """Records, not lines: a quoted field may span lines."""
    return frame.agg(F.count("*")).first()[0]
