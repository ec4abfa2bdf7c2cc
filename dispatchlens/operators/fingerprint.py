"""Fingerprints of tables as multisets of rows.

A row's SHA-256 gives eight lanes of 16 bits; a table's fingerprint is the sum of each
lane modulo 2^16.  Sums do not depend on the order of rows or tasks, count repeated rows
as often as they occur, combine before the shuffle, and fingerprints of parts add up to
the fingerprint of the whole.  A lane's sum stays within a long up to 10^14 rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlens.operators.quality import FAILED, PASSED

_LANES, _WIDTH = 8, 4  # lanes, hexadecimal digits of each


def _value_text(field: T.StructField) -> Column:
    """A value as text, different for different values of the column."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(field.dataType, (T.StructType, T.ArrayType)):
        return F.to_json(column)
    return column.cast("string")


def row_digest(schema: T.StructType) -> Column:
    """SHA-256 of a row; columns count by name, so their order does not matter.

    Every value is preceded by its length, and a null is a dash, so neighbouring values
    cannot run together.
    """
    texts = [_value_text(f) for f in sorted(schema.fields, key=lambda f: f.name)]
    sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws(" ", *sized), 256)


def _lane(digits: Column, i: int) -> Column:
    return F.conv(F.substring(digits, _WIDTH * i + 1, _WIDTH), 16, 10).cast("long")


def _joined(sums: list[Column]) -> Column:
    parts = [F.lpad(F.lower(F.hex(s % 16**_WIDTH)), _WIDTH, "0") for s in sums]
    return F.concat(*parts)


def _added(frame: DataFrame, digits: str, rows: Column, by: list[str]) -> DataFrame:
    lanes = [F.coalesce(F.sum(_lane(F.col(digits), i)), F.lit(0)) for i in range(_LANES)]
    named = [lane.alias(f"_lane{i}") for i, lane in enumerate(lanes)]
    sums = frame.groupBy(*by).agg(F.coalesce(rows, F.lit(0)).alias("row_count"), *named)
    return sums.select(*by, "row_count", _joined([F.col(f"_lane{i}") for i in range(_LANES)]).alias("fingerprint"))


def fingerprint(frame: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows and fingerprint of ``frame``, or of each group of ``by``.

    Without ``by`` an empty table gives one row, of zeros.  Columns of ``by`` are part of
    the rows as well.
    """
    by = by or []
    digests = frame.select(*by, row_digest(frame.schema).alias("_digest"))
    return _added(digests, "_digest", F.count("*"), by)


def combined(fingerprints: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The fingerprint of several tables' rows together, from their fingerprints."""
    return _added(fingerprints, "fingerprint", F.sum("row_count"), by or [])


def table_fingerprints(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table."""
    parts = [fingerprint(f).select(F.lit(t).alias("table_name"), "*") for t, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def repeated_run(first: Mapping[str, DataFrame], second: Mapping[str, DataFrame]) -> DataFrame:
    """Whether two runs gave the same rows, table by table.

    A table that only one run has fails, with null for the other run.
    """
    one, two = (
        table_fingerprints(run).withColumnsRenamed(
            {"row_count": f"{which}_rows", "fingerprint": f"{which}_fingerprint"}
        )
        for run, which in ((first, "first"), (second, "second"))
    )
    same = F.col("first_rows").eqNullSafe(F.col("second_rows")) & F.col(
        "first_fingerprint"
    ).eqNullSafe(F.col("second_fingerprint"))
    return one.join(two, "table_name", "full").withColumn("status", F.when(same, PASSED).otherwise(FAILED))
