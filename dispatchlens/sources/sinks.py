"""Writers: typed tables, cleaned CSV files and report files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text forms of values: dates are ISO, decimals are plain (scales stay within
# six digits), booleans are lower case and a null is an empty field.
CSV_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "lineSep": "\n",
}


def write_csv(frame: DataFrame, path: str) -> None:
    """A cleaned table as CSV, in as many files as it has partitions."""
    frame.write.mode("errorifexists").options(**CSV_FORMAT).csv(path)


def write_report(
    frame: DataFrame, path: str, order: list[Column], replace: bool = False
) -> int:
    """A bounded report as one ordered CSV file; returns its rows.

    The report is written aside, counted while it is written, and moved to ``path`` only
    if it has rows; an empty report is an error and leaves nothing behind.  With
    ``replace`` it takes the place of an earlier report, which stays if anything fails.
    """
    spark = frame.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(place) and not replace:
        raise ValueError(f"the report {path} exists")
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    fresh = spark._jvm.org.apache.hadoop.fs.Path(aside)
    written = Observation()
    counted = frame.observe(written, F.count(F.lit(1)).alias("rows"))
    single = counted.repartition(1).sortWithinPartitions(*order)
    single.write.mode("errorifexists").options(**CSV_FORMAT).csv(aside)
    rows = written.get["rows"]
    if rows == 0:
        files.delete(fresh, True)
        raise ValueError(f"the report {path} holds no rows")
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{aside}.old")
    replaced = files.exists(place) and files.rename(place, old)
    if not files.rename(fresh, place):
        if replaced:
            files.rename(old, place)
        raise OSError(f"the report could not be moved to {path}")
    if replaced:
        files.delete(old, True)
    return rows


def conform(frame: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``frame`` with exactly the types of ``schema``.

    A value that does not fit, or a null where none may be, fails the job.
    """

    def strict(field: T.StructField) -> Column:
        column = F.col(field.name)
        value = column.try_cast(field.dataType)
        text = F.coalesce(column.cast("string"), F.lit("null"))
        failure = F.raise_error(F.concat(F.lit(f"{table}.{field.name} cannot hold "), text))
        unfit = column.isNotNull() & value.isNull()
        if not field.nullable:
            unfit = value.isNull()
        return F.when(unfit, failure).otherwise(value).alias(field.name)

    return frame.select(*[strict(f) for f in schema.fields])


class LoadError(ValueError):
    """A table cannot be loaded as it stands."""


def load_table(frame: DataFrame, table: str, schema: T.StructType) -> None:
    """Load an existing, empty catalog table with exactly ``schema``'s columns."""
    spark = frame.sparkSession
    if not spark.catalog.tableExists(table):
        raise LoadError(f"table {table} does not exist")
    target = spark.table(table)
    if target.columns != frame.columns:
        raise LoadError(f"{table} has columns {target.columns}, not {frame.columns}")
    if not target.isEmpty():
        raise LoadError(f"{table} already holds rows")
    conform(frame, schema, table).write.insertInto(table)


def create_table(spark, table: str, schema: T.StructType) -> None:
    empty = spark.createDataFrame([], schema)
    empty.write.mode("errorifexists").format("parquet").saveAsTable(table)
