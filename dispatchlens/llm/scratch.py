"""Intermediate tables of one operator run, in the session's shared folder."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dispatchlens.plans.shared import fresh_path


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no batch that goes to Python hold more than ``rows`` documents.

    A session option; a smaller value stays.  Texts of some kilobytes in batches of ten
    thousand would take a large part of a small executor, several times over.
    """
    now = int(spark.conf.get(_BATCH_ROWS, "10000"))
    if not 0 < now <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that ``docs`` has no column of."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return [prefix + n for n in names]


class Scratch:
    """Writes tables to the shared folder and deletes those no longer needed.

    A written table cuts the lineage: after the loss of an executor its readers
    read again and compute nothing anew.
    """

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.name = name
        self.paths: dict[int, str] = {}

    def keep(self, frame: DataFrame) -> DataFrame:
        """``frame`` written, and read back."""
        path = fresh_path(self.spark, self.name)
        frame.write.parquet(path)
        table = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def view(self, table: DataFrame, frame: DataFrame) -> DataFrame:
        """``frame``, which reads nothing but the kept ``table`` and is dropped in its place."""
        self.paths[id(frame)] = self.paths.pop(id(table))
        return frame

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` returned and nothing will read again."""
        for table in tables:
            if path := self.paths.pop(id(table), None):
                place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                place.getFileSystem(conf).delete(place, True)


def batches_of(schema: pa.Schema, rows_at_once: int = 2000):
    """A collector that turns rows (tuples) into record batches of bounded size."""
    pending: list[tuple] = []

    def flush():
        columns = list(zip(*pending)) or [[] for _ in schema]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
        )
        pending.clear()
        return batch

    def add(row: tuple):
        pending.append(row)
        return flush() if len(pending) >= rows_at_once else None

    return add, flush
