"""Versions of the cleaned tables: written whole, then shown by one small file.

A load writes all tables under a folder of its own and checks their rows.  Only then does
it add a manifest that names the folder.  Readers follow the highest manifest, so they see
the version before or the version after a load, never a part of either; what a broken load
leaves behind no reader looks at.  A manifest is one new file that is never changed, which
needs no renaming and holds on object stores, too.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dispatchlens.operators import quality
from dispatchlens.operators.constraints import Lengths
from dispatchlens.plans import gate
from dispatchlens.plans.analysis import Analysis
from dispatchlens.plans.store import with_clean_tables
from dispatchlens.schemas import CLEAN_TABLES
from dispatchlens.settings import Settings
from dispatchlens.sources import sinks

_PREFIX = "manifest-"


class Files:
    """The file system of a folder, as the session sees it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        place = self.path("")
        self.files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, prefix: str) -> list[str]:
        if not self.files.exists(self.path("")):
            return []
        return sorted(
            s.getPath().getName()
            for s in self.files.listStatus(self.path(""))
            if s.getPath().getName().startswith(prefix)
        )

    def add(self, name: str, text: str) -> None:
        """A new file; an error if it exists."""
        out = self.files.create(self.path(name), False)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        source = self.files.open(self.path(name))
        text = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        source.close()
        return text

    def delete(self, name: str) -> None:
        self.files.delete(self.path(name), True)


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    rows: dict[str, int]


def _parsed(number: int, text: str) -> Version | None:
    """None for a manifest that is still being written."""
    try:
        content = json.loads(text)
        return Version(number, content["folder"], content["rows"])
    except ValueError:
        return None


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All published versions, the oldest first."""
    files = Files(spark, root)
    found = [_parsed(int(n.removeprefix(_PREFIX)), files.read(n)) for n in files.names(_PREFIX)]
    return [v for v in found if v]


def current(spark: SparkSession, root: str) -> Version | None:
    found = versions(spark, root)
    return found[-1] if found else None


def tables_of(spark: SparkSession, root: str, version: Version) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{version.folder}/{name}")
        for name, schema in CLEAN_TABLES.items()
    }


def published(spark: SparkSession, root: str, settings: Settings = Settings()) -> Analysis:
    """The analysis over the current version."""
    version = current(spark, root)
    if version is None:
        raise sinks.LoadError(f"nothing is published under {root}")
    return with_clean_tables(tables_of(spark, root, version), settings)


def publish(
    spark: SparkSession, analysis: Analysis, root: str, lengths: Lengths = Lengths(), again: bool = False
) -> Version:
    """Gate, write, check and show the cleaned tables as a new version.

    Where a version has the rows that the raw tables have, it stays and nothing is written,
    unless ``again``.  Raises before the manifest is added if the gate finds anything, a
    write fails or a table has fewer or more rows than its source.
    """
    sources = {name: analysis.raw[name] for name in CLEAN_TABLES}
    before = current(spark, root)
    if before and not again:
        expected = {r.table_name: r.actual_rows for r in quality.row_counts(sources).collect()}
        if before.rows == expected:
            return before
    gate.require_clean(analysis, lengths)
    folder = f"version-{uuid.uuid4().hex}"
    for name, frame in analysis.clean_tables().items():
        schema = CLEAN_TABLES[name]
        whole = sinks.conform(frame.select(*schema.fieldNames()), schema, name)
        whole.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{folder}/{name}")
    number = before.number + 1 if before else 1
    fresh = Version(number, folder, {})
    counts = quality.counts_against(tables_of(spark, root, fresh), sources).collect()  # a row per table
    wrong = sorted(r.table_name for r in counts if r.actual_rows != r.expected_rows)
    if wrong:
        raise sinks.LoadError(f"rows were lost or added in {wrong}")
    rows = {r.table_name: r.actual_rows for r in counts}
    Files(spark, root).add(f"{_PREFIX}{number:012d}", json.dumps({"folder": folder, "rows": rows}))
    return Version(number, folder, rows)


def drop_unseen(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all folders but those of the last ``keep`` versions; returns their names.

    Not while a load runs: its folder is not named by any manifest yet.
    """
    files, known = Files(spark, root), versions(spark, root)
    kept = {v.folder for v in known[-keep:]}
    gone = [n for n in files.names("version-") if n not in kept]
    for version in known[:-keep]:
        files.delete(f"{_PREFIX}{version.number:012d}")
    for name in gone:
        files.delete(name)
    return gone
