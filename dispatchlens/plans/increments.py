"""The fact store, brought up to date month by month.

Every month's rows lie in the folder of the run that wrote them.  A manifest, one small file
per run, names the folder, the rows and the fingerprint of each month.  A run compares the
fingerprints of the facts as they are now with those of the last manifest, writes only the
months that differ, and shows them with a manifest of its own.  Readers follow the last
manifest, so they see the store before or after a run and never a part of one, and an
unchanged month is neither written nor moved.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.operators.fingerprint import fingerprint
from dispatchlens.plans.analysis import Analysis
from dispatchlens.plans.shared import free_shuffles
from dispatchlens.plans.store import analysis_of_facts, staged_fact_rows
from dispatchlens.plans.versions import Files
from dispatchlens.settings import Settings
from dispatchlens.sources import sinks

_PREFIX, _MONTH, _RUN = "facts-", "purchase_month", "run"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a month


@dataclass(frozen=True)
class Month:
    """A month's rows, their fingerprint, and the run that wrote them."""

    rows: int
    fingerprint: str
    run: str


def _months(frame: DataFrame) -> dict[str, tuple[int, str]]:
    """Rows and fingerprint per month: as many rows as the data has months."""
    found = fingerprint(frame, [_MONTH]).collect()
    return {
        NO_MONTH if r[_MONTH] is None else r[_MONTH].isoformat(): (r["row_count"], r["fingerprint"])
        for r in found
    }


def manifests(spark: SparkSession, root: str) -> list[str]:
    return Files(spark, root).names(_PREFIX)


def state(spark: SparkSession, root: str) -> dict[str, Month]:
    """The months of the store as the last manifest shows them; empty before the first run."""
    names = manifests(spark, root)
    if not names:
        return {}
    content = json.loads(Files(spark, root).read(names[-1]))
    return {month: Month(**entry) for month, entry in content.items()}


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the store; a filter on the month prunes folders."""
    months = state(spark, root)
    if not months:
        raise sinks.LoadError(f"no facts are stored under {root}")
    base = root.rstrip("/")
    folders = [f"{base}/{_RUN}={m.run}/{_MONTH}={month}" for month, m in sorted(months.items())]
    rows = spark.read.option("basePath", base).parquet(*folders).drop(_RUN)
    return rows.withColumn(_MONTH, F.col(_MONTH).cast("date"))


def read_analysis(
    spark: SparkSession, root: str, sellers: DataFrame, settings: Settings = Settings()
) -> Analysis:
    """An analysis whose orders come from the store."""
    return analysis_of_facts(read(spark, root), sellers, settings)


def refresh(analysis: Analysis, root: str) -> dict[str, str]:
    """Bring the store under ``root`` up to date; what was done to each month.

    ``written`` months are new or differ, ``kept`` ones are as they were, ``dropped`` ones
    have no rows any more.  With nothing to do no manifest is added.  The written rows are
    read back, and unless their fingerprints are those of the facts, nothing is shown and
    ``LoadError`` is raised.  Of two runs at a time the one that ends later fails, since
    manifests are numbered and never replaced.  Facts without rows empty the store.

    The facts are computed once, into the session's shared folder, and deleted there at the end.
    """
    with staged_fact_rows(analysis) as rows:
        return _refreshed(rows, root)


def _refreshed(rows: DataFrame, root: str) -> dict[str, str]:
    spark, base = rows.sparkSession, root.rstrip("/")
    seen = manifests(spark, root)
    before, run = state(spark, root), uuid.uuid4().hex
    folder = f"{base}/{_RUN}={run}"
    if before:
        now = _months(rows)
        changed = [m for m, found in now.items() if m not in before or found != (before[m].rows, before[m].fingerprint)]
        if changed:
            _write(_of_months(rows, changed), folder)
    else:  # everything is new: written first, so that the facts are read once
        _write(rows, folder)
        now = changed = None
    if changed is None or changed:
        written = _months(_written(spark, folder, rows))
        if changed is None:
            now, changed = written, list(written)
        elif written != {m: now[m] for m in changed}:
            raise sinks.LoadError(f"the facts changed while they were written to {folder}")
    gone = sorted(set(before) - set(now))
    if changed or gone:
        kept = {m: asdict(before[m]) for m in now if m not in changed}
        fresh = {m: asdict(Month(*now[m], run)) for m in changed}
        number = int(seen[-1].removeprefix(_PREFIX)) + 1 if seen else 1
        Files(spark, root).add(f"{_PREFIX}{number:012d}", json.dumps(kept | fresh))
    actions = {m: "written" if m in changed else "kept" for m in now}
    return actions | {m: "dropped" for m in gone}


def _of_months(rows: DataFrame, months: list[str]) -> DataFrame:
    dated = [date.fromisoformat(m) for m in months if m != NO_MONTH]
    chosen = F.col(_MONTH).isin(dated)
    return rows.filter(chosen | F.col(_MONTH).isNull() if NO_MONTH in months else chosen)


def _write(rows: DataFrame, folder: str) -> None:
    balanced = rows.hint("rebalance", _MONTH)
    balanced.write.mode("errorifexists").partitionBy(_MONTH).parquet(folder)
    free_shuffles(rows.sparkSession)


def _written(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """What a run wrote, with the columns and types that it had before."""
    return spark.read.schema(like.schema).parquet(folder).select(*like.columns)


def drop_unseen(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the runs that none of the last ``keep`` manifests names; returns their names.

    Not while a run works: its folder is named by no manifest yet.
    """
    files, names = Files(spark, root), manifests(spark, root)
    kept = {
        entry["run"] for name in names[-keep:] for entry in json.loads(files.read(name)).values()
    }
    gone = [n for n in files.names(f"{_RUN}=") if n.removeprefix(f"{_RUN}=") not in kept]
    for name in [*names[:-keep], *gone]:
        files.delete(name)
    return gone
