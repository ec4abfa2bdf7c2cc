"""Fingerprints of tables, and the fact store that is brought up to date by months."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dispatchlens.operators.fingerprint import combined, fingerprint, repeated_run
from dispatchlens.plans import increments
from dispatchlens.plans.analysis import Analysis
from dispatchlens.plans.shared import shared_folder
from dispatchlens.schemas import RAW_COLUMNS
from dispatchlens.sources import sinks

from tests.helpers import order, text_table

ROWS = [(1, "a", None), (2, None, 1.5), (2, None, 1.5), (3, "", -0.0)]
SCHEMA = "k int, s string, x double"


def one(frame) -> tuple:
    return tuple(frame.first())


def test_fingerprint_ignores_order_and_counts_copies(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    whole = one(fingerprint(frame))
    assert whole[0] == 4 and len(whole[1]) == 32
    shuffled = frame.repartition(3, "x").select("x", "k", "s")
    assert one(fingerprint(shuffled)) == whole
    for other in (ROWS[:3], ROWS + ROWS[:1], [*ROWS[:3], (3, None, -0.0)], [*ROWS[:3], (4, "", -0.0)]):
        assert one(fingerprint(spark.createDataFrame(other, SCHEMA)))[1] != whole[1]


def test_values_of_neighbours_do_not_run_together(spark):
    frames = [
        spark.createDataFrame([row], "a string, b string")
        for row in (("1", "2"), ("12", ""), ("", "12"), ("12", None), (None, "12"), ("1 1:2", "2"))
    ]
    assert len({one(fingerprint(f))[1] for f in frames}) == len(frames)


def test_fingerprints_of_parts_add_up(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    parts = fingerprint(frame, ["k"])
    assert parts.count() == 3
    assert one(combined(parts)) == one(fingerprint(frame))
    empty = frame.limit(0)
    assert one(fingerprint(empty)) == (0, "0" * 32)
    assert fingerprint(empty, ["k"]).isEmpty()


def test_repeated_run_names_the_table_that_differs(spark):
    same, other = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(ROWS[1:], SCHEMA)
    found = repeated_run({"a": same, "b": same, "c": same}, {"a": same.repartition(2), "b": other})
    assert {r.table_name: r.status for r in found.collect()} == {"a": "OK", "b": "FAIL", "c": "FAIL"}


def analysis(spark, orders: list[dict], payments: list[dict] | None = None) -> Analysis:
    rows = {"orders": orders, "payments": payments or []}
    return Analysis({name: text_table(spark, name, rows.get(name, [])) for name in RAW_COLUMNS})


JANUARY = order("1", "2018-01-10 00:00:00")
FEBRUARY = order("2", "2018-02-10 00:00:00")


def stored(spark, root) -> list[tuple]:
    rows = increments.read(spark, root).select("purchase_month", "order_id", "recorded_payment_value")
    return sorted((str(m), o, v) for m, o, v in rows.collect())


def test_only_changed_months_are_written(spark, tmp_path):
    root = str(tmp_path / "facts")
    with pytest.raises(sinks.LoadError, match="no facts"):
        increments.read(spark, root)
    first = increments.refresh(analysis(spark, [JANUARY, FEBRUARY]), root)
    assert first == {"2018-01-01": "written", "2018-02-01": "written"}
    assert increments.refresh(analysis(spark, [FEBRUARY, JANUARY]), root) == {
        "2018-01-01": "kept", "2018-02-01": "kept",
    }
    assert len(increments.manifests(spark, root)) == 1
    old = increments.state(spark, root)

    paid = [{"order_id": "2", "payment_sequential": "1", "payment_type": "card",
             "payment_installments": "1", "payment_value": "9.50"}]
    again = increments.refresh(analysis(spark, [JANUARY, FEBRUARY], paid), root)
    assert again == {"2018-01-01": "kept", "2018-02-01": "written"}
    new = increments.state(spark, root)
    assert new["2018-01-01"] == old["2018-01-01"] and new["2018-02-01"].run != old["2018-02-01"].run
    written = Path(root) / f"run={new['2018-02-01'].run}"
    assert [p.name for p in written.glob("purchase_month=*")] == ["purchase_month=2018-02-01"]
    assert [(m, o, v and float(v)) for m, o, v in stored(spark, root)] == [
        ("2018-01-01", "1", None), ("2018-02-01", "2", 9.5),
    ]


def test_months_come_and_go(spark, tmp_path):
    root = str(tmp_path / "facts")
    undated = order("3", None)
    increments.refresh(analysis(spark, [JANUARY]), root)
    assert increments.refresh(analysis(spark, [undated, FEBRUARY]), root) == {
        increments.NO_MONTH: "written", "2018-02-01": "written", "2018-01-01": "dropped",
    }
    assert [row[:2] for row in stored(spark, root)] == [("2018-02-01", "2"), ("None", "3")]
    before = len(list(Path(root).glob("run=*")))
    assert len(increments.drop_unseen(spark, root, keep=1)) == 1 and before == 2
    assert len(stored(spark, root)) == 2


def test_a_run_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "facts")
    increments.refresh(analysis(spark, [JANUARY]), root)
    seen = stored(spark, root)

    def wrong(*arguments):
        raise OSError("lost")

    monkeypatch.setattr(increments, "_written", wrong)
    with pytest.raises(OSError):
        increments.refresh(analysis(spark, [JANUARY, FEBRUARY]), root)
    assert stored(spark, root) == seen


def test_no_facts_empty_the_store(spark, tmp_path):
    root = str(tmp_path / "facts")
    increments.refresh(analysis(spark, [JANUARY]), root)
    assert increments.refresh(analysis(spark, []), root) == {"2018-01-01": "dropped"}
    assert increments.state(spark, root) == {}


def test_a_month_filter_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "facts")
    increments.refresh(analysis(spark, [JANUARY, FEBRUARY]), root)
    rows = increments.read(spark, root).filter(F.col("purchase_month") == F.lit("2018-02-01").cast("date"))
    assert len(rows.inputFiles()) >= 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    assert [r.order_id for r in rows.collect()] == ["2"]


def test_facts_are_made_once_and_their_parts_deleted(spark, tmp_path, monkeypatch):
    """The writer reads a table; with the joins in its plan all shuffles would be made again."""
    root, plans = str(tmp_path / "facts"), []
    write = increments._write

    def watched(rows, folder):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(rows, folder)

    monkeypatch.setattr(increments, "_write", watched)
    made = Path(shared_folder(spark).removeprefix("file:")) / "dispatchlens"
    before = set(made.glob("*/*"))
    increments.refresh(analysis(spark, [JANUARY]), root)
    increments.refresh(analysis(spark, [JANUARY, FEBRUARY]), root)
    assert len(plans) == 2 and not any("Join" in plan or "Aggregate" in plan for plan in plans)
    assert set(made.glob("*/*")) == before
    assert [row[:2] for row in stored(spark, root)] == [("2018-01-01", "1"), ("2018-02-01", "2")]
