"""The audit of several tables against counting by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dispatchlens.operators import audit as au
from dispatchlens.operators.audit import Reference, audit


def tables(spark, rows=600, seed=1):
    """A third of the items belong to one order; keys repeat and are missing."""
    rng = random.Random(seed)
    orders = [(f"o{k}" if k % 17 else None, rng.choice(["c1", "c2", "c9", None])) for k in range(rows // 4)]
    orders += [("o1", "c1"), ("o1", "c2")]
    items = [
        (
            "o1" if k % 3 == 0 else rng.choice([f"o{rng.randint(0, 200)}", None]),
            rng.choice([rng.randint(1, 4), None]),
            rng.choice([-1, 0, 5, None]),
        )
        for k in range(rows)
    ]
    customers = [("c1",), ("c2",), ("c2",), ("c5",)]
    return {
        "orders": (orders, "order_id string, customer_id string"),
        "items": (items, "order_id string, number int, price int"),
        "customers": (customers, "customer_id string"),
    }


KEYS = {"orders": ["order_id"], "items": ["order_id", "number"], "customers": ["customer_id"]}
REFERENCES = [Reference("orders", "customer_id", "customers", "customer_id"), Reference("items", "order_id", "orders", "order_id", ("o3", "o199"))]


def by_hand(data):
    found = {}
    items = data["items"][0]
    found["items", "row", "price positive"] = sum(p is not None and p <= 0 for _, _, p in items)
    found["items", "row", "price is not five"] = sum(p == 5 for _, _, p in items)
    for name, columns in KEYS.items():
        keys = [r[: len(columns)] for r in data[name][0]]
        found[name, "missing", ", ".join(columns)] = sum(None in k for k in keys)
        found[name, "key", ", ".join(columns)] = len(keys) - len(set(keys))
    for ref, column in zip(REFERENCES, (1, 0)):
        child = {r[column] for r in data[ref.child][0]} - {None} - set(ref.known)
        found[ref.child, "reference", ref.name] = len(child - {r[0] for r in data[ref.parent][0]})
    return found


@pytest.mark.parametrize("which", ["whole", "no parents", "empty"])
def test_audit_counts_rows_keys_and_references(spark, which):
    data = tables(spark)
    if which != "whole":
        data["orders"] = ([], data["orders"][1])
    if which == "empty":
        data = {name: ([], schema) for name, (_, schema) in data.items()}
    frames = {n: spark.createDataFrame(rows, schema) for n, (rows, schema) in data.items()}
    failing = {"items": {"price positive": F.col("price") <= 0, "price is not five": F.col("price") == 5}}
    found = audit(frames, failing, KEYS, REFERENCES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Three tables and twice the meanings of the counts; no table joins another.
    assert plan.count("Scan ExistingRDD") == 5 and plan.count("Join") == 1
    got = {(r.table_name, r.kind, r.rule): r.failing for r in found.collect()}
    assert got == by_hand(data)


def test_keys_of_several_columns_do_not_run_together(spark):
    frame = spark.createDataFrame(
        [("a", "b c"), ("a b", "c"), ("a", None), (None, "a"), ("-", None), ("1:a", "b"), ("1", "a b")], "x string, y string"
    )
    assert frame.select(au.key_text(["x", "y"])).distinct().count() == 7


def test_more_rules_than_fit_a_word(spark):
    frame = spark.range(200).withColumn("x", F.col("id").cast("string"))
    failing = {"t": {f"rule {k}": F.col("id") % (k + 2) == 0 for k in range(130)}}
    got = {r.rule: r.failing for r in audit({"t": frame}, failing, {"t": ["x"]}).collect() if r.kind == "row"}
    assert got == {f"rule {k}": sum(i % (k + 2) == 0 for i in range(200)) for k in range(130)}
    rows = au.quarantined(frame, "t", failing["t"], ["x"]).collect()
    assert len(rows) == 199 - sum(all(i % (k + 2) for k in range(130)) for i in range(1, 200)) + 1
    assert {r.row_key for r in rows} | {r.x for r in au.without_quarantined(frame, failing["t"]).collect()} == {
        str(i) for i in range(200)
    }
    named = {r.row_key: r.failed_rules for r in rows}
    assert named["7"] == "rule 5" and named["9"] == "rule 1; rule 7"
    with pytest.raises(ValueError, match="more than 60"):
        au.failed_bits([F.lit(True)] * 61)


def test_rows_without_a_verdict_are_not_quarantined(spark):
    frame = spark.createDataFrame([("a", 1), ("b", None), (None, -1)], "k string, n int")
    rows = au.quarantined(frame, "t", {"positive": F.col("n") <= 0, "named": F.col("k").isNull()}, ["k", "n"]).collect()
    assert [tuple(r) for r in rows] == [("t", "-1", "positive; named")]
