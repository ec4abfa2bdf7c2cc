"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.crosscheck import compare, connect

FOLDER = "/root/testdata/sf0.001"
# The optional training-data operators have tests of their own.
OWN = {n: q for n, q in queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)}


@pytest.fixture(scope="module")
def checks(spark):
    """What differs, and the plan, of every query; several run at a time."""
    connection, statements = connect(FOLDER), oracle_sql()

    def check(item):
        name, query = item
        frame = query(spark, FOLDER)
        difference = compare(frame, connection.cursor(), statements[name])
        return name, difference, frame._jdf.queryExecution().executedPlan().toString()

    with ThreadPoolExecutor(6) as pool:
        return {name: rest for name, *rest in pool.map(check, OWN.items())}


def test_every_query_has_a_counterpart():
    assert set(OWN) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(checks, name):
    difference, plan = checks[name]
    assert difference is None
    assert not re.search("CartesianProduct|NestedLoop|Python|Pandas", plan)


def test_entry(spark):
    rows = entry(spark).collect()
    changes = [r.on_time_delivery_change_pp for r in rows]
    assert rows and changes == sorted(changes) and max(changes) <= -5
