from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dispatchlens.functions import text as tx
from dispatchlens.functions.months import month_argument, parse_month


def test_normalize_trims_every_kind_of_space_and_drops_missing_tokens(spark):
    values = ["  a b\t", " x　", "\x1fy\x85", "NA", " NA ", "", "   ", "null", "None ", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in frame.select(tx.normalize(F.col("v"))).collect()]
    # A token counts as missing only as it stands, before trimming.
    assert got == ["a b", "x", "y", None, "NA", None, None, None, "None", None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_normalize_agrees_with_strip(spark, values):
    values = [v for v in values if "\x00" not in v and v.isprintable() or v.isspace()]
    rows = [(i, v) for i, v in enumerate(values)]
    if not rows:
        return
    frame = spark.createDataFrame(rows, "i int, v string")
    got = {r.i: r.n for r in frame.select("i", tx.normalize(F.col("v")).alias("n")).collect()}
    for i, v in rows:
        kept = None if v in tx.MISSING_TOKENS else (v.strip() or None)
        assert got[i] == kept


def test_numbers_and_timestamps(spark):
    rows = ["1", "1.0", "1.5", "x", "-3", "2018-01-02", "2018-01-02 03:04:05", "2018", "2018-13-01"]
    frame = spark.createDataFrame([(v,) for v in rows], "v string")
    v = F.col("v")
    got = frame.select(
        tx.parse_integer(v), tx.parse_number(v, "decimal(12,2)"), tx.parse_timestamp(v)
    ).collect()
    assert [r[0] for r in got[:5]] == [1, 1, None, None, -3]
    assert [r[1] for r in got[:4]] == [Decimal("1.00"), Decimal("1.00"), Decimal("1.50"), None]
    assert [r[2] for r in got[5:]] == [
        datetime(2018, 1, 2), datetime(2018, 1, 2, 3, 4, 5), None, None,
    ]


def test_iso_timestamps_are_read_and_zones_are_not(spark):
    read = {
        "2017-01-02T10:00:00": datetime(2017, 1, 2, 10),
        "2017-01-02T10:00": datetime(2017, 1, 2, 10),
        "2017-01-02T10": datetime(2017, 1, 2, 10),
        "2017-01-02 10": datetime(2017, 1, 2, 10),
        "2017-01-02T10:11:12.5": datetime(2017, 1, 2, 10, 11, 12, 500_000),
        "2017-01-02 10:11:12.123456789": datetime(2017, 1, 2, 10, 11, 12, 123_456),
        "2017-01-02 23:59": datetime(2017, 1, 2, 23, 59),
        "2016-02-29T00:00:00.000": datetime(2016, 2, 29),
    }
    refused = [
        "2017-01-02T10:00:00Z", "2017-01-02T10:00:00+01:00", "2017-01-02T10:00-03", "2017-01-02 10:00:00 UTC",
        "2017-01-02T10:00:00 Europe/Berlin", "2017-01-02T", "2017-01-02TT10:00", "2017-01-02T24:00", "2017-01-02T10:60",
        "2017-02-29T10:00", "2017-01T10:00", "T10:00:00", "2017-01-02X10:00", "2017-01-02T10:00:00.", "2017-01", "never",
    ]
    frame = spark.createDataFrame([(v,) for v in [*read, *refused]], "v string")
    got = {r.v: r.t for r in frame.select("v", tx.parse_timestamp(F.col("v")).alias("t")).collect()}
    assert {v: got[v] for v in read} == read
    assert {v for v in refused if got[v] is not None} == set()


def test_month_strings(spark):
    texts = ["2018-02", "2018-8", "2018-13", "18-08", "August-2018", "2018-00", "0000-01", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(parse_month(F.col("t"))).collect()]
    assert got == [date(2018, 2, 1)] + [None] * 7
    assert month_argument("2018-02") == date(2018, 2, 1)
    for text in texts[1:]:
        with pytest.raises(ValueError):
            month_argument(text)
