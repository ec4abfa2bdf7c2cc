"""Running values and overlaps of spans against loops, and a text of very many matches."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import pii, spans


@pytest.mark.parametrize("size", [1, 2, 127, 128, 129, 1000])
def test_running_sums_and_maxima(spark, size):
    values = [random.Random(size).randint(-5, 9) for _ in range(size)]
    frame = spark.createDataFrame([(values,)], "v array<long>")
    zero = F.lit(0).cast("long")
    row = frame.select(
        spans.running(F.col("v"), zero, lambda a, b: a + b).alias("s"),
        spans.running(F.col("v"), zero, lambda a, b: F.greatest(a, b)).alias("m"),
    ).first()
    assert row.s == [0, *itertools.accumulate(values)][:-1]
    assert row.m == list(itertools.accumulate([0, *values], max))[:-1]


def test_spans_apart_from_others(spark):
    rng, rows = random.Random(8), []
    for k in range(60):
        most = rng.choice([0, 3, 300])
        pairs = [[(s, s + rng.randint(1, 9)) for s in sorted(rng.sample(range(4000), most))] for _ in range(2)]
        if k % 5 == 0:
            pairs[k % 2] = []
        rows.append((k, [("c", s, e) for s, e in pairs[0]], [("b", s, e) for s, e in pairs[1]]))
    frame = spark.createDataFrame(rows, f"k int, found {spans.SPANS}, base {spans.SPANS}")
    for r in frame.select("k", spans.apart_from(F.col("found"), F.col("base")).alias("left")).collect():
        _, found, base = rows[r.k]
        want = [f for f in found if not any(b[1] < f[2] and f[1] < b[2] for b in base)]
        assert sorted(map(tuple, r.left)) == sorted(want)


def test_a_text_of_very_many_matches(spark):
    text = " ".join(f"é 10.0.{k % 300}.{k % 256} u{k}@ex.org +49 30 55{k:05d}, key 123-45-{k % 9000 + 1000}" for k in range(3000))
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        want.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            want.append(("ip", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            want.append(("phone", *m.span()))
    got = [tuple(s) for s in row.base if s.kind != "card"]
    assert sorted(got) == sorted(want) and len(want) > 8000
    base = [tuple(s) for s in row.base]
    assert row.added and all(e <= s.start or b >= s.end for s in row.added[:50] for _, b, e in base)
