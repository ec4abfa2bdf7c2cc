"""Spans of texts as arrays of kind, start and end: found, compared and written.

Built-in expressions, whose time grows little faster than the number of spans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"


def written(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end``, comma-joined, by start, then kind in the order of ``kinds``."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"),
            s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


_RUN = 128  # values that are summed one after the other


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, initial: Column, merge) -> Column:
    """For each value of a non-empty array, what all values before it merge to.

    An array cannot grow within an expression without being copied, so values are merged
    in runs, and the runs' totals on top.
    """

    def merged(items: Column, start: Column) -> Column:
        return F.aggregate(items, F.array(start), lambda done, x: F.array_append(done, merge(F.element_at(done, -1), x)))

    def in_runs(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / _RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(v, k * _RUN + 1, F.lit(_RUN)))

    def all_runs(runs: Column) -> Column:
        starts = merged(F.transform(runs, lambda run: F.aggregate(run, initial, merge)), initial)
        zipped = F.arrays_zip(runs.alias("run"), F.slice(starts, F.lit(1), F.size(runs)).alias("start"))
        return F.flatten(
            F.transform(zipped, lambda z: F.slice(merged(z["run"], z["start"]), F.lit(1), F.size(z["run"])))
        )

    return let(let(values, in_runs), all_runs)


def apart_from(spans: Column, base: Column) -> Column:
    """The spans, by start, that overlap none of the base spans; both with start and end."""
    none, last = F.lit(0).cast("long"), F.lit(1 << 40).cast("long")

    def mark(s: Column, kind: int, span: Column) -> Column:
        return F.struct(
            s["start"].cast("long").alias("start"), F.lit(kind).alias("kind"),
            s["end"].cast("long").alias("end"), span.alias("span"),
        )

    def judged(marks: Column) -> Column:
        ends = F.transform(marks, lambda m: F.when(m["kind"] == 0, m["end"]).otherwise(none))
        starts = F.transform(F.reverse(marks), lambda m: F.when(m["kind"] == 0, m["start"]).otherwise(last))
        zipped = F.arrays_zip(
            marks.alias("mark"),
            running(ends, none, lambda a, b: F.greatest(a, b)).alias("before"),
            F.reverse(running(starts, last, lambda a, b: F.least(a, b))).alias("after"),
        )
        free = F.filter(
            zipped,
            lambda z: (z["mark"]["kind"] == 1) & (z["before"] <= z["mark"]["start"]) & (z["after"] >= z["mark"]["end"]),
        )
        return F.transform(free, lambda z: z["mark"]["span"])

    def sorted_marks(found: Column) -> Column:
        """Base spans carry some span as well, so that all marks are of one type."""
        of_base = F.transform(base, lambda b: mark(b, 0, F.get(found, F.lit(0))))
        return F.array_sort(F.concat(of_base, F.transform(found, lambda s: mark(s, 1, s))))

    empty = F.size(spans) < 1
    alone = F.size(base) < 1
    return F.when(empty | alone, spans).otherwise(let(let(spans, sorted_marks), judged))
