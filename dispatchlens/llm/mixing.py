"""Mixing sources to target weights on a curriculum that changes with time.

Each source has a share of the mix and a weight schedule over the time of training from
0 to 1.  The integral of its schedule up to a time is the number of words it has delivered
by then; inverting it gives the time at which each of its documents is due.  A source
that is to deliver more words than it has is read again, at most ``MOST`` times.

Only built-in expressions; the running sums are taken in two steps (within buckets of a
source, then over the buckets' totals), so that a large source is no single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch, unused

MOST = 3
_BUCKET_ROWS = 10_000


@dataclass(frozen=True)
class Schedule:
    """Weights repeat over the sources in code-point order, null last.

    A source's weight at time t is its share times 1 + slope * (2 t - 1); slopes repeat
    over the sources too and lie between -1 and 1, so the integral over all time is the
    share and the weight is never negative.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5)


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, schedule: Schedule) -> DataFrame:
    """``source, source_size, n, weight, slope, target``, a row per source.

    The shares of all words by weight, where no source exceeds ``MOST`` times its size:
    with the sources ordered by size over weight, those below a level are filled and
    the rest share by weight.  One row per source goes through the window; sources are
    the named parts of a mix, not a quantity that follows the documents.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("index", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", _pick(schedule.weights, F.col("index")).cast("long"))
    ranked = ranked.withColumn("slope", _pick(schedule.slopes, F.col("index")).cast("double"))
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), "index")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0).cast("long")
    filled = (
        ranked.withColumn("words", F.sum("source_size").over(everything))
        .withColumn("filled", MOST * F.coalesce(F.sum("source_size").over(before), zero))
        .withColumn(
            "open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
        )
    )
    share = (F.col("words") - F.col("filled")) / F.col("open")
    # Filling one source too few, or one too many, both lower the level.
    level = F.max(share).over(everything)
    return filled.select(
        "source",
        "source_size",
        "n",
        "weight",
        "slope",
        F.least(
            (MOST * F.col("source_size")).cast("double"), level * F.col("weight")
        ).alias("target"),
    )


def due_time(done: Column, slope: Column) -> Column:
    """The time at which the share ``done`` of a source is delivered.

    The schedule's integral is (1 - slope) t + slope t squared; its inverse is written
    so that no slope divides by zero.
    """
    start = 1 - slope
    return F.least(
        F.lit(1.0),
        F.when(done <= 0, F.lit(0.0)).otherwise(
            2 * done / (start + F.sqrt(F.greatest(start * start + 4 * slope * done, F.lit(0.0))))
        ),
    )


def word_count(text: str = "text") -> Column:
    count = F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(count, F.lit(0)).cast("long")


def mix(docs: DataFrame, schedule: Schedule | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, taken, position``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are not looked at.
    ``taken`` is the number of words of the document that the mix takes, repeats counted:
    the source is read in an order that the id's hash fixes, again and again, until the
    target is reached, so the last document may be taken in part.  ``position`` is the
    time at which the document is first due, null if it is not.  A null or empty text
    has no words and is not taken.  Rows that repeat an id are told apart by their size;
    equal ones share the words in an arbitrary but fixed order.
    """
    schedule = schedule or Schedule()
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.keep(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            word_count().alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"),
        )
    )
    targets = scratch.keep(source_targets(sizes, schedule))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("b.n") / _BUCKET_ROWS)).cast("long")
    prefix = F.conv(F.substring("a.key", 1, 8), 16, 10).cast("long")
    rows = (
        sizes.alias("a")
        .join(targets.alias("b"), same)
        .select("a.*", "b.source_size", "b.slope", "b.target", F.shiftright(prefix * buckets, 32).alias("bucket"))
    )
    rows = scratch.keep(rows)
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = running.alias("a").join(
        totals.alias("b"), same & (F.col("a.bucket") == F.col("b.bucket"))
    )
    place = F.col("a.inside") + F.col("b.before")
    budget = F.round("a.target").cast("long")
    taken = sum(
        F.least(
            F.greatest(budget - place - turn * F.col("a.source_size"), F.lit(0)), F.col("a.size")
        )
        for turn in range(MOST)
    )
    return joined.select(
        "a.doc_id", "a.source", "a.size", "a.source_size", "a.target",
        taken.cast("long").alias("taken"),
        F.when(
            taken > 0, due_time(place / F.col("a.target"), F.col("a.slope"))
        ).alias("position"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` range-sorted by position, those without one last; ties by id.

    Partitions follow each other, so a writer's files are in the order of training.
    """
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def curriculum(docs: DataFrame, schedule: Schedule | None = None) -> DataFrame:
    """``docs`` in the order of training, with as many copies as the mix takes.

    A document of which the mix takes the k-th copy by half or more appears k times, whole;
    one without words, or of which less is taken, does not appear.  All columns of
    ``docs``; rows are sorted by position within and across partitions.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "curriculum")
    mixed = mix(docs, schedule)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    plan = mixed.where("size > 0 and taken > 0").select(
        "doc_id", "source_size", "target", "position", copies.alias("copies")
    ).where("copies > 0")
    plan = scratch.keep(plan.groupBy("doc_id").agg(
        F.max("copies").alias("copies"), F.min("position").alias("position"),
        F.first(F.col("source_size") / F.col("target")).alias("stride"),
    ))
    names = dict(zip([*plan.columns, "turn", "at"], unused(docs, *plan.columns, "turn", "at")))
    named = plan.select(*[F.col(c).alias(names[c]) for c in plan.columns])
    turns = F.explode(F.sequence(F.lit(0), F.col(names["copies"]) - 1))
    due = docs.join(named, F.col("doc_id").cast("long").eqNullSafe(F.col(names["doc_id"])))
    due = due.select(*docs.columns, names["position"], names["stride"], turns.alias(names["turn"]))
    at = F.col(names["position"]) + F.col(names["turn"]) * F.col(names["stride"])
    due = due.withColumn(names["at"], at)
    order = [names["at"], "doc_id"]
    return due.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
