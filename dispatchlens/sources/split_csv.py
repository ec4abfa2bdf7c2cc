"""CSV records that span lines, read by as many tasks as the file has splits.

A line break ends a record if the quotes before it in the file are even in number.  A first
pass counts the quotes of every split, and their running sum tells each split whether it
begins inside a quoted field.  A second pass joins the lines of a split to records; only the
pieces of records that cross a border of splits, two a split at most, meet in a shuffle.

Quotes may stand only around fields and, doubled, inside them.  A file with bare quotes in
unquoted fields needs the reader of whole files.  Lines end with a line feed, or with a
carriage return and a line feed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dispatchlens.plans.shared import materialise

# Splits whose states are sent to all tasks; beyond, they are joined by a shuffle of lines.
MOST_BROADCAST = 1_000_000
WHOLE, HEAD, MIDDLE, TAIL = "whole", "head", "middle", "tail"

_PLACE = ["file", "start"]
_PIECES = "file string, start long, kind string, first boolean, text string"
_NAMES = [*_PLACE, "kind", "first", "text"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split that holds lines: whether it begins inside a quoted field.

    The window orders the splits of one file, a row for every 128 MB or so.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy(*_PLACE).agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counted.select(*_PLACE, inside.alias("inside"))


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole records, and the pieces at the ends of a split; empty lines between records are left out.

    ``first`` marks the first record of a file.  Memory holds a batch and the record that is
    open at its end.
    """
    place, held, kind, inside, first = None, [], WHOLE, False, False
    for batch in batches:
        found = []
        for file, start, value, began in zip(batch["file"], batch["start"], batch["value"], batch["inside"]):
            if (file, start) != place:
                if held:
                    found.append((*place, {WHOLE: TAIL, HEAD: MIDDLE}[kind], first, "\n".join(held)))
                place, held, inside = (file, start), [], bool(began)
                kind, first = HEAD if inside else WHOLE, start == 0
            held.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                text = "\n".join(held)
                if kind == HEAD or text not in ("", "\r"):
                    found.append((*place, kind, first, text))
                    first = False
                held, kind = [], WHOLE
        yield pd.DataFrame(found, columns=_NAMES)
    if held:
        last = (*place, {WHOLE: TAIL, HEAD: MIDDLE}[kind], first, "\n".join(held))
        yield pd.DataFrame([last], columns=_NAMES)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from the pieces at the borders: a tail, middles and a head, in file order."""
    # Within a split the head of one record comes before the tail of the next.
    in_file = Window.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    begins = (F.col("kind") == TAIL).cast("long")
    numbered = pieces.withColumn("record", F.sum(begins).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    return numbered.groupBy("file", "record").agg(
        F.bool_or("first").alias("first"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, text`` of every record; ``first`` is the file's header.

    A quoted field that the file never closes goes on to the file's end.  Empty lines are
    left out.  The pieces are written to the shared folder, so both uses read them there.
    """
    lines = _lines(spark, path)
    splits = materialise(_splits(lines), "csv-splits")
    if splits.count() <= MOST_BROADCAST:
        placed = lines.join(F.broadcast(splits), _PLACE)
    else:  # lines move, and are put back in order
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        moved = numbered.join(splits, _PLACE).repartition(*_PLACE)
        placed = moved.sortWithinPartitions(*_PLACE, "line")
    found = placed.select(*_PLACE, "value", "inside").mapInPandas(_pieces, _PIECES)
    pieces = materialise(found, "csv-pieces")
    whole = pieces.filter(F.col("kind") == WHOLE).select("file", "first", "text")
    crossing = _joined(pieces.filter(F.col("kind") != WHOLE)).select("file", "first", "text")
    return whole.unionByName(crossing).withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def read_text(spark: SparkSession, path: str, header: list[str], options: dict) -> DataFrame:
    """All columns as text; every file of ``path`` must begin with ``header``.

    ``options`` tell the quote and its escape.  A record with too few or too many fields, or
    a file with another header, fails the job.
    """
    schema = ", ".join(f"`{name}` string" for name in header)
    parsing = {**options, "mode": "FAILFAST", "multiLine": "true"}
    bare = F.when(F.col("first"), F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text"))
    parsed = records(spark, path).select("file", "first", F.from_csv(bare, schema, parsing).alias("r"))
    fields = F.array(*[F.col(f"r.`{name}`") for name in header])
    wrong = F.raise_error(F.concat("file", F.lit(": header does not conform"))).cast("boolean")
    as_expected = fields == F.array(*[F.lit(name) for name in header])
    kept = F.when(~F.col("first"), True).when(as_expected, False).otherwise(wrong)
    return parsed.filter(kept).select(*[F.col(f"r.`{name}`").alias(name) for name in header])
