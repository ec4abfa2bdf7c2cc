"""Repeated runs of lines, by a suffix array over line ids.

Only lines that occur twice can lie in a repeated run; all others end it.  Prefix doubling
ranks the suffixes of the texts' line sequences: in each round a suffix's rank and the rank
of the suffix that many lines further on give its next rank, until no two suffixes agree in
full.  How many lines suffixes next to each other in rank order share, the ranks of all
rounds tell, from the longest to the shortest.

The suffix array falls into intervals within which all neighbours share a line, and smaller
ones within which they share two.  An interval is a repeated line or run of lines, and its
members are the copies: the first one by document and line stays, later ones are deleted.
Every longer repeated run is made of overlapping runs of two lines with the same property,
so deleting by these intervals deletes the maximal runs.  A run of one line has to have
``WORDS`` words; a shorter line goes only as part of a run of two lines or more.

Ranks are numbers that rise with the sort order, taken from a range-partitioned sort, and
intervals are walked in a range-partitioned pass whose partitions meet at their ends only,
so no step sorts, counts or gathers a group in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch, unused

WORDS = 5  # of a run of one line
_PLACE = ["doc", "text_key", "line"]
_NO_ID = -(1 << 63)  # stands for a null id, and comes first


def _ranked(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``frame``, one row per key, with numbers that rise with the keys, from 1."""
    ordered = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.withColumn(name, F.monotonically_increasing_id() + 1)


def _text_key() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))


def _has_words(line: Column, words: int) -> Column:
    """Whether a line has that many words; reads no further than to the last of them."""
    if words < 1:
        return F.lit(True)
    word, gap = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
    return F.rlike(line, F.lit(rf"\A{gap}*+(?:{word}++{gap}++){{{words - 1}}}{word}"))


def _elements(docs: DataFrame, words: int) -> DataFrame:
    """``doc, text_key, line, key, alone``: every line of every text.

    ``alone``: it has words enough to be a run by itself.
    """
    lines = F.transform(
        F.split(F.col("text").cast("string"), "\n"),
        lambda x: F.struct(
            F.unhex(F.md5(x)).alias("key"),
            _has_words(x, words).alias("alone"),
        ),
    )
    rows = docs.where(F.col("text").isNotNull()).select(
        _doc().alias("doc"), _text_key().alias("text_key"), F.posexplode(lines).alias("line", "e")
    )
    return rows.select(*_PLACE, "e.key", "e.alone")


def _suffix_ranks(elements: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Ranks ``r`` of all places in each round; the last round's order is the suffix array.

    Round k compares 2 ** k lines.  Rank 0 stands for the end of the sequence.  The first
    round also has ``alone``.
    """
    keys = elements.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    keys = scratch.keep(_ranked(keys, ["key"], "r"))
    current = scratch.keep(elements.join(keys, "key").select(*_PLACE, "r", "alone"))
    rounds, step = [current], 1
    while True:
        ahead = current.select("doc", "text_key", (F.col("line") - step).alias("line"), F.col("r").alias("r2"))
        both = scratch.keep(
            current.join(ahead, _PLACE, "left").select(*_PLACE, "r", F.coalesce("r2", F.lit(0)).alias("r2"))
        )
        classes = both.groupBy("r", "r2").agg(F.count("*").alias("n"))
        classes = scratch.keep(_ranked(classes, ["r", "r2"], "next"))
        if classes.where("n > 1 and r2 > 0").isEmpty():
            scratch.drop(both, classes)
            return rounds
        following = both.join(classes, ["r", "r2"]).select(*_PLACE, F.col("next").alias("r"))
        current = scratch.keep(following)
        scratch.drop(both, classes)
        rounds.append(current)
        step *= 2


_NEXT = "doc long, text_key long, line int, doc_b long, text_key_b long, line_b int, pos long, edge int"


def _neighbours(batches):
    """Each place with the next one in order; the ends of the partition are marked.

    ``pos`` rises with the order of the next place.  ``edge`` is twice the number of the
    partition, plus 1 for its last place.
    """
    names = ["doc", "text_key", "line"]
    part, last = TaskContext.get().partitionId(), None
    pos = part << 33

    def row(values: dict, edge: int):
        empty = {f"{c}_b": [None] for c in names}
        arrays = {c: [values[c]] for c in names} | empty | {"pos": [part << 33], "edge": [edge]}
        return pa.RecordBatch.from_pydict(arrays, schema=_NEXT_ARROW)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).select(names)
        if last is None:
            yield row(table.slice(0, 1).to_pylist()[0], 2 * part)
        else:
            table = pa.concat_tables([last, table])
        n = len(table) - 1
        left, right = table.slice(0, n), table.slice(1, n)
        if n:
            columns = [c.combine_chunks() for c in (*left.columns, *right.columns)]
            columns += [pa.array(np.arange(pos + 1, pos + 1 + n)), pa.nulls(n, pa.int32())]
            yield from pa.Table.from_arrays(columns, schema=_NEXT_ARROW).to_batches()
        pos += n
        last = table.slice(n, 1)
    if last is not None:
        yield row(last.to_pylist()[0], 2 * part + 1)


_NEXT_ARROW = pa.schema(
    [("doc", pa.int64()), ("text_key", pa.int64()), ("line", pa.int32()), ("doc_b", pa.int64()),
     ("text_key_b", pa.int64()), ("line_b", pa.int32()), ("pos", pa.int64()), ("edge", pa.int32())]
)


def _adjacent(ranks: DataFrame, scratch: Scratch) -> DataFrame:
    """Each place of the suffix array (``_b``) with the one before; null before the first."""
    order = ["r", *_PLACE]
    ordered = ranks.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.keep(ordered.mapInArrow(_neighbours, _NEXT))
    # Two rows per partition: the last place of one and the first of the next.
    edges = found.where("edge is not null").orderBy("edge").collect()
    ends = [(None, None, None)] + [(e["doc"], e["text_key"], e["line"]) for e in edges[1::2]]
    across = [
        (*a, b["doc"], b["text_key"], b["line"], b["pos"]) for a, b in zip(ends, edges[::2])
    ]
    inner = found.where("edge is null").drop("edge")
    return inner.union(ranks.sparkSession.createDataFrame(across, inner.schema))


def _common_prefixes(rounds: list[DataFrame], scratch: Scratch) -> DataFrame:
    """The pairs of ``_adjacent`` with ``common``, the lines that they share."""
    pairs = scratch.keep(_adjacent(rounds[-1], scratch).withColumn("common", F.lit(0)))
    for k in range(len(rounds) - 1, -1, -1):
        ranks = rounds[k]
        a = ranks.select(
            "doc", "text_key", F.col("line").alias("at"), F.col("r").alias("ra")
        )
        b = ranks.select(
            F.col("doc").alias("doc_b"), F.col("text_key").alias("text_key_b"),
            F.col("line").alias("at_b"), F.col("r").alias("rb"),
        )
        moved = pairs.withColumn("at", F.col("line") + F.col("common")).withColumn(
            "at_b", F.col("line_b") + F.col("common")
        )
        moved = moved.join(a, ["doc", "text_key", "at"], "left").join(
            b, ["doc_b", "text_key_b", "at_b"], "left"
        )
        grown = F.when(F.col("ra") == F.col("rb"), F.col("common") + (1 << k)).otherwise(F.col("common"))
        following = scratch.keep(
            moved.select(*_PLACE, *[f"{c}_b" for c in _PLACE], "pos", grown.cast("int").alias("common"))
        )
        scratch.drop(pairs)
        pairs = following
    return pairs


_LEVELS = (1, 2)  # lines that the suffixes of an interval share
_MEMBER_ARROW = pa.schema(
    [("doc", pa.int64()), ("text_key", pa.int64()), ("line", pa.int32()), ("longest", pa.int32()),
     ("later1", pa.bool_()), ("end1", pa.int32()), ("later2", pa.bool_()), ("end2", pa.int32()),
     ("level", pa.int32()), ("whole", pa.bool_())]
)
_MEMBER = (
    "doc long, text_key long, line int, longest int, later1 boolean, end1 int, later2 boolean, "
    "end2 int, level int, whole boolean"
)


def _members(batches):
    """Which places of a partition of the suffix array have an earlier one in their interval.

    An interval that begins or ends with the partition may go on in others: its places have
    its number as ``end`` (twice the partition's, plus 1 at its end), and a row with a
    ``level`` tells its first place so far, and whether it fills the ``whole`` partition.
    """
    part = TaskContext.get().partitionId()
    if not (held := list(batches)):
        return
    table = pa.Table.from_batches(held).cast(_LCP_ARROW)
    if not len(table):
        return
    doc, key, line, longest, common = (c.to_numpy() for c in table.columns)
    n = len(doc)
    order = np.lexsort((line, key, doc))
    turn = np.empty(n, dtype=np.int64)
    turn[order] = np.arange(n)
    columns, ends = [pa.array(c) for c in (doc, key, line, longest)], []
    for level in _LEVELS:
        opens = common < level
        starts = np.flatnonzero(np.append(True, opens[1:]))
        least = np.minimum.reduceat(turn, starts)
        lengths = np.diff(np.append(starts, n))
        later = turn != np.repeat(least, lengths)
        end = np.full(len(starts), -1)
        if not opens[0]:
            end[0] = 2 * part
        whole = end[-1] >= 0
        if not whole:
            end[-1] = 2 * part + 1
        for k in np.flatnonzero(end >= 0).tolist():
            at = order[least[k]]
            ends.append((int(doc[at]), int(key[at]), int(line[at]), int(end[k]), level, bool(whole)))
        end = np.repeat(end, lengths)
        columns += [pa.array(later), pa.array(end.astype(np.int32), mask=end < 0)]
    columns += [pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())]
    yield from pa.Table.from_arrays(columns, schema=_MEMBER_ARROW).to_batches(max_chunksize=20_000)
    for d, k, i, end, level, whole in ends:
        values = {"doc": d, "text_key": k, "line": i, f"end{level}": end, "level": level, "whole": whole}
        yield pa.RecordBatch.from_pylist([values], schema=_MEMBER_ARROW)


_LCP_ARROW = pa.schema(
    [("doc", pa.int64()), ("text_key", pa.int64()), ("line", pa.int32()),
     ("longest", pa.int32()), ("common", pa.int32())]
)


def _first_places(ends: list) -> list[tuple]:
    """``end, doc, text_key, line`` of the first place of every interval that crosses partitions.

    ``ends`` are the marks of one level; there are at most two per partition.
    """
    out, group = [], []

    def close():
        if group:
            first = min((e["doc"], e["text_key"], e["line"]) for e in group)
            out.extend((e["end"], *first) for e in group)
            group.clear()

    for e in sorted(ends, key=lambda e: e["end"]):
        # An odd mark opens an interval; an even one goes on with it, and ends it unless it
        # fills its partition.
        if e["end"] % 2:
            close()
        group.append(e)
        if e["end"] % 2 == 0 and not e["whole"]:
            close()
    close()
    return out


def _later_places(pairs: DataFrame, reach: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc, text_key, line, longest, later1, later2`` for all places of the suffix array.

    ``later``: an earlier place is in the same interval of one, or two, common lines.
    ``longest``: lines of the longest prefix that the place shares with a neighbour.
    """
    own = pairs.select(*[F.col(f"{c}_b").alias(c) for c in _PLACE], "pos", "common")
    ahead = pairs.select(*_PLACE, F.col("common").alias("ahead"))
    # Ranks of long prefixes agree too where both sequences end.
    own = own.join(reach, _PLACE).join(ahead, _PLACE, "left").select(
        *_PLACE, "pos", F.least("common", "reach").alias("common"),
        F.least(F.greatest("common", "ahead"), "reach").cast("int").alias("longest"),
    )
    ordered = own.repartitionByRange("pos").sortWithinPartitions("pos").select(*_PLACE, "longest", "common")
    found = scratch.keep(ordered.mapInArrow(_members, _MEMBER))
    marks = found.where("level is not null").collect()  # at most four rows per partition
    places = found.where("level is null")
    for level in _LEVELS:
        ends = [m.asDict() | {"end": m[f"end{level}"]} for m in marks if m["level"] == level]
        schema = f"end{level} int, first_doc long, first_key long, first_line int"
        first = pairs.sparkSession.createDataFrame(_first_places(ends), schema)
        is_later = F.struct(*_PLACE) != F.struct("first_doc", "first_key", "first_line")
        places = places.join(F.broadcast(first), f"end{level}", "left").withColumn(
            f"later{level}", F.when(F.col("first_line").isNull(), F.col(f"later{level}")).otherwise(is_later)
        ).drop("first_doc", "first_key", "first_line", f"end{level}")
    return places.select(*_PLACE, "longest", "later1", "later2")


def repeated_runs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, text_key, first_line, last_line, longest``: the runs to delete.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not looked at.  Lines end at
    line feeds and count from 0; ``last_line`` is inclusive.  A run consists of lines that
    lie in a repeated run of two or more lines, or are repeated lines of ``words`` or more
    words, of which an earlier copy stands in a document with a smaller id (null first), or
    earlier in the same text.  Copies may overlap.  ``longest`` is the greatest number of
    lines that a place of the run shares with a neighbour in the suffix array.
    ``text_key`` tells texts of the same id apart; rows that repeat id and text count once.
    Null texts have no lines; an empty text is one line without words.
    """
    scratch = Scratch(docs.sparkSession, "line_runs")
    elements = _elements(docs, words)
    twice = docs.groupBy("doc_id", _text_key()).count().where("count > 1")
    if not twice.isEmpty():
        elements = elements.dropDuplicates([*_PLACE])
    elements = scratch.keep(elements)
    rounds = _suffix_ranks(elements, scratch)
    scratch.drop(elements)
    pairs = _common_prefixes(rounds, scratch)
    scratch.drop(*rounds[1:])
    ends = Window.partitionBy("doc", "text_key").orderBy("line")
    islands = rounds[0].withColumn("island", F.col("line") - F.row_number().over(ends))
    last = Window.partitionBy("doc", "text_key", "island")
    reach = islands.select(*_PLACE, "alone", (F.max("line").over(last) - F.col("line") + 1).alias("reach"))
    reach = scratch.keep(reach)
    places = _later_places(pairs, reach.drop("alone"), scratch).where("later1 or later2")
    going = places.join(reach.where("alone").select(*_PLACE, "alone"), _PLACE, "left")
    going = going.where("later2 or alone").select(
        *_PLACE, F.when(F.col("later2"), F.col("line") + 1).otherwise(F.col("line")).alias("to"), "longest"
    )
    # Runs that touch or overlap make one.
    before = F.max("to").over(ends.rowsBetween(Window.unboundedPreceding, -1))
    marked = going.withColumn("start", F.when(F.col("line") <= before + 1, 0).otherwise(1))
    marked = marked.withColumn("run", F.sum("start").over(ends))
    return marked.groupBy("doc", "text_key", "run").agg(
        F.min("line").alias("first_line"),
        F.max("to").alias("last_line"),
        F.max("longest").alias("longest"),
    ).select(
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"),
        "text_key", "first_line", "last_line", "longest",
    )


def without_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``docs`` with the runs' lines taken out of ``text``; all columns.

    Added are ``n_deleted``, ``n_runs`` and ``longest_run``, the greatest ``longest`` of
    its runs (0 without runs).  A text of which nothing is left becomes empty; a null stays
    null.
    """
    doc, key, taken = unused(docs, "doc", "key", "runs")
    gathered = runs.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("first_line", "last_line", "longest"))).alias(taken)
    )
    gathered = gathered.select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias(doc), F.col("text_key").alias(key), taken
    )
    joined = docs.join(gathered, (_doc() == F.col(doc)) & (_text_key() == F.col(key)), "left")
    lines, found = F.split(F.col("text").cast("string"), "\n"), F.col(taken)
    begins = F.concat(F.array(F.lit(0)), F.transform(found, lambda r: r["last_line"] + 1))
    stops = F.concat(F.transform(found, lambda r: r["first_line"]), F.array(F.size(lines)))
    between = F.zip_with(
        begins, stops, lambda a, b: F.slice(lines, a + 1, F.greatest(b - a, F.lit(0)))
    )
    text = F.array_join(F.flatten(between), "\n")
    deleted = F.aggregate(found, F.lit(0), lambda n, r: n + r["last_line"] - r["first_line"] + 1)
    longest = F.array_max(F.transform(found, lambda r: r["longest"]))
    kept = [
        F.when(found.isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(c)
        for c in docs.columns
    ]

    def number(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("long")

    return joined.select(
        *kept, number(deleted).alias("n_deleted"),
        number(F.when(found.isNotNull(), F.size(found))).alias("n_runs"), number(longest).alias("longest_run"),
    )
