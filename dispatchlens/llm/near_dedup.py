"""Near-duplicate documents by SetSketch registers, banded, estimated and verified.

1. Each text becomes its set of distinct word shingles, a 128-bit fingerprint of the
   set and its registers.  Equal sets are one class from here on.
2. Bands of registers are hashed; classes that share a band are candidates.  Their
   registers are compared, block by block, and the similarity estimated by likelihood.
   Classes that are likely near the threshold form a cluster; a block hands on only
   edges that connect it, so a large group of near copies costs rows in proportion.
3. Within a cluster the full sets are counted, pair by pair, but for pairs that are
   connected already.
   Blocks of a large band or cluster are dealt anew and at last, where parts are still
   apart, compared with each other.  No link is left out.
4. Verified links become connected components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import setsketch, words
from .graph import components
from .scratch import Scratch, batches_of


@dataclass(frozen=True)
class Settings:
    """``percent``: documents link when 100 * intersection >= percent * union.

    ``rows`` registers make a band; a pair at the threshold of 0.8 misses all bands
    with probability (1 - 0.8**rows) ** (registers / rows), below 1e-5.  ``slack`` is
    how far under the threshold an estimate may be before the pair is dropped, four
    standard deviations.  ``block``: members that are compared in one go.
    """

    width: int = 5
    percent: int = 80
    rows: int = 5
    slack: float = 0.13
    block: int = 512


def _sketched(width: int, full: bool):
    """Rows of key, size and either the registers or the whole set."""
    value = "elements" if full else "registers"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), (value, pa.binary())]
    )

    def run(batches):
        add, flush = batches_of(schema, 500)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, data, offsets in words.chunks(batch.column(1)):
                found = words.word_hashes(data, offsets)
                bounds = found.bounds(high - low)
                for k in range(high - low):
                    elements = np.unique(
                        words.shingles(found.hash[bounds[k] : bounds[k + 1]], width)
                    )
                    row = (ids[low + k], None, 0, None)
                    if len(elements):
                        raw = elements.tobytes()
                        shown = raw if full else setsketch.sketch(elements).tobytes()
                        row = (ids[low + k], xxhash.xxh3_128_digest(raw), len(elements), shown)
                    if (out := add(row)) is not None:
                        yield out
        yield flush()

    return run, f"doc_id long, key binary, n long, {value} binary"


def sets_of(docs: DataFrame, width: int, full: bool = False) -> DataFrame:
    run, schema = _sketched(width, full)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, schema
    )


class _Forest:
    """Which members of a block are connected, and the edges that did it."""

    def __init__(self, labels: np.ndarray):
        """``labels``: equal where two members are known to be connected."""
        self.label = np.unique(labels, return_inverse=True)[1]
        self.edges: list[tuple[int, int]] = []

    def connect(self, a: int, b: int) -> None:
        one, other = self.label[a], self.label[b]
        if one != other:
            self.label[self.label == other] = one
            self.edges.append((a, b))


def _likely_pairs(rows: dict[str, np.ndarray], settings: Settings, forest: _Forest):
    """Pairs of rows whose likely similarity is near the threshold, some at a time.

    Pairs that are connected, of sizes too far apart, or, where two blocks meet, of the
    same block are passed over.
    """
    floor = settings.percent / 100 - settings.slack
    at_once = 1 << 14
    n, block, registers = rows["n"], rows["block"], rows["registers"]
    across = rows["i"][0] != rows["j"][0]
    low = 0
    while low < len(n) - 1:
        high = min(len(n) - 1, low + max(1, at_once // len(n)))
        left, right = (x.reshape(-1) for x in np.meshgrid(np.arange(low, high), np.arange(low + 1, len(n)), indexing="ij"))
        open_ = (left < right) & (forest.label[left] != forest.label[right])
        open_ &= 100 * np.minimum(n[left], n[right]) >= settings.percent * np.maximum(n[left], n[right])
        if across:
            open_ &= block[left] != block[right]
        left, right = left[open_], right[open_]
        # Registers agree at least as often as elements do.
        equal = (registers[left] == registers[right]).sum(axis=1)
        maybe = equal >= (floor - 0.1) * setsketch.REGISTERS
        left, right = left[maybe], right[maybe]
        if len(left):
            likely = setsketch.likely_similarity(
                registers[left], registers[right], n[left].astype(float), n[right].astype(float)
            )
            good = likely >= floor
            # The most likely first: they connect most.
            order = np.argsort(-likely[good], kind="stable")
            yield left[good][order], right[good][order]
        low = high


def _cluster(rows: dict[str, np.ndarray], settings: Settings) -> _Forest:
    """Connects members that are likely near the threshold."""
    forest = _Forest(np.arange(len(rows["n"])))
    for left, right in _likely_pairs(rows, settings, forest):
        for a, b in zip(left.tolist(), right.tolist()):
            forest.connect(a, b)
    return forest


def _verify(rows: dict[str, np.ndarray], settings: Settings) -> _Forest:
    """Connects members whose full sets are similar enough."""
    forest = _Forest(rows["root"])
    sets = [np.frombuffer(raw, dtype=np.uint64) for raw in rows["elements"]]
    for left, right in _likely_pairs(rows, settings, forest):
        for a, b in zip(left.tolist(), right.tolist()):
            if forest.label[a] != forest.label[b] and similar(sets[a], sets[b], settings.percent):
                forest.connect(a, b)
    return forest


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


_SMALL = 32  # groups up to this size are compared many at a time


def _small_groups(columns: dict, starts: np.ndarray, stops: np.ndarray, settings: Settings):
    """Edges that connect the members of all small groups; members are rows.

    Without full sets an edge needs a likely pair; a pair that meets in several groups is
    looked at once.  With full sets the pair is counted.
    """
    small = (stops - starts > 1) & (stops - starts <= _SMALL)
    starts, stops = starts[small], stops[small]
    if not len(starts):
        return
    rows = np.concatenate([np.arange(a, b) for a, b in zip(starts.tolist(), stops.tolist())])
    after = np.repeat(stops, stops - starts) - rows - 1
    left = np.repeat(rows, after)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    n, root, block, registers = (columns[c] for c in ("n", "root", "block", "registers"))
    open_ = (root[left] != root[right]) & (
        (columns["i"][left] == columns["j"][left]) | (block[left] != block[right])
    )
    open_ &= 100 * np.minimum(n[left], n[right]) >= settings.percent * np.maximum(n[left], n[right])
    left, right = left[open_], right[open_]
    sets = columns.get("elements")
    if sets is None and len(left):
        pair = np.stack([np.minimum(root[left], root[right]), np.maximum(root[left], root[right])], axis=1)
        once = np.unique(pair.view([("a", np.int64), ("b", np.int64)]).reshape(-1), return_index=True)[1]
        left, right = left[once], right[once]
    floor = settings.percent / 100 - settings.slack
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for low in range(0, len(left), 1 << 14):
        a, b = left[low : low + (1 << 14)], right[low : low + (1 << 14)]
        maybe = (registers[a] == registers[b]).sum(axis=1) >= (floor - 0.1) * setsketch.REGISTERS
        a, b = a[maybe], b[maybe]
        if not len(a):
            continue
        likely = setsketch.likely_similarity(
            registers[a], registers[b], n[a].astype(float), n[b].astype(float)
        )
        good = likely >= floor
        for x, y in zip(a[good].tolist(), b[good].tolist()):
            one, other = find(int(root[x])), find(int(root[y]))
            if one == other:
                continue
            if sets is not None:
                raw = (np.frombuffer(sets[k], dtype=np.uint64) for k in (x, y))
                if not similar(*raw, settings.percent):
                    continue
            parent[other] = one
            yield x, y


def _by_group(compare, settings: Settings):
    """Runs ``compare`` on every (group, i, j) of sorted rows; gives the edges found."""
    names = ["group", "i", "j"]

    def edges(table: pa.Table):
        table = table.combine_chunks()
        columns = {c: table.column(c).to_numpy() for c in ("group", "i", "j", "block", "n", "root")}
        columns["registers"] = np.frombuffer(
            b"".join(table.column("registers").to_pylist()), dtype=np.uint16
        ).reshape(-1, setsketch.REGISTERS)
        if "elements" in table.column_names:
            columns["elements"] = np.array([*table.column("elements").to_pylist(), None], dtype=object)[:-1]
        keys = table.column("key").to_pylist()
        new = np.any([columns[c][1:] != columns[c][:-1] for c in names], axis=0)
        starts = np.flatnonzero(np.append(True, new)).tolist()
        stops = [*starts[1:], len(keys)]
        found = {
            (min(keys[x], keys[y]), max(keys[x], keys[y]))
            for x, y in _small_groups(columns, np.array(starts), np.array(stops), settings)
        }
        for a, b in zip(starts, stops):
            if b - a > _SMALL:
                forest = compare({c: v[a:b] for c, v in columns.items()}, settings)
                for x, y in forest.edges:
                    x, y = keys[a + x], keys[a + y]
                    found.add((min(x, y), max(x, y)))
        ordered = sorted(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in ordered], type=pa.binary()) for k in (0, 1)], names=["a", "b"]
        )

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            ends = [held.column(c).to_numpy() for c in names]
            complete = int(np.argmax(np.all([c == c[-1] for c in ends], axis=0))) if len(held) else 0
            if complete:
                yield edges(held.slice(0, complete))
                held = held.slice(complete)
        if held is not None and len(held):
            yield edges(held)

    return run


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, key, n_shingles, component_id, kept``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not looked at.  A text that
    is null, empty or without words has an empty set, links with nothing and stays.
    ``component_id`` is the smallest doc_id of the component; ``kept`` tells whether it
    is the row's own.  Rows that repeat an id are judged by their texts, and both are
    ``kept`` if the id is the smallest.  A row without id belongs to the component of
    its text and is kept only where no member has an id.
    """
    settings = settings or Settings()
    scratch = Scratch(docs.sparkSession, "near_dedup")
    rows = scratch.keep(sets_of(docs, settings.width))
    classes = scratch.keep(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("registers").alias("registers"),
        )
    )
    slim = scratch.keep(rows.select("doc_id", "key", "n"))
    scratch.drop(rows)
    roots = _roots(docs, classes, settings, scratch)
    labelled = classes.select("key", "doc_id").join(
        roots.withColumnRenamed("node", "key"), "key", "left"
    )
    labelled = labelled.select("key", "doc_id", F.coalesce("root", "key").alias("root"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = scratch.keep(labelled.join(least, "root").select("key", "component_id"))
    scratch.drop(classes, roots)
    out = slim.select("doc_id", "key", F.col("n").alias("n_shingles")).join(named, "key", "left")
    return out.select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _roots(docs: DataFrame, classes: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """``node, root`` of the class keys that verified links connect."""
    width = 2 * settings.rows
    bands = setsketch.REGISTERS // settings.rows
    band = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))),
    )
    members = classes.select("key", "n", F.explode(band).alias("band"))
    crowded = members.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    shared = scratch.keep(members.join(crowded.select("band"), "band"))
    groups = shared.select(F.col("band").alias("group"), "key", "n")
    clusters = _linked(groups, classes, _cluster, settings, scratch)
    scratch.drop(shared)
    if clusters is None:
        return classes.select(F.col("key").alias("node"), F.col("key").alias("root")).limit(0)
    named = clusters.select(F.col("node").alias("key"), "root").union(
        clusters.select(F.col("root").alias("key"), "root").distinct()
    )
    named = scratch.keep(
        named.join(classes.select("key", "n", "doc_id"), "key").select(
            "key", "n", "doc_id", F.xxhash64("root").alias("group")
        )
    )
    elements = scratch.keep(_elements(docs, named, settings))
    full = classes.select("key", "registers").join(elements, "key")
    roots = _linked(named, full, _verify, settings, scratch)
    scratch.drop(named, elements)
    if roots is None:
        return clusters.limit(0)
    scratch.drop(clusters)
    return roots


def _linked(named: DataFrame, values: DataFrame, compare, settings: Settings, scratch: Scratch) -> DataFrame | None:
    """``node, root`` of the members of ``named`` (group, key, n) that links connect, if any.

    Groups are compared in blocks, large ones dealt in two ways at once; only groups of
    several blocks that still hold several components have all their blocks compared.
    """
    roots = None
    for across in (False, True):
        members = named.withColumn("root", F.xxhash64("key")) if roots is None else _open(named, roots, settings)
        members = scratch.keep(members.select("group", "key", "n", "root"))
        if members.isEmpty():
            scratch.drop(members)
            break
        found = _compared(_blocks(members, settings, across), values, compare, settings)
        if roots is not None:
            found = found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        linked = components(found, scratch)
        scratch.drop(members, *([] if roots is None else [roots]))
        roots = linked
    return roots


def _elements(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The full sets of the classes that are in a cluster."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(
        wanted.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi"
    )
    if not wanted.where("doc_id is null").isEmpty():
        texts = texts.union(docs.where("doc_id is null").select(F.col("doc_id").cast("long"), "text"))
    return (
        sets_of(texts, settings.width, full=True)
        .join(wanted.select("key"), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("elements").alias("elements"))
    )


def _open(named: DataFrame, roots: DataFrame, settings: Settings) -> DataFrame:
    """Members, with components, of clusters of several blocks that hold several components."""
    known = roots.select(F.col("node").alias("key"), F.col("root").alias("r"))
    rows = named.join(known, "key", "left").select(
        "group", "key", "n", F.xxhash64(F.coalesce("r", "key")).alias("root")
    )
    split = rows.groupBy("group").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("c")
    )
    return rows.join(split.where((F.col("x") != F.col("y")) & (F.col("c") > settings.block)).select("group"), "group")


def _blocks(members: DataFrame, settings: Settings, across: bool) -> DataFrame:
    """Members dealt into blocks of their group; ``across``: every two blocks meet.

    Else a group of several blocks is dealt a second time, in another way.
    """
    counts = members.groupBy("group").agg(F.ceil(F.count("*") / settings.block).alias("blocks"))
    dealt = members.join(counts, "group")
    if not across:
        deals = F.when(F.col("blocks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        dealt = dealt.withColumn("deal", F.explode(deals))
        block = F.pmod(F.xxhash64("key", "deal"), F.col("blocks")) + F.col("deal") * F.col("blocks")
        dealt = dealt.withColumn("block", block)
        return dealt.withColumn("i", F.col("block")).withColumn("j", F.col("block")).drop("blocks", "deal")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.withColumn("k", every)
    return dealt.select(
        "group", "key", "n", "root", "block",
        F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
    )


def _compared(blocks: DataFrame, values: DataFrame, compare, settings: Settings) -> DataFrame:
    columns = [c for c in ("registers", "elements") if c in values.columns]
    rows = blocks.join(values.select("key", *columns), "key").select(
        "group", "i", "j", "block", "n", "root", "key", *columns
    )
    grouped = rows.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return grouped.mapInArrow(_by_group(compare, settings), "a binary, b binary")


def dedup(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with one document of each group; all its columns.

    Of rows with the same id and text one stays.  Rows without id stay.
    """
    spark = docs.sparkSession
    found = Scratch(spark, "near_dedup_kept").keep(
        near_duplicates(docs, settings).select("doc_id", "kept")
    )
    gone = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return left
    twice = left.join(repeated.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated.select("doc_id"), "doc_id", "left_anti").unionByName(twice).select(*docs.columns)
