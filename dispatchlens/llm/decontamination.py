"""Benchmark decontamination by latent semantic retrieval.

1. Words are hashed to terms; a written table holds every document's terms, so that the
   texts are read once.  Inverse document frequencies come from all passages.
2. A randomised SVD of the TF-IDF matrix of all passages: each task adds up its passages'
   share of the product with a random matrix, the sums meet by term, and the driver
   factors a matrix of ``TERMS`` by ``RANK``, whatever the size of the corpus.
3. Every overlapping window of every document is compared, in the latent space, with the
   benchmark's windows, which cover every item from its first word to its last.
   Candidates by cosine go on to the words themselves.
4. A candidate counts where the longest common subsequence of words covers enough of the
   item, or less of it but also its answer.

The benchmark goes to the tasks in blocks of at most ``ITEMS`` items, or of about
``VECTORS`` windows, a pass each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .scratch import Scratch, batches_of

TERM_BITS = 14
TERMS = 1 << TERM_BITS
RANK = 48
CELL = 6  # words; windows start with every cell
CELLS = 4
WINDOW = CELL * CELLS
STEP = CELL // 2  # words between an item's windows
ITEMS = 1000
VECTORS = 1 << 14
_TOKENS_AT_ONCE = 1 << 18
_COSINES_AT_ONCE = 1 << 22
_WINDOWS_AT_ONCE = 256  # their cosines stay in a core's cache


@dataclass(frozen=True)
class Settings:
    """``cosine``: candidates in the latent space, for items as long as a window; for
    shorter ones, which share a window with other words, less by the square root of their
    part of it.  ``shared``: least share of a window's
    possible words that the item has too.  ``whole``: share of the item's words that, in
    order, make a match; ``part``: the share that suffices if the answer is there as well,
    to the share ``answer``.  Items with fewer than ``least`` words are not looked for.
    ``common``: terms in a larger share of the passages than this weigh nothing.
    """

    cosine: float = 0.55
    shared: float = 0.4
    whole: float = 0.75
    part: float = 0.6
    answer: float = 0.75
    least: int = 8
    common: float = 0.1


def _terms(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for low, high, data, offsets in words.chunks(column):
        found = words.word_hashes(data, offsets, plain=True)
        terms = (found.hash >> np.uint64(64 - TERM_BITS)).astype(np.uint16)
        bounds = found.bounds(high - low)
        yield low, [terms[bounds[k] : bounds[k + 1]] for k in range(high - low)]


def _to_terms(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("terms", pa.binary())])
    add, flush = batches_of(schema, 1000)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for low, texts in _terms(batch.column(1)):
            for k, terms in enumerate(texts):
                if len(terms) and (out := add((ids[low + k], terms.tobytes()))) is not None:
                    yield out
    yield flush()


def _blocks(batches, ids: bool = False):
    """Term arrays of several documents at a time: all terms, and where each begins."""
    held, names, size = [], [], 0
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        named = batch.column(0).to_pylist() if ids else [None] * batch.num_rows
        for name, raw in zip(named, column):
            terms = np.frombuffer(raw.as_py(), dtype=np.uint16)
            held.append(terms)
            names.append(name)
            size += len(terms)
            if size >= _TOKENS_AT_ONCE:
                yield held, names
                held, names, size = [], [], 0
    if held:
        yield held, names


def _pieces(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the pieces of ``width`` words that divide texts, and pieces per text."""
    counts = -(-lengths // width)
    first = np.repeat(np.cumsum(lengths) - lengths, counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + number * width, counts


def _grid(held: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' pieces of ``width`` terms as rows, and pieces per text.

    The last piece of a text is filled up with the term ``TERMS``, which weighs nothing.
    """
    lengths = np.array([len(t) for t in held])
    counts = -(-lengths // width)
    grid = np.full(int(counts.sum()) * width, TERMS, dtype=np.int32)
    starts = (np.cumsum(counts) - counts) * width
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    grid[np.arange(len(shift)) + shift] = np.concatenate(held)
    return grid.reshape(-1, width), counts


def _row_sums(values: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """The sum of the terms' rows of ``values`` for every row of ``grid``."""
    total = values[grid[:, 0]]
    for k in range(1, grid.shape[1]):
        total += values[grid[:, k]]
    return total


def _with_filler(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values, np.zeros((1, *values.shape[1:]), dtype=values.dtype)])


def _passage_counts(batches):
    """In how many passages each term occurs; the number of passages under term -1."""
    totals, passages = np.zeros(TERMS, dtype=np.int64), 0
    for held, _ in _blocks(batches):
        grid, _ = _grid(held, WINDOW)
        grid.sort(axis=1)
        new = np.ones(grid.shape, dtype=bool)
        new[:, 1:] = grid[:, 1:] != grid[:, :-1]
        totals += np.bincount(grid[new], minlength=TERMS + 1)[:TERMS]
        passages += len(grid)
    at = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(at, -1).astype(np.int32)),
            pa.array(np.append(totals[at], passages)),
        ],
        names=["term", "n"],
    )


def _product(idf: np.ndarray, directions: np.ndarray):
    """Each task's share of A^T A times ``directions``, A being passages by terms."""
    scaled = _with_filler((idf[:, None] * directions).astype(np.float32))
    squares = _with_filler((idf**2).astype(np.float32))

    def run(batches):
        total = np.zeros((TERMS, directions.shape[1]))
        for held, _ in _blocks(batches):
            grid, _ = _grid(held, WINDOW)
            norm = np.maximum(_row_sums(squares, grid), np.float32(1e-6))
            passage = _row_sums(scaled, grid) / norm[:, None]
            heavy = squares[grid] > 0
            terms = grid[heavy]
            if not len(terms):
                continue
            owner = np.repeat(np.arange(len(grid)), heavy.sum(axis=1))
            by_direction = np.ascontiguousarray(passage.T.astype(np.float64))
            for k, values in enumerate(by_direction):
                total[:, k] += np.bincount(terms, weights=values[owner], minlength=TERMS)
        total *= idf[:, None]
        at = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(at.astype(np.int32))] + [pa.array(c) for c in total[at].T.copy()]
        names = ["term"] + [f"y{k}" for k in range(directions.shape[1])]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


@dataclass
class Latent:
    """Inverse document frequencies and the whitened projection of each term."""

    idf: np.ndarray
    projection: np.ndarray

    def project(self, terms: np.ndarray) -> np.ndarray:
        vector = self.projection[terms].sum(axis=0)
        return vector / max(float(np.linalg.norm(vector)), 1e-12)


def latent_space(terms: DataFrame, settings: Settings) -> Latent:
    """The leading singular directions of all passages of ``terms``."""
    counted = terms.mapInArrow(_passage_counts, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen = {r["term"]: r["n"] for r in counted.collect()}  # at most TERMS + 1 rows
    passages = seen.pop(-1, 0) or 0
    count = np.zeros(TERMS)
    count[list(seen)] = list(seen.values())
    idf = np.where(count > 0, np.log((1 + passages) / (1 + count)) + 1.0, 0.0)
    # With few passages every term is in a large share of them.
    idf[count > max(settings.common * passages, 50)] = 0.0
    directions = np.random.default_rng(7).standard_normal((TERMS, RANK))
    directions[idf == 0] = 0
    schema = "term int, " + ", ".join(f"y{k} double" for k in range(RANK))
    sums = terms.mapInArrow(_product(idf, directions), schema).groupBy("term")
    rows = sums.agg(*[F.sum(f"y{k}").alias(f"y{k}") for k in range(RANK)]).collect()
    product = np.zeros((TERMS, RANK))
    for row in rows:
        product[row["term"]] = row[1:]
    # Nystroem: A^T A is about Y (D^T Y)^-1 Y^T.
    inner = directions.T @ product
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > max(values.max(initial=0.0), 0.0) * 1e-10
    factor = product @ (vectors[:, good] / np.sqrt(values[good]))
    left, scale, _ = np.linalg.svd(factor, full_matrices=False)
    strong = scale > scale.max(initial=0.0) * 1e-6
    projection = idf[:, None] * left[:, strong] / np.maximum(scale[strong], 1e-12)
    return Latent(idf, projection.astype(np.float32))


class Item:
    """An item's words, and where each occurs in it, as bits."""

    def __init__(self, item_id: int | None, terms: np.ndarray, answer: np.ndarray):
        self.item_id, self.terms, self.answer = item_id, terms, answer
        self.places, self.answer_places = _places(terms), _places(answer)
        self.counts = {term: at.bit_count() for term, at in self.places.items()}

    def occurring(self, other: list[int]) -> int:
        """How many of the item's words ``other`` has too, in any order."""
        return sum(map(self.counts.__getitem__, self.counts.keys() & set(other)))


def _places(terms: np.ndarray) -> dict[int, int]:
    places: dict[int, int] = {}
    for k, term in enumerate(terms.tolist()):
        places[term] = places.get(term, 0) | (1 << k)
    return places


def common_subsequence(places: dict[int, int], size: int, other: list[int]) -> int:
    """Length of the longest common subsequence, a word of ``other`` at a time.

    ``places`` has the positions of each term in a sequence of ``size`` terms as bits.
    """
    full = (1 << size) - 1
    row = full
    for term in other:
        match = row & places.get(term, 0)
        row = ((row + match) | (row - match)) & full
    return size - row.bit_count()


def window_starts(size: int) -> list[int]:
    """First words of the windows of an item: every few words, and the last one."""
    last = max(0, size - WINDOW)
    return sorted({*range(0, last, STEP), last})


def near_pairs(window: np.ndarray, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of ``window``, columns of ``queries`` and cosines where these reach ``least``.

    The number of columns divides by eight, so that eight comparisons are looked at in one.
    """
    width = len(least)
    at, values = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.float32)]
    for low in range(0, len(window), _WINDOWS_AT_ONCE):
        near = (window[low : low + _WINDOWS_AT_ONCE] @ queries).reshape(-1, width)
        reached = (near >= least).reshape(-1)
        some = np.flatnonzero(reached.view(np.uint64))
        if len(some):
            flat = (some[:, None] * 8 + np.arange(8)).reshape(-1)
            flat = flat[reached[flat]]
            at.append(flat + low * width)
            values.append(near.reshape(-1)[flat])
    flat = np.concatenate(at)
    return flat // width, flat % width, np.concatenate(values)


def _search(latent: Latent, items: list[Item], settings: Settings):
    vectors, owners = [], []
    for k, item in enumerate(items):
        for first in window_starts(len(item.terms)):
            vectors.append(latent.project(item.terms[first : first + WINDOW]))
            owners.append(k)
    queries = np.array(vectors, dtype=np.float32).T.copy()
    owners = np.array(owners)
    rows_at_once = max(1, min(4096, _COSINES_AT_ONCE // len(owners)))
    projection = _with_filler(latent.projection)
    member = np.zeros((len(items), TERMS), dtype=bool)
    for k, item in enumerate(items):
        member[k, item.terms] = True
    sizes = np.array([len(i.terms) for i in items])
    least = settings.cosine * np.sqrt(np.minimum(sizes[owners] / (WINDOW), 1.0)).astype(np.float32)
    filler = -len(owners) % 8
    queries = np.pad(queries, ((0, 0), (0, filler)))
    least = np.pad(least, (0, filler), constant_values=np.inf)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()),
         ("last_word", pa.int64()), ("cosine", pa.float64()), ("covered", pa.float64()),
         ("answered", pa.float64())]
    )

    def judged(terms: np.ndarray, item: Item, first: int, last: int) -> tuple[float, float]:
        n = len(item.terms)
        region = terms[max(0, first - n) : last + n].tolist()
        # No more of the item can be there in order than is there at all.
        if item.occurring(region) / n < min(settings.part, settings.whole):
            return 0.0, 0.0
        covered = common_subsequence(item.places, n, region) / n
        if covered < settings.part:
            return covered, 0.0
        size = len(item.answer)
        found = common_subsequence(item.answer_places, size, region) if size else 0
        return covered, found / size if size else 1.0

    def run(batches):
        add, flush = batches_of(schema)
        for held, names in _blocks(batches, ids=True):
            terms = np.concatenate(held)
            lengths = np.array([len(t) for t in held])
            grid, counts = _grid(held, CELL)
            cells = _row_sums(projection, grid)
            first, _ = _pieces(lengths, CELL)
            text = np.repeat(np.arange(len(held)), counts)
            window, whole = cells.copy(), counts[text] <= CELLS
            for k in range(1, min(CELLS, len(cells))):
                same = text[k:] == text[:-k]
                window[:-k][same] += cells[k:][same]
            # A text's last windows are shorter; only the first of a short text counts.
            number = np.arange(len(cells)) - np.repeat(np.cumsum(counts) - counts, counts)
            used = np.flatnonzero(np.where(whole, number == 0, number <= counts[text] - CELLS))
            window = window[used]
            window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-12)
            starts = first[used]
            text_first = np.cumsum(lengths) - lengths
            text_last = text_first + lengths
            ends = np.minimum(starts + WINDOW, text_last[text[used]])
            best: dict[tuple[int, int], tuple] = {}
            for low in range(0, len(used), rows_at_once):
                at, query, value = near_pairs(window[low : low + rows_at_once], queries, least)
                if not len(at):
                    continue
                at, item = at + low, owners[query]
                at, item, value = _one_per_item(at, item, value, len(items))
                span = np.minimum(starts[at][:, None] + np.arange(WINDOW), ends[at][:, None] - 1)
                inside = np.arange(WINDOW) < (ends - starts)[at][:, None]
                hits = (member[item[:, None], terms[span]] & inside).sum(axis=1)
                going = hits >= settings.shared * np.minimum(WINDOW, sizes[item])
                for w, k, cosine in zip(at[going].tolist(), item[going].tolist(), value[going].tolist()):
                    t = int(text[used[w]])
                    own = held[t]
                    a, b = int(starts[w] - text_first[t]), int(ends[w] - text_first[t])
                    covered, answered = judged(own, items[k], a, b)
                    if covered >= settings.whole or (
                        covered >= settings.part and answered >= settings.answer
                    ):
                        key, row = (t, k), (covered, answered, cosine, -a, b)
                        best[key] = max(best.get(key, row), row)
            for (t, k), (covered, answered, cosine, a, b) in sorted(best.items()):
                row = (names[t], items[k].item_id, -a, b, cosine, covered, answered)
                if (out := add(row)) is not None:
                    yield out
        yield flush()

    return run


def _one_per_item(at, item, value, items: int):
    """The best cosine of each window with each item; rows come by window and item."""
    key = at * items + item
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return at[first], item[first], np.maximum.reduceat(value, first)


_FOUND = (
    "doc_id long, item_id long, first_word long, last_word long, "
    "cosine double, covered double, answered double"
)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Pairs of a document and a benchmark item whose passage it holds.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``, and may
    have ``answer`` (else an item's last quarter is its answer); other columns are not
    looked at.  ``first_word`` and ``last_word`` bound the best window, counted in words
    without punctuation; ``covered`` and ``answered`` are the shares of the item and of its
    answer that the text around it has in order.  Null and empty texts hold nothing.  A
    repeated row of ``docs`` gives its pairs again; so does a repeated item.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    terms = scratch.keep(
        docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string"))).mapInArrow(
            _to_terms, "doc_id long, terms binary"
        )
    )
    latent = latent_space(terms, settings)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(
        F.col("item_id").cast("long"),
        F.lower(F.col("text").cast("string")).alias("text"),
        F.lower(answer).alias("answer"),
    )
    found, block, windows = [], [], 0

    def searched():
        return terms.mapInArrow(_search(latent, block, settings), _FOUND)

    for row in items.toLocalIterator():
        item = _item(row, settings)
        if item is not None:
            block.append(item)
            windows += len(window_starts(len(item.terms)))
        if len(block) == ITEMS or windows >= VECTORS:
            found.append(scratch.keep(searched()))
            block, windows = [], 0
    if block or not found:
        found.append(searched() if block else spark.createDataFrame([], _FOUND))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _item(row, settings: Settings) -> Item | None:
    ((_, texts),) = list(_terms(pa.array([row["text"] or ""]))) or ((0, [np.zeros(0, np.uint16)]),)
    terms = texts[0]
    if len(terms) < settings.least:
        return None
    answer = terms[-max(1, len(terms) // 4) :]
    if row["answer"]:
        ((_, texts),) = list(_terms(pa.array([row["answer"]])))
        answer = texts[0] if len(texts[0]) else answer
    return Item(row["item_id"], terms, answer)


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; all columns.

    Rows without id stay.
    """
    found = contaminated(docs, benchmark, settings)
    gone = found.where("doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
