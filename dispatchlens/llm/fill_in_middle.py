"""Fill-in-middle: a text cut at two unit boundaries and put together in another order.

A text is divided into fixed blocks of bytes.  A Fenwick tree over the blocks holds their
counts of units and of code points; descending it by powers of two finds the block in
which a wanted unit ends, and the code points before that block, without a list of all
units.  The boundary itself is then looked for in that block alone.

A unit is a word with the white space before it, or the white space at the end of a text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .scratch import bound_batches


@dataclass(frozen=True)
class Settings:
    """Of a hundred documents ``cut`` are transformed, and of those ``spm`` with the suffix
    first.  ``marks`` stand before prefix, suffix and middle; none may begin with the end
    of another.  ``block``: bytes of a block.
    """

    seed: int = 42
    cut: int = 50
    spm: int = 80
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    block: int = 4096

    def __post_init__(self):
        ends = {m[k:] for m in self.marks for k in range(1, len(m))} | {""}
        starts = {m[:k] for m in self.marks for k in range(1, len(m) + 1)} | set(self.marks)
        if ends & starts or not all(self.marks) or len(set(self.marks)) < 3:
            raise ValueError("the marks could be read in two ways")


class BlockTree:
    """Units and code points of a text (UTF-8 bytes) by block, in a Fenwick tree."""

    def __init__(self, data: np.ndarray, block: int):
        self.data, self.block = data, block
        gap = words.IS_SEPARATOR[data]
        last = ~gap  # the last byte of each unit
        last[:-1] &= gap[1:]
        last[-1:] = True
        self.last = last
        starts = np.arange(0, len(data), block)
        counts = np.zeros((len(starts) + 1, 2), dtype=np.int64)
        if len(starts):
            first = (data & 0xC0) != 0x80
            counts[1:, 0] = np.add.reduceat(last, starts, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(first, starts, dtype=np.int64)
        sums = np.cumsum(counts, axis=0)
        self.units = int(sums[-1, 0])
        node = np.arange(len(sums))
        self.tree = sums - sums[node - (node & -node)]  # a node holds its lowest bit's span

    def boundary(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the end of the first ``units`` units."""
        if not units:
            return 0, 0
        at, points = 0, 0
        step = 1 << (len(self.tree).bit_length() - 1)
        while step:
            if at + step < len(self.tree) and self.tree[at + step, 0] < units:
                at += step
                units -= int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        low = at * self.block
        size = int(np.flatnonzero(self.last[low : low + self.block])[units - 1]) + 1
        return low + size, points + int(((self.data[low : low + size] & 0xC0) != 0x80).sum())


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits, from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def transformed(data: np.ndarray, doc_id: int | None, settings: Settings) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text, as bytes."""
    tree, raw = BlockTree(data, settings.block), data.tobytes()
    one, two, chosen, order = draws(settings.seed, doc_id)
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in settings.marks)
    marked = prefix_mark in raw or suffix_mark in raw or middle_mark in raw
    if not raw or marked or chosen % 100 >= settings.cut:
        return tree.units, "plain", None, None, raw
    cuts = sorted((one % (tree.units + 1), two % (tree.units + 1)))
    (low, before), (high, until) = tree.boundary(cuts[0]), tree.boundary(cuts[1])
    prefix, middle, suffix = prefix_mark + raw[:low], middle_mark + raw[low:high], suffix_mark + raw[high:]
    spm = order % 100 < settings.spm
    output = suffix + prefix + middle if spm else prefix + suffix + middle
    return tree.units, "spm" if spm else "psm", before, until - before, output


_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def _texts(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(offsets), pa.py_buffer(b"".join(parts)))


def _transform(settings: Settings):
    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            for low, high, data, offsets in words.chunks(batch.column(1)):
                rows = [
                    transformed(data[offsets[k] : offsets[k + 1]], names[low + k], settings)
                    for k in range(high - low)
                ]
                n, form, before, middle, output = zip(*rows)
                numbers = [pa.array(c, type=pa.int64()) for c in (names[low:high], n)]
                chars = [pa.array(c, type=pa.int64()) for c in (before, middle)]
                yield pa.RecordBatch.from_arrays(
                    [*numbers, pa.array(form, type=pa.string()), *chars, _texts(output)], names=_NAMES
                )

    return run


def transform(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns are not looked at.  A null text is empty.
    Empty texts, texts that hold a mark, and those not drawn stay as they are (``plain``,
    no lengths).  The draw depends on the id alone, so repeated rows are treated alike and
    a row without id is drawn like any other.  Lengths are code points.  No shuffle; a task
    holds one text and its counts at a time.
    """
    bound_batches(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(_transform(settings), _OUT)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text that ``transform`` was given, from its output and form."""
    prefix, suffix, middle = (F.lit(m) for m in settings.marks)

    def after(text: Column, mark: Column) -> Column:
        return F.split_part(text, mark, F.lit(2))

    def before(text: Column, mark: Column) -> Column:
        return F.split_part(text, mark, F.lit(1))

    spm = F.concat(
        before(after(output, prefix), middle), after(output, middle), before(after(output, suffix), prefix)
    )
    psm = F.concat(
        before(after(output, prefix), suffix), after(output, middle), before(after(output, suffix), middle)
    )
    return F.when(form == "spm", spm).when(form == "psm", psm).otherwise(output)


def digest(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``transform`` with hashes in place of texts."""
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), settings), 256).alias("restored_sha256"),
    )
