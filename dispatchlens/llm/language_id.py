"""Language identification by error-correcting output codes.

Every language gets a codeword.  For each bit a binary classifier tells the languages
with a 1 from those with a 0 by the byte 2-grams and 3-grams of the text: the mean
log-odds of its grams, scaled by how far the two groups lie apart.  Decoding sums, per
codeword, the logistic loss of every bit, weighted by that distance; the nearest codeword
wins.  A text whose grams speak for no codeword is flagged.

The classifiers are learnt from counts over all labelled documents; only the counts per
language and gram reach the driver, at most ``BUCKETS`` per language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .scratch import batches_of, bound_batches

BUCKETS = 1 << 13
UNDETERMINED = "und"
AMBIGUOUS = 0.5  # a smaller score flags the document
_SHARPNESS = 4.0
_SMOOTHING = 0.5
_LANGUAGES_AT_ONCE = 256
_TEXTS_AT_ONCE = 128  # rows of the dense matrix of gram counts

# a-z as they are, A-Z folded, bytes beyond ASCII as they are, all else a space.
_LETTERS = np.full(256, 32, dtype=np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language.

    Up to five languages get every division in two groups; more get random columns, the
    draw with the greatest smallest distance of several.
    """
    if languages < 2:
        return np.zeros((languages, 0), dtype=np.int8)
    if languages <= 5:
        columns = np.arange(1, 1 << (languages - 1))
        bits = (columns[None, :] >> np.arange(languages)[:, None]) & 1
        return (2 * bits - 1).astype(np.int8)
    width = max(15, 6 * int(np.ceil(np.log2(languages))))
    best, reached = None, -1
    for draw in range(50):
        random = np.random.default_rng(draw)
        code = np.where(random.random((languages, width)) < 0.5, -1, 1).astype(np.int8)
        code[0, (code == 1).all(axis=0)] = -1
        code[0, (code == -1).all(axis=0)] = 1
        apart = min(
            int((code[k] != code[k + 1 :]).sum(axis=1).min()) for k in range(languages - 1)
        )
        if apart > reached:
            best, reached = code, apart
    return best


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all grams of the texts and the text that each belongs to."""
    letters = _LETTERS[data]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    pairs = letters[:-1] * np.uint32(0x9E3779B1) + letters[1:] * np.uint32(0x85EBCA6B)
    two = (pairs ^ (pairs >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift
    threes = pairs[:-1] + letters[2:] * np.uint32(0xC2B2AE35)
    three = (threes ^ (threes >> np.uint32(13))) * np.uint32(0x297A2D39) >> shift
    in_two = text[1:] == text[:-1]
    in_three = text[2:] == text[:-2]
    grams = np.concatenate([two[in_two], three[in_three]]).astype(np.int64)
    return grams, np.concatenate([text[:-1][in_two], text[:-2][in_three]])


def _counts(batches):
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])
    held: dict[str, np.ndarray] = {}

    def rows():
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for low, high, data, offsets in words.chunks(batch.column(1), 1 << 20):
            if len(data) < 3:
                continue
            grams, text = _grams(data, offsets)
            names, which = np.unique(langs[low:high], return_inverse=True)
            counts = np.bincount(which[text] * BUCKETS + grams, minlength=len(names) * BUCKETS)
            for name, row in zip(names.tolist(), counts.reshape(-1, BUCKETS)):
                held[name] = held.get(name, 0) + row
            if len(held) > _LANGUAGES_AT_ONCE:
                yield from rows()
    yield from rows()


def _padded() -> Column:
    """The text between two spaces, so that first and last letters make grams."""
    return F.concat(F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(" "))


class Model:
    """Languages in code-point order, their codewords, and a classifier per bit."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        shares = (counts + _SMOOTHING) / (counts + _SMOOTHING).sum(axis=1, keepdims=True)
        self.weights = np.zeros((BUCKETS, self.code.shape[1]), dtype=np.float32)
        self.apart = np.zeros(self.code.shape[1])
        for bit in range(self.code.shape[1]):
            one = shares[self.code[:, bit] > 0].mean(axis=0)
            other = shares[self.code[:, bit] < 0].mean(axis=0)
            odds = np.log(one / other)
            self.apart[bit] = ((one - other) * odds).sum() / 2
            self.weights[:, bit] = odds * (_SHARPNESS / max(self.apart[bit], 1e-9))

    def decide(self, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword of each row of gram counts, and its share of the belief."""
        total = np.maximum(histogram.sum(axis=1, keepdims=True), 1)
        margins = (histogram @ self.weights) / total
        agree = margins[:, None, :] * self.code[None, :, :]
        weight = self.apart / self.apart.mean() if len(self.apart) else self.apart
        loss = (np.logaddexp(0.0, -agree) * weight).sum(axis=2)
        belief = np.exp(loss.min(axis=1, keepdims=True) - loss)
        best = loss.argmin(axis=1)
        return best, 1.0 / belief.sum(axis=1)


def learn(docs: DataFrame, lang: str = "lang") -> Model:
    """A model of all rows of ``docs`` with a text and a label in column ``lang``."""
    bound_batches(docs.sparkSession)
    labelled = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), _padded().alias("text")
    )
    rows = (
        labelled.mapInArrow(_counts, "lang string, gram int, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    languages = sorted({r["lang"] for r in rows})
    place = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    for r in rows:
        counts[place[r["lang"]], r["gram"]] = r["n"]
    return Model(languages, counts)


def _predictions(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        add, flush = batches_of(schema)
        for batch in batches:
            ids, lettered = (batch.column(k).to_pylist() for k in (0, 2))
            for low, high, data, offsets in words.chunks(batch.column(1), 1 << 18):
                for first in range(low, high, _TEXTS_AT_ONCE):
                    last = min(first + _TEXTS_AT_ONCE, high)
                    own = offsets[first - low : last - low + 1]
                    if model.languages:
                        grams, text = _grams(data[own[0] : own[-1]], own - own[0])
                        counts = np.bincount(
                            text * BUCKETS + grams, minlength=(last - first) * BUCKETS
                        )
                        best, score = model.decide(counts.reshape(-1, BUCKETS).astype(np.float32))
                    for k in range(first, last):
                        row = (ids[k], UNDETERMINED, 0.0)
                        if lettered[k] and model.languages:
                            row = (ids[k], model.languages[best[k - first]], float(score[k - first]))
                        if (out := add(row)) is not None:
                            yield out
        yield flush()

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns are not looked at.  A text that is null
    or has no letter is ``und`` with score 0, and so is every text if the model knows no
    language.  With one language all others are its; ties go to the first by name.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        _padded().alias("text"),
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    found = rows.mapInArrow(_predictions(model), "doc_id long, lang_pred string, score double")
    return found.withColumn("ambiguous", F.col("score") < AMBIGUOUS)


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents that no model learns from; rows without id are in the rest."""
    remainder = F.crc32(F.col(doc_id).cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those that are undetermined or ambiguous; all columns.

    A document goes if its id has a row that is rejected; rows without id go if their text is.
    """
    found = predict(docs, model).where(F.col("ambiguous") | (F.col("lang_pred") == UNDETERMINED))
    gone = found.where("doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
