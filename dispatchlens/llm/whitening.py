"""Whitening of integer vectors by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors, centred, are the rows of a matrix X that is never held whole.  From a
start vector v the two products Xv and X'u alternate: each pass over the rows takes both,
and sends a vector of the dimension's length per task.  The right vectors v stay on the
driver, a row each of at most the dimension's length.  A left vector u has an entry per row
of X and is nowhere stored: it is X times a vector w that the driver keeps, and every pass
computes the earlier ones anew from w to make the next orthogonal to all of them.  The
small bidiagonal matrix of the coefficients is decomposed on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

_SPLIT = 32  # bits of the low half of an entry in exact sums


@dataclass(frozen=True)
class Settings:
    """``components`` to find, of entries times ``scale``.  The search ends when the error
    of each is below ``tolerance`` of the largest deviation.
    """

    components: int = 4
    scale: int = 256
    tolerance: float = 1e-14
    column: str = "embedding"


def integers(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, x``: the usable vectors, each entry the floor of ``scale`` times it."""
    entries = F.col(settings.column).cast("array<double>")
    usable = F.forall(
        entries,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))),
    )
    scaled = F.transform(entries, lambda c: F.floor(c * F.lit(float(settings.scale))))
    return vectors.where(entries.isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _numbered(values) -> pa.RecordBatch:
    values = np.asarray(values, dtype=np.float64)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["pos", "value"])


def _summed(rows: DataFrame, partial, size: int) -> np.ndarray:
    """Sums over all tasks of the ``size`` numbers that ``partial`` gives for a task."""
    sums = rows.mapInArrow(partial, "pos long, value double").groupBy("pos").agg(F.sum("value"))
    total = np.zeros(size)
    for pos, value in sums.collect():  # ``size`` rows, a small multiple of the dimension
        total[pos] = value
    return total


def _exact_partial(batches):
    """High and low halves of the entries' sums, extremes, and the rows, for a task."""
    names = ["pos", "high", "low", "least", "most", "rows"]
    high = low = least = most = None
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(0))
        if high is None:
            high, low = np.zeros(x.shape[1], dtype=np.int64), np.zeros(x.shape[1], dtype=np.int64)
            least, most = x[0].copy(), x[0].copy()
        high += (x >> _SPLIT).sum(axis=0)
        low += (x & ((1 << _SPLIT) - 1)).sum(axis=0)
        least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
        rows += len(x)
    if rows:
        columns = [np.arange(len(high)), high, low, least, most, np.full(len(high), rows)]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)


@dataclass(frozen=True)
class Totals:
    """Number of distinct vectors, exact sums and the largest distance from a mean."""

    n: int
    sums: list[int]
    widest: int

    @property
    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def totals(fit: DataFrame) -> Totals:
    schema = "pos long, high long, low long, least long, most long, rows long"
    exact = fit.mapInArrow(_exact_partial, schema).groupBy("pos")
    rows = exact.agg(
        F.sum(F.col("high").cast("decimal(20,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(20,0)")).alias("low"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("rows").alias("rows"),
    ).orderBy("pos")
    found = rows.collect()  # a row per dimension
    sums = [(int(r["high"]) << _SPLIT) + int(r["low"]) for r in found]
    return Totals(
        found[0]["rows"] if found else 0, sums, max((r["most"] - r["least"] for r in found), default=0)
    )


def _products(centre: np.ndarray, y: np.ndarray, lefts: np.ndarray):
    """For p = Xy: X'p, the earlier left vectors' products with p, p'p and the trace of X'X."""

    def run(batches):
        back, along = np.zeros(len(y)), np.zeros(lefts.shape[1])
        square = trace = 0.0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0)) - centre
                p = x @ y
                back += x.T @ p
                along += (x @ lefts).T @ p
                square += float(p @ p)
                trace += float((x * x).sum())
        yield _numbered([*back, *along, square, trace])

    return run


class Bidiagonal:
    """The state of the driver: right vectors, coefficients, and what makes the left ones.

    ``rights`` (columns v), ``lefts`` (columns w, u = Xw), ``backs`` (columns X'u) and the
    coefficients u'Xv, all of the dimension's size at most.
    """

    def __init__(self, fit: DataFrame, centre: np.ndarray):
        self.fit, self.centre, self.size = fit, centre, len(centre)
        self.rights = np.zeros((self.size, 0))
        self.lefts = np.zeros((self.size, 0))
        self.backs = np.zeros((self.size, 0))
        self.matrix = np.zeros((0, 0))
        self.trace = 0.0
        self.random = np.random.default_rng(5)

    def _apart(self, vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - self.rights @ (self.rights.T @ vector)
        return vector

    def fresh(self) -> np.ndarray | None:
        """A random right vector orthogonal to all so far, if there is room."""
        if self.rights.shape[1] == self.size:
            return None
        vector = self._apart(self.random.standard_normal(self.size))
        return vector / np.linalg.norm(vector)

    def extend(self, v: np.ndarray, beta: float) -> np.ndarray | None:
        """Take in the right vector ``v``; the next one, or None at an invariant subspace.

        ``beta``: the coefficient that binds ``v`` to the last left vector, 0 at a fresh start.
        """
        lefts, known = self.lefts, self.lefts.shape[1]
        y = v - beta * lefts[:, -1] if beta else v.copy()
        along = np.zeros(known)
        along[-1:] = beta
        for _ in range(3):  # once, and again if much was taken away
            sums = _summed(self.fit, _products(self.centre, y, lefts), self.size + known + 2)
            back, turn = sums[: self.size], sums[self.size : self.size + known]
            square, self.trace = sums[-2], sums[-1]
            y, back, along = y - lefts @ turn, back - self.backs @ turn, along + turn
            left = max(square - float(turn @ turn), 0.0)
            if left > 0.5 * square or left <= self.trace * 1e-28:
                break
        self.rights = np.concatenate([self.rights, v[:, None]], axis=1)
        alpha = float(np.sqrt(left))
        lost = alpha <= 1e-13 * np.sqrt(self.trace)
        grown = np.zeros((known + (not lost), self.rights.shape[1]))
        grown[:known, :-1], grown[:known, -1] = self.matrix, along
        if not lost:
            grown[-1, -1] = alpha
            self.lefts = np.concatenate([lefts, y[:, None] / alpha], axis=1)
            self.backs = np.concatenate([self.backs, back[:, None] / alpha], axis=1)
        self.matrix, self.beta = grown, 0.0
        if lost:
            return None
        rest = self._apart(self.backs[:, -1])
        self.beta = float(np.linalg.norm(rest))
        if self.beta <= 1e-13 * np.sqrt(self.trace):
            self.beta = 0.0
            return None
        return self._apart(rest / self.beta)

    def run(self, components: int, tolerance: float) -> np.ndarray:
        """The leading right singular vectors of X, as columns."""
        v, beta = self.fresh(), 0.0
        while v is not None:
            v = self.extend(v, beta)
            beta = self.beta
            left, deviations, right = np.linalg.svd(self.matrix)
            wanted = min(components, self.size)
            if v is None:
                # An invariant subspace: can what lies outside still hold a leading one?
                outside = self.trace - float((deviations**2).sum())
                least = deviations[wanted - 1] if len(deviations) >= wanted else 0.0
                if outside <= max(least**2, 1e-24 * self.trace):
                    break
                v = self.fresh()
            elif len(deviations) > wanted:
                errors = beta * np.abs(left[-1, :wanted])
                if errors.max() <= tolerance * deviations[0]:
                    break
        return self.rights @ right[: min(components, self.size)].T


def _covariance_partial(centre: np.ndarray, directions: np.ndarray, scale: np.ndarray):
    """Sums and sums of products of the projected rows, for a task."""

    def run(batches):
        count = len(scale)
        sums, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            if batch.num_rows:
                z = (_matrix(batch.column(0)) - centre) @ directions / scale
                sums += z.sum(axis=0)
                products += z.T @ z
        yield _numbered([*sums, *products.ravel()])

    return run


def _covariance(fit: DataFrame, n: int, centre, directions, scale) -> np.ndarray:
    count = len(scale)
    found = _summed(fit, _covariance_partial(centre, directions, scale), count + count * count)
    mean = found[:count] / n
    return found[count:].reshape(count, count) / n - np.outer(mean, mean)


@dataclass(frozen=True)
class Model:
    """Centre, directions (columns, largest entry positive), variances along them, the
    whole variance, and the largest entry of the whitened covariance minus the identity.
    """

    totals: Totals
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The components of the distinct vectors of ``integers``; None without any vector."""
    scratch = Scratch(rows.sparkSession, "whitening")
    distinct = scratch.keep(rows.select("x").distinct())
    known = totals(distinct)
    if not known.n:
        scratch.drop(distinct)
        return None
    centre = known.centre
    search = Bidiagonal(distinct, centre)
    directions = search.run(settings.components, settings.tolerance)
    # The covariance along the found directions, once more, rotates them into place.
    along = _covariance(distinct, known.n, centre, directions, np.ones(directions.shape[1]))
    variances, turn = np.linalg.eigh((along + along.T) / 2)
    variances, directions = variances[::-1], directions @ turn[:, ::-1]
    trace = search.trace / known.n
    good = variances > 1e-20 * trace
    variances, directions = variances[good], directions[:, good]
    directions = directions / np.linalg.norm(directions, axis=0)
    largest = np.abs(directions).argmax(axis=0) if directions.size else np.zeros(0, dtype=int)
    directions = directions * np.sign(directions[largest, np.arange(len(variances))])
    error = 0.0
    if len(variances):
        white = _covariance(distinct, known.n, centre, directions, np.sqrt(variances))
        error = float(np.abs(white - np.eye(len(variances))).max())
    scratch.drop(distinct)
    return Model(known, directions, variances, trace, error)


_OUT = "vec_id long, component int, deviation decimal(38,0), whitened double"


def _whiten(model: Model):
    n, sums = model.totals.n, model.totals.sums
    size, count = len(sums), len(model.variances)
    small = size * (n * model.totals.widest) ** 2 < 2**62 and n * model.totals.widest < 2**31
    small = small and all(abs(s) < 2**62 for s in sums)

    def deviations(x: np.ndarray) -> list[int]:
        if small:
            apart = x * np.int64(n) - np.array(sums, dtype=np.int64)
            return (apart * apart).sum(axis=1).tolist()
        exact = x.astype(object) * n - np.array(sums, dtype=object)
        return (exact * exact).sum(axis=1).tolist()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            white = ((x - model.totals.centre) @ model.directions) / np.sqrt(model.variances)
            apart = [Decimal(int(d)) if d < 10**38 else None for d in deviations(x)]
            columns = [
                pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count))
                if not batch.column(0).null_count
                else pa.array([v for v in batch.column(0).to_pylist() for _ in range(count)], type=pa.int64()),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array([d for d in apart for _ in range(count)], type=pa.decimal128(38, 0)),
                pa.array(white.ravel()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per usable vector and component ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Needs ``vec_id`` and the column of vectors; other columns are not looked at.  A null
    vector, and one with a null or non-finite entry, has no rows; of vectors of several
    lengths those of the most frequent one count (of equally frequent ones, the longest).
    Repeated vectors have equal rows and count once in ``n`` and the covariance; a row
    without id is treated alike.  Directions without variance are no components, so there
    may be fewer than ``components``, and no rows at all where all vectors are equal or
    empty.  ``deviation`` is exact, and null where it has more than 38 digits.
    """
    rows = integers(vectors, settings)
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    model = None
    if usual and usual["length"]:
        rows = rows.where(F.size("x") == usual["length"])
        model = fit(rows, settings)
    if model is None or not len(model.variances):
        found = rows.limit(0).select("vec_id", F.lit(None).cast("array<bigint>").alias("x"))
        found = found.selectExpr(
            "vec_id", "0 as component", "cast(0 as decimal(38,0)) as deviation", "0.0D as whitened"
        )
        n, shares, error = 0, [], 0.0
    else:
        found = rows.select("vec_id", "x").mapInArrow(_whiten(model), _OUT)
        n, error = model.totals.n, model.identity_error
        shares = [float(v / model.trace) for v in model.variances]
    explained = F.element_at(F.array(*[F.lit(s) for s in [*shares, 0.0]]), F.col("component"))
    return found.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        (explained if shares else F.lit(0.0)).alias("explained"), F.lit(error).alias("identity_error"),
    )
