"""SetSketch registers: truncated minima on an exponential scale.

Every element starts a stream of random points, each assigned to a random register;
a register holds the smallest point it gets, as the exponent of ``BASE``.  Registers
of a union are the larger of two registers, so sketches merge; two sets agree in a
register with about their Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from .words import mix

REGISTERS = 160
BASE = 1.001
LARGEST = 65_535  # registers are truncated to 0 .. LARGEST
_RATE = 20.0
_LOG_BASE = float(np.log(BASE))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _points(elements: np.ndarray, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaps and registers of the points ``first`` .. of every element's stream."""
    numbers = (np.arange(first, first + count, dtype=np.uint64) + np.uint64(1)) * _STEP
    random = mix(elements[:, None] + numbers[None, :])
    gaps = -np.log1p((random >> np.uint64(11)) * -(2.0**-53)) / REGISTERS
    return gaps, ((random & np.uint64(0x7FF)) * np.uint64(REGISTERS) >> np.uint64(11)).astype(np.int64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The registers of a set of distinct 64-bit hashes, as ``uint16``.

    Only points below a limit are drawn, which holds about the same number of points
    for a set of any size; the limit is raised until every register has one.
    """
    least = np.full(REGISTERS, np.inf)
    if len(elements):
        limit = (np.log(REGISTERS) + 4.0) / len(elements)
        while True:
            least[:] = np.inf
            left, reached, first = elements, np.zeros(len(elements)), 0
            while len(left):
                count = 1 if first == 0 and limit * REGISTERS < 0.5 else int(limit * REGISTERS * 1.2) + 4
                gaps, registers = _points(left, first, count)
                times = reached[:, None] + np.cumsum(gaps, axis=1)
                near = times <= limit
                np.minimum.at(least, registers[near], times[near])
                going = near[:, -1]
                left, reached, first = left[going], times[going, -1], first + count
            if np.isfinite(least).all():
                break
            limit *= 2
    exponent = np.floor(1.0 - np.log(least / _RATE) / _LOG_BASE)
    return np.clip(exponent, 0, LARGEST).astype(np.uint16)


def likely_similarity(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 25
) -> np.ndarray:
    """The Jaccard similarity of greatest joint likelihood, for rows of registers.

    Given the sizes, the numbers of registers that are larger, smaller and equal
    follow a multinomial law in the similarity; its logarithm is concave, and the
    maximum is found by narrowing an interval.
    """
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - larger - smaller
    u = size_a / (size_a + size_b)
    v = 1.0 - u

    def probability(x):
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / _LOG_BASE

    def value(j):
        p, q = probability(u - v * j), probability(v - u * j)
        tiny = 1e-12
        return (
            larger * np.log(p + tiny)
            + smaller * np.log(q + tiny)
            + equal * np.log(np.maximum(1.0 - p - q, 0.0) + tiny)
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(steps):
        third = (high - low) / 3.0
        better = value(low + third) < value(high - third)
        low = np.where(better, low + third, low)
        high = np.where(better, high, high - third)
    return (low + high) / 2.0
