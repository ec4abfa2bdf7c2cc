"""A range coder for token ids, driven by a mix of order-0, order-1 and order-2 predictions.

Ids are cut into blocks.  All blocks of a segment are coded side by side, one numpy lane
each; every lane starts from the same state, so a block is decoded without the others.

The last id seen after the same two ids (order 2) and after the same id (order 1) are
candidates; each has a level, the length of its run of right guesses.  How often either
was right in this block, given both levels, is counted as the block goes on; the counts
mix the orders into the chances of three events: the order-2 candidate, the order-1
candidate, neither.  In the last case the id takes its share of the segment (order 0),
which the segment's header holds and every block starts from.

The encoder knows all ids and computes every interval of the code at once, by sorting
each block by context; only the arithmetic goes step by step.  The decoder goes step by
step with tables.  Both follow the same rule.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096  # ids in a block
MAGIC = b"TKCM"
VERSION = 1

_SLOT_BITS = 12  # contexts that a lane remembers per order, as a power of two
_LEVELS = 5  # 0: nothing seen; 1 + length of the run of right guesses, at most 4
_STATES = 2 * _LEVELS * _LEVELS
_EVENT_BITS = 12
_ONE = 1 << _EVENT_BITS
_FLOOR = 16  # least frequency of an event
_SHARED = _ONE - 6 * _FLOOR
_ID_BITS = 18
_TOP_BITS = 62
_TOP = np.uint64(1 << _TOP_BITS)
_LEAST = np.uint64(1 << (_TOP_BITS - 16))  # the range stays above this
_HEAD = struct.Struct("<4sBIQIIIII")
_GROUP = 128  # lanes whose intervals are computed at once


class Corrupt(ValueError):
    """A checksum does not match."""


def _slots(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the contexts after ``one``, and after ``two`` and ``one``, are remembered."""
    shift = np.uint32(32 - _SLOT_BITS)
    mixed = one * np.uint32(0x9E3779B1)
    return mixed >> shift, ((mixed ^ two) * np.uint32(0x85EBCA6B)) >> shift


def _frequencies(right2, right1, tried):
    """Frequencies of the order-2 and the order-1 event from counts so far."""
    scale = tried + 1
    return _FLOOR + right2 * _SHARED // scale, _FLOOR + right1 * _SHARED // scale


def _shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2 ** bits``, each at least one; the bounds of their intervals."""
    total = 1 << max(_ID_BITS, int(4 * len(counts)).bit_length())
    shares = 1 + np.floor(counts * ((total - len(counts)) / counts.sum())).astype(np.int64)
    shares[int(np.argmax(counts))] += total - shares.sum()
    return np.concatenate([[0], np.cumsum(shares)])


def _lengths(n: int, block: int) -> np.ndarray:
    count = -(-n // block)
    lengths = np.full(count, block, dtype=np.int64)
    if count:
        lengths[-1] = n - block * (count - 1)
    return lengths


def _after(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values``, which are in the given order of each row, in the row's own order."""
    out = np.empty_like(values)
    np.put_along_axis(out, order, values, axis=1)
    return out


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[:, by:] = x[:, :-by]
    return out


def _candidates(slots: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id the last one of the same slot, and the slot's level before it."""
    slots = slots.astype(np.uint16)
    order = np.argsort(slots, axis=1, kind="stable")
    ranked, came = np.take_along_axis(slots, order, 1), np.take_along_axis(ids, order, 1)
    chained = np.zeros(slots.shape, dtype=bool)
    chained[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
    guess = np.where(chained, _shifted(came, 1), 0)
    right = guess == came
    run1 = _shifted(right, 1)
    run2 = run1 & _shifted(right, 2)
    run3 = run2 & _shifted(right, 3)
    level = chained * (1 + run1.astype(np.int8) + run2 + run3)
    return _after(order, guess), _after(order, level.astype(np.uint16))


def _intervals(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and width of each id's interval; rows are blocks, ids count from one."""
    slots1, slots2 = _slots(_shifted(ids, 1), _shifted(ids, 2))
    guess1, level1 = _candidates(slots1, ids)
    guess2, level2 = _candidates(slots2, ids)
    state = level2 * np.uint16(_LEVELS) + level1
    state += np.uint16(_LEVELS * _LEVELS) * (guess1 == guess2)
    is2 = guess2 == ids
    is1 = (guess1 == ids) & ~is2
    order = np.argsort(state, axis=1, kind="stable")
    ranked = np.take_along_axis(state, order, 1)
    first = np.ones(state.shape, dtype=bool)
    first[:, 1:] = ranked[:, 1:] != ranked[:, :-1]

    def before(event: np.ndarray) -> np.ndarray:
        event = np.take_along_axis(event, order, 1).astype(np.int32)
        count = np.cumsum(event, axis=1, dtype=np.int32) - event
        return count - np.maximum.accumulate(np.where(first, count, 0), axis=1)

    f2, f1 = (
        _after(order, f)
        for f in _frequencies(before(is2), before(is1), before(np.ones_like(is1)))
    )
    bits = int(bounds[-1]).bit_length() - 1
    rest = _ONE - f1 - f2
    which = ids.astype(np.int64) - 1
    start = np.where(is2, 0, f2.astype(np.int64) << bits)
    start = np.where(is1 | is2, start, ((f1 + f2).astype(np.int64) << bits) + rest * bounds[which])
    width = np.where(is2, f2, f1).astype(np.int64) << bits
    width = np.where(is1 | is2, width, rest * np.diff(bounds)[which])
    return start, width


def _encode_lanes(numbers: np.ndarray, bounds: np.ndarray, block: int) -> list[bytes]:
    """Every block of ``numbers`` (positions in the alphabet) as bytes."""
    lengths = _lengths(len(numbers), block)
    lanes = len(lengths)
    ids = np.ones(lanes * block, dtype=np.uint32)
    ids[: len(numbers)] += numbers.astype(np.uint32)
    ids = ids.reshape(lanes, block)
    bits = int(bounds[-1]).bit_length() - 1 + _EVENT_BITS
    starts = np.empty((block, lanes), dtype=np.uint32 if bits <= 32 else np.uint64)
    widths = np.empty_like(starts)
    for k in range(0, lanes, _GROUP):
        start, width = _intervals(ids[k : k + _GROUP], bounds)
        starts[:, k : k + _GROUP], widths[:, k : k + _GROUP] = start.T, width.T
    shift, out_shift, sixteen = np.uint64(bits), np.uint64(_TOP_BITS - 16), np.uint64(16)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, _TOP, dtype=np.uint64)
    words = np.zeros((lanes, 3 * block + 4), dtype=np.uint16)
    used = np.zeros(lanes, dtype=np.int64)

    def carry(lane: np.ndarray) -> None:
        low[lane] -= _TOP
        at = used[lane] - 1
        while len(lane):
            words[lane, at] += np.uint16(1)
            more = words[lane, at] == 0
            lane, at = lane[more], at[more] - 1

    for step in range(int(lengths.max(initial=0))):
        n = lanes if step < lengths[-1] else lanes - 1
        unit = span[:n] >> shift
        low[:n] += unit * starts[step, :n]
        span[:n] = unit * widths[step, :n]
        over = np.flatnonzero(low >= _TOP)
        if len(over):
            carry(over)
        short = np.flatnonzero(span <= _LEAST)
        while len(short):
            value, at = low[short], used[short]
            words[short, at] = value >> out_shift
            used[short] = at + 1
            low[short] = (value & (_LEAST - np.uint64(1))) << sixteen
            wider = span[short] << sixteen
            span[short] = wider
            short = short[wider <= _LEAST]
    # The shortest number in the final range has one more word.
    low += _LEAST - np.uint64(1)
    over = np.flatnonzero(low >= _TOP)
    if len(over):
        carry(over)
    words[np.arange(lanes), used] = low >> out_shift
    return [words[k, : used[k] + 1].astype("<u2").tobytes() for k in range(lanes)]


def _decode_lanes(blocks: list[bytes], lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The numbers of all blocks, one after the other; only the last may be shorter."""
    lanes, block = len(blocks), int(lengths[0])
    longest = max(len(b) // 2 for b in blocks) + 8
    words = np.zeros((lanes, longest), dtype=np.uint16)
    for k, raw in enumerate(blocks):
        words[k, : len(raw) // 2] = np.frombuffer(raw, dtype="<u2")
    words = words.reshape(-1)
    used = np.arange(lanes) * longest
    last_word = used + longest - 1
    code = np.zeros(lanes, dtype=np.uint64)  # four times the place in the range
    sixteen, two = np.uint64(16), np.uint64(2)
    for _ in range(4):
        code = (code << sixteen) | words[used]
        used += 1
    id_bits = int(bounds[-1]).bit_length() - 1
    shift, id_shift = np.uint64(id_bits + _EVENT_BITS), np.uint64(id_bits)
    starts, shares = bounds[:-1].astype(np.uint64), np.diff(bounds).astype(np.uint64)
    owner = np.repeat(np.arange(len(shares), dtype=np.uint32), np.diff(bounds))
    span = np.full(lanes, _TOP, dtype=np.uint64)
    memory1, memory2 = (np.zeros(lanes << _SLOT_BITS, dtype=np.uint32) for _ in range(2))
    base = np.arange(lanes) << _SLOT_BITS
    state_base = np.arange(lanes, dtype=np.int64) * _STATES
    tried, right1, right2 = (np.zeros(lanes * _STATES, dtype=np.int32) for _ in range(3))
    one, before = (np.zeros(lanes, dtype=np.uint32) for _ in range(2))
    columns = np.zeros((block, lanes), dtype=np.uint32)
    three, seven = np.uint32(3), np.uint32(7)
    for step in range(block):
        n = lanes if step < lengths[-1] else lanes - 1
        if n < len(one):
            one, before, base, state_base = one[:n], before[:n], base[:n], state_base[:n]
        slots1, slots2 = _slots(one, before)
        at1, at2 = base + slots1, base + slots2
        cell1, cell2 = memory1[at1], memory2[at2]
        level1, level2 = cell1 & seven, cell2 & seven
        guess1, guess2 = cell1 >> three, cell2 >> three
        state = level2 * np.uint32(_LEVELS) + level1
        state += np.uint32(_LEVELS * _LEVELS) * (guess1 == guess2)
        state = state_base + state
        seen, had1, had2 = tried[state], right1[state], right2[state]
        f2, f1 = _frequencies(had2, had1, seen)
        both = f1 + f2
        unit = span[:n] >> shift
        place = (code[:n] >> two) // unit
        event = (place >> id_shift).astype(np.int32)
        is2 = event < f2
        hit = event < both
        start = np.where(is2, 0, f2).astype(np.uint64) << id_shift
        width = np.where(is2, f2, f1).astype(np.uint64) << id_shift
        ids = np.where(is2, guess2, guess1)
        missed = np.flatnonzero(~hit)
        if len(missed):
            above = both[missed].astype(np.uint64) << id_shift
            rest = (_ONE - both[missed]).astype(np.uint64)
            within = np.minimum((place[missed] - above) // rest, np.uint64(len(owner) - 1))
            which = owner[within.astype(np.int64)]
            start[missed] = above + rest * starts[which]
            width[missed] = rest * shares[which]
            ids[missed] = which + np.uint32(1)
        code[:n] -= (start * unit) << two
        span[:n] = width * unit
        short = np.flatnonzero(span <= _LEAST)
        while len(short):
            at = used[short]
            code[short] = (code[short] << sixteen) | words[np.minimum(at, last_word[short])]
            used[short] = at + 1
            wider = span[short] << sixteen
            span[short] = wider
            short = short[wider <= _LEAST]
        columns[step, :n] = ids
        tried[state] = seen + 1
        right2[state] = had2 + is2
        right1[state] = had1 + (hit & ~is2)
        grown1 = np.minimum(level1 * (guess1 == ids) + 1, _LEVELS - 1).astype(np.uint32)
        grown2 = np.minimum(level2 * (guess2 == ids) + 1, _LEVELS - 1).astype(np.uint32)
        memory1[at1] = (ids << three) | grown1
        memory2[at2] = (ids << three) | grown2
        before, one = one, ids
    return np.ascontiguousarray(columns.T).reshape(-1)[: int(lengths.sum())] - np.uint32(1)


def pack(ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: the ids of whole documents, in order.

    Header: magic, version, documents, ids, block length, blocks, alphabet, bytes of the
    packed tables, their CRC-32.  Packed tables: document ids and their null marks, ids
    per document, the alphabet and its counts, bytes and CRC-32 of every block.
    """
    ids = np.ascontiguousarray(ids, dtype="<u4")
    alphabet, numbers, counts = np.unique(ids, return_inverse=True, return_counts=True)
    blocks = _encode_lanes(numbers, _shares(counts), block) if len(ids) else []
    tables = zlib.compress(
        b"".join(
            [
                np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
                np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
                np.asarray(sizes, dtype="<u8").tobytes(),
                np.diff(alphabet, prepend=0).astype("<u4").tobytes(),
                counts.astype("<u4").tobytes(),
                np.array([len(b) for b in blocks], dtype="<u4").tobytes(),
                np.array(
                    [zlib.crc32(ids[k * block : (k + 1) * block]) for k in range(len(blocks))],
                    dtype="<u4",
                ).tobytes(),
            ]
        )
    )
    head = _HEAD.pack(
        MAGIC, VERSION, len(doc_ids), len(ids), block, len(blocks), len(alphabet),
        len(tables), zlib.crc32(tables),
    )
    return b"".join([head, tables, *blocks])


def unpack(segment: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """Ids, document ids and ids per document; raises ``Corrupt`` if a checksum fails."""
    magic, version, docs, n, block, count, letters, size, check = _HEAD.unpack_from(segment)
    if magic != MAGIC or version != VERSION:
        raise Corrupt("not a segment of this version")
    raw = bytes(segment[_HEAD.size : _HEAD.size + size])
    if zlib.crc32(raw) != check:
        raise Corrupt("the tables do not match their checksum")
    raw, at = zlib.decompress(raw), 0

    def take(kind: str, length: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(raw, dtype=kind, count=length, offset=at)
        at += got.nbytes
        return got

    doc_ids, missing, sizes = take("<i8", docs), take("u1", docs), take("<u8", docs)
    alphabet, counts = np.cumsum(take("<u4", letters), dtype=np.int64), take("<u4", letters)
    lengths, checks = take("<u4", count), take("<u4", count)
    ids = np.zeros(0, dtype="<u4")
    if n:
        ends = _HEAD.size + size + np.cumsum(lengths.astype(np.int64))
        blocks = [bytes(segment[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist())]
        numbers = _decode_lanes(blocks, _lengths(n, block), _shares(counts.astype(np.int64)))
        ids = alphabet[numbers].astype("<u4")
        for k, want in enumerate(checks.tolist()):
            if zlib.crc32(ids[k * block : (k + 1) * block]) != want:
                raise Corrupt(f"block {k} does not match its checksum")
    named = [None if m else d for d, m in zip(doc_ids.tolist(), missing.tolist())]
    return ids, named, sizes.astype(np.int64)
