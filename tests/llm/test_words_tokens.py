"""Word hashes and token ids against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from dispatchlens.llm import context_coder, token_output, words
from dispatchlens.llm.tokens import PieceEncoder

TEXTS = ["Hello hello  wörld\n", None, "", "a b\ta", " lead ", "x" * 2_000_000 + " y", "\x0b\x0c", "é É"]


@pytest.mark.parametrize("plain", [False, True])
def test_words_are_those_of_a_pattern(plain):
    pattern = rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+" if plain else rb"[^\x20\x09-\x0d]+"
    known: dict[bytes, int] = {}
    for low, high, data, offsets in words.chunks(pa.array(TEXTS), limit=64):
        found = words.word_hashes(data, offsets, plain)
        bounds = found.bounds(high - low)
        for k in range(low, high):
            wanted = re.findall(pattern, (TEXTS[k] or "").encode().lower())
            own = found.hash[bounds[k - low] : bounds[k - low + 1]].tolist()
            assert len(own) == len(wanted)
            for word, value in zip(wanted, own):
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_pieces_encode_as_whole_texts_do():
    encoder = PieceEncoder(token_output.default_tokenizer())
    random.seed(1)
    parts = [" ", "  ", "\n", "the", "é", "12", "!", "'s", "<|endoftext|>", "\x1c", "日本", " ", "\u0085", " x"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(3000)] + [None, ""]
    for low, high, data, offsets in words.chunks(pa.array(texts), 1 << 14):
        ids, sizes = encoder.encode(data, offsets)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for k in range(low, high):
            wanted = encoder.tokenizer.encode(texts[k] or "", add_special_tokens=False).ids
            assert ids[bounds[k - low] : bounds[k - low + 1]].tolist() == wanted, texts[k]


@pytest.mark.parametrize("n", [0, 1, 5, 255, 256, 257, 5000])
@pytest.mark.parametrize("kind", ["zipf", "same", "wide"])
def test_segments_round_trip(n, kind):
    random_ids = np.random.default_rng(n)
    ids = {
        "zipf": random_ids.zipf(1.4, n) % 50257,
        "same": np.zeros(n),
        "wide": random_ids.integers(0, 2**32, n),
    }[kind].astype(np.uint32)
    packed = context_coder.pack(ids, [None, 7], np.array([n // 2, n - n // 2]), block=256)
    got, names, sizes = context_coder.unpack(packed)
    assert (got == ids).all() and names == [None, 7] and sizes.tolist() == [n // 2, n - n // 2]


def test_a_changed_byte_is_noticed():
    ids = np.random.default_rng(0).integers(0, 500, 3000).astype(np.uint32)
    packed = bytearray(context_coder.pack(ids, [1], np.array([3000]), block=256))
    for place in (40, len(packed) // 2, len(packed) - 40):
        changed = bytearray(packed)
        changed[place] ^= 4
        with pytest.raises(ValueError):
            context_coder.unpack(bytes(changed))


def test_repetition_is_cheap():
    ids = np.tile(np.arange(50, dtype=np.uint32), 100)
    assert len(context_coder.pack(ids, [1], np.array([5000]))) < 1500
