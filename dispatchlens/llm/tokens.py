"""Token ids of many texts, with the tokenizers library.

A byte-level BPE divides a text before every single space between two visible
characters, so the piece up to the next such space is encoded alike wherever it stands.
Pieces are encoded once per worker and remembered; all others are looked up.
"""

from __future__ import annotations

import json
import os

import numpy as np

from . import words

# Last bytes, in UTF-8, of the white space beyond ASCII, after the bytes before them.
_WIDE_SPACES = {
    b"\xc2": (0x85, 0xA0),
    b"\xe1\x9a": (0x80,),
    b"\xe2\x80": (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF),
    b"\xe2\x81": (0x9F,),
    b"\xe3\x80": (0x80,),
}


class PieceEncoder:
    """Encodes texts with the tokenizer in ``path``; ``most`` pieces are remembered.

    Texts in which division at spaces might differ from the tokenizer's own (white space
    beyond ASCII, control characters, the text of a special token) are encoded whole, as
    is every text where the tokenizer is not a plain byte-level one.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        before = described.get("pre_tokenizer") or {}
        self.plain = (
            described.get("normalizer") is None
            and described["model"]["type"] == "BPE"
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
        )
        self.special = [t["content"].encode() for t in described.get("added_tokens", [])]
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros((0, 2), dtype=np.int64)  # first id and number of ids
        self.flat = np.zeros(0, dtype=np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in encoded]

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that are to be encoded whole."""
        odd = np.zeros(len(offsets) - 1, dtype=bool)
        if not self.plain:
            return ~odd
        at = [np.flatnonzero((data < 0x20) & ~words.IS_SEPARATOR[data])]
        for head, tails in _WIDE_SPACES.items():
            place = np.flatnonzero(data[: len(data) - len(head)] == head[0])
            for k in range(1, len(head)):
                place = place[data[place + k] == head[k]]
            at.append(place[np.isin(data[place + len(head)], tails)])
        raw = data.tobytes()
        for token in self.special:
            found, spots = raw.find(token), []
            while found >= 0:
                spots.append(found)
                found = raw.find(token, found + 1)
            at.append(np.array(spots, dtype=np.int64))
        odd[np.searchsorted(offsets, np.concatenate(at), side="right") - 1] = True
        return odd

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> None:
        texts = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist())]
        ids = self._ids(texts)
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        first = len(self.flat) + np.cumsum(counts) - counts
        fresh = np.fromiter((x for i in ids for x in i), dtype=np.uint32, count=int(counts.sum()))
        self.flat = np.concatenate([self.flat, fresh])
        known = np.concatenate([self.known, hashed])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.place = np.concatenate([self.place, np.stack([first, counts], axis=1)])[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts between ``offsets``, and the number of ids of each text."""
        texts = len(offsets) - 1
        odd = self._odd(data, offsets)
        whole = {
            k: np.array(self._ids([data[offsets[k] : offsets[k + 1]].tobytes().decode()])[0], dtype=np.uint32)
            for k in np.flatnonzero(odd).tolist()
        }
        visible = ~words.IS_SEPARATOR[data]
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 2:
            cut[1 : len(data) - 1] = (data[1:-1] == 0x20) & visible[:-2] & visible[2:]
        cut[offsets] = True
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(data))
        owner = np.searchsorted(offsets, start, side="right") - 1
        if len(whole):
            plain = ~odd[owner]
            start, end, owner = start[plain], end[plain], owner[plain]
        ids, sizes = np.zeros(0, dtype=np.uint32), np.zeros(texts, dtype=np.int64)
        if len(start):
            hashed = words.span_hashes(data, start, end, words.ALL_BYTES, gaps=len(whole) > 0)
            distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
            if len(self.known) + len(distinct) > self.most:
                self._forget()
            at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
            new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), dtype=bool)
            if new.any():
                self._learn(data, start[first[new]], end[first[new]], distinct[new])
                at = np.searchsorted(self.known, distinct)
            place = self.place[at][which]
            counts = place[:, 1]
            ends = np.cumsum(counts)
            source = np.repeat(place[:, 0] - (ends - counts), counts)
            source += np.arange(len(source))
            ids = self.flat[source]
            np.add.at(sizes, owner, counts)
        if not whole:
            return ids, sizes
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        parts = [whole.get(k, ids[bounds[k] : bounds[k + 1]]) for k in range(texts)]
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
