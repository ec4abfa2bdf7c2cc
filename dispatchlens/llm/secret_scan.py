"""Secrets in texts: base patterns, and strings that a vocabulary finds hard to write.

A byte-level vocabulary spends few tokens on what people write: words, names, paths,
numbers that repeat.  A random string takes a token for every one or two characters.  Runs
of characters that a key may consist of are encoded, and those with few characters per
token are taken for secrets, after known forms of digests and identifiers are set aside.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import bound_batches
from .spans import SPANS, count_of, written

# The base patterns.  A run of hexadecimal digits begins where none stands
# before it, which keeps long texts linear.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "random"]

_RUN = "A-Za-z0-9+/_-"
# Lengths, in hexadecimal digits, of common digests.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_INTEGRITY = re.compile(r"sha(?:256|384|512)-[A-Za-z0-9+/]+={0,2}")
_ANNOUNCED = re.compile(r"(?:md5|sha-?[0-9]{1,3}|digest|checksum|commit)['\"]?[\s:=(\"']{1,4}\Z", re.IGNORECASE)
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_DIVIDER = re.compile(r"[-_/+]+")
_WINDOW = 256


@dataclass(frozen=True)
class Settings:
    """A run of at least ``shortest`` characters is a secret with at most ``mixed``
    characters per token, or ``uniform`` where it consists of letters of one case, which
    invented words do, too.
    """

    shortest: int = 16
    mixed: float = 2.2
    uniform: float = 1.3


def default_vocabulary() -> str:
    """The installed byte-level vocabulary; every worker has the same package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=1)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def characters_per_token(text: str, vocabulary) -> float:
    """Of the string or its lower case, whichever is written with fewer tokens.

    Capitals alone make words expensive, not random.  Long strings are encoded in windows.
    """

    def tokens(string: str) -> int:
        parts = range(0, len(string), _WINDOW)
        return sum(len(vocabulary.encode_ordinary(string[k : k + _WINDOW])) for k in parts)

    return len(text) / max(1, min(tokens(text), tokens(text.lower())))


def known_form(run: str, before: str) -> bool:
    """Whether a run has the form of a digest or of an identifier.

    Digests: hexadecimal of a usual length, integrity values, and what a digest's name
    announces.  Identifiers: UUIDs, numbers, and words, capitals and numbers joined by
    dividers or by capitals, such as names in code, paths, dates and versions.
    """
    if _UUID.fullmatch(run) or _INTEGRITY.fullmatch(run) or _ANNOUNCED.search(before):
        return True
    if len(run) in DIGEST_LENGTHS and _HEXADECIMAL.fullmatch(run):
        return True
    fields = [f for f in _DIVIDER.split(run.rstrip("=")) if f]
    if all(f.isdigit() for f in fields):
        return True
    if len(fields) > 1 and all(f.isdigit() or (f.isalpha() and _cased(f)) for f in fields):
        return True
    parts = [p for f in fields for p in _PART.findall(f)]
    letters = [p for p in parts if p.isalpha()]
    named = sum(len(p) for p in letters) >= 4 * len(letters) and len(parts) - len(letters) <= 1
    return named and len(parts) > 1


def _cased(field: str) -> bool:
    return field.islower() or field.isupper() or field.istitle()


@lru_cache(maxsize=4)
def _candidate(shortest: int) -> re.Pattern:
    return re.compile(rf"(?<![{_RUN}])[{_RUN}]{{{shortest},}}={{0,2}}")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns, per kind leftmost and apart; failing ones are dropped."""
    assigned = ASSIGN.finditer(text) if ":" in text or "=" in text else ()
    found = [("assign", m.start(), m.end()) for m in assigned if len(m.group(1)) >= 8]
    accessed = ACCESS.finditer(text) if "AKIA" in text else ()
    found += [("access", m.start(), m.end()) for m in accessed if m.end() - m.start() >= 16]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def random_spans(
    text: str, base: list[tuple[str, int, int]], vocabulary, settings: Settings = Settings()
) -> list[tuple[str, int, int]]:
    """Runs that are hard to write, of no known form, and apart from the base spans."""
    found, taken, next_taken = [], sorted((s, e) for _, s, e in base), 0
    for match in _candidate(settings.shortest).finditer(text):
        start, end, run = match.start(), match.end(), match.group()
        while next_taken < len(taken) and taken[next_taken][1] <= start:
            next_taken += 1
        if next_taken < len(taken) and taken[next_taken][0] < end:
            continue
        bare = run.rstrip("=")
        uniform = bare.isalpha() and _cased(bare)
        limit = settings.uniform if uniform else settings.mixed
        if known_form(run, text[max(0, start - 24) : start]) and not uniform:
            continue
        if characters_per_token(run, vocabulary) <= limit:
            found.append(("random", start, end))
    return found


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _listed(spans: list) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def _scan(path: str, settings: Settings):
    def run(batches):
        vocabulary = encoding(path)
        for batch in batches:
            base, added = [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append(_listed(spans))
                added.append(_listed(random_spans(text or "", spans, vocabulary, settings)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, type=_SPAN), pa.array(added, type=_SPAN)],
                names=["doc_id", "base", "added"],
            )

    return run


def find(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, base, added`` (arrays of kind, start, end).

    ``vocabulary`` is the path of a tiktoken file on every worker.  Needs ``doc_id`` and
    ``text``; other columns are not looked at.  Positions are code points, the end exclusive.
    A null or empty text has no spans.  Repeated rows are treated alike.  No shuffle, and
    time that grows in proportion with a text's length.
    """
    bound_batches(docs.sparkSession)
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(_scan(vocabulary, settings), f"doc_id long, base {SPANS}, added {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, of the rows of ``find``."""
    return found.select(
        "doc_id",
        *[count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(F.col("base"), KINDS), 256).alias("base_sha256"),
        written(F.concat("base", "added"), KINDS).alias("spans"),
    )
