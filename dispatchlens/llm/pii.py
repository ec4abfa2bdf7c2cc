"""Personal data in texts, by base patterns and by weak supervision.

The base patterns find e-mail addresses, IP addresses, card and phone numbers.  Beyond
them, looser patterns propose candidates; labelers (the shape, a gazetteer of words, the
context before, the make-up of the characters, a checksum) vote for or against each or
abstain.  Expectation maximisation over the counts of vote patterns estimates how reliable
each labeler is, and from its beliefs a classifier over span features is trained.  What
the classifier takes for personal data is added to the base spans.

Only built-in expressions.  A text's spans stay with its row: no shuffle carries text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .spans import apart_from, let, running

# The base patterns.  A match starts where its run of characters starts, or
# where the last match ended; possessive quantifiers keep long runs linear.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_WORD = r"(?<![A-Za-z0-9_])"
_END = r"(?![A-Za-z0-9_])"
CANDIDATES = {
    "secret": _WORD + r"(?=[A-Za-z_-]{0,40}[0-9])[A-Za-z0-9_-]{16,}+",
    "number": _WORD + r"(?<![+.])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})" + _END,
    "contact": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
}
KINDS = [*BASE, *CANDIDATES]
# Words that announce personal data, and words that announce other numbers.
ANNOUNCING = "call contact credential email fax key login mail mobile passwd password phone pwd reach secret ssn tel token"
OTHER = "build checksum commit digest hash isbn issn md5 order page revision sha sha1 sha256 uuid version"
LABELERS = ["shape", "gazetteer", "context", "makeup", "checksum"]
FEATURES = ["known", "announced", "assigned", "other", "long", "digits", "upper", "hex", "separated"]
_MARK, _INSTEAD = "\ue000", "\ue001"
_ROUNDS = 8


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches of a pattern as structs of kind, start, end, text and what stands before.

    Matches are set between marks and the text is split at them; every second piece is
    a match, and lengths add up to positions in code points.
    """
    pieces = F.split(
        F.regexp_replace(F.translate(text, _MARK, _INSTEAD), f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int,text:string,before:string>>")
    zero = F.lit(0).cast("long")

    def spans(p: Column) -> Column:
        starts = running(F.transform(p, lambda piece: F.length(piece).cast("long")), zero, lambda a, b: a + b)
        matches = F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1)), F.lit(2))

        def span(i: Column, at: Column) -> Column:
            start, found = F.get(at, i).cast("int"), F.get(p, i)
            return F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(found)).alias("end"),
                found.alias("text"), F.substring(F.get(p, i - 1), -32, 32).alias("before"),
            )

        return let(starts, lambda at: F.transform(matches, lambda i: span(i, at)))

    found = let(pieces, lambda p: F.when(F.size(p) > 1, spans(p)).otherwise(none))
    return found


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""

    def value(digit: Column, place: Column) -> Column:
        number = digit.cast("int")
        twice = number * 2
        return F.when(place % 2 == 0, number).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    values = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), value)
    return F.aggregate(values, F.lit(0), lambda x, y: x + y) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    text = span["text"]
    if kind == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.try_to_number(p, F.lit("999")) <= 255))
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda span: _valid(kind, span)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def base_spans(text: Column) -> Column:
    """All base spans of a text, as an array; the kinds are found independently."""
    found = []
    for kind, pattern in BASE.items():
        spans = F.filter(_found(text, kind, pattern), _check(kind))
        plain = F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"]))
        empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
        hinted = text.contains(_HINTS[kind]) if _HINTS[kind] else text.rlike("[0-9]")
        found.append(F.when(hinted, plain.cast(empty_type())).otherwise(empty))
    return F.concat(*found)


def empty_type() -> str:
    return "array<struct<kind:string,start:int,end:int>>"


def _words(words: str) -> str:
    return r"(?i)(?:" + "|".join(words.split()) + r")\b[^A-Za-z0-9]*$"


def _described(span: Column) -> Column:
    """A candidate with its labelers' votes (1, -1, 0) and its features (0 or 1)."""
    text, before = span["text"], span["before"]
    announced, other = before.rlike(_words(ANNOUNCING)), before.rlike(_words(OTHER))
    assigned = before.rlike(r"[:=]\s*[\"']?$")
    digits = F.length(_digits(text)) / F.length(text)
    hexadecimal = text.rlike("^[0-9a-f]+$")
    known = (
        text.rlike(r"^AKIA[0-9A-Z]{16}$") | text.rlike("^[0-9a-f]{32,}$") | (span["kind"] == "contact")
        | text.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    )
    mixed = text.rlike("[A-Za-z]") & digits.between(0.15, 0.9)
    votes = {
        "shape": F.when(known, 1).when(text.rlike("[A-Za-z]{9}"), -1),
        "gazetteer": F.when(announced, 1).when(other, -1),
        "context": F.when(assigned, 1).when(before.rlike("[A-Za-z] $"), -1),
        "makeup": F.when(mixed | (span["kind"] != "secret"), 1).otherwise(-1),
        "checksum": F.when(
            (span["kind"] == "secret") & text.rlike("^[0-9]{14,19}$"), F.when(luhn(text), 1).otherwise(-1)
        ),
    }
    features = {
        "known": known,
        "announced": announced,
        "assigned": assigned,
        "other": other,
        "long": F.length(text) >= 24,
        "digits": digits >= 0.3,
        "upper": text.rlike("^[0-9A-Z]+$"),
        "hex": hexadecimal,
        "separated": text.rlike("[ _.()-]"),
    }
    return F.struct(
        span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
        *[F.coalesce(votes[v], F.lit(0)).cast("int").alias(v) for v in LABELERS],
        *[features[f].cast("int").alias(f) for f in FEATURES],
    )


def _candidates(text: Column, base: Column) -> Column:
    """Described candidates that overlap no base span."""
    found = [_found(text, kind, pattern) for kind, pattern in CANDIDATES.items()]
    hinted = [text.rlike("[0-9]"), text.rlike("[0-9]{3}[) .-]"), text.rlike(r"[\[(]at[\])]")]
    none = F.array().cast("array<struct<kind:string,start:int,end:int,text:string,before:string>>")
    spans = F.concat(*[F.when(h, f).otherwise(none) for h, f in zip(hinted, found)])
    return F.transform(apart_from(spans, base), _described)


def _log_odds(p: float) -> float:
    from math import log

    p = min(max(p, 0.01), 0.99)
    return log(p / (1 - p))


def _belief(prior: float, reliability: dict[str, float]) -> Column:
    """The chance that a candidate is personal data, given its votes."""
    odds = F.lit(_log_odds(prior))
    for name in LABELERS:
        odds = odds + F.col(name) * _log_odds(reliability[name])
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame) -> tuple[float, dict[str, float]]:
    """Prior and reliability of each labeler, by expectation maximisation.

    ``patterns`` has the votes and ``n``, the number of candidates with them: a row per
    combination, a few thousand at most.  A labeler is right about a candidate it votes on
    with its reliability, whatever the others say.
    """
    prior, reliability = 0.5, {name: 0.75 for name in LABELERS}
    for _ in range(_ROUNDS):
        believed = patterns.withColumn("belief", _belief(prior, reliability))
        right = {
            name: F.sum(
                F.when(F.col(name) > 0, F.col("n") * F.col("belief")).when(
                    F.col(name) < 0, F.col("n") * (1 - F.col("belief"))
                )
            )
            for name in LABELERS
        }
        row = believed.agg(
            F.sum("n").alias("all"),
            F.sum(F.col("n") * F.col("belief")).alias("true"),
            *[right[name].alias(f"right_{name}") for name in LABELERS],
            *[F.sum(F.col("n") * F.abs(F.col(name))).alias(f"votes_{name}") for name in LABELERS],
        ).first()
        if not row["all"]:
            break
        prior = (row["true"] + 1) / (row["all"] + 2)
        for name in LABELERS:
            votes, hits = row[f"votes_{name}"] or 0, row[f"right_{name}"] or 0.0
            # Better than chance: the labelers are written to be.
            reliability[name] = max(0.55, (hits + 3) / (votes + 4))
    return prior, reliability


def train(patterns: DataFrame, prior: float, reliability: dict[str, float]) -> tuple[float, dict]:
    """Weights of a span classifier over the features, from the beliefs as soft labels."""
    believed = patterns.withColumn("belief", _belief(prior, reliability))
    yes, no = F.col("n") * F.col("belief"), F.col("n") * (1 - F.col("belief"))
    row = believed.agg(
        F.sum(yes).alias("yes"),
        F.sum(no).alias("no"),
        *[F.sum(yes * F.col(f)).alias(f"yes_{f}") for f in FEATURES],
        *[F.sum(no * F.col(f)).alias(f"no_{f}") for f in FEATURES],
    ).first()
    total_yes, total_no = row["yes"] or 0.0, row["no"] or 0.0
    weights = {}
    for f in FEATURES:
        p = ((row[f"yes_{f}"] or 0.0) + 1) / (total_yes + 2)
        q = ((row[f"no_{f}"] or 0.0) + 1) / (total_no + 2)
        weights[f] = (_log_odds(p) - _log_odds(q), _log_odds(1 - q) - _log_odds(1 - p))
    bias = _log_odds((total_yes + 1) / (total_yes + total_no + 2))
    return bias, weights


def _score(span: Column, bias: float, weights: dict) -> Column:
    """Log-odds of a candidate under the classifier (features taken as independent).

    A feature that is there tells more than one that is missing: kinds differ in theirs.
    """
    terms = [
        F.when(span[f] == 1, F.lit(on)).otherwise(F.lit(-off) * 0.25) for f, (on, off) in weights.items()
    ]
    return reduce(lambda x, y: x + y, terms, F.lit(bias))


def _written(spans: Column) -> Column:
    """Spans as text, by start, then kind in the order of ``KINDS``."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(order, s["kind"]).alias("place"),
            s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, base, added`` (arrays of kind, start, end).

    Needs ``doc_id`` and ``text``; other columns are not looked at.  Positions are code
    points, the end exclusive.  A null text is an empty one and has no spans.  Without any
    candidate nothing is added.  Repeated rows are treated alike.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = scratch.keep(
        rows.select("doc_id", "base", _candidates(F.col("text"), F.col("base")).alias("candidates"))
    )
    columns = [*LABELERS, *FEATURES]
    each = rows.select(F.explode("candidates").alias("c")).select(*[F.col(f"c.{c}") for c in columns])
    patterns = scratch.keep(each.groupBy(*columns).agg(F.count("*").alias("n")))
    prior, reliability = estimate(patterns)
    bias, weights = train(patterns, prior, reliability)
    taken = F.filter("candidates", lambda c: _score(c, bias, weights) >= 0)
    added = F.transform(taken, lambda c: F.struct(c["kind"], c["start"], c["end"])).cast(empty_type())
    return rows.select("doc_id", "base", added.alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, of the rows of ``find``."""
    counts = [
        F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "added")).alias("spans"),
    )
