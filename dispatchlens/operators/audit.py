"""Row rules, keys and references of many tables, each read once.

A row becomes a few narrow entries: the set of rules it breaks, as bits of one number, its
own key, and the keys it refers to.  Entries of all tables are counted by what they say, in
one aggregation that combines before it moves: rows that break the same rules are one
entry, and a key's own rows and all references to it meet under the key.  So unique keys
and missing parents need no join, and an order or product that a third of all rows share
moves once per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlens.functions.measures import never_null

WORD = 60  # rules per number
_OWN = 1  # the bit of a key's own table; references have the bits above


@dataclass(frozen=True)
class Reference:
    """A child column, the parent column it must be found in, and keys that need none."""

    child: str
    column: str
    parent: str
    parent_column: str
    known: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.parent_column}"


def failed_bits(failing: Iterable[Column]) -> Column:
    """The failing conditions of a row as bits, the first one lowest; unknown passes."""
    bits = [F.when(never_null(bad), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, bad in enumerate(failing)]
    if len(bits) > WORD:
        raise ValueError(f"more than {WORD} rules in a word")
    return reduce(Column.bitwiseOR, bits, F.lit(0).cast("long"))


def _words(failing: Mapping[str, Column]) -> list[dict[str, Column]]:
    names = list(failing)
    return [{n: failing[n] for n in names[k : k + WORD]} for k in range(0, len(names), WORD)]


def key_text(columns: list[str]) -> Column:
    """A key as one text, different for different keys, null parts included."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    sized = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.concat_ws(" ", *sized)


@dataclass
class _Plan:
    """Entries per table, and what their counts mean."""

    entries: dict[str, list[Column]] = field(default_factory=dict)
    meanings: list[tuple] = field(default_factory=list)  # place, domain, kind, table, rule, bit
    domains: int = 0
    rule_domains: list[int] = field(default_factory=list)

    def domain(self) -> int:
        self.domains += 1
        return self.domains

    def enter(self, table: str, domain: int, key: Column, missing: Column, part: int) -> None:
        entry = F.struct(
            F.lit(domain).alias("domain"), key.alias("key"), missing.alias("missing"), F.lit(part).alias("part")
        )
        self.entries.setdefault(table, []).append(entry)

    def mean(self, domain: int, kind: str, table: str, rule: str, bit: int = 0) -> None:
        self.meanings.append((len(self.meanings), domain, kind, table, rule, bit))


def _missing(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def audit(
    tables: Mapping[str, DataFrame],
    failing: Mapping[str, Mapping[str, Column]],
    keys: Mapping[str, list[str]],
    references: Iterable[Reference] = (),
) -> DataFrame:
    """``table_name, kind, rule, failing``: a row for everything that was looked at.

    Kinds are ``row`` (rows that break the rule), ``missing`` (rows without a complete key),
    ``key`` (rows beyond the first of a key) and ``reference`` (distinct child keys without
    a parent; null refers to nothing).  Empty tables break no rule.  ``failing`` holds the
    conditions of bad rows, over the columns of the table; unknown conditions pass.
    """
    plan, own = _Plan(), {}
    for table, rules in failing.items():
        for word in _words(rules):
            domain = plan.domain()
            plan.rule_domains.append(domain)
            plan.enter(table, domain, failed_bits(word.values()).cast("string"), F.lit(False), _OWN)
            for bit, rule in enumerate(word):
                plan.mean(domain, "row", table, rule, bit)
    for table, columns in keys.items():
        domain = own[table, tuple(columns)] = plan.domain()
        plan.enter(table, domain, key_text(columns), _missing(columns), _OWN)
        for kind in ("missing", "key"):
            plan.mean(domain, kind, table, ", ".join(columns))
    children: dict[int, int] = {}
    for ref in references:
        place = ref.parent, (ref.parent_column,)
        if place not in own:
            own[place] = plan.domain()
            plan.enter(ref.parent, own[place], key_text([ref.parent_column]), _missing([ref.parent_column]), _OWN)
        domain = own[place]
        bit = children[domain] = children.get(domain, 0) + 1
        key = key_text([ref.column])
        excused = key.isNull() | key.isin(*ref.known) if ref.known else key.isNull()
        plan.enter(ref.child, domain, key, excused, _OWN << bit)
        plan.mean(domain, "reference", ref.child, ref.name, bit)

    entries = [tables[t].select(F.inline(F.array(*found))) for t, found in plan.entries.items()]
    found = reduce(DataFrame.unionByName, entries)
    per_key = found.groupBy("domain", "key", "missing").agg(
        F.count_if(F.col("part") == _OWN).alias("rows"), F.bit_or("part").alias("seen")
    )
    of_rules = F.col("domain").isin(plan.rule_domains)
    orphan = [
        F.count_if(
            ~F.col("missing") & (F.col("seen").bitwiseAND(_OWN) == 0) & (F.col("seen").bitwiseAND(_OWN << bit) != 0)
        )
        for bit in range(1, max(children.values(), default=0) + 1)
    ]
    # A row per key domain and per set of broken rules that occurs.
    counts = per_key.groupBy("domain", F.when(of_rules, F.col("key").cast("long")).alias("bits")).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("rows") > 0, F.col("rows") - 1)).alias("repeated"),
        F.sum(F.when(F.col("missing"), F.col("rows"))).alias("missing"),
        F.array(F.lit(0).cast("long"), *orphan).alias("orphans"),
    )
    spark = found.sparkSession
    meanings = spark.createDataFrame(
        plan.meanings, "place int, domain int, kind string, table_name string, rule string, bit int"
    )
    kind, zero = F.col("kind"), F.lit(0).cast("long")
    broken = F.expr("shiftright(bits, bit) & 1") == 1
    number = (
        F.when(kind == "row", F.when(broken, F.col("rows")))
        .when(kind == "missing", F.col("missing"))
        .when(kind == "key", F.col("repeated"))
        .otherwise(F.get("orphans", "bit"))
    )
    columns = ["place", "table_name", "kind", "rule"]
    # The meanings are as many as there are rules, whatever the size of the tables.
    named = counts.join(F.broadcast(meanings), "domain").select(*columns, F.coalesce(number, zero).alias("failing"))
    return (
        named.unionByName(meanings.select(*columns, zero.alias("failing")))
        .groupBy(*columns)
        .agg(F.sum("failing").alias("failing"))
        .orderBy("place")
        .drop("place")
    )


def quarantined(
    frame: DataFrame, table: str, failing: Mapping[str, Column], key: list[str]
) -> DataFrame:
    """Rows of a table that break a rule: ``table_name, row_key, failed_rules``.

    ``failed_rules`` names the rules in their order, ``row_key`` joins the key's columns.
    """
    named = F.array_compact(F.array(*[F.when(never_null(bad), F.lit(rule)) for rule, bad in failing.items()]))
    bad = reduce(Column.__or__, [failed_bits(word.values()) != 0 for word in _words(failing)])
    return frame.filter(bad).select(
        F.lit(table).alias("table_name"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in key]).alias("row_key"),
        F.concat_ws("; ", named).alias("failed_rules"),
    )


def without_quarantined(frame: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """Rows of a table that break no rule."""
    return frame.filter(
        reduce(Column.__and__, [failed_bits(word.values()) == 0 for word in _words(failing)])
    )
