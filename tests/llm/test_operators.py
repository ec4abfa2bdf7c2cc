"""The operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dispatchlens.llm import (
    decontamination,
    fuzzy_passages,
    language_id,
    licenses,
    line_runs,
    mixing,
    near_dedup,
    nearest,
    pii,
    queries,
    token_output,
)
from dispatchlens.llm.scratch import Scratch
from dispatchlens.llm.setsketch import likely_similarity, sketch
from dispatchlens.plans.shared import fresh_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long"


def table(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, g, s, None, "k", 3) for i, t, g, s in rows], SCHEMA)


def awkward(spark):
    long = " ".join(f"w{k % 911}x{k % 13}" for k in range(30_000))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n ", "en", "a"), (4, "the same words here", "en", "b"),
        (5, "The SAME words here", None, "b"), (4, "the same words here", "en", "b"), (6, long, "en", None),
        (7, long + " end", "fr", "c"), (None, "the same words here", "en", "b"), (8, "one", "de", "c"),
        (9, "12 34 !", None, "c"), (10, "one", "de", "c"), (None, None, None, None),
    ]
    return table(spark, rows)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text or "" for r in small.collect()}


def shingle_set(text, width):
    found = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    width = min(width, len(found))
    return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)} if found else set()


def component_ids(rows, width):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_near_duplicates(spark, small, which):
    docs = small if which == "small" else awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = near_dedup.near_duplicates(docs, near_dedup.Settings(width=2)).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted(component_ids(rows, 2), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_groups_of_many_blocks(spark):
    """Chains of near copies, whose ends are far apart, and unlike texts in the same bands."""
    words = [f"w{k}" for k in range(140)]
    rows = [(k, " ".join(words[k : k + 60]), None, None) for k in range(0, 80, 2)]
    rows += [(1000 + k, " ".join([*words[:60], f"x{k}"]), None, None) for k in range(40)]
    docs = table(spark, rows)
    found = near_dedup.near_duplicates(docs, near_dedup.Settings(width=2, block=5)).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found)
    assert got == sorted(component_ids([(i, t) for i, t, _, _ in rows], 2))


def test_dedup_keeps_one_of_each_group_and_the_columns(spark):
    docs = awkward(spark)
    left = near_dedup.dedup(docs)
    assert left.columns == docs.columns
    ids = sorted((r.doc_id for r in left.collect()), key=lambda i: (i is not None, i))
    assert ids == [None, None, 1, 2, 3, 4, 6, 8, 9]


def test_sketches_merge_and_estimate():
    elements = np.random.default_rng(3).integers(0, 2**63, 1250).astype(np.uint64)
    a, b = np.unique(elements[:1000]), np.unique(elements[125:1125])
    assert (np.maximum(sketch(a), sketch(b)) == sketch(np.union1d(a, b))).all()
    likely = likely_similarity(sketch(a)[None], sketch(b)[None], np.array([1000.0]), np.array([1000.0]))
    assert abs(likely[0] - 875 / 1125) < 0.13


def test_language_of_held_out_documents(small):
    model = language_id.learn(small.where(~language_id.held_out()))
    found = language_id.predict(small, model).join(small.select("doc_id", "lang"), "doc_id")
    tested = found.where(language_id.held_out()).collect()
    right = sum(r.lang == r.lang_pred for r in tested)
    assert tested and right >= 0.95 * len(tested)
    assert all(0 <= r.score <= 1 for r in tested)


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == got[9].lang_pred == "und"
    assert got[8].lang_pred in model.languages
    nothing = language_id.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("languages", [0, 1, 2, 4, 5, 9, 40])
def test_codewords_differ(languages):
    code = language_id.codewords(languages)
    assert len({tuple(c) for c in code}) == (languages if languages != 1 else 1)


def test_mixing_reaches_targets(spark, small):
    for docs in (small, awkward(spark)):
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        sources = {}
        for r in rows:
            assert 0 <= r.taken <= 3 * r.size
            assert (r.position is None) == (r.taken == 0)
            sources.setdefault(r.source, []).append(r)
        total = sum(r.size for r in rows)
        assert abs(sum(s[0].target for s in sources.values()) - total) < 1e-6 * total
        for source in sources.values():
            assert abs(sum(r.taken for r in source) - source[0].target) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_matches_sql(spark):
    from tests.crosscheck import compare, connect

    frame = queries.queries()["op9_mixing"](spark, SF)
    assert compare(frame, connect(SF), queries.oracle_sql()["op9_mixing"]) is None


def test_curriculum_copies_whole_documents(spark, small):
    ordered = mixing.curriculum(small)
    assert ordered.columns == small.columns
    copies = {r.doc_id: r["count"] for r in ordered.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(small).collect()}
    assert all(copies.get(i, 0) == int(t / s + 0.5) for i, (t, s) in taken.items() if s)


def test_due_time_inverts_the_integral(spark):
    frame = spark.range(0, 101).selectExpr("id / 100d as t").crossJoin(
        spark.createDataFrame([(-1.0,), (-0.5,), (0.0,), (0.7,), (1.0,)], "s double")
    )
    done = (1 - F.col("s")) * F.col("t") + F.col("s") * F.col("t") ** 2
    rows = frame.select("t", mixing.due_time(done, F.col("s")).alias("back")).collect()
    assert max(abs(r.t - r.back) for r in rows) < 1e-6


def test_benchmark_passages_are_found(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three"
    filler = " ".join(f"word{k % 97} other{k % 31}" for k in range(400))
    near = item.replace("kappa", "capa").replace("gamma ", "").upper()
    rows = [
        (1, filler + " " + item + " " + filler, "en", "a"), (2, filler, "en", "a"), (3, None, "en", "a"),
        (4, "", "en", "a"), (5, near, "en", "a"), (6, "alpha beta gamma and that is all " + filler, "en", "a"),
        (None, item, "en", "a"),
    ]
    docs = table(spark, rows)
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (10, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got == {(1, 7), (5, 7), (None, 7)}
    left = decontamination.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {None, 2, 3, 4, 6}
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), benchmark).count() == 0


def test_later_part_of_an_item_is_found(spark):
    item = [f"i{k}" for k in range(120)]
    swapped = [w if k >= 30 or k % 3 else f"other{k}" for k, w in enumerate(item)]
    filler = " ".join(f"word{k % 97} other{k % 31}" for k in range(400))
    rows = [
        (1, " ".join([filler, *item[28:], filler]), "en", "a"), (2, " ".join(item[60:]), "en", "a"),
        (3, " ".join([filler, *swapped]), "en", "a"), (4, " ".join(item[:92]), "en", "a"), (5, filler, "en", "a"),
    ]
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = decontamination.contaminated(table(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 7), (3, 7), (4, 7)}
    assert decontamination.window_starts(10) == [0] and decontamination.window_starts(31) == [0, 3, 6, 7]


@pytest.mark.parametrize("rows", [0, 1, 255, 256, 1000])
def test_near_pairs_are_all_that_reach_the_least_cosine(rows):
    rng = np.random.default_rng(rows)
    window, queries = rng.integers(-3, 4, (rows, 5)), rng.integers(-3, 4, (5, 24))
    least = np.append(rng.integers(5, 30, 21), [np.inf] * 3).astype(np.float32)
    at, query, value = decontamination.near_pairs(window.astype(np.float32), queries.astype(np.float32), least)
    near = window @ queries
    want = np.nonzero(near >= least)
    assert np.array_equal(at, want[0]) and np.array_equal(query, want[1])
    assert np.array_equal(value, near[want])


def test_words_in_any_order_bound_the_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(200):
        item = decontamination.Item(1, rng.integers(0, 9, 12), np.array([], dtype=np.int64))
        other = rng.integers(0, 20, 30).tolist()
        assert item.occurring(other) == sum(t in other for t in item.terms.tolist())
        assert decontamination.common_subsequence(item.places, 12, other) <= item.occurring(other)


def test_best_cosine_of_each_window_and_item():
    at, item = np.array([0, 0, 0, 2, 2]), np.array([1, 1, 3, 0, 3])
    got = decontamination._one_per_item(at, item, np.array([0.6, 0.9, 0.7, 0.8, 0.5]), 4)
    assert [c.tolist() for c in got] == [[0, 0, 2, 2], [1, 3, 0, 3], [0.9, 0.7, 0.8, 0.5]]


def test_common_subsequence():
    places = decontamination._places(np.array([1, 2, 3, 2, 5]))
    assert decontamination.common_subsequence(places, 5, [2, 9, 3, 2, 1, 5]) == 4
    assert decontamination.common_subsequence(places, 5, []) == 0


def test_shared_passages(spark, small, texts):
    found = fuzzy_passages.shared_passages(small).collect()
    got = {r.doc_id for r in found} | {r.other_id for r in found}
    windows = {}
    for i, text in texts.items():
        own = text.lower().split()
        for k in range(len(own) - 49):
            windows.setdefault(tuple(own[k : k + 50]), set()).add(i)
    exact = {i for ids in windows.values() if len(ids) > 1 for i in ids}
    assert exact and exact <= got
    assert all(r.alike >= 0.8 and r.doc_id != r.other_id for r in found)


def test_fuzzy_passage_and_awkward_rows(spark):
    passage = [f"p{k}" for k in range(120)]
    changed = [w if k % 17 else "changed" for k, w in enumerate(passage)]
    own = lambda n: [f"d{n}w{k}" for k in range(80)]
    rows = [
        (1, " ".join(own(1) + passage + own(2)), "en", "a"), (2, " ".join(own(3) + changed), "en", "a"),
        (3, " ".join(own(4)), "en", "a"), (None, " ".join(passage), "en", "a"), (4, None, "en", "a"), (5, "", "en", "a"),
    ]
    (row,) = fuzzy_passages.shared_passages(table(spark, rows)).collect()
    assert (row.doc_id, row.other_id) == (2, 1)
    assert row.first_word <= 90 and row.last_word >= 190 and 0.8 <= row.alike < 1


def test_chains_rise_in_both():
    settings = fuzzy_passages.Settings()
    x = np.array([0, 10, 20, 30, 12, 500])
    y = np.array([100, 110, 120, 130, 5, 900])
    chains = fuzzy_passages.chains(x, y, settings)
    assert chains[0] == [0, 1, 2, 3] and sorted(map(tuple, chains[1:])) == [(4,), (5,)]


def test_chains_begin_anew_after_a_long_passage():
    settings = fuzzy_passages.Settings()
    steps = np.concatenate([np.arange(0, 200, 5), np.arange(300, 400, 5)])
    chains = fuzzy_passages.chains(steps, steps + 1000, settings)
    assert sorted(map(len, chains)) == [20, 40]
    moved = steps + np.where(steps < 300, 1000, 0)
    assert sorted(map(len, fuzzy_passages.chains(steps, moved, settings))) == [20, 40]


def test_two_passages_of_one_pair(spark):
    one, two = [f"p{k}" for k in range(200)], [f"q{k}" for k in range(90)]
    own = lambda n: [f"d{n}w{k}" for k in range(100)]
    rows = [(1, " ".join(one + own(1) + two), "en", "a"), (2, " ".join(one + own(2) + two), "en", "a")]
    found = fuzzy_passages.shared_passages(table(spark, rows)).collect()
    assert sorted((r.first_word, r.last_word, r.other_first, r.other_last) for r in found) == [
        (0, 200, 0, 200), (300, 390, 300, 390)
    ]


def test_passage_of_two_middle_documents(spark):
    passage = [f"p{k}" for k in range(60)]
    own = lambda n: [f"d{n}w{k}" for k in range(60)]
    parts = lambda n: sum((passage[k : k + 40] + own(10 * n + k) for k in range(0, 25, 5)), [])
    rows = [(n, " ".join(parts(n)), "en", "a") for n in (1, 9)]
    rows += [(n, " ".join(own(n) + passage), "en", "a") for n in (5, 6)]
    (row,) = fuzzy_passages.shared_passages(table(spark, rows)).collect()
    assert (row.doc_id, row.first_word, row.last_word, row.other_id) == (6, 60, 120, 5)


@contextmanager
def dealt_over(spark, partitions):
    """As many partitions as a shuffle has, however small they are."""
    options = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {o: spark.conf.get(o) for o in options}
    for option, value in options.items():
        spark.conf.set(option, value)
    try:
        yield
    finally:
        for option, value in before.items():
            spark.conf.set(option, value)


def test_frequent_seeds_across_partitions(spark):
    """A passage in many documents, whose seeds fill several partitions, and fuzzy groups."""
    rng = np.random.default_rng(5)
    hot = [f"h{k}" for k in range(70)]
    rows = [(k, " ".join([f"o{k}w{j}" for j in range(20)] + hot + [f"e{k}w{j}" for j in range(k % 9)])) for k in range(90)]
    groups = [[f"g{g}w{k}" for k in range(90)] for g in range(6)]
    for k in range(36):
        passage = [w if rng.random() > 0.04 else f"x{k}y{j}" for j, w in enumerate(groups[k % 6])]
        rows.append((1000 + k, " ".join([f"o{k}v{j}" for j in range(10 + k)] + passage)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    results = []
    for partitions in (1, 5, 40):
        with dealt_over(spark, partitions):
            found = fuzzy_passages.shared_passages(docs).collect()
        results.append(sorted(map(tuple, found)))
        linked = {r.doc_id for r in found} | {r.other_id for r in found}
        assert linked == {i for i, _ in rows}
        kind = lambda i: "hot" if i < 1000 else i % 1000 % 6
        assert all(kind(r.doc_id) == kind(r.other_id) for r in found)
        exact = {(r.first_word, r.last_word) for r in found if r.doc_id < 1000}
        assert exact == {(20, 90)}
    assert results[0] == results[1] == results[2]
    empty = docs.limit(0)
    assert fuzzy_passages.shared_passages(empty).count() == 0


def test_straight_chains_are_those_of_the_tree():
    settings = fuzzy_passages.Settings()
    rng = np.random.default_rng(9)
    for _ in range(200):
        x = np.unique(np.cumsum(rng.choice([1, 3, 6, 9, 20, 40, 46, 47, 90], rng.integers(1, 40))))
        # A far match off the diagonal, which nothing reaches, sends the rest to the tree.
        straight = fuzzy_passages.chains(x, x + 7, settings)
        tree = fuzzy_passages.chains(np.append(x, 10**6), np.append(x + 7, 10**5), settings)
        assert straight == [c for c in tree if c != [len(x)]]


def test_batches_of_seed_pairs_are_small():
    settings = fuzzy_passages.Settings()
    n = 20_000
    spot = np.arange(n) * 4
    columns = [np.arange(n) * 7919, np.full(n, 3), spot, np.full(n, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "doc", "spot", "root"])
    sizes = [b.num_rows for b in fuzzy_passages._keys(settings)(iter([batch]))]
    least, most = settings.span
    assert max(sizes) <= fuzzy_passages._ROWS_AT_ONCE
    near = np.searchsorted(spot >> 1, (spot >> 1) + most, side="right") - np.searchsorted(spot >> 1, (spot >> 1) + least)
    assert sum(sizes) == near.sum()


def test_seeds_of_many_texts_are_those_of_each():
    settings = fuzzy_passages.Settings()
    none = np.zeros(0, dtype=np.int64)
    texts = ["a b " * 40, "x " * 49, "x " * 50, "", " ".join(f"w{k * k % 91}" for k in range(400)), "y z " * 25]

    def rows(ids):
        batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([texts[k] for k in ids])], names=["doc", "text"])
        found = fuzzy_passages._seeds(settings, (none, none))(iter([batch]))
        return sorted(tuple(r.values()) for b in found for r in b.to_pylist())

    together = rows(list(range(len(texts))))
    assert together == sorted(r for k in range(len(texts)) for r in rows([k]))
    assert {r[1] for r in together} == {0, 2, 4, 5}


def test_every_copy_of_a_passage_in_a_document(spark):
    passage = [f"p{k}" for k in range(80)]
    own = lambda n: [f"d{n}w{k}" for k in range(60)]
    twice = passage + own(1) + passage
    for texts in ([passage, twice], [twice, passage], [passage, twice, passage]):
        rows = [(n, " ".join(own(9 + n) + text), "en", "a") for n, text in enumerate(texts)]
        found = fuzzy_passages.shared_passages(table(spark, rows)).collect()
        n = texts.index(twice)
        got = {r.first_word for r in found if r.doc_id == n} | {r.other_first for r in found if r.other_id == n}
        assert got == {60, 200}


def test_passage_of_documents_that_are_never_neighbours(spark):
    """Every seed of it has other documents first, last and between, none with all of it."""
    passage = [f"p{k}" for k in range(60)]
    own = lambda n: [f"d{n}w{k}" for k in range(60)]
    parts = lambda n: sum((passage[k : k + 40] + own(100 * n + k) for k in range(0, 25, 5)), [])
    rows = [(n, " ".join(parts(n)), "en", "a") for n in (1, 3, 5, 7, 9)]
    rows += [(n, " ".join(own(n) + passage), "en", "a") for n in (4, 6)]
    (row,) = fuzzy_passages.shared_passages(table(spark, rows)).collect()
    assert (row.doc_id, row.first_word, row.last_word, row.other_id, row.class_id) == (6, 60, 120, 4, 4)


def test_copies_that_are_never_neighbours(spark):
    """Every seed of them has other documents first, last and between."""
    passage = [f"p{k}" for k in range(60)]
    own = lambda n: [f"d{n}w{k}" for k in range(60)]
    parts = lambda n: sum((passage[k : k + 49] + own(100 * n + k) for k in range(12)), [])
    rows = [(n, " ".join(parts(n)), "en", "a") for n in (1, 3, 5, 7, 9)]
    rows += [(n, " ".join(passage), "en", "a") for n in (4, 6, 8)]
    found = fuzzy_passages.shared_passages(table(spark, rows)).collect()
    assert {(r.doc_id, r.first_word, r.last_word, r.other_id, r.class_id) for r in found} == {
        (6, 0, 60, 4, 4), (8, 0, 60, 4, 4)
    }


def test_matches_are_deleted_before_the_second_round(spark, monkeypatch):
    keep, met, held = Scratch.keep, [], []

    def watched(self, frame):
        if frame.columns == ["key", "doc", "root"]:
            held.append(met[0] in self.paths.values())
        table = keep(self, frame)
        if "before_around" in frame.columns:
            met.append(self.paths[id(table)])
        return table

    monkeypatch.setattr(Scratch, "keep", watched)
    text = " ".join(f"p{k}" for k in range(60))
    rows = [(n, f"{text} own{n}", "en", "a") for n in range(3)]
    assert fuzzy_passages.shared_passages(table(spark, rows)).count() == 3
    assert held and not any(held)


def deleted_lines(rows):
    """Every place compared with every earlier place that begins with the same line."""
    texts = [t.split("\n") for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    ids = sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    places, out = {}, {}
    for n, (i, lines) in enumerate(zip(ids, texts)):
        gone = set()
        for k, line in enumerate(lines):
            longest = 0
            for m, j in places.get(line, ()):
                other, size = texts[m], 1
                while k + size < len(lines) and j + size < len(other) and lines[k + size] == other[j + size]:
                    size += 1
                longest = max(longest, size)
            if longest >= 2 or longest and len(line.split()) >= line_runs.WORDS:
                gone |= set(range(k, k + longest))
            places.setdefault(line, []).append((n, k))
        out[i] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_runs(spark, texts):
    got = queries.queries()["op5_line_runs"](spark, SF).collect()
    wanted = deleted_lines(texts.items())
    assert len(got) == len(texts)
    for r in got:
        n, text = wanted[r.doc_id]
        assert (r.n_deleted, r.text_sha256) == (n, hashlib.sha256(text.encode()).hexdigest())


def test_line_runs_of_awkward_rows(spark):
    rows = [
        (1, "a\nb\nc\nd", "en", "a"), (2, "x\na\nb\nc\ny", "en", "a"), (3, None, "en", "a"), (4, "", "en", "a"),
        (5, "a\nb\nc\nd", "en", "a"), (6, "z\nz\nz\nz", "en", "a"), (None, "b\nc", "en", "a"),
    ]
    docs = table(spark, rows)
    runs = line_runs.repeated_runs(docs)
    left = {r.doc_id: (r.n_deleted, r.text) for r in line_runs.without_runs(docs, runs).collect()}
    wanted = deleted_lines([(i, t) for i, t, _, _ in rows if t is not None])
    assert left == wanted | {3: (0, None)}
    longest = {r.doc_id: r.longest for r in runs.collect()}
    assert longest[2] == 3 and longest[5] == 4


def test_line_runs_of_one_line_and_hot_lines(spark):
    """One-line texts, lines between other neighbours, a line in every text, a long text."""
    same, short = "this line has more than five words", "short one"
    rows = [(k, "\n".join([f"own words {k}", same, "", f"other words {k}", short, str(k)]), None, None) for k in range(60)]
    rows += [(100 + k, same if k % 2 else f"a line of five words {k // 4}", None, None) for k in range(20)]
    rows += [(200 + k, "\n".join(f"line {j % 700}" for j in range(k, 3000)), None, None) for k in (0, 5)]
    docs = table(spark, rows).withColumnsRenamed({"key": "_runs", "node": "__Doc"})
    for partitions in (1, 7):
        with dealt_over(spark, partitions):
            left = line_runs.without_runs(docs, line_runs.repeated_runs(docs)).collect()
        assert {r.doc_id: (r.n_deleted, r.text) for r in left} == deleted_lines([r[:2] for r in rows])
    assert line_runs.without_runs(docs.limit(0), line_runs.repeated_runs(docs.limit(0))).count() == 0


def test_intervals_across_partitions():
    def end(number, place, whole=False):
        return {"end": number, "doc": place, "text_key": 0, "line": 0, "whole": whole}

    marks = [end(1, 9), end(2, 5, True), end(4, 7), end(5, 3), end(7, 8), end(8, 2)]
    firsts = {e: d for e, d, _, _ in line_runs._first_places(marks)}
    assert firsts == {1: 5, 2: 5, 4: 5, 5: 3, 7: 2, 8: 2}


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in text.split(".")),
        "card": 14 <= len(digits) <= 19 and sum(t - 9 if t > 9 else t for t in twice) % 10 == 0,
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def base_digest(text):
    spans = [
        (m.start(), place, kind, m.end())
        for place, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if is_valid(kind, m.group())
    ]
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    return hashlib.sha256(joined.encode()).hexdigest(), [sum(s[2] == k for s in spans) for k in BASE]


def test_personal_data(spark, texts):
    odd = [
        "a@b.c@d.e._x@f.g.", "é😀 x@y.zz  +1 (234) 567-8901.", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255",
        "4111 1111-1111 1111, 4111111111111112", "+1" + "." * 3000, "9" * 5000, "a" * 20_000 + "@", "@.@a.b..c@d",
        "+12 345 678 901 +1-1", "1 " * 3000,
    ]
    rows = [(i, t) for i, t in texts.items()] + [(10_000 + k, t) for k, t in enumerate(odd)]
    rows += [(20_000, None), (20_001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    given = dict(rows)
    for r in pii.digest(pii.find(docs)).collect():
        digest, counts = base_digest(given[r.doc_id])
        assert (r.base_sha256, [r.n_email, r.n_ip, r.n_card, r.n_phone]) == (digest, counts), given[r.doc_id]


def test_secrets_are_added_and_nothing_else(spark):
    secret = "0641917ea4e9feb9cda83477b57ac2654884f485"
    rows = [(k, f'so it is token = "{secret[:k % 5]}{secret[k % 5:]}" and the rest') for k in range(40)]
    rows += [(100 + k, f"the word abcdefghijklmnopqrst{k} and a price of 12") for k in range(40)]
    found = pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    spans = {r.doc_id: r.spans for r in found}
    assert all(spans[k] == "secret:18:58" for k in range(40))
    assert not any(spans[100 + k] for k in range(40))
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License.\nmore", True), (2, "a/b/x", "nothing", False),
        (3, "a/b/c/y", "Licensed under the Apache License, Version 2.0.", False), (4, "z/q", "text", None),
        (5, None, None, True), (6, "a/b/LICENSE", "Licensed under CC BY-NC 4.0.", True), (7, "a/w", "", False),
        (8, "a/b/c/d/e", "the license of thought", False), (2, "a/b/x", "nothing", False),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, license_file boolean")
    got = {r.doc_id: (r.license, r.origin, r.origin_path) for r in licenses.scan(files).collect()}
    assert got == {
        1: ("MIT", "own", "a/LICENSE"), 2: ("CC-BY-NC-4.0", "inherited", "a/b"),
        3: ("Apache-2.0", "own", "a/b/c/y"), 4: (None, None, None), 5: (None, None, None),
        6: ("CC-BY-NC-4.0", "own", "a/b/LICENSE"), 7: ("MIT", "inherited", "a"),
        8: ("CC-BY-NC-4.0", "inherited", "a/b"),
    }
    assert licenses.scan(files.limit(0)).count() == 0


def test_license_files_by_content(spark):
    mit, cc, apache = "Released under the MIT License.", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 2.0."
    rows = [
        (5001, "s/5001", f"Some text.\n{mit}\n"), (5002, "s/en/5002", f"\n{cc} And more."),
        (5003, "s/en/5/5003", f"A text. {apache} It goes on."), (5004, "s/en/5/5004", "nothing"),
        (5005, "s/de/5/5005", "nothing"), (5006, "t/5006", "nothing"), (5007, "t/5007", None),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.origin_path) for r in licenses.scan(files).collect()}
    assert got == {
        5001: ("MIT", "own", "s/5001"), 5002: ("CC-BY-4.0", "own", "s/en/5002"),
        5003: ("Apache-2.0", "own", "s/en/5/5003"), 5004: ("CC-BY-4.0", "inherited", "s/en"),
        5005: ("MIT", "inherited", "s"), 5006: (None, None, None), 5007: (None, None, None),
    }


def test_licenses_are_inherited_at_every_level(spark):
    found = queries.queries()["op8_licenses"](spark, "/root/testdata/sf0.1").where("origin = 'inherited'")
    depths = {r.n for r in found.select(F.size(F.split("origin_path", "/")).alias("n")).distinct().collect()}
    assert depths == {1, 2, 3}


def test_native_operators_run_no_python(spark):
    for name in ("op7_pii", "op8_licenses", "op9_mixing"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_neighbours_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    given = {r.vec_id: r.embedding for r in rows.collect()}
    first = given[min(given)]
    extra = [(100_000, first), (100_020, first), (100_001, None), (100_002, [0.0] * 64), (100_003, [float("nan")] * 64)]
    odd = spark.createDataFrame(extra, rows.schema)
    got = {}
    for r in nearest.neighbours(rows.union(odd), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    given |= {100_000: first, 100_020: first}
    ids = np.array(sorted(given))
    matrix = np.array([given[i] for i in ids], dtype=np.float64)
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = wanted = 0
    for query, found in got.items():
        found.sort()
        score = matrix @ matrix[np.searchsorted(ids, query)]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != query][:20]
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - score[np.searchsorted(ids, v)]) < 1e-12 for _, v, s in found)
        hits += len({int(ids[k]) for k in order} & {v for _, v, _ in found})
        wanted += 20
    assert hits >= 0.95 * wanted


def test_neighbours_are_the_nearest(spark):
    """Vectors without structure, which a walk through the graph finds in part."""
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((5000, 96)).round(2) * rng.choice([1, 3], (5000, 1))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest.neighbours(rows.repartition(5), F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert len(got) == 100
    for query, found in got.items():
        score = (matrix * matrix[query]).sum(axis=1)
        order = [k for k in np.lexsort((np.arange(5000), -score)) if k != query][:5]
        assert [found[k] for k in range(1, 6)] == [(k, score[k]) for k in order]


def test_tiles_of_a_scan_and_ties():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-1, 2, (4500, 6)).astype(np.float64)
    ids, queries = np.arange(7), vectors[:7]
    columns = [np.arange(4500), [v.tobytes() for v in vectors]]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c[a : a + 700]) for c in columns], names=["node", "vector"])
        for a in range(0, 4500, 700)
    ]
    found = [r for b in nearest._scan(ids, queries, 9)(iter(batches)) for r in b.to_pylist()]
    for query in ids:
        score = vectors @ queries[query]
        best = np.lexsort((np.arange(4500), -score))[:9]
        own = [r for r in found if r["query"] == query]
        assert [(r["node"], r["score"]) for r in own] == [(k, score[k]) for k in best]


def test_the_graph_finds_most_of_the_nearest(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    chosen = F.col("vec_id") % 20 == 0
    exact, walked = (
        {(r.query_id, r.vec_id) for r in nearest.neighbours(rows, chosen, settings=s).collect()}
        for s in (None, nearest.Settings())
    )
    assert len(exact & walked) >= 0.95 * len(exact)


def test_hubs_keep_their_own_neighbours_and_the_best_reverse_ones(spark):
    own = [(0, k, 100.0 - k) for k in range(1, 25)]
    reverse = [(k, 0, float(k) / 100) for k in range(100, 1100)]
    edges = spark.createDataFrame(own + reverse, "node long, other long, score float")
    kept = {r.other for r in nearest.search_graph(edges, nearest.Settings()).where("node = 0").collect()}
    assert kept == {*range(1, 25), *range(1028, 1100)}


def test_token_output(spark, texts):
    from tokenizers import Tokenizer

    path = fresh_path(spark, "tokens_test")
    odd = [(10_000, None), (10_001, ""), (None, "a"), (3, "again")]
    rows = list(texts.items()) + odd
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenizer_path = token_output.default_tokenizer()
    token_output.write(docs, path, tokenizer_path)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_output.read(spark, path).collect())
    tokenizer, start, wanted = Tokenizer.from_file(tokenizer_path), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        wanted.append((start, i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == wanted


def test_pipeline_keeps_clean_documents(spark, texts):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} <= set(texts) and len({r.doc_id for r in rows}) > len(texts) / 2
    assert sorted(r.start for r in rows)[0] == 0
