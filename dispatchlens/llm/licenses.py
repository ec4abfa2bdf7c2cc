"""Licence scans: TF-IDF cosine of statements to templates, then inheritance by path.

Every sentence of a text that has a word of licensing is compared with the templates as a
sparse TF-IDF vector.  Frequencies come from all such sentences.  Equal sentences are
compared once.  A file without a statement takes the licence of the nearest directory
above it that has a licence file.

Only built-in expressions.  The templates are a fixed table of a few dozen rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

# Notices by which well-known licences are stated.
TEMPLATES = {
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3"],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": ["Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "ISC": ["Permission to use, copy, modify, and distribute this software for any purpose is hereby granted"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3"],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "MPL-2.0": ["subject to the terms of the Mozilla Public License, v. 2.0"],
    "Proprietary": ["All rights reserved"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
# Words of which every statement has one.
WORDS = "affero apache bsd cc cc0 commons compliance copyright gpl licence licenced license licensed mit mozilla permission redistribution reserved unencumbered"
LEAST = 0.5  # cosine of a statement


def _sentences(text: Column) -> Column:
    """Sentences, numbered from 0, that have a word of licensing."""
    word = r"(?i)\b(?:" + "|".join(WORDS.split()) + r")\b"
    parts = F.split(text, r"[\n!?;|]|\.(?=\s|$)")
    numbered = F.transform(parts, lambda s, i: F.struct(i.alias("place"), s.alias("sentence")))
    # The first and the last that is not blank, where a notice stands.
    said = F.filter(numbered, lambda s: s["sentence"].rlike(r"\S"))
    edges = F.array(F.element_at(said, 1)["place"], F.element_at(said, -1)["place"])
    found = F.filter(numbered, lambda s: s["sentence"].rlike(word))
    found = F.transform(
        found,
        lambda s: F.struct(s["place"], s["sentence"], F.array_contains(edges, s["place"]).alias("edge")),
    )
    return F.when(text.rlike(word), found)


def _tokens(sentence: Column) -> Column:
    """Lower-case words and numbers; a version such as 2.0 is one."""
    words = F.split(F.lower(sentence), r"[^a-z0-9.]+")
    return F.filter(F.transform(words, lambda w: F.trim(w, F.lit("."))), lambda w: w != "")


def _templates(spark) -> DataFrame:
    rows = [(name, number, text) for name, texts in TEMPLATES.items() for number, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "license string, number int, notice string")
    return table.select("license", "number", F.explode(_tokens(F.col("notice"))).alias("term"))


def statements(texts: DataFrame) -> DataFrame:
    """``row, place, edge, license, cosine``: every sentence that states a licence; ``edge``
    where a text begins or ends with it.

    ``texts`` has ``row``, which names it, and ``sentences``.  Of templates with the same
    cosine the first licence by name counts.
    """
    spark = texts.sparkSession
    scratch = Scratch(spark, "licenses")
    found = texts.select("row", F.explode("sentences").alias("s"))
    found = found.select("row", "s.place", "s.edge", _tokens(F.col("s.sentence")).alias("tokens"))
    found = scratch.keep(found.withColumn("key", F.md5(F.array_join("tokens", " "))))
    distinct = found.groupBy("key").agg(F.count("*").alias("n"), F.first("tokens").alias("tokens"))
    terms = scratch.keep(
        distinct.select("key", "n", F.explode("tokens").alias("term"))
        .groupBy("key", "term")
        .agg(F.count("*").alias("tf"), F.first("n").alias("n"))
    )
    total = distinct.agg(F.sum("n")).first()[0] or 0
    seen = terms.groupBy("term").agg(F.sum("n").alias("df"))
    notices = _templates(spark).groupBy("license", "number", "term").agg(F.count("*").alias("tf"))
    idf = F.log((F.lit(1.0) + total) / (1 + F.coalesce(F.col("df"), F.lit(0)))) + 1
    weighted = notices.join(seen, "term", "left").select(
        "license", "number", "term", (F.col("tf") * idf).alias("v")
    )
    norms = weighted.groupBy("license", "number").agg(F.sqrt(F.sum(F.col("v") ** 2)).alias("norm"))
    notices = weighted.join(norms, ["license", "number"]).select(
        "license", "number", "term", (F.col("v") / F.col("norm")).alias("v")
    )
    vectors = terms.join(seen, "term").select("key", "term", (F.col("tf") * idf).alias("w"))
    lengths = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    products = (
        vectors.join(F.broadcast(notices), "term")
        .groupBy("key", "license", "number")
        .agg(F.sum(F.col("w") * F.col("v")).alias("product"))
    )
    scored = products.join(lengths, "key").withColumn(
        "cosine", F.round(F.col("product") / F.col("norm"), 9)
    )
    best = (
        scored.where(F.col("cosine") >= LEAST)
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
        .select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))
    )
    return found.join(best, "key").select("row", "place", "edge", "license", "cosine")


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", ""))


def _above(directory: Column) -> Column:
    """The directory and all above it, nearest first, each with its number of parts."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("place")),
    )


def scan(files: DataFrame) -> DataFrame:
    """A row per row of ``files``: ``doc_id, path, license, cosine, origin, origin_path``.

    ``files`` needs ``doc_id``, ``path`` (parts divided by ``/``) and ``text``, and may have
    ``license_file``, a boolean that tells whether a statement of the file holds for its
    directory; without it that is so where the text begins or ends with a statement.
    Other columns are not looked at.  ``origin`` is ``own`` where the file
    states its licence (the statement with the greatest cosine, then the first),
    ``inherited`` where the nearest directory above with a licence file does, and null
    where none does.  Of several licence files of a directory the one first by path
    counts.  A null or empty text states nothing; a file without path inherits nothing.
    Repeated rows are treated alike.
    """
    scratch = Scratch(files.sparkSession, "license_scan")
    given = "license_file" in files.columns
    rows = files.select(
        # Written at once, so that every reader sees the same numbers.
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.col("path").cast("string"),
        F.coalesce(F.col("license_file") if given else F.lit(None), F.lit(False)).alias("license_file"),
        _sentences(F.col("text").cast("string")).alias("sentences"),
    )
    rows = scratch.keep(rows)
    stated = statements(rows.select("row", "sentences"))
    own = scratch.keep(
        stated.groupBy("row")
        .agg(
            F.min(F.struct((-F.col("cosine")).alias("c"), "place", "license")).alias("b"),
            F.max("edge").alias("edge"),
        )
        .select("row", "edge", F.col("b.license").alias("own"), (-F.col("b.c")).alias("cosine"))
    )
    named = rows.drop("sentences").join(own, "row", "left").withColumn("directory", _directory(F.col("path")))
    if not given:
        named = named.withColumn("license_file", F.coalesce("edge", F.lit(False)))
    named = scratch.keep(named.drop("edge"))
    holding = (
        named.where("license_file and own is not null and directory is not null")
        .groupBy("directory")
        .agg(F.min(F.struct("path", "own")).alias("b"))
        .select(F.col("directory").alias("place"), F.col("b.own").alias("given"))
    )
    wanting = named.where("own is null and directory is not null").select("directory").distinct()
    nearest = (
        wanting.select("directory", F.explode(_above(F.col("directory"))).alias("a"))
        .select("directory", "a.depth", "a.place")
        .join(holding, "place")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "place", "given")).alias("b"))
        .select("directory", F.col("b.place").alias("from"), F.col("b.given").alias("given"))
    )
    joined = named.join(nearest, "directory", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("own", "given").alias("license"),
        "cosine",
        origin.alias("origin"),
        F.when(origin == "own", F.col("path")).otherwise(F.col("from")).alias("origin_path"),
    )
