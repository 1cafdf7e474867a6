"""Licence scan with DataFrame functions only.

Texts are lower-cased (A-Z) and cut into runs of letters and digits. Overlapping windows of WINDOW words, STEP
apart, get HASHES min-hashes of their SHINGLE-word shingles, one to a band; a template is retrieved where one of
its own windows (all of them, one word apart) shares a band. Then the template's shingles are looked up in the
whole document: a match holds at least CONTAINMENT of them.

Settings. Any run of WINDOW - STEP + 1 words lies within one window, so the shortest template (one shingle)
meets its window with a similarity of 1/4 at least, and a verbatim copy of WINDOW + STEP - 1 words or more meets
one with 1. With one row to a band a pair of windows of similarity s is retrieved with 1 - (1 - s)^HASHES: more
than 0.99998 at 1/4.

A gate runs before: a document that holds CONTAINMENT of a template's shingles holds one of the template's gate
words, because too few of its shingles are free of them; documents without any gate word are skipped, without
loss. Gate words and template windows are derived from the template list; it is a parameter of fixed size, and
its bands are broadcast only below MAX_BANDS rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.text import let

SHINGLE, WINDOW, STEP, HASHES, CONTAINMENT = 5, 8, 4, 40, 0.8
#: Rows of template bands that may be broadcast.
MAX_BANDS = 200_000

#: Notices by which texts state their licence, and the licence of each.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingles_of(text: str) -> list[str]:
    """Distinct shingles; fewer words than SHINGLE are one shingle."""
    words = words_of(text)
    return list(dict.fromkeys(" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))) if words else []


def gate_words(templates: list[tuple[str, str]] = TEMPLATES) -> list[str]:
    """Words without which no document can hold CONTAINMENT of a template: longest words first."""
    gates: set[str] = set()
    for _, text in templates:
        own = [set(s.split()) for s in shingles_of(text)]
        for word in sorted({w for s in own for w in s}, key=lambda w: (w not in gates, -len(w), w)):
            if sum(not s & gates for s in own) < CONTAINMENT * len(own):
                break
            gates.add(word)
    return sorted(gates)


def tokens(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[^a-z0-9]+"), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Shingles in order; an array of fewer words gives one, no word none."""

    def cut(x: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(x) - SHINGLE + 1, F.lit(1))), lambda i: F.array_join(F.slice(x, i, SHINGLE), " "))
        return F.when(F.size(x) == 0, F.array().cast("array<string>")).otherwise(many)

    return let(words, cut)


def window_bands(hashes: Column, step: int) -> Column:
    """For windows of WINDOW words, step words apart, the HASHES bands of each."""
    size, seeds = WINDOW - SHINGLE + 1, F.array(*[F.lit(k) for k in range(1, HASHES + 1)])

    def bands(window: Column) -> Column:
        return F.transform(seeds, lambda k: F.xxhash64(k, F.array_min(F.transform(window, lambda h: F.xxhash64(h, k)))))

    def windows(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(x) - size + step, F.lit(1)), F.lit(step))
        return F.flatten(F.transform(starts, lambda start: let(F.slice(x, start, size), bands)))

    return let(hashes, windows)


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, template_id, license, n_shared, n_shingles, containment): the templates that rows of docs hold.

    template_id is the place in the list. Defined results: null, empty and wordless texts match nothing; rows
    that repeat an id are each scanned; rows without an id keep the null. An empty list or table gives no rows.
    """
    spark = docs.sparkSession
    rows = [(i, name, shingles_of(text)) for i, (name, text) in enumerate(templates)]
    known = spark.createDataFrame([r for r in rows if r[2]], "template_id int, license string, wanted array<string>")
    hashed = lambda c: F.transform(c, lambda s: F.xxhash64(s))
    bands = known.select("template_id", F.explode(F.array_distinct(window_bands(hashed(F.col("wanted")), 1))).alias("band"))
    if HASHES * sum(len(r[2]) for r in rows) <= MAX_BANDS:
        bands, known = F.broadcast(bands), F.broadcast(known)
    gate = "(^|[^a-z0-9])(" + "|".join(gate_words(templates) or ["$^"]) + ")([^a-z0-9]|$)"
    text = F.coalesce(F.col(text_col), F.lit(""))
    gated = docs.select(F.col(id_col).alias("id"), text.alias("body"))
    lower = F.translate(F.col("body"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    gated = gated.where(lower.rlike(gate)).withColumn("mark", F.xxhash64("body"))
    own = gated.select("id", "mark", shingles(tokens(F.col("body"))).alias("held")).where(F.size("held") > 0)
    found = own.select("id", "mark", F.explode(window_bands(hashed(F.col("held")), STEP)).alias("band"))
    found = found.join(bands, "band").groupBy("id", "mark").agg(F.collect_set("template_id").alias("templates"))
    # collect_set holds at most one entry for each template.
    held = own.withColumn("key", F.xxhash64("id", "mark")).withColumnRenamed("id", "own_id").withColumnRenamed("mark", "own_mark")
    found = found.withColumn("key", F.xxhash64("id", "mark"))
    match = held.join(found, "key").where(F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_mark") == F.col("mark")))
    match = match.select("id", "held", F.explode("templates").alias("template_id")).join(known, "template_id")
    shared = F.size(F.array_intersect("wanted", "held"))
    match = match.select("id", "template_id", "license", shared.cast("long").alias("n_shared"), F.size("wanted").cast("long").alias("n_shingles"))
    match = match.where(F.col("n_shared") >= CONTAINMENT * F.col("n_shingles"))
    return match.select(F.col("id").alias(id_col), "template_id", "license", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def oracle() -> str:
    """DuckDB SQL for the rows of find_licenses(documents), by exact containment against all templates."""
    values = ", ".join(f"({i}, '{name}', '{' '.join(words_of(text))}')" for i, (name, text) in enumerate(TEMPLATES))
    split = lambda w: f"CASE WHEN len({w}) = 0 THEN [] WHEN len({w}) < {SHINGLE} THEN [array_to_string({w}, ' ')] ELSE [array_to_string({w}[i : i + {SHINGLE - 1}], ' ') FOR i IN range(1, len({w}) - {SHINGLE - 2})] END"
    return f"""
        WITH t(template_id, license, words) AS (VALUES {values}),
        ts AS (SELECT DISTINCT template_id::INTEGER AS template_id, license, unnest({split("w")}) AS g
               FROM (SELECT template_id, license, string_split(words, ' ') AS w FROM t)),
        tn AS (SELECT template_id, license, count(*) AS n FROM ts GROUP BY ALL),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w FROM documents),
        ds AS (SELECT DISTINCT doc_id, unnest({split("w")}) AS g FROM d),
        m AS (SELECT doc_id, template_id, count(*) AS n_shared FROM ds JOIN ts USING (g) GROUP BY ALL)
        SELECT doc_id, template_id, license, n_shared, n AS n_shingles, n_shared / n AS containment
        FROM m JOIN tn USING (template_id) WHERE n_shared >= {CONTAINMENT} * n
    """
