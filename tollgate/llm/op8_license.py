"""License scans with DataFrame functions only.

Texts become lower-cased words (runs of letters and digits), words become hashes of five-word
shingles.  For each length class of templates, a text is cut into overlapping windows: twice
the class's length, one length apart, so that every passage as long as a template lies whole
in some window.  A window and a template that share a band (the minimum of one of BANDS hash
functions over their shingles) become a candidate; candidates are verified by exact shingle
containment: the share of the template's distinct shingles in the window, CONTAINMENT or more.

Bands: a template of class length L has more than L / 2 shingles and a window at most 2 L, so a
window that holds 0.8 of a template has a Jaccard similarity J of at least 0.8 / 4.2 > 0.19
(0.4 L of at most 2.1 L).  With one row a band and 64 bands a match is retrieved with
probability 1 - (1 - J)^64 > 0.9999986.

A window can only share a band with a template if one of its shingles is one of the template's,
so signatures are made only for windows with at least one template shingle; this leaves out
nothing.  Texts are scanned in place, row by row; only matches and the small template table
(TEMPLATES, a fixed list) are joined, and only hashes of candidate windows leave the scan.

Defined cases: null and empty texts have no words and give no rows; a text shorter than a
window is one window; null doc_ids and repeated rows are scanned alike (equal doc_id, template
rows of repeated documents are merged); a template of fewer than five words raises ValueError;
empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .registry import register

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64

# fixed values: notices of public licenses
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _shingle_hash(words: Column, i: Column) -> Column:
    """Hash of the five words from place i (from 0)."""
    return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])


def _template_table(spark: SparkSession, templates) -> DataFrame:
    """(template, t_shingles, n, length): distinct shingle hashes and the length class."""
    rows = [(name, template_words(text)) for name, text in templates]
    if any(len(w) < SHINGLE for _, w in rows):
        raise ValueError(f"a template needs at least {SHINGLE} words")
    listed = [F.struct(F.lit(n).alias("template"), F.array(*map(F.lit, w)).alias("words")) for n, w in rows]
    t = spark.range(1).select(F.inline(F.array(*listed)))
    places = F.sequence(F.lit(0), F.size("words") - SHINGLE)
    t = t.select("template", (F.size("words") - SHINGLE + 1).alias("m"),
                 F.array_distinct(F.transform(places, lambda i: _shingle_hash(F.col("words"), i))).alias("t_shingles"))
    length = F.pow(F.lit(2.0), F.ceil(F.log2("m"))).cast("int")
    return t.select("template", "t_shingles", F.size("t_shingles").alias("n"), length.alias("length"))


def _bands(shingles: Column) -> Column:
    """The BANDS minima: entry b is the minimum of hash function b over the shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))))


def license_matches(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template, containment (best window), n_windows (matching windows), first_word
    (word place of the first matching window)."""
    t = _template_table(spark, templates)
    known = [(r.length, r.h) for r in t.select("length", F.explode("t_shingles").alias("h")).distinct().collect()]  # of the fixed list
    lengths = sorted({length for length, _ in known})
    words = F.expr(r"filter(split(lower(text), '[^\\p{L}\\p{N}]+'), w -> w <> '')")
    # Rows are not filtered before the outer explode: a filter on an array would be pushed down
    # and the array made again for each of its elements.
    scanned = docs.select("doc_id", words.alias("words"))
    places = F.sequence(F.lit(0), F.size("words") - SHINGLE)
    hashes = sorted({h for _, h in known})
    # word places of template shingles: the only pass over all words
    hits = F.filter(places, lambda i: _shingle_hash(F.col("words"), i).isin(hashes))
    scanned = scanned.select("doc_id", "words", F.when(F.size("words") >= SHINGLE, hits).alias("hits"))
    shingles = F.transform(places, lambda i: _shingle_hash(F.col("words"), i))
    scanned = scanned.select("doc_id", "hits", F.when(F.size("hits") > 0, shingles).alias("shingles"))
    windows = F.explode_outer(F.flatten(F.array(*[
        _windows(length, [h for x, h in known if x == length]) for length in lengths])))
    windows = scanned.select("doc_id", "shingles", windows.alias("w")).where("w IS NOT NULL")
    windows = windows.select("doc_id", "w.length", (F.col("w.window") * F.col("w.length")).alias("start"),
                             F.array_distinct(F.slice("shingles", F.col("w.window") * F.col("w.length") + 1, 2 * F.col("w.length"))).alias("s"))
    windows = windows.withColumn("bands", _bands(F.col("s")))
    t_bands = t.withColumn("t_bands", _bands(F.col("t_shingles"))).withColumnRenamed("length", "t_length")
    # windows and templates of a class that share a band: the template side is the fixed list
    bands = t_bands.select("template", "t_shingles", "n", "t_length", F.posexplode("t_bands").alias("b", "v")).groupBy(
        F.col("t_length"), "b", "v").agg(F.collect_list(F.struct("template", "t_shingles", "n")).alias("ts"))
    keyed = windows.select("doc_id", "length", "start", "s", F.posexplode_outer("bands").alias("b", "v"))
    found = keyed.join(F.broadcast(bands), (keyed.length == bands.t_length) & (keyed.b == bands.b) & (keyed.v == bands.v))
    found = found.select("doc_id", "length", "start", F.explode("ts").alias("t"),
                         "s").select("doc_id", "start", "t.template", "t.n",
                                     F.size(F.array_intersect("s", "t.t_shingles")).alias("common"))
    found = found.where(F.col("common") >= F.lit(containment) * F.col("n"))
    return (found.groupBy("doc_id", "template")
            .agg(F.max(F.col("common") / F.col("n")).alias("containment"),
                 F.count_distinct("start").alias("n_windows"), F.min("start").cast("long").alias("first_word")))


def _windows(length: int, hashes: list[int]) -> Column:
    """(length, number) of the windows of a length class that hold one of its templates'
    shingles: place p lies in window p div length and in the one before."""
    own = F.filter("hits", lambda i: F.element_at("shingles", i + 1).isin(hashes))
    both = F.flatten(F.transform(own, lambda i: F.array(F.floor(i / length), F.floor(i / length) - 1)))
    return F.transform(F.filter(F.array_distinct(both), lambda w: w >= 0),
                       lambda w: F.struct(F.lit(length).alias("length"), w.cast("int").alias("window")))


def oracle(templates=TEMPLATES, containment: float = CONTAINMENT) -> str:
    """Exact containment of every template in every window, without signatures."""
    rows = []
    for name, text in templates:
        words = template_words(text)
        m = len(words) - SHINGLE + 1
        length = 1 << (m - 1).bit_length()
        shingles = {" ".join(words[i:i + SHINGLE]) for i in range(m)}
        rows += [f"('{name}', '{s}', {len(shingles)}, {length})" for s in sorted(shingles)]
    return f"""
WITH t(template, shingle, n, length) AS (VALUES {', '.join(rows)}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w
      FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, unnest(range(0, len(w) - {SHINGLE - 1})) AS i, w FROM d WHERE len(w) >= {SHINGLE}),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {SHINGLE}], ' ') AS shingle FROM s),
h AS (SELECT DISTINCT doc_id, template, n, shingle, length, unnest([i // length, i // length - 1]) AS win
      FROM g JOIN t USING (shingle)),
c AS (SELECT doc_id, template, n, length, win, count(DISTINCT shingle) AS common FROM h WHERE win >= 0 GROUP BY ALL)
SELECT doc_id, template, max(CAST(common AS DOUBLE) / n) AS containment, CAST(count(*) AS BIGINT) AS n_windows,
       CAST(min(win * length) AS BIGINT) AS first_word
FROM c WHERE common >= {containment} * n GROUP BY doc_id, template
"""


ORACLE = oracle()


@register("op8_license_scan", ORACLE)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(spark, table(spark, sf_dir, "documents"))
