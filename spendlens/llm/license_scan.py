"""License scans by MinHash bands over overlapping text windows, in SQL functions only.

Texts and templates become sets of hashed five-word shingles (lower case, letters and digits only). A
template with up to 2^c shingles belongs to size class c; for each class, texts are cut into windows
of 2^(c+1) shingles, one every 2^c, so any occurrence of a template lies whole in some window. A
window that holds `CONTAINED` of a template's shingles has at least a known Jaccard similarity with
it, and the number of one-row bands is set so that they agree in a band with probability `RECALL`.
Windows and templates that agree in a band are verified: the share of the template's distinct
shingles that the window holds, counted exactly.

Two sets can only agree in a band through a shingle that both have, so texts and windows without any
template shingle are put aside before they are hashed; that loses nothing.

Defined results: a null, empty or short text (under five words) has no shingles and no license; a
template that occurs many times is one license; rows that repeat a doc_id are scanned one by one; an
empty table gives an empty result; further columns travel untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
RECALL = 0.9999

#: Public notices by which works name their license.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
}


def templates(spark: SparkSession, texts: dict[str, str] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(texts.items()), "license string, text string")


def bands(contained: float = CONTAINED, recall: float = RECALL) -> int:
    """One-row bands for the least similarity of a window that holds so much of a template.

    A template of class c has more than 2^(c-1) shingles and its window at most 2^(c+1), so the
    intersection is at least contained * 2^(c-1), the union at most 2^(c+1) and what is missing."""
    least = contained * 0.5 / (2 + (1 - contained) * 0.5)
    return math.ceil(math.log(1 - recall) / math.log(1 - least))


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """A hash for every run of so many words, in their order."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+", ""), r"[^\p{L}\p{N}]+")

    def runs(w: Column) -> Column:
        count = F.size(w) - F.when(F.element_at(w, -1) == "", 1).otherwise(0)  # a last separator ends no word
        return F.when(count < size, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), count - size), lambda i: F.xxhash64(*(w[i + k] for k in range(size))))
        )

    return _let(words, runs)


def _class_of(count: Column) -> Column:
    return F.ceil(F.log2(count)).cast("int")


def _agreeing(rows: DataFrame, keep: list[str], own: str, n: int) -> DataFrame:
    """A row for each band: the least hash of the row's shingles under the band's permutation."""
    least = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda band: F.array_min(F.transform(F.col(own), lambda h: F.xxhash64(h, band))),
    )
    return rows.select(*keep, own, F.posexplode(least).alias("band", "least"))


def matches(docs: DataFrame, known: DataFrame, contained: float = CONTAINED, recall: float = RECALL) -> DataFrame:
    """doc_id, print (of the text), license, first and last (words of the window) and containment of
    every window that holds the share of a template.

    `known` (license, text) is a list of templates: their shingles stand as literals in the plan, so
    it is read on the driver and must be a bounded list."""
    n = bands(contained, recall)
    set_of = known.select("license", F.array_distinct(shingles(F.col("text"))).alias("has")).filter(F.size("has") > 0)
    set_of = set_of.withColumn("class", _class_of(F.size("has"))).collect()
    if not set_of:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, print long, license string, first long, last long, containment double"
        )
    spark = docs.sparkSession
    sets = spark.createDataFrame([(r["license"], r["has"], r["class"]) for r in set_of], "license string, has array<long>, class int")
    by_class: dict[int, set[int]] = {}
    for r in set_of:
        by_class.setdefault(r["class"], set()).update(r["has"])

    def literal(hashes) -> Column:
        return F.lit(sorted(hashes))

    found = docs.select("doc_id", F.xxhash64("text").alias("print"), shingles(F.col("text")).alias("all")).filter(
        F.arrays_overlap("all", literal(set().union(*by_class.values())))
    )
    # all classes' windows in one pass: the shingles of a text are made once, windows are cut inside the array,
    # and only those with a template's shingle become rows, so that no row carries a whole text

    def holding(c: int, hashes: set[int]) -> Column:
        every = F.sequence(F.lit(0), F.size("all") - 1, F.lit(1 << c))
        held = F.filter(every, lambda at: F.arrays_overlap(F.slice("all", at + 1, 2 << c), literal(hashes)))
        return F.transform(
            held, lambda at: F.struct(F.lit(c).alias("class"), at.alias("at"), F.slice("all", at + 1, 2 << c).alias("window"))
        )

    none = F.array().cast("array<struct<class:int,at:int,window:array<bigint>>>")
    places = [
        F.when(F.arrays_overlap("all", literal(hashes)), holding(c, hashes)).otherwise(none)
        for c, hashes in sorted(by_class.items())
    ]
    cut = found.select("doc_id", "print", F.explode(F.concat(*places)).alias("place")).select(
        "doc_id", "print", "place.class", "place.at", "place.window"
    )
    windows = _agreeing(cut, ["doc_id", "print", "class", "at"], "window", n)
    wanted = _agreeing(sets, ["license", "class"], "has", n)
    met = windows.join(wanted, ["class", "band", "least"]).select(
        "doc_id",
        "print",
        "license",
        F.col("at").cast("long").alias("first"),
        (F.col("at") + F.size("window") + SHINGLE - 2).cast("long").alias("last"),
        (F.size(F.array_intersect("window", "has")) / F.size("has")).alias("containment"),
    )
    return met.filter(F.col("containment") >= contained).distinct()


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, text, rest (a struct of the other columns), licenses (sorted names) and windows (the
    license, the window's first and last word and its containment)."""
    known = templates(docs.sparkSession) if known is None else known
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    rows = rows.withColumn("print", F.xxhash64("text"))  # the text itself stays out of the join if it can
    found = (
        matches(rows, known)
        .groupBy(F.col("doc_id").alias("in"), F.col("print").alias("of"))
        .agg(
            F.sort_array(F.collect_set("license")).alias("licenses"),
            F.sort_array(F.collect_list(F.struct("license", "first", "last", "containment"))).alias("windows"),
        )
    )
    both = F.col("doc_id").eqNullSafe(F.col("in")) & (F.col("print") == F.col("of"))
    return rows.join(found, both, "left").select(
        "doc_id",
        "text",
        "rest",
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("windows", F.expr("array()").cast(found.schema["windows"].dataType)).alias("windows"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses")
    )


_VALUES = ",\n  ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())

#: The same windows and containments without bands: every shingle of every text against all templates.
SQL = rf"""
WITH template(license, text) AS (VALUES
  {_VALUES}
), rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), all_words AS (
  SELECT 0 AS r, license, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT license, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM template)
  UNION ALL
  SELECT r, NULL, unnest(w), generate_subscripts(w, 1)
  FROM (SELECT r, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM rows)
), all_grams AS (
  SELECT r, license, i - 1 AS p, word || ' ' || {" || ' ' || ".join(f"lead(word, {k}) OVER o" for k in range(1, SHINGLE))} AS g
  FROM all_words WINDOW o AS (PARTITION BY r, license ORDER BY i)
), template_grams AS (
  SELECT DISTINCT license, g FROM all_grams WHERE license IS NOT NULL AND g IS NOT NULL
), template_sizes AS (
  SELECT license, count(*) AS k, (1::BIGINT << ceil(log2(count(*)))::BIGINT) AS step FROM template_grams GROUP BY license
), grams AS (
  SELECT r, p, g FROM all_grams WHERE license IS NULL AND g IS NOT NULL
), hits AS (
  SELECT r, p, license, g, k, step FROM grams JOIN template_grams USING (g) JOIN template_sizes USING (license)
), placed AS (
  SELECT r, license, k, g, unnest([p // step, p // step - 1]) AS win FROM hits
), held AS (
  SELECT r, license, win FROM placed WHERE win >= 0 GROUP BY r, license, k, win HAVING count(DISTINCT g) >= {CONTAINED} * k
), found AS (
  SELECT r, count(DISTINCT license) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM held GROUP BY r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses FROM rows LEFT JOIN found USING (r)
"""
