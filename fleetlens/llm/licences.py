"""Licence scan in DataFrame operations alone.

Every line of a text, and every paragraph of several lines, is normalised (A-Z folded, anything but a-z and
0-9 to one blank) and compared with the licence templates by the Dice coefficient of their word bigrams as
bags: 2 |A and B| / (|A| + |B|) >= ``DICE``. Bounds on the size come first: a passage of n bigrams can only
match templates of DICE / (2 - DICE) n to (2 - DICE) / DICE n bigrams, so a passage outside the bounds of
all templates is dropped before its bigrams are made, and a bigram meets only templates within bounds. The
template table is a fixed list of a few hundred bigrams; it is the one side that is broadcast by its size.

Nulls, ties and odd rows: a null or empty text gives no row; of templates that fit a passage alike the
first by name is taken; repeated rows give rows each; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices and texts of public licences; fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Reserved": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, str, int, int]]:
    """(licence, bigram, times, size of the template's bag)."""
    rows = []
    for name, text in sorted(templates.items()):
        words = [w for w in re.split("[^a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER))) if w]
        bag = Counter(f"{a} {b}" for a, b in zip(words, words[1:]))
        rows += [(name, gram, n, sum(bag.values())) for gram, n in sorted(bag.items())]
    return rows


def _known(spark: SparkSession, rows: list[tuple[str, str, int, int]]) -> DataFrame:
    """The template table as literal rows: the optimizer knows its true size, so passages need no shuffle
    to meet it as long as it lies below Spark's broadcast threshold."""
    if not rows:
        return spark.createDataFrame([], "licence string, gram string, times long, bag long")

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join(f"({quoted(name)}, {quoted(gram)}, {times}L, {bag}L)" for name, gram, times, bag in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS known(licence, gram, times, bag)")


def _normal(text):
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """One row per passage that matches a template: doc_id, part (line or paragraph), place, licence, dice."""
    spark: SparkSession = docs.sparkSession
    rows = template_bigrams(templates)
    sizes = sorted({r[3] for r in rows})
    known = _known(spark, rows)
    low, high = dice / (2 - dice), (2 - dice) / dice
    ranges: list[list[float]] = []
    for size in sizes:
        if ranges and size * low <= ranges[-1][1]:
            ranges[-1][1] = size * high
        else:
            ranges.append([size * low, size * high])
    in_bounds = F.lit(False)
    for least, most in ranges:
        in_bounds = in_bounds | F.col("n").between(least - 1e-9, most + 1e-9)

    def once(value):  # a generated column is made once, not again in each expression that uses it
        return F.explode(F.array(value))

    def parts(kind: str, separator: str) -> DataFrame:
        cut = docs.select(
            F.col("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.posexplode(F.split(F.col("text").cast("string"), separator)).alias("place", "raw"),
        )
        if kind == "paragraph":  # one of a single line is that line
            cut = cut.where(F.instr(F.trim("raw"), "\n") > 0)
        return cut.select("doc_id", "row", F.lit(kind).alias("part"), "place", once(_normal(F.col("raw"))).alias("plain"))

    passages = parts("line", "\n").union(parts("paragraph", "\n[ \\t\\r]*\n"))
    passages = passages.withColumn("n", F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))))
    words = passages.where(in_bounds).select("doc_id", "row", "part", "place", "n", once(F.split("plain", " ")).alias("words"))
    grams = words.select(
        "doc_id",
        "row",
        "part",
        "place",
        "n",
        F.explode(
            F.zip_with(
                F.slice("words", 1, F.size("words") - 1),
                F.slice("words", 2, F.size("words") - 1),
                lambda a, b: F.concat(a, F.lit(" "), b),
            )
        ).alias("gram"),
    )
    fits = F.col("n").cast("double").between(F.col("bag") * low - 1e-9, F.col("bag") * high + 1e-9)
    met = grams.join(known, "gram").where(fits)
    key = ["doc_id", "row", "part", "place", "licence"]
    shared = met.groupBy(*key, "gram").agg(
        F.least(F.count("*"), F.first("times")).alias("both"), F.first("n").alias("n"), F.first("bag").alias("bag")
    )
    scored = (
        shared.groupBy(*key)
        .agg((2 * F.sum("both") / (F.first("n") + F.first("bag"))).alias("dice"))
        .where(F.col("dice") >= dice)
    )
    best = scored.groupBy("doc_id", "row", "part", "place").agg(
        F.min(F.struct((-F.col("dice")).alias("order"), "licence")).alias("best")
    )
    return best.select(
        "doc_id",
        "part",
        F.col("place").cast("long").alias("place"),
        F.col("best.licence").alias("licence"),
        F.round(-F.col("best.order"), 6).alias("dice"),
    )


def scan_sql() -> str:
    """The same scan in DuckDB SQL."""
    rows = ", ".join(f"('{a}', '{b}', {c}, {d})" for a, b, c, d in template_bigrams(TEMPLATES))
    normal = f"trim(regexp_replace(translate(raw, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known(licence, gram, times, bag) AS (VALUES {rows}),
cut AS (
  SELECT doc_id, 'line' AS part, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(len(string_split(text, chr(10))))) AS place FROM documents
  UNION ALL
  SELECT * FROM (
    SELECT doc_id, 'paragraph', unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) AS raw,
           unnest(range(len(string_split_regex(text, '\\n[ \\t\\r]*\\n')))) FROM documents)
  WHERE contains(trim(raw), chr(10))),
word AS (SELECT doc_id, part, place, string_split({normal}, ' ') AS w FROM cut WHERE {normal} <> ''),
gram AS (
  SELECT doc_id, part, place, len(w) - 1 AS n, w[i] || ' ' || w[i + 1] AS gram
  FROM (SELECT *, unnest(range(1, len(w))) AS i FROM word WHERE len(w) <= 400)),
shared AS (
  SELECT g.doc_id, g.part, g.place, k.licence, g.gram, least(count(*), any_value(times)) AS both_, any_value(n) AS n, any_value(bag) AS bag
  FROM gram g JOIN known k ON g.gram = k.gram GROUP BY ALL),
scored AS (
  SELECT doc_id, part, place, licence, 2 * sum(both_) / (any_value(n) + any_value(bag)) AS dice FROM shared GROUP BY ALL)
SELECT doc_id, part, CAST(place AS BIGINT) AS place, arg_min(licence, (-dice, licence)) AS licence, round(max(dice), 6) AS dice
FROM scored WHERE dice >= {DICE} GROUP BY doc_id, part, place
"""
