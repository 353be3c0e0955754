"""Licence notices found by the Dice coefficient over word bigrams.

Texts are cut into paragraphs (lines).  A paragraph and a template are
normalised alike (lower case, letters and digits only, one space between words)
and compared as sets of word bigrams: 2 * common / (bigrams + bigrams).  A
coefficient of ``PERCENT`` bounds the size of a paragraph from both sides, so a
paragraph meets only templates whose bounds its size is within; most meet none
and are dropped before any bigram is made.

The templates are a fixed list, spread to the sizes they admit: a few thousand
rows at most, which is what is broadcast.

Null and empty texts and paragraphs of one word have no bigrams and match
nothing.  Among equal coefficients the first licence by name wins.  Repeated
rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 80

# Wording of public licences' notices and permissions, by licence.
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def _template_bigrams() -> list[tuple[str, int, list[str]]]:
    """(licence, number of the template, its bigrams)."""
    rows = []
    for licence, texts in TEMPLATES.items():
        for number, text in enumerate(texts):
            words = re.findall("[a-z0-9]+", text.lower())
            rows.append((licence, number, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return rows


def _sizes(bigrams: int, percent: int) -> range:
    """Sizes of sets that can reach the coefficient with a set of this size."""
    return range(-(-percent * bigrams // (200 - percent)), (200 - percent) * bigrams // percent + 1)


def paragraph_bigrams(docs: DataFrame, key: str, text: str, longest: int) -> DataFrame:
    """(doc_id, unit_no, start, bigrams, size) of paragraphs of few enough words."""
    rows = docs.select(F.col(key).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("unit_no", "unit"))
    plain = F.btrim(F.regexp_replace(F.lower("unit"), "[^a-z0-9]+", " "))
    words = rows.select("doc_id", "unit_no", F.split(plain, " ").alias("words")).where(F.size("words") >= 2)
    # Repeated bigrams count once, so a long paragraph can have few; words bound nothing from above.
    few = F.when(F.size("words") > longest + 1, F.size(F.array_distinct("words")) <= longest + 1).otherwise(True)
    pairs = F.expr("array_distinct(transform(sequence(1, size(words) - 1), i -> concat(words[i - 1], ' ', words[i])))")
    return words.where(few).select("doc_id", "unit_no", pairs.alias("bigrams")).withColumn("size", F.size("bigrams"))


def license_matches(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, unit_no, licence, template, common, size, template_size) of matching paragraphs."""
    templates = _template_bigrams()
    admitted = [(name, number, size, bigrams, len(bigrams)) for name, number, bigrams in templates for size in _sizes(len(bigrams), percent)]
    longest = max(row[2] for row in admitted)
    table = docs.sparkSession.createDataFrame(
        admitted, "licence string, template int, size int, template_bigrams array<string>, template_size int"
    )
    met = paragraph_bigrams(docs, key, text, longest).join(F.broadcast(table), "size")
    common = F.size(F.array_intersect("bigrams", "template_bigrams"))
    return (
        met.withColumn("common", common)
        .where(200 * F.col("common") >= percent * (F.col("size") + F.col("template_size")))
        .select("doc_id", "unit_no", "licence", "template", "common", "size", "template_size")
    )


def best_by_paragraph(matches: DataFrame) -> DataFrame:
    """(doc_id, unit_no, licence, dice_permille): the best licence of each paragraph."""
    permille: Column = F.floor(2000 * F.col("common") / (F.col("size") + F.col("template_size"))).cast("long")
    rows = matches.withColumn("dice_permille", permille)
    first = F.min(F.struct((-F.col("dice_permille")).alias("worse"), "licence")).alias("best")
    return (
        rows.groupBy("doc_id", "unit_no")
        .agg(first)
        .select("doc_id", F.col("unit_no").cast("long").alias("unit_no"), "best.licence", (-F.col("best.worse")).alias("dice_permille"))
    )


def sql(percent: int = PERCENT) -> str:
    """The best licence of each paragraph in DuckDB SQL over ``documents`` (unique doc_id)."""
    rows = ", ".join(f"('{name}', {bigrams!r})" for name, _, bigrams in _template_bigrams())
    return f"""
WITH templates(licence, bigrams) AS (VALUES {rows}),
units AS (
  SELECT doc_id, i - 1 AS unit_no, string_split(trim(regexp_replace(lower(parts[i]), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
),
pairs AS (
  SELECT doc_id, unit_no, list_distinct(list_transform(range(2, len(words) + 1), lambda k: words[k - 1] || ' ' || words[k])) AS bigrams
  FROM units WHERE len(words) >= 2
),
scored AS (
  SELECT doc_id, unit_no, licence, len(list_intersect(p.bigrams, t.bigrams)) AS common, len(p.bigrams) + len(t.bigrams) AS sizes
  FROM pairs p JOIN templates t
    ON 200 * least(len(p.bigrams), len(t.bigrams)) >= {percent} * (len(p.bigrams) + len(t.bigrams))
)
SELECT doc_id, unit_no::BIGINT AS unit_no, licence, dice_permille FROM (
  SELECT doc_id, unit_no, licence, floor(2000 * common / sizes)::BIGINT AS dice_permille,
    row_number() OVER (PARTITION BY doc_id, unit_no ORDER BY floor(2000 * common / sizes) DESC, licence) AS place
  FROM scored WHERE 200 * common >= {percent} * sizes
) WHERE place = 1"""
