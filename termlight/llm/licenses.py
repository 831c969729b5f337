"""Licence notices by the Dice coefficient of word bigrams.

The units of a text are its lines and its paragraphs of several lines. A unit is normalised (lower
case, letters and digits only) and its distinct word bigrams are compared with those of each licence
template. With a threshold t, only units of between t / (2 - t) and (2 - t) / t times a template's
bigrams can reach it, so most units are dropped by their number of words before a bigram is made.
All work is built-in expressions without a shuffle. Units of fewer than two words have no bigram and
match nothing; neither do null and empty texts. Repeated rows are scanned alike, once each. An empty
table gives an empty result.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlight.llm.tables import let, plain

THRESHOLD = 0.8
#: Usual notices by licence; fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
]


def _words(text: Column) -> Column:
    return F.split(F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a template, whose words are ASCII."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """The sizes that can reach the threshold with a template of ``size`` bigrams."""
    slack = 1e-9
    return ceil(size * threshold / (2 - threshold) - slack), floor(size * (2 - threshold) / threshold + slack)


def _best(unit: Column, templates: list[tuple[str, list[str]]], threshold: float) -> Column:
    """``score, license`` of the template that is most like a unit."""
    sizes = [bounds(len(grams), threshold) for _, grams in templates]
    least, most = min(low for low, _ in sizes), max(high for _, high in sizes)

    def compared(grams: Column) -> Column:
        def score(known: list[str], low: int, high: int) -> Column:
            common = F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in known])))
            dice = common * 2.0 / (F.size(grams) + len(known))
            return F.when(F.size(grams).between(low, high), dice).otherwise(F.lit(0.0))

        scores = [F.struct(score(known, *size).alias("score"), F.lit(name).alias("license")) for (name, known), size in zip(templates, sizes, strict=True)]
        return F.array_max(F.array(*scores))

    def bigrams(words: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
        return F.array_distinct(pairs)

    # A unit of n words has at most n - 1 distinct bigrams; repeats can make it smaller, never larger.
    return let(_words(unit), lambda words: F.when(F.size(words) - 1 >= least, F.when(
        (F.size(words) - 1 <= most) | (F.size(F.array_distinct(words)) <= most + 1), let(bigrams(words), compared))))


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id`` and ``matches``, an array of ``unit, score, license`` at or above the threshold."""
    known = [(name, template_bigrams(text)) for name, text in (templates or TEMPLATES)]
    paragraphs = F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda p: F.instr(F.btrim(p, F.lit(" \t\r\n")), "\n") > 0)
    units = F.concat(F.split("text", "\n"), paragraphs)
    compared = F.transform(units, lambda unit: F.struct(unit.alias("unit"), _best(unit, known, threshold).alias("best")))
    matches = F.filter(compared, lambda u: u["best"]["score"] >= threshold)
    flat = F.transform(matches, lambda u: F.struct(u["unit"].alias("unit"), u["best"]["score"].alias("score"), u["best"]["license"].alias("license")))
    return plain(docs, id_column, text_column).select("doc_id", flat.alias("matches"))


def summary(found: DataFrame) -> DataFrame:
    """One row per document: number of matches, licences found, and the best score."""
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.sort_array(F.array_distinct("matches.license")), "|").alias("licenses"),
        F.round(F.coalesce(F.array_max("matches.score"), F.lit(0.0)), 6).alias("best_score"),
    )
