"""Licence notices in texts, by Dice coefficient over word bigrams.

Lines and paragraphs are normalised and compared with the paragraphs of licence templates. A unit of a given number of bigrams can
reach the threshold only with templates of similar size, so sizes rule out most pairs before any set is compared. All
of it is column expressions inside the row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of bigrams in common from which a unit counts as the licence, in hundredths.
PER_CENT = 80

# Notices and paragraphs of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        "language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Proprietary": ("All rights reserved.",),
}


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, as ``units`` makes them of texts."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(n: int, per_cent: int) -> tuple[int, int]:
    """The sizes of sets that can reach the coefficient with a set of ``n``: the smaller set bounds what they share."""
    return -(-per_cent * n // (200 - per_cent)), (200 - per_cent) * n // per_cent


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``. A bound value is worked out once, wherever filters are moved to."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def units_sql(text: str) -> str:
    """Every line, and every paragraph of several lines, as (kind, place among its kind, unit)."""
    lines = f"transform(split({text}, '\\n'), (u, i) -> struct('line' AS kind, i AS place, u AS unit))"
    parts = f"transform(split({text}, '\\n[ \\t\\r]*\\n'), (u, i) -> struct('paragraph' AS kind, i AS place, u AS unit))"
    return f"concat({lines}, filter({parts}, p -> contains(p.unit, '\\n')))"


def matches_sql(unit: str, listed: Sequence[tuple[str, list[str]]], per_cent: int) -> str:
    """(license, dice) of the templates that a unit reaches the coefficient with."""
    bounds = [size_bounds(len(grams), per_cent) for _, grams in listed]
    low, high = min(a for a, _ in bounds), max(b for _, b in bounds)
    cases = []
    for (name, grams), (least, most) in zip(listed, bounds, strict=True):
        common = f"size(array_intersect(s, array({', '.join(map(repr, grams))})))"
        cases.append(
            f"CASE WHEN size(g) BETWEEN {least} AND {most} AND {common} * 200 >= {per_cent} * (size(g) + {len(grams)}) "
            f"THEN struct({name!r} AS license, {common} * 2D / (size(g) + {len(grams)}) AS dice) END"
        )
    known = ", ".join(repr(g) for g in sorted({g for _, grams in listed for g in grams}))
    none = "array_compact(array(CASE WHEN false THEN struct('' AS license, 0D AS dice) END))"
    # A unit that matches one template shares so many bigrams with all of them together.
    compared = f"CASE WHEN size(s) * 200 >= {per_cent} * (size(g) + {low}) THEN array_compact(array({', '.join(cases)})) ELSE {none} END"
    within = f"CASE WHEN size(g) BETWEEN {low} AND {high} THEN {_let('s', f'filter(g, x -> x IN ({known}))', compared)} ELSE {none} END"
    pairs = "array_distinct(transform(slice(w, 1, size(w) - 1), (x, i) -> concat(x, ' ', get(w, i + 1))))"
    words = f"array_remove(split(regexp_replace(lower({unit}), '[^a-z0-9]+', ' '), ' '), '')"
    return _let("w", words, f"CASE WHEN size(w) > 1 THEN {_let('g', pairs, within)} ELSE {none} END")


def license_scan(
    documents: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, per_cent: int = PER_CENT,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, license, dice, line, paragraph, n_units) of every document and licence that a line or paragraph of it matches.

    dice is the best coefficient; line and paragraph are the places, from 0, of the first line and paragraph that match (-1: none);
    n_units is how many do. Null and empty texts match nothing; rows that share an id, or have none, are taken
    together; other columns are ignored; an empty table, or no template of two words, gives an empty result.
    """
    listed = [(name, bigrams(t)) for name, texts in templates.items() for t in texts]
    listed = [(name, grams) for name, grams in listed if grams]
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    if not listed:
        rows, listed = rows.limit(0), [("", ["no template"])]
    hits = rows.selectExpr("doc_id", f"inline({units_sql('text')})").selectExpr(
        "doc_id", "kind", "place", f"inline({matches_sql('unit', listed, per_cent)})"
    )
    # Several templates of a licence may match a unit, which counts once.
    best = hits.groupBy("doc_id", "license", "kind", "place").agg(F.max("dice").alias("dice"))
    return best.groupBy("doc_id", "license").agg(
        F.max("dice").alias("dice"),
        F.coalesce(F.min(F.when(F.col("kind") == "line", F.col("place"))), F.lit(-1)).alias("line"),
        F.coalesce(F.min(F.when(F.col("kind") == "paragraph", F.col("place"))), F.lit(-1)).alias("paragraph"),
        F.count(F.lit(1)).alias("n_units"),
    )
