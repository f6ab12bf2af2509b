"""Licence notices by the Dice coefficient of word bigrams, with DataFrame functions only.

Lines, the sentences of lines that have several, and blank-line-separated paragraphs of a text are normalised (a-z and 0-9 in lower
case, all else a space) and compared to the templates as sets of word bigrams. Sizes
bound the coefficient: sets of n and m bigrams reach t only if m lies between n*t/(2-t)
and n*(2-t)/t, so templates outside are never compared. A segment that reaches t with a
template also shares one of any m - ceil(t*m/(2-t)) + 1 of its bigrams; the longest ones
are looked for first, and before a text is normalised at all it must have a word of one
of them. These prunings are exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Licence notices as their publishers word them.
TEMPLATES: dict[str, str] = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "rights-reserved": "All rights reserved.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised text, in order."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(" ".join(pair) for pair in zip(words, words[1:])))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of bigrams that can reach the threshold with ``size`` of them."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def anchors(bigrams: list[str], threshold: float) -> list[str]:
    """Bigrams of which every segment that reaches the threshold has at least one."""
    least = math.ceil(len(bigrams) * threshold / (2 - threshold) - 1e-9)
    return sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - least + 1]


def marks(anchor_bigrams: list[str]) -> list[str]:
    """Words one of which stands in every text that has an anchor: the longer one of each.

    A word that contains another of them is not needed.
    """
    words = {max(a.split(" "), key=len) for a in anchor_bigrams}
    return sorted(w for w in words if not any(other in w for other in words - {w}))


def _has_any(text: Column, parts: list[str]) -> Column:
    """Whether one of the parts stands in the text, which is computed once."""
    return F.exists(F.array(text), lambda t: reduce(or_, [t.contains(p) for p in parts]))


#: Where one sentence of a line ends and the next begins.
SENTENCE_END = "[.!?;]+[ \\t\\r]+"


def segments(text: Column) -> Column:
    """Distinct lines and paragraphs; a null text has none."""
    lines, paragraphs = F.split(text, "\n", -1), F.split(text, "\n[ \t\r]*\n", -1)
    return F.array_distinct(F.when(text.contains("\n"), F.concat(lines, paragraphs)).otherwise(lines))


def with_sentences(segment: Column) -> Column:
    """The segment and, if it is a line of several sentences, each of these."""
    parts = F.filter(F.split(segment, SENTENCE_END, -1), lambda s: s != "")
    several = F.transform(F.array(parts), lambda s: F.when(F.size(s) > 1, F.concat(F.array(segment), s)).otherwise(F.array(segment)))
    line = ~segment.contains("\n") & segment.rlike(SENTENCE_END)
    return F.array_distinct(F.when(line, F.element_at(several, 1)).otherwise(F.array(segment)))


def _normalised(segment: Column) -> Column:
    """Its words between single spaces, with one at each end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(segment), "[^a-z0-9]+", " ")), F.lit(" "))


def _bigrams(normalised: Column) -> Column:
    words = F.split(F.trim(normalised), " ")
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document row and distinct matching segment: key, segment, license, dice.

    A notice that makes up nearly all of a line, of a sentence or of a paragraph is found,
    in texts of any length. Repeated rows each have their own. Each segment goes to its best template, ties to the first name. Templates need two
    words at least. Row by row, without a join; only matches are shuffled, to be distinct; texts without a match, empty
    and null ones give no row. Other columns of ``docs`` are left out.
    """
    sets = {name: template_bigrams(body) for name, body in sorted(templates.items())}
    bounds = {name: size_bounds(len(s), threshold) for name, s in sets.items()}
    wanted = sorted({a for s in sets.values() for a in anchors(s, threshold)})
    low, high = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())
    words = marks(wanted)

    def marked(segment: str) -> Column:
        return _has_any(F.lower(segment), words)

    found = (
        docs.filter(_has_any(F.lower(text), words))
        .select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), F.explode(segments(F.col(text))).alias("segment"))
        .filter(marked("segment"))
        .select("row", "k", F.explode(with_sentences(F.col("segment"))).alias("segment"))
        .filter((F.char_length("segment") >= 3) & marked("segment"))
        .select("row", "k", "segment", F.explode(F.array(_normalised(F.col("segment")))).alias("n"))
        .filter(_has_any(F.col("n"), [f" {a} " for a in wanted]))
        .select("row", "k", "segment", F.explode(F.array(_bigrams(F.col("n")))).alias("b"))
        .filter(F.size("b").between(low, high))
    )

    def scored(name: str) -> Column:
        size = F.size("b")
        dice = 2.0 * F.size(F.array_intersect(F.lit(sets[name]), F.col("b"))) / (size + len(sets[name]))
        # Sorted ascending: the negative coefficient puts the best first, then the name.
        return F.when(size.between(*bounds[name]), F.struct((-dice).alias("minus_dice"), F.lit(name).alias("license")))

    best = F.array_min(F.array_compact(F.array(*[scored(name) for name in sets])))
    return (
        found.withColumn("best", best)
        .filter(-F.col("best.minus_dice") >= threshold)
        # A sentence can stand in several lines.
        .dropDuplicates(["row", "segment"])
        .select(F.col("k").alias(key), "segment", F.col("best.license").alias("license"), (-F.col("best.minus_dice")).alias("dice"))
    )


def oracle_sql(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan without pruning, for DuckDB."""
    rows = ", ".join("('{}', ['{}'])".format(name, "', '".join(template_bigrams(body))) for name, body in sorted(templates.items()))
    return f"""
WITH t(license, tb) AS (VALUES {rows}),
s AS (SELECT doc_id, unnest(list_distinct(list_concat(string_split(text, chr(10)),
        flatten(list_transform(string_split(text, chr(10)), lambda line: CASE WHEN len(list_filter(regexp_split_to_array(line, '[.!?;]+[ \\t\\r]+'), lambda p: p <> '')) > 1
          THEN list_filter(regexp_split_to_array(line, '[.!?;]+[ \\t\\r]+'), lambda p: p <> '') ELSE [] END)),
        CASE WHEN contains(text, chr(10)) THEN regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') ELSE [] END))) AS segment FROM documents),
w AS (SELECT doc_id, segment, string_split(trim(regexp_replace(lower(segment), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM s),
b AS (SELECT doc_id, segment, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS b FROM w),
d AS (SELECT doc_id, segment, license, 2.0::DOUBLE * len(list_intersect(tb, b)) / (len(b) + len(tb)) AS dice FROM b, t WHERE len(b) > 0)
SELECT doc_id, segment, license, dice FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, segment ORDER BY dice DESC, license) AS place FROM d)
WHERE place = 1 AND dice >= {threshold}"""
