"""Licence statements in texts, by DataFrame operations only.

Every line of a text, and the text as a whole, is normalised to words and
compared with licence templates by Dice's coefficient over word bigrams,
repeats counted: twice the bigrams in common over all bigrams of both. Two
sizes that are too far apart cannot reach the least score whatever they hold,
so a unit is compared with the templates of about its size only, and a whole
text that is longer than any template admits is not cut up at all.

Bigrams meet the templates' by a join with a table that is bounded by the
templates; what is counted and shuffled is only what they have in common.

A statement inside a longer unit is found as a passage: any run of words of the
text, across its lines, that reaches the least score. The best run starts and
ends with a bigram of the template, so only the places of those are compared.
A run misses at most ``size - fewest`` bigrams of a template, so a text without
any of its ``size - fewest + 1`` rarest ones holds no such run; as a line is a
run too, only texts that have them are stored and looked at further. Complete
licences are found by their sections in the same way.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.shared import staged

#: Below this coefficient a unit states no licence.
LEAST_SCORE = 0.75
#: The unit numbers of a whole text and of a passage; lines count from 0.
WHOLE = -1
PASSAGE = -2

# Customary licence statements, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify,"
        " merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the"
        " LICENSE file.",
    ),
    ("ISC", "Licensed under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
)

#: Customary file headers that are looked for as passages only.
HEADERS = tuple(
    (
        name,
        "This program is free software: you can redistribute it and/or modify it under the terms"
        f" of the GNU {kind}General Public License as published by the Free Software Foundation,"
        f" either version {version} of the License, or (at your option) any later version.",
    )
    for name, kind, version in (
        ("GPL-2.0", "", "2"),
        ("LGPL-2.1", "Lesser ", "2.1"),
        ("LGPL-3.0", "Lesser ", "3"),
        ("AGPL-3.0", "Affero ", "3"),
    )
)

#: Licences whose complete text lies in ``license_texts``. Of equal matches the earlier one
#: counts, so a section that licences share is given to the first of them.
COMPLETE = (
    "MIT",
    "ISC",
    "BSD-2-Clause",
    "BSD-3-Clause",
    "Unlicense",
    "Apache-2.0",
    "MPL-2.0",
    "CC0-1.0",
    "GPL-2.0",
    "GPL-3.0",
    "LGPL-2.1",
    "LGPL-3.0",
    "AGPL-3.0",
)
#: Texts of up to so many words are one template; longer ones are cut at paragraphs.
WHOLE_WORDS = 300
SECTION_WORDS = 100

#: Templates of so many bigrams are looked for by how dense their bigrams lie in a piece of text.
LARGE = 40
PIECE = 100

_WORD = "[A-Za-z0-9]+"


def complete_text(name: str) -> str:
    return files(__package__).joinpath("license_texts", f"{name}.txt").read_text("utf-8")


def sections(text: str) -> list[str]:
    """The paragraphs of a licence, joined to sections of ``SECTION_WORDS`` words or more.

    Lines that hold a place for the holder's name are left out of short texts.
    """
    paragraphs = re.split(r"\n\s*\n", text.strip())
    if len(re.findall(_WORD, text)) <= WHOLE_WORDS:
        return ["\n\n".join(p for p in paragraphs if not re.match(r"(Copyright \(c\) )?<", p))]
    cut = [""]
    for paragraph in paragraphs:
        if len(re.findall(_WORD, cut[-1])) >= SECTION_WORDS:
            cut.append("")
        cut[-1] += f"{paragraph}\n\n"
    if len(re.findall(_WORD, cut[-1])) < SECTION_WORDS:
        cut[-2:] = ["".join(cut[-2:])]
    return cut


def complete_templates(names=COMPLETE) -> tuple:
    return tuple((name, section) for name in names for section in sections(complete_text(name)))


def template_bigrams(templates=TEMPLATES, least_score: float = LEAST_SCORE) -> list[tuple]:
    """(template, license, bigram, times, size, fewest, most) per bigram of each template.

    A unit of fewer than ``fewest`` or more than ``most`` bigrams cannot reach
    ``least_score`` with the template.
    """
    rows = []
    for number, (name, statement) in enumerate(templates):
        words = [word.lower() for word in re.findall(_WORD, statement)]
        size = len(words) - 1
        fewest = math.ceil(least_score / (2 - least_score) * size - 1e-9)
        most = math.floor((2 - least_score) / least_score * size + 1e-9)
        for bigram, times in Counter(map(" ".join, zip(words, words[1:]))).items():
            rows.append((number, name, bigram, times, size, fewest, most))
    return rows


def license_units(
    docs: DataFrame,
    templates=TEMPLATES,
    least_score: float = LEAST_SCORE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Units that state a licence: doc_id, text_hash, unit, license, score, template.

    A unit has a row for every template that it reaches.
    """
    spark: SparkSession = docs.sparkSession
    rows = template_bigrams(templates, least_score)
    most = max((row[6] for row in rows), default=0)
    table = spark.createDataFrame(
        rows,
        "template int, license string, bigram string, times int, size int, fewest int, most int",
    )
    text = F.col("text")
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    # Rows may be equal, so each has a number of its own while its bigrams are counted.
    texts = named.filter(text.isNotNull()).withColumns(
        {"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    line = F.posexplode(F.split(text, "\n")).alias("unit", "line")
    lines = texts.select("doc_id", "text_hash", "row", line)
    short = F.regexp_count(text, F.lit(_WORD)) <= most + 1
    whole = texts.filter(F.contains(text, F.lit("\n")) & short).select(
        "doc_id", "text_hash", "row", F.lit(WHOLE).alias("unit"), text.alias("line")
    )
    cleaned = F.lower(F.btrim(F.regexp_replace("line", f"[^{_WORD[1:-2]}]+", " ")))
    units = lines.unionByName(whole).select(
        "doc_id", "text_hash", "row", "unit", F.explode(F.array(F.split(cleaned, " "))).alias("words")
    )
    sized = units.withColumn("unit_size", F.size("words") - 1).filter(
        (F.col("unit_size") >= 1) & (F.col("unit_size") <= most)
    )
    bigrams = F.expr("transform(sequence(0, unit_size - 1), i -> words[i] || ' ' || words[i + 1])")
    held = sized.select(
        "doc_id", "text_hash", "row", "unit", "unit_size", F.explode(bigrams).alias("held")
    )
    about = (F.col("held") == F.col("bigram")) & F.col("unit_size").between(
        F.col("fewest"), F.col("most")
    )
    key = ["doc_id", "text_hash", "row", "unit", "unit_size", "template", "license", "size"]
    common = (
        held.join(F.broadcast(table), about)  # a few hundred rows, whatever the input
        .groupBy(*key, "bigram", "times")
        .agg(F.count("*").alias("here"))
    )
    counted = common.groupBy(*key).agg(F.sum(F.least("here", "times")).alias("both"))
    score = 2 * F.col("both") / (F.col("unit_size") + F.col("size"))
    return counted.withColumn("score", score).filter(F.col("score") >= least_score).drop("row")


def rarest(rows: list[tuple], more: Callable[[int], int]) -> set[str]:
    """Of ``template_bigrams``: every passage that reaches the score holds ``more`` of these.

    ``more`` is given the fewest bigrams of such a passage.
    """
    templates = defaultdict(list)
    spread = Counter(row[2] for row in rows)
    for row in rows:
        templates[row[0]].append(row)
    chosen = set()
    for own in templates.values():
        size, fewest = own[0][4:6]
        needed = size - fewest + more(fewest)
        for row in sorted(own, key=lambda row: (spread[row[2]], -len(row[2]), row[2])):
            if needed > 0:
                chosen.add(row[2])
                needed -= row[3]
    return chosen


def _among(values) -> str:
    return "IN (" + ", ".join(f"'{value}'" for value in sorted(values)) + ")" if values else "IS NULL"


def _words(text: str) -> Column:
    # Exploded arrays of one element keep Spark from computing their content again at each use.
    cleaned = F.lower(F.btrim(F.regexp_replace(text, f"[^{_WORD[1:-2]}]+", " ")))
    return F.explode(F.array(F.split(cleaned, " "))).alias("words")


def _hits(bigrams: set[str]) -> Column:
    """Places of ``bigrams`` in ``words``: structs of pos and bigram."""
    pair = "concat(w, ' ', get(words, i + 1))"
    first = _among({bigram.split(" ")[0] for bigram in bigrams})
    return F.explode(
        F.array(
            F.expr(
                f"filter(transform(words, (w, i) -> CASE WHEN w {first} AND {pair} {_among(bigrams)}"
                f" THEN struct(i AS pos, {pair} AS bigram) END), h -> h IS NOT NULL)"
            )
        )
    ).alias("hits")


def gated(
    docs: DataFrame,
    templates,
    least_score: float = LEAST_SCORE,
    large: int = LARGE,
    piece: int = PIECE,
) -> DataFrame:
    """doc_id and text of every row that may hold a passage of any template; no other row has one.

    ``has_small`` and ``has_large``: of templates of up to, and of at least, ``large`` bigrams.
    A passage holds a rarest bigram of its template. It holds half of the fewest
    bigrams where more of the rarest are looked for, and of the pieces that it is
    cut into, one has no less than their mean.
    """
    rows = [row for row in template_bigrams(templates, least_score) if row[4] >= 1]
    small = rarest([row for row in rows if row[4] < large], lambda fewest: 1)

    def half(fewest: int) -> int:
        return max(1, fewest // 2)

    big = [row for row in rows if row[4] >= large]
    many = rarest(big, half)
    dense = min((math.ceil(half(row[5]) / math.ceil(row[6] / piece)) for row in big), default=1)
    near = F.expr(
        f"exists(sequence({dense - 1}, greatest(size(at), {dense}) - 1),"
        f" i -> coalesce(get(at, i) - get(at, i - {dense - 1}) < {piece}, FALSE))"
    )
    return (
        docs.select("doc_id", "text")
        .select("doc_id", "text", _words("text"))
        .select("doc_id", "text", _hits(small | many))
        .withColumn("has_small", F.expr(f"exists(hits, h -> h.bigram {_among(small)})"))
        .withColumn("at", F.expr(f"filter(hits, h -> h.bigram {_among(many)}).pos"))
        .withColumn("has_large", near)
        .select("doc_id", "text", "has_small", "has_large")
        .filter("has_small OR has_large")
    )


def license_passages(
    docs: DataFrame, templates, least_score: float = LEAST_SCORE, large: int = LARGE
) -> DataFrame:
    """The best passage of each row and template: doc_id, text_hash, row, license, score, both, template.

    ``docs`` is what ``gated`` returns. ``both`` counts the bigrams that passage
    and template have in common.
    """
    spark: SparkSession = docs.sparkSession
    rows = [row for row in template_bigrams(templates, least_score) if row[4] >= 1]
    table = spark.createDataFrame(
        rows,
        "template int, license string, bigram string, times int, size int, fewest int, most int",
    )
    flags = ["has_small", "has_large"]
    held = (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),
            *flags,
            _words("text"),
        )
        .select("doc_id", "text_hash", "row", *flags, _hits({row[2] for row in rows}))
        .select("doc_id", "text_hash", "row", *flags, F.inline("hits"))
        .withColumnRenamed("bigram", "held")
    )
    may = (F.col("held") == F.col("bigram")) & F.when(
        F.col("size") < large, F.col("has_small")
    ).otherwise(F.col("has_large"))
    key = ["doc_id", "text_hash", "row", "template", "license", "size", "fewest", "most"]
    placed = (
        held.join(F.broadcast(table), may)  # bounded by the templates, whatever the input
        .groupBy(*key, "bigram", "times")
        .agg(F.sort_array(F.collect_list("pos")).alias("at"))
    )
    # A bigram counts in a passage unless ``times`` earlier ones of its kind are in it already.
    kept = F.expr(
        "transform(at, (p, n) -> struct(p AS pos, coalesce(get(at, if(n < times, -1, n - times)), -1) AS lost))"
    )
    dense = (
        placed.groupBy(*key)
        .agg(
            F.sum(F.least(F.size("at"), "times")).alias("reach"),
            F.sort_array(F.flatten(F.collect_list(kept))).alias("hits"),
        )
        .filter("reach >= fewest")
        .withColumn("n", F.size("hits"))
    )
    starts = dense.select(
        "*",
        F.explode(
            F.expr(
                "filter(sequence(0, n - fewest),"
                " i -> hits[i + fewest - 1].pos - hits[i].pos < most)"
            )
        ).alias("start"),
    )
    run = starts.select(
        *key,
        F.expr("slice(hits, start + 1, most)").alias("run"),
        F.expr("hits[start].pos").alias("first"),
    )
    both = "(s.both + if(h.lost < first, 1, 0))"
    length = "(h.pos - first + 1)"
    best = F.expr(
        "aggregate(run, named_struct('both', 0, 'score', 0.0D, 'common', 0), (s, h) ->"
        f" CASE WHEN {length} > most THEN s"
        f" WHEN 2 * {both} / ({length} + size) > s.score"
        f" THEN named_struct('both', {both}, 'score', 2 * {both} / ({length} + size), 'common', {both})"
        f" ELSE named_struct('both', {both}, 'score', s.score, 'common', s.common) END)"
    )
    return (
        run.select(*key, best.alias("best"))
        .groupBy("doc_id", "text_hash", "row", "license", "template")
        .agg(F.max(F.struct("best.score", "best.common")).alias("best"))
        .filter(F.col("best.score") >= least_score)
        .select(
            "doc_id",
            "text_hash",
            "row",
            "license",
            F.col("best.score").alias("score"),
            F.col("best.common").alias("both"),
            "template",
        )
    )


def scan_licenses(
    docs: DataFrame,
    templates=TEMPLATES,
    least_score: float = LEAST_SCORE,
    headers=HEADERS,
    complete=COMPLETE,
) -> DataFrame:
    """doc_id, license, score, unit and n_units of every row.

    The best statement counts: by score, then by the earlier template, then by
    the earlier unit, a whole text (-1) last. ``n_units`` is the number of
    lines and whole texts that state any licence. Without a statement, and for
    NULL and empty texts, license and unit are NULL, score and n_units 0.

    Where no line or whole text states a licence, passages (unit -2) of
    ``templates`` and ``headers`` do: the best is the one of the most bigrams
    in common times score. Before all of these count the complete texts, by
    the sum of that over a licence's sections; the score is that of the section
    that adds most. A passage that counts adds one to ``n_units``.
    """
    notices = (*templates, *headers)
    every = (*notices, *complete_templates(complete))
    named = staged(gated(docs, every, least_score), "licence-texts")
    ranks = ["doc_id", "text_hash", "rank", "weight", "score", "template", "unit", "license"]
    stated = license_units(named, templates, least_score).select(
        "*", F.lit(1).alias("rank"), F.col("score").alias("weight")
    )
    share = F.col("score") * F.col("both")
    passages = (
        license_passages(named, every, least_score)
        .withColumn("rank", F.when(F.col("template") < len(notices), 0).otherwise(2))
        .groupBy("doc_id", "text_hash", "row", "rank", "license")
        .agg(
            F.round(F.sum(share), 6).alias("every"),
            F.max(F.struct(share.alias("share"), "score", (-F.col("template")).alias("order"))).alias("top"),
        )
        .select(
            "*",
            F.when(F.col("rank") == 2, F.col("every")).otherwise(F.col("top.share")).alias("weight"),
            F.col("top.score").alias("score"),
            (-F.col("top.order")).alias("template"),
            F.lit(PASSAGE).alias("unit"),
        )
    )
    unit = F.when(F.col("unit") == WHOLE, F.lit(1 << 30)).otherwise(F.col("unit"))
    best = F.max(
        F.struct("rank", "weight", "score", -F.col("template"), -unit, "license", "unit")
    ).alias("best")
    line = F.when(F.col("unit") != PASSAGE, F.col("unit"))
    found = (
        stated.select(*ranks)
        .unionByName(passages.select(*ranks))
        .groupBy("doc_id", "text_hash")
        .agg(best, F.count_distinct(line).alias("n_lines"))
        .withColumn("n_units", F.col("n_lines") + (F.col("best.unit") == PASSAGE).cast("int"))
    )
    found = found.select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "best", "n_units"
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("found_id"))
    same &= F.col("text_hash") == F.col("found_hash")
    return rows.join(found, same, "left").select(
        "doc_id",
        F.col("best.license").alias("license"),
        F.coalesce("best.score", F.lit(0.0)).alias("score"),
        F.col("best.unit").alias("unit"),
        F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
    )


def sql(templates=TEMPLATES, least_score: float = LEAST_SCORE) -> str:
    """What ``scan_licenses`` returns, over the view ``documents``."""
    listed = ", ".join(
        f"({number}, '{name}', '{bigram}', {times}, {size}, {fewest}, {most})"
        for number, name, bigram, times, size, fewest, most in template_bigrams(templates, least_score)
    )
    return f"""
WITH templates (template, license, bigram, times, size, fewest, most) AS (VALUES {listed}),
texts AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
units AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line,
    CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS unit FROM texts
  UNION ALL SELECT r, text, {WHOLE} FROM texts WHERE contains(text, chr(10))
),
cut AS (
  SELECT r, unit, list_transform(regexp_extract_all(line, '{_WORD}'), lambda w: lower(w)) AS words
  FROM units
),
held AS (
  SELECT r, unit, len(words) - 1 AS unit_size,
    unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram
  FROM cut WHERE len(words) - 1 BETWEEN 1 AND (SELECT max(most) FROM templates)
),
common AS (
  SELECT r, unit, unit_size, template, license, size, bigram, least(count(*), times) AS shared
  FROM held JOIN templates USING (bigram) WHERE unit_size BETWEEN fewest AND most
  GROUP BY r, unit, unit_size, template, license, size, bigram, times
),
scored AS (
  SELECT r, unit, template, license, 2 * sum(shared) / (unit_size + size) AS score
  FROM common GROUP BY r, unit, unit_size, template, license, size
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r
    ORDER BY score DESC, template, CASE unit WHEN {WHOLE} THEN 1 << 30 ELSE unit END) AS place,
    count(DISTINCT unit) OVER (PARTITION BY r) AS n_units
  FROM scored WHERE score >= {least_score}
)
SELECT t.doc_id, b.license, coalesce(b.score, 0) AS score, b.unit, coalesce(b.n_units, 0) AS n_units
FROM texts t LEFT JOIN ranked b ON t.r = b.r AND b.place = 1
"""
