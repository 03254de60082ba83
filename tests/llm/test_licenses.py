from __future__ import annotations

import random
import re
import textwrap
from collections import Counter

import duckdb
import pytest

from llm_support import ODD, frame, rows_of
from waybill.llm import licenses


def by_sql(docs):
    with duckdb.connect() as connection:
        connection.register("documents", docs.select("doc_id", "text").toArrow())
        found = connection.execute(licenses.sql())
        names = [column[0] for column in found.description]
        rows = found.fetchall()
    return names, sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def test_scan_equals_sql(documents):
    names, rows = by_sql(documents)
    assert rows_of(licenses.scan_licenses(documents), *names) == rows


def test_odd_documents_equal_sql(odd, none):
    names, rows = by_sql(odd)
    assert rows_of(licenses.scan_licenses(odd), *names) == rows
    assert len(rows) == len(ODD)
    assert ("MIT", 1.0) in {row[1:3] for row in rows}
    assert rows_of(licenses.scan_licenses(none)) == []


def scan(spark, *texts):
    docs = frame(spark, [(i, text, "en", "s") for i, text in enumerate(texts)])
    return [tuple(r)[1:] for r in sorted(licenses.scan_licenses(docs).collect())]


def test_statements(spark):
    found = scan(
        spark,
        "words\nLICENSED under the  apache license -- version 2.0!\nmore words",
        "Released under a MIT License.",
        "The MIT licence was released under protest by all of them",
        "\n".join(licenses.TEMPLATES[4][1].split(", ")),
        "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
        "All rights reserved",
        "word",
    )
    assert found[0] == ("Apache-2.0", 1.0, 1, 2)  # the line, and the whole text too
    assert found[1] == (None, 0.0, None, 0)
    assert found[2] == (None, 0.0, None, 0)
    assert found[3][:3] == ("MIT", 1.0, licenses.WHOLE)
    assert found[4] == ("CC-BY-4.0", 1.0, 1, 2)
    assert found[5] == ("LicenseRef-All-Rights-Reserved", 1.0, 0, 1)
    assert found[6] == (None, 0.0, None, 0)


def test_equal_rows_are_counted_one_by_one(spark):
    docs = frame(spark, [(1, "Released under the MIT License.", "en", "s")] * 3)
    assert rows_of(licenses.scan_licenses(docs)) == [(1, "MIT", 1.0, 0, 1)] * 3


def test_size_bounds_prune_nothing_that_could_reach_the_score():
    for least in (0.5, 0.75, 0.9):
        for _, _, _, _, size, fewest, most in licenses.template_bigrams(least_score=least):
            for other in range(1, 3 * size + 3):
                best = 2 * min(size, other) / (size + other)
                assert (best >= least - 1e-12) == (fewest <= other <= most)


@pytest.mark.parametrize("repeat", [1, 2])
def test_repeated_bigrams_count(spark, repeat):
    templates = (("X", "a b a b a b"),)
    docs = frame(spark, [(1, " ".join(["a b"] * repeat), "en", "s")])
    units = licenses.license_units(docs, templates, least_score=0.1).collect()
    ours, theirs = Counter(["ab"] * repeat + ["ba"] * (repeat - 1)), Counter(["ab"] * 3 + ["ba"] * 2)
    both = sum((ours & theirs).values())
    assert [u.score for u in units] == [2 * both / (ours.total() + theirs.total())]


def words_in(text):
    return re.findall("[a-z0-9]+", text.lower())


def best_passage(words, template):
    """Score of the best run of words, by trying them all."""
    theirs, best = Counter(zip(template, template[1:])), 0.0
    for start in range(len(words) - 1):
        ours = Counter()
        for end in range(start, min(len(words) - 1, start + 2 * len(template))):
            ours[words[end], words[end + 1]] += 1
            best = max(best, 2 * (ours & theirs).total() / (ours.total() + theirs.total()))
    return best


@pytest.mark.parametrize("seed", range(3))
def test_passages_equal_trying_every_run(spark, seed):
    draw = random.Random(seed)
    templates = (("X", "a b c a b d a b"), ("Y", "b c d e"), ("Z", "c a"), ("W", "e e e e"))
    texts = [" ".join(draw.choices("abcdef", k=draw.randint(0, 40))) for _ in range(60)]
    docs = frame(spark, [(i, text, "en", "s") for i, text in enumerate(texts)])
    for least, large in ((0.5, 40), (0.75, 40), (0.5, 1), (0.75, 1)):
        near = licenses.gated(docs, templates, least, large, piece=3)
        found = licenses.license_passages(near, templates, least, large).collect()
        got = {(row.doc_id, row.template): row.score for row in found}
        want = {
            (i, number): score
            for i, text in enumerate(texts)
            for number, (_, template) in enumerate(templates)
            if (score := best_passage(words_in(text), words_in(template))) >= least
        }
        assert len(want) > 20 and got == pytest.approx(want)


def test_statements_inside_longer_units(spark):
    prose = "\n".join(f"some line {i} of many words that say nothing of it" for i in range(400))
    header = textwrap.fill(licenses.TEMPLATES[1][1], 40, initial_indent=" * ", subsequent_indent=" * ")
    agpl = textwrap.fill(licenses.HEADERS[-1][1], 72, initial_indent="# ", subsequent_indent="# ")
    found = scan(
        spark,
        f"{header}\n{prose}",
        "This tool is released under the MIT License and may be copied by anyone.",
        f"{prose}\nIt is licensed under CC\nBY-SA 4.0 since last year.\n{prose}",
        f"# Copyright 2020 Someone. All rights reserved.\n{header}\n{prose}",
        f"{prose}\n{agpl}\n{prose}",
        prose,
    )
    assert found == [
        ("Apache-2.0", 1.0, licenses.PASSAGE, 1),
        ("MIT", 1.0, licenses.PASSAGE, 1),
        ("CC-BY-SA-4.0", 1.0, licenses.PASSAGE, 1),
        ("Apache-2.0", 1.0, licenses.PASSAGE, 1),
        ("AGPL-3.0", 1.0, licenses.PASSAGE, 1),
        (None, 0.0, None, 0),
    ]


@pytest.mark.parametrize("wrapped", [True, False])
def test_complete_texts(spark, wrapped):
    holder = "Copyright (c) 2020 Some Holder and others\n\n"
    texts = []
    for name in licenses.COMPLETE:
        text = re.sub(r"(Copyright \(c\) )?<.*>.*\n\n", holder, licenses.complete_text(name), count=1)
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
        width = 75 if wrapped else 1 << 20
        texts.append("\n\n".join(textwrap.fill(paragraph, width) for paragraph in paragraphs))
    prose = "some words that say nothing of it\n" * 300
    for around in ("", prose):
        found = scan(spark, *(around + text + around for text in texts))
        assert [row[0] for row in found] == list(licenses.COMPLETE)
        assert all(row[1] > 0.95 and row[2] == licenses.PASSAGE for row in found)


def test_a_section_is_found_by_itself(spark):
    cut = licenses.sections(licenses.complete_text("MPL-2.0"))
    assert len(cut) > 10
    found = scan(spark, *(f"some words\n{section}\nsome more words" for section in cut))
    assert {row[:3] for row in found} == {("MPL-2.0", 1.0, licenses.PASSAGE)}
