"""Token counts against the library, and merging against a plain loop."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from llm_support import LONG, ODD, rows_of
from waybill.llm import token_counts
from waybill.llm.token_counts import Merges, count_tokens, merges

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    model = SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(model.encode(text or ""))


def counts(texts):
    return merges(MODEL).count(pa.array(texts, pa.string())).tolist()


SPECIAL = [
    "", " ", "  ", "\n", " \n ", "\n\n a", "a \n", "a\n b", "a  b", " a", "a ", "▁", "a▁b", "▁ a", "\t",
    "</s>", "<s> <unk>", "<0x0A>", "\0", "a\0b", "中文", "😀 é", "1234567 89", " ", " " * 500,
    "a" * 999, "ab" * 500, "a b " * 50 + " " * 80 + "c", "​ ﻿", "é", "\U0010ffff",
]


def test_special_texts(library):
    assert counts(SPECIAL) == [library(text) for text in SPECIAL]


def test_null_has_no_token():
    assert counts([None, "", "a"]) == [0, 0, 1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abetn é中\n\t ▁.,019😀\0<>/s"), max_size=60))
def test_random_texts(text):
    model = SentencePieceProcessor(model_file=MODEL)
    assert counts([text]) == [len(model.encode(text))]


def test_random_pieces(library):
    model = SentencePieceProcessor(model_file=MODEL)
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(259, model.get_piece_size())]
    rng = random.Random(3)
    texts = ["".join(rng.choices(pieces, k=rng.randrange(25))) for _ in range(3000)]
    assert counts(texts) == [library(text) for text in texts]


def test_documents(spark, documents, library):
    got = {row.doc_id: row for row in count_tokens(documents, MODEL).collect()}
    for row in documents.collect():
        found, size = got[row.doc_id], len((row.text or "").encode())
        assert (found.n_bytes, found.n_tokens) == (size, library(row.text))
        assert found.over_limit == (found.n_tokens > 4096)
    assert len(got) == documents.count()


def test_long_texts_are_cut_where_nothing_merges(monkeypatch, library):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 100)
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc  \n▁.é", k=rng.randrange(900))) for _ in range(200)]
    texts += [LONG, LONG.replace(" ", "\n"), LONG.replace(" ", "  "), LONG.replace(" ", "")]
    assert counts(texts) == [library(text) for text in texts]


def test_many_symbols_at_once(monkeypatch, library):
    monkeypatch.setattr(token_counts, "SYMBOLS_AT_ONCE", 50)
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 0)
    texts = [LONG, "the quick brown fox " * 30]
    merges(MODEL).known.clear()
    assert counts(texts) == [library(text) for text in texts]


def plain(pieces, word):
    """Merge the best pair, the left one of equals, until there is none; tokens left."""
    symbols = list(word)
    while True:
        pairs = [
            (-pieces[a + b], i)
            for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
            if a + b in pieces
        ]
        if not pairs:
            return sum(1 if s in pieces else len(s.encode()) for s in symbols)
        _, i = min(pairs)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


@pytest.mark.parametrize("tied", [False, True])
def test_any_vocabulary_merges_as_one_by_one(tied):
    """Also ones where a merge makes a better pair, and where pieces share a score."""
    rng = random.Random(7)
    for _ in range(60):
        made = {"".join(rng.choices("abc", k=rng.randrange(2, 6))) for _ in range(rng.randrange(25))}
        names = sorted(made | {"a", "b"})
        scores = rng.sample(range(100), len(names))
        pieces = {n: -float(s % 4 if tied else s) for n, s in zip(names, scores)}
        words = ["".join(rng.choices("abcd", k=rng.randrange(1, 30))) for _ in range(40)]
        words += ["a" * 150, "ab" * 90]
        assert Merges(pieces).survivors(words).tolist() == [plain(pieces, word) for word in words]


def test_pieces_with_inner_blanks_are_not_cut():
    pieces = {"a": -1.0, "▁": -2.0, "▁a": -3.0, "a▁a": -0.5, "a▁": -0.2}
    table = Merges(pieces)
    assert not table.cuts
    texts = ["a a", "a a a", " a  a"]
    want = [plain(pieces, "▁" + text.replace(" ", "▁")) for text in texts]
    assert table.count(pa.array(texts)).tolist() == want


def test_odd_rows(odd, library):
    got = count_tokens(odd, MODEL)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [
        (i, len((t or "").encode()), library(t), library(t) > 4096) for i, t, _, _ in ODD
    ]
    assert rows_of(got) == sorted(want, key=lambda row: [(v is not None, v) for v in row])


def test_limit_and_empty_table(spark, none, odd):
    assert count_tokens(none, MODEL).count() == 0
    assert count_tokens(odd, MODEL, limit=0).filter("over_limit").count() == odd.filter("text <> ''").count()


def test_one_pass_over_the_texts(odd):
    plan = count_tokens(odd, MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
