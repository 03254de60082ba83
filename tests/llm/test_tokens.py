from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_support import ODD, rows_of
from waybill.llm import packing, token_files, tokens

VOCABULARIES = {"byte_bpe_50k.json": 2, "word_bpe_49k.json": 0}
PARTS = ["a", "b", "the", " ", "  ", "\n", "\n\n", "\t", ",", ".", "'s", "%%%", "é", "É", " "]
PARTS += ["　", "\r\n", "\x1c", "\x00", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "1", "23", "中文", "́", "Σ", "İ", "_"]


def library(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    encoded = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, end] for e in encoded]


def ours(encoder, texts):
    found = []
    for ids, lengths in encoder.encode(pa.array(texts, pa.string())):
        ends = np.cumsum(lengths)
        found += [ids[a:b].tolist() for a, b in zip(ends - lengths, ends)]
    return found


@pytest.mark.parametrize("name", VOCABULARIES)
@pytest.mark.parametrize("size", [40, 3000])
def test_ids_equal_the_library(name, size, monkeypatch):
    draw = random.Random(size)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(4000)]
    texts += [" ".join(draw.choices(["foo", "Bar,", "baz\nqux.", "naïve"], k=80)) for _ in range(50)]
    texts += [None, "", " ".join(texts[:300])]
    encoder = tokens.Encoder(public_tokenizers.path(name), VOCABULARIES[name], cached_words=100)
    monkeypatch.setattr(tokens, "SLICE_BYTES", size)
    assert ours(encoder, texts) == library(name, texts, VOCABULARIES[name])


@pytest.mark.parametrize("name", VOCABULARIES)
def test_special_strings_are_their_tokens_unless_asked_otherwise(name):
    path = public_tokenizers.path(name)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "x<|startoftext|>y " * 3, "plain words"]
    assert ours(tokens.Encoder(path, 0), texts) == library(name, texts, 0)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = [[*plain.encode(text, add_special_tokens=False).ids, 0] for text in texts]
    assert ours(tokens.Encoder(path, 0, special_as_text=True), texts) == want
    assert want != library(name, texts, 0)


def test_parts_are_the_text():
    text = "one two  three\n four five " * 50
    assert "".join(tokens.parts(text, 20)) == text
    assert [*tokens.parts("x" * 100, 20)] == ["x" * 100]


def token_rows(spark, docs, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(docs, folder, path, 2)
    return rows_of(token_files.read_token_files(spark, folder))


def expected_rows(documents):
    ordered = sorted(documents, key=lambda d: (d[0] is not None, d[0]))
    ids = library("byte_bpe_50k.json", [text for _, text in ordered], 2)
    start, rows = 0, []
    for (doc_id, _), own in zip(ordered, ids):
        rows.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4"))))
        start += len(own)
    return rows


def test_token_files_equal_the_library(spark, documents, tmp_path):
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows = token_rows(spark, documents.repartition(7), f"file://{tmp_path}/files")
    assert rows == expected_rows(texts)


def test_files_are_flat(spark, documents, tmp_path):
    token_rows(spark, documents, f"file://{tmp_path}/files")
    manifest = token_files.read_manifest(f"file://{tmp_path}/files")
    assert manifest["dtype"] == "<u2"
    base = 0
    for shard in manifest["shards"]:
        assert shard["base"] == base
        ids = np.fromfile(f"{tmp_path}/files/{shard['path']}.bin", "<u2")
        offsets = np.fromfile(f"{tmp_path}/files/{shard['path']}.off", "<u8")
        doc_ids = np.fromfile(f"{tmp_path}/files/{shard['path']}.ids", "<i8")
        assert len(ids) == shard["tokens"] == offsets[-1]
        assert len(doc_ids) == len(offsets) - 1 == shard["documents"]
        assert (ids[offsets[1:].astype(int) - 1] == 2).all()
        assert (np.diff(doc_ids) >= 0).all()
        base += shard["tokens"]


def test_odd_documents(spark, odd, tmp_path):
    rows = token_rows(spark, odd, f"file://{tmp_path}/odd")
    assert [r[0] for r in rows] == sorted((d[0] for d in ODD), key=lambda i: (i is not None, i))
    got = sorted((r[2], r[3]) for r in rows)
    assert got == sorted((r[2], r[3]) for r in expected_rows([d[:2] for d in ODD]))
    starts = sorted(r[1] for r in rows)
    assert starts[0] == 0 and starts[-1] < sum(r[2] for r in rows)


def test_no_documents(spark, none, tmp_path):
    assert token_rows(spark, none, f"file://{tmp_path}/none") == []


def test_wide_vocabularies_take_four_bytes(tmp_path):
    assert tokens.id_type(public_tokenizers.path("byte_bpe_50k.json"), 2) == "<u2"
    assert tokens.id_type(public_tokenizers.path("byte_bpe_50k.json"), 1 << 16) == "<u4"


def check_packing(rows, documents, size):
    """Rows (doc_id, piece, start, length, crc, sequence, offset) against the texts."""
    want = []
    ids = library("word_bpe_49k.json", [text for _, text in documents], 0)
    for (doc_id, _), own in zip(documents, ids):
        for piece, start in enumerate(range(0, len(own), size)):
            part = np.array(own[start : start + size], "<u4")
            want.append((doc_id, piece, start, len(part), zlib.crc32(part)))
    key = lambda row: [(v is not None, v) for v in row]
    assert sorted((r[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for row in rows:
        sequences.setdefault(row[5], []).append((row[6], row[3]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), sum(r[3] for r in rows) / size


@pytest.mark.parametrize("size", [2048, 64])
def test_packing(spark, documents, size):
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(documents, path, 0, size)
    sequences, least = check_packing(rows_of(packed), texts, size)
    assert sequences <= least * 1.02 + 1


def test_packing_odd_documents(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    check_packing(rows_of(packing.pack_documents(odd, path, 0)), [d[:2] for d in ODD], 2048)
    assert rows_of(packing.pack_documents(none, path, 0)) == []


def test_packed_ids_are_the_ids(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    for row in packing.pack_documents(odd, path, 0, with_ids=True).collect():
        ids = np.frombuffer(row.ids, "<u2")
        assert (len(ids), zlib.crc32(ids.astype("<u4"))) == (row.length, row.ids_crc32)


def test_pieces_keep_their_columns_and_buckets_their_size(spark):
    pieces = spark.range(3000).selectExpr("id", "1 + id * 7919 % 100 AS length", "'x' AS bucket")
    rows = packing.pack(pieces, ["id"], 100, bucket_pieces=500).collect()
    assert {r.bucket for r in rows} == {"x"}
    assert len({r.sequence_id >> 40 for r in rows}) == 6
    assert len({r.sequence_id for r in rows}) <= sum(r.length for r in rows) / 100 * 1.02 + 6


def test_equal_rows_are_spread_over_buckets(spark, tmp_path):
    """A third of the rows alike, as NULL ids with empty texts are."""
    pieces = spark.range(3000).selectExpr("if(id % 3 = 0, NULL, id) AS id", "1 AS length")
    pieces.write.parquet(f"{tmp_path}/pieces")
    stored = spark.read.parquet(f"{tmp_path}/pieces")
    packed = packing.pack(stored, ["id"], 100, bucket_pieces=500)
    rows = packed.selectExpr("*", "spark_partition_id() AS task").collect()
    buckets = {}
    for row in rows:
        buckets.setdefault(row.sequence_id >> 40, []).append(row)
    assert len(buckets) == 6
    for mine in buckets.values():
        assert 400 <= len(mine) <= 600
        assert 100 <= sum(row.id is None for row in mine) <= 250
        assert len({row.task for row in mine}) == 1
    assert len({mine[0].task for mine in buckets.values()}) == 6


def test_several_buckets_in_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "MOST_TASKS", 2)
    pieces = spark.range(3000).selectExpr("id", "1 + id * 7919 % 100 AS length")
    pieces.write.parquet(f"{tmp_path}/pieces")
    rows = packing.pack(spark.read.parquet(f"{tmp_path}/pieces"), ["id"], 100, bucket_pieces=500)
    sequences = {}
    for row in rows.collect():
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in sequences.values():
        ends = [0, *(offset + length for offset, length in sorted(placed))]
        assert [offset for offset, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 100
    assert len({sequence >> 40 for sequence in sequences}) == 6


def bounded_best_fit(lengths, size, most_open):
    """As the method says it: the fullest bin that has room, else a new one; the fullest closes."""
    filled, open_, placed = [], [], []
    for length in lengths:
        fitting = [b for b in open_ if filled[b] + length <= size]
        if fitting:
            fullest = max(filled[b] for b in fitting)
            found = [b for b in fitting if filled[b] == fullest]
        else:
            filled.append(0)
            found = [len(filled) - 1]
            open_.append(found[0])
        placed.append((found, filled[found[0]]))
        yield placed[-1]
        chosen = yield
        filled[chosen] += length
        open_ = [b for b in open_ if filled[b] < size]
        if len(open_) > most_open:
            most = max(filled[b] for b in open_)
            closed = yield [b for b in open_ if filled[b] == most]
            open_.remove(closed)


@pytest.mark.parametrize("most_open", [1, 2, 5, 17])
def test_bins_close_the_fullest(most_open):
    """Every placement and closing is one that the method allows."""
    draw, bins = random.Random(most_open), packing.Bins(50, most_open)
    lengths = [draw.randint(1, 50) for _ in range(1500)]
    plain = bounded_best_fit(lengths, 50, most_open)
    step = next(plain)
    for length in lengths:
        allowed, offset = step
        found, at = bins.place(length)
        assert found in allowed and at == offset
        next(plain)
        try:
            step = plain.send(found)
            if isinstance(step, list):
                open_now = {b for group in bins.by_free for b in group}
                (closed,) = [b for b in step if b not in open_now]
                step = plain.send(closed)
        except StopIteration:
            break


@pytest.mark.parametrize("most_open", [1, 4, 1000])
def test_bins(most_open):
    draw, bins, filled = random.Random(most_open), packing.Bins(50, most_open), {}
    for _ in range(2000):
        length = draw.randint(1, 50)
        best = max((f for f in filled.values() if f + length <= 50), default=None)
        found, offset = bins.place(length)
        assert offset == filled.get(found, 0)
        if most_open == 1000 and best is not None:
            assert offset == best  # the bin with the least room
        filled[found] = offset + length
        assert filled[found] <= 50 and bins.open <= most_open
