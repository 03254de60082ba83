"""Lines that many documents share.

Texts are cut into lines, each line is normalised to a key and hashed, and
documents are counted per hash. Long keys found in many documents lose their
lines everywhere but in one document, the one with the largest id; the other
lines are put together again in their old order.

Hashes have 128 bits. A document gives each of its keys once, and documents
are counted in two steps, by key and document and then by key, so that a line
in a third of all documents is added up where it is read. Decisions come back
as the hashes that each document loses, and only documents that lose any
are cut up a second time.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import SPACE_CHARACTERS, free_name, ship, staged

LEAST_CHARACTERS = 20
LEAST_DOCUMENTS = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(_UPPER, _UPPER.lower())


def key_hash(line: str, least: int = LEAST_CHARACTERS) -> bytes | None:
    """The hash of a line's key, or None if the key is too short to be judged."""
    key = line.strip(SPACE_CHARACTERS)
    if len(key) < least:
        return None
    # bytes.lower() knows ASCII letters only.
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def line_hashes(docs: DataFrame, id_column: str, text_column: str, least: int) -> DataFrame:
    """(doc_id, high, low): the distinct keys of each row, as two longs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, highs, lows = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {key_hash(line, least) for line in (text.as_py() or "").split("\n")}
                for high, low in map(struct.Struct("<qq").unpack, found - {None}):
                    ids.append(doc_id)
                    highs.append(high)
                    lows.append(low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (ids, highs, lows)], names=["doc_id", "high", "low"]
            )

    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return named.filter("doc_id IS NOT NULL").mapInArrow(cut, "doc_id long, high long, low long")


def lost_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """(lost_id, lost): the hashes that each document loses; other documents have no row."""
    ship(docs.sparkSession)
    held = staged(line_hashes(docs, id_column, text_column, least_characters), "lines")
    shared = (
        held.distinct()
        .groupBy("high", "low")
        .agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
        .filter(F.col("documents") >= least_documents)
        .select("high", "low", "keeper")
    )
    # Stored first: a join beside the grouping could not split a line that very many share.
    shared = staged(shared, "shared-lines")
    losing = held.join(shared, ["high", "low"]).filter(F.col("doc_id") != F.col("keeper"))
    return losing.groupBy(F.col("doc_id").alias("lost_id")).agg(
        F.collect_set(F.struct("high", "low")).alias("lost")
    )


def _kept(text: str, lost: set[bytes], least: int) -> tuple[str, int, int]:
    """The text without its lost lines, the number of lines and of lost ones."""
    lines = text.split("\n")
    if not lost:
        return text, len(lines), 0
    kept = [line for line in lines if key_hash(line, least) not in lost]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _cleaned(
    docs: DataFrame, id_column: str, text_column: str, least_characters: int, least_documents: int
) -> tuple[DataFrame, str]:
    """Rows of ``docs`` with the hashes that they lose, and the name of that column."""
    lost = lost_lines(docs, id_column, text_column, least_characters, least_documents)
    name, key = free_name(docs, "lost"), free_name(docs, "lost_id")
    lost = lost.toDF(key, name)
    joined = docs.join(lost, F.col(id_column).cast("long") == F.col(key), "left").drop(key)
    return joined, name


def _lost_sets(column: pa.Array) -> Iterator[set[bytes]]:
    pack = struct.Struct("<qq").pack
    for lost in column.to_pylist():
        yield {pack(x["high"], x["low"]) for x in lost or ()}


def line_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row.

    A NULL or empty text is one empty line. Documents are told apart by id, so
    rows of one id count once and lose the same lines. Rows without an id are
    not counted and lose nothing.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    joined, name = _cleaned(texts, "doc_id", "text", least_characters, least_documents)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, digests = [], [], []
            for text, lost in zip(batch.column("text"), _lost_sets(batch.column(name)), strict=True):
                kept, n, gone = _kept(text.as_py() or "", lost, least_characters)
                lines.append(n)
                dropped.append(gone)
                digests.append(hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lines, pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(digests),
                ],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    return joined.mapInArrow(report, schema)


def without_shared_lines(
    docs: DataFrame,
    least_characters: int = LEAST_CHARACTERS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``docs`` with all columns and rows, shared lines cut out of ``text``.

    ``n_chars``, if there is such a column, counts what is left of a text that
    lost lines.
    """
    joined, name = _cleaned(docs, "doc_id", "text", least_characters, least_documents)

    names, counted = docs.columns, "n_chars" in docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {column: batch.column(column) for column in names}
            texts = columns["text"].to_pylist()
            sizes = columns["n_chars"].to_pylist() if counted else []
            for i, lost in enumerate(_lost_sets(batch.column(name))):
                if lost:
                    texts[i] = _kept(texts[i], lost, least_characters)[0]
                    if counted:
                        sizes[i] = len(texts[i])
            columns["text"] = pa.array(texts, columns["text"].type)
            if counted:
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=names)

    return joined.mapInArrow(cut, docs.schema)


#: What ``line_report`` returns, over the view ``documents``.
SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS position
  FROM texts
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {LEAST_CHARACTERS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCUMENTS}
),
judged AS (
  SELECT k.r, k.doc_id, k.line, k.position, coalesce(k.doc_id <> s.keeper, FALSE) AS lost
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
