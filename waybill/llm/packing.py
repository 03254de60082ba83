"""Best-fit packing of documents into sequences of bounded length.

Bounded-space online best-fit: pieces arrive one by one, each goes to the open
bin that it leaves with the least room, and is given out at once with its
sequence and offset. Open bins are kept by free space, with one bit of an
integer per value of free space that some bin has, so the best bin is a shift
and a lowest set bit away. Beyond a fixed number of open bins the fullest one
closes, the one that has just been filled included. A task holds the open bins
and nothing else, however many pieces pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.shared import free_name, ship, staged
from waybill.llm.tokens import CACHED_WORDS, encoder

SEQUENCE_TOKENS = 2048
#: Bins that may be open at a time, in each bucket.
OPEN_BINS = 32_768
#: Pieces that share bins. More of them waste less room; fewer spread wider.
BUCKET_PIECES = 65_536
#: Tasks that pack, at most; beyond, a task packs several buckets one after the other.
MOST_TASKS = 20_000


class Bins:
    """The open bins of one bucket."""

    def __init__(self, size: int, most_open: int) -> None:
        self.size, self.most_open = size, most_open
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.present = 0
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        self.open -= 1
        if not bins:
            self.present ^= 1 << free
        return found

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``size`` tokens."""
        fitting = self.present >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(found)
            self.present |= 1 << left
            self.open += 1
            if self.open > self.most_open:
                self._take((self.present & -self.present).bit_length() - 1)
        return found, self.size - free


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    size: int = SEQUENCE_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """Documents as pieces of at most ``size`` tokens, the end id included.

    Only longer documents are cut, into pieces of ``size`` and a last one that
    may be shorter. A NULL text is empty: a piece with the end id alone. Ids
    may repeat or be NULL. Returns doc_id, piece, start, length, ids_crc32 (of
    the ids as unsigned 32-bit integers) and, if wanted, the ids as binary.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, end_id, cached_words).encode
        for batch in batches:
            done = 0
            for ids, lengths in encode(batch.column("text")):
                pieces = -(-lengths // size)
                of = np.repeat(np.arange(len(lengths)), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * size
                length = np.minimum(size, lengths[of] - start)
                first = (np.cumsum(lengths) - lengths)[of] + start
                parts = [ids[a : a + n] for a, n in zip(first.tolist(), length.tolist())]
                columns = [
                    batch.column("id").take(pa.array(done + of)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(part.astype("<u4")) for part in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([part.tobytes() for part in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                done += len(lengths)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def pack(
    pieces: DataFrame,
    key: list[str],
    size: int = SEQUENCE_TOKENS,
    length_column: str = "length",
    bucket_pieces: int = BUCKET_PIECES,
    most_open: int = OPEN_BINS,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are 1 to ``size``.

    Pieces are dealt in turn over buckets of about ``bucket_pieces``, whatever
    they hold, so that equal rows are as spread as any; the number of buckets
    grows with the input and no bucket does. Within a bucket the longest come
    first, which lets short ones fill the gaps. ``pieces`` must be a stored
    table: it is counted first, and its files give the turns.
    """
    ship(pieces.sparkSession)
    buckets = max(1, -(-pieces.count() // bucket_pieces))
    bucket = free_name(pieces, "bucket")
    schema = T.StructType(
        [*pieces.schema, T.StructField("sequence_id", T.LongType())]
        + [T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, None
        for batch in batches:
            sequences, offsets = [], []
            where = batch.column(bucket).to_pylist()
            for b, length in zip(where, batch.column(length_column).to_pylist(), strict=True):
                if b != now:
                    now, bins = b, Bins(size, most_open)
                found, offset = bins.place(length)
                sequences.append((b << 40) + found)
                offsets.append(offset)
            kept = batch.drop_columns([bucket])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    turn = F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int")
    dealt = pieces.withColumn(bucket, turn)
    return (
        dealt.repartitionById(min(buckets, MOST_TASKS), bucket)
        .sortWithinPartitions(bucket, F.desc(length_column), *key)
        .mapInArrow(place, schema)
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    size: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """Encode, cut and pack whole documents; see ``token_pieces`` and ``pack``."""
    pieces = token_pieces(
        docs, vocabulary, end_id, size, with_ids=with_ids, cached_words=cached_words
    )
    pieces = staged(pieces, "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], size)
