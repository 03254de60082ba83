"""Token-id files: flat unsigned integers plus 64-bit document offsets.

A folder holds one shard per range of ids:

* ``<shard>.bin``: token ids of its documents, back to back, little-endian
  unsigned 16-bit integers, or 32-bit ones for vocabularies beyond 65,536;
* ``<shard>.off``: where each document begins in that file, counted in ids,
  and at last the number of ids; unsigned 64-bit;
* ``<shard>.ids``: the documents' ids, signed 64-bit;

and ``manifest.json``, which lists the shards in order with the number of ids
before each: prefix sums over the shards' counts, a line per shard. Shards are
written by tasks that know nothing of each other; a task's attempt writes
files of its own and only attempts that Spark accepts are in the manifest.

Documents come in ascending id, NULL ids first; equal ids by the hash of their
texts. A NULL text is an empty one and yields the end id alone. Other columns
of the input are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.shared import ship
from waybill.llm.tokens import CACHED_WORDS_ALONE, encoder, id_type

_SHARD = pa.schema(
    [
        ("shard", pa.int32()),
        ("path", pa.string()),
        ("documents", pa.int64()),
        ("null_ids", pa.int64()),
        ("tokens", pa.int64()),
    ]
)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text and write it below ``folder``, a URI all executors see."""
    ship(docs.sparkSession)
    dtype = id_type(vocabulary, end_id)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{context.partitionId():05d}-{context.taskAttemptId()}"
        store, base = fs.FileSystem.from_uri(f"{folder}/{name}")
        encode = encoder(vocabulary, end_id, CACHED_WORDS_ALONE).encode
        written, documents, null_ids = 0, 0, 0
        with (
            store.open_output_stream(f"{base}.bin") as ids_out,
            store.open_output_stream(f"{base}.off") as offsets_out,
            store.open_output_stream(f"{base}.ids") as names_out,
        ):
            for batch in batches:
                doc_ids = batch.column("id")
                for ids, lengths in encode(batch.column("text")):
                    ends = written + np.cumsum(lengths)
                    ids_out.write(ids.tobytes())
                    offsets_out.write((ends - lengths).astype("<u8").tobytes())
                    written = int(ends[-1])
                names_out.write(doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
                documents += len(doc_ids)
                null_ids += doc_ids.null_count
            offsets_out.write(np.array([written], "<u8").tobytes())
        row = (context.partitionId(), name, documents, null_ids, written)
        yield pa.RecordBatch.from_pylist([dict(zip(_SHARD.names, row))], schema=_SHARD)

    ordered = (
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            F.col(text_column).alias("text"),
            F.xxhash64(text_column).alias("tie"),
        )
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )
    # One row per shard: the prefix sums below are over files, not documents.
    kinds = "shard int, path string, documents long, null_ids long, tokens long"
    found = ordered.mapInArrow(write, kinds)
    shards = sorted((row.asDict() for row in found.collect()), key=lambda shard: shard["shard"])
    bases = accumulate((s["tokens"] for s in shards), initial=0)
    listed = [shard | {"base": base} for shard, base in zip(shards, bases)]
    store, path = fs.FileSystem.from_uri(f"{folder}/manifest.json")
    with store.open_output_stream(path) as out:
        out.write(json.dumps({"dtype": dtype, "shards": listed}).encode())


class Ranges:
    """A flat file of numbers in a store that cannot be mapped; slices are read as they are asked for."""

    def __init__(self, file: pa.NativeFile, dtype: str) -> None:
        self.file, self.dtype = file, np.dtype(dtype)

    def __getitem__(self, at: slice) -> np.ndarray:
        size = self.dtype.itemsize
        return np.frombuffer(
            self.file.read_at((at.stop - at.start) * size, at.start * size), self.dtype
        )


class Shard:
    """One shard, memory-mapped where its file system is a mounted one and read by ranges elsewhere."""

    def __init__(self, folder: str, name: str, dtype: str) -> None:
        self.folder, self.name, self.dtype = folder, name, dtype
        self.offsets = self._open("off", "<u8")
        self.doc_ids = self._open("ids", "<i8")
        self.tokens = self._open("bin", dtype)

    def _open(self, kind: str, dtype: str) -> np.ndarray | Ranges:
        store, path = fs.FileSystem.from_uri(f"{self.folder}/{self.name}.{kind}")
        if store.get_file_info(path).size == 0:
            return np.empty(0, dtype)  # an empty file cannot be mapped
        if isinstance(store, fs.LocalFileSystem):
            return np.memmap(path, dtype, mode="r")
        if kind == "bin":
            return Ranges(store.open_input_file(path), dtype)
        with store.open_input_file(path) as file:
            return np.frombuffer(file.read(), dtype)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def documents(self, first: int, stop: int) -> Iterator[np.ndarray]:
        """The ids of some documents in a row, read together."""
        bounds = self.offsets[first : stop + 1].astype(np.int64)
        ids = self.tokens[int(bounds[0]) : int(bounds[-1])]
        for start, end in zip(bounds - bounds[0], bounds[1:] - bounds[0]):
            yield ids[start:end]

    def document(self, i: int) -> np.ndarray:
        return next(self.documents(i, i + 1))


def read_manifest(folder: str) -> dict:
    store, path = fs.FileSystem.from_uri(f"{folder}/manifest.json")
    with store.open_input_stream(path) as file:
        return json.loads(file.read())


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and ids_crc32.

    ``start`` counts the ids of all documents before it, ``n_tokens`` includes
    the end id, and the checksum is over the ids as unsigned 32-bit integers.
    A folder of no documents gives no rows.
    """
    ship(spark)
    manifest = read_manifest(folder)
    dtype = manifest["dtype"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed in batch.to_pylist():
                shard = Shard(folder, listed["path"], dtype)
                for first in range(0, len(shard), 2_000):
                    at = range(first, min(first + 2_000, len(shard)))
                    own = shard.documents(first, at.stop)
                    crcs = [zlib.crc32(ids.astype("<u4")) for ids in own]
                    starts = shard.offsets[first : first + len(at)].astype("i8")
                    ends = shard.offsets[first + 1 : first + 1 + len(at)].astype("i8")
                    unnamed = np.arange(first, first + len(at)) < listed["null_ids"]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[first : first + len(at)], mask=unnamed),
                            pa.array(starts + listed["base"]),
                            pa.array(ends - starts),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    shards = spark.createDataFrame(
        [(s["path"], s["null_ids"], s["base"]) for s in manifest["shards"]],
        "path string, null_ids long, base long",
    )
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
