"""Language identification by compression.

Each language has a raw-content dictionary, made of its documents. A text is
compressed against every one of them, block by block, and the language whose
dictionary leaves the fewest bytes is predicted. The score is the margin: how
much smaller than with the second best. Narrow margins are rejected: the
prediction stays, as the nearest language known, but ``sure`` is false. On both
sides only the letters of a text count, in lower case.

Dictionaries hold a bounded sample: of each language the first
``DOCUMENTS_EACH`` learning documents by a hash of their id, as far as they fit
into ``DICTIONARY_BYTES``. Of a learning document they hold the letters, and of
a long one the first of these only, so that ``LEAST_DOCUMENTS`` have room.
Whole texts are judged. The dictionaries are broadcast, 112 KB a language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.shared import first_by_hash, is_held_out, ship

DOCUMENTS_EACH = 500
DICTIONARY_BYTES = 112 << 10
#: Documents that share a dictionary at least, if there are as many.
LEAST_DOCUMENTS = 32
#: Blocks are small, so that the dictionary matters to all of a long text.
BLOCK_BYTES = 8 << 10
LEVEL = 9
#: Below this margin a prediction is not sure.
LEAST_MARGIN = 0.02
UNDETERMINED = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The letters of a text in lower case, a blank for whatever is between."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def dictionaries(
    learning: DataFrame, documents_each: int = DOCUMENTS_EACH, size: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """Dictionary content per language, the most frequent first, from rows of text and lang."""
    spark = learning.sparkSession
    known = learning.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    named = known.select("doc_id", "lang").distinct()
    chosen = first_by_hash(named, "lang", "doc_id", documents_each).collect()
    held = Counter(row["lang"] for row in chosen)
    # Bounded by documents_each and the number of languages.
    wanted = spark.createDataFrame(
        [
            (row["doc_id"], row["lang"], row["place"], share_of(size, held[row["lang"]]))
            for row in chosen
        ],
        T.StructType(
            [
                T.StructField("wanted_id", learning.schema["doc_id"].dataType),
                T.StructField("wanted_lang", learning.schema["lang"].dataType),
                T.StructField("place", T.IntegerType()),
                T.StructField("share", T.IntegerType()),
            ]
        ),
    )
    spelled = F.btrim(F.regexp_replace("text", r"[^\p{L}\p{M}]+", " "))
    texts = known.join(
        F.broadcast(wanted), (F.col("doc_id") == F.col("wanted_id")) & (F.col("lang") == F.col("wanted_lang"))
    ).select("lang", "place", F.substring(spelled, F.lit(1), F.col("share")).alias("text"))
    contents: dict[str, bytes] = {}
    for row in texts.orderBy("lang", "place", "text").toLocalIterator():
        so_far = contents.get(row["lang"], b"")
        if len(so_far) < size and (found := letters(row["text"])):
            contents[row["lang"]] = so_far + found + b" "
    counts = known.groupBy("lang").count().collect()
    by_size = sorted((-row["count"], row["lang"]) for row in counts if row["lang"] in contents)
    return {lang: contents[lang][:size] for _, lang in by_size}


def share_of(size: int, documents: int) -> int:
    """Characters of a document's letters that its language's dictionary takes at most.

    At least ``LEAST_DOCUMENTS`` share a dictionary if there are as many.
    """
    return -(-size // max(1, min(documents, LEAST_DOCUMENTS)))


class Judge:
    """Compressors of all languages."""

    def __init__(self, contents: dict[str, bytes], level: int = LEVEL) -> None:
        self.langs = list(contents)
        self.compressors = []
        for content in contents.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=level,
                    dict_data=dictionary,
                    write_checksum=False,
                    write_content_size=False,
                    write_dict_id=False,
                )
            )

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and margin; (``und``, 0.0) for a text without a letter.

        Languages that compress equally well are taken in order.
        """
        if not self.langs or not any(map(str.isalpha, text or "")):
            return UNDETERMINED, 0.0
        data = letters(text)
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]
        best, *others = sorted(range(len(sizes)), key=sizes.__getitem__)
        return self.langs[best], 1 - sizes[best] / sizes[others[0]] if others else 1.0


def identify(
    docs: DataFrame,
    folds: int = 4,
    fold: int = 2,
    least_margin: float = LEAST_MARGIN,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score and sure of every row.

    Learns from rows whose id's crc32 modulo ``folds`` is not ``fold`` and
    whose lang is known; a row without an id is not learned from. Ties go to
    the language with more documents. A NULL or empty text, one without a letter,
    and any text where nothing could be learned are ``und`` with score 0.
    """
    ship(docs.sparkSession)
    learning = docs.filter(~is_held_out(folds, fold)).select("doc_id", "text", "lang")
    contents = docs.sparkSession.sparkContext.broadcast(dictionaries(learning))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(contents.value).judge
        for batch in batches:
            found = [judge(text.as_py()) for text in batch.column("text")]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array([score >= least_margin for score in scores], pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "sure"],
            )

    texts = docs.select("doc_id", is_held_out(folds, fold).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, sure boolean"
    return texts.mapInArrow(judge, schema)
