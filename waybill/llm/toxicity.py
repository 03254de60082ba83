"""Toxicity by subword embeddings.

A word is a bag of the character n-grams of its spelling, boundaries included;
each n-gram has a hashed bucket with an embedding. A word's vector is the mean
of its n-grams', a document's the mean of its words', and a linear softmax
over it gives the two classes. Embeddings and softmax are trained jointly, in
numpy, so a misspelling that was never seen shares most of its n-grams with
the words that were. A few neutral words are added to every mean, as otherwise
the words of a very short text weigh more than they can tell.

The model is fitted on a bounded sample of the labelled documents: of each
class the first ``DOCUMENTS_EACH`` by a hash of the id. Of a document with more
than ``WORDS_OF_ONE`` distinct words it takes about as many, by their hash; a
document that does not fit into what is left of ``WORDS_EACH`` distinct words
is skipped. They come to the driver one by one, as word counts. Scoring reads every whole text. As both means are linear, a word adds
one number to its document's logit, computed once per distinct word and worker.
"""

from __future__ import annotations

import functools
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import SPACE, first_by_hash, is_held_out, ship, staged

DOCUMENTS_EACH = 1500
WORDS_EACH = 500_000
WORDS_OF_ONE = 20_000
BUCKETS = 1 << 18
DIMENSIONS = 8
SHORTEST, LONGEST = 3, 5
#: Neutral words in every document's mean.
PADDING = 30
#: Buckets that fewer documents hit are not learned.
RARE = 8
EPOCHS = 60
RATE, MOMENTUM, DECAY = 1.0, 0.9, 1e-4
#: Words that a worker remembers.
CACHED_WORDS = 400_000
SLICE_BYTES = 6 << 20

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def grams(word: str) -> list[int]:
    """Buckets of a word's n-grams and of the word itself; [] for one without a letter or digit."""
    core = _EDGES.sub("", word.lower())
    if not core:
        return []
    data = f"<{core}>"
    found = [data[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(data) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in [*found, data]]


class Model:
    """What is left of embeddings and softmax for scoring: a number per bucket, and the bias."""

    def __init__(self, of_bucket: np.ndarray, bias: float) -> None:
        self.of_bucket = of_bucket.astype(np.float32)
        self.bias = float(bias)

    def of_word(self, word: str) -> float:
        """What a word adds to the sum of which the logit is the mean."""
        buckets = grams(word)
        return float(self.of_bucket[buckets].mean()) if buckets else 0.0


def _matrix(documents: Iterable[tuple[dict[str, int], int]]) -> tuple[np.ndarray, ...]:
    """Row, bucket and weight of each bucket in each document, and the classes.

    Documents come one by one, so their words are never held together.
    """
    rows, buckets, weights, classes = [], [], [], []
    for row, (counts, label) in enumerate(documents):
        total = sum(counts.values()) + PADDING
        hit, share = [], []
        for word, count in counts.items():
            if of_word := grams(word):
                hit += of_word
                share += [count / total / len(of_word)] * len(of_word)
        found, place = np.unique(np.array(hit, np.int32), return_inverse=True)
        rows.append(np.full(len(found), row, np.int32))
        buckets.append(found)
        weights.append(np.bincount(place, share, len(found)).astype(np.float32))
        classes.append(label)
    if not classes:
        return (np.empty(0),) * 4
    return *map(np.concatenate, (rows, buckets, weights)), np.array(classes, float)


@dataclass(frozen=True)
class Weights:
    """Each bucket's weight in each document, by documents and by buckets."""

    rows: np.ndarray
    row_starts: np.ndarray
    bucket: np.ndarray
    weight: np.ndarray
    buckets: np.ndarray
    bucket_starts: np.ndarray
    row_by: np.ndarray
    weight_by: np.ndarray
    root: np.ndarray

    def logits(self, embeddings: np.ndarray, softmax: np.ndarray, bias: float, n: int) -> np.ndarray:
        of_bucket = embeddings @ softmax
        logits = np.full(n, bias - of_bucket @ self.root)
        each = self.weight * of_bucket.astype(np.float32)[self.bucket]
        logits[self.rows] += np.add.reduceat(each, self.row_starts)
        return logits

    def gradients(
        self,
        embeddings: np.ndarray,
        softmax: np.ndarray,
        bias: float,
        toxic: np.ndarray,
        shares: np.ndarray,
    ) -> list:
        """Of the weighted log loss and the decay, by embeddings, softmax and bias."""
        logits = self.logits(embeddings, softmax, bias, len(toxic))
        missed = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - toxic) * shares
        back = np.zeros(len(embeddings))
        each = self.weight_by * missed.astype(np.float32)[self.row_by]
        back[self.buckets] = np.add.reduceat(each, self.bucket_starts)
        back -= missed.sum() * self.root
        return [
            np.outer(back, softmax) + DECAY * embeddings,
            embeddings.T @ back + DECAY * softmax,
            missed.sum(),
        ]


def train(
    documents: Iterable[tuple[dict[str, int], int]], toxic_share: float, seed: int = 7
) -> Model | None:
    """Fit a model on word counts and classes, by gradients over all documents.

    Without a document of each class there is none.

    A softmax over two classes depends on the difference of their weights, so
    that difference is learned. The gradient of every embedding is a multiple
    of it; an epoch therefore needs each bucket's weight in each document once
    forwards and once backwards. Buckets are centred and scaled by the root of
    their mean weight, so that frequent n-grams don't drown the rest.
    ``toxic_share`` is the share of the toxic class in the loss.
    """
    row, bucket, weight, toxic = _matrix(documents)
    n = len(toxic)
    if not 0 < toxic.sum() < n:
        return None
    common = np.bincount(bucket, minlength=BUCKETS) >= RARE
    kept = common[bucket]
    row, bucket, weight = row[kept], bucket[kept], weight[kept]
    if not len(row):
        return Model(np.zeros(BUCKETS), np.log(toxic_share / (1 - toxic_share)))
    root = np.sqrt(np.bincount(bucket, weight, BUCKETS) / n)
    scale = np.where(root > 0, 1 / np.maximum(root, 1e-12), 0)
    weight *= scale[bucket].astype(np.float32)

    row_starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    rows = row[row_starts]
    order = np.argsort(bucket, kind="stable")
    row_by, weight_by, sorted_bucket = row[order], weight[order], bucket[order]
    bucket_starts = np.flatnonzero(np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]])
    buckets = sorted_bucket[bucket_starts]
    del row, order, sorted_bucket

    shares = np.where(
        toxic == 1, toxic_share / toxic.sum(), (1 - toxic_share) / (n - toxic.sum())
    )
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 0.01 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    softmax = random.normal(0, 1, DIMENSIONS)
    softmax /= np.linalg.norm(softmax)
    bias = np.log(toxic_share / (1 - toxic_share))
    weights = Weights(
        rows, row_starts, bucket, weight, buckets, bucket_starts, row_by, weight_by, root
    )
    moves = [np.zeros_like(embeddings), np.zeros_like(softmax), 0.0]
    for _ in range(EPOCHS):
        gradients = weights.gradients(embeddings, softmax, bias, toxic, shares)
        moves = [MOMENTUM * move - RATE * step for move, step in zip(moves, gradients)]
        embeddings += moves[0]
        softmax += moves[1]
        bias += moves[2]
    of_bucket = embeddings @ softmax
    return Model(of_bucket * scale, bias - of_bucket @ root)


def learning_words(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    fold: int = 0,
    documents_each: int = DOCUMENTS_EACH,
    words_each: int = WORDS_EACH,
    words_of_one: int = WORDS_OF_ONE,
) -> tuple[DataFrame, float]:
    """(words, toxic, place) of a bounded number of documents; the toxic share of all labels."""
    spark = docs.sparkSession
    usable = (
        labels.filter(~is_held_out(folds, fold) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    seen = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    chosen = first_by_hash(usable, "toxic", "doc_id", documents_each)
    chosen = chosen.select(F.col("doc_id").alias("labelled"), "toxic", "place")
    # Bounded by documents_each, two numbers a row.
    texts = docs.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("labelled")
    )
    split = texts.select("toxic", "place", F.explode(F.split("text", f"{SPACE}+")).alias("word"))
    counts = split.filter("word <> ''").groupBy("toxic", "place", "word").count()
    counts = staged(counts, "words")
    # A row per chosen document.
    sizes = counts.groupBy("toxic", "place").agg(F.count("*").alias("n")).collect()
    kept, held = [], {}
    most = min(words_of_one, words_each)
    for row in sorted(sizes, key=lambda row: (row["toxic"], row["place"])):
        n = min(row["n"], most)
        if held.get(row["toxic"], 0) + n <= words_each:
            held[row["toxic"]] = held.get(row["toxic"], 0) + n
            kept.append((row["toxic"], row["place"], min(1.0, most / row["n"])))
    fitting = spark.createDataFrame(kept, "toxic int, place int, share double")
    part = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    learning = (
        counts.join(F.broadcast(fitting), ["toxic", "place"])
        .filter(part < F.col("share"))
        .groupBy("toxic", "place")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", "count")))).alias("words"))
        .select("words", "toxic", "place")
    )
    return staged(learning, "learning"), seen.get(1, 0) / max(1, sum(seen.values()))


@functools.lru_cache(maxsize=2)
def _remembered(key: str) -> dict[str, float]:
    """The words that a worker has met, for one model."""
    return {}


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Learns from labels whose id's crc32 modulo ``folds`` is not ``fold``; a
    document labelled both ways counts as toxic. Rows without an id are held
    out. A NULL, empty or wordless text has the score of the bias alone. Where
    not both classes have a document to learn from, every score is 0.
    """
    spark = docs.sparkSession
    ship(spark)
    learning, share = learning_words(docs, labels, folds, fold)
    rows = learning.orderBy("toxic", "place").toLocalIterator()
    model = train(((row["words"], row["toxic"]) for row in rows), share)
    shared = spark.sparkContext.broadcast(model)  # a number per bucket, whatever the input
    key = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, _remembered(key)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model is not None:
                scores = np.concatenate([*_logits(batch.column("text"), model, known), []])
                scores = 1 / (1 + np.exp(-np.clip(scores, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    texts = docs.select("doc_id", is_held_out(folds, fold).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return texts.mapInArrow(score, schema)


def _logits(texts: pa.Array, model: Model, known: dict[str, float]) -> Iterator[np.ndarray]:
    """Logits of texts, slice by slice: the bias and the mean over a text's words."""
    texts = texts.cast(pa.string()).fill_null("")
    sizes = pc.binary_length(texts).to_numpy()
    first = 0
    while first < len(texts):
        room = int(np.searchsorted(np.cumsum(sizes[first:]), SLICE_BYTES, "right"))
        slice_ = texts[first : first + max(1, room)]
        split = pc.ascii_split_whitespace(slice_)
        words = split.values.dictionary_encode()
        distinct = words.dictionary.to_pylist()
        values = np.zeros(len(distinct))
        for i, word in enumerate(distinct):
            value = known.get(word)
            if value is None:
                value = model.of_word(word)
                if len(known) < CACHED_WORDS:
                    known[word] = value
            values[i] = value
        real = np.array([bool(word) for word in distinct], float)
        at, starts = words.indices.to_numpy(), split.offsets.to_numpy()
        text_of = np.repeat(np.arange(len(slice_)), np.diff(starts))
        total = np.bincount(text_of, values[at], len(slice_))
        count = np.bincount(text_of, real[at], len(slice_))
        yield model.bias + total / (count + PADDING)
        first += max(1, room)
