"""Ranked lexical search of every document for each item, by groups of matched terms.

Most documents hold some of an item's terms, and most of those hold the same
few common ones. For a block of documents and an item, a task sets one bit per
term in a mask of each document that holds it. Documents of one mask are a
group, and a group can score no more than the sum of what its terms score at
most in the block. Groups are evaluated from the highest such sum on, until the
item's worst kept score beats all that is left.

Documents are never joined with items or with each other. Each is cut into
terms once, where only the terms of some item are kept; tasks then hand on the
best few documents of each item that they have met. The items, a stated query
set, come in blocks of bounded size, which the driver sends to the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import ship, staged

#: Documents kept for each item.
BEST = 50
#: Documents, and occurrences of terms in them, whose bitmaps a task holds at a time.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 16_384, 2_000_000
#: Bytes of items that are sent to the tasks together, about.
ITEM_BYTES = 8 << 20
#: Bytes of a text that are cut at a time.
SLICE_BYTES = 4 << 20
#: Documents that are scored together, about, before the next look at the worst kept score.
AT_ONCE = 128

#: Bytes that end a term become blanks and A-Z lower case; others belong to terms.
_FOLD = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte
    if byte >= 0x80 or chr(byte).isalnum()
    else 0x20
    for byte in range(256)
)
_CUT = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded length."""
    raw, start = (text or "").encode(), 0
    while start < len(raw):
        stop = len(raw)
        if stop - start > SLICE_BYTES:
            cut = _CUT.search(raw, start + SLICE_BYTES)
            stop = cut.start() if cut else stop
        yield raw[start:stop].translate(_FOLD).split()
        start = stop


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def lengths_of(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The documents' m, from their numbers of terms."""
    if len(n) and 50 * int(n.max()) * documents >= 1 << 63:
        return np.array([50 + 50 * int(one) * documents // total for one in n], np.int64)
    return 50 + 50 * n * documents // total


@dataclass(frozen=True)
class Items:
    """Items with the numbers of their distinct terms in ``vocabulary``."""

    ids: list[int | None]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def _items(rows: list) -> Items:
    """Rows of one id are one item; items without a term find nothing."""
    vocabulary: dict[bytes, int] = {}
    found: dict[int | None, set[int]] = {}
    for row in rows:
        mine = found.setdefault(row["id"], set())
        for some in terms(row["text"]):
            mine.update(vocabulary.setdefault(term, len(vocabulary)) for term in some)
    found = {item: mine for item, mine in found.items() if mine}
    return Items([*found], [np.array(sorted(mine)) for mine in found.values()], vocabulary)


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """(id, n, terms, counts) of every document with a term: its terms of the items, and how often."""
    wanted = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = wanted.value.get
        for batch in batches:
            kept, n, offsets, held, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column("text")):
                total, mine = 0, Counter()
                for some in terms(text.as_py()):
                    total += len(some)
                    mine.update(map(number, some))
                mine.pop(None, None)
                if total:
                    kept.append(row)
                    n.append(total)
                    held += mine.keys()
                    counts += mine.values()
                    offsets.append(len(held))
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(kept, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(cut, "id long, n long, terms array<int>, counts array<long>")


Kept = tuple[np.ndarray, np.ndarray, np.ndarray]


class Block:
    """The postings of some documents by term, and what each is worth."""

    def __init__(
        self,
        ids: np.ndarray,
        unnamed: np.ndarray,
        m: np.ndarray,
        of: np.ndarray,
        term: np.ndarray,
        tf: np.ndarray,
    ) -> None:
        self.ids, self.unnamed = ids, unnamed
        order = np.lexsort((of, term))
        self.of, term = of[order], term[order]
        tf, lengths = tf[order], m[self.of]
        # Whole numbers; beyond 2^33 occurrences by Python's.
        if len(tf) and int(tf.max()) >= 1 << 33:
            pairs = zip(tf.tolist(), lengths.tolist())
            self.value = np.array([10**9 * t // (1000 * t + 20 * x) for t, x in pairs], np.int64)
        else:
            self.value = 10**9 * tf // (1000 * tf + 20 * lengths)
        self.present, first = np.unique(term, return_index=True)
        self.bounds = np.append(first, len(term))
        self.most = np.maximum.reduceat(self.value, first) if len(term) else self.value

    def _groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents by mask, where each mask's begin, and the masks: a bit per row of ``rows``."""
        masks = np.zeros((len(self.ids), -(-len(rows) // 64)), np.uint64)
        for j, row in enumerate(rows):
            masks[self.of[self.bounds[row] : self.bounds[row + 1]], j >> 6] |= np.uint64(1 << (j & 63))
        order = np.lexsort(masks.T)
        masks = masks[order]
        new = np.ones(len(order), bool)
        new[1:] = (masks[1:] != masks[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        return order, starts, masks[starts]

    def best(self, wanted: np.ndarray, weights: np.ndarray, kept: Kept, most: int) -> Kept:
        """The ``most`` best of ``kept`` and of this block: scores, whether unnamed, ids."""
        rows = np.searchsorted(self.present, wanted)
        there = rows < len(self.present)
        there[there] = self.present[rows[there]] == wanted[there]
        there &= weights[wanted] > 0
        rows, worth = rows[there], weights[wanted[there]]
        if not len(rows):
            return kept
        order, starts, masks = self._groups(rows)
        sizes = np.diff(starts, append=len(order))

        def has(j: int, of: np.ndarray) -> np.ndarray:
            return (of[..., j >> 6] >> np.uint64(j & 63)) & np.uint64(1) > 0

        bound = np.zeros(len(starts), np.int64)
        for j, most_of_it in enumerate(worth * self.most[rows]):
            bound[has(j, masks)] += most_of_it
        ranked = np.argsort(-bound, kind="stable")
        seen = np.cumsum(sizes[ranked])
        at = 0
        while at < len(ranked):
            # Equal scores may still win by id, and none is kept that scores nothing.
            least = max(1, int(kept[0][-1])) if len(kept[0]) == most else 1
            if bound[ranked[at]] < least:
                break
            stop = int(np.searchsorted(seen, (seen[at - 1] if at else 0) + AT_ONCE)) + 1
            groups = ranked[at:stop]
            groups = groups[bound[groups] >= least]
            at = stop
            picked = np.concatenate([order[starts[g] : starts[g] + sizes[g]] for g in groups])
            scores = np.zeros(len(picked), np.int64)
            some = np.bitwise_or.reduce(masks[groups], axis=0)
            for j in filter(lambda j: has(j, some), range(len(rows))):
                first, last = self.bounds[rows[j]], self.bounds[rows[j] + 1]
                place = np.searchsorted(self.of[first:last], picked)
                place = np.minimum(place, last - first - 1)
                match = self.of[first:last][place] == picked
                scores[match] += worth[j] * self.value[first:last][place[match]]
            picked, scores = picked[scores > 0], scores[scores > 0]
            found = (scores, self.unnamed[picked], self.ids[picked])
            scores, unnamed, ids = map(np.concatenate, zip(kept, found))
            first = np.lexsort((ids, unnamed, -scores))[:most]
            kept = (scores[first], unnamed[first], ids[first])
        return kept


def _search(
    held: DataFrame, items: Items, weights: np.ndarray, documents: int, total: int, most: int
) -> DataFrame:
    """Each task's best documents of each item."""
    sent = held.sparkSession.sparkContext.broadcast((items.ids, items.terms, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted, weights = sent.value
        nothing = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        kept: list[Kept] = [nothing] * len(names)

        def blocks() -> Iterator[list[pa.RecordBatch]]:
            waiting, size, documents = [], 0, 0
            for batch in batches:
                for first in range(0, len(batch), BLOCK_DOCUMENTS):
                    part = batch.slice(first, BLOCK_DOCUMENTS)
                    fresh = len(part.column("terms").flatten())
                    if waiting and (
                        documents + len(part) > BLOCK_DOCUMENTS or size + fresh > BLOCK_POSTINGS
                    ):
                        yield waiting
                        waiting, size, documents = [], 0, 0
                    waiting.append(part)
                    size, documents = size + fresh, documents + len(part)
            if waiting:
                yield waiting

        for block in blocks():
            rows = pa.Table.from_batches(block).combine_chunks()
            columns = [rows[name].combine_chunks() for name in ("id", "n", "terms", "counts")]
            ids, n, lists, counts = columns
            sizes = pc.list_value_length(lists).to_numpy()
            found = Block(
                ids.fill_null(0).to_numpy(),
                ids.is_null().to_numpy(zero_copy_only=False),
                lengths_of(n.to_numpy(), documents, total),
                np.repeat(np.arange(len(sizes)), sizes),
                lists.flatten().to_numpy(),
                counts.flatten().to_numpy(),
            )
            for i, mine in enumerate(wanted):
                kept[i] = found.best(mine, weights, kept[i], most)
        sizes = [len(scores) for scores, _, _ in kept]
        if sum(sizes):
            scores, unnamed, ids = map(np.concatenate, zip(*kept))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()).take(pa.array(np.repeat(np.arange(len(names)), sizes))),
                    pa.array(ids, mask=unnamed),
                    pa.array(scores),
                ],
                names=["item_id", "doc_id", "score"],
            )

    return held.mapInArrow(search, "item_id long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``most`` best documents.

    Equal scores go by ascending doc_id, NULL ids last; rows with one doc_id
    rank one by one. Documents that score 0 are not returned, so an item of no
    term, or of terms that no document holds, has no rows. Items with one id,
    NULL included, are one item with the terms of all. A NULL text has no term;
    empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(
        F.col(item_column).cast("long").alias("id"), F.col(item_text_column).alias("text")
    ).filter(F.length("text") > 0)
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        some = _items(asked.filter(block == b).collect())
        held = staged(postings(texts, some), "postings")
        documents, total = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(some.vocabulary), np.int64)
        for row in holding:
            weights[row["term"]] = weight(documents, row["count"])
        parts.append(_search(held, some, weights, documents, total, most))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= most)
        .select("item_id", "rank", "doc_id", "score")
    )


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The same by joins, for small tables.
SQL = f"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS row_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS terms
    FROM documents
),
held AS (SELECT *, len(terms) AS n FROM cut WHERE len(terms) > 0),
size AS (SELECT count(*) AS documents, sum(n) AS total FROM held),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term
    FROM benchmark
),
postings AS (
    SELECT row_id, term, count(*) AS tf
    FROM (SELECT row_id, unnest(terms) AS term FROM held)
    WHERE term IN (SELECT term FROM asked)
    GROUP BY ALL
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), size
),
scored AS (
    SELECT item_id, row_id, sum(weight * ((1000000000 * tf)
               // (1000 * tf + 20 * (50 + (50 * n * documents) // total)))) AS score
    FROM postings JOIN weights USING (term) JOIN asked USING (term)
        JOIN held USING (row_id), size
    GROUP BY item_id, row_id
),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored JOIN held USING (row_id)
    WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {BEST}
"""
