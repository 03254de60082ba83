"""SimHash near-duplicates, found with vantage-point trees.

A text's fingerprint has a bit set where more than half of its shingles'
hashes have it. Texts link if their fingerprints differ in few bits, and a
component is whatever links reach.

Distinct fingerprints are dealt over shards by a vantage-point tree, grown
from a bounded sample: each node splits by Hamming distance to a vantage
fingerprint. Where the distance of a fingerprint from the outer side is within
the link distance of the boundary, the triangle inequality allows a link
across, so it goes to the inner side as well; all other branches are pruned.
Any two linked fingerprints thus meet in some shard. A shard is split in the
same way down to small leaves, in which all pairs are compared.

Links are never listed pair by pair. A shard joins what it links and gives out
one edge per fingerprint, to the smallest one of its group; groups from
different shards are then joined by alternating star contraction, a few
rounds of grouping by fingerprint.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.shared import ship, staged

SHINGLE_WORDS = 3
LINK_BITS = 2
#: Fixed value: the seed of the shingle hash.
HASH_SEED = 42

#: Fingerprints that a shard should hold, the most shards of the first tree, and
#: the most fingerprints that it is grown from. Where that makes larger shards,
#: each is dealt again by a tree of its own.
SHARD_SIZE = 16_384
MOST_SHARDS = 4_096
MOST_SAMPLED = 32_768
#: Every pair is compared in groups of up to this size.
LEAF_SIZE = 512
#: Shingles whose bits are counted at a time.
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text; zero for one without a word."""
    # On bytes, lower() and split() know ASCII letters and white space only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(words) - shingle_words] + 1).tolist()]
    ends = [*spaces[shingle_words - 1 :].tolist(), len(joined)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for first in range(0, len(starts), _AT_ONCE):
        at = slice(first, first + _AT_ONCE)
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts[at], ends[at])]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = 2 * counts > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, tie (a hash of the text) and bits, the fingerprint as a signed long, of every row."""
    ship(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), bits], names=["doc_id", "tie", "bits"]
            )

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text_column).alias("tie"),
        F.col(text_column).alias("text"),
    )
    return texts.mapInArrow(compute, "doc_id long, tie long, bits long")


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _split(points: np.ndarray, random: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage fingerprint and radius that part ``points`` best; None if none does.

    Of a few vantages and radii near the median, the one is taken that leaves
    the fewest points just outside of the boundary.
    """
    best = None
    for vantage in random.choice(points, min(len(points), 5), replace=False):
        counts = np.bincount(distances(points, vantage), minlength=66)
        inside = np.cumsum(counts)
        for radius in np.flatnonzero((inside >= 0.35 * len(points)) & (inside <= 0.65 * len(points))):
            copied = counts[radius + 1 : radius + 1 + LINK_BITS].sum()
            if best is None or copied < best[0]:
                best = (copied, vantage, int(radius))
    return best and best[1:]


class VantageTree:
    """Splits fingerprints into shards; a node is (vantage, radius, inner, outer), a leaf its number."""

    def __init__(self, sample: np.ndarray, shards: int, seed: int = 7) -> None:
        self.leaves = 0
        self.root = self._grow(np.unique(sample), shards, np.random.default_rng(seed))

    def _grow(self, points: np.ndarray, shards: int, random: np.random.Generator):
        parted = _split(points, random) if shards > 1 and len(points) > 3 else None
        if not parted:
            self.leaves += 1
            return self.leaves - 1
        vantage, radius = parted
        inner = distances(points, vantage) <= radius
        return (
            vantage,
            radius,
            self._grow(points[inner], shards // 2, random),
            self._grow(points[~inner], shards - shards // 2, random),
        )

    def route(self, points: np.ndarray, link_bits: int) -> Iterator[tuple[int, np.ndarray]]:
        """Shards with the positions of the fingerprints that belong there."""
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, at = waiting.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                yield node, at
                continue
            vantage, radius, inner, outer = node
            far = distances(points[at], vantage)
            waiting.append((inner, at[far <= radius + link_bits]))
            waiting.append((outer, at[far > radius]))


class Groups:
    """Disjoint sets of positions, each named by its smallest member."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the groups of a[i] and b[i], for all i."""
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.parent, b, a)
            self._flatten()

    def _flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return
            self.parent = up


def link(points: np.ndarray, link_bits: int) -> np.ndarray:
    """For each of the distinct, sorted ``points`` the position of its group's smallest."""
    groups, random = Groups(len(points)), np.random.default_rng(7)
    waiting = [np.arange(len(points))]
    while waiting:
        at = waiting.pop()
        parted = _split(points[at], random) if len(at) > LEAF_SIZE else None
        if parted:
            vantage, radius = parted
            far = distances(points[at], vantage)
            inner, outer = at[far <= radius + link_bits], at[far > radius]
            if len(inner) < len(at) and len(outer) < len(at):
                waiting += [inner, outer]
                continue
        for first in range(0, len(at), LEAF_SIZE):
            here = at[first : first + LEAF_SIZE]
            near = np.bitwise_count(points[here][:, None] ^ points[at[first:]][None, :]) <= link_bits
            a, b = np.nonzero(near)
            groups.join(here[a], at[first:][b])
    return groups.parent


def _dealt_again(dealt: DataFrame, shards: int, link_bits: int) -> DataFrame:
    """Shards split into parts of about ``SHARD_SIZE``: (shard, part, bits).

    Every shard's tree is grown in a task, from some eight fingerprints a part.
    It comes first in the stream of its shard, whose fingerprints follow in
    batches, so a task holds a tree and a batch and the driver neither.
    """
    size, every = SHARD_SIZE, max(1, SHARD_SIZE // 8)

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        sample = frame["bits"].to_numpy().view(np.uint64)
        tree = VantageTree(sample, -(-len(sample) * every // size))
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "tree": [pickle.dumps(tree)]})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tree = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("shard").to_numpy()
            bits = batch.column("bits").fill_null(0).to_numpy().view(np.uint64)
            ends = np.flatnonzero(np.diff(numbers)) + 1
            for first, end in zip([0, *ends], [*ends, len(numbers)]):
                if numbers[first] != current:
                    # A shard too small for the sample has no tree, and stays whole.
                    current, tree = numbers[first], VantageTree(np.empty(0, np.uint64), 1)
                stored = batch.column("tree")[int(first)].as_py()
                if stored is not None:
                    tree, first = pickle.loads(stored), first + 1
                for part, at in tree.route(bits[first:end], link_bits):
                    columns = [
                        pa.array(np.full(len(at), current, np.int32)),
                        pa.array(np.full(len(at), part, np.int32)),
                        pa.array(bits[first:end][at].view(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "part", "bits"])

    drawn = dealt.filter(F.pmod(F.xxhash64("bits", F.lit("again")), F.lit(every)) == 0)
    trees = drawn.groupBy("shard").applyInPandas(grow, "shard int, tree binary")
    stream = (
        trees.unionByName(dealt, allowMissingColumns=True)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.col("tree").isNull())
    )
    return stream.select("shard", "tree", "bits").mapInArrow(deal, "shard int, part int, bits long")


def linked_edges(spark: SparkSession, distinct: DataFrame, link_bits: int) -> DataFrame:
    """Edges (bits, root) of fingerprints to smaller ones, which span all links.

    ``distinct`` is a stored table of one row per fingerprint in column bits.
    """
    ship(spark)
    total = distinct.count()
    wanted = -(-total // SHARD_SIZE)
    shards = min(MOST_SHARDS, wanted)
    sample = np.empty(0, np.uint64)
    if shards > 1:
        # An eighth at most, and never more than MOST_SAMPLED or so.
        every = max(8, -(-total // MOST_SAMPLED))
        drawn = distinct.filter(F.pmod(F.xxhash64("bits"), F.lit(every)) == 0).select("bits")
        rows = drawn.limit(2 * MOST_SAMPLED).collect()
        sample = np.array([row["bits"] for row in rows], np.int64).view(np.uint64)
    tree = VantageTree(sample, shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy()
            for shard, at in tree.route(bits.view(np.uint64), link_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(bits[at])],
                    names=["shard", "bits"],
                )

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(frame["bits"].to_numpy().view(np.uint64))
        roots = link(points, link_bits)
        linked = np.flatnonzero(roots != np.arange(len(points)))
        return pd.DataFrame(
            {"bits": points[linked].view(np.int64), "root": points[roots[linked]].view(np.int64)}
        )

    dealt, group = distinct.select("bits").mapInArrow(deal, "shard int, bits long"), ["shard"]
    if wanted > shards:
        dealt, group = _dealt_again(staged(dealt, "dealt"), shards, link_bits), ["shard", "part"]
    return dealt.groupBy(*group).applyInPandas(join, "bits long, root long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b) but the roots.

    Each round moves every neighbour of a node to the smallest one it knows,
    first the larger ones, then the smaller ones, until nothing moves. Rounds
    are written, so a lost executor repeats one of them at most.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))

    def checksum(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        )

    now = staged(edges.toDF("a", "b").filter("a <> b").distinct(), "links")
    known = checksum(now)
    while known[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(smallest(both), "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        down = large.filter("a <> b")
        down = down.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = smallest(down)
        small = (
            down.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = staged(small, "links")
        before, known = known, checksum(now)
        if known == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _rooted(docs: DataFrame, shingle_words: int, link_bits: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (bits, root) of all fingerprints with the root's smallest id."""
    each = staged(fingerprints(docs, shingle_words), "fingerprints")
    distinct = staged(each.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(linked_edges(docs.sparkSession, distinct, link_bits))
    of_root = distinct.join(roots, distinct["bits"] == roots["node"], "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")
    )
    smallest = of_root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return each, of_root.select("bits", "root").join(smallest, "root")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, link_bits: int = LINK_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    ``component_id`` is the smallest doc_id that links reach, the row's own
    included. Rows of equal or NULL doc_id are rows like others; a component
    in which every id is NULL has none. Empty and NULL texts have fingerprint
    zero and link like any other. No rows give none.
    """
    each, rooted = _rooted(docs, shingle_words, link_bits)
    return each.join(rooted, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, link_bits: int = LINK_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with all columns.

    It is the row of the smallest doc_id, NULL last; of several such rows the
    first by a hash of its text, and one of those that are equal in both.
    """
    each, rooted = _rooted(docs, shingle_words, link_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("first")
    stays = each.join(rooted, "bits").groupBy("root").agg(first)
    stays = stays.select(
        F.col("first.doc_id").alias("stay_id"), F.col("first.tie").alias("stay_tie")
    ).distinct()
    row = F.struct(*map(F.col, docs.columns)).alias("row")
    named = docs.select(F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_tie"), row)
    same = F.col("row_id").eqNullSafe(F.col("stay_id")) & (F.col("row_tie") == F.col("stay_tie"))
    # Spark keeps one row per task and key before it shuffles for this.
    one = Window.partitionBy("row_id", "row_tie").orderBy("row_tie")
    kept = named.join(stays, same, "left_semi").withColumn("place", F.row_number().over(one))
    return kept.filter("place = 1").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
