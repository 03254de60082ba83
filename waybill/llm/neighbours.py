"""Approximate nearest neighbours over robust-pruned directed graphs.

Vectors are dealt over shards of bounded size, and each shard builds a graph
of its own: a greedy search for a new point proposes neighbours, and robust
pruning keeps the nearest one, drops what lies nearer to it (by a relaxed
factor) than to the point, and goes on with the rest, so that a few diverse
edges remain. Edges run both ways until a full point prunes its own. The graphs
are stored. A beam search then takes every query through every shard, and the
best of all shards are kept, with exact distances on the original vectors.

A task holds one shard and one batch of queries: points and queries of a shard
come to it as one sorted stream, points first.

Equal vectors are one point of the graph, which knows its smallest ids; a
vector that a third of the rows share costs no more than any other. Points are
inserted in batches, so that searches run side by side in numpy, around the
middle of the shard and in double precision wherever its spread asks for it. A
vector that lies immensely farther out than most has no place in the graph: it
is compared with every query, and as a query with every point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import ship, staged

NEIGHBOURS = 10
#: Points of a shard, and bytes of their vectors, about.
SHARD_POINTS, SHARD_BYTES = 8_192, 64 << 20
#: Edges that a point keeps, and candidates that a search holds while building.
DEGREE, BUILD_BEAM = 32, 64
#: Candidates that a search for a query holds.
QUERY_BEAM = 160
#: The relaxed factor of pruning.
ALPHA = 1.2
#: Times the usual distance from the middle beyond which a vector is far out.
FAR_OUT = 1e9
#: Shards within so many times the usual distance are searched in single precision.
SINGLE = 1e3
#: Tasks, at most; beyond, a task takes several shards one after the other.
MOST_TASKS = 20_000
_BATCH = 512


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, also where squares are too large or small for it."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        apart = points - query
        found = np.sqrt((apart**2).sum(axis=1))
        odd = ~((found > 1e-140) & (found < 1e150))
        if odd.any():
            some = apart[odd]
            largest = np.abs(some).max(axis=1, initial=0.0)
            scale = np.where((largest > 0) & np.isfinite(largest), largest, 1.0)
            found[odd] = scale * np.sqrt(((some / scale[:, None]) ** 2).sum(axis=1))
    return found


class Frame:
    """The middle of a shard and its usual distance from it, in which all is measured."""

    def __init__(self, points: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            self.middle = np.median(points, axis=0)
        self.unit = 1.0
        sizes = self._sizes(points)
        usual = float(np.median(sizes))
        if 0 < usual < np.inf:
            self.unit = usual

    def _sizes(self, points: np.ndarray) -> np.ndarray:
        return np.abs(self.moved(points)).max(axis=1, initial=0.0)

    def moved(self, points: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return (points - self.middle) / self.unit

    def near(self, points: np.ndarray, limit: float = FAR_OUT) -> np.ndarray:
        """Which points are not far out."""
        return self._sizes(points) < limit


class Graph:
    """A directed graph over the rows of ``points``, which are distinct and in a ``Frame``."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, seed: int = 7) -> None:
        self.single = bool(np.abs(points).max(initial=0.0) < SINGLE)
        self.points = points = points.astype(np.float32 if self.single else float)
        n = len(points)
        self.entry = int((points**2).sum(axis=1).argmin()) if n else 0
        if edges is not None:
            self.edges = edges
            return
        self.edges = np.full((n, DEGREE), -1, np.int32)
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]]) if n else order
        done = 1
        while done < n:  # batches grow with the graph, so that a batch sees most of it
            batch = order[done : done + max(1, min(_BATCH, done))]
            self._insert(batch)
            done += len(batch)
        for first in range(0, n, _BATCH):  # once more, with the whole graph in place
            self._insert(order[first : first + _BATCH])

    def _squared(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances from each query to the points in its row of ``ids``; -1 is far."""
        apart = self.points[ids]
        apart -= queries[:, None, :]
        return np.where(ids < 0, np.inf, np.einsum("qkd,qkd->qk", apart, apart))

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest points that greedy searches meet, nearest first; -1 for none."""
        queries = queries.astype(self.points.dtype)
        n = len(queries)
        ids = np.full((n, beam), -1, np.int64)
        ids[:, 0] = self.entry
        far = np.full((n, beam), np.inf)
        far[:, 0] = self._squared(queries, ids[:, :1])[:, 0]
        open_ = np.zeros((n, beam), bool)
        open_[:, 0] = True
        active = np.arange(n)
        while len(active):
            waiting = np.where(open_[active], far[active], np.inf)
            best = waiting.argmin(axis=1)
            alive = np.isfinite(waiting[np.arange(len(active)), best])
            active, best = active[alive], best[alive]
            if not len(active):
                break
            open_[active, best] = False
            nexts = self.edges[ids[active, best]].astype(np.int64)
            held = ids[active]
            nexts[(nexts[:, :, None] == held[:, None, :]).any(axis=2)] = -1
            steps = self._squared(queries[active], nexts)
            every = np.concatenate([held, nexts], axis=1)
            every_far = np.concatenate([far[active], steps], axis=1)
            every_open = np.concatenate([open_[active], nexts >= 0], axis=1)
            order = np.argsort(every_far, axis=1, kind="stable")[:, :beam]
            ids[active] = np.take_along_axis(every, order, axis=1)
            far[active] = np.take_along_axis(every_far, order, axis=1)
            open_[active] = np.take_along_axis(every_open, order, axis=1)
        ids[~np.isfinite(far)] = -1
        return ids, far

    def _prune(self, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """At most DEGREE diverse neighbours out of each row of ``candidates``; -1 is none."""
        rows = np.arange(len(points))
        candidates = np.sort(candidates, axis=1)
        again = np.zeros_like(candidates, bool)
        again[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
        candidates = np.where(again | (candidates == points[:, None]), -1, candidates)
        far = self._squared(self.points[points], candidates)
        order = np.argsort(far, axis=1, kind="stable")
        candidates = np.take_along_axis(candidates, order, axis=1)
        far = np.take_along_axis(far, order, axis=1)
        # Around the point itself, so that little is lost between its neighbours.
        vectors = self.points[candidates] - self.points[points][:, None, :]
        norms = (vectors**2).sum(axis=2)
        dots = vectors @ vectors.transpose(0, 2, 1)
        kept = np.full((len(points), DEGREE), -1, np.int32)
        alive = np.isfinite(far)
        for place in range(DEGREE):
            best = alive.argmax(axis=1)
            some = alive[rows, best]
            if not some.any():
                break
            chosen = candidates[rows, best]
            kept[some, place] = chosen[some]
            between = norms + norms[rows, best][:, None] - 2 * dots[rows, best]
            alive &= ~(ALPHA**2 * between <= far)
            alive[rows, best] = False
        return kept

    def _insert(self, batch: np.ndarray) -> None:
        found, _ = self.search(self.points[batch], BUILD_BEAM)
        self.edges[batch] = self._prune(batch, np.concatenate([found, self.edges[batch]], axis=1))
        # Edges back: (neighbour, point) pairs by neighbour.
        to = self.edges[batch].ravel().astype(np.int64)
        back = np.repeat(batch, DEGREE)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        if not len(to):
            return
        starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        targets, counts = to[starts], np.diff(np.r_[starts, len(to)])
        for first in range(0, len(targets), _BATCH):
            some = slice(first, first + _BATCH)
            news = np.full((len(targets[some]), counts[some].max()), -1)
            column = np.arange(news.shape[1])
            at = starts[some, None] + column
            inside = column < counts[some, None]
            news[inside] = back[at[inside]]
            have = self.edges[targets[some]]
            news[(news[:, :, None] == have[:, None, :]).any(axis=2)] = -1
            every = np.concatenate([have, news], axis=1)
            full = (every >= 0).sum(axis=1) > DEGREE
            # Room left: the edges in front, as they are.
            packed = np.take_along_axis(every, np.argsort(every < 0, axis=1, kind="stable"), axis=1)
            self.edges[targets[some][~full]] = packed[~full, :DEGREE]
            if full.any():
                self.edges[targets[some][full]] = self._prune(targets[some][full], every[full])


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector): one row per id, without NULL, zero or non-finite vectors.

    Of several vectors with one id the smallest in array order counts.
    """
    vector = F.col("vector")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(vector, lambda x: x != 0)
    named = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")
    ).filter(F.col("id").isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False)))
    return named.groupBy("id").agg(F.min("vector").alias("vector"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_points: int = SHARD_POINTS,
    query_beam: int = QUERY_BEAM,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found for each query.

    ``score`` is the Euclidean distance in double precision; ties go to the
    smaller id. A query is not its own neighbour, and vectors of another
    length than a query's are none of its candidates. Rows without an id, and
    vectors that are NULL, zero or hold a NULL or non-finite component, take
    no part; repeated ids count once. Fewer candidates than ``k`` give fewer
    rows, no candidates none.
    """
    ship(vectors.sparkSession)
    every = staged(usable(vectors, id_column, vector_column), "vectors")
    # Distinct vectors with their k + 1 smallest ids: Spark keeps so many per
    # task before it shuffles, so a very common vector is no large group.
    place = Window.partitionBy("vector").orderBy("id")
    points = (
        every.withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    points = staged(points.withColumn("size", F.size("vector")), "points")
    shards, total = _shards(points, shard_points)
    shard = F.col("first") + F.pmod(F.xxhash64(F.col("ids")[0]), F.col("shards")).cast("int")
    tasks = min(total, MOST_TASKS)
    dealt = (
        points.join(F.broadcast(shards), "size")
        .select(shard.alias("shard"), "ids", F.col("vector").cast("array<double>").alias("vector"))
        .repartitionById(tasks, "shard")
        .sortWithinPartitions("shard", F.col("ids")[0])
    )
    graphs = staged(dealt.mapInArrow(_build, _STORED), "graphs")
    asked = usable(queries, id_column, vector_column).withColumn("size", F.size("vector"))
    # Every shard of its length answers a query: its own copy of the stated query set.
    everywhere = asked.join(F.broadcast(shards), "size").select(
        F.explode(F.expr("sequence(first, first + shards - 1)")).alias("shard"),
        F.lit(None).cast("int").alias("place"),
        F.array("id").alias("ids"),
        F.col("vector").cast("array<double>").alias("vector"),
        F.lit(None).cast("array<int>").alias("edges"),
    )
    stream = (
        graphs.unionByName(everywhere)
        .repartitionById(tasks, "shard")
        .sortWithinPartitions("shard", F.asc_nulls_last("place"))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _answers(batches, k, query_beam)

    answers = stream.mapInArrow(answer, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


_STORED = "shard int, place int, ids array<long>, vector array<double>, edges array<int>"


def _shards(points: DataFrame, shard_points: int) -> tuple[DataFrame, int]:
    """Per length of vectors the number of its first shard and how many it has, and the sum of all."""
    rows, total = [], 0
    for row in points.groupBy("size").count().orderBy("size").collect():
        most = max(1, min(shard_points, SHARD_BYTES // (8 * row["size"])))
        shards = -(-row["count"] // most)
        rows.append((row["size"], total, shards))
        total += shards
    schema = "size int, first int, shards int"
    return points.sparkSession.createDataFrame(rows, schema), max(1, total)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows in pieces of one shard each; shards lie one after the other."""
    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for first, stop in zip(bounds, bounds[1:]):
            if stop > first:
                yield int(numbers[first]), batch.slice(first, stop - first)


def _vectors(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    column = rows.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's points with their edges; those far out come last and have none."""

    def built(shard: int, pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(pieces).combine_chunks()
        points = _vectors(rows)
        frame = Frame(points)
        near = frame.near(points)
        order = np.concatenate([np.flatnonzero(near), np.flatnonzero(~near)])
        graph = Graph(frame.moved(points[near]))
        rows = rows.take(pa.array(order))
        inside = len(graph.points)
        edges = pa.array([*graph.edges.tolist(), *[None] * (len(order) - inside)], pa.list_(pa.int32()))
        table = pa.table(
            {
                "shard": pa.array(np.full(len(order), shard), pa.int32()),
                "place": pa.array(np.arange(len(order)), pa.int32()),
                "ids": rows.column("ids"),
                "vector": rows.column("vector"),
                "edges": edges,
            }
        )
        yield from table.to_batches(max_chunksize=2_000)

    now, pieces = None, []
    for shard, piece in _by_shard(batches):
        if shard != now and pieces:
            yield from built(now, pieces)
            pieces = []
        now = shard
        pieces.append(piece)
    if pieces:
        yield from built(now, pieces)


class Shard:
    """A stored shard, ready to be searched."""

    def __init__(self, pieces: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(pieces).combine_chunks()
        self.exact = _vectors(rows)
        lists = rows.column("ids").combine_chunks()
        self.ids = lists.flatten().to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        edges = rows.column("edges").combine_chunks()
        inside = len(edges) - edges.null_count
        self.frame = Frame(self.exact)
        self.graph = Graph(
            self.frame.moved(self.exact[:inside]),
            edges.drop_null().flatten().to_numpy().reshape(inside, DEGREE),
        )
        self.outside = np.arange(inside, len(edges))

    def _found(self, queries: np.ndarray, beam: int) -> Iterator[np.ndarray]:
        """The points that each query is compared with."""
        near = self.frame.near(queries, SINGLE if self.graph.single else FAR_OUT)
        met = np.full((len(queries), beam), -1, np.int64)
        if near.any() and len(self.graph.points):
            met[near], _ = self.graph.search(self.frame.moved(queries[near]), beam)
        for row, is_near in zip(met, near):
            yield np.concatenate([row[row >= 0], self.outside]) if is_near else np.arange(len(self.exact))

    def best(
        self, names: np.ndarray, queries: np.ndarray, k: int, beam: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its ``k`` nearest ids and their exact distances."""
        for query, vector, at in zip(names.tolist(), queries, self._found(queries, beam)):
            score = distances(self.exact[at], vector)
            # Only points that can be among the k + 1 nearest need their ids.
            if len(at) > k + 1:
                some = np.argpartition(score, k)[: k + 1]
                some = np.flatnonzero(score <= score[some].max())
                at, score = at[some], score[some]
            sizes = self.starts[at + 1] - self.starts[at]
            which = np.repeat(np.arange(len(at)), sizes)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            members = self.ids[np.repeat(self.starts[at], sizes) + offset]
            other = members != query
            members, score = members[other], score[which][other]
            order = np.lexsort((members, score))[:k]
            yield query, members[order], score[order]


def _answers(
    batches: Iterator[pa.RecordBatch], k: int, beam: int
) -> Iterator[pa.RecordBatch]:
    now, pieces, shard = None, [], None
    for number, piece in _by_shard(batches):
        if number != now:
            now, pieces, shard = number, [], None
        is_point = piece.column("place").is_valid()
        points = int(pc.sum(is_point).as_py() or 0)
        if points:
            pieces.append(piece.slice(0, points))
        asked = piece.slice(points)
        if not len(asked) or not (pieces or shard):
            continue
        if shard is None:
            shard, pieces = Shard(pieces), []
        names, queries = asked.column("ids").flatten().to_numpy(), _vectors(asked)
        for first in range(0, len(asked), _BATCH):
            some = slice(first, first + _BATCH)
            found = [*shard.best(names[some], queries[some], k, beam)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([q for q, _, _ in found], [len(m) for _, m, _ in found])),
                    pa.array(np.concatenate([m for _, m, _ in found])),
                    pa.array(np.concatenate([s for _, _, s in found])),
                ],
                names=["query_id", "vec_id", "score"],
            )
