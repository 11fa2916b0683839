"""Approximate nearest neighbours by balanced posting lists.

The index is a set of centroids, fitted on a bounded sample by splitting it again and again
until no part is larger than its share, so lists are balanced; every vector of the table is
then put in the list of its nearest centroid.  Vectors near a boundary are replicated to the
other lists that are at most ``REPLICA_RATIO`` times as far.  Centroids are searched by an
in-memory neighbour graph that a block of points walks together.  A query reads the lists whose
centroid is at most so many times as far as its nearest; that ratio is measured on some queries
whose exact neighbours are known, so that ``RECALL`` of them are reached.  Data without structure
gets a larger ratio.  A table that is its own sample has them at hand; in a larger one the whole
table is searched for them, and the centroids are fitted on rows that are no queries: a query
that helped to place its centroid lies too near to it, which asks for a larger ratio.

Nearness is the largest inner product.  For the index only, vectors get one more component
that makes all norms equal, and queries a zero, so that order by distance is order by inner
product; scores are computed in double precision on the original vectors.

Equal vectors are indexed once and expanded at the end, so no number of copies makes a list
long.  Vectors are dealt to shards and stay there once, with the numbers of their lists; a task
holds a shard and queries pass through it in turns, each scored against the lists it reads.
Products in single precision leave out what cannot be among a query's best, whatever they are
rounded by; the rest is scored in double precision.  Only the best of each shard are passed on.
Queries that found fewer than asked are searched exactly against all rows.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components
takes no part, nor does one whose length is not the table's most frequent length, or a row
without vec_id; of rows that share a vec_id the smallest vector counts; fewer candidates
than asked are all returned; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.skew import attach
from burnish.session import materialise

SAMPLE = 32_768  # vectors the centroids are fitted on, at most about
SAMPLE_BYTES = 32 << 20  # and their size as floats
LIST_ROWS = 200  # vectors a list should hold
MOST_LISTS = 4_096
REPLICAS = 4
REPLICA_RATIO = 1.1
RECALL = 0.97
MEASURED = 200  # sample vectors whose exact neighbours set the ratio
KNOWN = 600  # and queries, where the table is larger than its sample
DEGREE = 16
BLOCK = 2_000  # rows of a list that are scored at once
SHARD_BYTES = 128 << 20  # vectors that a task holds
ASKED = 1_000_000  # queries that pass through a task, at most
TURN = 4_000  # queries that a task scores at once
WORK = 50_000_000  # pairs of a query and a row, below which a task is not worth another
EACH = 20  # vectors that are moved in the time a query takes in a shard, however small
PENDING = 30  # rows of a query that wait to be ranked, about
FEW = 500  # queries that are searched exactly where the rows lie
_POINTS = 500  # points that walk the graph together


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, hash, norm) of the rows that take part, one per vec_id.

    Ids that repeat are found by their number alone; only their rows are brought together.
    """
    v = F.col("embedding")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(finite & F.exists(v, lambda x: x != 0))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    measured = ["vec_id", "v", F.size("v").alias("d"), F.xxhash64("v").alias("hash"), norm.alias("norm")]
    rows = materialise(rows.select("vec_id", v.alias("v")).select(*measured), "vectors")
    again = materialise(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "again")
    if not again.isEmpty():
        marked = attach(rows, again, ["vec_id"])
        one = marked.filter("n IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v")).select(*measured)
        rows = materialise(marked.filter("n IS NULL").drop("n").unionByName(one), "vectors")
    size = rows.groupBy("d").count().orderBy(F.col("count").desc(), "d").limit(1).collect()
    return rows.filter(F.col("d") == (size[0].d if size else 0)).drop("d")


def _split(points: np.ndarray, most: int, random: np.random.Generator) -> list[np.ndarray]:
    """Centroids of parts of at most ``most`` points each, by repeated k-means splits."""
    if len(points) <= most:
        return [points.mean(axis=0)]
    ways = int(min(16, max(2, -(-len(points) // most))))
    centres = points[random.choice(len(points), ways, replace=False)]
    for _ in range(8):
        near = (-2 * points @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
        centres = np.stack([points[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(ways)])
    near = (-2 * points @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
    if np.bincount(near, minlength=ways).max() > 0.95 * len(points):  # no structure: halve along the widest axis
        near = (np.argsort(np.argsort(points[:, points.var(axis=0).argmax()], kind="stable")) >= len(points) // 2).astype(int)
    return [c for i in np.unique(near) for c in _split(points[near == i], most, random)]


def build(sample: np.ndarray, lists: int, longest: float, k: int, recall: float = RECALL, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> dict:
    """Centroids of the lifted sample, the graph over them, and the ratio that reaches ``recall``.

    ``known``: queries, vectors near them, and the place of each vector's query; without it sample vectors are the queries.
    """
    points = _lift(sample, longest)
    centres = np.stack(_split(points, max(1, -(-len(points) // max(1, lists))), np.random.default_rng(7))).astype(np.float32)
    graph = np.zeros((len(centres), min(DEGREE, len(centres) - 1)), np.int64)
    for at in range(0, len(centres), _POINTS):
        gaps = _gaps(centres[at : at + _POINTS], centres)
        gaps[np.arange(len(gaps)), at + np.arange(len(gaps))] = np.inf
        graph[at : at + _POINTS] = np.argsort(gaps, axis=1, kind="stable")[:, : graph.shape[1]]
    far = np.random.default_rng(11).integers(0, len(centres), (len(centres), 4))  # long links keep the graph in one piece
    index = {"centres": centres, "graph": np.concatenate((graph, far), axis=1), "entries": np.unique(np.linspace(0, len(centres) - 1, 16).astype(int)), "longest": longest}

    counted = known is not None
    if known is None:
        asked = np.random.default_rng(13).permutation(len(sample))[:MEASURED]
        scores = sample[asked].astype(np.float64) @ sample.astype(np.float64).T
        scores[np.arange(len(asked)), asked] = -np.inf
        near = np.argpartition(-scores, min(k, len(sample) - 1), axis=1)[:, :k]
        known = sample[asked], sample[near.ravel()], np.repeat(np.arange(len(asked)), near.shape[1])
    to_lists = np.sqrt(_gaps(_aim(known[0], longest), centres))
    to_lists /= np.maximum(to_lists.min(axis=1, keepdims=True), 1e-12)
    needed = np.full(len(known[1]), np.inf)
    for at in range(0, len(needed), _POINTS):
        own = np.sqrt(_gaps(_lift(known[1][at : at + _POINTS], longest), centres))
        held = np.argsort(own, axis=1, kind="stable")[:, :REPLICAS]
        held_gap = np.take_along_axis(own, held, axis=1)
        reach = to_lists[known[2][at : at + _POINTS][:, None], held]
        needed[at : at + _POINTS] = np.where(held_gap <= REPLICA_RATIO * held_gap[:, :1] + 1e-6, reach, np.inf).min(axis=1)
    if counted and len(needed):  # what some queries of many reach may be that of all by two standard errors less
        reached = np.bincount(known[2], needed <= np.quantile(needed, recall)) / np.maximum(np.bincount(known[2]), 1)
        recall = min(1.0, recall + 2 * reached.std() / len(reached) ** 0.5)
    index["ratio"] = float(np.quantile(needed, recall)) * (1 + 1e-6) if len(needed) else 1.0
    index["beam"] = int(1.2 * (to_lists <= index["ratio"]).sum(axis=1).max()) + 16
    return index


def _lift(points: np.ndarray, longest: float) -> np.ndarray:
    rest = np.maximum(longest**2 - (points.astype(np.float64) ** 2).sum(axis=1), 0)
    return np.concatenate((points, np.sqrt(rest)[:, None]), axis=1).astype(np.float32)


def _aim(queries: np.ndarray, longest: float) -> np.ndarray:
    norms = np.linalg.norm(queries.astype(np.float64), axis=1, keepdims=True)
    return np.concatenate((queries * (longest / np.maximum(norms, 1e-300)), np.zeros((len(queries), 1))), axis=1).astype(np.float32)


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gaps = (-2 * a) @ b.T
    gaps += (a**2).sum(axis=1)[:, None]
    gaps += (b**2).sum(axis=1)
    return np.maximum(gaps, 0, out=gaps)


def _walk(points: np.ndarray, index: dict, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the centroids met on a walk of the graph, and each point's squared distance to them.

    The points walk together: a step expands what is among the ``beam`` nearest of any of them, so
    each meets all that it would meet alone.  Past half of the centroids all are met at once, in their order.
    """
    centres, graph = index["centres"], index["graph"]
    met, done = np.zeros(len(centres), bool), np.zeros(len(centres), bool)
    nodes, gaps, fresh = np.zeros(0, np.int64), np.zeros((len(points), 0), np.float32), index["entries"]
    while len(fresh):
        if len(nodes) + len(fresh) > len(centres) // 2:
            return np.arange(len(centres)), _gaps(points, centres)
        met[fresh] = True
        nodes, gaps = np.concatenate((nodes, fresh)), np.concatenate((gaps, _gaps(points, centres[fresh])), axis=1)
        best = gaps <= np.partition(gaps, beam - 1, axis=1)[:, beam - 1 : beam] if len(nodes) > beam else np.ones(gaps.shape, bool)
        step = nodes[best.any(axis=0)]
        step = step[~done[step]]
        done[step] = True
        fresh = np.unique(graph[step])
        fresh = fresh[~met[fresh]]
    return nodes, gaps


def nearest_lists(points: np.ndarray, index: dict, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Search of the centroid graph for many points: ``most`` list numbers and distances, nearest first."""
    nodes, gaps = _walk(points, index, min(most + most // 2 + 16, len(index["centres"])))
    out, rows = [], np.arange(len(points))
    for _ in range(min(most, len(nodes))):
        out.append(gaps.argmin(axis=1))
        out.append(gaps[rows, out[-1]])
        gaps[rows, out[-2]] = np.inf
    return nodes[np.stack(out[::2], axis=1)], np.sqrt(np.stack(out[1::2], axis=1))


def reads(points: np.ndarray, index: dict, ratio: float) -> np.ndarray:
    """For each point and list, whether it is at most ``ratio`` times as far as the nearest; the beam is doubled for points that fill it."""
    out = np.zeros((len(points), len(index["centres"])), bool)
    todo, most = np.arange(len(points)), index["beam"]
    while len(todo):
        nodes, gaps = _walk(points[todo], index, min(most + most // 2 + 16, len(index["centres"])))
        near = gaps <= (ratio * np.sqrt(gaps.min(axis=1, keepdims=True)) + 1e-6) ** 2
        if len(nodes) == out.shape[1] and len(todo) == len(out):
            return near
        full = (near.sum(axis=1) >= most) & (len(nodes) < out.shape[1])
        out[todo[~full, None], nodes] = near[~full]
        todo, most = todo[full], 2 * most
    return out


def lists_within(points: np.ndarray, index: dict, ratio: float) -> list[list[int]]:
    """The lists at most ``ratio`` times as far as the nearest."""
    return [np.flatnonzero(x).tolist() for x in reads(points, index, ratio)]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of lists that are equally long."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten()
    kept = flat if flat.type in (pa.float32(), pa.float64()) else flat.cast(pa.float64())
    return kept.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigner(shared):
    """Iterator function over (cid, v): adds the lists of each vector, nearest first."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not len(batch):
                continue
            found, counts = [], []
            vectors = _matrix(batch.column("v"))
            for at in range(0, len(vectors), _POINTS):
                lists, gaps = nearest_lists(_lift(vectors[at : at + _POINTS].astype(np.float32), index["longest"]), index, REPLICAS)
                near = gaps <= REPLICA_RATIO * gaps[:, :1] + 1e-6
                found.append(lists[near])
                counts.append(near.sum(axis=1))
            ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("v"), lists], names=["cid", "v", "lists"])

    return assign


_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("cid", T.LongType()), T.StructField("score", T.DoubleType())])
_BEST = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("cids", T.ArrayType(T.LongType())), T.StructField("scores", T.ArrayType(T.DoubleType()))])


def _ranked(query: np.ndarray, cid: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: by score, then cid; a cid met several times counts once."""
    order = np.lexsort((cid, -score, query))
    new = np.ones(len(order), bool)
    new[1:] = (query[order[1:]] != query[order[:-1]]) | (cid[order[1:]] != cid[order[:-1]])
    order = order[new]
    query = query[order]
    return order[np.arange(len(query)) - np.searchsorted(query, query) < k]


class _Shard:
    """Vectors of a task, each once, and which of them are in each list."""

    def __init__(self, cids: np.ndarray, vectors: np.ndarray, counts: np.ndarray, lists: np.ndarray):
        self.cids, self.vectors = cids, vectors
        order = np.argsort(lists, kind="stable")
        self.rows = np.repeat(np.arange(len(cids), dtype=np.int32), counts)[order]
        self.lists, starts = np.unique(lists[order], return_index=True)
        self.ends = np.append(starts, len(order))
        longest = max(float(np.sqrt((vectors[at : at + BLOCK].astype(np.float64) ** 2).sum(axis=1)).max()) for at in range(0, len(vectors), BLOCK))
        power = 1.0 if vectors.dtype == np.float32 else 2.0 ** -np.frexp(longest)[1] if 0 < longest < np.inf else 1.0
        self.rough = vectors if vectors.dtype == np.float32 else (vectors * power).astype(np.float32)
        # What two products of unit queries can be wrong by; where single precision may overflow nothing is left out.
        slack = 4 * (vectors.shape[1] + 8) * 2.0**-24 * longest * power
        self.slack = np.float32(slack) if 0 < slack < 1e30 else np.float32(np.inf)

    def best(self, queries: np.ndarray, read: np.ndarray, k: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``queries``, cids and scores: the k best of each among the lists it reads; ``read`` is lists x queries."""
        exact = queries.astype(np.float64)
        unit = exact / np.abs(exact).max(axis=1, keepdims=True)
        unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
        bound = np.full(len(queries), -np.inf, np.float32)
        which, what, rough = [], [], []
        waits = 0

        def scored(q: np.ndarray, r: np.ndarray) -> np.ndarray:
            out = np.empty(len(q))
            for at in range(0, len(q), 50_000):
                some = slice(at, at + 50_000)
                out[some] = np.einsum("ij,ij->i", exact[q[some]], self.vectors[r[some]].astype(np.float64))
            return out

        def ranked(cut: bool) -> None:
            q, r, s = (np.concatenate(x) for x in (which, what, rough))
            pair = q.astype(np.int64) * len(self.cids) + r
            order = pair.argsort()
            order = order[np.append(True, np.diff(pair[order]) > 0)]
            q, s = q[order], s[order]
            falling = s.view(np.int32) ^ np.where(s < 0, 0, 0x7FFFFFFF).astype(np.int32)  # orders as -s does
            by = (q.astype(np.int64) * 2**32 + falling).argsort()
            q, r, s = q[by], r[order[by]], s[by]
            last = np.searchsorted(q, np.arange(len(queries))) + k - 1
            full = np.flatnonzero((last < len(q)) & (q[np.minimum(last, len(q) - 1)] == np.arange(len(queries))))
            bound[full] = np.maximum(bound[full], s[last[full]] - self.slack)
            near = ~(s < bound[q])
            q, r, s = q[near], r[near], s[near]
            if cut or len(q) > 4 * k * len(queries):  # many are almost as good as the k-th
                own = _ranked(q, self.cids[r], scored(q, r), k)
                q, r, s = q[own], r[own], s[own]
            which[:], what[:], rough[:] = [q], [r], [s]

        for at in np.flatnonzero(read.any(axis=1)):
            by = np.flatnonzero(read[at])
            own = self.rows[self.ends[at] : self.ends[at + 1]]
            asked = unit[by]
            for some in (own[i : i + block] for i in range(0, len(own), block)):
                scores = asked @ self.rough[some].T
                least = bound[by]
                if len(some) > k and (first := np.flatnonzero(np.isneginf(least))).size and np.isfinite(self.slack):
                    least[first] = -np.partition(-scores[first], k - 1, axis=1)[:, k - 1] - self.slack
                    bound[by[first]] = least[first]
                some_q = np.flatnonzero(~(scores.max(axis=1) < least))
                if not len(some_q):
                    continue
                scores = scores[some_q]
                hit = np.flatnonzero(~(scores < least[some_q, None]))
                q, r = np.divmod(hit, len(some))
                which.append(by[some_q[q]].astype(np.int32))
                what.append(some[r])
                rough.append(scores.ravel()[hit])
                waits += len(hit)
                if waits > PENDING * len(queries):
                    ranked(False)
                    waits = 0
        if not which:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        ranked(True)
        q, r = which[0], what[0]
        return q, self.cids[r], scored(q, r)


def _searcher(shared, k: int, most: int, block: int):
    """Iterator function over the rows of one shard, vectors before queries: the k best of each query in it."""

    def search_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value if shared is not None else None
        held, filled, cids, counts, lists = None, 0, [], [], []
        shard, ids, asked = None, [], []

        def turn(ids: np.ndarray, queries: np.ndarray) -> pa.RecordBatch:
            read = np.ones((1, len(queries)), bool)
            if index is not None:
                read = np.empty((len(shard.lists), len(queries)), bool)
                for at in range(0, len(queries), _POINTS):
                    aims = _aim(queries[at : at + _POINTS].astype(np.float32), index["longest"])
                    near = reads(aims, index, index["ratio"]).T
                    read[:, at : at + _POINTS] = near if len(near) == len(shard.lists) else near[shard.lists]
            place, cid, score = shard.best(queries, read, k, block)
            ends = np.searchsorted(place, np.arange(len(ids) + 1))
            offsets = pa.array(ends, pa.int32())
            arrays = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(cid, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(score, pa.float64()))]
            return pa.RecordBatch.from_arrays(arrays, names=_BEST.names).filter(pa.array(ends[1:] > ends[:-1]))

        for batch in batches:
            first = int(np.count_nonzero(batch.column("kind").to_numpy() == 0))
            if first:
                part = batch.slice(0, first)
                vectors = _matrix(part.column("v"))
                if held is None:
                    held = np.empty((max(most, first), vectors.shape[1]), vectors.dtype)
                if filled + first > len(held):
                    held = np.concatenate((held[:filled], np.empty((max(first, len(held) // 4), held.shape[1]), held.dtype)))
                held[filled : filled + first] = vectors
                filled += first
                cids.append(part.column("id").to_numpy())
                of = part.column("lists")
                counts.append(np.diff(of.offsets.to_numpy()))
                lists.append(of.flatten().to_numpy())
            if first == len(batch) or held is None:
                continue
            if shard is None:
                shard = _Shard(np.concatenate(cids), held[:filled], np.concatenate(counts), np.concatenate(lists))
                cids, counts, lists = [], [], []
            part = batch.slice(first)
            ids.append(part.column("id").to_numpy())
            asked.append(_matrix(part.column("v")))
            if sum(map(len, ids)) >= TURN:
                every, rows = np.concatenate(ids), np.concatenate(asked)
                whole = len(every) // TURN * TURN
                for at in range(0, whole, TURN):
                    yield turn(every[at : at + TURN], rows[at : at + TURN])
                ids, asked = [every[whole:]], [rows[whole:]]
        if sum(map(len, ids)):
            yield turn(np.concatenate(ids), np.concatenate(asked))

    return search_shard


def _merger(k: int):
    """Iterator function over rows of ``_BEST`` sorted by query: the k best of each query."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(rows: pa.Table) -> pa.RecordBatch:
            cids, scores = (rows.column(c).combine_chunks() for c in ("cids", "scores"))
            query = np.repeat(rows.column("query_id").to_numpy(), np.diff(cids.offsets.to_numpy()))
            cid, score = cids.flatten().to_numpy(), scores.flatten().to_numpy()
            own = _ranked(query, cid, score, k)
            return pa.RecordBatch.from_arrays([pa.array(query[own]), pa.array(cid[own]), pa.array(score[own])], names=_FOUND.names)

        left = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if left is None else pa.concat_tables([left, rows])
            if not len(rows):
                continue
            query = rows.column("query_id").to_numpy()
            whole = int(np.searchsorted(query, query[-1]))  # the last query may go on
            if whole:
                yield best(rows.slice(0, whole))
            left = rows.slice(whole)
        if left is not None and len(left):
            yield best(left)

    return merge


def _tiles(rows: int, asked: int, width: int, tasks: int) -> tuple[int, int]:
    """Shards of the vectors and parts of the queries, so that little is moved; a task takes one of each."""
    least, parts = max(1, -(-rows * width // SHARD_BYTES)), max(1, -(-asked // ASKED))
    wanted = min(2 * tasks, rows * asked // WORK)
    tiles = [(max(least, -(-wanted // p)), p) for p in range(parts, max(parts, wanted) + 1)]
    return min(tiles, key=lambda x: x[1] * rows + EACH * x[0] * asked)


def _scored(listed: DataFrame, asked: DataFrame, size: dict, k: int, block: int, index=None) -> DataFrame:
    """listed (cid, v, lists), asked (query_id, q) -> the k best of each query.

    Vectors are dealt to shards by hash, queries to parts; a shard is repeated for each part
    and a query for each shard.  Without an index every query reads every row.
    """
    spark = listed.sparkSession
    kind = listed.schema["v"].dataType
    width = size["d"] * (4 if kind.elementType == T.FloatType() else 12)
    shards, parts = _tiles(size["n"], asked.count(), width, spark.sparkContext.defaultParallelism)

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    place = lambda c, n: F.pmod(F.xxhash64(F.lit("tile"), c), F.lit(n)).cast("int")
    held = listed.select(place("cid", shards).alias("shard"), each(parts).alias("part"), F.lit(0).alias("kind"), F.col("cid").cast("long").alias("id"), "v", "lists")
    none = F.lit(None).cast("array<int>").alias("lists")
    passing = asked.select(each(shards).alias("shard"), place("query_id", parts).alias("part"), F.lit(1).alias("kind"), F.col("query_id").cast("long").alias("id"), F.col("q").alias("v"), none)
    rows = held.unionByName(passing).withColumn("tile", F.col("shard") * parts + F.col("part")).drop("shard", "part")
    rows = rows.repartitionById(shards * parts, F.col("tile")).sortWithinPartitions("kind").select("kind", "id", "v", "lists")
    best = rows.mapInArrow(_searcher(index, k, int(1.1 * size["n"] / shards) + 1_000, block), _BEST)
    return best.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_merger(k), _FOUND)


def _expanded(found: DataFrame, members: DataFrame | None, k: int) -> DataFrame:
    """Best vector classes -> best rows, without the query's own; ``members`` are the rows of classes that have several."""
    if members is None:
        rows = found.withColumn("vec_id", F.col("cid"))
    else:
        rows = found.join(members, "cid", "left").withColumn("vec_id", F.coalesce("vec_id", "cid"))
    rows = rows.filter(F.col("vec_id") != F.col("query_id"))
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(distinct: DataFrame, asked: np.ndarray, k: int, without: np.ndarray | None = None) -> DataFrame:
    """query, cid, score: the k rows nearest to each of a few queries, named by their place, by a scan of all rows.

    ``without``: for each query a cid that does not count.
    """
    shared = distinct.sparkSession.sparkContext.broadcast((asked.astype(np.float64), without))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, without = shared.value
        query, cid, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.full(len(asked), -np.inf)
        for batch in batches:
            ids = batch.column("cid").to_numpy()
            if not len(ids):
                continue
            new = asked @ _matrix(batch.column("v")).T.astype(np.float64)
            if without is not None:
                new[without[:, None] == ids] = -np.inf
            bound = least
            if len(ids) > k and np.isneginf(least).any():
                bound = np.maximum(least, -np.partition(-new, k - 1, axis=1)[:, k - 1])
            which, what = np.nonzero((new >= bound[:, None]) & (new > -np.inf))
            query, cid, score = np.append(query, which), np.append(cid, ids[what]), np.append(score, new[which, what])
            own = _ranked(query, cid, score, k)
            query, cid, score = query[own], cid[own], score[own]
            full = np.flatnonzero(np.bincount(query, minlength=len(asked)) == k)
            least[full] = score[np.searchsorted(query, full) + k - 1]
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(cid, pa.int64()), pa.array(score, pa.float64())], names=["query", "cid", "score"])

    near = distinct.select(F.col("cid").cast("long").alias("cid"), "v").mapInArrow(nearest, "query long, cid long, score double")
    by = Window.partitionBy("query").orderBy(F.col("score").desc(), "cid")
    return near.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= k).drop("r")


def _known(distinct: DataFrame, queries: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Some queries, the k vectors of the table that are nearest to each, and the place of each vector's query."""
    some = queries.orderBy(F.xxhash64(F.lit("measured"), "query_id"), "query_id").limit(KNOWN).collect()
    asked = np.array([r.q for r in some], np.float64)
    near = materialise(_nearest(distinct, asked, k, np.array([r.cid for r in some], np.int64)), "near")
    rows = distinct.select("cid", "v").join(F.broadcast(near.select("query", "cid")), "cid").select("query", "v").collect()
    vectors = np.array([r.v for r in rows], np.float64).reshape(len(rows), asked.shape[1])
    return asked.astype(np.float32), vectors.astype(np.float32), np.array([r["query"] for r in rows], np.int64)


def _exact(distinct: DataFrame, asked: DataFrame, size: dict, k: int, block: int) -> DataFrame:
    """The k best of each query among all rows.  Rows are not moved for a few queries."""
    some = asked.limit(FEW + 1).collect()
    if len(some) > FEW:
        return _scored(distinct.select("cid", "v", F.array(F.lit(0)).alias("lists")), asked, size, k, block)
    ids = asked.sparkSession.createDataFrame([(i, r.query_id) for i, r in enumerate(some)], "query long, query_id long")
    return _nearest(distinct, np.array([r.q for r in some], np.float64), k).join(F.broadcast(ids), "query").select("query_id", "cid", "score")


def search(vectors: DataFrame, is_query: Column, k: int = 20, lists: int | None = None, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that ``is_query`` names."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    twice = materialise(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "twice")
    members = None
    if twice.isEmpty():
        classed = rows.select("vec_id", "v", "norm", F.col("vec_id").alias("cid"))
    else:
        marked = attach(rows, twice, ["hash"])
        near = marked.filter("n IS NOT NULL").select("vec_id", "v", "norm")
        copied = near.groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
        near = attach(near, copied, ["v"]).select("vec_id", "v", "norm", F.coalesce("first", "vec_id").alias("cid"), F.col("first").isNotNull().alias("several"))
        far = marked.filter("n IS NULL").select("vec_id", "v", "norm", F.col("vec_id").alias("cid"), F.lit(False).alias("several"))
        classed = materialise(near.unionByName(far), "classed")
        first = Window.partitionBy("cid").orderBy("vec_id")
        members = classed.filter("several").select("cid", "vec_id").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).drop("r")
        members = materialise(members, "members")
    distinct = classed.filter(F.col("vec_id") == F.col("cid")).select("cid", "vec_id", "v", "norm")
    queries = classed.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "cid")
    asks = F.coalesce(is_query, F.lit(False))
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"), F.max(F.size("v")).alias("d"), F.count_if(~asks).alias("others")).first().asDict()
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = materialise(queries, "queries")
    chance = F.pmod(F.xxhash64(F.lit("ann"), "cid"), F.lit(1_000_000)) / 1e6
    fitted = min(SAMPLE, SAMPLE_BYTES // (4 * size["d"]) + 1)
    whole = size["n"] <= fitted or queries.isEmpty()
    # A query that takes part in the fit lies nearer to its list than others do.
    pool, of = (distinct.filter(~asks), size["others"]) if not whole and size["others"] >= fitted else (distinct, size["n"])
    sample = pool.filter(chance < fitted / of).select("cid", "v").limit(2 * fitted).toPandas().sort_values("cid")["v"]
    if not len(sample):
        sample = distinct.select("v").limit(1).toPandas()["v"]
    lists = lists or int(min(MOST_LISTS, max(1, size["n"] // LIST_ROWS)))
    known = None if whole else _known(distinct, queries, k)
    index = build(np.stack(sample.to_numpy()).astype(np.float32), lists, float(size["longest"]), k, recall, known)
    index = spark.sparkContext.broadcast(index)
    kind = T.StructType([distinct.schema["cid"], distinct.schema["v"], T.StructField("lists", T.ArrayType(T.IntegerType()))])
    listed = distinct.select("cid", "v").mapInArrow(_assigner(index), kind)
    found = materialise(_expanded(_scored(listed, queries, size, k + 1, block, index), members, k), "found")

    # Queries whose lists held too few rows are searched against everything.
    everything = rows.count()
    few = queries.join(found.groupBy("query_id").count(), "query_id", "left").filter(F.coalesce("count", F.lit(0)) < min(k, everything - 1))
    few = materialise(few.select("query_id", "q"), "few")
    if few.isEmpty():
        return found
    exact = _expanded(_exact(distinct, few, size, k + 1, block), members, k)
    return reduce(DataFrame.unionByName, [found.join(few.select("query_id"), "query_id", "left_anti"), exact])
