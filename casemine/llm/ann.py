"""Nearest neighbours: 2-stable projections, kd-trees, a chi-square stopping test.

Vectors are scaled to length one, so that the largest cosine is the smallest
distance, and projected on ``PROJECTIONS`` Gaussian directions.  The squared
projected distance of two points over their squared true distance follows a
chi-square law with that many degrees of freedom.  A search therefore looks at
points in the order of their projected distance, verifies each with the true
measure, and stops when what is still ahead is so far in the projection that a
point closer than the current k-th best would have a chance of ``1 - CERTAINTY``
at most to lie there.

On Spark: the top of a kd-tree over the projections is fitted on a bounded
sample (``SAMPLE`` rows chosen by a hash of the id); every row is indexed by
dropping down that tree into a cell.  Cells with more than ``CELL_ROWS`` rows
are dealt into parts by a hash.  A query first searches the parts of its own
cell, which bounds its k-th distance; then the other cells whose boxes the
stopping test does not exclude.  Inside a part a local kd-tree gives leaves;
queries visit them in the order of projected distance to their boxes, all
queries of a round together, until the test holds for each.  Of equal vectors
only the k + 1 smallest ids are searched (no query needs more), so a vector that
a third of all rows share does not fill cells.  Queries of a cell are dealt
into groups too, so no task's memory follows the table.

Scores are cosines of the original vectors in double precision, computed pair
by pair at the end, so that equal vectors get equal scores.  Where different
vectors tie at the cut (scaled copies, vectors of signs), all points within
``TIE`` of it are scored that way and the smaller ids stay.

Edge cases: null ids and vectors, zero vectors and vectors with null or
non-finite components take no part, nor vectors of another length than the
most frequent one; a repeated id is not its own neighbour, asks with the least
of its vectors (by their bytes) and is found by its nearest one; fewer than k
candidates give fewer rows; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

PROJECTIONS = 8
CERTAINTY = 0.995
SAMPLE = 16_384
CELL_ROWS = 8_192
QUERY_ROWS = 4_096
LEAF = 64
TIE = 1e-12  # scores that rounding may have put in either order
SEED = 20
SCHEMA = "query_id long, vec_id long, score double"


def chi_square_bound(freedom: int, certainty: float) -> float:
    """x with P(chi-square <= x) = certainty, for an even number of degrees."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(freedom // 2))
        low, high = (x, high) if 1 - tail < certainty else (low, x)
    return high


FAR = chi_square_bound(PROJECTIONS, CERTAINTY)


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(size, PROJECTIONS))


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def split(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """kd-tree leaves: halves by the median of the widest coordinate."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        axis = int(np.ptp(points[rows], axis=0).argmax())
        order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
        todo += [order[:len(rows) // 2], order[len(rows) // 2:]]
    return out


class Top:
    """The tree of cells: ``axis`` and ``at`` of inner nodes in heap order."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.at = np.zeros(1 << depth, dtype=int), np.zeros(1 << depth)
        node = np.ones(len(sample), dtype=int)
        for _ in range(depth):
            for i in np.unique(node):
                rows = sample[node == i]
                self.axis[i] = np.ptp(rows, axis=0).argmax()
                self.at[i] = np.median(rows[:, self.axis[i]])
            node = self._down(sample, node)

    def _down(self, points: np.ndarray, node: np.ndarray) -> np.ndarray:
        return 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.at[node])

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=int)
        for _ in range(self.depth):
            node = self._down(points, node)
        return node - (1 << self.depth)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corner of every cell."""
        low, high = np.full((1, PROJECTIONS), -np.inf), np.full((1, PROJECTIONS), np.inf)
        for level in range(self.depth):
            nodes = np.arange(1 << level, 2 << level)
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            axis, at = self.axis[nodes], self.at[nodes]
            high[0::2][np.arange(len(nodes)), axis] = np.minimum(high[0::2][np.arange(len(nodes)), axis], at)
            low[1::2][np.arange(len(nodes)), axis] = np.maximum(low[1::2][np.arange(len(nodes)), axis], at)
        return low, high


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        gap = np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0)
        out += gap * gap
    return out


def vectors(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, size)


def exact(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine; very small or large vectors are scaled before they are squared."""
    aa, bb = np.dot(a, a), np.dot(b, b)
    if not (1e-200 < aa < 1e200 and 1e-200 < bb < 1e200):
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        aa, bb = np.dot(a, a), np.dot(b, b)
    return float(np.dot(a, b) / (math.sqrt(aa) * math.sqrt(bb)))


def _exact_rows(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``exact`` of one vector with many."""
    aa, bb = np.dot(a, a), np.vecdot(rows, rows)
    plain = (1e-200 < bb) & (bb < 1e200) & (1e-200 < aa < 1e200)
    out = np.empty(len(rows))
    out[plain] = np.vecdot(rows[plain], a) / (math.sqrt(aa) * np.sqrt(bb[plain]))
    for i in np.flatnonzero(~plain):
        out[i] = exact(a, rows[i])
    return out


def _tied(own: int, v: np.ndarray, near: np.ndarray, ids: np.ndarray, data: np.ndarray, first: np.ndarray,
          last: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (-score, id) among the points ``near``, smaller ids first."""
    minus = -_exact_rows(v, data[first[near]])
    size = np.minimum(last[near] - first[near], k + 1)  # the query itself may be one of equal vectors
    row = np.repeat(first[near], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    minus, some = np.repeat(minus, size), ids[row]
    minus, some = minus[some != own], some[some != own]
    order = np.lexsort((some, minus))[:k]
    return list(zip(minus[order].tolist(), some[order].tolist()))


def _first_of(own: int, ranked: list[tuple[float, int]], k: int) -> list[tuple[int, int, float]]:
    """The first k different ids of (-score, id), as (query id, id, score)."""
    best: dict[int, float] = {}
    for minus, x in ranked:
        if x not in best:
            if len(best) == k:
                break
            best[x] = -minus
    return [(own, x, score) for x, score in best.items()]


def search(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bound: np.ndarray,
           k: int) -> list[tuple[int, int, float]]:
    """The k best of a part for every query: (query id, id, score).  ``bound``
    is the cosine each query has to beat or equal.  An id with several vectors
    counts once, by its best one."""
    if not len(ids) or not len(query_ids):
        return []
    # so many rows hold k ids beside the query's own, whichever they are
    wanted, most = k, int(np.unique(ids, return_counts=True)[1].max())
    k = (k + 1) * most - 1
    order = np.lexsort((ids, *data.T[::-1]))
    ids, data = ids[order], data[order]
    first = np.flatnonzero(np.r_[True, (data[1:] != data[:-1]).any(axis=1)])
    last = np.r_[first[1:], len(ids)]
    points, where = unit(data[first]), directions(data.shape[1])
    q = unit(queries)
    low_points, low_queries = points @ where, q @ where
    leaves = split(low_points, LEAF)
    corners = [(low_points[r].min(axis=0), low_points[r].max(axis=0)) for r in leaves]
    ahead = box_distance(low_queries, *map(np.array, zip(*corners)))
    turn = np.argsort(ahead, axis=1, kind="stable")
    ahead = np.take_along_axis(ahead, turn, axis=1)
    # one more than k, as the query itself may be among them, and the first one
    # that is cut: where it ties, the cut is sorted out at the end
    best = np.full((len(q), k + 2), -2.0)
    which = np.full((len(q), k + 2), -1)
    active = np.arange(len(q))
    for step in range(len(leaves)):
        # the k-th best so far: the query's own point is the best of all, if it is here
        limit = np.maximum(best[active, k], bound[active] - 1e-9)
        reach = FAR * np.maximum(2 - 2 * limit, 0) + 1e-12
        active = active[ahead[active, step] <= reach]
        if not len(active):
            break
        leaf = turn[active, step]
        by = np.argsort(leaf, kind="stable")
        edge = np.flatnonzero(np.r_[True, leaf[by][1:] != leaf[by][:-1]])
        for a, b in zip(edge, [*edge[1:], len(by)]):
            some, rows = active[by[a:b]], leaves[leaf[by[a]]]
            score = np.c_[best[some], q[some] @ points[rows].T]
            name = np.c_[which[some], np.broadcast_to(rows, (len(some), len(rows)))]
            top = np.argsort(-score, axis=1, kind="stable")[:, :k + 2]
            best[some] = np.take_along_axis(score, top, axis=1)
            which[some] = np.take_along_axis(name, top, axis=1)
    ties = (which[:, k + 1] >= 0) & (best[:, k + 1] >= best[:, k] - TIE)
    out = []
    for i, (own, v) in enumerate(zip(query_ids.tolist(), queries)):
        if ties[i]:
            least = best[i, k] - TIE
            reach = FAR * max(2 - 2 * least, 0) + 1e-12
            rows = np.concatenate([leaves[x] for x in turn[i, :np.searchsorted(ahead[i], reach, side="right")]])
            near = rows[points[rows] @ q[i] >= least]
            out += _first_of(own, _tied(own, v, near, ids, data, first, last, k), wanted)
            continue
        found = []
        for p in which[i, :k + 1]:
            if p < 0:
                continue
            some = [x for x in ids[first[p]:last[p]].tolist() if x != own]
            score = exact(v, data[first[p]])
            found += [(-score, x) for x in some[:k]]
        out += _first_of(own, sorted(found), wanted)
    return out


def _visit(index: DataFrame, queries: DataFrame, parts: dict[int, int], size: int, k: int) -> DataFrame:
    """Search: ``queries`` (query_id, v, bound, cell) against the parts of their
    cells; ``parts`` has the number of parts of each cell."""
    counts = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = {c: -(-n // QUERY_ROWS) for c, n in counts.items()}
    cells = sorted(set(parts) & set(groups))
    deal = queries.sparkSession.createDataFrame([(c, parts[c], groups[c]) for c in cells], "cell int, parts int, groups int")
    deal = F.broadcast(deal)  # a row per cell
    right = (queries.join(deal, "cell")
             .withColumn("group", F.pmod(F.xxhash64("query_id", F.lit(1)), F.col("groups")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(F.col("cell").alias("cell"), "part", "group", "query_id", F.col("v").alias("v"), "bound"))
    left = (index.join(deal, "cell")
            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
            .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
            .select("cell", "part", "group", "vec_id", "v"))

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        got = []
        if rows.num_rows and asked.num_rows:
            got = search(rows.column("vec_id").to_numpy(), vectors(rows.column("v"), size),
                         asked.column("query_id").to_numpy(), vectors(asked.column("v"), size),
                         asked.column("bound").to_numpy(), k)
        return pa.table({"query_id": pa.array([g[0] for g in got], pa.int64()),
                         "vec_id": pa.array([g[1] for g in got], pa.int64()),
                         "score": pa.array([g[2] for g in got], pa.float64())})

    key = ["cell", "part", "group"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, SCHEMA)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query; parts give at most k each."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def neighbours(table: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id",
               vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every row that
    ``is_query`` (a condition on the id) names, among all other rows."""
    spark = table.sparkSession
    v = F.col(vector).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.where(F.col(vec_id).isNotNull() & ok).select(
        F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"), is_query.alias("asked"))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, n = sizes["size"], sizes["n"]
    rows = rows.where(F.size("v") == size)
    depth = max(0, min(math.ceil(math.log2(n / CELL_ROWS)) if n > CELL_ROWS else 0, int(math.log2(SAMPLE)) - 5))
    where = directions(size)
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").collect()] if depth else []
    top = Top(unit(np.array(sample)) @ where if depth else np.zeros((0, PROJECTIONS)), depth)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(1)
            data = np.asarray(raw.flatten()).reshape(-1, size)
            cell = top.cell(unit(data) @ where)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in data], pa.binary()), batch.column(2),
                 pa.array(cell.astype(np.int32))], ["vec_id", "v", "asked", "cell"])

    index = cut(rows.mapInArrow(place, "vec_id long, v binary, asked boolean, cell int"))
    asked = index.where("asked").groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("v", "cell")).alias("q"))
    asked = cut(asked.select("query_id", "q.v", "q.cell"))
    # of equal vectors only the k + 1 smallest ids can be among k neighbours;
    # Spark limits the groups of this window before their shuffle
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    index = cut(index.dropDuplicates(["v", "vec_id"]).withColumn("place", place).where(F.col("place") <= k + 1)
                .select("vec_id", "v", "cell"))
    parts = {r["cell"]: -(-r["n"] // CELL_ROWS) for r in
             index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per cell
    home = cut(_visit(index, asked.withColumn("bound", F.lit(-2.0)), parts, size, k))
    kth = _best(home, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    if depth:
        low, high = top.boxes()
        names = np.array(sorted(parts), dtype=np.int32)
        low, high = low[names], high[names]

        def others(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                bound = batch.column(3).to_numpy()
                p = unit(vectors(batch.column(1), size)) @ where
                near = box_distance(p, low, high) <= FAR * np.maximum(2 - 2 * bound, 0)[:, None] + 1e-12
                near &= names[None, :] != batch.column(2).to_numpy()[:, None]
                i, j = np.nonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(bound[i]),
                     pa.array(names[j])], ["query_id", "v", "bound", "cell"])

        wide = asked.join(kth, "query_id", "left").select("query_id", "v", "cell",
                                                          F.coalesce("bound", F.lit(-2.0)).alias("bound"))
        wide = cut(wide.mapInArrow(others, "query_id long, v binary, bound double, cell int"))
        home = home.unionByName(_visit(index, wide, parts, size, k))
    return _best(home, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
