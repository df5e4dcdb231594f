"""Nearest neighbours by vantage-point trees, one a shard.

Rows are dealt into shards of about SHARD_ROWS by a hash of their id, and each shard's tree is built in numpy and
stored as one row: the index, in which every valid row is. Queries travel in blocks to all shards. A node holds a
vantage point and, for both halves of its other points, the least and the greatest distance from it; by the triangle
inequality a half holds nothing nearer than the gap between the query's distance and that ring. It is entered if
gap <= factor * (distance of the k-th nearest so far): factor 1 restores exact search, less prunes more.

Distances are double-precision sums in the order of the components, on the original vectors; ties go to the smaller
id. Vectors that are null, all zero or hold null or non-finite components take no part, nor do rows without an id.
Vectors of different lengths are never compared. Rows that repeat an id are candidates of their own; as a query, the
least of them counts. An empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import park

K, FACTOR = 10, 0.9
SHARD_ROWS, QUERY_BLOCK, LEAF = 8192, 256, 128


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All pairs, each summed component by component."""
    total = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        d = q[:, j, None] - x[None, :, j]
        d *= d
        total += d
    return np.sqrt(total)


class VPTree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF, seed: int = 0):
        rng = np.random.default_rng(seed)
        order = np.lexsort((np.arange(len(ids)), ids))
        # node: (start, end, left, right, rings); an inner node's vantage point is its first row
        self.nodes, todo = [], [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][2 + side] = me
            node = [start, end, -1, -1, None]
            self.nodes.append(node)
            if end - start <= max(leaf, 2):
                continue
            pick = int(rng.integers(start, end))
            order[[start, pick]] = order[[pick, start]]
            d = distances(points[order[start : start + 1]], points[order[start + 1 : end]])[0]
            by = np.argsort(d, kind="stable")
            order[start + 1 : end] = order[start + 1 : end][by]
            d, mid = d[by], (end - start - 1) // 2
            node[4] = (d[0], d[mid - 1], d[mid], d[-1])
            todo += [(start + 1, start + 1 + mid, me, 0), (start + 1 + mid, end, me, 1)]
        self.ids, self.points = ids[order], points[order]

    def search(self, ids: np.ndarray, q: np.ndarray, k: int = K, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """(distances, ids) of the k nearest of each query but the rows of its own id; inf where there are fewer."""
        best, who = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)

        def offer(at: np.ndarray, start: int, end: int, d: np.ndarray) -> None:
            found = np.broadcast_to(self.ids[start:end], d.shape)
            d = np.where(found == ids[at, None], np.inf, d)
            d, found = np.concatenate([best[at], d], 1), np.concatenate([who[at], found], 1)
            order = np.lexsort((found, d), axis=1)[:, :k]
            best[at], who[at] = np.take_along_axis(d, order, 1), np.take_along_axis(found, order, 1)

        def visit(n: int, at: np.ndarray) -> None:
            if not len(at):
                return
            start, end, left, right, rings = self.nodes[n]
            if rings is None:
                offer(at, start, end, distances(q[at], self.points[start:end]))
                return
            d = distances(q[at], self.points[start : start + 1])
            offer(at, start, start + 1, d)
            d = d[:, 0]
            gap = [np.maximum(np.maximum(rings[i] - d, d - rings[i + 1]), 0) for i in (0, 2)]
            near = gap[0] <= gap[1]
            for child, first, g in ((left, near, gap[0]), (right, ~near, gap[1]), (right, near, gap[1]), (left, ~near, gap[0])):
                visit(child, at[first & (g <= factor * best[at, k - 1] * (1 + 1e-12))])

        if self.nodes and len(self.ids):
            visit(0, np.arange(len(q)))
        return best, who


def valid(vector: Column) -> Column:
    """Not null nor empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & valid(F.col("v"))).withColumn("dim", F.size("v"))


def _matrix(lists) -> np.ndarray:
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.values.to_numpy(zero_copy_only=False)[flat.offsets[0].as_py() :].reshape(len(flat), -1)


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """rows (id, v, dim) -> dim, shard, shards and the shard's tree."""
    many = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = rows.join(F.broadcast(many), "dim").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")))  # a row for each vector length

    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t["id"].to_numpy(), kind="stable")
        tree = VPTree(t["id"].to_numpy()[order], _matrix(t["v"])[order])
        return pa.table({"dim": t["dim"][:1], "shard": t["shard"][:1], "shards": t["shards"][:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    return dealt.groupBy("dim", "shard").applyInArrow(run, "dim int, shard long, shards long, tree binary")


def search(index: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR) -> DataFrame:
    """queries (id, v, dim) -> query_id, rank, id, score, over all shards."""
    queries = queries.groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.*")
    n = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("n"))
    blocks = queries.join(F.broadcast(n), "dim").groupBy("dim", F.pmod(F.xxhash64("id", F.lit(1)), F.col("n")).alias("block")).agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("v")).alias("vs"))
    shards = index.groupBy("dim").agg(F.max("shards").alias("m"))
    sent = blocks.join(F.broadcast(shards), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    pairs = sent.join(index.select("dim", "shard", "tree"), ["dim", "shard"]).select("ids", "vs", "tree")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values.to_numpy()
                q = batch.column(1)[i].values.to_numpy().reshape(len(ids), -1)
                best, who = pickle.loads(batch.column(2)[i].as_py()).search(ids, q, k, factor)
                ok = np.isfinite(best)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.repeat(ids, ok.sum(1))), "id": pa.array(who[ok]), "score": pa.array(best[ok])})

    found = pairs.mapInArrow(run, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def nearest(df: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """is_query: a condition on the column id. -> query_id, rank (int), the neighbour's id, score."""
    rows = vectors(df, id_col, vector_col)
    found = search(park(build_index(rows), "vptrees"), rows.where(is_query), k, factor)
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")
