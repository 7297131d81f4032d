"""Exact top-k inner products by no-random-access aggregation of sorted lists.

Vectors become integers, floor(64 * x). The table is cut into shards by a hash of the id; a shard keeps, for
each dimension, a list of its members sorted by that coordinate. A query reads all lists in step, each
from the end that its own coordinate favours. What has been read of a member is its score so far; the
smallest value of a list bounds what an unread coordinate adds from below, the last value read from above.
Members whose upper bound is under the k-th lower bound are outsiders for good. A query stops reading as soon as
no more than ``FEW`` times k members still qualify, or at the last depth; these have their final scores resolved, and the
best of all shards are merged.

A task meets one shard and one group of queries; every query meets every shard once.

Ties go to the smaller vec_id. Vectors that are null, or hold null or non-finite components, take no
part; a query meets vectors of its own length only. Components are to be below 2**20 in size, so that
sums are exact. A repeated row counts as often as it stands there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.shared import runs, settle, shuffle_width

SCALE = 64
SHARD_ROWS = 8192
QUERY_GROUP = 4096
# Queries that read the lists in step.
QUERY_BLOCK = 128
# How deep the lists are read before the bounds are looked at again, as shares of their length.
DEPTHS = (0.6, 0.8, 0.9, 0.95)
# A query stops once at most so many times k members still qualify.
FEW = 4



class SortedLists:
    """Members of a shard and, per dimension, their order by that coordinate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[order], vectors[order].T
        # Whole numbers up to 2**24 are exact in 32 bits.
        self.largest = int(np.abs(vectors).max(initial=0))
        self.vectors = vectors.astype(np.float32 if self.largest < 1 << 24 else np.float64)
        rising = np.argsort(vectors, axis=1, kind="stable")
        self.values = np.take_along_axis(self.vectors, rising, 1)
        self.place = np.empty(rising.shape, np.int32)
        np.put_along_axis(self.place, rising, np.arange(len(ids), dtype=np.int32)[None, :], 1)
        self.at_stop: dict[tuple, tuple] = {}
        self.by_kind: dict[type, np.ndarray] = {}

    def _kind(self, queries: np.ndarray) -> type:
        """32 bits if no sum of products with these queries can pass what is exact in them."""
        most = max(1, self.largest) * max(1, int(np.abs(queries).max(initial=0))) * len(self.vectors)
        return np.float32 if most < 1 << 24 else np.float64

    def _bounds(self, depth: int, kind: type) -> tuple:
        """What a read of ``depth`` entries from either end of each list gives: values read, and what bounds the rest."""
        if (depth, kind) not in self.at_stop:
            n, out = len(self.ids), []
            for open_, worst, frontier in (
                (self.place < n - depth, self.values[:, :1], self.values[:, n - depth, None]),
                (self.place >= depth, self.values[:, -1:], self.values[:, depth - 1, None]),
            ):
                out.append([np.where(open_, bound, self.vectors).astype(kind) for bound in (worst, frontier)])
            self.at_stop[depth, kind] = tuple(np.concatenate((down, up)) for down, up in zip(out[0], out[1], strict=True))
        return self.at_stop[depth, kind]

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """Per query in turn: ids and scores of its best k."""
        n, kind = len(self.ids), self._kind(queries)
        q = queries.astype(kind)
        if kind not in self.by_kind:
            self.by_kind[kind] = self.vectors.astype(kind, copy=False)
        vectors = self.by_kind[kind]
        own = query_ids[:, None] == self.ids[None, :]
        alive = ~own
        # A list is read from its upper end by positive coordinates, from its lower end by negative ones.
        halves = np.concatenate((np.maximum(q, 0), np.minimum(q, 0)), 1)
        # Queries that still read, and how many entries of each list a query has read.
        reading = np.arange(len(q))
        self.read = np.zeros(len(q), int)
        for share in DEPTHS:
            depth = int(n * share)
            if n - 1 <= k or not depth or not len(reading):
                break
            lower, upper = (halves[reading] @ bound for bound in self._bounds(depth, kind))
            lower[own[reading]] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
            alive[reading] &= upper >= kth[:, None]
            self.read[reading] = depth
            reading = reading[alive[reading].sum(1) > FEW * k]
        for i in range(len(q)):
            left = np.flatnonzero(alive[i])
            final = np.rint(q[i] @ vectors[:, left]).astype(np.int64)
            found = np.lexsort((self.ids[left], -final))[:k]
            yield self.ids[left[found]], final[found]


def integers(vector: str = "embedding") -> Column:
    """floor(64 * x) of every component; null if any is null or not finite."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(x, lambda v: F.floor(SCALE * v.cast("double")).cast("long")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the k best others of every row that ``is_query`` marks.

    ``vectors``: (vec_id, embedding); other columns are ignored.
    """
    spark = vectors.sparkSession
    whole = vectors.where("vec_id IS NOT NULL").select("vec_id", integers().alias("v"), is_query.alias("q")).where("size(v) > 0")
    n = {r.q: r.n for r in whole.groupBy("q").agg(F.count("*").alias("n")).collect()}
    queries = n.get(True, 0)
    shards, groups = -(-sum(n.values()) // SHARD_ROWS) or 1, -(-queries // QUERY_GROUP) or 1
    shard, group = (F.pmod(F.xxhash64(F.lit(s), "vec_id"), F.lit(m)).cast("int") for s, m in ((1, shards), (2, groups)))

    def every(m: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(m - 1)))

    members = whole.select(F.size("v").alias("d"), shard.alias("s"), every(groups).alias("g"), F.lit(0).alias("side"), "vec_id", "v")
    asking = whole.where("q").select(F.size("v").alias("d"), every(shards).alias("s"), group.alias("g"), F.lit(1).alias("side"), "vec_id", "v")
    width = max(shuffle_width(spark), 2 * shards * groups)
    dealt = members.unionAll(asking).repartition(width, "d", "s", "g").sortWithinPartitions("d", "s", "g", "side")

    def search(batches):
        lists, held, key = None, [], None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "s", "g", "side", "vec_id")}
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(cols["d"])
            parts = np.column_stack([cols[c] for c in ("d", "s", "g", "side")])
            same = np.concatenate(([0], np.cumsum((parts[1:] != parts[:-1]).any(1)))) if len(parts) else np.zeros(0, int)
            edges = runs(same)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                d, s, g, side = parts[a].tolist()
                rows = flat[ends[a] - d : ends[b - 1]].reshape(-1, d)
                if (d, s, g) != key:
                    key, lists, held = (d, s, g), None, []
                if side == 0:
                    held.append((cols["vec_id"][a:b], rows))
                elif held:
                    if lists is None:
                        lists = SortedLists(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    yield answers(lists, cols["vec_id"][a:b], rows)

    def answers(lists, ids, rows) -> pa.RecordBatch:
        found = []
        for a in range(0, len(ids), QUERY_BLOCK):
            part = slice(a, a + QUERY_BLOCK)
            found += [(q, *best) for q, best in zip(ids[part].tolist(), lists.top(ids[part], rows[part], k), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
                pa.array(np.concatenate([f[2] for f in found]).astype(np.int64)),
            ],
            names=["query_id", "vec_id", "score"],
        )

    # Settled, so that a lost window task does not search again.
    best = settle(dealt.mapInArrow(search, "query_id long, vec_id long, score long"), "topk")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
