"""Connected components of a table of links: tasks join up their own links, joins and minima what is left."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import settle


# Rows for one task of the rounds below.
TASK_ROWS = 100_000


def components(links: DataFrame) -> DataFrame:
    """Every end of a link with the smallest id it can reach: (id, component_id).

    Links (a, b) point from larger to smaller ids; in turn every node's larger neighbours are hung on
    its smallest one, and its smaller ones on the smallest. Both keep components as they are, and the
    number of rounds grows with the logarithm of the longest path. A hub's links are reduced to one
    minimum in each task, and the join back may split them. Before that each task puts its own links,
    ``TASK_ROWS`` or so, in this form; no rounds follow if they are all.
    """
    tasks = max(1, -(-links.count() // TASK_ROWS))
    stars = links.select("a", "b").coalesce(tasks).mapInArrow(_own_stars, "a long, b long")
    if tasks == 1:
        return _named(stars)
    tree = settle(_down(stars), "links")
    seen = _sums(tree)
    while True:
        both = tree.unionAll(tree.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node move to the smallest id among it and its neighbours.
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        wide = settle(wide.where("a <> b").coalesce(tasks), "links")
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        lower = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = settle(_down(near.unionAll(lower.select("a", F.col("m").alias("b")))).coalesce(tasks), "links")
        now = _sums(new)
        if now == seen:
            return _named(new).coalesce(tasks)
        tree, seen = new, now


def _named(stars: DataFrame) -> DataFrame:
    """Links from each node but the roots to the root of its component, as (id, component_id), with the roots."""
    roots = stars.where("a <> b").select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    return stars.where("a <> b").select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionAll(roots)


def _own_stars(batches):
    """A task's links as links to the smallest id that each end reaches by them."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
    ends = [x for x in above if root(x) != x]
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array([root(x) for x in ends], pa.int64())], names=["a", "b"])


def _down(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _sums(links: DataFrame) -> tuple:
    """Number of links and order-free 128 bits of them: sets of equal sums are equal."""
    parts = [F.sum(F.xxhash64(F.lit(k), "a", "b").cast("decimal(38,0)")) for k in (1, 2)]
    return tuple(links.agg(F.count("*"), *parts).first())
