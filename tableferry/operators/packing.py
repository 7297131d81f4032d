"""Chunks: groups of queued tables that are copied together.

First fit, largest first: a table goes to the first chunk with room in bytes and in number of
tables, else it opens a new one.  A table without size always fits by bytes; one larger than the
cap gets a chunk for itself.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.session import settle

def max_tables_per_chunk(queued_rows: int, concurrent_chunks: int) -> int | None:
    """Cap that makes at least as many chunks as can run at once."""
    if queued_rows <= 0 or concurrent_chunks <= 0:
        return None
    return math.ceil(queued_rows / concurrent_chunks)


def count_caps(queued: DataFrame, concurrent_chunks: int) -> DataFrame:
    """Rows and derived count cap of each batch."""
    return queued.groupBy("batch_id").agg(F.count("*").alias("queued_rows")).withColumn(
        "max_tables", F.ceil(F.col("queued_rows") / F.lit(concurrent_chunks)).cast("int")
    )


def plan_chunks(queued: DataFrame, capacity_bytes: int, concurrent_chunks: int | None = None, parts: int = 1) -> DataFrame:
    """Chunk number of every queued table, from 1 in each batch.

    First fit decreasing places tables of one size in a row, so a batch is packed from its distinct
    sizes and how many tables have each: no id, and no more than a row per distinct size of one batch, enters a
    task's Python. The runs it gives are dealt to the ids by their rank within the size.

    With several ``parts`` the sizes of a batch are dealt to so many tasks by a hash, each packs its own by the same rule, and the one
    chunk of each that may be half empty is packed once more with those of the others. No task then holds
    more than its share of the sizes, and all chunks but one of a batch are more than half full, by bytes or by number;
    which tables meet in a chunk differs from the packing in one part.
    """
    rows = queued.select("batch_id", "migration_id", F.coalesce("size_in_bytes", F.lit(0)).alias("size"))
    sizes = rows.groupBy("batch_id", "size").agg(F.count("*").alias("n"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False)
        cap = math.ceil(pdf["n"].sum() / concurrent_chunks) if concurrent_chunks else None
        which, first, last, chunk = first_fit_runs(pdf["size"].tolist(), pdf["n"].tolist(), capacity_bytes, cap)
        size = pdf["size"].to_numpy()[which]
        return pd.DataFrame({"batch_id": pdf["batch_id"].iloc[0], "size": size, "first": first, "last": last, "chunk_id": chunk})

    if parts > 1:
        runs = _packed_in_parts(sizes, capacity_bytes, concurrent_chunks, parts)
    else:
        runs = sizes.groupBy("batch_id").applyInPandas(pack, "batch_id string, size bigint, first bigint, last bigint, chunk_id int")
    places = runs.select("batch_id", "size", F.explode(F.sequence("first", "last")).alias("rank"), "chunk_id")
    return _ranked(rows).join(places, ["batch_id", "size", "rank"]).select("batch_id", "migration_id", "chunk_id")


def _packed_in_parts(sizes: DataFrame, capacity_bytes: int, concurrent_chunks: int | None, parts: int) -> DataFrame:
    """Runs of equal tables and their chunks, packed by several tasks for each batch."""
    totals = sizes.groupBy("batch_id").agg(F.sum("n").alias("total"))
    part = F.pmod(F.xxhash64("batch_id", "size"), F.lit(parts)).cast("int")

    def cap_of(pdf: pd.DataFrame) -> int | None:
        return math.ceil(pdf["total"].iloc[0] / concurrent_chunks) if concurrent_chunks else None

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False)
        cap = cap_of(pdf)
        which, first, last, chunk = first_fit_runs(pdf["size"].tolist(), pdf["n"].tolist(), capacity_bytes, cap)
        size, n = pdf["size"].to_numpy()[which], last - first + 1
        held, tables = np.zeros((2, chunk.max() + 1), np.int64)
        np.add.at(held, chunk, size * n)
        np.add.at(tables, chunk, n)
        # What did not fit into a chunk that is half empty would be more than half of another: there is one at most.
        full = (held > capacity_bytes / 2) | (tables > (cap or np.inf) / 2)
        full[0] = False
        local = np.where(full, np.cumsum(full), 0)[chunk]
        given = {c: pdf[c].iloc[0] for c in ("batch_id", "part", "total")}
        return pd.DataFrame({**given, "size": size, "first": first, "last": last, "local": local})

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        cap, full = cap_of(pdf), int(pdf["full"].sum())
        held: list[list[int]] = []
        chunk = {}
        for p, size, n in sorted(zip(pdf["part"], pdf["held"], pdf["tables"], strict=True), key=lambda u: (-u[1], u[0])):
            if n:
                at = next((i for i, (b, m) in enumerate(held) if b + size <= capacity_bytes and (cap is None or m + n <= cap)), len(held))
                if at == len(held):
                    held.append([0, 0])
                held[at][0] += size
                held[at][1] += n
                chunk[p] = full + at + 1
        pdf = pdf.sort_values("part")
        before = pdf["full"].cumsum() - pdf["full"]
        return pd.DataFrame({"batch_id": pdf["batch_id"], "part": pdf["part"], "before": before, "rest": pdf["part"].map(chunk).fillna(0).astype("int64")})

    dealt = sizes.join(totals, "batch_id").withColumn("part", part)
    packed = dealt.groupBy("batch_id", "part").applyInPandas(
        pack, "batch_id string, part int, total bigint, size bigint, first bigint, last bigint, local bigint"
    )
    packed = settle(packed, "packed")
    n = F.col("last") - F.col("first") + 1
    open_ = F.col("local") == 0
    # One row per part.
    rests = packed.groupBy("batch_id", "part", "total").agg(
        F.max("local").alias("full"),
        F.sum(F.when(open_, F.col("size") * n).otherwise(0)).alias("held"),
        F.sum(F.when(open_, n).otherwise(0)).alias("tables"),
    )
    numbers = rests.groupBy("batch_id").applyInPandas(together, "batch_id string, part int, before bigint, rest bigint")
    chunk = F.when(open_, F.col("rest")).otherwise(F.col("before") + F.col("local"))
    return packed.join(numbers, ["batch_id", "part"]).select("batch_id", "size", "first", "last", chunk.cast("int").alias("chunk_id"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with their rank, from 0, by id among those of one batch and size.

    Ranks come from a range sort: within a partition by counting, and from there by the counts of the
    partitions before. So a size that most tables have is ranked by many tasks.
    """
    sorted_ = rows.repartitionByRange("batch_id", "size", "migration_id").withColumn("part", F.spark_partition_id())
    sorted_ = settle(sorted_, "ranked")
    within = Window.partitionBy("part", "batch_id", "size").orderBy("migration_id")
    before = Window.partitionBy("batch_id", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sorted_.groupBy("batch_id", "size", "part").agg(F.count("*").alias("n"))
    starts = parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    local = sorted_.withColumn("local", F.row_number().over(within) - 1)
    return local.join(starts, ["batch_id", "size", "part"]).withColumn("rank", F.col("start") + F.col("local")).drop("part", "start", "local")


def first_fit_runs(sizes: list[int], counts: list[int], capacity: int, max_tables: int | None):
    """Runs of equal tables that go to one chunk: (index of the size, first, last, chunk number from 1).

    ``sizes`` in the order they are placed, each with a number of tables. Chunks are the leaves of a
    tree whose nodes hold the most room below them, so that the first
    chunk with room is found in as many steps as the tree is deep.
    """
    most = sum(counts)
    width = 1
    room = [-1, -1]
    free: list[int] = []  # bytes left in each chunk, however few tables it may still take
    tables: list[int] = []
    first_open = 0  # first chunk below the count cap: where a table without size goes
    out: list[tuple[int, int, int, int]] = []

    def grown() -> None:
        nonlocal width, room
        old, width = room[width : 2 * width], 2 * width
        room = [-1] * (2 * width)
        room[width : width + len(old)] = old
        for node in range(width - 1, 0, -1):
            room[node] = max(room[2 * node], room[2 * node + 1])

    def put(leaf: int) -> None:
        full = max_tables is not None and tables[leaf] >= max_tables
        node = width + leaf
        room[node] = -1 if full else max(free[leaf], -1)
        while node > 1:
            node >>= 1
            room[node] = max(room[2 * node], room[2 * node + 1])

    for i, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        done = 0
        while done < count:
            if size == 0:
                while first_open < len(free) and max_tables is not None and tables[first_open] >= max_tables:
                    first_open += 1
                leaf = first_open if first_open < len(free) else -1
            elif room[1] >= size:
                leaf = 1
                while leaf < width:
                    leaf = 2 * leaf if room[2 * leaf] >= size else 2 * leaf + 1
                leaf -= width
            else:
                leaf = -1
            if leaf < 0:
                leaf = len(free)
                free.append(capacity)
                tables.append(0)
                while leaf >= width:
                    grown()
            fits = most if size == 0 else max(1, free[leaf] // size)
            k = min(count - done, fits, most if max_tables is None else max_tables - tables[leaf])
            tables[leaf] += k
            free[leaf] -= k * size
            put(leaf)
            out.append((i, done, done + k - 1, leaf + 1))
            done += k
    which, first, last, chunk = (np.array([r[j] for r in out], np.int64) for j in range(4))
    return which, first, last, chunk.astype(np.int32)


def rebuild_chunks(control: DataFrame) -> DataFrame:
    """Chunks of the rows that already have a number: how many tables and bytes each holds."""
    return control.groupBy("batch_id", F.coalesce("chunk_id", F.lit(0)).alias("chunk_id")).agg(
        F.count("*").alias("tables"),
        F.sum(F.coalesce("size_in_bytes", F.lit(0))).alias("total_bytes"),
    )


def chunk_members(control: DataFrame) -> DataFrame:
    """Chunks with the list of their tables' ids.

    Only for rows with a planned chunk, which holds no more tables than its cap.
    """
    return control.filter(F.coalesce("chunk_id", F.lit(0)) > 0).groupBy("batch_id", "chunk_id").agg(
        F.sort_array(F.collect_list("migration_id")).alias("migration_ids"),
        F.sum(F.coalesce("size_in_bytes", F.lit(0))).alias("total_bytes"),
    )


def needs_planning(queued: DataFrame) -> Column:
    return F.coalesce(F.col("chunk_id"), F.lit(0)) == 0


def chunk_balance(chunks: DataFrame) -> DataFrame:
    """Largest chunk over smallest, per batch; balanced means no chunk above twice another."""
    ratio = F.max("total_bytes") / F.nullif(F.min("total_bytes"), F.lit(0))
    return chunks.groupBy("batch_id").agg(
        F.count("*").alias("chunks"),
        F.max("total_bytes").alias("largest_bytes"),
        F.min("total_bytes").alias("smallest_bytes"),
        ratio.cast("double").alias("ratio"),
    ).withColumn("balanced", F.coalesce(F.col("ratio") <= 2, F.lit(False)))
