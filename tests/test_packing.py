from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableferry.operators import packing as P


def brute_force(sizes, capacity, max_tables):
    totals, counts, out = [], [], []
    for s in sizes:
        fits = [i for i in range(len(totals))
                if (max_tables is None or counts[i] < max_tables) and (capacity - totals[i] >= s or s == 0)]
        if fits:
            i = fits[0]
            totals[i] += s
            counts[i] += 1
        else:
            i = len(totals)
            totals.append(s)
            counts.append(1)
        out.append(i + 1)
    return out


def placed(sizes, capacity, max_tables):
    """Chunk of each of the sizes, which come in falling order, by way of runs."""
    distinct = sorted(set(sizes), reverse=True)
    which, first, last, chunk = P.first_fit_runs(distinct, [sizes.count(s) for s in distinct], capacity, max_tables)
    runs = sorted(zip(which.tolist(), first.tolist(), last.tolist(), chunk.tolist(), strict=True))
    return [c for _, a, b, c in runs for _ in range(b - a + 1)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 120), min_size=1, max_size=60), st.integers(1, 100), st.one_of(st.none(), st.integers(1, 6)))
def test_first_fit_is_the_plain_one(sizes, capacity, max_tables):
    sizes = sorted(sizes, reverse=True)
    assert placed(sizes, capacity, max_tables) == brute_force(sizes, capacity, max_tables)


def test_many_tables_pack_fast():
    sizes = np.sort(np.random.default_rng(1).integers(1, 10**9, 50_000))[::-1]
    which, first, last, chunk = P.first_fit_runs(sizes.tolist(), [1] * len(sizes), 10**10, 100)
    totals = np.bincount(chunk, weights=sizes[which])
    assert totals.max() <= 10**10 and np.bincount(chunk).max() <= 100


def _queued(spark, rows):
    return spark.createDataFrame(rows, "batch_id string, migration_id string, size_in_bytes bigint")


def test_caps_hold_and_every_table_is_placed_once(spark):
    rows = [("a", f"a{i:04d}", (i * 37) % 90) for i in range(300)] + [("b", f"b{i:02d}", None) for i in range(20)]
    got = P.plan_chunks(_queued(spark, rows), 100, 5).collect()
    assert sorted(r["migration_id"] for r in got) == sorted(r[1] for r in rows)
    size = {r[1]: r[2] or 0 for r in rows}
    for batch, cap in (("a", 60), ("b", 4)):
        chunks: dict[int, list[str]] = {}
        for r in got:
            if r["batch_id"] == batch:
                chunks.setdefault(r["chunk_id"], []).append(r["migration_id"])
        assert sorted(chunks) == list(range(1, len(chunks) + 1))
        assert all(len(m) <= cap for m in chunks.values())
        assert all(sum(size[x] for x in m) <= 100 for m in chunks.values())
    assert len({r["chunk_id"] for r in got if r["batch_id"] == "b"}) == 5


def test_a_large_batch_is_packed_as_a_whole(spark):
    n = 60_000
    sizes = [(7 * i) % 97 if i % 3 else 0 for i in range(n)]
    rows = [("hot", f"m{i:05d}", sizes[i]) for i in range(n)] + [("cold", "c", 5)]
    got = P.plan_chunks(_queued(spark, rows).repartition(7), 1000, 200).collect()
    order = sorted(range(n), key=lambda i: (-sizes[i], i))
    want = dict(zip([f"m{i:05d}" for i in order], brute_force([sizes[i] for i in order], 1000, math.ceil(n / 200)), strict=True))
    assert {r["migration_id"]: r["chunk_id"] for r in got if r["batch_id"] == "hot"} == want
    assert [r["chunk_id"] for r in got if r["batch_id"] == "cold"] == [1]


@pytest.mark.parametrize("rows,chunks,cap", [(130, 8, 17), (0, 5, None), (5, 0, None), (3, 5, 1)])
def test_count_cap(rows, chunks, cap):
    assert P.max_tables_per_chunk(rows, chunks) == cap
    if cap:
        assert cap == math.ceil(rows / chunks)


@pytest.mark.parametrize("concurrent", [None, 4, 40])
def test_parts_are_packed_apart(spark, concurrent):
    rng = np.random.default_rng(3)
    sizes = {"many": rng.integers(0, 120, 700).tolist(), "small": [0] * 9 + [3], "large": [500] * 8, "one": [7]}
    rows = [(b, f"{b}{i:04d}", s) for b, of in sizes.items() for i, s in enumerate(of)]
    got = P.plan_chunks(_queued(spark, rows).repartition(5), 100, concurrent, parts=6).collect()
    assert sorted(r["migration_id"] for r in got) == sorted(r[1] for r in rows)
    size = {r[1]: r[2] for r in rows}
    for batch, of in sizes.items():
        cap = math.ceil(len(of) / concurrent) if concurrent else math.inf
        chunks = {}
        for r in got:
            if r["batch_id"] == batch:
                chunks.setdefault(r["chunk_id"], []).append(size[r["migration_id"]])
        assert sorted(chunks) == list(range(1, len(chunks) + 1))
        for held in chunks.values():
            assert len(held) <= cap and (sum(held) <= 100 or sum(s > 0 for s in held) == 1)
        assert sum(2 * sum(c) <= 100 and 2 * len(c) <= cap for c in chunks.values()) <= 1
