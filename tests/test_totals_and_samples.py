"""Running totals of appended history, and samples that look at every part."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import rowcode
from tableferry.operators import reconcile as Q
from tableferry.session import new_folder
from tableferry.sources import stored_tables as ST
from tableferry.streaming import rollups as U


def attempts(spark, n, seed):
    rng = random.Random(seed)
    rows = [(f"m{i}", rng.choice(["SUCCESS", "FAILED"]), rng.randint(0, 9), rng.choice([None, 5]), f"2000-01-0{rng.randint(1, 3)} 10:00:00") for i in range(n)]
    return spark.createDataFrame(rows, "migration_id string, status string, duration_seconds bigint, source_size_bytes bigint, at string").withColumn("created_at", F.col("at").cast("timestamp"))


def test_totals_count_every_append_once(spark, monkeypatch):
    stored = ST.StoredTables(spark, new_folder(spark, "meta"))
    totals = U.attempts_by_day(spark, new_folder(spark, "totals"), stored.path("attempts"), S.ATTEMPTS)
    totals.advance()
    assert totals.read().count() == 0
    stored.create()
    want = Counter()
    for k in range(3):
        part = ST.conform(attempts(spark, 40, k), S.ATTEMPTS)
        stored.append("attempts", part, f"b{k % 2}")
        for r in part.collect():
            want[r["created_at"].date(), r["status"], "attempts"] += 1
            want[r["created_at"].date(), r["status"], "seconds"] += r["duration_seconds"]
            want[r["created_at"].date(), r["status"], "bytes"] += r["source_size_bytes"] or 0
        if k == 1:
            # The driver dies after the sums are written and before they count; the step is made again.
            with monkeypatch.context() as broken:
                broken.setattr(U, "create_once", lambda *a: 1 / 0)
                with pytest.raises(Exception, match="division|ZeroDivision"):
                    totals.advance()
        totals.advance()
        totals.advance()
        got = {(r["day"], r["status"], c): r[c] for r in totals.read().collect() for c in ("attempts", "seconds", "bytes")}
        assert got == dict(want)


def test_every_part_is_sampled(spark):
    rng = random.Random(4)
    rows = [("big", rng.randint(0, 10**6)) for _ in range(3000)] + [("same", 7)] * 2000 + [("few", k) for k in range(3)] + [(None, k) for k in range(50)]
    rows += [("mixed", 1)] * 3000 + [("mixed", k) for k in range(40)]
    source = spark.createDataFrame(rows, "p string, v bigint").repartition(4)
    lost = [r for r in rows if rng.random() < 0.7] + [("new", 1)]
    target = spark.createDataFrame(lost, "p string, v bigint").repartition(3)
    got = {(r["p"], r["row_hash"]): (r["src_count"], r["tgt_count"]) for r in Q.stratified_differences(source, target, ["p"], per_part=20).collect()}
    sha = {(r["p"], r["v"]): r["h"] for r in source.unionAll(target).distinct().withColumn("h", rowcode.row_sha256(source)).collect()}
    left, right = Counter(rows), Counter(lost)
    want = {}
    for part in {p for p, _ in left | right}:
        sample = sorted((r for r in left | right if r[0] == part), key=lambda r: sha[r])[:20]
        want |= {(part, sha[r]): (left[r], right[r]) for r in sample if left[r] != right[r]}
    assert got == want and {p for p, _ in want} >= {"big", "same", "mixed", "new", None}
    assert Q.stratified_differences(source, source.repartition(7), ["p"]).isEmpty()
    assert Q.stratified_differences(source.limit(0), source.limit(0), ["p"]).isEmpty()
