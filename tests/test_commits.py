"""Commit logs, copies by parts, group commits, change feeds and retention."""

from __future__ import annotations

import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.plans import run as R
from tableferry.session import new_folder
from tableferry.sources import commit_log as G
from tableferry.sources import snapshots as V
from tableferry.sources.stored_tables import StoredTables

SCHEMA = T.StructType().add("id", "string").add("v", "integer")


def log(spark, keys=("id",)):
    return G.CommitLog(spark, new_folder(spark, "log"), SCHEMA, list(keys))


def rows(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def state(one):
    return sorted(tuple(r) for r in one.read().collect())


def test_the_latest_published_row_of_a_key_counts(spark):
    one = log(spark)
    assert state(one) == []
    one.append(rows(spark, [("a", 1), ("b", 1)]))
    one.append(rows(spark, [("b", 2), ("c", None)]))
    one.begin(rows(spark, [("a", 99), ("z", 99)]))  # never published
    assert state(one) == [("a", 1), ("b", 2), ("c", None)]
    # New rows may be made from the state they replace.
    one.replace(one.read().withColumn("v", F.col("v") + 10))
    assert state(one) == [("a", 11), ("b", 12), ("c", None)]
    one.append(rows(spark, [("c", 5)]))
    one.replace(None)
    assert state(one) == []
    one.append(rows(spark, [("d", 1)]))
    assert state(one) == [("d", 1)]


def test_a_compaction_covers_only_what_lies_before_open_claims(spark):
    one = log(spark)
    for k in range(3):
        one.append(rows(spark, [("a", k), (f"k{k}", k)]))
    late = one.begin(rows(spark, [("a", 7)]))
    one.append(rows(spark, [("b", 8)]))
    one.compact()
    assert len(one.in_force()) == 2 and state(one) == [("a", 2), ("b", 8), ("k0", 0), ("k1", 1), ("k2", 2)]
    one.publish(late)
    assert ("a", 7) in state(one)
    one.compact()
    assert len(one.in_force()) == 1 and state(one) == [("a", 7), ("b", 8), ("k0", 0), ("k1", 1), ("k2", 2)]
    # Someone who slept through a replacement is told so.
    asleep = one.begin(rows(spark, [("a", 9)]))
    one.replace(rows(spark, [("n", 1)]))
    with pytest.raises(RuntimeError, match="overtaken"):
        one.publish(asleep)
    assert state(one) == [("n", 1)]


def test_many_appends_are_compacted_and_old_folders_go(spark, monkeypatch):
    monkeypatch.setattr(G, "COMPACT_AFTER", 4)
    one = log(spark)
    for k in range(7):
        one.append(rows(spark, [("a", k)]))
    assert len(one.in_force()) <= 4 and state(one) == [("a", 6)]
    open_one = one.begin(rows(spark, [("b", 1)]))
    assert one.vacuum(older_than_hours=1) == 0
    assert one.vacuum(older_than_hours=0) > 0
    assert state(one) == [("a", 6)] and one.vacuum(older_than_hours=0) == 0
    # What is still being written stays, and numbers are not given again.
    one.publish(open_one)
    assert state(one) == [("a", 6), ("b", 1)]
    assert one.append(rows(spark, [("c", 1)])) > open_one.seq


def test_writers_of_one_log_do_not_lose_rows(spark):
    one = log(spark)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: one.append(rows(spark, [(f"w{k}", k)])), range(6)))
    assert state(one) == [(f"w{k}", k) for k in range(6)]


def test_control_rows_of_a_dead_writer_are_not_seen(spark):
    tables = StoredTables(spark, new_folder(spark, "meta"))
    tables.create()
    row = lambda i, s: spark.createDataFrame([(i, s)], "migration_id string, status string")
    assert tables.read("control").count() == 0 and tables.batch("b").count() == 0
    tables.update_batch("b", row("1", "QUEUED"))
    tables.update_batch("c", row("1", "QUEUED"))
    tables.update_batch("b", row("1", "ASSIGNED"))
    tables.begin_update("b", row("1", "LOST"))
    assert {(r["batch_id"], r["status"]) for r in tables.read("control").collect()} == {("b", "ASSIGNED"), ("c", "QUEUED")}
    tables.append("attempts", row("1", "SUCCESS"), "b")
    tables.append("attempts", row("2", "SUCCESS"), "c")
    R.delete_batch(tables, "b")
    assert [r["batch_id"] for r in tables.read("control").collect()] == ["c"]
    assert [r["migration_id"] for r in tables.read("attempts").collect()] == ["2"]
    tables.update_batch("b", row("3", "QUEUED"))
    assert [r["migration_id"] for r in tables.batch("b").collect()] == ["3"]
    with pytest.raises(ValueError, match="batch id"):
        tables.update_batch("a/b", row("1", "QUEUED"))


def store_of(spark):
    return V.SnapshotStore(spark, new_folder(spark, "parts"))


def files_of(store):
    return {p for p in Path(store.root.removeprefix("file:")).rglob("part-*.parquet") if "/tables/" in str(p)}


def table(spark, pairs):
    return spark.createDataFrame(pairs, "k bigint, p string, v double, m map<string,int>, a array<string>")


def content(df):
    return Counter(str(sorted(r.asDict(recursive=True).items())) for r in df.collect())


def test_only_changed_parts_are_written(spark):
    store = store_of(spark)
    first = [(i, random.Random(i).choice(["x", "", None, "y/=%z"]), float(i), {"b": 1, "a": i}, ["q", None]) for i in range(200)]
    store.copy_changed(table(spark, first), "a.b.c", partition_by=["p"])
    before = files_of(store)
    later = [(i, p, v + (i == 3), m, a) for i, p, v, m, a in first]
    touched = first[3][1]
    assert store.copy_changed(table(spark, later), "a.b.c", partition_by=["p"]) == 1
    new = files_of(store) - before
    assert {r["p"] for r in spark.read.parquet(*[str(f) for f in new]).collect()} == {touched}
    assert content(store.read("a.b.c")) == content(table(spark, later)) and content(store.read("a.b.c", 0)) == content(table(spark, first))
    entry = store.ledger().filter("version = 1").first()
    assert entry["num_files"] == len(before) + len(new) - len([f for f in before if spark.read.parquet(str(f)).first()["p"] == touched])
    # The same rows again, in another order: no file is written. A row less in one part and none in another: one part written, one gone.
    before = files_of(store)
    store.copy_changed(table(spark, later[::-1]).repartition(5), "a.b.c", partition_by=["p"])
    assert files_of(store) == before
    fewer = [r for r in later if r[1] != "" and r[0] != 5]
    store.copy_changed(table(spark, fewer), "a.b.c", partition_by=["p"])
    assert content(store.read("a.b.c")) == content(table(spark, fewer))
    # Other columns or another way to cut share nothing; nothing at all is a version, too.
    store.copy_changed(table(spark, fewer).drop("m"), "a.b.c", partition_by=["p"])
    assert store.read("a.b.c").columns == ["k", "p", "v", "a"] and store.read("a.b.c").count() == len(fewer)
    store.copy_changed(table(spark, fewer), "a.b.c", keys=["k"], parts=8)
    assert content(store.read("a.b.c")) == content(table(spark, fewer))
    store.copy_changed(table(spark, []), "a.b.c", keys=["k"], parts=8)
    assert store.read("a.b.c").count() == 0 and store.read("a.b.c").columns == ["k", "p", "v", "m", "a"]
    store.restore("a.b.c", 1)
    assert content(store.read("a.b.c")) == content(table(spark, later))


def plain_changes(before, after):
    left, right = Counter(map(str, before)), Counter(map(str, after))
    gone, come = left - right, right - left
    key = lambda r: r[: r.index(",")]
    lost, won = {key(r) for r in gone}, {key(r) for r in come}
    out = Counter({("update_preimage" if key(r) in won else "delete", r): n for r, n in gone.items()})
    return out + Counter({("update_postimage" if key(r) in lost else "insert", r): n for r, n in come.items()})


@pytest.mark.parametrize("how", [{"keys": ["k"], "parts": 5}, {"partition_by": ["p"]}, None])
def test_changes_are_those_of_a_plain_comparison(spark, how):
    rng = random.Random(6)
    schema = "k bigint, p string, v double"
    first = [(rng.choice([None, *range(60)]), rng.choice(["x", "y", None]), rng.choice([0.0, 1.5, None])) for _ in range(120)]
    later = [r for r in first if rng.random() < 0.8] + [(rng.randint(50, 90), "x", 2.0) for _ in range(20)]
    later = [(k, rng.choice(["x", "z"]) if rng.random() < 0.1 else p, v) for k, p, v in later]
    store = store_of(spark)
    for pairs in (first, later):
        df = spark.createDataFrame(pairs, schema)
        _ = store.copy_changed(df, "a.b.c", **how) if how else store.copy(df, "a.b.c", partition_by=["p"])
    got = Counter((r["_change"], str((r["k"], r["p"], r["v"]))) for r in store.changes("a.b.c", 0, 1, ["k"]).collect())
    assert got == plain_changes(first, later)
    assert store.changes("a.b.c", 1, 1, ["k"]).isEmpty()
    with pytest.raises(ValueError, match="no version"):
        store.changes("a.b.c", 0, 9, ["k"])
    with pytest.raises(ValueError, match="keys"):
        store.changes("a.b.c", 0, 1, ["nope"])


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_chunk_is_committed_by_as_many_jobs_whatever_its_size(spark):
    store, jobs = store_of(spark), []
    for n in (40, 120):
        staged = [store.stage(spark.range(3).coalesce(1), f"a.b.t{i}") for i in range(n)]
        commits = len(store._log.commits())
        jobs.append(jobs_of(spark, f"chunk {n}", lambda s=staged: store.commit(s)))
        assert len(store._log.commits()) == commits + 1
    assert jobs[1] <= jobs[0] + 1
    assert store.ledger().count() == 160 and store.ledger().filter("num_files < 1 OR size_in_bytes < 1").isEmpty()
    assert store.commit([]) == []


def test_retention_keeps_what_versions_still_name(spark):
    store = store_of(spark)
    rows_ = [(i, "xy"[i % 2], 0.0, {}, []) for i in range(40)]
    for change in (0.0, 1.0, 2.0):
        store.copy_changed(table(spark, [(k, p, v + change * (p == "y"), m, a) for k, p, v, m, a in rows_]), "a.b.c", partition_by=["p"])
    store.copy(spark.range(5), "a.b.d")
    half = store.stage(spark.range(6), "a.b.d")
    assert store.vacuum(older_than_hours=1) == 0
    store.expire(keep_versions=1)
    assert store.vacuum(older_than_hours=1) == 0
    # Two folders of part y, of versions 0 and 1, and the copy that was not committed in time.
    assert store.vacuum(older_than_hours=0) == 3 and not Path(half.path.removeprefix("file:")).exists()
    assert store.read("a.b.c").agg(F.sum("v")).first()[0] == 40.0 and store.read("a.b.d").count() == 5
    assert store.copy(spark.range(7), "a.b.d") == 1 and store.read("a.b.d").count() == 7


def test_rows_of_versions_by_parts_are_counted(spark):
    source, target = store_of(spark), store_of(spark)
    rows_ = [(i, "xyz"[i % 3], 0.0, {}, []) for i in range(30)]
    source.copy_changed(table(spark, rows_), "s.b.c", partition_by=["p"])
    source.copy_changed(table(spark, rows_[:20]), "s.b.c", partition_by=["p"])
    target.copy(table(spark, rows_[:20]), "t.b.c", partition_by=["p"])
    target.copy_changed(table(spark, []), "t.b.e")
    records = spark.createDataFrame(
        [("m", "s", "b", "c", "t", "b", "c", 0, 0), ("n", "s", "b", "c", "t", "b", "c", None, None), ("e", "s", "b", "c", "t", "b", "e", 1, 0), ("u", "s", "b", "u", "t", "b", "e", 1, 0)],
        "migration_id string, source_catalog string, source_schema string, source_table string, target_catalog string, target_schema string, target_table string, source_version bigint, target_version bigint",
    )
    got = {r["migration_id"]: (r["source_row_count"], r["target_row_count"], r["count_error"]) for r in R.version_counts(records, source, target).collect()}
    assert got == {"m": (30, 20, None), "n": (20, 20, None), "e": (20, 0, None), "u": (None, 0, "version not in the ledger")}
