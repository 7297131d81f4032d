"""The steps one after the other, over stored tables and versioned copies."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.operators import changes as C
from tableferry.operators import checks as K
from tableferry.operators import reconcile as Q
from tableferry.operators import telemetry as T
from tableferry.plans import run as R
from tableferry.session import new_folder
from tableferry.sources import listing as L
from tableferry.sources import selection_inputs as I
from tableferry.sources.generators import SPECS, generate
from tableferry.sources.snapshots import SnapshotStore
from tableferry.sources.stored_tables import StoredTables

TABLES = ["customer_dim", "revenue_monthly", "empty_staging_table", "single_row_table", "complex_types_table", "pageviews_hourly"]


@pytest.fixture(scope="module")
def source(spark):
    store = SnapshotStore(spark, new_folder(spark, "src")).create()
    for spec in SPECS:
        if spec.table_name in TABLES:
            store.copy(generate(spark, spec, min(spec.rows, 40)), f"prod.{spec.schema_name}.{spec.table_name}", partition_by=spec.partition_by)
    return store


def parts_of(table):
    return next(s.partition_by for s in SPECS if s.table_name == table)


def world(spark, source):
    specs = [s for s in SPECS if s.table_name in TABLES]
    selection = spark.createDataFrame([("prod", s.schema_name, s.table_name, "dr", s.schema_name, s.table_name, i) for i, s in enumerate(specs)], S.SELECTION)
    settings = spark.createDataFrame([("CATALOG", "prod", "", None, "DISABLE")], S.SETTINGS)
    stats = source.ledger().select("table_fqn", F.col("path").alias("location"), "size_in_bytes", "num_files", F.lit("parquet").alias("format"), F.col("committed_at").alias("last_modified"), "version")
    return selection, settings, stats


def stats_of(store):
    return store.ledger().groupBy("table_fqn").agg(
        F.max_by("size_in_bytes", "version").alias("size_in_bytes"), F.max_by("num_files", "version").alias("num_files"),
        F.lit("parquet").alias("format"), F.max("committed_at").alias("last_modified"))


def stored(spark):
    tables = StoredTables(spark, new_folder(spark, "meta"))
    tables.create()
    return tables


def statuses(tables, batch):
    return {r["source_table"]: r["status"] for r in tables.read("control").filter(F.col("batch_id") == batch).collect()}


def no_targets(spark):
    return spark.createDataFrame([], S.LISTING)


def test_onboard_copy_validate_retry(spark, source):
    tables, target = stored(spark), SnapshotStore(spark, new_folder(spark, "tgt")).create()
    selection, settings, stats = world(spark, source)
    rules = spark.createDataFrame([(1, "table", "prod", "sales", "customer_*")], S.RULES)
    run = R.Run("b1", run_id="r1", concurrent_chunks=2, max_attempts=2)
    counters = R.onboard(tables, selection, rules, settings, stats, no_targets(spark), run).first()
    assert (counters["total"], counters["inserted"], counters["po_blocked"]) == (5, 5, 0)
    assert tables.read("exclusion_log").first()["exclusion_rule"] == "table:prod.sales.customer_*"
    control = tables.read("control")
    assert set(statuses(tables, "b1").values()) == {"QUEUED"} and control.filter("chunk_id IS NULL").isEmpty()
    ids = {r["source_table"]: r["migration_id"] for r in control.collect()}

    broken = {"single_row_table"}

    def source_of(row):
        if row["source_table"] in broken:
            raise RuntimeError("socket closed")
        name = ".".join(row[c] for c in S.SOURCE_NAME)
        return source.read(name, row["source_version"]), row["source_version"], parts_of(row["source_table"])

    totals = R.copy_batch(tables, target, source_of, run).first()
    assert (totals["dispatched"], totals["completed_tables"], totals["failed_tables"]) == (5, 4, 1)
    assert statuses(tables, "b1")["single_row_table"] == "RETRY_PENDING"
    failed = tables.read("control").filter("source_table = 'single_row_table'").first()
    assert failed["error_code"] == "CLONE_FAILED" and failed["attempt_number"] == 1 and "socket closed" in failed["error_message"]

    broken.clear()
    stats_row = R.retry_batch(tables, run).first()
    assert (stats_row["eligible"], stats_row["requeued"]) == (1, 1)
    assert R.copy_batch(tables, target, source_of, run).first()["completed_tables"] == 1
    assert set(statuses(tables, "b1").values()) == {"COMPLETED"}
    assert tables.read("attempts").count() == 6
    assert T.orphan_attempts(tables.read("attempts"), tables.read("control")).isEmpty()

    totals = R.validate_batch(tables, stats_of(source), stats_of(target), run, lambda rec: R.version_counts(rec, source, target)).first()
    assert (totals["passed"], totals["failed"], totals["row_count_matched"]) == (5, 0, 5)
    assert set(statuses(tables, "b1").values()) == {"VALIDATED"}
    assert tables.read("validation_history").filter("row_count_matched").count() == 5
    for name in ("analytics.pageviews_hourly", "edge_cases.complex_types_table", "sales.empty_staging_table"):
        s, t = source.read(f"prod.{name}"), target.read(f"dr.{name}")
        assert Q.row_differences(s.select(*t.columns), t).isEmpty()

    # The same batch again changes nothing unless forced; forced, it keeps the ids.
    again = R.onboard(tables, selection, rules, settings, stats, no_targets(spark), run).first()
    assert (again["inserted"], again["skipped"]) == (0, 5)
    forced = R.onboard(tables, selection, rules, settings, stats, no_targets(spark), R.Run("b1", run_id="r2", force=True)).first()
    assert forced["inserted"] == 5
    rows = tables.read("control").collect()
    assert {r["source_table"]: r["migration_id"] for r in rows} == ids
    assert all(r["status"] == "QUEUED" and r["validation_status"] is None and r["attempt_number"] == 0 for r in rows)

    # Another batch has rows of its own.
    R.onboard(tables, selection, rules, settings, stats, no_targets(spark), R.Run("007"))
    assert tables.read("control").count() == 10 and tables.read("control").select("migration_id").distinct().count() == 10
    assert {r[0] for r in tables.read("control").select("batch_id").distinct().collect()} == {"b1", "007"}
    R.delete_batch(tables, "007")
    assert {r["source_table"]: r["migration_id"] for r in tables.read("control").collect()} == ids
    assert tables.read("attempts").count() == 6


def test_targets_must_be_there_and_blocked_tables_are_booked(spark, source):
    tables = stored(spark)
    selection, _, stats = world(spark, source)
    settings = spark.createDataFrame([("CATALOG", "prod", "", None, "DISABLE"), ("SCHEMA", "prod", "edge_cases", None, "ENABLE")], S.SETTINGS)
    there = spark.createDataFrame([("dr", "sales", "customer_dim", "MANAGED", False, "parquet", None), ("dr", "finance", "revenue_monthly", "MANAGED", False, "parquet", None)], S.LISTING)
    c = R.onboard(tables, selection, I.no_rules(spark), settings, stats, there, R.Run("g", require_target=True)).first()
    assert (c["inserted"], c["skipped_target_missing"], c["po_blocked"]) == (2, 2, 2)
    codes = {r["source_table"]: (r["status"], r["error_code"]) for r in tables.read("control").collect()}
    assert codes["pageviews_hourly"] == ("SKIPPED", "TARGET_NOT_PRECREATED")
    assert codes["single_row_table"] == ("PO_BLOCKED", "PREDICTIVE_OPTIMIZATION_ENABLED")
    assert codes["customer_dim"] == ("QUEUED", None)
    # Unblocked, a plain run of the same batch queues them.
    open_settings = spark.createDataFrame([("CATALOG", "prod", "", None, "DISABLE")], S.SETTINGS)
    again = R.onboard(tables, selection, I.no_rules(spark), open_settings, stats, there, R.Run("g")).first()
    assert again["inserted"] == 4
    assert statuses(tables, "g")["single_row_table"] == "QUEUED"


def test_sources_that_are_gone_fail_for_good_and_unmeasured_ones_do_not(spark, source):
    selection, settings, stats = world(spark, source)
    none = stats.filter(F.lit(False))
    tables = stored(spark)
    c = R.onboard(tables, selection, I.no_rules(spark), settings, none, no_targets(spark), R.Run("x")).first()
    assert c["not_found"] == 6 and set(statuses(tables, "x").values()) == {"FAILED_PERMANENT"}
    R.onboard(tables, selection, I.no_rules(spark), settings, none, no_targets(spark), R.Run("y", skip_stats=True))
    rows = tables.read("control").filter("batch_id = 'y'").collect()
    assert all(r["status"] == "QUEUED" and r["size_gb"] is None and r["workload_class"] == "UNKNOWN" and r["workload_weight"] == 0 for r in rows)
    for bad in (" ", "", "a/b"):
        with pytest.raises(ValueError):
            R.Run(bad)


def test_retry_of_permanent_failures_is_opt_in(spark):
    rows = [("a", "b", "FAILED_PERMANENT", 3, 3, "PERMISSION_DENIED"), ("b", "b", "FAILED", 1, 3, "CLONE_FAILED"), ("c", "b", "RETRY_PENDING", 3, 3, None), ("d", "b", "FAILED", 1, 3, "schema_not_found"), ("e", "other", "FAILED", 0, 3, None)]
    df = spark.createDataFrame(rows, "migration_id string, batch_id string, status string, attempt_number int, max_attempts int, error_code string")
    df = df.withColumns({"error_message": F.lit(None).cast("string"), "queued_at": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp")})
    now = F.current_timestamp()
    plain = {r["migration_id"]: r["status"] for r in C.retry_pass(df, now, "b").collect()}
    assert plain == {"a": "FAILED_PERMANENT", "b": "QUEUED", "c": "FAILED_PERMANENT", "d": "FAILED_PERMANENT", "e": "FAILED"}
    opted = {r["migration_id"]: (r["status"], r["attempt_number"]) for r in C.retry_pass(df, now, "b", retry_permanent=True).collect()}
    assert opted["a"] == ("QUEUED", 0)


def test_versions_and_restore(spark):
    store = SnapshotStore(spark, new_folder(spark, "v")).create()
    assert not store.exists("a.b.c")
    assert [store.copy(spark.range(n), "a.b.c") for n in (3, 5)] == [0, 1]
    assert store.read("a.b.c").count() == 5 and store.read("a.b.c", 0).count() == 3
    assert store.restore("a.b.c", 0) == 2 and store.read("a.b.c").count() == 3
    assert store.copy(spark.range(9), "a.b.c") == 3 and store.read("a.b.c").count() == 9
    with pytest.raises(ValueError):
        store.read("a.b.c", 8)
    assert L.path_stats(spark, store.latest("a.b.c")[1]).first()["num_files"] >= 1


def test_copies_that_end_together_are_all_committed(spark):
    store = SnapshotStore(spark, new_folder(spark, "p")).create()
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: store.copy(spark.range(i), f"a.b.t{i}"), range(8)))
    assert {r["table_fqn"] for r in store.ledger().collect()} == {f"a.b.t{i}" for i in range(8)}


def test_batches_written_together_do_not_meet(spark):
    tables = stored(spark)
    rows = lambda i: spark.createDataFrame([(f"m{i}", f"b{i}", "QUEUED")], "migration_id string, batch_id string, status string")

    def write(i):
        tables.replace_batch(f"b{i}", rows(i))
        tables.append("validation_history", rows(i))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(6)))
    for name in ("control", "validation_history"):
        assert {(r["migration_id"], r["batch_id"]) for r in tables.read(name).collect()} == {(f"m{i}", f"b{i}") for i in range(6)}


def test_a_copy_that_was_never_committed_is_not_there(spark):
    store = SnapshotStore(spark, new_folder(spark, "u")).create()
    store.copy(spark.range(3), "a.b.c")
    spark.range(100).write.parquet(store.folder("a.b.c"))
    assert store.read("a.b.c").count() == 3
    assert store.copy(spark.range(4), "a.b.c") == 1 and store.read("a.b.c").count() == 4


def test_many_folders_are_counted_at_once(spark):
    store = SnapshotStore(spark, new_folder(spark, "n")).create()
    frames = {"a.b.c d+e": spark.range(7), "a.b.p": spark.range(6).withColumn("k", F.col("id") % 2), "a.b.none": spark.range(0).withColumn("x", F.lit("y"))}
    for name, df in frames.items():
        store.copy(df, name, partition_by=["k"] if "k" in df.columns else [])
    paths = {store.latest(n)[1]: df.count() for n, df in frames.items()}
    assert {r["path"]: r["row_count"] for r in L.folder_row_counts(spark, list(paths)).collect()} == paths


def test_verdict_keeps_an_error_in_counting_apart(spark):
    records = spark.createDataFrame([("m", "c", "s", "t", "d", "s", "t", 1, 2)], "migration_id string, source_catalog string, source_schema string, source_table string, target_catalog string, target_schema string, target_table string, source_version bigint, target_version bigint")
    records = records.withColumns({"source_row_count": F.lit(None).cast("bigint"), "target_row_count": F.lit(None).cast("bigint")})
    stats = lambda name: spark.createDataFrame([(name, "p", 10, 1, "parquet")], "table_fqn string, location string, size_in_bytes bigint, num_files bigint, format string").withColumn("last_modified", F.current_timestamp())
    counts = spark.createDataFrame([("m", None, None, "boom")], "migration_id string, source_row_count bigint, target_row_count bigint, count_error string")
    r = K.validate(records, stats("c.s.t"), stats("d.s.t"), counts).first()
    assert r["status"] == "VALIDATION_FAILED" and r["row_count_matched"] is None and "row_count ERROR: boom" in r["message"]
    r = K.validate(records, stats("c.s.t"), stats("d.s.t")).first()
    assert r["status"] == "VALIDATED" and not r["row_count_checked"]
    r = K.validate(records, stats("c.s.t"), stats("x.s.t"), counts).first()
    assert r["message"].startswith("TARGET_MISSING") and not r["row_count_checked"]


def test_copies_of_one_target_do_not_mix(spark):
    store = SnapshotStore(spark, new_folder(spark, "x")).create()
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda n: store.copy(spark.range(n), "a.b.c"), (10, 20, 30, 40)))
    assert sorted(versions) == [0, 1, 2, 3]
    assert [store.read("a.b.c", v).count() for v in versions] == [10, 20, 30, 40]


def test_partition_values_keep_type_and_emptiness(spark):
    store = SnapshotStore(spark, new_folder(spark, "y")).create()
    rows = [(1, "00", 7), (2, "01", None), (3, "", 7), (4, None, 8), (5, "v", 8)]
    store.copy(spark.createDataFrame(rows, "id bigint, k string, n int"), "a.b.c", partition_by=["k", "n"])
    back = store.read("a.b.c")
    assert back.dtypes == [("id", "bigint"), ("k", "string"), ("n", "int")]
    assert sorted(map(tuple, back.collect())) == rows
    assert [tuple(r) for r in store.partition_columns().collect()] == [("a.b.c", ["k", "n"])]


def test_folders_that_no_file_lies_in_have_no_count(spark):
    root = new_folder(spark, "z")
    spark.range(5).write.parquet(f"{root}/some/where")
    spark.range(0).write.parquet(f"{root}/none")
    paths = [f"{root}/some/where", f"{root}/none", f"file:{root.removeprefix('file:')}/some/where"]
    assert {r["path"]: r["row_count"] for r in L.folder_row_counts(spark, paths).collect()} == dict(zip(paths, (5, 0, 5), strict=True))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: None)})
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_folder(Session, "x")
