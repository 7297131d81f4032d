"""Copies, versions and the stored tables: each query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from tableferry import schemas as S
from tableferry.operators import checks as K
from tableferry.operators import reconcile as Q
from tableferry.operators import telemetry as T
from tableferry.plans import run as R
from tableferry.session import new_folder
from tableferry.sources import snapshots as V
from tableferry.sources import stored_tables as ST
from tableferry.streaming import rollups as U


def _store(t):
    return V.SnapshotStore(t.spark, new_folder(t.spark, "store")).create()


def _stored(t):
    stored = ST.StoredTables(t.spark, new_folder(t.spark, "stored"))
    stored.create()
    return stored


def _now():
    return F.expr("TIMESTAMP '2000-01-01 00:00:00'")


@query("A12", "SELECT * FROM orders")
def copied_table(t):
    store = _store(t)
    store.copy(t.orders, "tgt.main.orders", "src.main.orders")
    return store.read("tgt.main.orders")


@query("A12, J11, A14", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS src_rows, COUNT(*) AS tgt_rows, true AS matched FROM lineitem GROUP BY 1, 2""")
def copy_keeps_partitions(t):
    store = _store(t)
    keys = ["l_returnflag", "l_linestatus"]
    store.copy(t.lineitem, "tgt.main.lineitem", "src.main.lineitem", 4, partition_by=keys)
    copied = store.read("tgt.main.lineitem").select(*t.lineitem.columns)
    return Q.compare_checksums(t.lineitem, copied, by=keys).select(*keys, "src_rows", "tgt_rows", "matched")


_CODED = """SELECT o_orderkey, o_custkey, CASE o_orderkey % 5 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '' WHEN 3 THEN 'x' END AS code FROM {orders}"""


@query("A10, A12", _CODED.format(orders="orders"))
def text_partitions_kept(t):
    """Leading zeros, empty texts and NULLs as partition values."""
    store = _store(t)
    store.copy(t.spark.sql(_CODED, orders=t.orders), "tgt.main.coded", partition_by=["code"])
    return store.read("tgt.main.coded")


@query("A12", "SELECT * FROM orders")
def copy_over_a_left_folder(t):
    """A first try that died after writing other partitions."""
    store = _store(t)
    t.orders.withColumn("o_orderstatus", F.lit("dead")).write.partitionBy("o_orderstatus").parquet(store.folder("tgt.main.orders"))
    store.copy(t.orders, "tgt.main.orders", partition_by=["o_orderstatus"])
    return store.read("tgt.main.orders").select(*t.orders.columns)


@query("A12, A14", """
SELECT 0 AS version, COUNT(*) AS row_count FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 1, COUNT(*) FROM orders WHERE o_orderkey % 3 > 0""")
def two_sources_one_target(t):
    store = _store(t)
    store.copy(t.orders.filter("o_orderkey % 3 = 0"), "tgt.main.both", "src.a")
    store.copy(t.orders.filter("o_orderkey % 3 > 0"), "tgt.main.both", "src.b")
    return Q.row_counts({str(v): store.read("tgt.main.both", v) for v in (0, 1)}).select(F.col("table_name").cast("int").alias("version"), "row_count")


@query("J11", """
SELECT 'partition_columns_match' AS check_name, 'm.flags' AS table_name, true AS passed, 'src=[l_linestatus, l_returnflag] tgt=[l_linestatus, l_returnflag]' AS detail
UNION ALL SELECT 'partition_columns_match', 'm.lost', false, concat('src=[l_linestatus] tgt=[', substr('x', 1, CAST(least(0, (SELECT COUNT(*) FROM lineitem)) AS BIGINT)), ']')""")
def stored_partitions_match(t):
    """Partition columns of two stores' own copies."""
    source, target = _store(t), _store(t)
    source.copy(t.lineitem, "m.flags", partition_by=["l_returnflag", "l_linestatus"])
    target.copy(t.lineitem, "m.flags", partition_by=["l_linestatus", "l_returnflag"])
    source.copy(t.lineitem, "m.lost", partition_by=["l_linestatus"])
    target.copy(t.lineitem, "m.lost")
    named = [s.partition_columns().withColumnRenamed("table_fqn", "table_name") for s in (source, target)]
    return K.partitions_match(*named)


@query("A10, J3, D19", """
SELECT 0 AS version, (SELECT COUNT(*) FROM orders WHERE o_orderkey % 2 = 0) AS row_count UNION ALL SELECT 1, (SELECT COUNT(*) FROM orders)
UNION ALL SELECT -1, (SELECT COUNT(*) FROM orders)""")
def rows_at_versions(t):
    store = _store(t)
    store.copy(t.orders.filter("o_orderkey % 2 = 0"), "tgt.main.orders")
    store.copy(t.orders, "tgt.main.orders")
    at = {"0": store.read("tgt.main.orders", 0), "1": store.read("tgt.main.orders", 1), "-1": store.read("tgt.main.orders")}
    return Q.row_counts(at).select(F.col("table_name").cast("int").alias("version"), "row_count")


@query("A22", "SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def restored_table(t):
    store = _store(t)
    store.copy(t.orders.filter("o_orderkey % 2 = 0"), "tgt.main.orders")
    store.copy(t.orders, "tgt.main.orders")
    store.restore("tgt.main.orders", 0)
    return store.read("tgt.main.orders")


# A later state of two tables: some rows changed, some gone, some new. Both sides run the same text.
_LATER_LINES = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_orderkey % 9 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM {lineitem} WHERE NOT (l_returnflag = 'A' AND l_orderkey % 10 = 3)"""
_LINES = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM {lineitem}"
_LATER_ORDERS = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderdate
 FROM {orders} WHERE o_orderkey % 13 <> 0 UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM {orders} WHERE o_orderkey % 17 = 0"""
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM {orders}"


def _versions(t, store, name, first, later, frames, **how):
    """Two versions of a table, copied one after the other."""
    return [store.copy_changed(t.spark.sql(text, **frames), name, **how) for text in (first, later)]


@query("A12", _LATER_LINES.format(lineitem="lineitem"))
def recopied_changes(t):
    """The second copy writes the partitions whose rows changed and names the others again."""
    store = _store(t)
    _versions(t, store, "tgt.main.lineitem", _LINES, _LATER_LINES, {"lineitem": t.lineitem}, partition_by=["l_returnflag", "l_linestatus"])
    return store.read("tgt.main.lineitem")


@query("A12, A14", """
WITH b AS (SELECT l_returnflag, l_linestatus, COUNT(*) AS n, bool_or(l_returnflag = 'A' AND l_orderkey % 10 = 3 OR l_returnflag = 'R' AND l_orderkey % 9 = 0) AS hit FROM lineitem GROUP BY 1, 2)
SELECT CAST(0 AS BIGINT) AS version, COUNT(*) AS parts, CAST(SUM(n) AS BIGINT) AS row_count, COUNT(*) AS written FROM b
UNION ALL SELECT 1, COUNT(*), (SELECT COUNT(*) FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_orderkey % 10 = 3)), COUNT(*) FILTER (WHERE hit) FROM b""")
def parts_written(t):
    """How many parts each version holds, and how many of them its own copy wrote."""
    store = _store(t)
    _versions(t, store, "tgt.main.lineitem", _LINES, _LATER_LINES, {"lineitem": t.lineitem}, partition_by=["l_returnflag", "l_linestatus"])
    parts = store.ledger().select("version", "path", F.explode("parts").alias("p"))
    own = F.col("p.folder").startswith(F.col("path"))
    return parts.groupBy("version").agg(F.count("*").alias("parts"), F.sum("p.row_count").alias("row_count"), F.count(F.when(own, 1)).alias("written"))


@query("A12", _LATER_ORDERS.format(orders="orders"))
def recopied_by_key(t):
    store = _store(t)
    _versions(t, store, "tgt.main.orders", _ORDERS, _LATER_ORDERS, {"orders": t.orders}, keys=["o_orderkey"], parts=64)
    return store.read("tgt.main.orders")


@query("2.K", f"""
WITH a AS ({_ORDERS.format(orders="orders")}), b AS ({_LATER_ORDERS.format(orders="orders")}),
j AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb, a.o_custkey AS ca, b.o_custkey AS cb, a.o_orderstatus AS sa, b.o_orderstatus AS sb, a.o_orderdate AS da, b.o_orderdate AS db
 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT 'insert' AS _change, kb AS o_orderkey, cb AS o_custkey, sb AS o_orderstatus, db AS o_orderdate FROM j WHERE ka IS NULL
UNION ALL SELECT 'delete', ka, ca, sa, da FROM j WHERE kb IS NULL
UNION ALL SELECT 'update_preimage', ka, ca, sa, da FROM j WHERE ka = kb AND sa IS DISTINCT FROM sb
UNION ALL SELECT 'update_postimage', kb, cb, sb, db FROM j WHERE ka = kb AND sa IS DISTINCT FROM sb""")
def change_feed(t):
    """Changes between two versions that were copied by parts: shared folders are not read."""
    store = _store(t)
    first, later = _versions(t, store, "tgt.main.orders", _ORDERS, _LATER_ORDERS, {"orders": t.orders}, keys=["o_orderkey"])
    return store.changes("tgt.main.orders", first, later, ["o_orderkey"])


@query("2.K", f"""
WITH a AS ({_ORDERS.format(orders="orders")}), b AS ({_LATER_ORDERS.format(orders="orders")})
SELECT CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.o_orderkey = b.o_orderkey) THEN 'update_postimage' ELSE 'insert' END AS _change, COUNT(*) AS n
 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) b GROUP BY 1
UNION ALL SELECT CASE WHEN EXISTS (SELECT 1 FROM b WHERE a.o_orderkey = b.o_orderkey) THEN 'update_preimage' ELSE 'delete' END, COUNT(*)
 FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) a GROUP BY 1""")
def change_feed_of_full_copies(t):
    """Updates move rows from one partition to another."""
    store = _store(t)
    for text in (_ORDERS, _LATER_ORDERS):
        store.copy(t.spark.sql(text, orders=t.orders), "tgt.main.orders", partition_by=["o_orderstatus"])
    return store.changes("tgt.main.orders", 0, 1, ["o_orderkey"]).groupBy("_change").agg(F.count("*").alias("n"))


@query("A9, A14", """
SELECT concat('m.p', o_orderpriority[1]) AS table_fqn, CAST(0 AS BIGINT) AS version, COUNT(*) AS row_count, true AS measured FROM orders GROUP BY 1
UNION ALL SELECT 'm.p1', 1, COUNT(*), true FROM orders WHERE o_orderpriority[1] = '1'""")
def chunk_committed(t):
    """The copies of a chunk, one of them of a table that is in it twice, made versions by one ledger commit."""
    store = _store(t)
    of = lambda p: t.orders.filter(F.substring("o_orderpriority", 1, 1) == p)
    done = store.commit([store.stage(of(p), f"m.p{p}", partition_by=["o_orderstatus"]) for p in "123451"])
    rows = Q.row_counts({f"{r['table_fqn']}/{r['version']}": store.read(r["table_fqn"], r["version"]) for r in done})
    name = F.split("table_name", "/")
    counted = rows.select(name[0].alias("table_fqn"), name[1].cast("bigint").alias("version"), "row_count")
    known = store.ledger().select("table_fqn", "version", ((F.col("num_files") > 0) & (F.col("size_in_bytes") > 0)).alias("measured"))
    return counted.join(known, ["table_fqn", "version"]).select("table_fqn", "version", "row_count", "measured")


@query("A22", f"""
SELECT 'tgt.main.lineitem' AS table_fqn, COUNT(*) AS versions, (SELECT COUNT(*) FROM ({_LATER_LINES.format(lineitem="lineitem")})) AS row_count FROM (SELECT 1)
UNION ALL SELECT 'tgt.main.orders', 1, COUNT(*) FROM orders WHERE o_orderkey % 3 = 0""")
def kept_after_retention(t):
    """Old versions expired and their folders removed, but for those that the last version still names."""
    store = _store(t)
    _versions(t, store, "tgt.main.lineitem", _LINES, _LATER_LINES, {"lineitem": t.lineitem}, partition_by=["l_returnflag", "l_linestatus"])
    for k in (1, 2, 3):
        store.copy(t.orders.filter(f"o_orderkey % {k} = 0"), "tgt.main.orders", partition_by=["o_orderstatus"])
    store.expire(keep_versions=1)
    store.vacuum(older_than_hours=0)
    left = store.ledger().groupBy("table_fqn").agg(F.count("*").alias("versions"))
    rows = Q.row_counts({n: store.read(n) for n in ("tgt.main.lineitem", "tgt.main.orders")})
    return left.join(rows, F.col("table_fqn") == F.col("table_name")).select("table_fqn", "versions", "row_count")


@query("A9", """
SELECT table_fqn, version, operation, path, source_version, num_files, size_in_bytes FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY table_fqn ORDER BY version DESC) AS rn FROM ledger) WHERE rn = 1""")
def latest_versions(t):
    return V.latest_versions(t.ledger)


@query("A14", """
SELECT table_fqn, num_files AS target_num_files, size_in_bytes AS target_size_bytes, version AS target_version, source_version FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_fqn ORDER BY version DESC) AS rn FROM ledger) WHERE rn = 1""")
def copy_metrics(t):
    return V.copy_metrics(t.ledger)


_NAME = "concat(source_catalog, '.', source_schema, '.', source_table)"


@query("A13", f"""
SELECT migration_id, CASE WHEN clone_type = 'delta_share' THEN 'name' WHEN source_path LIKE 'abfss://%' THEN 'path_and_location' ELSE 'name_fallback' END AS route,
 CASE WHEN clone_type <> 'delta_share' AND source_path LIKE 'abfss://%' THEN source_path ELSE {_NAME} END AS source_ref,
 CASE WHEN clone_type <> 'delta_share' AND source_path LIKE 'abfss://%' THEN concat('abfss://tgt@store/migration_data/', target_schema, '/', target_table) END AS target_location
FROM control""")
def copy_routes(t):
    return V.copy_route(t.control, "abfss://tgt@store/")


@query("A13", f"""
SELECT migration_id, CASE WHEN clone_type = 'delta_share' THEN 'name' WHEN source_path LIKE 'abfss://%' THEN 'path' ELSE 'name_fallback' END AS route,
 CASE WHEN clone_type <> 'delta_share' AND source_path LIKE 'abfss://%' THEN source_path ELSE {_NAME} END AS source_ref,
 CAST(NULL AS VARCHAR) AS target_location FROM control""")
def copy_routes_without_location(t):
    return V.copy_route(t.control)


@query("A15", """
SELECT migration_id, batch_id, status, size_in_bytes, chunk_id, source_row_count, CAST(NULL AS TIMESTAMP) AS onboarded_at FROM control""")
def stored_control(t):
    stored = _stored(t)
    stored.create()
    stored.replace_all("control", t.control)
    shown = stored.read("control").select("migration_id", "batch_id", "status", "size_in_bytes", "chunk_id", "source_row_count", "onboarded_at")
    return shown.withColumn("onboarded_at", F.col("onboarded_at").cast("timestamp_ntz"))


@query("A15, B10", """
SELECT migration_id, batch_id, CASE WHEN batch_id = 'batch-3' THEN 'QUEUED' ELSE status END AS status FROM control""")
def replaced_batch(t):
    stored = _stored(t)
    stored.replace_all("control", t.control)
    mine = T.of_batch(stored.read("control"), "batch-3").withColumn("status", F.lit("QUEUED"))
    stored.replace_batch("batch-3", mine)
    return stored.read("control").select("migration_id", "batch_id", "status")


@query("A15, I1, I5", """
SELECT migration_id, batch_id, CASE WHEN batch_id = 'batch-3' AND CAST(migration_id AS BIGINT) % 3 = 0 THEN 'VALIDATED' WHEN batch_id IN ('batch-2', 'batch-3') AND CAST(migration_id AS BIGINT) % 2 = 0
  THEN 'COMPLETED' ELSE status END AS status, size_in_bytes FROM control
UNION ALL SELECT concat('new-', migration_id), 'batch-2', 'QUEUED', NULL FROM control WHERE batch_id = 'batch-2' AND status = 'FAILED'""")
def published_control(t):
    """Several appends to two batches, a compaction, and a commit whose writer died before it was published."""
    stored = _stored(t)
    stored.replace_all("control", t.control)

    def rows(batch, every, status):
        mine = stored.batch(batch).filter(F.col("migration_id").try_cast("bigint") % every == 0)
        return mine.withColumn("status", F.lit(status))

    new = stored.batch("batch-2").filter("status = 'FAILED'").select(F.concat(F.lit("new-"), "migration_id").alias("migration_id"), F.lit("QUEUED").alias("status"))
    stored.update_batch("batch-2", new)
    for batch in ("batch-2", "batch-3"):
        stored.update_batch(batch, rows(batch, 2, "COMPLETED"))
    stored.compact_batch("batch-3")
    stored.update_batch("batch-3", rows("batch-3", 3, "VALIDATED"))
    stored.begin_update("batch-3", rows("batch-3", 1, "LOST"))
    return stored.read("control").select("migration_id", "batch_id", "status", "size_in_bytes")


@query("I19", """
SELECT 'control' AS kind, migration_id, CASE WHEN batch_id = 'batch-2' THEN 'QUEUED' ELSE status END AS status FROM control WHERE batch_id <> 'batch-1'
UNION ALL SELECT 'attempt', migration_id, status FROM control WHERE batch_id IN ('batch-2', 'batch-3')""")
def stored_batch_deleted(t):
    """One batch dropped, with its attempts, while another is being written."""
    stored = _stored(t)
    stored.replace_all("control", t.control)
    for batch in ("batch-1", "batch-2", "batch-3"):
        stored.append("attempts", ST.conform(t.control.filter(F.col("batch_id") == batch), S.ATTEMPTS), batch)
    open_commit = stored.begin_update("batch-2", stored.batch("batch-2").withColumn("status", F.lit("QUEUED")))
    stored.delete_batch("batch-1")
    stored.vacuum(older_than_hours=0)
    stored.finish_update("batch-2", open_commit)
    left = stored.read("control").select(F.lit("control").alias("kind"), "migration_id", "status")
    return left.unionAll(stored.read("attempts").select(F.lit("attempt"), "migration_id", "status"))


@query("A16", """
SELECT migration_id, attempt_number, cluster_id, status, substr(error_code, 1, 50) AS error_code, duration_seconds, source_size_bytes,
 CAST(0 AS BIGINT) AS target_size_bytes FROM attempts""")
def appended_attempts(t):
    stored = _stored(t)
    half = F.col("attempt_number") <= 3
    stored.append("attempts", ST.attempt_rows(_with_text(t.attempts).filter(half)))
    stored.append("attempts", ST.attempt_rows(_with_text(t.attempts).filter(~half)))
    return stored.read("attempts").select(
        "migration_id", "attempt_number", "cluster_id", "status", "error_code", "duration_seconds", "source_size_bytes", "target_size_bytes")


def _with_text(df):
    return df.withColumns({"error_message": F.lit(None).cast("string"), "target_size_bytes": F.lit(None).cast("bigint")})


@query("A17", """
SELECT 'run-7' AS run_id, migration_id, row_count_checked, source_row_count, target_row_count, row_count_matched, status,
 substr(concat('checked ', validation_id), 1, 1000) AS message FROM validation_history""")
def appended_validations(t):
    stored = _stored(t)
    outcomes = t.validation_history.withColumn("message", F.concat(F.lit("checked "), "validation_id"))
    stored.append("validation_history", ST.validation_rows(outcomes, "run-7", _now()))
    return stored.read("validation_history").select(
        "run_id", "migration_id", "row_count_checked", "source_row_count", "target_row_count", "row_count_matched", "status", "message")


@query("2.K, D3", """
SELECT CAST(created_at AS DATE) AS day, status, COUNT(*) AS attempts, CAST(SUM(duration_seconds) AS BIGINT) AS seconds, CAST(SUM(source_size_bytes) AS BIGINT) AS bytes FROM attempts GROUP BY 1, 2""")
def running_attempts(t):
    """Three appends, the totals brought up to date after each by a stream that reads only what is new."""
    stored = _stored(t)
    totals = U.attempts_by_day(t.spark, new_folder(t.spark, "totals"), stored.path("attempts"), S.ATTEMPTS)
    for k in range(3):
        stored.append("attempts", ST.attempt_rows(_with_text(t.attempts).filter(F.col("attempt_number") % 3 == k)), f"batch-{k}")
        totals.advance()
    totals.advance()
    return totals.read()


@query("2.K, D26, E1", """
SELECT CAST(DATE '2000-01-01' + CAST(CAST(validation_id AS BIGINT) % 3 AS INT) AS DATE) AS day, status, COUNT(*) AS validations, COUNT(*) FILTER (WHERE row_count_checked) AS counted,
 COUNT(*) FILTER (WHERE row_count_matched) AS matched FROM validation_history GROUP BY 1, 2""")
def running_validations(t):
    stored = _stored(t)
    totals = U.validations_by_status(t.spark, new_folder(t.spark, "totals"), stored.path("validation_history"), S.VALIDATION_HISTORY)
    number = F.col("validation_id").cast("bigint")
    outcomes = t.validation_history.withColumn("message", F.lit("")).withColumn("batch_id", F.concat(F.lit("b"), number % 2))
    for k in range(3):
        at = F.expr(f"TIMESTAMP '2000-01-01 00:00:00' + INTERVAL {k} DAY")
        stored.append("validation_history", ST.validation_rows(outcomes.filter(number % 3 == k), f"run-{k}", at))
        totals.advance()
    return totals.read()


@query("J3", """
SELECT concat('m', o_orderpriority[1]) AS migration_id, COUNT(*) AS source_row_count, COUNT(*) - COUNT(*) FILTER (WHERE o_orderpriority[1] = '2' AND o_orderkey % 2 = 0) AS target_row_count,
 CAST(NULL AS VARCHAR) AS count_error FROM orders WHERE o_orderpriority[1] < '4' GROUP BY 1
UNION ALL SELECT 'm9', NULL, COUNT(*), 'LookupError: no raw.main.p9' FROM orders WHERE o_orderpriority[1] = '1'""")
def live_counted_sources(t):
    """Sources that no ledger holds are counted as they are now; one of them cannot be opened."""
    target, none = _store(t), _store(t)
    of = lambda p: t.orders.filter(F.substring("o_orderpriority", 1, 1) == p)
    sources = {f"raw.main.p{p}": of(p) for p in "123"}

    def opened(name):
        if name not in sources:
            raise LookupError(f"no {name}")
        return sources[name]

    staged = [target.stage(df.filter("NOT (o_orderpriority LIKE '2%' AND o_orderkey % 2 = 0)"), f"tgt.{n[4:]}") for n, df in sources.items()]
    target.commit([*staged, target.stage(of("1"), "tgt.main.p9")])
    names = ", ".join(f"{c} string" for c in ("migration_id", *S.SOURCE_NAME, *S.TARGET_NAME))
    records = t.spark.createDataFrame([(f"m{p}", "raw", "main", f"p{p}", "tgt", "main", f"p{p}") for p in "1239"], names)
    records = records.withColumns({"source_version": F.lit(None).cast("bigint"), "target_version": F.lit(0).cast("bigint")})
    return R.version_counts(records, none, target, opened)


@query("A19", "SELECT 'exec-9' AS execution_id, check_name, table_name, passed, detail FROM report")
def appended_report(t):
    stored = _stored(t)
    stored.append("check_report", ST.report_rows(t.report.drop("execution_id"), "exec-9", _now()))
    return stored.read("check_report").select("execution_id", "check_name", "table_name", "passed", "detail")


assert set(S.STORED_TABLES) == {"control", "attempts", "validation_history", "exclusion_log", "check_report"}
