"""Changes to control rows and request rows, onboarding decisions, packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ACTIVE, OPEN, RETRYABLE, query
from tableferry import schemas as S
from tableferry.operators import changes as C
from tableferry.operators import checks as K
from tableferry.operators import gate as G
from tableferry.operators import packing as P
from tableferry.operators import selection as X
from tableferry.operators import telemetry as T
from tableferry.plans import run as R
from tableferry.session import settle

TS = "TIMESTAMP '2000-01-01 00:00:00'"
KEY = "CAST(migration_id AS BIGINT)"


def now():
    return F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'")


def _updated(hit: str, assign: dict[str, str], source: str = "control", keep: str = "*") -> str:
    """SQL of a guarded update: the assigned columns change where ``hit`` holds."""
    cases = ", ".join(f"CASE WHEN {hit} THEN {v} ELSE {c} END AS {c}" for c, v in assign.items())
    return f"SELECT {keep} REPLACE ({cases}) FROM {source}"


# --- onboarding -----------------------------------------------------------------

_SHOWN = ["migration_id", "run_id", "batch_id", *S.SOURCE_NAME, "target_table", "status", "size_in_bytes", "workload_class",
          "source_version", "attempt_number", "max_attempts", "started_at", "completed_at", "failed_at", "queued_at", "error_code",
          "error_message", "validation_status", "source_row_count", "target_row_count", "updated_at", "chunk_id"]
_FRESH = {c: "NULL" for c in ["started_at", "completed_at", "failed_at", "validation_status", "source_row_count", "target_row_count"]}


def _upserted(status: str, assign: dict[str, str], insert: dict[str, str]) -> str:
    """SQL of an upsert of ``incoming`` to ``control``."""
    base = {"status": f"'{status}'", "updated_at": TS}
    assign, insert = {**base, **assign}, {**base, **insert}
    cols = []
    for c in _SHOWN:
        if c in S.IDENTITY:
            cols.append(f"COALESCE(t.{c}, s.{c}) AS {c}")
            continue
        has = c in ("migration_id", "run_id", "target_table", "size_in_bytes", "workload_class", "source_version", "max_attempts",
                    "error_code", "error_message")
        added = insert.get(c, f"s.{c}" if has else "NULL")
        both = assign.get(c, f"t.{c}")
        cols.append(f"CASE WHEN t.migration_id IS NULL THEN {added} WHEN s.migration_id IS NULL THEN t.{c} ELSE {both} END AS {c}")
    return f"SELECT {', '.join(cols)} FROM control t FULL JOIN incoming s USING ({', '.join(S.IDENTITY)})"


@query("I1, C1", _upserted("QUEUED", {
    **_FRESH, **{c: f"s.{c}" for c in ["run_id", "target_table", "size_in_bytes", "workload_class", "source_version", "max_attempts"]},
    "error_code": "NULL", "error_message": "NULL", "attempt_number": "0", "queued_at": TS,
}, {"attempt_number": "0", "queued_at": TS, "error_code": "NULL", "error_message": "NULL"}))
def upsert_queued(t):
    incoming = t.incoming.drop("error_code", "error_message")
    return C.upsert_queued(t.control, incoming, now()).select(*_SHOWN)


@query("I2", _upserted("SKIPPED", {
    **_FRESH, "target_table": "s.target_table", "error_code": "'TARGET_NOT_PRECREATED'", "error_message": "s.error_message",
}, {"error_code": "'TARGET_NOT_PRECREATED'"}))
def upsert_target_missing(t):
    return C.upsert_target_missing(t.control, t.incoming, now()).select(*_SHOWN)


@query("I3", _upserted("PO_BLOCKED", {
    **_FRESH, "run_id": "s.run_id", "target_table": "s.target_table", "error_code": "s.error_code", "error_message": "s.error_message",
}, {}))
def upsert_blocked(t):
    return C.upsert_blocked(t.control, t.incoming, now()).select(*_SHOWN)


@query("I4", _upserted("FAILED_PERMANENT", {"error_message": "s.error_message"}, {}))
def upsert_permanent_failure(t):
    return C.upsert_permanent_failure(t.control, t.incoming, now()).select(*_SHOWN)


_OUTCOME = """f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_catalog, source_schema, source_table ORDER BY ordinal) AS rn
  FROM selection) WHERE rn = 1),
w AS (SELECT f.*, COALESCE(a.value, b.value, d.value) AS value, c.status AS existing, c.migration_id AS existing_id,
  l.table_name IS NOT NULL AS there, s.format FROM f
 LEFT JOIN (SELECT * FROM settings WHERE level = 'TABLE' AND value <> 'INHERIT') a ON a.catalog = source_catalog AND a.schema_name = source_schema AND a.table_name = source_table
 LEFT JOIN (SELECT * FROM settings WHERE level = 'SCHEMA' AND value <> 'INHERIT') b ON b.catalog = source_catalog AND b.schema_name = source_schema
 LEFT JOIN (SELECT * FROM settings WHERE level = 'CATALOG' AND value <> 'INHERIT') d ON d.catalog = source_catalog
 LEFT JOIN (SELECT source_catalog, source_schema, source_table, status, migration_id FROM control WHERE batch_id = 'batch-3') c USING (source_catalog, source_schema, source_table)
 LEFT JOIN target_listing l ON l.catalog = target_catalog AND l.schema_name = target_schema AND l.table_name = target_table
 LEFT JOIN source_stats s ON s.table_fqn = concat(source_catalog, '.', source_schema, '.', source_table)),
o AS (SELECT *, CASE WHEN COALESCE(value, '') <> 'DISABLE' THEN 'PO_BLOCKED'
 WHEN existing IN ('COMPLETED', 'VALIDATED', 'FAILED_PERMANENT', 'SKIPPED') THEN 'SKIPPED_EXISTING' WHEN NOT there THEN 'SKIPPED'
 WHEN COALESCE(format, '') <> 'parquet' THEN 'FAILED_PERMANENT' ELSE 'QUEUED' END AS outcome FROM w)"""
RUN = R.Run("batch-3", run_id="run-9", require_target=True)


def _judged(t):
    return R.judged_selection(X.first_wins(t.selection), t.control, t.settings, t.source_stats, t.target_listing, RUN)


@query("I5, C11, C12, A11", f"""
WITH {_OUTCOME} SELECT ordinal, outcome, CASE outcome WHEN 'SKIPPED' THEN
 concat('Target table ', target_catalog, '.', target_schema, '.', target_table, ' does not exist yet in the target catalog.')
 WHEN 'FAILED_PERMANENT' THEN 'Source table not found or not a Delta table' END AS message FROM o""")
def onboarding_outcomes(t):
    text = F.when(F.col("outcome") != "PO_BLOCKED", F.col("error_message"))
    return _judged(t).select("ordinal", "outcome", text.alias("message"))


@query("D25", f"""
WITH {_OUTCOME} SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE outcome = 'QUEUED') AS inserted,
 COUNT(*) FILTER (WHERE outcome IN ('SKIPPED', 'SKIPPED_EXISTING', 'FAILED_PERMANENT')) AS skipped,
 COUNT(*) FILTER (WHERE outcome = 'SKIPPED') AS skipped_target_missing, COUNT(*) FILTER (WHERE outcome = 'FAILED_PERMANENT') AS not_found,
 COUNT(*) FILTER (WHERE outcome = 'PO_BLOCKED') AS po_blocked FROM o""")
def selection_stats(t):
    return G.selection_stats(_judged(t))


@query("A20", f"""
WITH {_OUTCOME} SELECT source_catalog, source_schema, source_table, target_catalog, target_schema, target_table, outcome,
 COALESCE(value, '') <> 'DISABLE' AS blocked, CASE value WHEN 'DISABLE' THEN '' WHEN 'ENABLE' THEN 'PREDICTIVE_OPTIMIZATION_ENABLED'
 ELSE 'PREDICTIVE_OPTIMIZATION_UNKNOWN' END AS gate_code FROM o""")
def dry_run(t):
    plan = R.dry_run(X.first_wins(t.selection), t.control, t.settings, t.source_stats, t.target_listing, RUN)
    return plan.drop("source_path", "size_in_bytes", "workload_class")


@query("A20", f"WITH {_OUTCOME} SELECT 'exec-1' AS execution_id, outcome, COUNT(*) AS tables FROM o GROUP BY outcome")
def dry_run_blueprint(t):
    plan = R.dry_run(X.first_wins(t.selection), t.control, t.settings, t.source_stats, t.target_listing, RUN)
    stored = R.blueprint(plan, "exec-1", now())
    back = F.from_json("blueprint_json", plan.schema)
    return stored.select("execution_id", back["outcome"].alias("outcome")).groupBy("execution_id", "outcome").agg(F.count("*").alias("tables"))


_PLANNED = f"""{_OUTCOME}, p AS (SELECT o.source_catalog, o.source_schema, o.source_table, target_catalog, target_schema, target_table, outcome,
 COALESCE(value, '') <> 'DISABLE' AS blocked, CASE value WHEN 'DISABLE' THEN '' WHEN 'ENABLE' THEN 'PREDICTIVE_OPTIMIZATION_ENABLED' ELSE 'PREDICTIVE_OPTIMIZATION_UNKNOWN' END AS gate_code,
 z.location AS source_path, z.size_in_bytes, CASE WHEN z.size_in_bytes IS NULL THEN 'UNKNOWN' WHEN z.size_in_bytes < 10737418240 THEN 'SMALL' WHEN z.size_in_bytes < 107374182400 THEN 'MEDIUM'
  WHEN z.size_in_bytes < 1073741824000 THEN 'LARGE' ELSE 'XLARGE' END AS workload_class
 FROM o LEFT JOIN source_stats z ON z.table_fqn = concat(o.source_catalog, '.', o.source_schema, '.', o.source_table))"""


def _plan(t, stats=None):
    return R.dry_run(X.first_wins(t.selection), t.control, t.settings, t.source_stats if stats is None else stats, t.target_listing, RUN)


@query("A20", f"WITH {_PLANNED} SELECT * FROM p")
def stored_blueprint(t):
    """All columns of a plan that was stored as JSON and read back with its types, among older rows and those of another execution."""
    # Read by three blueprints: made once.
    plan = settle(_plan(t), "plan")
    stored = R.blueprint(plan, "exec-1", now()).unionAll(R.blueprint(plan.withColumn("outcome", F.lit("OTHER")), "exec-2", now()))
    older = R.blueprint(plan.withColumn("size_in_bytes", F.lit(-1).cast("bigint")), "exec-1", now() - F.expr("INTERVAL 1 DAY"))
    return R.stored_plan(settle(stored.unionAll(older)), "exec-1")


@query("A20", f"""
WITH {_PLANNED}, n AS (SELECT *, CASE WHEN size_in_bytes % 5 = 0 THEN size_in_bytes + 1 ELSE size_in_bytes END AS now_size FROM p)
SELECT source_catalog, source_schema, source_table, CASE WHEN source_table LIKE '%7' THEN 'GONE' WHEN source_table LIKE '%3' THEN 'NEW' WHEN now_size IS DISTINCT FROM size_in_bytes THEN 'CHANGED' ELSE 'SAME' END AS verdict,
 CASE WHEN source_table NOT LIKE '%7' AND source_table NOT LIKE '%3' THEN CASE WHEN now_size IS DISTINCT FROM size_in_bytes THEN 'size_in_bytes' ELSE '' END END AS changed,
 CASE WHEN source_table NOT LIKE '%3' THEN outcome END AS planned_outcome, CASE WHEN source_table NOT LIKE '%7' THEN outcome END AS present_outcome FROM n""")
def blueprint_drift(t):
    """A stored plan against a later dry run: tables gone, new ones, and sizes that grew."""
    stored = R.blueprint(_plan(t).filter("source_table NOT LIKE '%3'"), "exec-1", now())
    grown = t.source_stats.withColumn("size_in_bytes", F.expr("CASE WHEN size_in_bytes % 5 = 0 THEN size_in_bytes + 1 ELSE size_in_bytes END"))
    return R.plan_drift(R.stored_plan(stored, "exec-1"), _plan(t, grown).filter("source_table NOT LIKE '%7'"))


# --- planning and copying -------------------------------------------------------


@query("I6, C2", _updated("status = 'QUEUED' AND a.migration_id IS NOT NULL", {
    "chunk_id": "a.new_chunk", "batch_id": "'batch-new'", "updated_at": TS,
}, f"control LEFT JOIN (SELECT migration_id, CAST({KEY} % 9 + 1 AS INT) AS new_chunk FROM control WHERE {KEY} % 3 <> 0) a USING (migration_id)",
    "* EXCLUDE (new_chunk)"))
def assign_chunks(t):
    k = F.expr(KEY)
    pairs = t.control.filter(k % 3 != 0).select(
        "migration_id", F.lit("batch-new").alias("batch_id"), (k % 9 + 1).cast("int").alias("chunk_id"))
    return C.assign_chunks(t.control, pairs, now())


@query("I7", _updated("status = 'QUEUED' AND batch_id = 'batch-2' AND chunk_id = 13", {
    "status": "'ASSIGNED'", "assigned_cluster_id": "'cl-1'", "updated_at": TS,
}))
def mark_assigned(t):
    return C.mark_assigned(t.control, "batch-2", 13, "cl-1", now())


@query("I8", _updated("status IN ('ASSIGNED', 'QUEUED') AND f.duration_seconds_1 IS NOT NULL", {
    "status": "'IN_PROGRESS'", "attempt_number": "attempt_number + 1", "started_at": TS, "updated_at": TS,
}, "control LEFT JOIN (SELECT migration_id, duration_seconds AS duration_seconds_1 FROM finished) f USING (migration_id)",
    "* EXCLUDE (duration_seconds_1)"))
def mark_in_progress(t):
    return C.mark_in_progress(t.control, t.finished, now())


_FINISHED = """control LEFT JOIN (SELECT migration_id, duration_seconds AS d, target_num_files AS n, target_version AS v, source_version AS s
 FROM finished) f USING (migration_id)"""


@query("I9", _updated("status = 'IN_PROGRESS' AND d IS NOT NULL", {
    "status": "'COMPLETED'", "completed_at": TS, "duration_seconds": "d", "target_num_files": "n", "target_version": "v",
    "source_version": "COALESCE(s, source_version)", "error_code": "NULL", "error_message": "NULL", "updated_at": TS,
}, _FINISHED, "* EXCLUDE (d, n, v, s)"))
def mark_completed(t):
    return C.mark_completed(t.control, t.finished, now())


_LOST = """control LEFT JOIN (SELECT migration_id, true AS hit, COALESCE(error_code, 'CLONE_FAILED') AS code, error_message AS text, duration_seconds AS d
 FROM lost) f USING (migration_id)"""


@query("I10", _updated("status = 'IN_PROGRESS' AND hit", {
    "status": "CASE WHEN code = 'LOCATION_OVERLAP' THEN 'FAILED_PERMANENT' WHEN attempt_number < max_attempts THEN 'RETRY_PENDING' ELSE 'FAILED' END",
    "failed_at": TS, "duration_seconds": "COALESCE(d, 0)", "error_code": "code", "error_message": "text", "updated_at": TS,
}, _LOST, "* EXCLUDE (hit, code, text, d)"))
def mark_failed(t):
    return C.mark_failed(t.control, t.lost, now())


@query("I11", _updated("hit", {"status": "'FAILED_PERMANENT'", "error_message": "text", "updated_at": TS}, _LOST, "* EXCLUDE (hit, code, text, d)"))
def mark_permanent_failure(t):
    return C.mark_permanent_failure(t.control, t.lost.withColumnRenamed("error_message", "reason"), now())


_OUT = """control LEFT JOIN (SELECT migration_id, status AS st, message AS msg, source_row_count AS a, target_row_count AS b FROM outcomes) o USING (migration_id)"""


@query("I12", _updated("status = 'COMPLETED' AND st IS NOT NULL", {
    "status": "st", "validation_status": "st", "validation_message": "msg", "source_row_count": "COALESCE(a, source_row_count)",
    "target_row_count": "COALESCE(b, target_row_count)", "updated_at": TS,
}, _OUT, "* EXCLUDE (st, msg, a, b)"))
def mark_validated(t):
    return C.mark_validated(t.control, t.outcomes, now())


_CHUNK = f"batch_id = 'batch-5' AND chunk_id = 16 AND status IN {OPEN}"


@query("I18", _updated(_CHUNK, {
    "status": "CASE WHEN attempt_number + 1 < max_attempts THEN 'RETRY_PENDING' ELSE 'FAILED' END", "attempt_number": "attempt_number + 1",
    "started_at": f"CASE WHEN status <> 'IN_PROGRESS' THEN {TS} ELSE started_at END", "failed_at": TS, "duration_seconds": "0",
    "error_code": "'SUBMIT_FAILED'", "error_message": "'no room'", "updated_at": TS,
}))
def mark_chunk_lost(t):
    return C.mark_chunk_lost(t.control, "batch-5", 16, "no room", now())[0]


@query("I18, A16", f"""
SELECT migration_id, attempt_number + 1 AS attempt_number, 'FAILED' AS status, 'SUBMIT_FAILED' AS error_code, 'no room' AS error_message FROM control
WHERE {_CHUNK}""")
def attempts_of_lost_chunk(t):
    rows = C.mark_chunk_lost(t.control, "batch-5", 16, "no room", now())[1]
    return rows.select("migration_id", "attempt_number", "status", "error_code", "error_message")


# --- retry ----------------------------------------------------------------------


@query("I13", _updated(f"status IN {RETRYABLE} AND f.x IS NOT NULL", {"status": "'QUEUED'", "queued_at": TS, "updated_at": TS},
       "control LEFT JOIN (SELECT migration_id, 1 AS x FROM lost) f USING (migration_id)", "* EXCLUDE (x)"))
def requeue(t):
    return C.requeue(t.control, t.lost, now())


_RESET = {"status": "'RETRY_PENDING'", "attempt_number": "0", "error_code": "NULL",
          "error_message": "'Reset from FAILED_PERMANENT by retry_permanent=true'", "updated_at": TS}


@query("I13", _updated(f"status IN {RETRYABLE} AND f.x IS NOT NULL",
       {"status": "'QUEUED'", "attempt_number": "CAST(attempt_number + 1 AS INT)", "queued_at": TS, "updated_at": TS},
       "control LEFT JOIN (SELECT migration_id, 1 AS x FROM lost) f USING (migration_id)", "* EXCLUDE (x)"))
def requeue_counting_the_attempt(t):
    return C.requeue(t.control, t.lost, now(), count_attempt=True)


# Rows whose start is not known: by their last update, or stale as they are.
_UNSTARTED = "(SELECT * REPLACE (CASE WHEN CAST(migration_id AS BIGINT) % 3 = 0 THEN NULL ELSE started_at END AS started_at) FROM control)"


@query("I15", f"""
SELECT migration_id, CASE WHEN status IN {ACTIVE} AND date_sub('minute', COALESCE(started_at, updated_at), TIMESTAMP '1995-06-01 00:00:00') > 120
 THEN 'RETRY_PENDING' ELSE status END AS later, CASE WHEN status IN {ACTIVE} AND (started_at IS NULL
 OR date_sub('minute', started_at, TIMESTAMP '1995-06-01 00:00:00') > 120) THEN 'RETRY_PENDING' ELSE status END AS at_once FROM {_UNSTARTED}""")
def stale_without_a_start(t):
    rows = t.control.withColumn("started_at", F.expr("CASE WHEN CAST(migration_id AS BIGINT) % 3 <> 0 THEN started_at END"))
    at = F.expr("TIMESTAMP '1995-06-01 00:00:00'")
    later = C.reconcile_stale(rows, at).select("migration_id", F.col("status").alias("later"))
    once = C.reconcile_stale(rows, at, unstarted_at_once=True).select("migration_id", F.col("status").alias("at_once"))
    return later.join(once, "migration_id")


@query("I14", _updated("status = 'FAILED_PERMANENT' AND batch_id = 'batch-3'", _RESET))
def reset_permanent_failures(t):
    return C.reset_permanent_failures(t.control, now(), "batch-3")


_STALE = f"status IN {ACTIVE} AND date_sub('minute', started_at, TIMESTAMP '1995-06-01 00:00:00') > 120"


@query("I15", _updated(_STALE, {
    "status": "'RETRY_PENDING'", "error_code": "'STALE_EXECUTION'",
    "error_message": "'Record was IN_PROGRESS/ASSIGNED beyond stale threshold; requeued'", "updated_at": "TIMESTAMP '1995-06-01 00:00:00'",
}))
def reconcile_stale(t):
    return C.reconcile_stale(t.control, F.expr("TIMESTAMP_NTZ '1995-06-01 00:00:00'"))


_PERMANENT = "('TABLE_OR_VIEW_NOT_FOUND', 'SCHEMA_NOT_FOUND', 'CATALOG_NOT_FOUND', 'PERMISSION_DENIED', 'FAILED_PERMANENT')"
_PASS = f"""r AS ({_updated("status = 'FAILED_PERMANENT'", _RESET)}),
p AS (SELECT *, CASE WHEN status IN {RETRYABLE} THEN CASE WHEN error_code IN {_PERMANENT} THEN 'permanent_code'
 WHEN attempt_number >= max_attempts THEN 'attempts_exhausted' ELSE 'requeued' END END AS retry_outcome FROM r)"""


@query("I16, B15", f"""
WITH {_PASS} SELECT migration_id, retry_outcome, CASE WHEN retry_outcome = 'requeued' THEN 'QUEUED' WHEN retry_outcome IS NOT NULL
 THEN 'FAILED_PERMANENT' ELSE status END AS status, CASE retry_outcome WHEN 'permanent_code' THEN concat('Non-retryable error: ', error_code)
 WHEN 'attempts_exhausted' THEN 'Max attempts (3) exhausted' ELSE error_message END AS error_message,
 CASE WHEN retry_outcome = 'requeued' THEN {TS} + to_seconds(CASE WHEN attempt_number > 0 THEN CAST(30 * pow(2, attempt_number - 1) AS INT) ELSE 0 END) END AS next_eligible_at
FROM p""")
def retry_pass(t):
    passed = C.retry_pass(t.control, now(), retry_permanent=True, backoff_base=30.0)
    return passed.select("migration_id", "retry_outcome", "status", "error_message", "next_eligible_at")


@query("I16", f"""
WITH {_PASS} SELECT COUNT(retry_outcome) AS eligible, COUNT(*) FILTER (WHERE retry_outcome = 'requeued') AS requeued,
 COUNT(*) FILTER (WHERE retry_outcome <> 'requeued') AS permanent FROM p""")
def retry_stats(t):
    return C.retry_stats(C.retry_pass(t.control, now(), retry_permanent=True))


@query("I17", f"""
SELECT migration_id, status AS old_status, CASE WHEN {KEY} % 2 = 0 THEN 'QUEUED' ELSE 'RETRY_PENDING' END AS new_status FROM control
WHERE CASE WHEN {KEY} % 2 = 0 THEN status NOT IN ('QUEUED', 'WAITING_FOR_LOAD', 'ASSIGNED', 'RETRY_PENDING', 'FAILED_PERMANENT')
 ELSE status NOT IN ('RETRY_PENDING', 'FAILED', 'VALIDATION_FAILED', 'FAILED_PERMANENT') END""")
def illegal_moves(t):
    moved = t.control.withColumn("status", F.when(F.expr(KEY) % 2 == 0, "QUEUED").otherwise("RETRY_PENDING"))
    return C.illegal_moves(t.control, moved)


# --- batches --------------------------------------------------------------------


@query("I19", "SELECT migration_id, status FROM control WHERE batch_id <> 'batch-1'")
def batch_deleted(t):
    return C.delete_batch(t.control, t.attempts, "batch-1")[0].select("migration_id", "status")


@query("I19, C4", """
SELECT migration_id, attempt_number, created_at FROM attempts a WHERE EXISTS
 (SELECT 1 FROM control c WHERE c.migration_id = a.migration_id AND c.batch_id <> 'batch-1')""")
def attempts_after_delete(t):
    return C.delete_batch(t.control, t.attempts, "batch-1")[1].select("migration_id", "attempt_number", "created_at")


@query("I20", _updated("batch_id = 'batch-2'", {
    "status": "'QUEUED'", "attempt_number": "0",
    **{c: "NULL" for c in ["started_at", "completed_at", "failed_at", "error_code", "error_message", "validation_status", "validation_message"]},
}))
def requeue_batch(t):
    return C.requeue_batch(t.control, "batch-2")


# --- requests -------------------------------------------------------------------


@query("I21", _updated(f"status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= {TS})", {
    "status": "'IN_PROGRESS'", "execution_id": "'exec-now'",
}, "requests"))
def claim_requests(t):
    return C.claim_requests(t.requests, "exec-now", now())


@query("I21", _updated("status = 'IN_PROGRESS' AND done.st IS NOT NULL", {"status": "st", "completed_at": TS}, """requests LEFT JOIN
 (SELECT split_part(execution_id, '-', 2) AS onboarding_id, CASE WHEN COUNT(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED' ELSE 'COMPLETED' END AS st
  FROM request_audit GROUP BY 1) done USING (onboarding_id)""", "* EXCLUDE (st)"))
def complete_requests(t):
    failed = F.count(F.when(F.col("status") == "FAILED", 1)) > 0
    done = t.request_audit.groupBy(F.split_part("execution_id", F.lit("-"), F.lit(2)).alias("onboarding_id")).agg(
        F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"))
    return C.complete_requests(t.requests, done, now())


@query("I21", _updated("status = 'FAILED'", {
    "status": "'PENDING'", "execution_id": "NULL", "completed_at": "NULL", "notes": "concat(COALESCE(notes, ''), ' | Re-queued: again')",
}, "requests"))
def requeue_requests(t):
    return C.requeue_requests(t.requests, F.col("status") == "FAILED", "again")


@query("I21", _updated("status = 'IN_PROGRESS' AND date_diff('day', CAST(requested_at AS DATE), DATE '1998-01-01') > 1", {
    "status": "'PENDING'", "execution_id": "NULL",
}, "requests"))
def reset_stuck_requests(t):
    return C.reset_stuck_requests(t.requests, F.expr("DATE '1998-01-01'"))


# --- statistics joined, packing -------------------------------------------------


@query("C10", """
SELECT c.migration_id, s.size_in_bytes AS src_bytes, g.size_in_bytes AS tgt_bytes, s.num_files AS src_files, g.num_files AS tgt_files
FROM control c LEFT JOIN source_stats s ON s.table_fqn = concat(c.source_catalog, '.', c.source_schema, '.', c.source_table)
LEFT JOIN target_stats g ON g.table_fqn = concat(c.target_catalog, '.', c.target_schema, '.', c.target_table)""")
def stats_of_both_sides(t):
    joined = K.with_stats(t.control, t.source_stats, t.target_stats)
    return joined.select("migration_id", "src_bytes", "tgt_bytes", "src_files", "tgt_files")


@query("E7", """
SELECT batch_id, COUNT(*) AS queued_rows, CAST(ceil(COUNT(*) / 5.0) AS INT) AS max_tables FROM control WHERE status = 'QUEUED' GROUP BY batch_id""")
def derived_count_caps(t):
    return P.count_caps(T.queued(t.control), 5)


# First fit, largest first, one table per step and batch; totals and counts of the open chunks are lists.
_CAP = 500 * 1024**3


@query("E6, E7, D24", f"""
WITH RECURSIVE q AS (SELECT batch_id, migration_id, size_in_bytes AS size,
 ROW_NUMBER() OVER (PARTITION BY batch_id ORDER BY size_in_bytes DESC, migration_id) AS rn,
 CAST(ceil(COUNT(*) OVER (PARTITION BY batch_id) / 5.0) AS BIGINT) AS cap FROM control WHERE status = 'QUEUED'),
p AS (SELECT batch_id, migration_id, rn, cap, 1::BIGINT AS chunk_id, [size] AS totals, [1::BIGINT] AS counts FROM q WHERE rn = 1
UNION ALL
SELECT batch_id, migration_id, rn, cap, chunk_id,
 CASE WHEN chunk_id > len(totals) THEN list_append(totals, size) ELSE list_transform(totals, lambda x, i: CASE WHEN i = chunk_id THEN x + size ELSE x END) END,
 CASE WHEN chunk_id > len(totals) THEN list_append(counts, 1) ELSE list_transform(counts, lambda x, i: CASE WHEN i = chunk_id THEN x + 1 ELSE x END) END
FROM (SELECT q.batch_id, q.migration_id, q.rn, q.cap, q.size, p.totals, p.counts,
  COALESCE(list_position(list_transform(p.totals, lambda x, i: ({_CAP} - x >= q.size OR q.size = 0) AND p.counts[i] < q.cap), true), len(p.totals) + 1) AS chunk_id
 FROM p JOIN q ON q.batch_id = p.batch_id AND q.rn = p.rn + 1))
SELECT batch_id, migration_id, CAST(chunk_id AS INT) AS chunk_id FROM p""")
def chunk_packing(t):
    return P.plan_chunks(T.queued(t.control), _CAP, 5)


# Whatever the parts, each table is placed once, no chunk is over its caps and at most one of a batch is half empty.
@query("E6", f"""
SELECT batch_id, COUNT(*) AS tables, CAST(SUM(size_in_bytes) AS BIGINT) AS bytes, true AS within_caps, true AS well_filled
FROM control WHERE status = 'QUEUED' GROUP BY batch_id""")
def chunk_packing_in_parts(t):
    queued = T.queued(t.control)
    placed = queued.select("migration_id", "batch_id", "size_in_bytes").join(P.plan_chunks(queued, _CAP, 5, parts=8), ["batch_id", "migration_id"])
    chunks = placed.groupBy("batch_id", "chunk_id").agg(
        F.count("*").alias("n"), F.sum("size_in_bytes").alias("held"), F.count_if(F.col("size_in_bytes") > 0).alias("sized")
    ).join(P.count_caps(queued, 5), "batch_id")
    within = (F.col("n") <= F.col("max_tables")) & ((F.col("held") <= _CAP) | (F.col("sized") == 1))
    half_empty = (2 * F.col("held") <= _CAP) & (2 * F.col("n") <= F.col("max_tables"))
    return chunks.groupBy("batch_id").agg(
        F.sum("n").alias("tables"), F.sum("held").alias("bytes"), F.bool_and(within).alias("within_caps"), (F.count_if(half_empty) <= 1).alias("well_filled")
    )
