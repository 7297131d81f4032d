"""Telemetry over control rows, attempts, validations and the copy audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ACTIVE, DONE, FAILED, GB, OPEN, RETRYABLE, count_if, query
from tableferry.functions import measures as M
from tableferry.operators import checks as K
from tableferry.operators import packing as P
from tableferry.operators import telemetry as T
from tableferry.sources import listing as L

NOW = "TIMESTAMP '2000-01-01 00:00:00'"


# --- headline and breakdowns ----------------------------------------------------


@query("D1", f"""
SELECT COUNT(*) AS total_tables, {count_if(f"status IN {DONE}")} AS done_tables,
 {count_if(f"status IN {ACTIVE}")} AS active_tables, {count_if("status = 'QUEUED'")} AS queued_tables,
 {count_if(f"status IN {FAILED}")} AS failed_tables,
 ROUND(100.0 * {count_if(f"status IN {DONE}")} / NULLIF(COUNT(*), 0), 1)::DOUBLE AS pct_complete,
 ROUND(COALESCE({GB}, 0), 2) AS total_gb,
 ROUND(COALESCE(CAST(SUM(CASE WHEN status IN {DONE} THEN size_in_bytes ELSE 0 END) AS DOUBLE) / 1073741824, 0), 2) AS gb_done
FROM control""")
def headline_kpis(t):
    return T.kpis(t.control)


@query("D2", f"SELECT status, COUNT(*) AS n, {GB} AS total_gb FROM control GROUP BY status")
def status_counts(t):
    return T.status_counts(t.control)


@query("D2", f"SELECT batch_id, status, COUNT(*) AS n, {GB} AS total_gb FROM control GROUP BY batch_id, status")
def status_counts_by_batch(t):
    return T.status_counts(t.control, by_batch=True)


@query("D2, D16", "SELECT status, COUNT(*) AS n FROM requests GROUP BY status")
def request_status_counts(t):
    return T.breakdown(t.requests, ["status"])


@query("D3", f"""
SELECT date_trunc('hour', completed_at) AS hour, COUNT(*) AS tables_done, ROUND({GB}, 2) AS gb_done, ROUND(AVG(duration_seconds), 1) AS avg_duration_s
FROM control WHERE status IN {DONE} AND completed_at IS NOT NULL GROUP BY 1""")
def hourly_throughput(t):
    return T.throughput(t.control)


# Every hour in which something ended, against all that had ended by its end.
@query("E1", f"""
SELECT ends.hour, COUNT(*) AS cumulative_done
FROM (SELECT DISTINCT make_timestamp(CAST(floor(epoch(completed_at) / 3600) AS BIGINT) * 3600000000) AS hour FROM control
 WHERE completed_at IS NOT NULL AND status IN {DONE}) ends
JOIN control c ON c.status IN {DONE} AND c.completed_at < ends.hour + INTERVAL 1 HOUR GROUP BY ends.hour""")
def burn_up(t):
    return T.burn_up(t.control)


@query("D4", f"SELECT COALESCE(error_code, '(none)') AS error_code, COUNT(*) AS n FROM control WHERE status IN {FAILED} GROUP BY 1")
def failures_by_code(t):
    return T.failure_codes(t.control)


@query("D5", """
SELECT CAST(created_at AS DATE) AS day, COALESCE(status, '(unknown)') AS status, COUNT(*) AS n
FROM attempts GROUP BY 1, 2""")
def attempts_per_day(t):
    return T.daily_by_status(t.attempts, "created_at")


@query("D6", """
SELECT CAST(validated_at AS DATE) AS day, COALESCE(status, '(unknown)') AS status, COUNT(*) AS n
FROM validation_history GROUP BY 1, 2""")
def validations_per_day(t):
    return T.daily_by_status(t.validation_history, "validated_at")


@query("D7", f"""
SELECT batch_id, chunk_id, COUNT(*) AS tables, ROUND({GB}, 2) AS gb, CAST(SUM(size_in_bytes) AS BIGINT) AS total_bytes,
 {count_if(f"status IN {DONE}")} AS done FROM control WHERE chunk_id IS NOT NULL GROUP BY batch_id, chunk_id""")
def chunk_fan_out(t):
    return T.chunk_fan_out(t.control)


_COUNTERS = ", ".join(f"{count_if(f"status = '{s}'")} AS {name}" for name, s in T.RUN_COUNTERS.items())


@query("D8", f"""
SELECT COUNT(*) AS total, {_COUNTERS}, CAST(SUM(size_in_bytes) AS BIGINT) AS total_bytes,
 CAST(SUM(CASE WHEN status IN {DONE} THEN size_in_bytes END) AS BIGINT) AS bytes_done,
 CAST(SUM(duration_seconds) AS BIGINT) AS total_duration_s
FROM control WHERE batch_id = 'batch-3'""")
def run_metrics(t):
    return T.run_metrics(t.control, "batch-3")


@query("D9", f"""
SELECT chunk_id, status, COUNT(*) AS tables, ROUND({GB}, 2) AS total_gb, AVG(duration_seconds) AS avg_duration_s
FROM control WHERE batch_id = 'batch-2' GROUP BY chunk_id, status""")
def batch_summary(t):
    return T.batch_summary(t.control, "batch-2")


@query("D10", f"SELECT workload_class, COUNT(*) AS n, {GB} AS total_gb FROM control GROUP BY workload_class")
def workload_distribution(t):
    return T.workload_distribution(t.control)


@query("D11", f"""
SELECT DISTINCT batch_id, chunk_id FROM control WHERE status IN {OPEN} AND COALESCE(chunk_id, 0) > 0""")
def open_chunks(t):
    return T.open_chunks(t.control)


_STATUS = """CASE WHEN source_row_count IS NULL OR target_row_count IS NULL THEN 'NOT CHECKED'
 WHEN source_row_count = target_row_count THEN 'MATCH' ELSE 'MISMATCH' END"""


def _dimension(name: str) -> str:
    expr = _STATUS if name == "row_count_status" else name
    return f"""SELECT '{name}' AS dimension, CAST({expr} AS VARCHAR) AS value, COUNT(*) AS tables, {GB} AS gb,
 AVG(duration_seconds) AS avg_duration_s FROM control GROUP BY 1, 2"""


@query("D12", " UNION ALL ".join(_dimension(d) for d in T.CONTROL_DIMENSIONS))
def control_breakdowns(t):
    return T.control_breakdowns(t.control)


@query("D12", """
SELECT batch_id, workload_class, AVG(duration_seconds) AS avg_duration_s, MAX(attempt_number) AS most_attempts
FROM control GROUP BY batch_id, workload_class""")
def breakdown_of_any_measure(t):
    return T.breakdown(
        t.control, ["batch_id", "workload_class"],
        avg_duration_s=F.avg("duration_seconds"), most_attempts=F.max("attempt_number"),
    )


@query("D13", f"""
SELECT execution_id, COUNT(*) AS tables_attempted, {count_if("status = 'SUCCESS'")} AS success,
 {count_if("status = 'FAILED'")} AS failed, {count_if("validation_status = 'PASS'")} AS val_pass,
 {count_if("validation_status = 'FAIL'")} AS val_fail,
 ROUND(CAST(SUM(size_bytes) AS DOUBLE) / 1073741824, 3) AS total_gb,
 CAST(SUM(duration_seconds) AS BIGINT) AS total_seconds, CAST(SUM(records_cloned) AS BIGINT) AS total_records,
 MIN(start_time) AS started_at, MAX(end_time) AS completed_at FROM audit GROUP BY execution_id""")
def execution_summary(t):
    return T.execution_summary(t.audit)


@query("D14", f"""
SELECT CAST(run_timestamp AS DATE) AS run_date, execution_id, COUNT(*) AS total_tables,
 CAST(SUM(size_bytes) AS DOUBLE) / 1e9 AS total_gb, {count_if("status = 'FAILED'")} AS failures
FROM audit GROUP BY 1, 2""")
def daily_executions(t):
    return T.daily_executions(t.audit)


@query("D15", f"""
SELECT cluster_id, COUNT(*) AS tables_assigned, {count_if("status = 'SUCCESS'")} AS done,
 {count_if("status = 'FAILED'")} AS failed, MIN(start_time) AS started_at, MAX(end_time) AS last_update
FROM audit WHERE execution_id = 'exec-2' GROUP BY cluster_id""")
def copies_by_cluster(t):
    return T.by_cluster(t.audit, "exec-2")


@query("D16", """
SELECT status, COUNT(*) AS table_count, CAST(SUM(records_cloned) AS BIGINT) AS total_records,
 CAST(SUM(size_bytes) AS DOUBLE) / 1e9 AS total_gb, ROUND(AVG(duration_seconds) / 60.0, 1) AS avg_duration_min
FROM audit WHERE execution_id = 'exec-1' GROUP BY status""")
def live_progress(t):
    return T.live_progress(t.audit, "exec-1")


@query("D17", """
SELECT priority, status, COUNT(*) AS request_count, MIN(requested_at) AS oldest_request
FROM requests GROUP BY priority, status""")
def request_queue_state(t):
    return T.request_queue(t.requests)


@query("D18, J17", """
WITH limits AS (SELECT * FROM (VALUES ('row_count_parity', 100.0), ('schema_match', 100.0), ('data_hash_integrity', 99.0),
 ('table_type_preserved', 100.0), ('partition_columns_match', 100.0), ('audit_log_completeness', 100.0),
 ('delta_table_valid', 100.0)) AS x(check_name, required_pct)),
rates AS (SELECT check_name, COUNT(*) AS checks, COUNT(*) FILTER (WHERE passed) AS passed_checks FROM report GROUP BY check_name)
SELECT check_name, checks, passed_checks, passed_checks * 100.0::DOUBLE / checks AS pass_rate,
 required_pct::DOUBLE AS required_pct, passed_checks * 100.0::DOUBLE / checks >= required_pct AS accepted
FROM rates LEFT JOIN limits USING (check_name)""")
def acceptance(t):
    return K.acceptance(t.report)


@query("D18", """
SELECT check_name, passed, COUNT(*) AS check_count, COUNT(*) FILTER (WHERE passed) AS passed_count
FROM report GROUP BY check_name, passed""")
def check_pass_counts(t):
    return K.pass_counts(t.report)


@query("D18", """
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
 COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
 ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE passed) / COUNT(*), 2) AS pass_rate_pct FROM report""")
def report_summary(t):
    return K.report_summary(t.report)


@query("J16, F8", """
SELECT execution_id, check_name, table_name, passed, detail FROM report WHERE NOT passed ORDER BY check_name, table_name, detail, execution_id LIMIT 1""")
def first_failed_check(t):
    return K.first_failures(t.report)


@query("D24", """
SELECT batch_id, COALESCE(chunk_id, 0) AS chunk_id, COUNT(*) AS tables, CAST(SUM(size_in_bytes) AS BIGINT) AS total_bytes
FROM control WHERE status = 'QUEUED' GROUP BY 1, 2""")
def rebuilt_chunks(t):
    return P.rebuild_chunks(T.queued(t.control))


_LAST = """last AS (SELECT migration_id, arg_max(status, attempt_number) AS outcome FROM
 (SELECT migration_id, attempt_number, MAX(status) AS status FROM attempts GROUP BY 1, 2) GROUP BY migration_id),
chunks AS (SELECT batch_id, chunk_id, COUNT(*) AS dispatched,
 COUNT(*) FILTER (WHERE outcome = 'SUCCESS') AS completed_tables, COUNT(*) FILTER (WHERE outcome <> 'SUCCESS') AS failed_tables
 FROM last JOIN control USING (migration_id) GROUP BY batch_id, chunk_id)"""


@query("D26", f"WITH {_LAST} SELECT * FROM chunks")
def chunk_outcomes(t):
    return T.chunk_outcomes(t.attempts, t.control)


@query("D26", f"""
WITH {_LAST} SELECT CAST(SUM(dispatched) AS BIGINT) AS dispatched, CAST(SUM(completed_tables) AS BIGINT) AS completed_tables,
 CAST(SUM(failed_tables) AS BIGINT) AS failed_tables, COUNT(*) FILTER (WHERE failed_tables = 0) AS completed_chunks,
 COUNT(*) FILTER (WHERE failed_tables > 0) AS failed_chunks FROM chunks""")
def run_outcome_totals(t):
    return T.outcome_totals(T.chunk_outcomes(t.attempts, t.control))


@query("D28", """
SELECT CASE WHEN gb < 0 THEN 0 WHEN gb >= 500 THEN 11 ELSE CAST(floor(gb * 10 / 500) AS BIGINT) + 1 END AS bucket, COUNT(*) AS tables
FROM (SELECT CAST(size_in_bytes AS DOUBLE) / 1073741824 AS gb FROM control) GROUP BY 1""")
def size_histogram(t):
    return T.size_histogram(t.control, 0.0, 500.0, 10)


@query("D29", "SELECT catalog, schema_name, COUNT(*) AS tables FROM listing GROUP BY catalog, schema_name")
def tables_per_schema(t):
    return L.tables_per_schema(t.listing)


@query("D30", """
WITH c AS (SELECT batch_id, chunk_id, CAST(SUM(size_in_bytes) AS BIGINT) AS total_bytes FROM control
 WHERE chunk_id IS NOT NULL GROUP BY 1, 2)
SELECT batch_id, COUNT(*) AS chunks, MAX(total_bytes) AS largest_bytes, MIN(total_bytes) AS smallest_bytes,
 CAST(MAX(total_bytes) AS DOUBLE) / MIN(total_bytes) AS ratio,
 CAST(MAX(total_bytes) AS DOUBLE) / MIN(total_bytes) <= 2 AS balanced FROM c GROUP BY batch_id""")
def chunk_balance(t):
    return P.chunk_balance(T.chunk_fan_out(t.control))


# --- latest of each -------------------------------------------------------------


@query("E4", """
SELECT execution_id FROM audit ORDER BY run_timestamp DESC, execution_id DESC LIMIT 1""")
def latest_execution(t):
    return T.latest_execution(t.audit)


@query("E5", """
SELECT migration_id, validation_id, validated_at, row_count_checked, source_row_count, target_row_count, row_count_matched, status,
 CASE WHEN source_row_count IS NULL THEN 'NOT CHECKED' WHEN source_row_count = target_row_count THEN 'MATCH'
  ELSE 'MISMATCH' END AS row_count_status
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY migration_id ORDER BY validated_at DESC, validation_id DESC) AS rn
 FROM validation_history) WHERE rn = 1""")
def latest_validations(t):
    return T.latest_validations(t.validation_history)


@query("E5", "SELECT * FROM validation_history")
def full_validation_history(t):
    return T.full_validation_history(t.validation_history)


# --- filters --------------------------------------------------------------------


@query("B10", "SELECT migration_id, status FROM control WHERE batch_id = 'batch-5'")
def rows_of_batch(t):
    return T.of_batch(t.control, "batch-5").select("migration_id", "status")


@query("B11", "SELECT migration_id, chunk_id, size_in_bytes FROM control WHERE status = 'QUEUED' AND batch_id = 'batch-1'")
def queued_rows(t):
    return T.queued(t.control, "batch-1").select("migration_id", "chunk_id", "size_in_bytes")


@query("B12", f"""
SELECT migration_id, status FROM control WHERE batch_id = 'batch-1' AND chunk_id = 13 AND status IN {OPEN}""")
def rows_of_chunk(t):
    return T.chunk_queue(t.control, "batch-1", 13).select("migration_id", "status")


@query("B13", f"SELECT migration_id, batch_id, chunk_id, started_at, status FROM control WHERE status IN {ACTIVE}")
def rows_in_flight(t):
    return T.in_flight(t.control).select("migration_id", "batch_id", "chunk_id", "started_at", "status")


@query("B14", """
SELECT migration_id, source_version, target_version FROM control
WHERE status = 'COMPLETED' AND COALESCE(validation_status, '') <> 'VALIDATED'""")
def rows_to_validate(t):
    return T.to_validate(t.control).select("migration_id", "source_version", "target_version")


@query("B15", f"""
SELECT migration_id, attempt_number, status FROM control WHERE status IN {RETRYABLE} AND attempt_number < max_attempts""")
def retryable_rows(t):
    return T.retryable(t.control).select("migration_id", "attempt_number", "status")


@query("B16, B17", """
SELECT migration_id, CASE WHEN size_in_bytes IS NULL THEN 'UNKNOWN' WHEN size_in_bytes < 10737418240 THEN 'SMALL'
  WHEN size_in_bytes < 107374182400 THEN 'MEDIUM' WHEN size_in_bytes < 1073741824000 THEN 'LARGE' ELSE 'XLARGE' END AS class,
 CAST(CASE WHEN size_in_bytes IS NULL THEN 0 WHEN size_in_bytes < 10737418240 THEN 1
  WHEN size_in_bytes < 107374182400 THEN 3 WHEN size_in_bytes < 1073741824000 THEN 8 ELSE 20 END AS INT) AS weight,
 CAST(size_in_bytes AS DOUBLE) / 1073741824 AS size_gb
FROM (SELECT migration_id, CASE WHEN CAST(migration_id AS BIGINT) % 13 <> 0
 THEN size_in_bytes * (CASE WHEN CAST(migration_id AS BIGINT) % 5 = 0 THEN 10 ELSE 1 END) END AS size_in_bytes FROM control)""")
def workload_classes(t):
    k = F.col("migration_id").cast("bigint")
    size = F.when(k % 13 != 0, F.col("size_in_bytes") * F.when(k % 5 == 0, 10).otherwise(1))
    return t.control.withColumn("b", size).select(
        "migration_id",
        M.workload_class(F.col("b")).alias("class"),
        M.workload_weight(F.col("b")).alias("weight"),
        M.gib(F.col("b")).alias("size_gb"),
    )


@query("B18", f"""
SELECT migration_id, {_STATUS} AS row_count_status, CASE WHEN source_row_count IS NULL THEN 'NOT CHECKED'
 WHEN source_row_count = target_row_count THEN 'MATCH' ELSE 'MISMATCH' END AS by_source FROM control""")
def row_count_statuses(t):
    by_source = M.row_count_status_by_source(F.col("source_row_count"), F.col("target_row_count"))
    return T.with_row_count_status(t.control).select("migration_id", "row_count_status", by_source.alias("by_source"))


_MESSAGES = """CASE CAST(migration_id AS BIGINT) % 6 WHEN 0 THEN concat('[TABLE_OR_VIEW_NOT_FOUND] no table ', source_table)
 WHEN 1 THEN 'LOCATION_OVERLAP at s3' WHEN 2 THEN 'java: PermissionDenied' WHEN 3 THEN 'PERMISSION_DENIED: no'
 WHEN 4 THEN 'org.AnalysisException: bad' ELSE 'socket closed' END"""


@query("B19", f"""
WITH m AS (SELECT migration_id, attempt_number, max_attempts, {_MESSAGES} AS message FROM control),
c AS (SELECT *, CASE WHEN contains(message, 'TABLE_OR_VIEW_NOT_FOUND') THEN 'TABLE_OR_VIEW_NOT_FOUND'
 WHEN contains(message, 'LOCATION_OVERLAP') THEN 'LOCATION_OVERLAP'
 WHEN contains(message, 'PERMISSION_DENIED') OR contains(message, 'PermissionDenied') THEN 'PERMISSION_DENIED'
 WHEN contains(message, 'AnalysisException') THEN 'ANALYSIS_EXCEPTION' ELSE 'CLONE_FAILED' END AS error_code FROM m)
SELECT migration_id, error_code, CASE WHEN error_code <> 'CLONE_FAILED' THEN 'FAILED_PERMANENT'
 WHEN attempt_number < max_attempts THEN 'RETRY_PENDING' ELSE 'FAILED' END AS next_status FROM c""")
def error_classification(t):
    df = t.control.withColumn("message", F.expr(_MESSAGES)).withColumn("error_code", M.error_code(F.col("message")))
    nxt = M.failure_status(F.col("error_code"), F.col("attempt_number"), F.col("max_attempts"))
    return df.select("migration_id", "error_code", nxt.alias("next_status"))


@query("B20", f"""
SELECT source_catalog, source_schema, source_table, attempt_number, max_attempts, error_code, error_message, updated_at
FROM control WHERE status IN {FAILED}""")
def failed_rows(t):
    return T.failed_rows(t.control)


@query("B21", """
SELECT onboarding_id, request_name, requested_by, execution_id, requested_at FROM requests WHERE status = 'IN_PROGRESS'""")
def requests_in_flight(t):
    return T.requests_in_flight(t.requests)


@query("B22", """
SELECT migration_id, substr(repeat(concat(error_message, ' '), 40), 1, 500) AS error_message,
 substr(repeat(error_code, 5), 1, 50) AS error_code FROM control WHERE error_message IS NOT NULL""")
def capped_texts(t):
    long = t.control.filter("error_message IS NOT NULL")
    return long.select(
        "migration_id",
        M.capped(F.repeat(F.concat("error_message", F.lit(" ")), 40), 500).alias("error_message"),
        M.capped(F.repeat("error_code", 5), 50).alias("error_code"),
    )


@query("B23", """
SELECT DISTINCT table_name, src_catalog, src_schema, tgt_catalog, tgt_schema, table_type, status, clone_mode
FROM audit WHERE execution_id = 'exec-3' AND status = 'SUCCESS'""")
def expected_tables(t):
    return K.expected_tables(t.audit, "exec-3")


# --- joins ----------------------------------------------------------------------


@query("C3", """
SELECT migration_id, source_table, attempt_number, a.status FROM attempts a JOIN
 (SELECT migration_id, source_table FROM control) c USING (migration_id)""")
def attempts_of_tables(t):
    return T.attempts_of(t.attempts, t.control).select("migration_id", "source_table", "attempt_number", "status")


@query("C4", """
SELECT migration_id, attempt_number FROM attempts a
WHERE NOT EXISTS (SELECT 1 FROM control c WHERE c.migration_id = a.migration_id AND c.batch_id <> 'batch-4')""")
def orphan_attempts(t):
    left = t.control.filter("batch_id <> 'batch-4'")
    return T.orphan_attempts(t.attempts, left).select("migration_id", "attempt_number")


@query("C5", """
SELECT r.onboarding_id, r.request_name, r.requested_by, execution_id, r.requested_at, a.table_name, a.error_message
FROM requests r JOIN request_audit a USING (execution_id) WHERE r.status = 'FAILED' AND a.status = 'FAILED'""")
def failed_requests(t):
    return T.failed_requests(t.requests, t.request_audit)


# --- lists ----------------------------------------------------------------------


@query("F1", """
SELECT migration_id, chunk_id, workload_weight, size_in_bytes FROM control WHERE status = 'QUEUED'
ORDER BY chunk_id, workload_weight DESC, size_in_bytes DESC, migration_id LIMIT 500""")
def work_queue(t):
    return T.work_queue(t.control).select("migration_id", "chunk_id", "workload_weight", "size_in_bytes")


@query("F2", f"""
SELECT migration_id, source_schema, source_table, target_schema, target_table,
 ROUND(CAST(size_in_bytes AS DOUBLE) / 1073741824, 2) AS size_gb, duration_seconds, batch_id, status
FROM control WHERE duration_seconds IS NOT NULL ORDER BY duration_seconds DESC, migration_id LIMIT 50""")
def longest_copies(t):
    return T.longest_copies(t.control)


@query("F3", f"""
SELECT source_catalog, source_schema, source_table, status, error_code, error_message, attempt_number, max_attempts,
 batch_id, updated_at FROM control WHERE status IN {FAILED} ORDER BY updated_at DESC, migration_id LIMIT 500""")
def latest_failures(t):
    return T.latest_failures(t.control)


@query("F4", """
SELECT source_schema, source_table, target_schema, target_table, source_version, target_version, source_row_count,
 target_row_count, validation_status, updated_at FROM control WHERE source_row_count <> target_row_count
ORDER BY updated_at DESC, migration_id LIMIT 500""")
def latest_mismatches(t):
    return T.latest_mismatches(t.control)


@query("F6", """
SELECT source_catalog, source_schema, source_table, target_catalog, target_schema, target_table, status, chunk_id,
 CAST(size_in_bytes AS DOUBLE) / 1073741824 AS size_gb FROM control WHERE batch_id = 'batch-6'""")
def batch_review(t):
    return T.batch_review(t.control, "batch-6")


@query("F7", f"""
SELECT onboarding_id, priority, requested_at FROM requests
WHERE status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= {NOW})""")
def due_requests(t):
    return T.due_requests(t.requests, F.expr(NOW)).select("onboarding_id", "priority", "requested_at")


@query("F7", f"""
SELECT scope_mode, clone_mode, COUNT(*) AS requests, MIN(priority) AS top_priority FROM requests
WHERE status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= {NOW}) GROUP BY 1, 2""")
def due_request_groups(t):
    return T.request_groups(t.requests, F.expr(NOW))


# --- scalar functions -----------------------------------------------------------


@query("H", f"""
SELECT migration_id, CAST(date_sub('minute', started_at, updated_at) AS BIGINT) AS age_minutes,
 CAST(date_diff('day', CAST(started_at AS DATE), CAST(updated_at AS DATE)) AS INT) AS age_days,
 CASE WHEN attempt_number > 0 THEN 30.0::DOUBLE * pow(2.0, attempt_number - 1) ELSE 0.0 END AS backoff_s,
 CASE WHEN duration_seconds <> 0 THEN CAST(size_in_bytes AS DOUBLE) / 1048576.0::DOUBLE / duration_seconds END AS mbps
FROM control""")
def times_and_rates(t):
    return t.control.select(
        "migration_id",
        M.age_minutes(F.col("started_at"), F.col("updated_at")).alias("age_minutes"),
        F.date_diff("updated_at", "started_at").alias("age_days"),
        M.backoff_seconds(30.0, F.col("attempt_number")).alias("backoff_s"),
        M.throughput_mbps(F.col("size_in_bytes").cast("double"), F.col("duration_seconds")).alias("mbps"),
    )


_OUTCOME = """CASE CAST(migration_id AS BIGINT) % 4
 WHEN 0 THEN concat('SUCCESS:batch=', batch_id, ',chunk=', CAST(chunk_id AS VARCHAR(32)), ',ok=', CAST(chunk_id AS VARCHAR(32)), ',fail=0')
 WHEN 1 THEN concat('PARTIAL_FAILURE:batch=', batch_id, ',chunk=1,ok=2,fail=', CAST(chunk_id AS VARCHAR(32)))
 WHEN 2 THEN 'SUCCESS' ELSE 'cluster lost' END"""


@query("H", """
SELECT migration_id,
 CAST(CASE CAST(migration_id AS BIGINT) % 4 WHEN 0 THEN chunk_id WHEN 1 THEN 2 WHEN 2 THEN 9 ELSE 0 END AS BIGINT) AS ok,
 CAST(CASE CAST(migration_id AS BIGINT) % 4 WHEN 0 THEN 0 WHEN 1 THEN chunk_id WHEN 2 THEN 0 ELSE 9 END AS BIGINT) AS fail
FROM control""")
def outcome_texts(t):
    df = t.control.select("migration_id", F.expr(_OUTCOME).alias("text"))
    return df.select("migration_id", M.outcome_counts(F.col("text"), F.lit(9)).alias("o")).select("migration_id", "o.*")
