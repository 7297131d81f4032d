"""Progress, throughput, failures and validation results from the control and history tables.

Grouped results come from partial aggregates, so what is shuffled is a row per group and task.
Lists for a screen are top-k queries: every task keeps its own k rows before they are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import measures as M


def _done() -> Column:
    return F.col("status").isin(S.DONE)


def _failed() -> Column:
    return F.col("status").isin(S.FAILED)


def _n(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _gb() -> Column:
    """GiB of a sum of bytes; the integers are summed first, so no order of adding shows."""
    return M.gib(F.sum("size_in_bytes"))


def _hour(col: str = "completed_at") -> Column:
    return F.date_trunc("HOUR", col).cast("timestamp_ntz")


# --- headline -----------------------------------------------------------------


def kpis(control: DataFrame) -> DataFrame:
    """Headline numbers, one row."""
    done_bytes = F.sum(F.when(_done(), F.col("size_in_bytes")).otherwise(0))
    return control.agg(
        F.count("*").alias("total_tables"),
        _n(_done()).alias("done_tables"),
        _n(F.col("status").isin(S.ACTIVE)).alias("active_tables"),
        _n(F.col("status") == "QUEUED").alias("queued_tables"),
        _n(_failed()).alias("failed_tables"),
        F.round(M.percent(_n(_done()), F.count("*")), 1).alias("pct_complete"),
        F.round(F.coalesce(_gb(), F.lit(0.0)), 2).alias("total_gb"),
        F.round(F.coalesce(M.gib(done_bytes), F.lit(0.0)), 2).alias("gb_done"),
    )


def status_counts(control: DataFrame, by_batch: bool = False) -> DataFrame:
    keys = ["batch_id", "status"] if by_batch else ["status"]
    return control.groupBy(*keys).agg(F.count("*").alias("n"), _gb().alias("total_gb"))


def throughput(control: DataFrame) -> DataFrame:
    """Tables, volume and mean duration by the hour of completion."""
    return (
        control.filter(_done() & F.col("completed_at").isNotNull())
        .groupBy(_hour().alias("hour"))
        .agg(
            F.count("*").alias("tables_done"),
            F.round(_gb(), 2).alias("gb_done"),
            F.round(F.avg("duration_seconds"), 1).alias("avg_duration_s"),
        )
    )


def burn_up(control: DataFrame) -> DataFrame:
    """Running total of completed tables by hour.

    The running sum has one row per hour to go through, however many tables there are.
    """
    hours = control.filter(_done() & F.col("completed_at").isNotNull()).groupBy(_hour().alias("hour"))
    total = F.sum("n").over(Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0))
    return hours.agg(F.count("*").alias("n")).select("hour", total.alias("cumulative_done"))


# --- breakdowns ---------------------------------------------------------------


def breakdown(df: DataFrame, dims: Sequence[str], **measures: Column) -> DataFrame:
    """Any measures by any columns; counts rows if no measure is named."""
    wanted = measures or {"n": F.count("*")}
    return df.groupBy(*dims).agg(*[m.alias(name) for name, m in wanted.items()])


CONTROL_DIMENSIONS = [
    "status", "batch_id", "clone_type", "workload_class", "attempt_number", "validation_status", "row_count_status",
]


def control_breakdowns(control: DataFrame, dims: Sequence[str] = tuple(CONTROL_DIMENSIONS)) -> DataFrame:
    """Tables, GiB and mean duration by each of the dimensions, from one scan."""
    df = control.withColumn(
        "row_count_status", M.row_count_status(F.col("source_row_count"), F.col("target_row_count"))
    )
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims]
    exploded = df.select("size_in_bytes", "duration_seconds", F.explode(F.array(*pairs)).alias("d"))
    return exploded.groupBy("d.dimension", "d.value").agg(
        F.count("*").alias("tables"), _gb().alias("gb"), F.avg("duration_seconds").alias("avg_duration_s")
    )


def failure_codes(control: DataFrame) -> DataFrame:
    code = F.coalesce("error_code", F.lit("(none)")).alias("error_code")
    return control.filter(_failed()).groupBy(code).agg(F.count("*").alias("n"))


def daily_by_status(history: DataFrame, time_col: str) -> DataFrame:
    """Rows of a history table by day and status."""
    status = F.coalesce("status", F.lit("(unknown)")).alias("status")
    return history.groupBy(F.to_date(time_col).alias("day"), status).agg(F.count("*").alias("n"))


def chunk_fan_out(control: DataFrame) -> DataFrame:
    return (
        control.filter(F.col("chunk_id").isNotNull())
        .groupBy("batch_id", "chunk_id")
        .agg(
            F.count("*").alias("tables"),
            F.round(_gb(), 2).alias("gb"),
            F.sum("size_in_bytes").alias("total_bytes"),
            _n(_done()).alias("done"),
        )
    )


RUN_COUNTERS = {
    "queued": "QUEUED",
    "in_progress": "IN_PROGRESS",
    "assigned": "ASSIGNED",
    "completed": "COMPLETED",
    "validated": "VALIDATED",
    "failed": "FAILED",
    "failed_permanent": "FAILED_PERMANENT",
    "validation_failed": "VALIDATION_FAILED",
    "retry_pending": "RETRY_PENDING",
    "skipped": "SKIPPED",
    "po_blocked": "PO_BLOCKED",
}


def run_metrics(control: DataFrame, batch_id: str) -> DataFrame:
    """Counters of a batch by state, one row."""
    mine = of_batch(control, batch_id)
    return mine.agg(
        F.count("*").alias("total"),
        *[_n(F.col("status") == s).alias(name) for name, s in RUN_COUNTERS.items()],
        F.coalesce(F.sum("size_in_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(F.when(_done(), F.col("size_in_bytes"))), F.lit(0)).alias("bytes_done"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("total_duration_s"),
    )


def batch_summary(control: DataFrame, batch_id: str) -> DataFrame:
    return of_batch(control, batch_id).groupBy("chunk_id", "status").agg(
        F.count("*").alias("tables"),
        F.round(_gb(), 2).alias("total_gb"),
        F.avg("duration_seconds").alias("avg_duration_s"),
    )


def workload_distribution(control: DataFrame) -> DataFrame:
    return control.groupBy("workload_class").agg(F.count("*").alias("n"), _gb().alias("total_gb"))


def size_histogram(control: DataFrame, low_gb: float, high_gb: float, buckets: int) -> DataFrame:
    """Tables by size, in equal steps between two sizes; below and above have a bucket each."""
    gb = M.gib(F.col("size_in_bytes"))
    bucket = F.width_bucket(gb, F.lit(low_gb), F.lit(high_gb), F.lit(buckets)).alias("bucket")
    return control.filter(F.col("size_in_bytes").isNotNull()).groupBy(bucket).agg(F.count("*").alias("tables"))


def exclusions_by_type(log: DataFrame) -> DataFrame:
    return log.groupBy("exclusion_type").agg(F.count("source_table").alias("n"))


def chunk_outcomes(attempts: DataFrame, control: DataFrame) -> DataFrame:
    """Tables done and failed per chunk, by the last attempt on each; of two with one number a success counts.

    Number and outcome go into one long, whose maximum a hash aggregate can keep.
    """
    rank = F.col("attempt_number").cast("bigint") * 2 + (F.col("status") == "SUCCESS").cast("bigint")
    last = attempts.groupBy("migration_id").agg((F.max(rank) % 2 == 1).alias("succeeded"))
    rows = last.join(control.select("migration_id", "batch_id", "chunk_id"), "migration_id")
    return rows.groupBy("batch_id", "chunk_id").agg(
        F.count("*").alias("dispatched"),
        _n(F.col("succeeded")).alias("completed_tables"),
        _n(~F.col("succeeded")).alias("failed_tables"),
    )


def outcome_totals(chunks: DataFrame) -> DataFrame:
    """Totals over ``chunk_outcomes``, one row; a chunk is complete if no table of it failed."""
    return chunks.agg(
        F.sum("dispatched").alias("dispatched"),
        F.sum("completed_tables").alias("completed_tables"),
        F.sum("failed_tables").alias("failed_tables"),
        _n(F.col("failed_tables") == 0).alias("completed_chunks"),
        _n(F.col("failed_tables") > 0).alias("failed_chunks"),
    )


# --- filters ------------------------------------------------------------------


def of_batch(df: DataFrame, batch_id: str = "") -> DataFrame:
    """Rows of one batch, all of them if none is named; on stored tables it prunes partitions."""
    return df.filter(F.col("batch_id") == batch_id) if batch_id else df


def queued(control: DataFrame, batch_id: str = "") -> DataFrame:
    return of_batch(control, batch_id).filter(F.col("status") == "QUEUED")


def of_chunk(control: DataFrame, batch_id: str, chunk_id: int) -> DataFrame:
    mine = (F.col("chunk_id") == chunk_id) & F.col("status").isin(S.OPEN)
    return of_batch(control, batch_id).filter(mine)


def in_flight(control: DataFrame, batch_id: str = "") -> DataFrame:
    return of_batch(control, batch_id).filter(F.col("status").isin(S.ACTIVE))


def to_validate(control: DataFrame, batch_id: str = "") -> DataFrame:
    fresh = ~F.coalesce(F.col("validation_status") == "VALIDATED", F.lit(False))
    return of_batch(control, batch_id).filter((F.col("status") == "COMPLETED") & fresh)


def retryable(control: DataFrame, batch_id: str = "") -> DataFrame:
    some_left = F.col("attempt_number") < F.col("max_attempts")
    return of_batch(control, batch_id).filter(F.col("status").isin(S.RETRYABLE) & some_left)


def open_chunks(control: DataFrame, batch_id: str = "") -> DataFrame:
    """Chunks that still have work to do."""
    work = of_batch(control, batch_id).filter(F.col("status").isin(S.OPEN) & (F.coalesce("chunk_id", F.lit(0)) > 0))
    return work.select("batch_id", "chunk_id").distinct()


def failed_rows(control: DataFrame) -> DataFrame:
    """Failed tables with what is known about why."""
    return control.filter(_failed()).select(
        *S.SOURCE_NAME, "attempt_number", "max_attempts", "error_code", "error_message", "updated_at"
    )


def with_row_count_status(control: DataFrame) -> DataFrame:
    s, t = F.col("source_row_count"), F.col("target_row_count")
    return control.withColumn("row_count_status", M.row_count_status(s, t))


# --- lists --------------------------------------------------------------------


def work_queue(control: DataFrame, limit: int = 500, batch_id: str = "") -> DataFrame:
    """Next tables to copy: by chunk, then weight, then size."""
    return (
        queued(control, batch_id)
        .orderBy(
            F.col("chunk_id").asc_nulls_first(),
            F.col("workload_weight").desc_nulls_last(),
            F.col("size_in_bytes").desc_nulls_last(),
            "migration_id",
        )
        .limit(limit)
    )


def chunk_queue(control: DataFrame, batch_id: str, chunk_id: int) -> DataFrame:
    return of_chunk(control, batch_id, chunk_id).orderBy(F.col("workload_weight").desc_nulls_last(), "migration_id")


def longest_copies(control: DataFrame, limit: int = 50) -> DataFrame:
    return (
        control.filter(F.col("duration_seconds").isNotNull())
        .orderBy(F.desc("duration_seconds"), "migration_id")
        .limit(limit)
        .select(
            "migration_id", "source_schema", "source_table", "target_schema", "target_table",
            F.round(M.gib(F.col("size_in_bytes")), 2).alias("size_gb"), "duration_seconds", "batch_id", "status",
        )
    )


def latest_failures(control: DataFrame, limit: int = 500) -> DataFrame:
    return (
        control.filter(_failed())
        .orderBy(F.col("updated_at").desc_nulls_last(), "migration_id")
        .limit(limit)
        .select(
            *S.SOURCE_NAME, "status", "error_code", "error_message", "attempt_number", "max_attempts",
            "batch_id", "updated_at",
        )
    )


def latest_mismatches(control: DataFrame, limit: int = 500) -> DataFrame:
    return (
        control.filter(F.col("source_row_count") != F.col("target_row_count"))
        .orderBy(F.col("updated_at").desc_nulls_last(), "migration_id")
        .limit(limit)
        .select(
            "source_schema", "source_table", "target_schema", "target_table", "source_version", "target_version",
            "source_row_count", "target_row_count", "validation_status", "updated_at",
        )
    )


def latest_exclusions(log: DataFrame, limit: int = 1000) -> DataFrame:
    return log.orderBy(F.col("excluded_at").desc_nulls_last(), *S.SOURCE_NAME).limit(limit)


def batch_review(control: DataFrame, batch_id: str) -> DataFrame:
    """All tables of a batch in the order an operator reads them."""
    return (
        of_batch(control, batch_id)
        .orderBy(F.col("chunk_id").asc_nulls_first(), "source_schema", "source_table")
        .select(*S.SOURCE_NAME, *S.TARGET_NAME, "status", "chunk_id", M.gib(F.col("size_in_bytes")).alias("size_gb"))
    )


# --- attempts and validations -------------------------------------------------


def attempts_of(attempts: DataFrame, control: DataFrame, source_table: str | None = None) -> DataFrame:
    """Attempts on the control rows, or on those of one table."""
    rows = control if source_table is None else control.filter(F.col("source_table") == source_table)
    return attempts.join(rows.select("migration_id", "source_table"), "migration_id")


def orphan_attempts(attempts: DataFrame, control: DataFrame) -> DataFrame:
    """Attempts whose control row is gone."""
    return attempts.join(control.select("migration_id"), "migration_id", "left_anti")


def latest_validations(history: DataFrame) -> DataFrame:
    """Last validation of each table; an aggregate, so a table validated very often is no burden."""
    rest = [c for c in history.columns if c != "migration_id"]
    newest = F.max_by(F.struct(*rest), F.struct("validated_at", *[c for c in ("validation_id",) if c in rest]))
    return history.groupBy("migration_id").agg(newest.alias("v")).select("migration_id", "v.*").withColumn(
        "row_count_status",
        M.row_count_status_by_source(F.col("source_row_count"), F.col("target_row_count")),
    )


def full_validation_history(history: DataFrame) -> DataFrame:
    """Every validation, the newest first."""
    return history.orderBy(F.col("validated_at").desc(), "migration_id")


# --- copy audit and request queue ---------------------------------------------


def latest_execution(audit: DataFrame) -> DataFrame:
    """The execution that ran last, one row."""
    return audit.agg(F.max_by("execution_id", F.struct("run_timestamp", "execution_id")).alias("execution_id"))


def execution_results(audit: DataFrame, execution_id: str) -> DataFrame:
    return audit.filter(F.col("execution_id") == execution_id)


def execution_summary(audit: DataFrame) -> DataFrame:
    """Totals of each execution."""
    return audit.groupBy("execution_id").agg(
        F.count("*").alias("tables_attempted"),
        _n(F.col("status") == "SUCCESS").alias("success"),
        _n(F.col("status") == "FAILED").alias("failed"),
        _n(F.col("validation_status") == "PASS").alias("val_pass"),
        _n(F.col("validation_status") == "FAIL").alias("val_fail"),
        F.round(M.gib(F.sum("size_bytes")), 3).alias("total_gb"),
        F.sum("duration_seconds").alias("total_seconds"),
        F.sum("records_cloned").alias("total_records"),
        F.min("start_time").alias("started_at"),
        F.max("end_time").alias("completed_at"),
    )


def daily_executions(audit: DataFrame) -> DataFrame:
    return audit.groupBy(F.to_date("run_timestamp").alias("run_date"), "execution_id").agg(
        F.count("*").alias("total_tables"),
        (F.sum("size_bytes").cast("double") / 1e9).alias("total_gb"),
        _n(F.col("status") == "FAILED").alias("failures"),
    )


def by_cluster(audit: DataFrame, execution_id: str | None = None) -> DataFrame:
    rows = audit if execution_id is None else execution_results(audit, execution_id)
    return rows.groupBy("cluster_id").agg(
        F.count("*").alias("tables_assigned"),
        _n(F.col("status") == "SUCCESS").alias("done"),
        _n(F.col("status") == "FAILED").alias("failed"),
        F.min("start_time").alias("started_at"),
        F.max("end_time").alias("last_update"),
    )


def live_progress(audit: DataFrame, execution_id: str | None = None) -> DataFrame:
    rows = audit if execution_id is None else execution_results(audit, execution_id)
    return rows.groupBy("status").agg(
        F.count("*").alias("table_count"),
        F.sum("records_cloned").alias("total_records"),
        (F.sum("size_bytes").cast("double") / 1e9).alias("total_gb"),
        F.round(F.avg("duration_seconds") / 60.0, 1).alias("avg_duration_min"),
    )


def request_queue(requests: DataFrame) -> DataFrame:
    """Requests by priority and state, with the oldest of each."""
    return requests.groupBy("priority", "status").agg(
        F.count("*").alias("request_count"), F.min("requested_at").alias("oldest_request")
    )


def requests_in_flight(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("status") == "IN_PROGRESS").select(
        "onboarding_id", "request_name", "requested_by", "execution_id", "requested_at"
    )


def due_requests(requests: DataFrame, now: Column) -> DataFrame:
    """Pending requests in the order they run; those planned for later wait."""
    due = (F.col("status") == "PENDING") & F.coalesce(F.col("scheduled_for") <= now, F.lit(True))
    return requests.filter(due).orderBy("priority", "requested_at", "onboarding_id")


def request_groups(requests: DataFrame, now: Column) -> DataFrame:
    """Due requests by what they ask for; each group runs together."""
    due = (F.col("status") == "PENDING") & F.coalesce(F.col("scheduled_for") <= now, F.lit(True))
    return requests.filter(due).groupBy("scope_mode", "clone_mode").agg(
        F.count("*").alias("requests"), F.min("priority").alias("top_priority")
    )


def failed_requests(requests: DataFrame, audit: DataFrame) -> DataFrame:
    """Failed requests with the failed copies of their execution.

    Executions are few and have many rows on either side, so each side is filtered and stripped
    before the join, and Spark splits the executions that turn out large.
    """
    r = requests.filter(F.col("status") == "FAILED").select(
        "onboarding_id", "request_name", "requested_by", "execution_id", "requested_at"
    )
    a = audit.filter(F.col("status") == "FAILED").select("execution_id", "table_name", "error_message")
    return r.join(a, "execution_id")
