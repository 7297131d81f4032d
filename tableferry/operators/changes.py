"""Changes to control rows, as frames in and frames out.

Every change is one join, or none where the rows to change are told by their own columns, and a
CASE per column under a guard on the state a row is in.  Rows outside the guard come out as they
went in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import measures as M

Assignments = Mapping[str, Column]



def null() -> Column:
    return F.lit(None)


def update_where(current: DataFrame, guard: Column, assign: Assignments) -> DataFrame:
    """Set columns of the rows the guard holds for; no join, no shuffle."""
    hit = F.coalesce(guard, F.lit(False))
    types = {f.name: f.dataType for f in current.schema.fields}
    return current.select(
        *[
            F.when(hit, assign[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in assign else F.col(c)
            for c in current.columns
        ]
    )


def update_from(
    current: DataFrame,
    changes: DataFrame,
    guard: Column,
    assign: Assignments,
    on: Sequence[str] = ("migration_id",),
) -> DataFrame:
    """Set columns from change rows, at most one per key; change columns are named ``s_<name>``."""
    named = changes.select(*on, *[F.col(c).alias(f"s_{c}") for c in changes.columns if c not in on])
    joined = current.join(named.withColumn("_hit", F.lit(True)), list(on), "left")
    known = {c: v for c, v in assign.items() if c in current.columns}
    return update_where(joined, F.col("_hit") & guard, known).select(*current.columns)


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    assign: Assignments,
    insert: Assignments,
    on: Sequence[str] = tuple(S.IDENTITY),
) -> DataFrame:
    """Update the rows that the incoming ones meet, add the others; incoming columns are ``s_<name>``."""
    named = incoming.select(*on, *[F.col(c).alias(f"s_{c}") for c in incoming.columns if c not in on])
    left = current.withColumn("_old", F.lit(True))
    joined = left.join(named.withColumn("_new", F.lit(True)), list(on), "full_outer")
    types = {f.name: f.dataType for f in current.schema.fields}
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    added = F.col("_old").isNull()

    def value(c: str) -> Column:
        if c in on:
            return F.col(c)
        out = F.when(added, insert.get(c, null()).cast(types[c]))
        if c in assign:
            out = out.when(both, assign[c].cast(types[c]))
        return out.otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in current.columns])


# --- onboarding ---------------------------------------------------------------

_FRESH = ["started_at", "completed_at", "failed_at", "validation_status", "source_row_count", "target_row_count"]
_MAPPED = ["run_id", *S.TARGET_NAME]


def _from(incoming: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(f"s_{c}") for c in columns if c in incoming.columns}


def _onboard(current: DataFrame, incoming: DataFrame, status: str, now: Column, assign: dict, insert: dict) -> DataFrame:
    base = {"status": F.lit(status), "updated_at": now}
    created = {**_from(incoming, incoming.columns), **base, "created_at": now, **insert}
    have = current.columns
    keep = lambda d: {c: v for c, v in d.items() if c in have}
    return upsert(current, incoming, keep({**base, **assign}), keep(created))


def upsert_queued(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Queue tables: a row that is there is reset to a fresh start, and takes the new mapping."""
    measured = ["source_path", "size_in_bytes", "size_gb", "workload_class", "workload_weight",
                "source_num_files", "source_version", "max_attempts"]
    assign = {
        **_from(incoming, _MAPPED + measured),
        **{c: null() for c in _FRESH},
        "error_code": null(),
        "error_message": null(),
        "attempt_number": F.lit(0),
        "onboarded_at": now,
        "queued_at": now,
    }
    insert = {"attempt_number": F.lit(0), "discovered_at": now, "onboarded_at": now, "queued_at": now}
    return _onboard(current, incoming, "QUEUED", now, assign, insert)


def upsert_target_missing(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Enlist tables whose target is not there: SKIPPED, and nothing left of an earlier run."""
    error = {
        "error_code": F.lit("TARGET_NOT_PRECREATED"),
        "error_message": M.capped(F.col("s_error_message"), S.ERROR_CHARS),
    }
    assign = {**_from(incoming, S.TARGET_NAME), **error, **{c: null() for c in _FRESH}}
    return _onboard(current, incoming, "SKIPPED", now, assign, {**error, "discovered_at": now})


def upsert_blocked(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Enlist tables the setting gate stopped, with its code and reason."""
    error = {
        "error_code": F.col("s_error_code"),
        "error_message": M.capped(F.col("s_error_message"), S.ERROR_CHARS),
    }
    assign = {**_from(incoming, _MAPPED), **error, **{c: null() for c in _FRESH}}
    return _onboard(current, incoming, "PO_BLOCKED", now, assign, {**error, "discovered_at": now})


def upsert_permanent_failure(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Enlist tables that cannot be copied at all; an earlier row only gets state and message."""
    error = {"error_message": M.capped(F.col("s_error_message"), S.ERROR_CHARS)}
    return _onboard(current, incoming, "FAILED_PERMANENT", now, error, error)


# --- planning and copying -----------------------------------------------------


def assign_chunks(current: DataFrame, assignments: DataFrame, now: Column) -> DataFrame:
    """Write planned batch and chunk to rows that are still queued."""
    return update_from(
        current,
        assignments,
        F.col("status") == "QUEUED",
        {"batch_id": F.col("s_batch_id"), "chunk_id": F.col("s_chunk_id"), "updated_at": now},
    )


def mark_assigned(current: DataFrame, batch_id: str, chunk_id: int | None, cluster_id: str, now: Column) -> DataFrame:
    """QUEUED to ASSIGNED, for one chunk or for all of a batch."""
    mine = (F.col("status") == "QUEUED") & (F.col("batch_id") == batch_id)
    if chunk_id is not None:
        mine = mine & (F.col("chunk_id") == chunk_id)
    return update_where(
        current, mine, {"status": F.lit("ASSIGNED"), "assigned_cluster_id": F.lit(cluster_id), "updated_at": now}
    )


def mark_in_progress(current: DataFrame, starting: DataFrame, now: Column, from_worker: bool = False) -> DataFrame:
    """To IN_PROGRESS with one attempt more; a worker may also take up a row it left in progress."""
    states = S.OPEN if from_worker else ["ASSIGNED", "QUEUED"]
    return update_from(
        current,
        starting.select("migration_id"),
        F.col("status").isin(states),
        {
            "status": F.lit("IN_PROGRESS"),
            "attempt_number": F.coalesce("attempt_number", F.lit(0)) + 1,
            "started_at": now,
            "updated_at": now,
        },
    )


def mark_completed(current: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    """IN_PROGRESS to COMPLETED with the copy's numbers; an unknown source version keeps the old one."""
    return update_from(
        current,
        finished,
        F.col("status") == "IN_PROGRESS",
        {
            "status": F.lit("COMPLETED"),
            "completed_at": now,
            "duration_seconds": F.col("s_duration_seconds"),
            "target_num_files": F.col("s_target_num_files"),
            "target_version": F.col("s_target_version"),
            "source_version": F.coalesce("s_source_version", "source_version"),
            "error_code": null(),
            "error_message": null(),
            "updated_at": now,
        },
    )


def mark_failed(current: DataFrame, failed: DataFrame, now: Column) -> DataFrame:
    """IN_PROGRESS to the failure state that the code and the attempts left ask for."""
    code = F.coalesce("s_error_code", F.lit("CLONE_FAILED"))
    return update_from(
        current,
        failed,
        F.col("status") == "IN_PROGRESS",
        {
            "status": M.failure_status(code, F.col("attempt_number"), F.coalesce("max_attempts", F.lit(3))),
            "failed_at": now,
            "duration_seconds": F.coalesce("s_duration_seconds", F.lit(0)),
            "error_code": M.capped(code, S.CODE_CHARS),
            "error_message": M.capped(F.col("s_error_message"), S.ERROR_CHARS),
            "updated_at": now,
        },
    )


def mark_permanent_failure(current: DataFrame, given_up: DataFrame, now: Column) -> DataFrame:
    """To FAILED_PERMANENT by id, whatever the state."""
    return update_from(
        current,
        given_up,
        F.lit(True),
        {
            "status": F.lit("FAILED_PERMANENT"),
            "error_message": M.capped(F.col("s_reason"), S.ERROR_CHARS),
            "updated_at": now,
        },
    )


def mark_chunk_lost(current: DataFrame, batch_id: str, chunk_id: int, error: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Book a chunk whose job never started: each open table failed once.  Rows, and their attempts."""
    mine = (F.col("batch_id") == batch_id) & (F.col("chunk_id") == chunk_id) & F.col("status").isin(S.OPEN)
    attempt = F.coalesce("attempt_number", F.lit(0)) + 1
    text = F.lit(error[: S.ERROR_CHARS])
    rows = update_where(
        current,
        mine,
        {
            "status": M.failure_status(F.lit("SUBMIT_FAILED"), attempt, F.coalesce("max_attempts", F.lit(3))),
            "attempt_number": attempt,
            "started_at": F.when(F.col("status") != "IN_PROGRESS", now).otherwise(F.col("started_at")),
            "failed_at": now,
            "duration_seconds": F.lit(0),
            "error_code": F.lit("SUBMIT_FAILED"),
            "error_message": text,
            "updated_at": now,
        },
    )
    attempts = current.filter(mine).select(
        "migration_id",
        attempt.cast("int").alias("attempt_number"),
        F.lit("").alias("cluster_id"),
        F.lit("FAILED").alias("status"),
        F.lit("SUBMIT_FAILED").alias("error_code"),
        text.alias("error_message"),
        now.alias("started_at"),
        now.alias("completed_at"),
        now.alias("created_at"),
    )
    return rows, attempts


# --- validation ---------------------------------------------------------------


def mark_validated(current: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """COMPLETED to the verdict; a count that was not taken keeps the one there is."""
    return update_from(
        current,
        outcomes,
        F.col("status") == "COMPLETED",
        {
            "status": F.col("s_status"),
            "validation_status": F.col("s_status"),
            "validation_message": M.capped(F.col("s_message"), S.MESSAGE_CHARS),
            "source_row_count": F.coalesce("s_source_row_count", "source_row_count"),
            "target_row_count": F.coalesce("s_target_row_count", "target_row_count"),
            "updated_at": now,
        },
    )


# --- retry --------------------------------------------------------------------


def requeue(current: DataFrame, eligible: DataFrame, now: Column, count_attempt: bool = False) -> DataFrame:
    """Back to QUEUED.  The attempt is counted when it starts, unless ``count_attempt`` has it counted here as well."""
    attempt = F.coalesce("attempt_number", F.lit(0)) + 1 if count_attempt else F.col("attempt_number")
    return update_from(
        current,
        eligible.select("migration_id"),
        F.col("status").isin(S.RETRYABLE),
        {"status": F.lit("QUEUED"), "attempt_number": attempt, "queued_at": now, "updated_at": now},
    )


def reset_permanent_failures(current: DataFrame, now: Column, batch_id: str = "") -> DataFrame:
    """Opt-in: give permanently failed rows a new set of attempts."""
    mine = F.col("status") == "FAILED_PERMANENT"
    if batch_id:
        mine = mine & (F.col("batch_id") == batch_id)
    return update_where(
        current,
        mine,
        {
            "status": F.lit("RETRY_PENDING"),
            "attempt_number": F.lit(0),
            "error_code": null(),
            "error_message": F.lit("Reset from FAILED_PERMANENT by retry_permanent=true"),
            "updated_at": now,
        },
    )


def is_stale(now: Column, minutes: int = 120, unstarted_at_once: bool = False) -> Column:
    """In flight for more than so many minutes since the start.

    Where no start is known the last update counts, or, with ``unstarted_at_once``, the row is stale as it is.
    """
    since = F.col("started_at") if unstarted_at_once else F.coalesce("started_at", "updated_at")
    old = F.coalesce(M.age_minutes(since, now) > minutes, F.lit(True))
    return F.col("status").isin(S.ACTIVE) & old


def reconcile_stale(
    current: DataFrame, now: Column, minutes: int = 120, batch_id: str = "", unstarted_at_once: bool = False
) -> DataFrame:
    """Rows stuck in flight go to RETRY_PENDING."""
    mine = is_stale(now, minutes, unstarted_at_once)
    if batch_id:
        mine = mine & (F.col("batch_id") == batch_id)
    return update_where(
        current,
        mine,
        {
            "status": F.lit("RETRY_PENDING"),
            "error_code": F.lit("STALE_EXECUTION"),
            "error_message": F.lit("Record was IN_PROGRESS/ASSIGNED beyond stale threshold; requeued"),
            "updated_at": now,
        },
    )


def retry_decision() -> Column:
    """What a retry pass does with a row: give up by code, give up by attempts, or requeue."""
    return (
        F.when(F.upper(F.coalesce("error_code", F.lit(""))).isin(S.RETRY_PERMANENT_CODES), "permanent_code")
        .when(F.coalesce("attempt_number", F.lit(0)) >= F.coalesce("max_attempts", F.lit(3)), "attempts_exhausted")
        .otherwise("requeued")
    )


def retry_pass(
    current: DataFrame, now: Column, batch_id: str = "", retry_permanent: bool = False, backoff_base: float = 0.0
) -> DataFrame:
    """One retry pass over the control rows, with ``retry_outcome`` and ``next_eligible_at`` added.

    All rows are decided in one projection: reset (if asked for), then permanent codes, then the
    attempt cap, then the queue.
    """
    rows = reset_permanent_failures(current, now, batch_id) if retry_permanent else current
    mine = F.col("status").isin(S.RETRYABLE)
    if batch_id:
        mine = mine & (F.col("batch_id") == batch_id)
    rows = rows.withColumn("retry_outcome", F.when(mine, retry_decision()))
    given_up = F.col("retry_outcome").isin("permanent_code", "attempts_exhausted")
    reason = F.when(
        F.col("retry_outcome") == "permanent_code",
        F.concat(F.lit("Non-retryable error: "), F.upper(F.col("error_code"))),
    ).otherwise(F.concat(F.lit("Max attempts ("), F.coalesce("max_attempts", F.lit(3)).cast("string"), F.lit(") exhausted")))
    wait = M.backoff_seconds(backoff_base, F.coalesce("attempt_number", F.lit(0)))
    again = F.col("retry_outcome") == "requeued"
    rows = rows.withColumn("next_eligible_at", F.when(again, F.timestamp_add("SECOND", wait.cast("int"), now)))
    rows = update_where(rows, given_up, {"status": F.lit("FAILED_PERMANENT"), "error_message": reason, "updated_at": now})
    return update_where(rows, again, {"status": F.lit("QUEUED"), "queued_at": now, "updated_at": now})


def retry_stats(passed: DataFrame) -> DataFrame:
    """Counters of a retry pass, one row."""
    n = lambda *o: F.count(F.when(F.col("retry_outcome").isin(*o), 1))
    return passed.agg(
        F.count("retry_outcome").alias("eligible"),
        n("requeued").alias("requeued"),
        n("permanent_code", "attempts_exhausted").alias("permanent"),
    )


# --- batches ------------------------------------------------------------------


def requeue_batch(current: DataFrame, batch_id: str) -> DataFrame:
    """Queue a whole batch again from scratch."""
    cleared = ["started_at", "completed_at", "failed_at", "error_code", "error_message",
               "validation_status", "validation_message"]
    return update_where(
        current,
        F.col("batch_id") == batch_id,
        {"status": F.lit("QUEUED"), "attempt_number": F.lit(0), **{c: null() for c in cleared}},
    )


def delete_batch(control: DataFrame, attempts: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Control rows without the batch, and the attempts that still have a control row."""
    left = control.filter(~F.col("batch_id").eqNullSafe(batch_id))
    return left, attempts.join(left.select("migration_id"), "migration_id", "left_semi")


def illegal_moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose state changed along no legal edge."""
    spark = before.sparkSession
    edges = spark.createDataFrame(S.TRANSITIONS, "old_status string, new_status string")
    moved = (
        before.select("migration_id", F.col("status").alias("old_status"))
        .join(after.select("migration_id", F.col("status").alias("new_status")), "migration_id")
        .filter(F.col("old_status") != F.col("new_status"))
    )
    # The edge list is a constant of twenty rows.
    return moved.join(F.broadcast(edges), ["old_status", "new_status"], "left_anti")


# --- request queue ------------------------------------------------------------


def claim_requests(requests: DataFrame, execution_id: str, now: Column) -> DataFrame:
    """Pending requests that are due go in progress under an execution id."""
    due = (F.col("status") == "PENDING") & F.coalesce(F.col("scheduled_for") <= now, F.lit(True))
    return update_where(requests, due, {"status": F.lit("IN_PROGRESS"), "execution_id": F.lit(execution_id)})


def complete_requests(requests: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """In-progress requests take the final state of their run."""
    return update_from(
        requests,
        outcomes,
        F.col("status") == "IN_PROGRESS",
        {"status": F.col("s_status"), "completed_at": now},
        on=["onboarding_id"],
    )


def requeue_requests(requests: DataFrame, which: Column, note: str) -> DataFrame:
    """Chosen requests are pending again, with a note of it."""
    noted = F.concat(F.coalesce("notes", F.lit("")), F.lit(f" | Re-queued: {note}"))
    return update_where(
        requests,
        which,
        {"status": F.lit("PENDING"), "execution_id": null(), "completed_at": null(), "notes": noted},
    )


def reset_stuck_requests(requests: DataFrame, today: Column, days: int = 1) -> DataFrame:
    """Requests in progress for more than so many days are pending again."""
    stuck = (F.col("status") == "IN_PROGRESS") & (F.date_diff(today, F.col("requested_at")) > days)
    return update_where(requests, stuck, {"status": F.lit("PENDING"), "execution_id": null()})
