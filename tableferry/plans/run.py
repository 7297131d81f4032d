"""The steps of a migration, each over the stored tables: onboard, copy, validate, retry.

Every step reads the control rows of its batch, makes all changes in one plan, and writes the
batch back once.  One writer per batch at a time; batches never touch each other's rows or folders.
"""

from __future__ import annotations

import itertools
import re
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import measures as M
from tableferry.functions import names as N
from tableferry.operators import changes as C
from tableferry.operators import checks as K
from tableferry.operators import exclusion as E
from tableferry.operators import gate as G
from tableferry.operators import packing as P
from tableferry.operators import reconcile as Q
from tableferry.operators import telemetry as T
from tableferry.session import new_folder, settle
from tableferry.sources import listing as L
from tableferry.sources import stored_tables as ST
from tableferry.sources.snapshots import SnapshotStore, folders_of
from tableferry.sources.stored_tables import StoredTables

FOLDERS_PER_JOB = 2000


@dataclass(frozen=True)
class Run:
    """What a step is told about itself."""

    batch_id: str
    run_id: str = ""
    clone_type: str = "direct_adls"
    source_workspace: str = ""
    target_workspace: str = ""
    max_attempts: int = 3
    force: bool = False
    require_target: bool = False
    skip_stats: bool = False
    row_counts: bool = True
    retry_permanent: bool = False
    stale_minutes: int = 120
    chunk_capacity_gb: float = 50.0
    concurrent_chunks: int = 5
    packing_parts: int = 1
    threads: int = 4
    table_format: str = "parquet"

    def __post_init__(self):
        if not re.fullmatch(S.BATCH_ID, self.batch_id):
            raise ValueError("a batch id is letters, digits, dots, dashes and underscores: it names a folder")


def row_id(batch_id: str) -> Column:
    """Id of a control row, the same each time for one table in one batch."""
    h = F.md5(F.concat_ws("\x1f", F.lit(batch_id), *S.SOURCE_NAME))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def judged_selection(
    selection: DataFrame,
    control: DataFrame,
    settings: DataFrame,
    stats: DataFrame,
    target_listing: DataFrame,
    run: Run,
) -> DataFrame:
    """The selection with the outcome of the gates, and all columns a control row takes."""
    df = G.setting_gate(selection, settings)
    df = G.already_settled(df, control, run.batch_id)
    df = G.target_listed(df, target_listing)
    df = G.with_source_stats(df, stats)
    if run.skip_stats:
        unknown = ["source_path", "size_in_bytes", "source_num_files", "source_version"]
        df = df.withColumns({c: F.lit(None).cast(S.CONTROL[c].dataType) for c in unknown})
    size = F.col("size_in_bytes")
    target = N.fqn(*S.TARGET_NAME)
    missing = F.concat(F.lit("Target table "), target, F.lit(" does not exist yet in the target catalog."))
    return df.withColumns(
        {
            "outcome": G.onboarding_outcome(run.force, run.require_target, run.skip_stats, run.table_format),
            "migration_id": F.coalesce("existing_id", row_id(run.batch_id)),
            "run_id": F.lit(run.run_id),
            "clone_type": F.lit(run.clone_type),
            "source_workspace": F.lit(run.source_workspace),
            "target_workspace": F.lit(run.target_workspace),
            "batch_id": F.lit(run.batch_id),
            "size_gb": M.gib(size),
            "workload_class": M.workload_class(size),
            "workload_weight": M.workload_weight(size),
            "max_attempts": F.lit(run.max_attempts),
        }
    ).withColumns(
        {
            "error_code": F.when(F.col("outcome") == "PO_BLOCKED", F.col("gate_code")),
            "error_message": F.when(F.col("outcome") == "PO_BLOCKED", F.col("reason"))
            .when(F.col("outcome") == "SKIPPED", missing)
            .when(F.col("outcome") == "FAILED_PERMANENT", G.NOT_FOUND_TEXT),
        }
    )


_IDENTIFYING = ["migration_id", "run_id", "clone_type", "source_workspace", "target_workspace", *S.SOURCE_NAME,
                *S.TARGET_NAME, "batch_id"]
_MEASURED = ["source_path", "size_in_bytes", "size_gb", "workload_class", "workload_weight", "source_num_files",
             "source_version", "max_attempts"]


def onboarded(control: DataFrame, judged: DataFrame, now: Column) -> DataFrame:
    """Control rows after an onboarding pass: each outcome goes in by its own rule."""
    of = lambda outcome, cols: judged.filter(F.col("outcome") == outcome).select(*cols)
    error = ["error_code", "error_message"]
    control = C.upsert_queued(control, of("QUEUED", _IDENTIFYING + _MEASURED), now)
    control = C.upsert_target_missing(control, of("SKIPPED", _IDENTIFYING + error[1:]), now)
    control = C.upsert_blocked(control, of("PO_BLOCKED", _IDENTIFYING + error), now)
    return C.upsert_permanent_failure(control, of("FAILED_PERMANENT", _IDENTIFYING + error[1:]), now)


def planned(control: DataFrame, run: Run, now: Column) -> DataFrame:
    """Control rows with a chunk for every queued one."""
    queued = T.queued(control, run.batch_id)
    chunks = P.plan_chunks(queued, int(run.chunk_capacity_gb * S.GIB), run.concurrent_chunks, run.packing_parts)
    return C.assign_chunks(control, chunks, now)


def onboard(
    tables: StoredTables,
    selection: DataFrame,
    rules: DataFrame,
    settings: DataFrame,
    stats: DataFrame,
    target_listing: DataFrame,
    run: Run,
) -> DataFrame:
    """Exclude, gate, queue and pack a selection; log what was excluded.  Gives the counters.

    Clean tables are queued and planned before a blocked one fails the step: ask
    ``gate.raise_if_blocked`` afterwards.
    """
    now = F.current_timestamp()
    kept, excluded = E.apply_exclusions(selection, rules)
    control = tables.batch(run.batch_id)
    control = C.reconcile_stale(control, now, run.stale_minutes, run.batch_id)
    # Judged once and written: four upserts and the counters read it.
    judged = settle(judged_selection(kept, control, settings, stats, target_listing, run), "judged")
    rows = settle(onboarded(control, judged, now), "onboarded")
    tables.replace_batch(run.batch_id, planned(rows, run, now))
    tables.append("exclusion_log", ST.exclusion_rows(excluded, run.run_id, run.batch_id, now))
    return G.selection_stats(judged)


def dry_run(
    selection: DataFrame,
    control: DataFrame,
    settings: DataFrame,
    stats: DataFrame,
    target_listing: DataFrame,
    run: Run,
) -> DataFrame:
    """What a run would do with each table: mapping, verdict, size, class.  Writes nothing."""
    judged = judged_selection(selection, control, settings, stats, target_listing, run)
    return judged.select(
        *S.SOURCE_NAME, *S.TARGET_NAME, "outcome", "blocked", "gate_code", "source_path", "size_in_bytes", "workload_class"
    )


def blueprint(plan: DataFrame, execution_id: str, now: Column) -> DataFrame:
    """A dry run as rows to store: one JSON text per table."""
    return plan.select(
        F.lit(execution_id).alias("execution_id"),
        now.alias("generated_at"),
        F.to_json(F.struct(*plan.columns)).alias("blueprint_json"),
    )


def stored_plan(blueprints: DataFrame, execution_id: str) -> DataFrame:
    """The plan that was stored under an execution, with its types; the latest row of a table counts."""
    mine = blueprints.filter(F.col("execution_id") == execution_id)
    rows = mine.select("generated_at", F.from_json("blueprint_json", S.PLAN, {"mode": "FAILFAST"}).alias("p"))
    newest = rows.groupBy(*[F.col(f"p.{c}").alias(c) for c in S.SOURCE_NAME]).agg(F.max_by("p", "generated_at").alias("p"))
    return newest.select("p.*")


def plan_drift(plan: DataFrame, present: DataFrame) -> DataFrame:
    """What a stored plan says of each table against what a dry run says now.

    ``verdict``: SAME, CHANGED (with the columns that differ), NEW (not planned) or GONE (planned, no longer selected). With it come
    the planned and the present outcome.
    """
    others = [c for c in S.PLAN.names if c not in S.SOURCE_NAME]

    def side(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*[F.col(c).cast(S.PLAN[c].dataType).alias(c) for c in others])
        return df.select(*[F.col(c).alias(f"{name}_{c}") for c in S.SOURCE_NAME], values.alias(name))

    same_table = [F.col(f"was_{c}").eqNullSafe(F.col(f"is_{c}")) for c in S.SOURCE_NAME]
    both = side(plan, "was").join(side(present, "is"), same_table, "full")
    changed = F.filter(F.array(*[F.when(~F.col(f"was.{c}").eqNullSafe(F.col(f"is.{c}")), c) for c in others]), lambda c: c.isNotNull())
    verdict = F.when(F.col("was").isNull(), "NEW").when(F.col("is").isNull(), "GONE").when(F.size(changed) > 0, "CHANGED").otherwise("SAME")
    told = F.when(F.col("was").isNotNull() & F.col("is").isNotNull(), F.array_join(changed, ","))
    names = [F.coalesce(f"was_{c}", f"is_{c}").alias(c) for c in S.SOURCE_NAME]
    return both.select(*names, verdict.alias("verdict"), told.alias("changed"), F.col("was.outcome").alias("planned_outcome"), F.col("is.outcome").alias("present_outcome"))


Source = Callable[[Row], tuple[DataFrame, int | None, list[str]]]


def copy_chunk(
    tables: StoredTables, store: SnapshotStore, source_of: Source, run: Run, chunk_id: int, cluster_id: str = ""
) -> str:
    """Copy the open tables of one chunk, and book each result.  Gives the folder of the attempts.

    A chunk holds no more tables than its cap, so its rows fit the driver, which starts one write
    job per table, a few at a time; Spark spreads each of them. All that were written are measured and committed together, and
    only the chunk's own control rows are appended to the batch.
    """
    spark, now = tables.spark, F.current_timestamp()
    rows = tables.batch(run.batch_id).filter(F.col("chunk_id") == chunk_id)
    mine = settle(T.of_chunk(rows, run.batch_id, chunk_id), "chunk")
    rows = C.mark_assigned(rows, run.batch_id, chunk_id, cluster_id, now)
    tables.update_batch(run.batch_id, C.mark_in_progress(rows, mine, now, from_worker=True))

    def one(row: Row) -> tuple:
        target = ".".join(row[c] for c in S.TARGET_NAME)
        source = ".".join(row[c] for c in S.SOURCE_NAME)
        began = time.time()
        staged, error = None, None
        try:
            frame, version, partitions = source_of(row)
            staged = store.stage(frame, target, source, version, partitions)
        except Exception as e:  # noqa: BLE001 - any failure of one table is booked, the others go on
            error = f"{type(e).__name__}: {e}"
        return row["migration_id"], staged, error, int(time.time() - began)

    with ThreadPoolExecutor(run.threads) as pool:
        results = list(pool.map(one, _rows(mine)))
    committed = iter(store.commit([staged for _, staged, _, _ in results if staged]))
    booked = []
    for migration_id, staged, error, seconds in results:
        m = next(committed) if staged else None
        measures = (m["num_files"], m["size_in_bytes"], m["version"], m["source_version"]) if m else (None,) * 4
        booked.append((migration_id, "SUCCESS" if staged else "FAILED", error, seconds, *measures))
    outcome = spark.createDataFrame(
        booked,
        "migration_id string, status string, error_message string, duration_seconds bigint, "
        "target_num_files bigint, target_size_bytes bigint, target_version bigint, source_version bigint",
    )
    outcome = outcome.withColumn("error_code", F.when(F.col("status") == "FAILED", M.error_code(F.col("error_message"))))
    return _book(tables, mine, outcome, run, chunk_id, cluster_id)


def _rows(df: DataFrame) -> Iterable[Row]:
    return df.toLocalIterator()


def _book(tables: StoredTables, mine: DataFrame, outcome: DataFrame, run: Run, chunk_id: int, cluster_id: str) -> str:
    """Append a chunk's attempts and the new state of its rows; gives the folder of the attempts."""
    now = F.current_timestamp()
    rows = tables.batch(run.batch_id).filter(F.col("chunk_id") == chunk_id)
    done = outcome.filter(F.col("status") == "SUCCESS").drop("status", "error_message", "error_code")
    lost = outcome.filter(F.col("status") == "FAILED").select("migration_id", "error_code", "error_message", "duration_seconds")
    attempts = (
        outcome.join(mine.select("migration_id", "attempt_number", "size_in_bytes"), "migration_id")
        .join(rows.select("migration_id", "started_at"), "migration_id")
        .withColumn("attempt_number", F.coalesce("attempt_number", F.lit(0)) + 1)
        .withColumn("source_size_bytes", F.col("size_in_bytes"))
        .withColumns({"run_id": F.lit(run.run_id), "cluster_id": F.lit(cluster_id), "completed_at": now, "created_at": now})
    )
    folder = tables.append("attempts", ST.attempt_rows(attempts), run.batch_id)
    tables.update_batch(run.batch_id, C.mark_failed(C.mark_completed(rows, done, now), lost, now))
    return folder


def copy_batch(tables: StoredTables, store: SnapshotStore, source_of: Source, run: Run) -> DataFrame:
    """Copy all open chunks of a batch, one after the other; rows without a chunk are planned first.

    Gives the totals; ``failed_tables`` above zero means that the step failed.
    """
    now = F.current_timestamp()
    batch = settle(C.reconcile_stale(tables.batch(run.batch_id), now, run.stale_minutes, run.batch_id))
    if not T.queued(batch).filter(P.needs_planning(batch)).isEmpty():
        batch = planned(batch, run, now)
    tables.replace_batch(run.batch_id, batch)
    open_chunks = T.open_chunks(tables.batch(run.batch_id), run.batch_id).orderBy("chunk_id")
    folders = [copy_chunk(tables, store, source_of, run, chunk["chunk_id"]) for chunk in _rows(settle(open_chunks))]
    # What this call appended, read back at once.
    return T.outcome_totals(T.chunk_outcomes(tables.appended("attempts", folders), tables.batch(run.batch_id)))


def validate_batch(
    tables: StoredTables,
    source_stats: DataFrame,
    target_stats: DataFrame,
    run: Run,
    counts_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Judge the completed tables of a batch, write verdicts and history.  Gives the counters.

    ``counts_of`` takes the records and gives their row counts at the copied versions.
    """
    now = F.current_timestamp()
    batch = tables.batch(run.batch_id)
    records = T.to_validate(batch)
    counts = counts_of(records) if run.row_counts and counts_of else None
    verdicts = settle(K.validate(records, source_stats, target_stats, counts, expected_format=run.table_format).drop("checks"))
    changes = verdicts.select("migration_id", "status", "message", "source_row_count", "target_row_count")
    tables.replace_batch(run.batch_id, C.mark_validated(batch, changes, now))
    tables.append("validation_history", ST.validation_rows(verdicts, run.run_id, now))
    return K.validation_totals(verdicts)


def version_counts(records: DataFrame, source: SnapshotStore, target: SnapshotStore, open_source: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Row counts of each record's tables at the versions that were copied.

    Source tables that the ledger does not hold at all are counted as they are now, if ``open_source`` tells how to read a table
    by its name. A version that the ledger does not know gives no count, and says so; so does a table that cannot be read.
    """
    pinned = records.select(
        "migration_id", N.fqn(*S.SOURCE_NAME).alias("src"), N.fqn(*S.TARGET_NAME).alias("tgt"), "source_version", "target_version"
    )
    sides = settle(
        _folders(pinned, source.ledger(), "src", "source_version", "source_row_count").unionByName(
            _folders(pinned, target.ledger(), "tgt", "target_version", "target_row_count")
        )
    )
    folders = sides.select("path").filter(F.col("path").isNotNull()).distinct()
    counted = sides.join(_counted_folders(folders), "path", "left")
    unversioned = sides.filter(~F.col("versioned") & (F.col("side") == "source_row_count")).select("name").distinct()
    live = _live_counts(unversioned, open_source).withColumn("side", F.lit("source_row_count"))
    counted = counted.join(live, ["name", "side"], "left")
    rows = F.when(F.col("empty"), 0).otherwise(F.coalesce("row_count", "live_count"))
    # A side has a count if each of its folders has one.
    n, error = F.when(F.count(rows) == F.count("*"), F.sum(rows)).alias("n"), F.max("live_error").alias("live_error")
    whole = counted.groupBy("migration_id", "side").agg(n, error)
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("n"))).alias(side)
    out = whole.groupBy("migration_id").agg(of("source_row_count"), of("target_row_count"), error)
    unknown = F.col("source_row_count").isNull() | F.col("target_row_count").isNull()
    return out.withColumn("count_error", F.when(unknown, F.coalesce("live_error", F.lit("version not in the ledger")))).drop("live_error")


LIVE_COUNTS_PER_JOB = 100


def _live_counts(names: DataFrame, open_table: Callable[[str], DataFrame] | None) -> DataFrame:
    """(name, live_count, live_error) of tables as they are now: tagged counts of a hundred tables a job, which read no columns."""
    spark, schema = names.sparkSession, "name string, live_count bigint, live_error string"
    out = new_folder(spark, "live-counts")
    spark.createDataFrame([], schema).write.parquet(out)
    for some in itertools.batched((r["name"] for r in _rows(names)) if open_table else (), LIVE_COUNTS_PER_JOB):
        frames, errors = {}, []
        for name in some:
            try:
                frames[name] = open_table(name)
            except Exception as e:  # noqa: BLE001 - a table that cannot be opened has no count, the others do
                errors.append((name, None, f"{type(e).__name__}: {e}"[: S.ERROR_CHARS]))
        if frames:
            counts = Q.row_counts(frames).select(F.col("table_name").alias("name"), F.col("row_count").alias("live_count"))
            counts.withColumn("live_error", F.lit(None).cast("string")).write.mode("append").parquet(out)
        if errors:
            spark.createDataFrame(errors, schema).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _counted_folders(folders: DataFrame) -> DataFrame:
    """Row counts of all folders, a job per few thousand: no more paths than that are held at once."""
    spark = folders.sparkSession
    out = new_folder(spark, "counts")
    spark.createDataFrame([], "path string, row_count bigint").write.parquet(out)
    for some in itertools.batched((r["path"] for r in _rows(folders)), FOLDERS_PER_JOB):
        L.folder_row_counts(spark, some).write.mode("append").parquet(out)
    return spark.read.schema("path string, row_count bigint").parquet(out)


def _folders(pinned: DataFrame, ledger: DataFrame, name: str, version: str, side: str) -> DataFrame:
    """Folders of each record's version, several if it was copied by parts; a record without one means the current version.

    A version without any part holds no rows; one that the ledger does not know has a NULL folder.
    """
    rows = ledger.select(F.col("table_fqn").alias(name), F.col("version").alias("v"), folders_of().alias("paths"))
    current = rows.groupBy(name).agg(F.max("v").alias("newest"))
    asked = pinned.join(current, name, "left").withColumn("v", F.coalesce(version, "newest"))
    found = asked.join(rows, [name, "v"], "left")
    empty, versioned = (F.size("paths") == 0).alias("empty"), F.col("newest").isNotNull().alias("versioned")
    return found.select("migration_id", F.lit(side).alias("side"), F.col(name).alias("name"), versioned, empty, F.explode_outer("paths").alias("path"))


def retry_batch(tables: StoredTables, run: Run) -> DataFrame:
    """One retry pass over a batch.  Gives the counters; copy the batch again afterwards."""
    now = F.current_timestamp()
    batch = tables.batch(run.batch_id)
    passed = settle(C.retry_pass(batch, now, run.batch_id, run.retry_permanent))
    tables.replace_batch(run.batch_id, passed)
    return C.retry_stats(passed)


def delete_batch(tables: StoredTables, batch_id: str) -> None:
    """Remove a batch and the attempts it leaves behind; other batches may be written meanwhile."""
    tables.delete_batch(batch_id)
