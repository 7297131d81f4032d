"""Checks on copied tables: a record's verdict, and the report of a whole execution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import measures as M
from tableferry.functions import names as N


def _check(name: str, passed: Column, message: Column, source: Column | None = None, target: Column | None = None) -> Column:
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        message.alias("message"),
        text(source).alias("source_value"),
        text(target).alias("target_value"),
    )


def metric_check(name: str, source: Column, target: Column, tolerance_pct: float) -> Column:
    """Is a number of the target within so many percent of the source's?"""
    passed = M.within_tolerance(source, target, tolerance_pct)
    zero = F.concat(F.lit(f"{name} src=0 tgt="), target.cast("string"))
    pct = F.format_string("%.2f", F.bround(M.diff_pct(source, target), 2))
    text = F.concat(
        F.lit(f"{name} src="), F.format_number(source, 0), F.lit(" tgt="), F.format_number(target, 0),
        F.lit(" diff="), pct, F.lit(f"% (tol={tolerance_pct}%)"),
        F.when(passed, " ✓").otherwise(" ✗ EXCEEDS TOLERANCE"),
    )
    message = (
        F.when(source != 0, text)
        .when(passed, zero)
        .otherwise(F.concat(zero, F.lit(" (target non-zero when source is 0)")))
    )
    return _check(name, passed, message, source, target)


def files_check(source: Column, target: Column, tolerance_pct: float) -> Column:
    """File counts; two tables without a file are equal."""
    both_empty = _check("file_count", F.lit(True), F.lit("Both source and target have 0 files (empty table)"))
    return F.when((source == 0) & (target == 0), both_empty).otherwise(
        metric_check("file_count", source, target, tolerance_pct)
    )


def format_check(target_format: Column, expected: str) -> Column:
    shown = F.upper(F.coalesce(target_format, F.lit("")))
    passed = shown == expected.upper()
    text = F.concat(F.lit("Target format="), shown)
    return _check(
        "target_format",
        passed,
        F.when(passed, text).otherwise(F.concat(text, F.lit(f" (expected {expected.upper()})"))),
    )


def version_check(last_modified: Column) -> Column:
    """Does the target say when it was last changed?"""
    shown = F.coalesce(last_modified.cast("string"), F.lit("None"))
    return _check(
        "delta_version_present", last_modified.isNotNull(), F.concat(F.lit("Target lastCommitTimestamp="), shown)
    )


def row_count_check() -> Column:
    """Counts at the copied versions; an error in counting is neither a match nor a mismatch."""
    s, t = F.col("counted_source"), F.col("counted_target")
    show = lambda v: F.coalesce(v.cast("string"), F.lit("None"))
    pinned = F.col("source_version").isNotNull() | F.col("target_version").isNotNull()
    note = F.when(
        pinned,
        F.concat(F.lit(" (src@v"), show(F.col("source_version")), F.lit(", tgt@v"), show(F.col("target_version")), F.lit(")")),
    ).otherwise(" (unversioned — live count; no source_version/target_version on record)")
    text = F.concat(F.lit("row_count src="), F.format_number(s, 0), F.lit(" tgt="), F.format_number(t, 0), note)
    error = F.concat(F.lit("row_count ERROR: "), F.coalesce("count_error", F.lit("no count")))
    failed_to_count = s.isNull() | t.isNull()
    message = (
        F.when(failed_to_count, error).when(s == t, text).otherwise(F.concat(text, F.lit(" ✗ MISMATCH")))
    )
    return _check("row_count", F.coalesce(s == t, F.lit(False)), message, s, t)


def check_line(check: Column) -> Column:
    return F.concat(F.when(check["passed"], "✓").otherwise("✗"), F.lit(" "), check["check_name"], F.lit(": "), check["message"])


def _stats(stats: DataFrame, side: str) -> DataFrame:
    return stats.select(
        F.col("table_fqn").alias(f"{side}_fqn"),
        F.lit(True).alias(f"{side}_exists"),
        F.coalesce("size_in_bytes", F.lit(0)).alias(f"{side}_bytes"),
        F.coalesce("num_files", F.lit(0)).alias(f"{side}_files"),
        F.col("format").alias(f"{side}_format"),
        F.col("last_modified").alias(f"{side}_modified"),
    )


def with_stats(records: DataFrame, source_stats: DataFrame, target_stats: DataFrame) -> DataFrame:
    """Records with the statistics of their source and target; NULL where a table is missing."""
    out = records.withColumn("_src", N.fqn(*S.SOURCE_NAME)).withColumn("_tgt", N.fqn(*S.TARGET_NAME))
    out = out.join(_stats(source_stats, "src"), F.col("_src") == F.col("src_fqn"), "left")
    out = out.join(_stats(target_stats, "tgt"), F.col("_tgt") == F.col("tgt_fqn"), "left")
    return out.drop("_src", "_tgt", "src_fqn", "tgt_fqn")


def validate(
    records: DataFrame,
    source_stats: DataFrame,
    target_stats: DataFrame,
    counts: DataFrame | None = None,
    size_tolerance: float = S.SIZE_TOLERANCE_PCT,
    file_tolerance: float = S.FILE_TOLERANCE_PCT,
    expected_format: str = "parquet",
) -> DataFrame:
    """Verdict, message and checks of each copied record.

    A missing table fails at once; otherwise only row counts can fail a record, all other checks
    are told but advise.  ``counts`` has (migration_id, source_row_count, target_row_count) and,
    if counting can fail, ``count_error``; without it no count is checked.
    """
    df = with_stats(records, source_stats, target_stats)
    count_cols = ["source_row_count", "target_row_count", "count_error"]
    df = df.drop("source_row_count", "target_row_count")
    if counts is not None:
        if "count_error" not in counts.columns:
            counts = counts.withColumn("count_error", F.lit(None).cast("string"))
        taken = counts.select(
            "migration_id", *[F.col(c).alias(n) for c, n in zip(count_cols, ["counted_source", "counted_target", "count_error"])]
        )
        df = df.join(taken, "migration_id", "left")
    quoted = lambda cols: F.concat(F.lit("`"), F.concat_ws("`.`", *cols), F.lit("`"))
    checks = [
        _check("source_exists", F.lit(True), F.concat(F.lit("Source "), quoted(S.SOURCE_NAME), F.lit(" exists"))),
        _check("target_exists", F.lit(True), F.concat(F.lit("Target "), quoted(S.TARGET_NAME), F.lit(" exists"))),
        format_check(F.col("tgt_format"), expected_format),
        metric_check("size_bytes", F.col("src_bytes"), F.col("tgt_bytes"), size_tolerance),
        files_check(F.col("src_files"), F.col("tgt_files"), file_tolerance),
        version_check(F.col("tgt_modified")),
    ]
    none = F.lit(None)
    if counts is not None:
        checks.append(row_count_check())
    gone = (
        F.when(F.col("src_exists").isNull(), "SOURCE_MISSING: source table not found after clone")
        .when(F.col("tgt_exists").isNull(), "TARGET_MISSING: target table was not created")
    )
    df = df.withColumn("gone", gone).withColumn("checks", F.when(F.col("gone").isNull(), F.array(*checks)))
    there = F.col("gone").isNull()
    if counts is not None:
        s, t = F.col("counted_source"), F.col("counted_target")
        df = df.withColumns(
            {
                "row_count_checked": there,
                "source_row_count": F.when(there, s),
                "target_row_count": F.when(there, t),
                "row_count_matched": F.when(there, s == t),
            }
        )
        failed = ~there | ~F.coalesce(F.col("row_count_matched"), F.lit(False))
    else:
        df = df.withColumns(
            {
                "row_count_checked": F.lit(False),
                "source_row_count": none.cast("bigint"),
                "target_row_count": none.cast("bigint"),
                "row_count_matched": none.cast("boolean"),
            }
        )
        failed = ~there
    lines = F.array_join(F.transform("checks", check_line), " | ")
    return df.withColumns(
        {
            "status": F.when(failed, "VALIDATION_FAILED").otherwise("VALIDATED"),
            "message": F.coalesce("gone", lines),
        }
    ).drop("gone", "counted_source", "counted_target", "count_error")


def check_rows(validated: DataFrame) -> DataFrame:
    """One row per record and check."""
    return validated.select("migration_id", F.explode("checks").alias("c")).select("migration_id", "c.*")


def validation_totals(outcomes: DataFrame) -> DataFrame:
    """Counters of a validation pass, one row."""
    n = lambda cond: F.count(F.when(cond, 1))
    checked = F.col("row_count_checked")
    return outcomes.agg(
        n(F.col("status") == "VALIDATED").alias("passed"),
        n(F.col("status") != "VALIDATED").alias("failed"),
        n(checked).alias("row_count_checked"),
        n(checked & F.col("row_count_matched")).alias("row_count_matched"),
        n(checked & ~F.col("row_count_matched")).alias("row_count_mismatched"),
    )


# --- report over an execution -------------------------------------------------


def expected_tables(audit: DataFrame, execution_id: str) -> DataFrame:
    """Tables the execution copied with success, each once."""
    mine = (F.col("execution_id") == execution_id) & (F.col("status") == "SUCCESS")
    cols = ["table_name", "src_catalog", "src_schema", "tgt_catalog", "tgt_schema", "table_type", "status", "clone_mode"]
    return audit.filter(mine).select(*[c for c in cols if c in audit.columns]).distinct()


def type_preserved(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Is each table of the type it had?  Where that is not known, any type will do.

    ``expected`` and ``actual`` have (table_name, table_type).
    """
    joined = expected.join(actual.select("table_name", F.upper("table_type").alias("actual")), "table_name", "left")
    actual_type = F.coalesce("actual", F.lit("UNKNOWN"))
    want = F.col("table_type")
    return joined.select(
        F.lit("table_type_preserved").alias("check_name"),
        "table_name",
        ((actual_type == want) | (want == "UNKNOWN")).alias("passed"),
        F.concat(F.lit("expected="), want, F.lit(" actual="), actual_type).alias("detail"),
    )


def partitions_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """Same partition columns, in any order?  Both sides have (table_name, partition_columns)."""
    cols = lambda name: F.sort_array(F.coalesce(F.col(name), F.array().cast("array<string>")))
    s = source.select("table_name", cols("partition_columns").alias("src"))
    t = target.select("table_name", cols("partition_columns").alias("tgt"))
    show = lambda c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
    return s.join(t, "table_name", "left").select(
        F.lit("partition_columns_match").alias("check_name"),
        "table_name",
        F.coalesce(F.col("src") == F.col("tgt"), F.lit(False)).alias("passed"),
        F.concat(F.lit("src="), show("src"), F.lit(" tgt="), F.coalesce(show("tgt"), F.lit("none"))).alias("detail"),
    )


def audit_completeness(audit: DataFrame, execution_id: str) -> DataFrame:
    """Does the audit log know the execution?  Its rows by status in the text, one row."""
    by_status = audit.filter(F.col("execution_id") == execution_id).groupBy("status").agg(F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.concat("status", F.lit("="), F.col("n").cast("string"))))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return by_status.agg(total.alias("total"), parts.alias("parts")).select(
        F.lit("audit_log_completeness").alias("check_name"),
        F.lit(f"execution_id={execution_id}").alias("table_name"),
        (F.col("total") > 0).alias("passed"),
        F.concat(F.lit("total="), "total", F.lit(" "), F.array_join("parts", " | ")).alias("detail"),
    )


def without_audit_row(expected: DataFrame, audit: DataFrame, key: str = "table_name") -> DataFrame:
    """Expected tables that have no audit row at all."""
    return expected.join(audit.select(key), key, "left_anti")


def has_history(expected: DataFrame, ledger: DataFrame) -> DataFrame:
    """Is there a committed version of each table?  The latest operation in the text.

    ``expected`` has table_name, ``ledger`` (table_fqn, version, operation).
    """
    latest = ledger.groupBy(F.col("table_fqn").alias("table_name")).agg(F.max_by("operation", "version").alias("op"))
    return expected.select("table_name").join(latest, "table_name", "left").select(
        F.lit("delta_table_valid").alias("check_name"),
        "table_name",
        F.col("op").isNotNull().alias("passed"),
        F.concat(F.lit("latest_op="), F.coalesce("op", F.lit("n/a"))).alias("detail"),
    )


def pass_counts(report: DataFrame) -> DataFrame:
    """Checks by name and verdict."""
    return report.groupBy("check_name", "passed").agg(
        F.count("*").alias("check_count"), F.count(F.when(F.col("passed"), 1)).alias("passed_count")
    )


def acceptance(report: DataFrame) -> DataFrame:
    """Pass rate of each check against what sign-off asks for."""
    wanted = report.sparkSession.createDataFrame(S.ACCEPTANCE_THRESHOLDS, "check_name string, required_pct double")
    rates = report.groupBy("check_name").agg(
        F.count("*").alias("checks"), F.count(F.when(F.col("passed"), 1)).alias("passed_checks")
    )
    rate = F.col("passed_checks") * 100.0 / F.col("checks")
    # The thresholds are a constant of seven rows.
    return rates.join(F.broadcast(wanted), "check_name", "left").select(
        "check_name",
        "checks",
        "passed_checks",
        rate.cast("double").alias("pass_rate"),
        "required_pct",
        (rate >= F.coalesce("required_pct", F.lit(100.0))).alias("accepted"),
    )


def report_summary(report: DataFrame) -> DataFrame:
    """Counters of a report, one row."""
    passed = F.count(F.when(F.col("passed"), 1))
    total = F.count("*")
    return report.agg(
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        (total - passed).alias("failed_checks"),
        F.round(F.coalesce(M.percent(passed, total), F.lit(0.0)), 2).alias("pass_rate_pct"),
    )


def first_failures(report: DataFrame, n: int = 1) -> DataFrame:
    """The first checks that did not pass, by name and table."""
    return report.filter(~F.col("passed")).orderBy("check_name", "table_name", "detail").limit(n)


def raise_on_first_failure(report: DataFrame) -> None:
    """Fail fast: stop at the first check that did not pass."""
    for r in first_failures(report).collect():
        raise AssertionError(f"Check '{r['check_name']}' failed for table '{r['table_name']}': {r['detail']}")
