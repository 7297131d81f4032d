"""Column expressions for sizes, classes, times, codes and outcome texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableferry import schemas as S


def gib(num_bytes: Column) -> Column:
    """Bytes to GiB; NULL stays NULL (never measured)."""
    return num_bytes.cast("double") / F.lit(float(S.GIB))


def workload_class(num_bytes: Column) -> Column:
    out = F.when(num_bytes.isNull(), S.UNMEASURED_CLASS[0])
    for name, upper, _ in S.WORKLOAD_CLASSES:
        out = out.otherwise(name) if upper is None else out.when(num_bytes < upper, name)
    return out


def workload_weight(num_bytes: Column) -> Column:
    out = F.when(num_bytes.isNull(), S.UNMEASURED_CLASS[1])
    for _, upper, weight in S.WORKLOAD_CLASSES:
        out = out.otherwise(weight) if upper is None else out.when(num_bytes < upper, weight)
    return out.cast("int")


def row_count_status(source: Column, target: Column) -> Column:
    return (
        F.when(source.isNull() | target.isNull(), "NOT CHECKED")
        .when(source == target, "MATCH")
        .otherwise("MISMATCH")
    )


def row_count_status_by_source(source: Column, target: Column) -> Column:
    """Variant that only asks whether the source was counted."""
    return (
        F.when(source.isNull(), "NOT CHECKED")
        .when(source == target, "MATCH")
        .otherwise("MISMATCH")
    )


def error_code(message: Column) -> Column:
    """Error code from the text of an exception; the first hit wins."""
    return (
        F.when(message.contains("TABLE_OR_VIEW_NOT_FOUND"), "TABLE_OR_VIEW_NOT_FOUND")
        .when(message.contains("LOCATION_OVERLAP"), "LOCATION_OVERLAP")
        .when(message.rlike("PERMISSION_DENIED|PermissionDenied"), "PERMISSION_DENIED")
        .when(message.contains("AnalysisException"), "ANALYSIS_EXCEPTION")
        .otherwise("CLONE_FAILED")
    )


def failure_status(code: Column, attempt: Column, max_attempts: Column) -> Column:
    return (
        F.when(code.isin(S.COPY_PERMANENT_CODES), "FAILED_PERMANENT")
        .when(attempt < max_attempts, "RETRY_PENDING")
        .otherwise("FAILED")
    )


def capped(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def diff_pct(source: Column, target: Column) -> Column:
    """Difference in percent of the source; NULL where the source is zero."""
    return F.abs(source - target) / F.when(source != 0, source).cast("double") * 100


def within_tolerance(source: Column, target: Column, tolerance_pct: float | Column) -> Column:
    """A zero source needs a zero target; else the difference has to stay in the tolerance."""
    return F.when(source == 0, target == 0).otherwise(diff_pct(source, target) <= tolerance_pct)


def backoff_seconds(base: float, attempt: Column) -> Column:
    """Wait before the next try: ``base * 2^(attempt-1)``, none before the first."""
    return F.when(attempt > 0, F.lit(base) * F.pow(F.lit(2.0), attempt - 1)).otherwise(F.lit(0.0))


def throughput_mbps(num_bytes: Column, seconds: Column) -> Column:
    return num_bytes / F.lit(1048576.0) / F.nullif(seconds, F.lit(0))


def age_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two times, cut off towards zero."""
    return F.timestamp_diff("MINUTE", start, end)


def outcome_counts(text: Column, total: Column) -> Column:
    """Struct (ok, fail) from a text such as ``SUCCESS:batch=b,chunk=3,ok=5,fail=1``.

    Without both counts a text that starts with SUCCESS means all done, any other all failed.
    """
    pairs = F.str_to_map(text, F.lit(","), F.lit("="))
    stated = text.contains("ok=") & text.contains("fail=")
    ok = F.try_element_at(pairs, F.lit("ok")).try_cast("bigint")
    fail = F.try_element_at(pairs, F.lit("fail")).try_cast("bigint")
    usable = stated & ok.isNotNull() & fail.isNotNull()
    all_done = text.startswith("SUCCESS")
    total = total.cast("bigint")
    return F.struct(
        F.when(usable, ok).when(all_done, total).otherwise(F.lit(0)).alias("ok"),
        F.when(usable, fail).when(all_done, F.lit(0)).otherwise(total).alias("fail"),
    )


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))
