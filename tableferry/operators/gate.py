"""Gates a selected table has to pass before it is queued, and the order they are asked in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import measures as M
from tableferry.functions import names as N

# --- fixed values: codes and texts stored with a blocked or skipped table ----
ENABLED_CODE = "PREDICTIVE_OPTIMIZATION_ENABLED"
UNKNOWN_CODE = "PREDICTIVE_OPTIMIZATION_UNKNOWN"
NO_TARGET_CODE = "TARGET_NOT_PRECREATED"
NOT_FOUND_TEXT = "Source table not found or not a Delta table"
# --- end of fixed values -----------------------------------------------------

# So many settings of schemas and catalogs are sent to all tasks.
BROADCAST_SETTINGS = 100_000


def effective_setting(selection: DataFrame, settings: DataFrame) -> DataFrame:
    """Value of a setting for each table, inherited from schema, then catalog; where it came from.

    One row of ``settings`` per (level, name).  The three levels are joined on their own. Those of schemas and catalogs
    are counted first and broadcast if they are few: the selection is not dealt by its few schemas.
    """
    levels = {
        "TABLE": (["catalog", "schema_name", "table_name"], S.SOURCE_NAME),
        "SCHEMA": (["catalog", "schema_name"], S.SOURCE_NAME[:2]),
        "CATALOG": (["catalog"], S.SOURCE_NAME[:1]),
    }
    told = F.col("value") != "INHERIT"
    wide = settings.filter(F.col("level").isin("SCHEMA", "CATALOG") & told)
    few = wide.limit(BROADCAST_SETTINGS + 1).count() <= BROADCAST_SETTINGS
    out = selection
    for level, (own, names) in levels.items():
        side = settings.filter((F.col("level") == level) & told)
        side = side.groupBy(*[F.col(c).alias(n) for c, n in zip(own, names)]).agg(F.max("value").alias(f"_{level}"))
        out = out.join(F.broadcast(side) if few and level != "TABLE" else side, names, "left")
    value = F.coalesce(*[F.col(f"_{level}") for level in levels])
    level = F.coalesce(*[F.when(F.col(f"_{lv}").isNotNull(), lv) for lv in levels])
    inherited_name = (
        F.when(level == "SCHEMA", N.fqn(*S.SOURCE_NAME[:2])).when(level == "CATALOG", F.col("source_catalog"))
    )
    return out.select(
        *selection.columns,
        value.alias("value"),
        level.alias("value_level"),
        inherited_name.alias("source_name"),
    )


def setting_gate(selection: DataFrame, settings: DataFrame) -> DataFrame:
    """Verdict on each table: only a confirmed DISABLE passes, an unknown value blocks."""
    df = effective_setting(selection, settings)
    enabled, disabled = F.col("value") == "ENABLE", F.col("value") == "DISABLE"
    place = F.coalesce(F.concat(F.col("value_level"), F.lit(" "), F.col("source_name")), F.lit("set directly on the table"))
    reason = (
        F.when(disabled, "Predictive optimization disabled.")
        .when(
            enabled,
            F.concat(
                F.lit("Predictive optimization is ENABLED ("),
                place,
                F.lit(") — disable it before migrating this source table."),
            ),
        )
        .otherwise("Could not confirm predictive optimization is disabled.")
    )
    return df.select(
        *selection.columns,
        (~F.coalesce(disabled, F.lit(False))).alias("blocked"),
        F.col("value"),
        F.when(enabled, F.col("value_level")).alias("level"),
        F.when(enabled, F.col("source_name")).alias("source_name"),
        reason.alias("reason"),
        F.when(disabled, "").when(enabled, ENABLED_CODE).otherwise(UNKNOWN_CODE).alias("gate_code"),
    )


def already_settled(selection: DataFrame, control: DataFrame, batch_id: str) -> DataFrame:
    """The selection with the batch's own row for each table: its id and status, NULL if new."""
    mine = control.filter(F.col("batch_id") == batch_id).select(
        *S.SOURCE_NAME,
        F.col("migration_id").alias("existing_id"),
        F.col("status").alias("existing_status"),
    )
    return selection.join(mine, S.SOURCE_NAME, "left")


def target_listed(selection: DataFrame, target_listing: DataFrame) -> DataFrame:
    """The selection with ``target_exists``."""
    keys = target_listing.select(
        F.col("catalog").alias("target_catalog"),
        F.col("schema_name").alias("target_schema"),
        F.col("table_name").alias("target_table"),
        F.lit(True).alias("_there"),
    ).distinct()
    return selection.join(keys, S.TARGET_NAME, "left").withColumn(
        "target_exists", F.col("_there").isNotNull()
    ).drop("_there")


def with_source_stats(selection: DataFrame, stats: DataFrame) -> DataFrame:
    """The selection with the source's location, size, files, format and version."""
    side = stats.select(
        F.col("table_fqn").alias("_fqn"),
        F.col("location").alias("source_path"),
        "size_in_bytes",
        F.col("num_files").alias("source_num_files"),
        F.col("format").alias("source_format"),
        (F.col("version") if "version" in stats.columns else F.lit(None)).cast("bigint").alias("source_version"),
    )
    return selection.join(side, N.fqn(*S.SOURCE_NAME) == F.col("_fqn"), "left").drop("_fqn")


def onboarding_outcome(
    force: bool, need_target: bool, skip_stats: bool = False, fmt: str = "parquet"
) -> Column:
    """First of the gates a table stops at, else QUEUED.

    Order: setting gate, settled row of the same batch, target there, source there and of the
    right format.
    """
    settled = F.coalesce(F.col("existing_status").isin(S.SETTLED), F.lit(False))
    usable = F.coalesce(F.lower("source_format") == fmt, F.lit(False))
    return (
        F.when(F.col("blocked"), "PO_BLOCKED")
        .when(settled & F.lit(not force), "SKIPPED_EXISTING")
        .when(~F.col("target_exists") & F.lit(need_target), "SKIPPED")
        .when(~usable & F.lit(not skip_stats), "FAILED_PERMANENT")
        .otherwise("QUEUED")
    )


def selection_stats(judged: DataFrame) -> DataFrame:
    """Counters of an onboarding pass, one row."""
    n = lambda *outcomes: F.count(F.when(F.col("outcome").isin(*outcomes), 1))
    return judged.agg(
        F.count("*").alias("total"),
        n("QUEUED").alias("inserted"),
        n("SKIPPED", "SKIPPED_EXISTING", "FAILED_PERMANENT").alias("skipped"),
        n("SKIPPED").alias("skipped_target_missing"),
        n("FAILED_PERMANENT").alias("not_found"),
        n("PO_BLOCKED").alias("po_blocked"),
    )


def class_counts(selection_with_stats: DataFrame) -> DataFrame:
    """Plan preview: how many tables of each workload class."""
    return selection_with_stats.groupBy(M.workload_class(F.col("size_in_bytes")).alias("workload_class")).agg(
        F.count("*").alias("tables")
    )


def first_offenders(gated: DataFrame, n: int = 10) -> DataFrame:
    """The first blocked tables, for an error message."""
    name = N.fqn(*S.SOURCE_NAME)
    return (
        gated.filter("blocked")
        .select(name.alias("table_fqn"), "gate_code")
        .orderBy("table_fqn")
        .limit(n)
    )


def raise_if_blocked(gated: DataFrame, n: int = 10) -> None:
    """Fail the step, naming the first offenders, if the gate blocks any table."""
    shown = first_offenders(gated, n).collect()
    if shown:
        total = gated.filter("blocked").count()
        named = "; ".join(f"{r['table_fqn']} ({r['gate_code']})" for r in shown)
        raise RuntimeError(f"{total} source table(s) blocked by the setting gate. First few: {named}")
