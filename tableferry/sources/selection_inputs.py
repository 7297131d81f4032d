"""Readers of what to copy: mapping files, mapping documents, job parameters, exclusion rules.

Each reader gives mapping rows (``MAPPING``) and, where rows can be bad, the bad ones with a reason.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import names as N

_NAMES = S.SOURCE_NAME + S.TARGET_NAME
_SCOPES = ["catalog", "schema", "table"]


def read_table_file(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns as text with trimmed lower-case names, plus ``ordinal``.

    ``ordinal`` grows with the place of a row: name of the file, block, line.
    """
    raw = spark.read.csv(path, header=True, quote='"', escape='"', enforceSchema=False)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    named = raw.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in raw.columns], *place)
    # Within a block the line order is that of the task that reads it; the sort keeps the ids in order.
    ordered = named.withColumn("_line", F.monotonically_increasing_id()).orderBy("_file", "_block", "_line")
    return ordered.drop("_file", "_block", "_line").withColumn("ordinal", F.monotonically_increasing_id())


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) if name in df.columns else F.lit("")


def is_row_level(df: DataFrame) -> bool:
    """A header with ``clone_type`` has catalog / schema / table rows, any other only tables."""
    return "clone_type" in df.columns


def explicit_mappings(df: DataFrame) -> DataFrame:
    """Each row is one table; a blank target means the source's name."""
    s = {n: _text(df, n) for n in _NAMES}
    target = {t: F.when(s[t] != "", s[t]).otherwise(s[src]) for src, t in zip(S.SOURCE_NAME, S.TARGET_NAME)}
    missing = [n for n in S.SOURCE_NAME if n not in df.columns]
    return df.select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.lit("table").alias("scope"),
        *[s[n].alias(n) for n in S.SOURCE_NAME],
        *[target[n].alias(n) for n in S.TARGET_NAME],
        F.array().cast("array<string>").alias("exclude_schemas"),
        F.array().cast("array<string>").alias("exclude_tables"),
        (F.lit(f"missing column {missing[0]}") if missing else F.lit(None).cast("string")).alias("reason"),
    )


def row_level_mappings(df: DataFrame) -> DataFrame:
    """Rows of any scope with exclude lists of their own; ``reason`` says why a row is no good."""
    s = {n: _text(df, n) for n in _NAMES}
    scope = F.lower(_text(df, "clone_type"))
    scope = F.when(scope == "", "table").otherwise(scope)
    within_catalog = scope == "catalog"
    only_table = scope == "table"
    none = F.lit(None).cast("string")

    def target(src: str, t: str) -> Column:
        return F.when(s[t] != "", s[t]).otherwise(s[src])

    reason = (
        F.when(s["source_catalog"] == "", "missing source_catalog")
        .when(~scope.isin(_SCOPES), "unknown clone_type")
        .when(~within_catalog & (s["source_schema"] == ""), "missing source_schema")
        .when(only_table & (s["source_table"] == ""), "missing source_table")
    )
    no_globs = F.array().cast("array<string>")
    return df.select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        scope.alias("scope"),
        s["source_catalog"].alias("source_catalog"),
        F.when(~within_catalog, s["source_schema"]).otherwise(none).alias("source_schema"),
        F.when(only_table, s["source_table"]).otherwise(none).alias("source_table"),
        target("source_catalog", "target_catalog").alias("target_catalog"),
        F.when(~within_catalog, target("source_schema", "target_schema")).otherwise(none).alias("target_schema"),
        F.when(only_table, target("source_table", "target_table")).otherwise(none).alias("target_table"),
        F.when(within_catalog, N.list_cell(_text(df, "exclude_schemas"))).otherwise(no_globs).alias("exclude_schemas"),
        F.when(~only_table, N.list_cell(_text(df, "exclude_tables"))).otherwise(no_globs).alias("exclude_tables"),
        reason.alias("reason"),
    )


def mappings(df: DataFrame) -> DataFrame:
    """Mapping rows of either file form, with ``reason`` set on the bad ones."""
    return row_level_mappings(df) if is_row_level(df) else explicit_mappings(df)


def good(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason")


def bad(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())


def document_mappings(spark: SparkSession, document: Mapping, document_path: str = "") -> DataFrame:
    """Mapping rows of a parsed mapping document.

    ``migration.csv_path`` hands the whole choice to a CSV, relative to the document; else the
    ``mappings`` list counts, and only without one the older ``selection`` block.
    """
    body = document.get("migration") or {}
    if body.get("csv_path"):
        path = PurePosixPath(body["csv_path"])
        if not path.is_absolute() and "://" not in body["csv_path"]:
            path = PurePosixPath(document_path).parent / path
        where = body["csv_path"] if "://" in body["csv_path"] else str(path)
        return mappings(read_table_file(spark, where))
    entries = list(body.get("mappings") or []) or list(_older_entries(body.get("selection") or {}))
    rows = [_document_row(i, e) for i, e in enumerate(entries)]
    df = spark.createDataFrame(rows, S.MAPPING)
    return df.withColumn(
        "reason", F.when(~F.col("scope").isin(_SCOPES), F.lit("unknown mapping type"))
    )


def _older_entries(selection: Mapping) -> Iterable[dict]:
    kind = selection.get("type", "schema")
    group = {"catalog": "catalogs", "schema": "schemas", "table": "tables"}.get(kind)
    return [{**entry, "type": kind} for entry in selection.get(group, [])] if group else []


def _document_row(ordinal: int, entry: Mapping) -> tuple:
    scope = (entry.get("type") or "schema").lower()
    catalog = entry.get("source") if scope == "catalog" else entry.get("source_catalog")
    schema = entry.get("source_schema") if scope != "catalog" else None
    table = entry.get("source_table") if scope == "table" else None
    return (
        ordinal,
        scope,
        catalog,
        schema,
        table,
        entry.get("target" if scope == "catalog" else "target_catalog", catalog),
        entry.get("target_schema", schema) if scope != "catalog" else None,
        entry.get("target_table", table) if scope == "table" else None,
        list(entry.get("exclude_schemas") or []) if scope != "table" else [],
        list(entry.get("exclude_tables") or []) if scope != "table" else [],
    )


def parameter_mappings(
    params: DataFrame, scope: str, target_catalog: str = "", target_schema: str = ""
) -> DataFrame:
    """Mapping rows of name lists: ``params`` has one text column ``names`` per row.

    A name has as many dot-separated parts as its scope asks for; others get a reason.
    """
    scope = scope.lower() if scope.lower() in _SCOPES else "schema"
    parts_wanted = _SCOPES.index(scope) + 1
    # Numbered after the names are apart: ids grow with the rows and, within one, with the names.
    listed = params.select(F.explode(N.name_list(F.col("names"))).alias("name")).withColumn("ordinal", F.monotonically_increasing_id())
    p = F.split("name", r"\.")
    part = [F.try_element_at(p, F.lit(i + 1)) if i < parts_wanted else F.lit(None).cast("string") for i in range(3)]
    own = lambda value, i: F.lit(value) if value else part[i]
    empty = F.array().cast("array<string>")
    return listed.select(
        "ordinal",
        F.lit(scope).alias("scope"),
        part[0].alias("source_catalog"),
        part[1].alias("source_schema"),
        part[2].alias("source_table"),
        own(target_catalog, 0).alias("target_catalog"),
        (own(target_schema, 1) if scope == "schema" else part[1]).alias("target_schema"),
        part[2].alias("target_table"),
        empty.alias("exclude_schemas"),
        empty.alias("exclude_tables"),
        F.when(F.size(p) != parts_wanted, F.concat(F.lit("malformed name: "), "name")).alias("reason"),
    )


def exclusion_rules(df: DataFrame) -> DataFrame:
    """Exclusion rules of a CSV read by ``read_table_file``; ``reason`` is set on the bad rows."""
    kind = F.lower(_text(df, "exclude_type"))
    catalog, schema, table = _text(df, "catalog"), _text(df, "schema"), _text(df, "table")
    reason = (
        F.when(~kind.isin(_SCOPES), "invalid exclude_type")
        .when(catalog == "", "missing catalog")
        .when(kind.isin("schema", "table") & (schema == ""), "missing schema")
        .when((kind == "table") & (table == ""), "missing table")
    )
    return df.select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        kind.alias("exclude_type"),
        catalog.alias("catalog"),
        schema.alias("schema_name"),
        table.alias("table_name"),
        reason.alias("reason"),
    )


def no_rules(spark: SparkSession) -> DataFrame:
    """What a blank rule path stands for: nothing is excluded."""
    return spark.createDataFrame([], S.RULES)


def merged_patterns(first: Column, second: Column) -> Column:
    """Patterns of two config layers, each once."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(first, empty), F.coalesce(second, empty))
