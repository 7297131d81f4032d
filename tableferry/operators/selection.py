"""From mapping rows and a table listing to the tables to copy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import names as N
from tableferry.sources import listing as L


def expand(
    mappings: DataFrame,
    listing: DataFrame,
    only_tables: bool = True,
    excluded_schemas: Sequence[str] = tuple(S.DEFAULT_EXCLUDED_SCHEMAS),
    excluded_regexes: Sequence[str] = (),
) -> DataFrame:
    """Expand catalog and schema rows over the listing; table rows need no listing.

    Equi joins on catalog, or catalog and schema: Spark broadcasts the mapping side when it
    measures it small, and splits a catalog that holds much of the listing when it is not.
    Per-row exclude globs become regular expressions once per mapping row, before the join.
    """
    rows = mappings.select(
        *S.MAPPING.names[:8],
        N.glob_regexes(F.col("exclude_schemas")).alias("schema_res"),
        N.glob_regexes(F.col("exclude_tables")).alias("table_res"),
    )
    listed = L.copyable(listing, only_tables).filter(~table_name_excluded("table_name", excluded_regexes))
    listed = listed.select("catalog", "schema_name", "table_name")
    in_catalogs = listed.filter(~schema_excluded("schema_name", excluded_schemas))

    catalogs = rows.filter(F.col("scope") == "catalog")
    from_catalogs = (
        catalogs.join(in_catalogs, F.col("source_catalog") == F.col("catalog"))
        .filter(~N.matches_any(F.col("schema_name"), F.col("schema_res")))
        .filter(~N.matches_any(F.col("table_name"), F.col("table_res")))
    )
    schemas = rows.filter(F.col("scope") == "schema").filter(
        ~N.matches_any(F.col("source_schema"), F.col("schema_res"))
    )
    from_schemas = schemas.join(
        listed, (F.col("source_catalog") == F.col("catalog")) & (F.col("source_schema") == F.col("schema_name"))
    ).filter(~N.matches_any(F.col("table_name"), F.col("table_res")))
    tables = (
        rows.filter(F.col("scope") == "table")
        .filter(~N.matches_any(F.col("source_schema"), F.col("schema_res")))
        .filter(~N.matches_any(F.col("source_table"), F.col("table_res")))
    )
    return concat(
        from_catalogs.select(
            "ordinal",
            "source_catalog",
            F.col("schema_name").alias("source_schema"),
            F.col("table_name").alias("source_table"),
            "target_catalog",
            F.col("schema_name").alias("target_schema"),
            F.col("table_name").alias("target_table"),
        ),
        from_schemas.select(
            "ordinal",
            "source_catalog",
            "source_schema",
            F.col("table_name").alias("source_table"),
            "target_catalog",
            F.coalesce("target_schema", "source_schema").alias("target_schema"),
            F.col("table_name").alias("target_table"),
        ),
        tables.select("ordinal", *S.SOURCE_NAME, *S.TARGET_NAME),
    )


def concat(*parts: DataFrame) -> DataFrame:
    """All expansions one after the other."""
    return reduce(DataFrame.unionByName, parts)


def catalog_excluded(name: str, excluded: Sequence[str]) -> Column:
    """Exact catalog names, case ignored."""
    return F.lower(F.col(name)).isin([c.lower() for c in excluded])


def schema_excluded(name: str, excluded: Sequence[str]) -> Column:
    """Exact schema names, case ignored."""
    return F.lower(F.col(name)).isin([s.lower() for s in excluded])


def glob_excluded(name: str, globs: Sequence[str]) -> Column:
    """Name globs of a configuration layer."""
    hits = [N.like_glob(F.col(name), g) for g in globs]
    return reduce(Column.__or__, hits, F.lit(False))


def table_name_excluded(name: str, regexes: Sequence[str]) -> Column:
    """Regular expressions that match the whole name, case ignored."""
    hits = [F.col(name).rlike(rf"(?i)^(?:{p})\z") for p in regexes]
    return reduce(Column.__or__, hits, F.lit(False))


def drop_excluded(
    selection: DataFrame,
    catalogs: Sequence[str] = (),
    schema_globs: Sequence[str] = (),
    table_globs: Sequence[str] = (),
) -> DataFrame:
    """The document's global exclusions, on what the mappings gave."""
    return (
        selection.filter(~catalog_excluded("source_catalog", catalogs))
        .filter(~glob_excluded("source_schema", schema_globs))
        .filter(~glob_excluded("source_table", table_globs))
    )


def with_target_defaults(df: DataFrame, target_catalog: str = "", target_schema: str = "") -> DataFrame:
    """Target names: an override if given, else the row's own, else the source's."""
    override = {"target_catalog": target_catalog, "target_schema": target_schema, "target_table": ""}
    return df.withColumns(
        {
            t: F.lit(override[t]) if override[t] else N.or_default(t, s)
            for s, t in zip(S.SOURCE_NAME, S.TARGET_NAME)
        }
    )


def first_wins(selection: DataFrame, order: Sequence[str | Column] = ("ordinal",)) -> DataFrame:
    """One row per source table: the first in mapping order.

    An aggregate, not a window: every task keeps one row per table before anything is shuffled,
    so a table that is selected very often weighs no more than another.
    """
    rest = [c for c in selection.columns if c not in S.SOURCE_NAME]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return selection.groupBy(*S.SOURCE_NAME).agg(first.alias("first")).select(*S.SOURCE_NAME, "first.*").select(
        *selection.columns
    )


def later_duplicates(selection: DataFrame) -> DataFrame:
    """How often, and with which first and last mapping row, a source was selected again."""
    return (
        selection.groupBy(*S.SOURCE_NAME)
        .agg(
            F.count("*").alias("selected"),
            F.min("ordinal").alias("first_ordinal"),
            F.max("ordinal").alias("last_ordinal"),
        )
        .filter(F.col("selected") > 1)
        .withColumn("reason", F.lit("DUPLICATE_SOURCE"))
    )


def target_conflicts(selection: DataFrame) -> DataFrame:
    """Targets that several source tables are to be written to, whatever the case of their letters.

    One row per such target, in lower case: number of sources, of mapping rows, and the first and last mapping row. Two rows of one
    source are no conflict; a target with a NULL in its name is none. The sources of a target are counted
    after they are made distinct, so a target that very many rows name is a short sum in every task.
    """
    target = [F.lower(c).alias(c) for c in S.TARGET_NAME]
    sources = selection.select(*target, *[F.lower(c).alias(c) for c in S.SOURCE_NAME], "ordinal").dropna(subset=S.TARGET_NAME)
    per_source = sources.groupBy(*S.TARGET_NAME, *S.SOURCE_NAME).agg(
        F.count("*").alias("n"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last")
    )
    return (
        per_source.groupBy(*S.TARGET_NAME)
        .agg(F.count("*").alias("sources"), F.sum("n").alias("selected"), F.min("first").alias("first_ordinal"), F.max("last").alias("last_ordinal"))
        .filter(F.col("sources") > 1)
        .withColumn("reason", F.lit("DUPLICATE_TARGET"))
    )


def with_target_rivals(selection: DataFrame) -> DataFrame:
    """The selection with the number of other sources that have a row's target; 0 if it is the only one."""
    rivals = target_conflicts(selection).select(*[F.col(c).alias(f"_{c}") for c in S.TARGET_NAME], (F.col("sources") - 1).alias("_rivals"))
    same = [F.lower(c) == F.col(f"_{c}") for c in S.TARGET_NAME]
    return selection.join(rivals, same, "left").select(*selection.columns, F.coalesce("_rivals", F.lit(0)).cast("bigint").alias("target_rivals"))


def remapped_locations(tables: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Target location of each table by the longest source prefix; none means no rule fits.

    ``prefixes`` has (src_prefix, tgt_prefix).  A location is joined to prefixes by equality of
    its leading text, once per length that a prefix has, so no pair is tried that cannot match.
    """
    lengths = prefixes.select(F.length("src_prefix").alias("n")).distinct().agg(F.sort_array(F.collect_set("n"), False))
    # Lengths of location prefixes: a handful of numbers, never more than the longest path has characters.
    wanted = lengths.first()[0] or []
    one_each = prefixes.groupBy("src_prefix").agg(F.min("tgt_prefix").alias("tgt_prefix"))
    result = tables
    best = []
    for n in wanted:
        hit = one_each.filter(F.length("src_prefix") == n).select(
            F.col("src_prefix").alias(f"_p{n}"), F.col("tgt_prefix").alias(f"_t{n}")
        )
        result = result.join(hit, F.substring("location", 1, n) == F.col(f"_p{n}"), "left")
        moved = F.concat(F.col(f"_t{n}"), F.expr(f"substring(location, {n + 1})"))
        best.append(F.when(F.col(f"_p{n}").isNotNull(), moved))
    target = F.coalesce(*best) if best else F.lit(None).cast("string")
    return result.select(
        *tables.columns,
        target.alias("target_location"),
        F.when(target.isNull(), "NO_PREFIX_RULE").alias("warning"),
    )
