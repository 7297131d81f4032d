"""What to copy: readers of mappings, expansion over a listing, exclusions, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import count_if, query
from tableferry import schemas as S
from tableferry.functions import names as N
from tableferry.operators import exclusion as E
from tableferry.operators import gate as G
from tableferry.operators import selection as X
from tableferry.operators import telemetry as T
from tableferry.session import new_folder
from tableferry.sources import listing as L
from tableferry.sources import selection_inputs as I
from tableferry.sources import stored_tables as ST

KEY = "CAST(migration_id AS BIGINT)"
NAMES = ", ".join([*S.SOURCE_NAME, *S.TARGET_NAME])


def written_csv(t, df):
    """The frame as a CSV folder, read back by the library's reader."""
    path = new_folder(t.spark, "csv")
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return I.read_table_file(t.spark, path)


# --- mapping files --------------------------------------------------------------


@query("A1, B8", f"""
SELECT 'table' AS scope, source_catalog, source_schema, source_table,
 CASE WHEN {KEY} % 3 = 0 THEN source_catalog ELSE target_catalog END AS target_catalog,
 CASE WHEN {KEY} % 4 = 0 THEN source_schema ELSE target_schema END AS target_schema,
 CASE WHEN {KEY} % 5 = 0 THEN source_table ELSE target_table END AS target_table FROM control""")
def explicit_mapping_file(t):
    k = F.expr("CAST(migration_id AS BIGINT)")
    blank = lambda c, n: F.when(k % n == 0, F.lit("  ")).otherwise(F.col(c)).alias(c)
    raw = t.control.select(
        F.concat(F.lit(" "), "source_catalog").alias("source_catalog"), "source_schema",
        F.concat("source_table", F.lit("  ")).alias("source_table"),
        blank("target_catalog", 3), blank("target_schema", 4), blank("target_table", 5),
    )
    return I.good(I.mappings(written_csv(t, raw))).select("scope", *S.SOURCE_NAME, *S.TARGET_NAME)


_KIND = f"CASE {KEY} % 6 WHEN 0 THEN 'Catalog' WHEN 1 THEN 'schema' WHEN 2 THEN 'table' WHEN 3 THEN '' WHEN 4 THEN 'view' ELSE ' TABLE ' END"
_SCHEMA_GLOBS = "concat('[''', source_schema, ''', \"*_old\"]')"
_TABLE_GLOBS = f"CASE WHEN {KEY} % 4 = 0 THEN '[''broken' WHEN {KEY} % 4 = 1 THEN '' WHEN {KEY} % 4 = 2 THEN '''tmp_*''' ELSE '[''tmp_*'', ''st?g*'']' END"
_ROW_LEVEL = f"""SELECT migration_id, {_KIND} AS clone_type, CASE WHEN {KEY} % 13 = 0 THEN '' ELSE source_catalog END AS source_catalog,
 CASE WHEN {KEY} % 17 = 0 THEN ' ' ELSE source_schema END AS source_schema, CASE WHEN {KEY} % 19 = 0 THEN '' ELSE source_table END AS source_table,
 CASE WHEN {KEY} % 2 = 0 THEN target_catalog ELSE '' END AS target_catalog, target_schema, '' AS target_table,
 {_SCHEMA_GLOBS} AS exclude_schemas, {_TABLE_GLOBS} AS exclude_tables FROM control"""
_ROW_RULES = f"""k AS (SELECT *, CASE WHEN trim(lower(clone_type)) = '' THEN 'table' ELSE trim(lower(clone_type)) END AS scope,
 trim(source_schema) AS s2 FROM ({_ROW_LEVEL})),
j AS (SELECT *, CASE WHEN source_catalog = '' THEN 'missing source_catalog' WHEN scope NOT IN ('catalog', 'schema', 'table') THEN 'unknown clone_type'
 WHEN scope <> 'catalog' AND s2 = '' THEN 'missing source_schema' WHEN scope = 'table' AND source_table = '' THEN 'missing source_table' END AS reason FROM k)"""


@query("A2, A3, B9", f"""
WITH {_ROW_RULES} SELECT scope, source_catalog, CASE WHEN scope <> 'catalog' THEN s2 END AS source_schema,
 CASE WHEN scope = 'table' THEN source_table END AS source_table,
 CASE WHEN target_catalog <> '' THEN target_catalog ELSE source_catalog END AS target_catalog,
 CASE WHEN scope <> 'catalog' THEN target_schema END AS target_schema, CASE WHEN scope = 'table' THEN source_table END AS target_table,
 CASE WHEN scope = 'catalog' THEN concat(regexp_extract(exclude_schemas, '''(.*)''', 1), ';*_old') ELSE '' END AS exclude_schemas,
 CASE WHEN scope = 'table' THEN '' ELSE CASE {KEY} % 4 WHEN 2 THEN 'tmp_*' WHEN 3 THEN 'tmp_*;st?g*' ELSE '' END END AS exclude_tables
FROM j WHERE reason IS NULL""")
def row_level_mapping_file(t):
    raw = t.spark.sql(_ROW_LEVEL.replace("FROM control", "FROM {c}"), c=t.control)
    rows = I.good(I.mappings(written_csv(t, raw)))
    return rows.select(
        "scope", *S.SOURCE_NAME, *S.TARGET_NAME,
        F.array_join("exclude_schemas", ";").alias("exclude_schemas"), F.array_join("exclude_tables", ";").alias("exclude_tables"),
    )


@query("B9", f"WITH {_ROW_RULES} SELECT reason, COUNT(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY reason")
def rejected_mapping_rows(t):
    raw = t.spark.sql(_ROW_LEVEL.replace("FROM control", "FROM {c}"), c=t.control)
    return I.bad(I.mappings(written_csv(t, raw))).groupBy("reason").agg(F.count("*").alias("n"))


@query("A3", f"""
SELECT migration_id, CASE {KEY} % 3 WHEN 0 THEN concat('it''s ', migration_id, ';b') WHEN 1 THEN concat('None;', migration_id) ELSE 'a"b;c\\d' END AS joined FROM control""")
def escaped_list_cells(t):
    cell = F.expr(f"""CASE {KEY} % 3 WHEN 0 THEN concat("['it\\\\'s ", migration_id, "', 'b']") WHEN 1 THEN concat('[None, ', migration_id, ']')
     ELSE r'["a\\"b", "c\\\\d"]' END""")
    return t.control.select("migration_id", F.array_join(N.list_cell(cell), ";").alias("joined"))


@query("A3", f"""
SELECT migration_id, CASE {KEY} % 4 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS entries,
 CASE {KEY} % 4 WHEN 2 THEN 'tmp_*' WHEN 3 THEN 'tmp_*;st?g*' ELSE '' END AS joined FROM control""")
def list_cells(t):
    cells = t.control.select("migration_id", F.expr(_TABLE_GLOBS).alias("cell"))
    items = N.list_cell(F.col("cell"))
    return cells.select("migration_id", F.size(items).cast("bigint").alias("entries"), F.array_join(items, ";").alias("joined"))


_RULE_ROWS = f"""SELECT migration_id, CASE {KEY} % 5 WHEN 0 THEN ' Catalog' WHEN 1 THEN 'schema' WHEN 2 THEN 'table' WHEN 3 THEN '' ELSE 'database' END AS exclude_type,
 CASE WHEN {KEY} % 7 = 0 THEN '' ELSE concat(source_catalog, ' ') END AS catalog, CASE WHEN {KEY} % 11 = 0 THEN '' ELSE source_schema END AS schema,
 CASE WHEN {KEY} % 13 = 0 THEN '' ELSE source_table END AS table FROM control"""


@query("A4, B9", f"""
WITH k AS (SELECT trim(lower(exclude_type)) AS exclude_type, trim(catalog) AS catalog, schema AS schema_name, "table" AS table_name
 FROM ({_RULE_ROWS.replace('AS schema,', 'AS "schema",').replace('AS table ', 'AS "table" ')}))
SELECT * FROM k WHERE exclude_type IN ('catalog', 'schema', 'table') AND catalog <> '' AND (exclude_type = 'catalog' OR schema_name <> '')
 AND (exclude_type <> 'table' OR table_name <> '')""")
def exclusion_rule_file(t):
    raw = t.spark.sql(_RULE_ROWS.replace("FROM control", "FROM {c}"), c=t.control).drop("migration_id")
    return I.good(I.exclusion_rules(written_csv(t, raw))).drop("ordinal")


_PARAMS = f"""SELECT CASE WHEN {KEY} % 2 = 0
 THEN concat('["', source_catalog, '.', source_schema, '.', source_table, '", "', source_catalog, '.', source_schema, '"]')
 ELSE concat(source_catalog, '.', source_schema, '.', source_table, ' , ,', source_catalog, '.', source_schema, '.again') END AS names FROM control"""


@query("A6, B8, B9", f"""
WITH n AS (SELECT concat(source_catalog, '.', source_schema, '.', source_table) AS name FROM control
 UNION ALL SELECT concat(source_catalog, '.', source_schema, CASE WHEN {KEY} % 2 = 0 THEN '' ELSE '.again' END) FROM control)
SELECT 'table' AS scope, split_part(name, '.', 1) AS source_catalog, split_part(name, '.', 2) AS source_schema,
 CASE WHEN name LIKE '%.%.%' THEN split_part(name, '.', 3) END AS source_table, 'over' AS target_catalog, split_part(name, '.', 2) AS target_schema,
 CASE WHEN name LIKE '%.%.%' THEN split_part(name, '.', 3) END AS target_table,
 CASE WHEN name NOT LIKE '%.%.%' THEN concat('malformed name: ', name) END AS reason FROM n""")
def parameter_names(t):
    params = t.spark.sql(_PARAMS.replace("FROM control", "FROM {c}"), c=t.control)
    return I.parameter_mappings(params, "table", target_catalog="over").drop("ordinal", "exclude_schemas", "exclude_tables")


# --- expansion ------------------------------------------------------------------

DOCUMENT = {
    "migration": {
        "mappings": [
            {"type": "catalog", "source": "cat_0", "target": "moved_0", "exclude_schemas": ["sch_1", "*_old"], "exclude_tables": ["staging_*"]},
            {"type": "schema", "source_catalog": "cat_1", "source_schema": "sch_2", "target_schema": "second", "exclude_tables": ["*[05]"]},
            {"type": "schema", "source_catalog": "cat_0", "source_schema": "sch_1"},
            {"type": "table", "source_catalog": "cat_9", "source_schema": "s", "source_table": "only_here"},
            {"type": "view", "source_catalog": "cat_1"},
        ],
        "exclude": {"catalogs": ["CAT_2"], "schemas": ["sch_5"], "tables": ["tmp_*"]},
    }
}
_LISTED = "SELECT * FROM listing WHERE NOT is_temporary AND table_type IN ('MANAGED', 'EXTERNAL')"
_EXPANDED = f"""x AS (SELECT 0 AS ordinal, catalog AS source_catalog, schema_name AS source_schema, table_name AS source_table, 'moved_0' AS target_catalog,
 schema_name AS target_schema, table_name AS target_table FROM ({_LISTED}) WHERE catalog = 'cat_0'
 AND lower(schema_name) NOT IN ('information_schema', 'sch_1') AND NOT table_name GLOB 'staging_*'
UNION ALL SELECT 1, catalog, schema_name, table_name, 'cat_1', 'second', table_name FROM ({_LISTED})
 WHERE catalog = 'cat_1' AND schema_name = 'sch_2' AND NOT table_name GLOB '*[05]'
UNION ALL SELECT 2, catalog, schema_name, table_name, 'cat_0', 'sch_1', table_name FROM ({_LISTED}) WHERE catalog = 'cat_0' AND schema_name = 'sch_1'
UNION ALL SELECT 3, 'cat_9', 's', 'only_here', 'cat_9', 's', 'only_here'),
y AS (SELECT * FROM x WHERE lower(source_catalog) <> 'cat_2' AND NOT source_schema GLOB 'sch_5' AND NOT source_table GLOB 'tmp_*')"""


def _document_selection(t):
    rows = I.good(I.document_mappings(t.spark, DOCUMENT))
    excluded = DOCUMENT["migration"]["exclude"]
    return X.drop_excluded(X.expand(rows, t.listing), excluded["catalogs"], excluded["schemas"], excluded["tables"])


@query("A5, A7, C7, G1, B1, B3, B4, B5, B6", f"WITH {_EXPANDED} SELECT CAST(ordinal AS BIGINT) AS ordinal, {NAMES} FROM y")
def document_selection(t):
    return _document_selection(t)


_FROM_CONTROL = f"""m AS (SELECT DISTINCT source_catalog, source_schema, concat('to_', source_schema) AS target_schema FROM control
 WHERE source_catalog <> 'cat_0')"""


@query("C7, B2", f"""
WITH {_FROM_CONTROL} SELECT source_catalog, source_schema, table_name AS source_table, source_catalog AS target_catalog, target_schema,
 table_name AS target_table FROM m JOIN ({_LISTED}) l ON l.catalog = m.source_catalog AND l.schema_name = m.source_schema
 AND NOT regexp_full_match(table_name, 'T_[0-9]{{1,3}}|staging_.*', 'i')""")
def schema_expansion(t):
    maps = t.control.filter("source_catalog <> 'cat_0'").select("source_catalog", "source_schema").distinct()
    maps = maps.select(
        F.lit(0).cast("bigint").alias("ordinal"), F.lit("schema").alias("scope"), "source_catalog", "source_schema",
        F.lit(None).cast("string").alias("source_table"), F.col("source_catalog").alias("target_catalog"),
        F.concat(F.lit("to_"), "source_schema").alias("target_schema"), F.lit(None).cast("string").alias("target_table"),
        F.array().cast("array<string>").alias("exclude_schemas"), F.array().cast("array<string>").alias("exclude_tables"),
    )
    return X.expand(maps, t.listing, excluded_regexes=["T_[0-9]{1,3}", "staging_.*"]).drop("ordinal")


@query("A7", " UNION ALL ".join(
    f"SELECT 'lake' AS catalog, 'raw' AS schema_name, '{n}' AS table_name, 'EXTERNAL' AS table_type, false AS is_temporary"
    for n in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
              "pages", "benchmark", "labels", "conversations"]))
def folder_listing(t):
    return L.folder_listing(t.spark, t.sf_dir, "lake", "raw").drop("format", "location")


@query("A8")
def folder_stats(t):
    return L.folder_stats(t.spark, t.sf_dir, "lake.raw.").drop("last_modified")


@query("A8", """
SELECT concat('lake.raw.', n) AS table_fqn, true AS has_files, true AS has_bytes, 'parquet' AS format FROM (VALUES ('region'), ('nation'), ('customer'), ('supplier'), ('part'), ('orders'), ('lineitem'),
 ('events'), ('documents'), ('embeddings'), ('pages'), ('benchmark'), ('labels'), ('conversations')) AS v(n)""")
def folders_with_files(t):
    """Tables of the given folder, each with files and bytes."""
    stats = L.folder_stats(t.spark, t.sf_dir, "lake.raw.")
    return stats.select("table_fqn", (F.col("num_files") > 0).alias("has_files"), (F.col("size_in_bytes") > 0).alias("has_bytes"), "format")


@query("A8, D29", """
SELECT 'lake.raw.orders' AS table_fqn, COUNT(DISTINCT concat(o_orderstatus, '/', o_orderpriority)) AS num_files, true AS has_bytes FROM orders
UNION ALL SELECT 'lake.raw.lineitem', COUNT(DISTINCT concat(l_returnflag, '/', l_linestatus, '/', l_linenumber)), true FROM lineitem
UNION ALL SELECT 'lake.raw.nowhere', 0, false""")
def located_stats(t):
    """Tables stored in nested partition folders, a file each; and one that is not there."""
    places = []
    for name, keys in (("orders", ["o_orderstatus", "o_orderpriority"]), ("lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"])):
        path = new_folder(t.spark, "nested")
        getattr(t, name).repartition(*keys).write.partitionBy(*keys).parquet(path)
        places.append((f"lake.raw.{name}", path))
    places.append(("lake.raw.nowhere", new_folder(t.spark, "nowhere")))
    stats = L.located_stats(t.spark.createDataFrame(places, "table_fqn string, location string"))
    return stats.select("table_fqn", "num_files", (F.coalesce("size_in_bytes", F.lit(0)) > 0).alias("has_bytes"))


@query("A11", """
SELECT migration_id, EXISTS (SELECT 1 FROM target_listing l WHERE l.catalog = c.target_catalog AND l.schema_name = c.target_schema
 AND l.table_name = c.target_table) AS target_exists FROM control c""")
def target_existence(t):
    return G.target_listed(t.control, t.target_listing).select("migration_id", "target_exists")


@query("B1", """
SELECT migration_id FROM control WHERE NOT (lower(source_schema) GLOB 'sch_[1-3]' OR lower(source_schema) GLOB '*_x')
 AND NOT (lower(source_table) GLOB 'tmp_*' OR lower(source_table) GLOB 't_??' OR lower(source_table) GLOB 'staging_[!1-4]*')""")
def glob_exclusions(t):
    globs = X.glob_excluded("source_table", ["TMP_*", "t_??", "staging_[!1-4]*"])
    return t.control.filter(~X.glob_excluded("source_schema", ["sch_[1-3]", "*_X"])).filter(~globs).select("migration_id")


@query("B1, G4", """
SELECT migration_id FROM control WHERE NOT (source_table GLOB concat('*', substr(batch_id, 7, 1)) OR source_table GLOB 'tmp_*')""")
def glob_exclusions_per_row(t):
    own = F.array(F.concat(F.lit("*"), F.substring("batch_id", 7, 1)), F.lit("tmp_*"))
    globs = N.glob_regexes(I.merged_patterns(own, F.array(F.lit("tmp_*"))))
    return t.control.filter(~N.matches_any(F.col("source_table"), globs)).select("migration_id")


@query("B2", "SELECT migration_id FROM control WHERE NOT regexp_full_match(source_table, 'TMP_.*|t_1.*5', 'i')")
def name_regex_exclusion(t):
    return t.control.filter(~X.table_name_excluded("source_table", ["TMP_.*", "t_1.*5"])).select("migration_id")


@query("B3, B4", """
SELECT catalog, schema_name, table_name FROM listing WHERE lower(catalog) NOT IN ('cat_1') AND lower(schema_name) NOT IN
 ('information_schema', 'internal')""")
def catalog_and_schema_exclusion(t):
    kept = t.listing.filter(~X.catalog_excluded("catalog", ["CAT_1"]))
    return kept.filter(~X.schema_excluded("schema_name", [*S.DEFAULT_EXCLUDED_SCHEMAS, "Internal"])).select("catalog", "schema_name", "table_name")


@query("B5, B6", f"SELECT catalog, schema_name, table_name FROM ({_LISTED})")
def copyable_tables(t):
    return L.copyable(t.listing).select("catalog", "schema_name", "table_name")


@query("B6", "SELECT catalog, schema_name, table_name FROM listing WHERE NOT is_temporary")
def permanent_tables(t):
    return L.permanent_tables(t.listing).select("catalog", "schema_name", "table_name")


@query("B7", "SELECT catalog, schema_name, table_name FROM listing WHERE lower(format) = 'parquet'")
def tables_of_format(t):
    return L.of_format(t.listing).select("catalog", "schema_name", "table_name")


@query("B8", f"""
SELECT migration_id, 'main' AS target_catalog, CASE WHEN {KEY} % 3 = 0 THEN source_schema ELSE target_schema END AS target_schema,
 CASE WHEN {KEY} % 5 = 0 THEN source_table ELSE target_table END AS target_table FROM control""")
def target_defaults(t):
    k = F.expr(KEY)
    df = t.control.withColumn("target_schema", F.when(k % 3 != 0, F.col("target_schema")))
    df = df.withColumn("target_table", F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("target_table")))
    return X.with_target_defaults(df, target_catalog="main").select("migration_id", *S.TARGET_NAME)


@query("B24", "SELECT catalog, schema_name, table_name, table_type, location FROM listing WHERE table_type = 'EXTERNAL'")
def external_tables(t):
    return L.external_tables(t.listing)


@query("B25", """
SELECT source_catalog, source_schema, source_table, ordinal FROM selection s WHERE EXISTS (SELECT 1 FROM listing l WHERE l.catalog = s.source_catalog
 AND l.schema_name = s.source_schema AND l.table_name = s.source_table AND l.format = 'parquet' AND l.table_type = 'MANAGED')""")
def requested_and_usable(t):
    usable = t.listing.filter("table_type = 'MANAGED'")
    return L.requested_and_usable(t.selection, usable).select(*S.SOURCE_NAME, "ordinal")


_PREFIXES = """SELECT * FROM (VALUES ('s3://bucket0', 'gs://zero'), ('s3://bucket1/', 'gs://one/'), ('s3://bucket1/sch_1', 'gs://one-first'),
 ('s3://bucket2/sch_5/t_', 'gs://two/fifth/')) AS p(src_prefix, tgt_prefix)"""


@query("C16", f"""
WITH p AS ({_PREFIXES}), h AS (SELECT l.catalog, l.schema_name, l.table_name, l.location, arg_max(p.tgt_prefix, length(p.src_prefix)) AS tgt, MAX(length(p.src_prefix)) AS n
 FROM listing l LEFT JOIN p ON starts_with(l.location, p.src_prefix) GROUP BY 1, 2, 3, 4)
SELECT catalog, schema_name, table_name, concat(tgt, NULL) IS NULL AS x, CASE WHEN n IS NOT NULL THEN concat(tgt, substr(location, n + 1)) END AS target_location,
 CASE WHEN n IS NULL THEN 'NO_PREFIX_RULE' END AS warning FROM h""".replace(" concat(tgt, NULL) IS NULL AS x,", ""))
def remapped_locations(t):
    out = X.remapped_locations(t.listing.select("catalog", "schema_name", "table_name", "location"), t.spark.sql(_PREFIXES))
    return out.drop("location")


# --- first wins -----------------------------------------------------------------

_FIRST = f"""f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_catalog, source_schema, source_table ORDER BY ordinal) AS rn
 FROM selection) WHERE rn = 1)"""


@query("E2", f"WITH {_FIRST} SELECT ordinal, {NAMES} FROM f")
def first_mapping_wins(t):
    return X.first_wins(t.selection)


@query("E2", """
SELECT source_catalog, source_schema, source_table, COUNT(*) AS selected, MIN(ordinal) AS first_ordinal, MAX(ordinal) AS last_ordinal,
 'DUPLICATE_SOURCE' AS reason FROM selection GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def duplicate_selections(t):
    return X.later_duplicates(t.selection)


# Every third row goes to one schema of one catalog, in letters of either case.
_MERGED = """SELECT ordinal, source_catalog, source_schema, source_table, CASE ordinal % 3 WHEN 0 THEN 'One' ELSE target_catalog END AS target_catalog,
 CASE ordinal % 3 WHEN 0 THEN 'all' ELSE target_schema END AS target_schema, CASE ordinal % 6 WHEN 0 THEN concat('T_', ordinal % 700)
 WHEN 3 THEN concat('t_', ordinal % 700) ELSE target_table END AS target_table FROM {selection}"""
_RIVALS = f"""m AS ({_MERGED.format(selection="selection")}), c AS (SELECT lower(target_catalog) AS target_catalog, lower(target_schema) AS target_schema,
 lower(target_table) AS target_table, COUNT(DISTINCT (lower(source_catalog), lower(source_schema), lower(source_table))) AS sources, COUNT(*) AS selected,
 MIN(ordinal) AS first_ordinal, MAX(ordinal) AS last_ordinal FROM m GROUP BY 1, 2, 3)"""


@query("E2, I1", f"WITH {_RIVALS} SELECT *, 'DUPLICATE_TARGET' AS reason FROM c WHERE sources > 1")
def duplicate_targets(t):
    return X.target_conflicts(t.spark.sql(_MERGED, selection=t.selection))


@query("E2, I1", f"""
WITH {_RIVALS} SELECT m.ordinal, m.source_catalog, m.source_schema, m.source_table, m.target_table, c.sources - 1 AS target_rivals FROM m JOIN c
 ON lower(m.target_catalog) = c.target_catalog AND lower(m.target_schema) = c.target_schema AND lower(m.target_table) = c.target_table""")
def rivals_for_a_target(t):
    rows = X.with_target_rivals(t.spark.sql(_MERGED, selection=t.selection))
    return rows.drop("target_catalog", "target_schema")


# --- exclusions -----------------------------------------------------------------

_JUDGED = f"""WITH {_FIRST}, j AS (SELECT f.*, (SELECT MIN(r.ordinal) FROM rules r WHERE lower(f.source_catalog) GLOB lower(r.catalog)
 AND (r.exclude_type = 'catalog' OR lower(f.source_schema) GLOB lower(r.schema_name))
 AND (r.exclude_type <> 'table' OR lower(f.source_table) GLOB lower(r.table_name))) AS rule_ordinal FROM f)"""
_RULE_TEXT = """CASE exclude_type WHEN 'catalog' THEN concat('catalog:', catalog) WHEN 'schema' THEN concat('schema:', catalog, '.', schema_name)
 ELSE concat('table:', catalog, '.', schema_name, '.', table_name) END"""


@query("C6, E3", f"{_JUDGED} SELECT ordinal, rule_ordinal FROM j")
def first_matching_rule(t):
    return E.first_rule(X.first_wins(t.selection), t.rules).select("ordinal", "rule_ordinal")


@query("C6", f"{_JUDGED} SELECT ordinal, {NAMES} FROM j WHERE rule_ordinal IS NULL")
def kept_tables(t):
    return E.apply_exclusions(X.first_wins(t.selection), t.rules)[0]


@query("C6", f"""
{_JUDGED} SELECT j.ordinal, exclude_type AS exclusion_type, {_RULE_TEXT} AS exclusion_rule FROM j JOIN rules r ON r.ordinal = rule_ordinal""")
def excluded_tables(t):
    return E.apply_exclusions(X.first_wins(t.selection), t.rules)[1].select("ordinal", "exclusion_type", "exclusion_rule")


# More rules than are put into the plan: one for every twentieth control row.
_MANY_RULES = f"""SELECT {KEY} + 10 AS ordinal, CASE WHEN {KEY} % 200 = 0 THEN 'table' ELSE 'schema' END AS exclude_type, source_catalog AS catalog,
 CASE WHEN {KEY} % 200 = 0 THEN source_schema ELSE concat(source_schema, '_none') END AS schema_name,
 CASE WHEN {KEY} % 400 = 0 THEN source_table ELSE concat('*_', CAST({KEY} % 1000 AS VARCHAR(32))) END AS table_name FROM control WHERE {KEY} % 20 = 0"""


@query("C6, E3", f"""
WITH {_FIRST}, m AS ({_MANY_RULES}), j AS (SELECT f.ordinal, MIN(m.ordinal) AS rule_ordinal FROM f LEFT JOIN m ON f.source_catalog = m.catalog
 AND f.source_schema = m.schema_name AND m.exclude_type = 'table' AND f.source_table GLOB m.table_name
 GROUP BY f.ordinal)
SELECT ordinal, rule_ordinal FROM j""")
def first_of_many_rules(t):
    many = t.spark.sql(_MANY_RULES.replace("FROM control", "FROM {c}"), c=t.control)
    return E.first_rule(X.first_wins(t.selection), many).select("ordinal", "rule_ordinal")


# Rules whose table pattern has no literal start: only an end, only a middle, or both behind other wildcards.
_OPEN_RULES = f"""SELECT {KEY} + 10 AS ordinal, CASE WHEN {KEY} % 5 = 0 THEN 'schema' ELSE 'table' END AS exclude_type, '*' AS catalog,
 CASE WHEN {KEY} % 5 = 0 THEN concat('*_', CAST({KEY} % 97 AS VARCHAR(32))) ELSE '*' END AS schema_name,
 CASE WHEN {KEY} % 5 = 1 THEN concat('*', CAST({KEY} AS VARCHAR(32)), '*') WHEN {KEY} % 5 = 2 THEN concat('?*_', CAST({KEY} % 1000 AS VARCHAR(32))) ELSE concat('*_', CAST({KEY} AS VARCHAR(32))) END AS table_name
 FROM control WHERE {KEY} % 40 < 5"""


@query("C6, E3", f"""
WITH {_FIRST}, m AS ({_OPEN_RULES}), j AS (SELECT f.ordinal, MIN(m.ordinal) AS rule_ordinal FROM f LEFT JOIN m
 ON f.source_schema GLOB m.schema_name AND (m.exclude_type = 'schema' OR f.source_table GLOB m.table_name) GROUP BY f.ordinal)
SELECT ordinal, rule_ordinal FROM j""")
def first_of_open_rules(t):
    rules = t.spark.sql(_OPEN_RULES.replace("FROM control", "FROM {c}"), c=t.control)
    return E.first_rule(X.first_wins(t.selection), rules).select("ordinal", "rule_ordinal")


@query("C13", f"""
{_JUDGED} SELECT COUNT(*) AS resolved, {count_if("rule_ordinal IS NULL AND ordinal % 50 <> 0")} AS onboarded, {count_if("rule_ordinal IS NOT NULL")} AS excluded,
 COUNT(*) = {count_if("rule_ordinal IS NULL AND ordinal % 50 <> 0")} + {count_if("rule_ordinal IS NOT NULL")} AS complete FROM j""")
def selection_coverage(t):
    selection = X.first_wins(t.selection)
    kept, excluded = E.apply_exclusions(selection, t.rules)
    return E.coverage(selection, kept.filter("ordinal % 50 <> 0"), excluded)


@query("C13", f"""
{_JUDGED} SELECT source_catalog, source_schema, source_table FROM j WHERE rule_ordinal IS NULL AND ordinal % 50 = 0""")
def uncovered_tables(t):
    selection = X.first_wins(t.selection)
    kept, excluded = E.apply_exclusions(selection, t.rules)
    return E.uncovered(selection, kept.filter("ordinal % 50 <> 0"), excluded)


def _log(t):
    _, excluded = E.apply_exclusions(X.first_wins(t.selection), t.rules)
    when = F.timestamp_seconds(F.col("ordinal") % 1000).cast("timestamp_ntz")
    return excluded.withColumns({"run_id": F.lit("r"), "batch_id": F.lit("b"), "excluded_at": when})


@query("F5", f"""
{_JUDGED} SELECT source_catalog, source_schema, source_table, exclude_type AS exclusion_type, {_RULE_TEXT} AS exclusion_rule,
 epoch_ms(0) + to_seconds(j.ordinal % 1000) AS excluded_at FROM j JOIN rules r ON r.ordinal = rule_ordinal
ORDER BY excluded_at DESC, source_catalog, source_schema, source_table LIMIT 1000""")
def latest_exclusions(t):
    cols = [*S.SOURCE_NAME, "exclusion_type", "exclusion_rule", "excluded_at"]
    return T.latest_exclusions(_log(t).select(*cols))


@query("D12", f"""
{_JUDGED} SELECT exclude_type AS exclusion_type, COUNT(*) AS n FROM j JOIN rules r ON r.ordinal = rule_ordinal GROUP BY 1""")
def exclusions_by_type(t):
    return T.exclusions_by_type(_log(t))


@query("A18", f"""
{_JUDGED} SELECT 'run-1' AS run_id, 'batch-x' AS batch_id, source_catalog, source_schema, source_table, exclude_type AS exclusion_type,
 {_RULE_TEXT} AS exclusion_rule FROM j JOIN rules r ON r.ordinal = rule_ordinal""")
def exclusion_log(t):
    stored = ST.StoredTables(t.spark, new_folder(t.spark, "stored"))
    stored.create()
    _, excluded = E.apply_exclusions(X.first_wins(t.selection), t.rules)
    stored.append("exclusion_log", ST.exclusion_rows(excluded, "run-1", "batch-x", F.current_timestamp()))
    return stored.read("exclusion_log").drop("excluded_at")


# --- gates ----------------------------------------------------------------------

_EFFECTIVE = """e AS (SELECT c.migration_id, c.source_catalog, c.source_schema, c.source_table, COALESCE(a.value, b.value, d.value) AS value,
 CASE WHEN a.value IS NOT NULL THEN 'TABLE' WHEN b.value IS NOT NULL THEN 'SCHEMA' WHEN d.value IS NOT NULL THEN 'CATALOG' END AS value_level FROM control c
 LEFT JOIN (SELECT * FROM settings WHERE level = 'TABLE' AND value <> 'INHERIT') a ON a.catalog = c.source_catalog AND a.schema_name = c.source_schema AND a.table_name = c.source_table
 LEFT JOIN (SELECT * FROM settings WHERE level = 'SCHEMA' AND value <> 'INHERIT') b ON b.catalog = c.source_catalog AND b.schema_name = c.source_schema
 LEFT JOIN (SELECT * FROM settings WHERE level = 'CATALOG' AND value <> 'INHERIT') d ON d.catalog = c.source_catalog),
g AS (SELECT *, COALESCE(value <> 'DISABLE', true) AS blocked, CASE value WHEN 'DISABLE' THEN '' WHEN 'ENABLE' THEN 'PREDICTIVE_OPTIMIZATION_ENABLED'
 ELSE 'PREDICTIVE_OPTIMIZATION_UNKNOWN' END AS gate_code FROM e)"""


@query("C11", f"""
WITH {_EFFECTIVE} SELECT migration_id, blocked, value, CASE WHEN value = 'ENABLE' THEN value_level END AS level,
 CASE WHEN value = 'ENABLE' THEN CASE value_level WHEN 'SCHEMA' THEN concat(source_catalog, '.', source_schema) WHEN 'CATALOG' THEN source_catalog END END AS source_name,
 gate_code, CASE value WHEN 'DISABLE' THEN 'Predictive optimization disabled.' WHEN 'ENABLE' THEN concat('Predictive optimization is ENABLED (',
  CASE value_level WHEN 'TABLE' THEN 'set directly on the table' WHEN 'SCHEMA' THEN concat('SCHEMA ', source_catalog, '.', source_schema)
  ELSE concat('CATALOG ', source_catalog) END, ') — disable it before migrating this source table.')
  ELSE 'Could not confirm predictive optimization is disabled.' END AS reason FROM g""")
def setting_gate(t):
    gated = G.setting_gate(t.control.select("migration_id", *S.SOURCE_NAME), t.settings)
    return gated.drop(*S.SOURCE_NAME)


@query("F8", f"""
WITH {_EFFECTIVE} SELECT concat(source_catalog, '.', source_schema, '.', source_table) AS table_fqn, gate_code FROM g WHERE blocked ORDER BY 1 LIMIT 10""")
def first_offenders(t):
    return G.first_offenders(G.setting_gate(t.control.select("migration_id", *S.SOURCE_NAME), t.settings))


@query("C12", """
SELECT s.ordinal, c.migration_id AS existing_id, c.status AS existing_status FROM selection s LEFT JOIN
 (SELECT * FROM control WHERE batch_id = 'batch-3') c USING (source_catalog, source_schema, source_table)""")
def already_settled(t):
    return G.already_settled(t.selection, t.control, "batch-3").select("ordinal", "existing_id", "existing_status")


@query("D27, B16", """
SELECT CASE WHEN s.size_in_bytes IS NULL THEN 'UNKNOWN' WHEN s.size_in_bytes < 10737418240 THEN 'SMALL' WHEN s.size_in_bytes < 107374182400 THEN 'MEDIUM'
 WHEN s.size_in_bytes < 1073741824000 THEN 'LARGE' ELSE 'XLARGE' END AS workload_class, COUNT(*) AS tables
FROM selection c LEFT JOIN source_stats s ON s.table_fqn = concat(c.source_catalog, '.', c.source_schema, '.', c.source_table) GROUP BY 1""")
def planned_class_counts(t):
    return G.class_counts(G.with_source_stats(t.selection, t.source_stats))
