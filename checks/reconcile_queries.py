"""Reconciliation of a copy with known damage, and checks on many copies at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from tableferry.operators import checks as K
from tableferry.operators import reconcile as Q
from tableferry.operators import telemetry as T
from tableferry.sources import listing as L

COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "quantity_c",
]


def _sized(col: str) -> str:
    text = f"strftime({col}, '%Y-%m-%d %H:%M:%S')" if col == "l_shipdate" else f"CAST({col} AS VARCHAR)"
    return f"COALESCE(length({text}) || ':' || {text}, '-')"


ENCODED = f"concat({', '.join(_sized(c) for c in COLUMNS)})"

def _freq(cols: list[str] = COLUMNS, source: str = "src_rows", target: str = "tgt_rows") -> str:
    """SQL of the rows that do not occur equally often: whole rows are compared, nothing is hashed."""
    names = ", ".join(cols)
    return f"""b AS (SELECT {names}, 1 AS s, 0 AS g FROM {source} UNION ALL SELECT {names}, 0, 1 FROM {target}),
diff AS (SELECT {names}, CAST(SUM(s) AS BIGINT) AS src_count, CAST(SUM(g) AS BIGINT) AS tgt_count FROM b GROUP BY ALL HAVING SUM(s) <> SUM(g))"""


_BY_COUNTS = "SELECT src_count, tgt_count, COUNT(*) AS distinct_rows FROM diff GROUP BY 1, 2"


def _by_counts(differences):
    return differences.groupBy("src_count", "tgt_count").agg(F.count("*").alias("distinct_rows"))


@query("C8, J9", f"WITH {_freq()} SELECT * FROM diff")
def differing_rows(t):
    return Q.differing_rows(t.src_rows, t.tgt_rows)


@query("C8, J9", f"WITH {_freq()} {_BY_COUNTS}")
def row_differences(t):
    return _by_counts(Q.row_differences(t.src_rows, t.tgt_rows))


@query("C8, D20", f"WITH {_freq()} {_BY_COUNTS}")
def row_differences_by_part(t):
    return _by_counts(Q.row_differences_by_part(t.src_rows, t.tgt_rows, ["l_returnflag", "l_linestatus"]))


@query("C8, D20", f"WITH {_freq()} {_BY_COUNTS}")
def row_differences_by_bucket(t):
    return _by_counts(Q.row_differences_by_bucket(t.src_rows, t.tgt_rows))


_RAW = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"]
_DAMAGED = """g AS (SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
 CASE WHEN l_suppkey % 40 = 0 THEN '' ELSE l_linestatus END AS l_linestatus) FROM lineitem)"""


@query("C8", f"WITH {_DAMAGED}, {_freq(_RAW, 'lineitem', 'g')} SELECT * FROM diff")
def differing_line_items(t):
    damaged = t.lineitem.withColumns(
        {
            "l_quantity": F.when(F.col("l_partkey") % 50 != 0, F.col("l_quantity")),
            "l_linestatus": F.when(F.col("l_suppkey") % 40 == 0, "").otherwise(F.col("l_linestatus")),
        }
    )
    return Q.differing_rows(t.lineitem, damaged)


@query("J9", f"""
WITH {_freq()} SELECT (SELECT COUNT(*) FROM src_rows) AS rows_sampled, (SELECT COUNT(*) FROM diff) AS hash_mismatches,
 (SELECT COUNT(*) FROM diff) = 0 AS passed,
 concat(format('{{:,}}', (SELECT COUNT(*) FROM src_rows)), ' rows sampled, ', (SELECT COUNT(*) FROM diff), ' hash mismatches') AS detail""")
def integrity(t):
    return Q.integrity(t.src_rows, t.tgt_rows)


@query("J9")
def sampled_row_differences(t):
    return Q.row_differences(t.src_rows, t.tgt_rows, percent=5.0)


@query("J9", f"""
WITH b AS (SELECT l_returnflag, l_linestatus, sha256({ENCODED}) AS row_hash, 1 AS s, 0 AS g FROM src_rows
 UNION ALL SELECT l_returnflag, l_linestatus, sha256({ENCODED}), 0, 1 FROM tgt_rows),
c AS (SELECT l_returnflag, l_linestatus, row_hash, CAST(SUM(s) AS BIGINT) AS src_count, CAST(SUM(g) AS BIGINT) AS tgt_count FROM b GROUP BY ALL),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY row_hash) AS rk FROM c)
SELECT l_returnflag, l_linestatus, row_hash, src_count, tgt_count FROM r WHERE rk <= 200 AND src_count <> tgt_count""")
def stratified_sample_differences(t):
    return Q.stratified_differences(t.src_rows, t.tgt_rows, ["l_returnflag", "l_linestatus"], per_part=200)


@query("D22", f"SELECT md5({ENCODED}) AS row_hash, COUNT(*) AS n FROM src_rows GROUP BY 1")
def row_hash_frequency(t):
    return Q.hash_frequency(t.src_rows)


_SHA = f"CAST(concat('0x', substr(sha256({ENCODED}), 1, 15)) AS BIGINT)"
# Sums of the eight 32-bit words of the digests.
_SHA_SUMS = "concat_ws(':', " + ", ".join(f"CAST(SUM(CAST(concat('0x', substr(sha256({ENCODED}), {8 * i + 1}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(8)) + ")"


@query("D20", f"SELECT COUNT(*) AS row_count, {_SHA_SUMS} AS checksum FROM src_rows")
def checksum_sha256(t):
    out = Q.checksum(t.src_rows, algorithm="SHA256")
    return out.withColumn("checksum", F.col("checksum").cast("string"))


@query("D20", f"""
SELECT l_returnflag, l_linestatus, s.n AS src_rows, g.n AS tgt_rows, s.h = g.h AND s.n = g.n AS matched
FROM (SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM({_SHA}) AS h FROM src_rows GROUP BY 1, 2) s
FULL JOIN (SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM({_SHA}) AS h FROM tgt_rows GROUP BY 1, 2) g
USING (l_returnflag, l_linestatus)""")
def checksums_by_part(t):
    out = Q.compare_checksums(t.src_rows, t.tgt_rows, by=["l_returnflag", "l_linestatus"])
    return out.select("l_returnflag", "l_linestatus", "src_rows", "tgt_rows", "matched")


@query("D20", """
SELECT src_rows, tgt_rows, src_rows = tgt_rows AND same AS matched FROM (SELECT
 (SELECT COUNT(*) FROM src_rows) AS src_rows, (SELECT COUNT(*) FROM tgt_rows) AS tgt_rows,
 NOT EXISTS (SELECT l_orderkey, l_shipdate FROM src_rows EXCEPT ALL SELECT l_orderkey, l_shipdate FROM tgt_rows) AS same)""")
def checksum_of_columns(t):
    return Q.compare_checksums(t.src_rows, t.tgt_rows, ["l_orderkey", "l_shipdate"]).select("src_rows", "tgt_rows", "matched")


@query("D20", """
SELECT (SELECT COUNT(*) FROM lineitem) AS src_rows, (SELECT COUNT(*) FROM lineitem) AS tgt_rows, true AS matched""")
def checksum_ignores_order(t):
    # In as many tasks as the session makes for a table of this size: a fixed number would read more each, the larger it is.
    shuffled = t.lineitem.repartition("l_suppkey")
    return Q.compare_checksums(t.lineitem, shuffled).select("src_rows", "tgt_rows", "matched")


def _profile(col: str, numeric: bool, table: str = "src_rows") -> str:
    text = f"strftime({{}}({col}), '%Y-%m-%d %H:%M:%S')" if col == "l_shipdate" else f"CAST({{}}({col}) AS VARCHAR)"
    avg = f"CAST(AVG({col}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{col}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({col}) AS null_count,
 {text.format('MIN')} AS min_value, {text.format('MAX')} AS max_value, {avg} AS avg_value FROM {table}"""


_NUMERIC = {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "quantity_c"}


@query("D21", " UNION ALL ".join(_profile(c, c in _NUMERIC) for c in COLUMNS))
def column_profile(t):
    return Q.profile(t.src_rows)


def _profiles(table: str) -> str:
    return " UNION ALL ".join(_profile(c, c in _NUMERIC, table) for c in COLUMNS)


@query("D21, J15", f"""
SELECT column_name, s.row_count AS src_row_count, g.row_count AS tgt_row_count,
 s.row_count = g.row_count AND s.null_count = g.null_count AND s.min_value = g.min_value AND s.max_value = g.max_value
  AND s.avg_value IS NOT DISTINCT FROM g.avg_value AS matched
FROM ({_profiles("src_rows")}) s FULL JOIN ({_profiles("tgt_rows")}) g USING (column_name)""")
def compared_profiles(t):
    out = Q.compare_profiles(Q.profile(t.src_rows), Q.profile(t.tgt_rows))
    return out.select("column_name", "src_row_count", "tgt_row_count", "matched")


_ALL = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations"]


@query("D19, D29", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in _ALL))
def table_row_counts(t):
    return Q.row_counts({n: getattr(t, n) for n in _ALL})


@query("J14, G2, D19", """
WITH c AS (SELECT 'lineitem' AS table_name, (SELECT COUNT(*) FROM src_rows) AS src_rows, (SELECT COUNT(*) FROM tgt_rows) AS tgt_rows
 UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders)
 UNION ALL SELECT 'events', (SELECT COUNT(*) FROM events WHERE event_id % 3 = 0), (SELECT COUNT(*) FROM events))
SELECT table_name, src_rows, tgt_rows, src_rows = tgt_rows AS passed,
 concat('src=', format('{:,}', src_rows), ' tgt=', format('{:,}', tgt_rows), CASE WHEN src_rows = tgt_rows THEN ''
  ELSE concat(' DELTA=', CASE WHEN tgt_rows > src_rows THEN '+' ELSE '' END, format('{:,}', tgt_rows - src_rows)) END) AS detail
FROM c""")
def row_count_parity(t):
    return Q.paired_counts(
        {
            "lineitem": (t.src_rows, t.tgt_rows),
            "orders": (t.orders, t.orders),
            "events": (t.events.filter("event_id % 3 = 0"), t.events),
        }
    )


# --- schemas --------------------------------------------------------------------

_TYPE = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
 WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"""
_SCHEMAS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, column_name, {_TYPE} AS data_type FROM (DESCRIBE SELECT * FROM {n})" for n in _ALL
)
# The altered copies: keys turned to text, one column left out of each big table, one added to orders.
_ALTERED = f"""SELECT table_name, column_name, CASE WHEN column_name LIKE '%custkey' THEN 'string' ELSE data_type END AS data_type
 FROM ({_SCHEMAS}) WHERE column_name NOT IN ('l_tax', 'props', 'html') UNION ALL SELECT 'orders', 'o_comment', 'string'"""


def _altered(t):
    out = {}
    for n in _ALL:
        df = getattr(t, n).drop("l_tax", "props", "html")
        df = df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.endswith("custkey")})
        out[n] = df.withColumn("o_comment", F.lit("x")) if n == "orders" else df
    return out


_SDIFF = f"""d AS (SELECT table_name, column_name, s.data_type AS src_type, g.data_type AS tgt_type,
 CASE WHEN g.data_type IS NULL THEN 'missing' WHEN s.data_type IS NULL THEN 'extra' ELSE 'type_mismatch' END AS difference
 FROM ({_SCHEMAS}) s FULL JOIN ({_ALTERED}) g USING (table_name, column_name)
 WHERE s.data_type IS DISTINCT FROM g.data_type)"""


@query("C9, G3", f"WITH {_SDIFF} SELECT * FROM d")
def schema_differences(t):
    return Q.schema_differences(Q.schema_rows({n: getattr(t, n) for n in _ALL}), Q.schema_rows(_altered(t)))


@query("J8", f"""
WITH {_SDIFF}, n AS (SELECT table_name, COUNT(*) AS columns FROM ({_SCHEMAS}) GROUP BY 1),
i AS (SELECT table_name, string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE difference = 'missing') AS miss,
 string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE difference = 'extra') AS extra,
 string_agg(concat(column_name, ': ', src_type, ' -> ', tgt_type), ', ' ORDER BY column_name) FILTER (WHERE difference = 'type_mismatch') AS retyped
 FROM d GROUP BY table_name)
SELECT table_name, i.table_name IS NULL AS passed, CASE WHEN i.table_name IS NULL THEN concat(columns, ' cols match')
 ELSE concat_ws('; ', 'missing in tgt: ' || miss, 'extra in tgt: ' || extra, 'type mismatches: ' || retyped) END AS detail
FROM n LEFT JOIN i USING (table_name)""")
def schema_match(t):
    return Q.schema_match(Q.schema_rows({n: getattr(t, n) for n in _ALL}), Q.schema_rows(_altered(t)))


# --- checks on many copies ------------------------------------------------------

_SRC = "concat(source_catalog, '.', source_schema, '.', source_table)"
_TGT = "concat(target_catalog, '.', target_schema, '.', target_table)"


def _metric(name: str, s: str, g: str, tol: float) -> str:
    pct = f"abs({s} - {g}) / NULLIF({s}, 0)::DOUBLE * 100"
    return f"""CASE WHEN {s} = 0 THEN concat('{name} src=0 tgt=', {g}, CASE WHEN {g} = 0 THEN '' ELSE ' (target non-zero when source is 0)' END)
 ELSE concat('{name} src=', format('{{:,}}', {s}), ' tgt=', format('{{:,}}', {g}), ' diff=', printf('%.2f', {pct}), '% (tol={tol}%)',
 CASE WHEN {pct} <= {tol} THEN ' ✓' ELSE ' ✗ EXCEEDS TOLERANCE' END) END"""


def _ok(s: str, g: str, tol: float) -> str:
    return f"CASE WHEN {s} = 0 THEN {g} = 0 ELSE abs({s} - {g}) / {s}::DOUBLE * 100 <= {tol} END"


_VALIDATED = f"""r AS (SELECT * FROM control WHERE status = 'COMPLETED'),
j AS (SELECT r.*, s.table_fqn AS s_fqn, g.table_fqn AS g_fqn, s.size_in_bytes AS sb, g.size_in_bytes AS gb, s.num_files AS sf, g.num_files AS gf,
  g.format AS gfmt, g.last_modified AS gmod, c.source_row_count AS sn, c.target_row_count AS gn, c.count_error
 FROM r LEFT JOIN source_stats s ON s.table_fqn = {_SRC.replace("source_", "r.source_")}
 LEFT JOIN target_stats g ON g.table_fqn = {_TGT.replace("target_", "r.target_")} LEFT JOIN counts c ON c.migration_id = r.migration_id),
k AS (SELECT *, s_fqn IS NOT NULL AND g_fqn IS NOT NULL AS there,
 {_ok("sb", "gb", 1.0)} AS size_ok, sf = 0 AND gf = 0 OR {_ok("sf", "gf", 5.0)} AS files_ok, {_metric("size_bytes", "sb", "gb", 1.0)} AS size_text,
 CASE WHEN sf = 0 AND gf = 0 THEN 'Both source and target have 0 files (empty table)' ELSE {_metric("file_count", "sf", "gf", 5.0)} END AS files_text,
 concat(' (src@v', COALESCE(CAST(source_version AS VARCHAR), 'None'), ', tgt@v', COALESCE(CAST(target_version AS VARCHAR), 'None'), ')') AS note FROM j),
v AS (SELECT migration_id, there AS row_count_checked, CASE WHEN there THEN sn END AS source_row_count, CASE WHEN there THEN gn END AS target_row_count,
 CASE WHEN there THEN sn = gn END AS row_count_matched,
 CASE WHEN there AND COALESCE(sn = gn, false) THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS status,
 CASE WHEN s_fqn IS NULL THEN 'SOURCE_MISSING: source table not found after clone'
  WHEN g_fqn IS NULL THEN 'TARGET_MISSING: target table was not created' ELSE concat(
  '✓ source_exists: Source `', source_catalog, '`.`', source_schema, '`.`', source_table, '` exists | ',
  '✓ target_exists: Target `', target_catalog, '`.`', target_schema, '`.`', target_table, '` exists | ',
  CASE WHEN gfmt = 'parquet' THEN '✓ target_format: Target format=PARQUET' ELSE concat('✗ target_format: Target format=', upper(gfmt), ' (expected PARQUET)') END, ' | ',
  CASE WHEN size_ok THEN '✓' ELSE '✗' END, ' size_bytes: ', size_text, ' | ',
  CASE WHEN files_ok THEN '✓' ELSE '✗' END, ' file_count: ', files_text, ' | ',
  CASE WHEN gmod IS NOT NULL THEN '✓' ELSE '✗' END, ' delta_version_present: Target lastCommitTimestamp=', COALESCE(strftime(gmod, '%Y-%m-%d %H:%M:%S'), 'None'), ' | ',
  CASE WHEN COALESCE(sn = gn, false) THEN '✓' ELSE '✗' END, ' row_count: ', CASE WHEN sn IS NULL OR gn IS NULL THEN concat('row_count ERROR: ', COALESCE(count_error, 'no count'))
   ELSE concat('row_count src=', format('{{:,}}', sn), ' tgt=', format('{{:,}}', gn), note, CASE WHEN sn = gn THEN '' ELSE ' ✗ MISMATCH' END) END) END AS message
 FROM k)"""


def _validated(t):
    return K.validate(T.to_validate(t.control), t.source_stats, t.target_stats, t.counts)


@query("J1, J2, J3, J4, J5, J6, J7, C10", f"WITH {_VALIDATED} SELECT * FROM v")
def validation_verdicts(t):
    return _validated(t).select(
        "migration_id", "row_count_checked", "source_row_count", "target_row_count", "row_count_matched", "status", "message"
    )


@query("D23", f"""
WITH {_VALIDATED} SELECT COUNT(*) FILTER (WHERE status = 'VALIDATED') AS passed, COUNT(*) FILTER (WHERE status <> 'VALIDATED') AS failed,
 COUNT(*) FILTER (WHERE row_count_checked) AS row_count_checked, COUNT(*) FILTER (WHERE row_count_checked AND row_count_matched) AS row_count_matched,
 COUNT(*) FILTER (WHERE row_count_checked AND NOT row_count_matched) AS row_count_mismatched FROM v""")
def validation_totals(t):
    return K.validation_totals(_validated(t))


@query("J1", f"""
WITH {_VALIDATED} SELECT check_name, COUNT(*) AS checks, COUNT(*) FILTER (WHERE passed) AS passed FROM (
 SELECT 'source_exists' AS check_name, true AS passed FROM k WHERE there UNION ALL SELECT 'target_exists', true FROM k WHERE there
 UNION ALL SELECT 'target_format', gfmt = 'parquet' FROM k WHERE there UNION ALL SELECT 'size_bytes', size_ok FROM k WHERE there
 UNION ALL SELECT 'file_count', files_ok FROM k WHERE there UNION ALL SELECT 'delta_version_present', gmod IS NOT NULL FROM k WHERE there
 UNION ALL SELECT 'row_count', COALESCE(sn = gn, false) FROM k WHERE there) GROUP BY 1""")
def validation_checks(t):
    rows = K.check_rows(_validated(t))
    return rows.groupBy("check_name").agg(F.count("*").alias("checks"), F.count(F.when(F.col("passed"), 1)).alias("passed"))


@query("C14", """
SELECT migration_id, 'SOURCE' AS gone FROM control c WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.catalog = c.source_catalog
 AND l.schema_name = c.source_schema AND l.table_name = c.source_table AND l.table_type <> 'VIEW')
UNION ALL SELECT migration_id, 'TARGET' FROM control c WHERE NOT EXISTS (SELECT 1 FROM target_listing l
 WHERE l.catalog = c.target_catalog AND l.schema_name = c.target_schema AND l.table_name = c.target_table)""")
def missing_after_copy(t):
    source = L.missing(t.control, t.listing.filter("table_type <> 'VIEW'"), ["source_catalog", "source_schema", "source_table"])
    target = L.missing(t.control, t.target_listing, ["target_catalog", "target_schema", "target_table"])
    return source.select("migration_id", F.lit("SOURCE").alias("gone")).unionByName(
        target.select("migration_id", F.lit("TARGET").alias("gone"))
    )


@query("C15, J12", """
SELECT DISTINCT table_name FROM audit e WHERE execution_id = 'exec-3' AND status = 'SUCCESS' AND NOT EXISTS
 (SELECT 1 FROM audit a WHERE a.table_name = e.table_name AND a.records_cloned % 5 <> 0)""")
def without_audit_row(t):
    expected = K.expected_tables(t.audit, "exec-3").select("table_name").distinct()
    return K.without_audit_row(expected, t.audit.filter("records_cloned % 5 <> 0"))


@query("J12", """
WITH n AS (SELECT status, COUNT(*) AS n FROM audit WHERE execution_id = 'exec-4' GROUP BY status)
SELECT 'audit_log_completeness' AS check_name, 'execution_id=exec-4' AS table_name, SUM(n) > 0 AS passed,
 concat('total=', SUM(n), ' ', string_agg(concat(status, '=', n), ' | ' ORDER BY status)) AS detail FROM n""")
def audit_completeness(t):
    return K.audit_completeness(t.audit, "exec-4")


_EXPECTED = "(SELECT DISTINCT table_name, table_type FROM audit WHERE execution_id = 'exec-3' AND status = 'SUCCESS')"
# Types found on the target: the listing calls all lines above five external.
_FOUND = """(SELECT DISTINCT table_name, CASE WHEN CAST(split_part(table_name, '_', 4) AS INT) > 5 THEN 'external' ELSE 'managed' END AS table_type
 FROM audit WHERE records_cloned % 6 <> 0)"""


@query("J10", f"""
SELECT 'table_type_preserved' AS check_name, e.table_name, COALESCE(upper(f.table_type), 'UNKNOWN') = e.table_type OR e.table_type = 'UNKNOWN' AS passed,
 concat('expected=', e.table_type, ' actual=', COALESCE(upper(f.table_type), 'UNKNOWN')) AS detail
FROM {_EXPECTED} e LEFT JOIN {_FOUND} f USING (table_name)""")
def types_preserved(t):
    expected = K.expected_tables(t.audit, "exec-3").select("table_name", "table_type").distinct()
    line = F.split_part("table_name", F.lit("_"), F.lit(4)).cast("int")
    found = t.audit.filter("records_cloned % 6 <> 0").select(
        "table_name", F.when(line > 5, "external").otherwise("managed").alias("table_type")
    ).distinct()
    return K.type_preserved(expected, found)


@query("J11", """
SELECT 'partition_columns_match' AS check_name, migration_id AS table_name, k % 3 <> 0 AS passed,
 concat('src=[region, sale_date] tgt=', CASE WHEN k % 3 = 0 THEN '[sale_date]' ELSE '[region, sale_date]' END) AS detail
FROM (SELECT migration_id, CAST(migration_id AS BIGINT) AS k FROM control)""")
def partitions_match(t):
    k = F.col("migration_id").cast("bigint")
    name = F.col("migration_id").alias("table_name")
    source = t.control.select(name, F.array(F.lit("sale_date"), F.lit("region")).alias("partition_columns"))
    short = F.when(k % 3 == 0, F.array(F.lit("sale_date"))).otherwise(F.array(F.lit("region"), F.lit("sale_date")))
    return K.partitions_match(source, t.control.select(name, short.alias("partition_columns")))


@query("J13", """
SELECT 'delta_table_valid' AS check_name, e.table_name, op IS NOT NULL AS passed, concat('latest_op=', COALESCE(op, 'n/a')) AS detail
FROM (SELECT concat('tgt.t_', migration_id) AS table_name FROM control) e LEFT JOIN
 (SELECT table_fqn AS table_name, arg_max(operation, version) AS op FROM ledger GROUP BY 1) USING (table_name)""")
def has_history(t):
    expected = t.control.select(F.concat(F.lit("tgt.t_"), "migration_id").alias("table_name"))
    return K.has_history(expected, t.ledger)


_SHA_SUM = f"(SELECT {_SHA_SUMS} FROM {{}})"


@query("J15", f"""
WITH n AS (SELECT (SELECT COUNT(*) FROM src_rows) AS s, (SELECT COUNT(*) FROM tgt_rows) AS g),
h AS (SELECT {_SHA_SUM.format("src_rows")} AS s, {_SHA_SUM.format("tgt_rows")} AS g)
SELECT 'COUNT' AS check_name, abs(s - g) / s::DOUBLE * 100 <= 5.0 AS passed,
 concat('src=', format('{{:,}}', s), ' tgt=', format('{{:,}}', g), ' DELTA=', format('{{:,}}', g - s)) AS detail FROM n
UNION ALL SELECT 'CHECKSUM', s = g, concat('src=', s, ' tgt=', g) FROM h
UNION ALL SELECT 'COLUMN_SAMPLE', false, 'columns differ: {", ".join(sorted(COLUMNS))}'""")
def validation_mode_all(t):
    return Q.validate_copy(t.src_rows, t.tgt_rows, "ALL", tolerance_pct=5.0, algorithm="SHA256")


_DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


@query("C8", f"""
WITH g AS (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN concat(text, '.') ELSE text END AS text,
 CASE WHEN doc_id % 70 <> 0 THEN lang END AS lang, source, n_chars FROM documents), {_freq(_DOCS, 'documents', 'g')} SELECT * FROM diff""")
def differing_documents(t):
    damaged = t.documents.withColumns(
        {
            "text": F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")),
            "lang": F.when(F.col("doc_id") % 70 != 0, F.col("lang")),
        }
    )
    return Q.differing_rows(t.documents, damaged)


def _text_sized(col: str) -> str:
    return f"COALESCE(length(CAST({col} AS VARCHAR)) || ':' || CAST({col} AS VARCHAR), '-')"


@query("D22", f"SELECT md5(concat({', '.join(_text_sized(c) for c in _DOCS)})) AS row_hash, COUNT(*) AS n FROM documents GROUP BY 1")
def document_hash_frequency(t):
    return Q.hash_frequency(t.documents)


@query("D20, C8", """
SELECT (SELECT COUNT(*) FROM orders) AS src_rows, (SELECT COUNT(*) FROM orders) AS tgt_rows, true AS matched, CAST(0 AS BIGINT) AS differences""")
def retyped_columns_agree(t):
    """A column of another type with equal values: checksum and row comparison say the same."""
    wide = t.orders.select("o_orderkey", "o_custkey")
    other = wide.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    sums = Q.compare_checksums(wide, other).select("src_rows", "tgt_rows", "matched")
    return sums.withColumn("differences", F.lit(Q.row_differences(wide, other).count()).cast("bigint"))


@query("C8, J9", """
SELECT COUNT(*) AS rows_sampled, CAST(0 AS BIGINT) AS hash_mismatches, false AS passed, 'missing in tgt: o_totalprice' AS detail FROM orders""")
def missing_column_is_a_failure(t):
    return Q.integrity(t.orders, t.orders.drop("o_totalprice"))


@query("D21, J15", """
SELECT 'l_extendedprice' AS column_name, COUNT(*) AS src_row_count, COUNT(*) AS tgt_row_count, true AS matched FROM lineitem""")
def means_of_another_layout(t):
    """The mean of doubles, added up in two orders."""
    prices = t.lineitem.select(F.col("l_extendedprice").cast("double").alias("l_extendedprice"))
    other = prices.repartition(13).sortWithinPartitions("l_extendedprice")
    return Q.compare_profiles(Q.profile(prices), Q.profile(other)).select("column_name", "src_row_count", "tgt_row_count", "matched")
