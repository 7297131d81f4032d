"""Frames derived from the given tables; the same SQL text feeds Spark and the DuckDB oracle.

``CTES`` maps a name to a SELECT over the given tables (and over other names in it).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

CTES = {
    "control": """
SELECT CAST(o_orderkey AS VARCHAR(32)) AS migration_id,
 concat('run-', CAST(o_custkey % 8 AS VARCHAR(32))) AS run_id,
 concat('batch-', CAST(o_custkey % 8 AS VARCHAR(32))) AS batch_id,
 CAST(o_orderkey % 40 + 1 AS INT) AS chunk_id,
 CASE WHEN o_orderkey % 5 = 0 THEN 'direct_adls' ELSE 'delta_share' END AS clone_type,
 concat('cat_', CAST(o_custkey % 3 AS VARCHAR(32))) AS source_catalog,
 concat('sch_', substr(o_orderpriority, 1, 1)) AS source_schema,
 concat(CASE WHEN o_orderkey % 11 = 0 THEN 'tmp_' WHEN o_orderkey % 13 = 0 THEN 'staging_' ELSE 't_' END,
        CAST(o_orderkey AS VARCHAR(32))) AS source_table,
 concat('tgt_', CAST(o_custkey % 3 AS VARCHAR(32))) AS target_catalog,
 concat('sch_', substr(o_orderpriority, 1, 1)) AS target_schema,
 concat('c_', CAST(o_orderkey AS VARCHAR(32))) AS target_table,
 CASE WHEN o_orderkey % 3 = 0 THEN concat('abfss://src@store/', CAST(o_orderkey AS VARCHAR(32))) END AS source_path,
 CAST(floor(o_totalprice * 1000000) AS BIGINT) AS size_in_bytes,
 CAST(o_orderkey % 50 AS BIGINT) AS source_num_files,
 CASE WHEN o_totalprice < 100000 THEN 'SMALL' WHEN o_totalprice < 250000 THEN 'MEDIUM' ELSE 'LARGE' END AS workload_class,
 CASE WHEN o_totalprice < 100000 THEN 1 WHEN o_totalprice < 250000 THEN 3 ELSE 8 END AS workload_weight,
 concat('cluster-', CAST(o_orderkey % 5 AS VARCHAR(32))) AS assigned_cluster_id,
 CASE WHEN o_orderkey % 20 < 9 THEN 'VALIDATED' WHEN o_orderkey % 20 < 12 THEN 'COMPLETED'
      WHEN o_orderkey % 20 < 14 THEN 'QUEUED' WHEN o_orderkey % 20 = 14 THEN 'ASSIGNED'
      WHEN o_orderkey % 20 = 15 THEN 'IN_PROGRESS' WHEN o_orderkey % 20 = 16 THEN 'FAILED'
      WHEN o_orderkey % 20 = 17 THEN 'RETRY_PENDING' WHEN o_orderkey % 20 = 18 THEN 'VALIDATION_FAILED'
      WHEN o_orderkey % 60 = 19 THEN 'FAILED_PERMANENT' WHEN o_orderkey % 60 = 39 THEN 'SKIPPED'
      ELSE 'PO_BLOCKED' END AS status,
 CAST(o_orderkey % 4 AS INT) AS attempt_number, 3 AS max_attempts,
 CASE WHEN o_orderkey % 20 >= 16 THEN CASE o_orderkey % 3 WHEN 0 THEN 'TABLE_OR_VIEW_NOT_FOUND'
      WHEN 1 THEN 'CLONE_FAILED' END END AS error_code,
 CASE WHEN o_orderkey % 20 >= 16 THEN concat('failed on ', CAST(o_orderkey AS VARCHAR(32))) END AS error_message,
 o_orderdate AS queued_at,
 o_orderdate AS started_at,
 CASE WHEN o_orderkey % 20 < 12 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) END AS completed_at,
 CASE WHEN o_orderkey % 20 >= 16 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) END AS failed_at,
 CASE WHEN o_orderkey % 20 < 12 THEN CAST(o_orderkey % 3600 AS BIGINT) END AS duration_seconds,
 CASE WHEN o_orderkey % 20 < 12 THEN CAST(o_orderkey % 45 AS BIGINT) END AS target_num_files,
 CAST(o_orderkey % 6 AS BIGINT) AS source_version,
 CASE WHEN o_orderkey % 20 < 12 THEN CAST(o_orderkey % 2 AS BIGINT) END AS target_version,
 CASE WHEN o_orderkey % 20 < 9 THEN 'VALIDATED' WHEN o_orderkey % 20 = 18 THEN 'VALIDATION_FAILED' END AS validation_status,
 CASE WHEN o_orderkey % 20 < 9 THEN 'all good' WHEN o_orderkey % 20 = 18 THEN 'rows differ' END AS validation_message,
 o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 100 AS INT) AS updated_at,
 CASE WHEN o_orderkey % 20 < 9 THEN CAST(o_custkey AS BIGINT) END AS source_row_count,
 CASE WHEN o_orderkey % 20 < 9 THEN CAST(o_custkey - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) END AS target_row_count
FROM orders""",
    "attempts": """
SELECT CAST(l_orderkey AS VARCHAR(32)) AS migration_id, l_linenumber AS attempt_number,
 concat('cluster-', CAST(l_suppkey % 5 AS VARCHAR(32))) AS cluster_id,
 CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CASE WHEN l_returnflag = 'R' THEN 'CLONE_FAILED' END AS error_code,
 CAST(floor(l_quantity) AS BIGINT) AS duration_seconds,
 CAST(floor(l_extendedprice * 1000) AS BIGINT) AS source_size_bytes,
 l_shipdate AS created_at
FROM lineitem""",
    "validation_history": """
SELECT CAST(event_id AS VARCHAR(32)) AS validation_id,
 CAST(event_id % 1000 + 1 AS VARCHAR(32)) AS migration_id, ts AS validated_at,
 event_id % 5 <> 0 AS row_count_checked,
 CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 5000 AS BIGINT) END AS source_row_count,
 CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 5000 + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS BIGINT) END AS target_row_count,
 CASE WHEN event_id % 5 <> 0 THEN event_id % 17 <> 0 END AS row_count_matched,
 CASE WHEN event_id % 5 <> 0 AND event_id % 17 = 0 THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END AS status
FROM events""",
    # The copy audit log: one row per line item, run by a handful of executions.
    "audit": """
SELECT concat('exec-', CAST(l_suppkey % 7 AS VARCHAR(32))) AS execution_id,
 concat('sch_', l_linestatus, '.t_', CAST(l_orderkey AS VARCHAR(32)), '_', CAST(l_linenumber AS VARCHAR(32))) AS table_name,
 'cat_src' AS src_catalog, concat('sch_', l_linestatus) AS src_schema,
 'cat_tgt' AS tgt_catalog, concat('sch_', l_linestatus) AS tgt_schema,
 CASE WHEN l_linenumber % 3 = 0 THEN 'EXTERNAL' WHEN l_linenumber % 7 = 0 THEN 'UNKNOWN' ELSE 'MANAGED' END AS table_type,
 'path_resolution' AS clone_mode,
 concat('cluster-', CAST(l_partkey % 5 AS VARCHAR(32))) AS cluster_id,
 CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CASE WHEN l_returnflag = 'R' THEN 'CLONE_FAILED' END AS error_message,
 CASE WHEN l_returnflag = 'R' THEN 'SKIPPED' WHEN l_partkey % 10 = 0 THEN 'FAIL' ELSE 'PASS' END AS validation_status,
 CAST(l_partkey AS BIGINT) AS records_cloned,
 CAST(floor(l_extendedprice * 1000) AS BIGINT) AS size_bytes,
 CAST(floor(l_quantity) AS BIGINT) AS duration_seconds,
 l_shipdate AS run_timestamp, l_shipdate AS start_time,
 l_shipdate + INTERVAL '1' HOUR * CAST(l_linenumber AS INT) AS end_time
FROM lineitem""",
    "requests": """
SELECT CAST(o_orderkey AS VARCHAR(32)) AS onboarding_id,
 concat('request ', CAST(o_orderkey AS VARCHAR(32))) AS request_name,
 CASE o_orderkey % 3 WHEN 0 THEN 'catalog' WHEN 1 THEN 'schema' ELSE 'table' END AS scope_mode,
 CASE WHEN o_orderkey % 2 = 0 THEN 'path_resolution' ELSE 'delta_share' END AS clone_mode,
 CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority,
 CASE o_orderkey % 5 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'COMPLETED' WHEN 3 THEN 'FAILED' ELSE 'SKIPPED' END AS status,
 concat('user', CAST(o_custkey % 20 AS VARCHAR(32))) AS requested_by,
 o_orderdate AS requested_at,
 CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL '1' HOUR * 24 * 365 END AS scheduled_for,
 CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN concat('req-', CAST(o_orderkey AS VARCHAR(32))) END AS execution_id,
 CASE WHEN o_orderkey % 5 IN (2, 3) THEN o_orderdate END AS completed_at,
 CASE WHEN o_orderkey % 2 = 0 THEN 'first run' END AS notes
FROM orders""",
    # Copies made for the requests, several per request.
    "request_audit": """
SELECT concat('req-', CAST(l_orderkey AS VARCHAR(32))) AS execution_id,
 concat('t_', CAST(l_orderkey AS VARCHAR(32)), '_', CAST(l_linenumber AS VARCHAR(32))) AS table_name,
 CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CASE WHEN l_returnflag = 'R' THEN 'CLONE_FAILED' END AS error_message
FROM lineitem""",
    "src_rows": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate,
 CAST(floor(l_quantity * 100) AS BIGINT) AS quantity_c
FROM lineitem""",
    "tgt_rows": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate,
 CAST(floor(l_quantity * 100) AS BIGINT) + CASE WHEN l_partkey % 101 = 0 THEN 1 ELSE 0 END AS quantity_c
FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 97 <> 0""",
    "rules": """
SELECT CAST(ordinal AS BIGINT) AS ordinal, exclude_type, catalog, schema_name, table_name
FROM (VALUES (1, 'schema', 'cat_0', 'sch_1', ''), (2, 'table', 'cat_*', 'sch_*', 'tmp_*'),
 (3, 'catalog', 'cat_2', '', ''), (4, 'table', 'cat_1', 'sch_3', 'staging_?*'))
 AS r(ordinal, exclude_type, catalog, schema_name, table_name)""",
    "settings": """
SELECT level, catalog, schema_name, CAST(NULL AS VARCHAR(32)) AS table_name, value FROM (VALUES
 ('CATALOG', 'cat_0', '', 'DISABLE'), ('CATALOG', 'cat_1', '', 'ENABLE'),
 ('SCHEMA', 'cat_1', 'sch_2', 'DISABLE'), ('SCHEMA', 'cat_0', 'sch_3', 'ENABLE'),
 ('SCHEMA', 'cat_0', 'sch_4', 'INHERIT')) AS s(level, catalog, schema_name, value)
UNION ALL
SELECT 'TABLE', source_catalog, source_schema, source_table,
 CASE CAST(migration_id AS BIGINT) % 3 WHEN 0 THEN 'ENABLE' WHEN 1 THEN 'DISABLE' ELSE 'INHERIT' END
FROM control WHERE CAST(migration_id AS BIGINT) % 17 = 0""",
    # What was selected: every control row's table, some of them selected a second time.
    "selection": """
SELECT CAST(migration_id AS BIGINT) AS ordinal, source_catalog, source_schema, source_table,
 target_catalog, target_schema, target_table FROM control
UNION ALL
SELECT CAST(migration_id AS BIGINT) + 1000000000, source_catalog, source_schema, source_table,
 target_catalog, target_schema, concat(target_table, '_again') FROM control WHERE CAST(migration_id AS BIGINT) % 4 = 0""",
    # The listing: the tables of the control rows, plus what no copy may take.
    "listing": """
SELECT source_catalog AS catalog, source_schema AS schema_name, source_table AS table_name,
 CASE WHEN CAST(migration_id AS BIGINT) % 9 = 0 THEN 'VIEW' WHEN CAST(migration_id AS BIGINT) % 6 = 0 THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type,
 CAST(migration_id AS BIGINT) % 31 = 0 AS is_temporary,
 CASE WHEN CAST(migration_id AS BIGINT) % 23 = 0 THEN 'csv' ELSE 'parquet' END AS format,
 concat('s3://bucket', CAST(CAST(migration_id AS BIGINT) % 4 AS VARCHAR(32)), '/', source_schema, '/', source_table) AS location
FROM control
UNION ALL
SELECT concat('cat_', CAST(c_custkey % 3 AS VARCHAR(32))), 'Information_Schema', concat('v_', CAST(c_custkey AS VARCHAR(32))),
 'MANAGED', false, 'parquet', concat('s3://meta/', CAST(c_custkey AS VARCHAR(32))) FROM customer""",
    "target_listing": """
SELECT target_catalog AS catalog, target_schema AS schema_name, target_table AS table_name,
 CASE WHEN CAST(migration_id AS BIGINT) % 6 = 0 THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type
FROM control WHERE CAST(migration_id AS BIGINT) % 8 <> 0""",
    "source_stats": """
SELECT concat(source_catalog, '.', source_schema, '.', source_table) AS table_fqn,
 concat('s3://bucket/', source_table) AS location, size_in_bytes, source_num_files AS num_files,
 CASE WHEN CAST(migration_id AS BIGINT) % 23 = 0 THEN 'csv' ELSE 'parquet' END AS format,
 updated_at AS last_modified, source_version AS version
FROM control WHERE CAST(migration_id AS BIGINT) % 29 <> 0""",
    "target_stats": """
SELECT concat(target_catalog, '.', target_schema, '.', target_table) AS table_fqn,
 concat('s3://target/', target_table) AS location,
 CASE WHEN CAST(migration_id AS BIGINT) % 10 = 0 THEN size_in_bytes - size_in_bytes % 1000 * 3 ELSE size_in_bytes END
  - CASE WHEN CAST(migration_id AS BIGINT) % 14 = 0 THEN 2000000000 ELSE 0 END AS size_in_bytes,
 CASE WHEN CAST(migration_id AS BIGINT) % 6 = 0 THEN source_num_files * 2 ELSE source_num_files END AS num_files,
 CASE WHEN CAST(migration_id AS BIGINT) % 37 = 0 THEN 'orc' ELSE 'parquet' END AS format,
 CASE WHEN CAST(migration_id AS BIGINT) % 41 <> 0 THEN updated_at END AS last_modified
FROM control WHERE CAST(migration_id AS BIGINT) % 8 <> 0""",
    # Row counts of the copied versions; some could not be taken.
    "counts": """
SELECT migration_id,
 CASE WHEN CAST(migration_id AS BIGINT) % 19 <> 0 THEN CAST(o_custkey AS BIGINT) END AS source_row_count,
 CASE WHEN CAST(migration_id AS BIGINT) % 19 <> 0 THEN CAST(o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 3 ELSE 0 END AS BIGINT) END AS target_row_count,
 CASE WHEN CAST(migration_id AS BIGINT) % 19 = 0 THEN 'timed out' END AS count_error
FROM control JOIN orders ON o_orderkey = CAST(migration_id AS BIGINT)""",
    # Results of copies, one row per table: some did not learn the source version.
    "finished": """
SELECT migration_id, CAST(MAX(duration_seconds) AS BIGINT) AS duration_seconds, CAST(COUNT(*) AS BIGINT) AS target_num_files,
 CAST(MAX(attempt_number) AS BIGINT) AS target_version,
 CASE WHEN COUNT(*) % 2 = 0 THEN CAST(MIN(attempt_number) + 10 AS BIGINT) END AS source_version FROM attempts GROUP BY migration_id""",
    "lost": """
SELECT migration_id, CASE COUNT(*) % 4 WHEN 0 THEN 'LOCATION_OVERLAP' WHEN 1 THEN 'CLONE_FAILED' WHEN 2 THEN 'SOCKET' END AS error_code,
 concat('lost after ', CAST(MAX(duration_seconds) AS VARCHAR(32))) AS error_message,
 CASE WHEN COUNT(*) % 3 <> 0 THEN CAST(MAX(duration_seconds) AS BIGINT) END AS duration_seconds FROM attempts GROUP BY migration_id""",
    "outcomes": """
SELECT migration_id, CASE WHEN source_row_count = target_row_count THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS status,
 concat('counted ', COALESCE(CAST(source_row_count AS VARCHAR(32)), 'nothing')) AS message, source_row_count,
 CASE WHEN CAST(migration_id AS BIGINT) % 3 <> 0 THEN target_row_count END AS target_row_count
FROM counts WHERE CAST(migration_id AS BIGINT) % 5 <> 0""",
    # Tables onboarded to batch-3: its own once more, and others that are new to it.
    "incoming": """
SELECT concat('new-', migration_id) AS migration_id, 'run-new' AS run_id, 'delta_share' AS clone_type,
 source_catalog, source_schema, source_table, 'batch-3' AS batch_id,
 target_catalog, target_schema, concat(target_table, '_moved') AS target_table,
 source_path, size_in_bytes * 2 AS size_in_bytes, workload_class, workload_weight, source_num_files, source_version + 1 AS source_version,
 5 AS max_attempts, 'SOME_CODE' AS error_code, concat('because of ', migration_id) AS error_message
FROM control WHERE batch_id = 'batch-3' OR CAST(migration_id AS BIGINT) % 7 = 0""",
    "ledger": """
SELECT concat('tgt.t_', CAST(l_orderkey AS VARCHAR(32))) AS table_fqn,
 CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS version,
 CASE WHEN l_returnflag = 'R' THEN 'RESTORE' ELSE 'COPY' END AS operation,
 concat('s3://target/t_', CAST(l_orderkey AS VARCHAR(32)), '/', CAST(l_linenumber AS VARCHAR(32))) AS path,
 concat('src.t_', CAST(l_orderkey AS VARCHAR(32))) AS source_fqn,
 CAST(l_linenumber AS BIGINT) AS source_version, CAST(floor(l_quantity) AS BIGINT) AS num_files,
 CAST(floor(l_extendedprice * 1000) AS BIGINT) AS size_in_bytes, l_shipdate AS committed_at
FROM lineitem""",
    # Check reports of all copies, as the post-copy checks leave them.
    "report": """
SELECT concat('exec-', CAST(l_suppkey % 7 AS VARCHAR(32))) AS execution_id,
 CASE l_linenumber % 7 WHEN 0 THEN 'row_count_parity' WHEN 1 THEN 'schema_match' WHEN 2 THEN 'data_hash_integrity'
  WHEN 3 THEN 'table_type_preserved' WHEN 4 THEN 'partition_columns_match' WHEN 5 THEN 'audit_log_completeness'
  ELSE 'delta_table_valid' END AS check_name,
 concat('t_', CAST(l_orderkey AS VARCHAR(32))) AS table_name,
 CASE WHEN l_linenumber % 7 = 3 THEN true ELSE l_partkey % 113 <> 0 END AS passed,
 concat('line ', CAST(l_linenumber AS VARCHAR(32))) AS detail
FROM lineitem""",
}
_READ = re.compile(r"\b(FROM|JOIN)\s+([a-z_]+)\b")


def _names_in(sql: str) -> list[str]:
    words = {m.group(2) for m in _READ.finditer(sql)}
    return [n for n in [*CTES, *TABLES] if n in words]


def cte_chain(body: str) -> str:
    """The body as one statement, with every fixture it names, in order, put before it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in _names_in(sql):
            if name in CTES and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = [f"{n} AS ({CTES[n]})" for n in needed]
    body = body.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return head + ",\n".join([*ctes, body.removeprefix(head)])
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body


class Fixtures:
    """The given tables and the derived frames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._made:
            return self._made[name]
        if name in TABLES:
            out = self.table(name)
        elif name in CTES:
            used = {n: getattr(self, n) for n in _names_in(CTES[name])}
            text = _as_parameters(CTES[name], used)
            out = self.spark.sql(text, **used)
        else:
            raise AttributeError(name)
        self._made[name] = out
        return out


def _as_parameters(sql: str, used: dict) -> str:
    """Names that are read from become frame parameters."""
    return _READ.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}" if m.group(2) in used else m.group(), sql)
