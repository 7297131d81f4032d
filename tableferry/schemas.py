"""Table schemas, status groups and limits shared by the whole library."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# States of a control row and the moves between them.
STATUSES = [
    "DISCOVERED", "ONBOARDED", "WAITING_FOR_LOAD", "QUEUED", "ASSIGNED", "IN_PROGRESS",
    "COMPLETED", "FAILED", "FAILED_PERMANENT", "RETRY_PENDING", "SKIPPED", "PO_BLOCKED",
    "VALIDATED", "VALIDATION_FAILED",
]
TRANSITIONS = [
    ("DISCOVERED", "ONBOARDED"),
    ("DISCOVERED", "FAILED_PERMANENT"),
    ("DISCOVERED", "SKIPPED"),
    ("ONBOARDED", "WAITING_FOR_LOAD"),
    ("WAITING_FOR_LOAD", "QUEUED"),
    ("QUEUED", "ASSIGNED"),
    ("QUEUED", "SKIPPED"),
    ("ASSIGNED", "IN_PROGRESS"),
    ("ASSIGNED", "QUEUED"),
    ("IN_PROGRESS", "COMPLETED"),
    ("IN_PROGRESS", "FAILED"),
    ("COMPLETED", "VALIDATED"),
    ("COMPLETED", "VALIDATION_FAILED"),
    ("FAILED", "RETRY_PENDING"),
    ("FAILED", "FAILED_PERMANENT"),
    ("RETRY_PENDING", "QUEUED"),
    ("VALIDATION_FAILED", "RETRY_PENDING"),
    ("VALIDATION_FAILED", "FAILED_PERMANENT"),
    ("FAILED_PERMANENT", "RETRY_PENDING"),
    ("FAILED_PERMANENT", "QUEUED"),
]
DONE = ["COMPLETED", "VALIDATED"]
FAILED = ["FAILED", "FAILED_PERMANENT", "VALIDATION_FAILED"]
ACTIVE = ["ASSIGNED", "IN_PROGRESS"]
OPEN = ["QUEUED", "ASSIGNED", "IN_PROGRESS"]
RETRYABLE = ["FAILED", "RETRY_PENDING", "VALIDATION_FAILED"]
TERMINAL = ["VALIDATED", "FAILED_PERMANENT", "SKIPPED", "PO_BLOCKED"]
# A batch that is run again leaves these alone unless it is forced.
SETTLED = ["COMPLETED", "VALIDATED", "FAILED_PERMANENT", "SKIPPED"]

# Error codes that a retry pass, and the copy worker, treat as final.
RETRY_PERMANENT_CODES = [
    "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "CATALOG_NOT_FOUND", "PERMISSION_DENIED",
    "DELTA_NOT_SUPPORTED", "NON_DELTA_SOURCE", "SOURCE_IS_VIEW", "FAILED_PERMANENT",
]
COPY_PERMANENT_CODES = [
    "TABLE_OR_VIEW_NOT_FOUND", "LOCATION_OVERLAP", "PERMISSION_DENIED", "ANALYSIS_EXCEPTION",
]

# Workload classes: name, upper size bound in bytes, weight.
GIB = 1024 ** 3
WORKLOAD_CLASSES = [
    ("SMALL", 10 * GIB, 1),
    ("MEDIUM", 100 * GIB, 3),
    ("LARGE", 1000 * GIB, 8),
    ("XLARGE", None, 20),
]
UNMEASURED_CLASS = ("UNKNOWN", 0)

# Schemas never selected when a whole catalog is expanded; a platform's own internal ones are passed on top.
DEFAULT_EXCLUDED_SCHEMAS = ["information_schema"]

# Text caps.
CODE_CHARS = 50
ERROR_CHARS = 500
MESSAGE_CHARS = 1000

# Share of passing tables each check needs for sign-off, in percent.
ACCEPTANCE_THRESHOLDS = [
    ("row_count_parity", 100.0),
    ("schema_match", 100.0),
    ("data_hash_integrity", 99.0),
    ("table_type_preserved", 100.0),
    ("partition_columns_match", 100.0),
    ("audit_log_completeness", 100.0),
    ("delta_table_valid", 100.0),
]

# Tolerances of the size and file-count checks, in percent.
SIZE_TOLERANCE_PCT = 1.0
FILE_TOLERANCE_PCT = 5.0
# --- end of fixed values ----------------------------------------------------

IDENTITY = ["source_catalog", "source_schema", "source_table", "batch_id"]
SOURCE_NAME = ["source_catalog", "source_schema", "source_table"]
TARGET_NAME = ["target_catalog", "target_schema", "target_table"]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """Schema of "name type, name type"; needs no session."""
    fields = [f.split(" ") for f in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SELECTION = _struct(
    "source_catalog string, source_schema string, source_table string, "
    "target_catalog string, target_schema string, target_table string, ordinal bigint"
)
MAPPING = _struct(
    "ordinal bigint, scope string, source_catalog string, source_schema string, "
    "source_table string, target_catalog string, target_schema string, target_table string, "
    "exclude_schemas array<string>, exclude_tables array<string>"
)
LISTING = _struct(
    "catalog string, schema_name string, table_name string, table_type string, "
    "is_temporary boolean, format string, location string"
)
RULES = _struct(
    "ordinal bigint, exclude_type string, catalog string, schema_name string, table_name string"
)
SETTINGS = _struct("level string, catalog string, schema_name string, table_name string, value string")
TABLE_STATS = _struct(
    "table_fqn string, location string, size_in_bytes bigint, num_files bigint, format string, "
    "last_modified timestamp"
)
CONTROL = _struct(
    "migration_id string, run_id string, clone_type string, source_workspace string, "
    "target_workspace string, source_catalog string, source_schema string, source_table string, "
    "target_catalog string, target_schema string, target_table string, batch_id string, "
    "chunk_id int, source_path string, size_in_bytes bigint, size_gb double, "
    "workload_class string, workload_weight int, assigned_cluster_id string, status string, "
    "attempt_number int, max_attempts int, discovered_at timestamp, onboarded_at timestamp, "
    "queued_at timestamp, started_at timestamp, completed_at timestamp, failed_at timestamp, "
    "duration_seconds bigint, error_code string, error_message string, source_num_files bigint, "
    "target_num_files bigint, source_version bigint, target_version bigint, "
    "validation_status string, validation_message string, created_at timestamp, "
    "updated_at timestamp, source_row_count bigint, target_row_count bigint"
)
ATTEMPTS = _struct(
    "run_id string, migration_id string, attempt_number int, cluster_id string, worker_id string, "
    "started_at timestamp, completed_at timestamp, status string, error_code string, "
    "error_message string, duration_seconds bigint, source_size_bytes bigint, "
    "target_size_bytes bigint, created_at timestamp"
)
VALIDATION_HISTORY = _struct(
    "run_id string, migration_id string, batch_id string, source_catalog string, "
    "source_schema string, source_table string, target_catalog string, target_schema string, "
    "target_table string, source_version bigint, target_version bigint, "
    "row_count_checked boolean, source_row_count bigint, target_row_count bigint, "
    "row_count_matched boolean, status string, message string, validated_at timestamp, "
    "created_at timestamp"
)
EXCLUSION_LOG = _struct(
    "run_id string, batch_id string, source_catalog string, source_schema string, "
    "source_table string, exclusion_type string, exclusion_rule string, excluded_at timestamp"
)
CHECK_REPORT = _struct(
    "execution_id string, validated_at timestamp, check_name string, table_name string, "
    "passed boolean, detail string"
)
REQUESTS = _struct(
    "onboarding_id string, request_name string, scope_mode string, clone_mode string, "
    "src_catalog string, src_schema string, src_table string, tgt_catalog string, "
    "tgt_schema string, priority int, status string, requested_by string, requested_at timestamp, "
    "scheduled_for timestamp, execution_id string, completed_at timestamp, validation_mode string, "
    "validation_columns string, count_tolerance_pct double, checksum_algorithm string, "
    "notes string, tags map<string,string>"
)
COPY_AUDIT = _struct(
    "execution_id string, onboarding_id string, batch_id string, batch_sequence int, "
    "retry_attempt int, run_timestamp timestamp, table_name string, src_catalog string, "
    "src_schema string, tgt_catalog string, tgt_schema string, table_type string, "
    "clone_mode string, src_location string, tgt_location string, records_cloned bigint, "
    "files_copied bigint, size_bytes bigint, throughput_mbps double, start_time timestamp, "
    "end_time timestamp, duration_seconds bigint, cluster_id string, status string, "
    "error_message string, validation_status string, validation_notes string"
)
LEDGER = _struct(
    "table_fqn string, version bigint, operation string, path string, source_fqn string, "
    "source_version bigint, num_files bigint, size_in_bytes bigint, committed_at timestamp, "
    "schema_json string, partition_columns array<string>"
)
# Parts of a version that was copied by parts: where each lies, and what tells whether it is the same as before.
PARTS = _struct("part string, folder string, row_count bigint, checksum string, num_files bigint, size_in_bytes bigint")
LEDGER.add("parts", T.ArrayType(PARTS))

# What a batch id may look like: it names a folder.
BATCH_ID = r"[A-Za-z0-9._-]+"

# What a dry run says of a table.
PLAN = _struct(
    "source_catalog string, source_schema string, source_table string, target_catalog string, target_schema string, target_table string, "
    "outcome string, blocked boolean, gate_code string, source_path string, size_in_bytes bigint, workload_class string"
)

# Stored tables and the column each is partitioned by.
STORED_TABLES = {
    "control": (CONTROL, ["batch_id"]),
    "attempts": (ATTEMPTS, []),
    "validation_history": (VALIDATION_HISTORY, ["batch_id"]),
    "exclusion_log": (EXCLUSION_LOG, ["batch_id"]),
    "check_report": (CHECK_REPORT, []),
}
