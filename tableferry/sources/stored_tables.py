"""The stored control and history tables: create, widen, append, replace batches."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import schemas as S
from tableferry.functions import measures as M
from tableferry.session import settle
from tableferry.sources.commit_log import ABANDONED_HOURS, Commit, CommitLog, latest, names_in, read_commits, remove


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


class StoredTables:
    """Folder of Parquet tables, one per entry of ``schemas.STORED_TABLES``.

    Control rows lie in a commit log per batch: changed rows are appended, the latest of an id counts, and nothing of a
    half-written commit is ever seen. History rows lie in a folder per append, attempts by the batch they were made
    for. So runs of different batches write to folders of their own and never meet.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """Make the tables that are not there yet; running it again changes nothing."""
        for name, (schema, keys) in S.STORED_TABLES.items():
            if name != "control":
                empty = self.spark.createDataFrame([], schema)
                for c in _PATH_COLUMNS[name == "attempts"]:
                    empty = empty.withColumn(c, F.lit(""))
                empty.write.mode("append").partitionBy(*_PATH_COLUMNS[name == "attempts"], *keys).parquet(self.path(name))

    def _log(self, batch_id: str) -> CommitLog:
        if not re.fullmatch(S.BATCH_ID, batch_id or ""):
            raise ValueError(f"{batch_id!r}: a batch id is letters, digits, dots, dashes and underscores, as it names a folder")
        return CommitLog(self.spark, self.path("control"), _CONTROL, ["migration_id"], f"batch_id={batch_id}")

    def batches(self) -> list[str]:
        """Ids of the batches that were ever written."""
        return sorted(n.removeprefix("batch_id=") for n in names_in(self.spark, f"{self.path('control')}/commits"))

    def batch(self, batch_id: str) -> DataFrame:
        """Control rows of one batch; no other batch is looked at."""
        return self._control([batch_id])

    def _control(self, batches: list[str]) -> DataFrame:
        """The published control rows: one read of all folders in force, the batch being part of their path."""
        folders = [self._log(b).folders() for b in batches]
        of_batch = [T.StructField("batch_id", T.StringType())]
        rows = read_commits(self.spark, f"{self.path('control')}/rows", _CONTROL, [f for fs in folders for f in fs], of_batch)
        if any(len(fs) > 1 for fs in folders):
            rows = latest(rows, S.CONTROL.names, ["batch_id", "migration_id"])
        return rows.select(*S.CONTROL.names)

    def read(self, name: str) -> DataFrame:
        """The whole table; columns added since a file was written read as NULL."""
        if name == "control":
            return self._control(self.batches())
        schema, _ = S.STORED_TABLES[name]
        stored = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in _PATH_COLUMNS[name == "attempts"])])
        return self.spark.read.schema(stored).parquet(self.path(name)).select(*schema.names)

    def append(self, name: str, rows: DataFrame, batch_id: str = "") -> str:
        """Add rows to a history table, attempts under their batch; gives the folder."""
        schema, keys = S.STORED_TABLES[name]
        if name == "control":
            raise ValueError("control rows are written by batch, not appended")
        folder = f"{self.path(name)}/" + (f"of={batch_id or '-'}/" if name == "attempts" else "") + f"commit={uuid.uuid4().hex}"
        _by_partition(conform(rows, schema), keys).write.partitionBy(*keys).parquet(folder)
        return folder

    def appended(self, name: str, folders: list[str]) -> DataFrame:
        """The rows of some appends alone."""
        schema, _ = S.STORED_TABLES[name]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders).select(*schema.names)

    def update_batch(self, batch_id: str, rows: DataFrame) -> None:
        """Publish new and changed control rows of a batch; all others stay as they are."""
        self._log(batch_id).append(conform(rows, _CONTROL))

    def begin_update(self, batch_id: str, rows: DataFrame) -> Commit:
        """Write what ``finish_update`` will publish; a writer that dies in between has changed nothing."""
        return self._log(batch_id).begin(conform(rows, _CONTROL))

    def finish_update(self, batch_id: str, commit: Commit) -> None:
        self._log(batch_id).publish(commit)

    def compact_batch(self, batch_id: str) -> None:
        """One commit in place of a batch's many, which updates do from time to time by themselves."""
        self._log(batch_id).compact()

    def replace_batch(self, batch_id: str, rows: DataFrame) -> None:
        """Publish new control rows in place of all rows of a batch; they may come from the batch itself."""
        self._log(batch_id).replace(conform(rows, _CONTROL))

    def delete_batch(self, batch_id: str) -> None:
        """Drop a batch: its control rows by one published file, the attempts made for it by their folder. Others are not touched."""
        self._log(batch_id).replace(None)
        remove(self.spark, f"{self.path('attempts')}/of={batch_id}")

    def vacuum(self, older_than_hours: float = ABANDONED_HOURS) -> int:
        """Remove control rows that no published state needs any more, of all batches; gives the number of folders."""
        return sum(self._log(b).vacuum(older_than_hours) for b in self.batches())

    def replace_all(self, name: str, rows: DataFrame) -> None:
        """Put new rows in place of the whole table, while no run is writing to it."""
        schema, keys = S.STORED_TABLES[name]
        settled = settle(conform(rows, schema), name)
        if name == "control":
            found = {r[0] for r in settled.select("batch_id").distinct().toLocalIterator()}
            for b in sorted(found):
                self._log(b).replace(settled.filter(F.col("batch_id") == b))
            for b in set(self.batches()) - found:
                self._log(b).replace(None)
            return
        for c in _PATH_COLUMNS[name == "attempts"]:
            settled = settled.withColumn(c, F.lit("-" if c == "of" else uuid.uuid4().hex))
        keys = [*_PATH_COLUMNS[name == "attempts"], *keys]
        writer = _by_partition(settled, keys).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*keys).parquet(self.path(name))


# Columns of the paths of history tables, and of attempts.
_PATH_COLUMNS = (["commit"], ["of", "commit"])
_CONTROL = T.StructType([f for f in S.CONTROL.fields if f.name != "batch_id"])


def _by_partition(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of a partition together before the write, so that it gets few files.

    A rebalance, not a repartition: Spark cuts a partition that is large and joins small ones.
    """
    return rows.hint("rebalance", *keys) if keys else rows


def attempt_rows(attempts: DataFrame) -> DataFrame:
    """Attempt rows fit for the append: texts capped, numbers never NULL."""
    return conform(
        attempts.withColumn("error_code", M.capped(F.col("error_code"), S.CODE_CHARS))
        .withColumn("error_message", M.capped(F.col("error_message"), S.ERROR_CHARS))
        .withColumn("duration_seconds", F.coalesce("duration_seconds", F.lit(0)))
        .withColumn("source_size_bytes", F.coalesce("source_size_bytes", F.lit(0)))
        .withColumn("target_size_bytes", F.coalesce("target_size_bytes", F.lit(0))),
        S.ATTEMPTS,
    )


def validation_rows(outcomes: DataFrame, run_id: str, now) -> DataFrame:
    """Validation outcomes as history rows: one per table and pass, never changed again."""
    return conform(
        outcomes.withColumn("run_id", F.lit(run_id))
        .withColumn("message", M.capped(F.col("message"), S.MESSAGE_CHARS))
        .withColumn("validated_at", now)
        .withColumn("created_at", now),
        S.VALIDATION_HISTORY,
    )


def exclusion_rows(excluded: DataFrame, run_id: str, batch_id: str, now) -> DataFrame:
    """Excluded selections, each with the rule that matched it first."""
    return conform(
        excluded.withColumn("run_id", F.lit(run_id))
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("excluded_at", now),
        S.EXCLUSION_LOG,
    )


def report_rows(checks: DataFrame, execution_id: str, now) -> DataFrame:
    return conform(
        checks.withColumn("execution_id", F.lit(execution_id)).withColumn("validated_at", now),
        S.CHECK_REPORT,
    )
