"""Running totals of appended history, brought up to date by small streams that run until nothing is left.

A stream reads the folders of a history table as files come to them, and its checkpoint knows which it has seen. Each step
sums what is new by the roll-up's keys, in its tasks first, and writes the sums to a folder of the step's number; a file
made after that says that the folder is whole. A step that is tried again, as its driver was lost, reads the same
files and writes the same folder again, so every file counts once. Readers add up the sums of the whole steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.sources.commit_log import create_once, names_in


class RunningTotals:
    """Sums by key over a growing folder of Parquet files.

    ``keys`` and ``sums`` map names to expressions over ``schema``; sums are added up, so they have to be numbers per row.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, schema: T.StructType, keys: Mapping[str, Column], sums: Mapping[str, Column]):
        self.spark, self.root, self.source, self.schema = spark, root.rstrip("/"), source.rstrip("/"), schema
        self.keys, self.sums = dict(keys), dict(sums)

    def _summed(self, rows: DataFrame) -> DataFrame:
        named = rows.select(*[c.alias(n) for n, c in self.keys.items()], *[c.cast("bigint").alias(n) for n, c in self.sums.items()])
        return added(named, list(self.keys), list(self.sums))

    def advance(self) -> None:
        """Take in all that was appended since the last call."""
        if not names_in(self.spark, self.source):
            return
        files = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.source)

        def put(rows: DataFrame, step: int) -> None:
            self._summed(rows).write.mode("overwrite").parquet(f"{self.root}/sums/step={step}")
            create_once(self.spark, f"{self.root}/done/{step}")

        writer = files.writeStream.foreachBatch(put).option("checkpointLocation", f"{self.root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()

    def _steps(self) -> list[str]:
        """Folders of the whole steps."""
        return [f"{self.root}/sums/step={n}" for n in sorted(names_in(self.spark, f"{self.root}/done"), key=int)]

    def read(self) -> DataFrame:
        """Totals of all steps taken, one row per key."""
        fields = self._summed(self.spark.createDataFrame([], self.schema)).schema
        steps = self._steps()
        if not steps:
            return self.spark.createDataFrame([], fields)
        return added(self.spark.read.schema(fields).parquet(*steps), list(self.keys), list(self.sums))


def added(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in sums])


def attempts_by_day(spark: SparkSession, root: str, attempts: str, schema: T.StructType) -> RunningTotals:
    """Attempts, seconds and bytes of every day and outcome."""
    return RunningTotals(
        spark,
        root,
        attempts,
        schema,
        {"day": F.to_date("created_at"), "status": F.col("status")},
        {"attempts": F.lit(1), "seconds": F.col("duration_seconds"), "bytes": F.col("source_size_bytes")},
    )


def validations_by_status(spark: SparkSession, root: str, history: str, schema: T.StructType) -> RunningTotals:
    """Validations of every day and verdict, and how many of them compared row counts and found them equal."""
    matched = F.when(F.col("row_count_matched"), 1).otherwise(0)
    return RunningTotals(
        spark, root, history, schema, {"day": F.to_date("validated_at"), "status": F.col("status")}, {"validations": F.lit(1), "counted": F.when(F.col("row_count_checked"), 1).otherwise(0), "matched": matched}
    )
