"""Small helpers of the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import new_folder, settle

__all__ = ["LARGE_ROWS", "by_ids", "forget", "runs", "settle", "settled_at", "shuffle_width", "small_batches", "texts_of"]


# Parquet looks at what it holds after 100 rows at first, so rows of megabytes would make pages and row groups without a
# bound, and a page is held whole, off the heap too, by whoever writes or reads it. With these it looks after each row.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def settled_at(df: DataFrame, purpose: str, options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, with the writer's ``options``, and read again, and where it lies."""
    path = new_folder(df.sparkSession, purpose)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Remove a settled folder that no frame still in use reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, under their usual names; rows without a key are left out by no one."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


# Rows that go to a Python worker at once: texts are long, and a batch is held by the JVM and by the worker.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of Arrow batches for the session; a smaller bound that is set already stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# So many ids (8 bytes each) are sent to every task rather than joined by a shuffle of the texts.
BROADCAST_IDS = 2_000_000


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` whose doc_id is (left_semi) or is not (left_anti) among ``ids``, which are settled first.

    Their number is looked at: few are broadcast, many are joined.
    """
    ids = settle(ids.select("doc_id").where("doc_id IS NOT NULL"), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def runs(keys: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal neighbours: positions of their starts, and the length at the end."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.zeros(1, int)
