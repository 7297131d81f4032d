"""Session settings and shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library expects; a cluster may set sizes of its own on top.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Folder made for an application that names none.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can read, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run in this process, as in tests, a temporary folder is
    made, one per application. On a cluster executors would write to disks of their own, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it has to name a folder that all executors share")
        app = spark.sparkContext.applicationId
        folder = _own_folders.setdefault(app, "") or tempfile.mkdtemp(prefix="tableferry-")
        _own_folders[app] = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(df, purpose: str = "settled"):
    """Write a frame to the shared folder and read it back: cuts the plan, survives lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
