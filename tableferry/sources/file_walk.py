"""Files below folders, listed by tasks.

Folders are listed level by level: the tasks of a job list the folders of one level, keep sums of the files they
meet and name the folders below, which the next job lists. Neither the driver nor a task holds the files of a table;
a row is written per folder and key. Levels are written to the shared folder, so a lost task is a few listings again.

Names that Spark's readers hide (a leading "." or "_" without "=") are left out, files and folders alike.
Paths are opened by ``pyarrow.fs``: local, HDFS, S3, GCS and ABFS.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import new_folder

# Folders a task lists; their number decides how many tasks a level has.
FOLDERS_PER_TASK = 64
MAX_TASKS = 4096

_ROWS = "key string, folder string, num_files long, size_in_bytes long, last_modified timestamp"
_KINDS = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.timestamp("us", tz="UTC"))


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


class _Sums:
    """Files, bytes and latest change by key."""

    def __init__(self):
        self.by_key: dict = {}

    def add(self, key, info) -> None:
        n, size, last = self.by_key.get(key, (0, 0, None))
        at = info.mtime
        self.by_key[key] = n + 1, size + (info.size or 0), at if last is None or (at is not None and at > last) else last

    def rows(self) -> list[tuple]:
        return [(key, None, *sums) for key, sums in self.by_key.items()]


def _opened(path: str):
    """File system, path in it, and what to put before paths that it names.

    Paths are taken as they are, not as escaped URIs, as Spark takes them.
    """
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path, ""
    scheme, rest = path.split("://", 1)
    authority, _, tail = rest.partition("/")
    fs, base = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")
    base = base.rstrip("/")
    place = f"{scheme}://{authority}"
    return fs, f"{base}/{tail}", place[: len(place) - len(base)]


def _listed(batches):
    """Rows of one level: sums of the files met, and the folders below."""
    for batch in batches:
        rows = []
        for key, path in zip(batch.column("key").to_pylist(), batch.column("folder").to_pylist(), strict=True):
            fs, inner, head = _opened(path)
            sums = _Sums()
            found = fs.get_file_info(inner)
            if found.type == pafs.FileType.File:
                sums.add(found.base_name if key is None else key, found)
            elif found.type == pafs.FileType.Directory:
                for info in fs.get_file_info(pafs.FileSelector(inner)):
                    if _hidden(info.base_name):
                        continue
                    name = info.base_name if key is None else key
                    if info.type == pafs.FileType.Directory:
                        rows.append((name, head + info.path, None, None, None))
                    elif info.type == pafs.FileType.File:
                        sums.add(name, info)
            rows += sums.rows()
        if rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "folder", "num_files", "size_in_bytes", "last_modified"])


def folder_sums(folders: DataFrame) -> DataFrame:
    """(key, num_files, size_in_bytes, last_modified) of all files below the folders of each key.

    ``folders``: (key, folder); a folder may be a file. Where ``key`` is null, each entry of the folder is a key of its
    own, under its name. A key whose folders do not exist or hold no file gives no row; a null folder gives none either.
    """
    spark = folders.sparkSession
    level, levels = folders.select("key", "folder").where("folder IS NOT NULL").distinct(), []
    left = level.count()
    while left:
        path = new_folder(spark, "file-walk")
        tasks = min(MAX_TASKS, -(-left // FOLDERS_PER_TASK))
        level.repartition(tasks).mapInArrow(_listed, _ROWS).write.parquet(path)
        levels.append(path)
        level = spark.read.schema(_ROWS).parquet(path).where("folder IS NOT NULL").select("key", "folder")
        left = level.count()
    if not levels:
        return spark.createDataFrame([], _ROWS).drop("folder")
    # The rows of all levels are read by one scan.
    sums = spark.read.schema(_ROWS).parquet(*levels).where("folder IS NULL")
    return sums.groupBy("key").agg(
        F.sum("num_files").alias("num_files"), F.sum("size_in_bytes").alias("size_in_bytes"), F.max("last_modified").alias("last_modified")
    )


def entry_sums(spark: SparkSession, root: str) -> DataFrame:
    """``folder_sums`` of each entry of one folder, keyed by its name."""
    return folder_sums(spark.createDataFrame([(None, root)], "key string, folder string"))
