"""Versioned copies of tables: a folder per try and a ledger of what was committed.

Every try writes to a folder of its own, which only the ledger names: a copy that died halfway leaves nothing
that is ever read. A version of a table is claimed by creating a file, which one writer at most
can do on a file system with atomic creation such as HDFS; so two copies of one target get two versions.

The ledger is a commit log: a chunk of copies is measured by one listing and committed by one write, whatever the number of its
tables; its rows lie by a bucket of the table's name, and many commits are compacted into one. It keeps each
version's schema and partition columns, and reads go by them. Partition values
of text columns are stored behind a mark, so that an empty text stays apart from NULL.

A repeated copy may write only what changed: the rows of a table are cut into parts, by its partition columns or by a hash of
its keys, and the version's ledger row names the folder of every part with its rows and checksum. A part whose
checksum is that of the last version is named again and not written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tableferry import schemas as S
from tableferry.functions import rowcode
from tableferry.session import settle
from tableferry.sources import listing
from tableferry.sources.commit_log import ABANDONED_HOURS, CommitLog, create_once, file_system, names_in, remove

# Buckets of the ledger by table name.
LEDGER_BUCKETS = 16
# A version's parts are a list in its ledger row, and folders to list when it is read.
MOST_PARTS = 100_000


@dataclass(frozen=True)
class Staged:
    """A copy that is written and not yet committed."""

    target_fqn: str
    path: str
    source_fqn: str
    source_version: int | None
    schema_json: str
    partition_by: tuple[str, ...]
    operation: str


class SnapshotStore:
    """Tables under ``root/tables/<name>/<try>`` with the ledger in ``root/ledger``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        stored = StructType([*S.LEDGER.fields]).add("bucket", "integer")
        self._log = CommitLog(spark, f"{self.root}/ledger", stored, partition_by=["bucket"])

    def create(self) -> "SnapshotStore":
        """Kept for callers; a store without commits is an empty one."""
        return self

    def ledger(self) -> DataFrame:
        return self._log.read().drop("bucket")

    def folder(self, table_fqn: str, location: str | None = None) -> str:
        """A new folder for one try, qualified with its file system."""
        home = location.rstrip("/") if location else f"{self.root}/tables/{table_fqn.replace('.', '/')}"
        fs, path = file_system(self.spark, f"{home}/{uuid.uuid4().hex}")
        return fs.makeQualified(path).toString()

    def exists(self, table_fqn: str) -> bool:
        return not self._entries(table_fqn).isEmpty()

    def latest(self, table_fqn: str) -> tuple[int, str] | None:
        """Version and folder that "current" stands for: the last row the ledger got."""
        row = latest_versions(self._entries(table_fqn)).first()
        return (row["version"], row["path"]) if row else None

    def _entry(self, table_fqn: str, version: int | None = None) -> Row | None:
        entries = self._entries(table_fqn)
        if version is not None:
            entries = entries.filter(F.col("version") == version)
        return entries.orderBy(F.desc("version")).first()

    def read(self, table_fqn: str, version: int | None = None) -> DataFrame:
        """The table as of a version; without one as it is now."""
        row = self._entry(table_fqn, version)
        if row is None:
            raise ValueError(f"{table_fqn}: no version {'' if version is None else version} in the ledger")
        if row["parts"] is not None:
            return self._read_parts(row, [p["folder"] for p in row["parts"]])
        if row["schema_json"] is None:
            return self.spark.read.parquet(row["path"])
        schema = StructType.fromJson(json.loads(row["schema_json"]))
        marked = _marked(schema, row["partition_columns"] or [])
        files = self.spark.read.schema(schema).parquet(row["path"])
        return files.select(*[F.expr(f"substring(`{f.name}`, 2)").alias(f.name) if f.name in marked else F.col(f"`{f.name}`") for f in schema.fields])

    def _read_parts(self, row: Row, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(row["schema_json"]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def stage(
        self,
        source: DataFrame,
        target_fqn: str,
        source_fqn: str = "",
        source_version: int | None = None,
        partition_by: Sequence[str] = (),
        location: str | None = None,
        operation: str = "COPY",
    ) -> Staged:
        """Write a full copy to a folder of its own; ``commit`` makes it a version.

        The copy is one narrow job: tasks write what they read, nothing is shuffled, and the
        partition columns of the source stay those of the target.
        """
        path = self.folder(target_fqn, location)
        marked = _marked(source.schema, partition_by)
        stored = source.select(*[F.concat(F.lit(_MARK), F.col(f"`{c}`")).alias(c) if c in marked else F.col(f"`{c}`") for c in source.columns])
        stored.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
        return Staged(target_fqn, path, source_fqn, source_version, json.dumps(source.schema.jsonValue()), tuple(partition_by), operation)

    def copy(
        self,
        source: DataFrame,
        target_fqn: str,
        source_fqn: str = "",
        source_version: int | None = None,
        partition_by: Sequence[str] = (),
        location: str | None = None,
        operation: str = "COPY",
    ) -> int:
        """Write a full copy as the table's next version and commit it; gives the version."""
        return self.commit([self.stage(source, target_fqn, source_fqn, source_version, partition_by, location, operation)])[0]["version"]

    def commit(self, staged: Sequence[Staged]) -> list[Row]:
        """Make staged copies versions, all with one listing and one ledger commit.

        Gives a row per copy in their order: table_fqn, version, num_files, size_in_bytes, source_version.
        """
        if not staged:
            return []
        versions = self._claim_versions([s.target_fqn for s in staged])
        measured = self._measured([s.path for s in staged])
        rows = []
        for s, version in zip(staged, versions, strict=True):
            files, size = measured.get(_try_of(s.path), (0, 0))
            rows.append((s.target_fqn, version, s.operation, s.path, s.source_fqn, s.source_version, files, size, None, s.schema_json, list(s.partition_by), None))
        self._commit(self.spark.createDataFrame(rows, S.LEDGER).withColumn("committed_at", F.current_timestamp()))
        return [Row(table_fqn=r[0], version=r[1], num_files=r[6], size_in_bytes=r[7], source_version=r[5]) for r in rows]

    def _measured(self, folders: list[str]) -> dict[str, tuple[int, int]]:
        """Files and bytes under each of the folders of tries, from one listing; only sums come back."""
        of_try = F.regexp_extract("path", f".*/({_TRY})/", 1)
        sums = listing.data_files(self.spark, folders).groupBy(of_try.alias("try")).agg(F.count("*").alias("files"), F.sum("length").alias("size"))
        return {r["try"]: (r["files"], r["size"]) for r in sums.collect()}

    def copy_changed(
        self,
        source: DataFrame,
        target_fqn: str,
        source_fqn: str = "",
        source_version: int | None = None,
        partition_by: Sequence[str] = (),
        keys: Sequence[str] = (),
        parts: int = 64,
    ) -> int:
        """Commit the source as the next version, writing only the parts that the last version does not hold.

        Parts are the values of ``partition_by`` or else ``parts`` buckets of ``keys`` (all columns without keys). The source is
        read once for a count and two exact hash sums per part, and its changed parts once more to be written. A last
        version with other columns, types or parts shares nothing.
        """
        schema_json = json.dumps(source.schema.jsonValue())
        rows = source.withColumn(_PART, part_of(source, partition_by, keys, parts))
        first, second = rowcode.row_key(source)
        sums = rows.select(_PART, first.alias("a"), second.alias("b")).groupBy(_PART).agg(
            F.count("*").alias("row_count"), F.concat_ws(":", rowcode.exact_hash_sum(F.col("a")).cast("string"), rowcode.exact_hash_sum(F.col("b")).cast("string")).alias("checksum")
        )
        old = self._last_parts(target_fqn, schema_json)
        known = settle(sums.join(old, [_PART, "row_count", "checksum"], "left"), "parts")
        n = known.agg(F.count("*"), F.count("folder")).first()
        if n[0] > MOST_PARTS:
            raise ValueError(f"{target_fqn}: {n[0]} parts, more than the {MOST_PARTS} that one version may have")
        path = self.folder(target_fqn)
        measured = self.spark.createDataFrame([], f"{_PART} string, num_files bigint, size_in_bytes bigint")
        if n[1] < n[0]:
            # At most MOST_PARTS names of 32 characters.
            changed = F.broadcast(known.filter("folder IS NULL").select(_PART))
            fresh = rows.join(changed, _PART, "left_semi").select(*[F.col(f"`{c}`") for c in source.columns], _PART)
            fresh.hint("rebalance", _PART).write.mode("errorifexists").partitionBy(_PART).parquet(path)
            part = F.regexp_extract("path", f"/{_TRY}/{_PART}=([^/]+)/", 1)
            measured = listing.data_files(self.spark, path).groupBy(part.alias(_PART)).agg(F.count("*").alias("num_files"), F.sum("length").alias("size_in_bytes"))
        listed = known.join(measured.withColumnsRenamed({"num_files": "new_files", "size_in_bytes": "new_size"}), _PART, "left").select(
            F.struct(
                F.col(_PART).alias("part"),
                F.coalesce("folder", F.concat(F.lit(f"{path}/{_PART}="), F.col(_PART))).alias("folder"),
                "row_count",
                "checksum",
                F.coalesce("num_files", "new_files").alias("num_files"),
                F.coalesce("size_in_bytes", "new_size").alias("size_in_bytes"),
            ).alias("p")
        )
        version = self._claim_versions([target_fqn])[0]
        total = lambda c: F.coalesce(F.sum(f"p.{c}"), F.lit(0)).alias(c)
        row = listed.agg(F.sort_array(F.collect_list("p")).alias("parts"), total("num_files"), total("size_in_bytes")).select(
            F.lit(target_fqn).alias("table_fqn"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit("COPY_CHANGED").alias("operation"),
            F.lit(path).alias("path"),
            F.lit(source_fqn).alias("source_fqn"),
            F.lit(source_version).cast("bigint").alias("source_version"),
            "num_files",
            "size_in_bytes",
            F.current_timestamp().alias("committed_at"),
            F.lit(schema_json).alias("schema_json"),
            F.array(*[F.lit(c) for c in partition_by]).cast("array<string>").alias("partition_columns"),
            "parts",
        )
        self._commit(row)
        return version

    def _last_parts(self, table_fqn: str, schema_json: str) -> DataFrame:
        """Parts of the current version, if it has any and its schema is this one."""
        last = self._entries(table_fqn).groupBy("table_fqn").agg(F.max_by(F.struct("schema_json", "parts"), "version").alias("l"))
        parts = last.filter(F.col("l.schema_json") == schema_json).select(F.explode("l.parts").alias("p"))
        return parts.select(F.col("p.part").alias(_PART), "p.row_count", "p.checksum", "p.folder", "p.num_files", "p.size_in_bytes")

    def changes(self, table_fqn: str, before: int, after: int, keys: Sequence[str]) -> DataFrame:
        """What changed between two versions, by key: ``_change`` and the table's columns.

        ``insert`` and ``delete`` for keys that one version lacks, ``update_preimage`` and ``update_postimage`` for rows that
        differ. Rows that both versions hold equally often are no changes; a key with several rows gives as many images. Of versions that
        were copied by parts only the folders that they do not share are read. Rows with a null key pair like any others.
        """
        old, new = self._entry(table_fqn, before), self._entry(table_fqn, after)
        for version, row in ((before, old), (after, new)):
            if row is None:
                raise ValueError(f"{table_fqn}: no version {version} in the ledger")
        if old["schema_json"] != new["schema_json"]:
            raise ValueError(f"{table_fqn}: versions {before} and {after} have different columns")
        if old["parts"] is not None and new["parts"] is not None:
            mine, theirs = ([p["folder"] for p in r["parts"]] for r in (old, new))
            kept = set(mine) & set(theirs)
            sides = [self._read_parts(r, [f for f in fs if f not in kept]) for r, fs in ((old, mine), (new, theirs))]
        else:
            sides = [self.read(table_fqn, v) for v in (before, after)]
        return row_changes(*sides, keys)

    def restore(self, table_fqn: str, version: int) -> int:
        """Make an earlier version current again; the ledger gains a row, no data moves."""
        back = self._entries(table_fqn).filter(F.col("version") == version)
        if back.isEmpty():
            raise ValueError(f"{table_fqn}: no version {version} to restore")
        new = self._claim_versions([table_fqn])[0]
        row = back.limit(1).withColumn("version", F.lit(new).cast("bigint"))
        row = row.withColumn("operation", F.lit("RESTORE")).withColumn("committed_at", F.current_timestamp())
        self._commit(row.withColumn("source_version", F.lit(version).cast("bigint")))
        return new

    def expire(self, keep_versions: int = 1) -> None:
        """Take all but the last versions of every table off the ledger; ``vacuum`` removes what they alone named.

        To be run while nothing is copied: a commit that is under way fails, and can be tried again.
        """
        rows = self._log.read()
        # Numbers are given in order, but not without gaps: the n-th last is found in the sorted list of a table's versions.
        kept = rows.groupBy("table_fqn").agg(F.element_at(F.slice(F.sort_array(F.collect_list("version"), asc=False), 1, keep_versions), -1).alias("least"))
        self._log.replace(rows.join(kept, "table_fqn").filter(F.col("version") >= F.col("least")))

    def vacuum(self, older_than_hours: float = ABANDONED_HOURS) -> int:
        """Remove folders under ``root/tables`` that no version of the ledger names, if nothing in them is young; gives their number.

        The files are listed and joined to the ledger's folders by Spark; only the names of dead folders come to the driver, one after the other.
        """
        home = f"{self.root}/tables"
        if not names_in(self.spark, home):
            return 0
        entries = self.ledger()
        named = entries.select(F.explode(folders_of()).alias("folder")).distinct()
        folder = F.regexp_extract("path", f"^(.*/{_TRY}(?:/{_PART}=[^/]+)?)/", 1)
        there = listing.data_files(self.spark, home).groupBy(folder.alias("folder")).agg(F.max("modificationTime").alias("at"))
        old = F.unix_timestamp("at") <= F.unix_timestamp(F.current_timestamp()) - int(3600 * older_than_hours)
        plain = listing.plain_path
        dead = there.filter(old & (F.col("folder") != "")).join(named.select(plain(F.col("folder")).alias("live")), plain(F.col("folder")) == F.col("live"), "left_anti")
        gone = 0
        for r in settle(dead.select("folder"), "dead").toLocalIterator():
            remove(self.spark, r["folder"])
            gone += 1
        self._log.vacuum(older_than_hours)
        return gone

    def _entries(self, table_fqn: str) -> DataFrame:
        return self._log.read().filter((F.col("bucket") == _bucket(F.lit(table_fqn))) & (F.col("table_fqn") == table_fqn)).drop("bucket")

    def _claim_versions(self, tables: list[str]) -> list[int]:
        """The first version of each after the last that no other writer has claimed; one look at the ledger for all."""
        asked = self.spark.createDataFrame([(t,) for t in set(tables)], "table_fqn string")
        # A chunk's names, no more than its cap.
        mine = self.ledger().join(F.broadcast(asked), "table_fqn", "left_semi")
        last = {r["table_fqn"]: r["last"] for r in mine.groupBy("table_fqn").agg(F.max("version").alias("last")).collect()}
        out = []
        for t in tables:
            version = last.get(t, -1) + 1
            while not create_once(self.spark, f"{self.root}/claims/{t}/{version}"):
                version += 1
            last[t] = version
            out.append(version)
        return out

    def partition_columns(self) -> DataFrame:
        """(table_fqn, partition_columns) of the current version of every table."""
        newest = F.max_by("partition_columns", "version").alias("partition_columns")
        return self.ledger().groupBy("table_fqn").agg(newest)

    def _commit(self, rows: DataFrame) -> None:
        """One commit of the ledger, whatever the number of its rows."""
        self._log.append(rows.select(*S.LEDGER.names).withColumn("bucket", _bucket(F.col("table_fqn"))).coalesce(1))


# Folders of tries, and the column and folder names of parts.
_TRY = "[0-9a-f]{32}"
_PART = "_part"


def _try_of(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[1]


def _bucket(table_fqn: Column) -> Column:
    return (F.crc32(table_fqn) % LEDGER_BUCKETS).cast("int")


def folders_of() -> Column:
    """Folders that hold the rows of a ledger row's version."""
    return F.when(F.col("parts").isNull(), F.array("path")).otherwise(F.transform("parts", lambda p: p["folder"]))


def part_of(source: DataFrame, partition_by: Sequence[str], keys: Sequence[str], parts: int) -> Column:
    """Name of the part a row belongs to, fit for a folder, different for different ways to cut a table."""
    if partition_by:
        return F.md5(F.concat(F.lit(f"by {len(partition_by)}:"), rowcode.encoded(source, partition_by)))
    columns = list(keys) or source.columns
    bucket = F.pmod(rowcode.row_key(source, columns)[0], F.lit(parts)).cast("string")
    return F.md5(F.concat(F.lit(f"of {parts} {','.join(columns)}:"), bucket))


def row_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of two states that differ, as changes by key (see ``SnapshotStore.changes``).

    Each side is reduced to counts per distinct row in its tasks; one shuffle by key follows, and equal rows cancel out.
    """
    columns = before.columns
    missing = [k for k in keys if k not in columns]
    if missing or not keys:
        raise ValueError(f"keys {list(keys)}: have to be columns of the table")

    def side(df: DataFrame, sign: int) -> DataFrame:
        whole, key = rowcode.row_key(df), rowcode.row_key(df, keys)
        return df.select(key[0].alias("k1"), key[1].alias("k2"), whole[0].alias("r1"), whole[1].alias("r2"), F.lit(sign).cast("bigint").alias("n"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))

    both = side(before, -1).unionAll(side(after.select(*[F.col(f"`{c}`") for c in columns]), 1))
    rows = both.groupBy("k1", "k2", "r1", "r2").agg(F.sum("n").alias("n"), F.any_value("row").alias("row")).filter("n <> 0")
    rows = settle(rows, "changes")
    # Which keys lost and gained rows: two numbers per changed key.
    of_key = rows.groupBy(F.col("k1").alias("a"), F.col("k2").alias("b")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    told = rows.join(of_key, (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")))
    updated = (F.col("least") < 0) & (F.col("most") > 0)
    change = F.when(updated & (F.col("n") < 0), "update_preimage").when(updated, "update_postimage").when(F.col("n") < 0, "delete").otherwise("insert")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("n")))
    return told.select(change.alias("_change"), times.alias("_copy"), "row").select("_change", *[F.col(f"row.`{c}`").alias(c) for c in columns])


# Stands before the partition values of text columns.
_MARK = "v"


def _marked(schema: StructType, partition_by: Sequence[str]) -> list[str]:
    return [f.name for f in schema.fields if f.name in partition_by and isinstance(f.dataType, StringType)]


def latest_versions(ledger: DataFrame) -> DataFrame:
    """Latest version of every table, with where it is and what it was copied from."""
    newest = F.max_by(F.struct("version", "operation", "path", "source_version", "num_files", "size_in_bytes"), "version")
    return ledger.groupBy("table_fqn").agg(newest.alias("newest")).select("table_fqn", "newest.*")


def copy_metrics(ledger: DataFrame) -> DataFrame:
    """What a finished copy reports back: files, bytes, version and the source version copied."""
    return latest_versions(ledger).select(
        "table_fqn",
        F.col("num_files").alias("target_num_files"),
        F.col("size_in_bytes").alias("target_size_bytes"),
        F.col("version").alias("target_version"),
        F.col("source_version").alias("source_version"),
    )


def copy_route(control: DataFrame, target_root: str = "", path_scheme: str = "abfss://") -> DataFrame:
    """How each table is read and where it goes.

    ``delta_share`` rows are read by name.  The others are read by path where they have one, with
    an explicit target location if a root for it is given, and by name where they have none.
    """
    by_path = (F.col("clone_type") != "delta_share") & F.coalesce(F.col("source_path").startswith(path_scheme), F.lit(False))
    root = target_root.rstrip("/")
    place = F.concat_ws("/", F.lit(root), F.lit("migration_data"), "target_schema", "target_table")
    name = F.concat_ws(".", *S.SOURCE_NAME)
    return control.select(
        "migration_id",
        F.when(F.col("clone_type") == "delta_share", "name")
        .when(by_path & F.lit(bool(root)), "path_and_location")
        .when(by_path, "path")
        .otherwise("name_fallback")
        .alias("route"),
        F.when(by_path, F.col("source_path")).otherwise(name).alias("source_ref"),
        F.when(by_path & F.lit(bool(root)), place).alias("target_location"),
    )
