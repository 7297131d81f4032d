"""What tables there are: catalog listings, file statistics and existence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import schemas as S
from tableferry.functions import names as N
from tableferry.sources import file_walk as W


def session_listing(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """Listing of the session's catalog with kind, format and location; one metadata call per schema.

    What the catalog says of a table is text, and is taken apart by Spark. A view has no format and no location.
    """
    catalog = catalog or spark.catalog.currentCatalog()
    found = []
    for db in spark.sql(f"SHOW SCHEMAS IN {_quoted(catalog)}").toLocalIterator():
        found.append(spark.sql(f"SHOW TABLE EXTENDED IN {_quoted(catalog)}.{_quoted(db[0])} LIKE '*'").withColumn("_schema", F.lit(db[0])))
    if not found:
        return spark.createDataFrame([], S.LISTING)
    told = lambda name: F.nullif(F.regexp_extract("information", rf"(?m)^{name}: *(.*?) *$", 1), F.lit(""))
    # Temporary views are told with every schema, without one of their own.
    rows = reduce(DataFrame.unionByName, found).withColumn("_kind", F.upper(told("Type")))
    return rows.select(
        F.lit(catalog).alias("catalog"),
        F.when(F.col("isTemporary"), F.coalesce(F.nullif("namespace", F.lit("")), F.lit(""))).otherwise(F.col("_schema")).alias("schema_name"),
        F.col("tableName").alias("table_name"),
        F.when(F.col("isTemporary"), "TEMPORARY").otherwise(F.col("_kind")).alias("table_type"),
        F.col("isTemporary").alias("is_temporary"),
        F.when(~F.col("isTemporary") & (F.col("_kind") != "VIEW"), F.lower(told("Provider"))).alias("format"),
        F.when(~F.col("isTemporary") & (F.col("_kind") != "VIEW"), told("Location")).alias("location"),
    ).distinct()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def folder_listing(spark: SparkSession, root: str, catalog: str, schema_name: str) -> DataFrame:
    """Listing of a folder whose entries are Parquet tables: one file or one folder each."""
    return (
        W.entry_sums(spark, root)
        .select(F.col("key").alias("table_name"))
        .select(
            F.lit(catalog).alias("catalog"),
            F.lit(schema_name).alias("schema_name"),
            F.regexp_replace("table_name", r"\.parquet$", "").alias("table_name"),
            F.lit("EXTERNAL").alias("table_type"),
            F.lit(False).alias("is_temporary"),
            F.lit("parquet").alias("format"),
            F.concat(F.lit(root.rstrip("/") + "/"), "table_name").alias("location"),
        )
    )


def data_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Path, length and time of every file under a folder, or under several; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", "modificationTime")


def folder_stats(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Size, file count and last change of each table folder under ``root``, listed by tasks."""
    return W.entry_sums(spark, root).select(
        F.concat(F.lit(prefix), F.regexp_replace("key", r"\.parquet$", "")).alias("table_fqn"),
        F.concat(F.lit(root.rstrip("/") + "/"), "key").alias("location"),
        "size_in_bytes",
        "num_files",
        F.lit("parquet").alias("format"),
        "last_modified",
    )


def located_stats(tables: DataFrame) -> DataFrame:
    """Size, file count and last change of tables (table_fqn, location), listed by tasks.

    Several locations of one table count together. A table without a location, or with no file there, has 0 files,
    NULL bytes (never measured) and NULL last change.
    """
    sums = W.folder_sums(tables.select(F.col("table_fqn").alias("key"), F.col("location").alias("folder")))
    named = tables.select("table_fqn").distinct().join(sums.withColumnRenamed("key", "table_fqn"), "table_fqn", "left")
    return named.select("table_fqn", "size_in_bytes", F.coalesce("num_files", F.lit(0)).cast("bigint").alias("num_files"), "last_modified")


def path_stats(spark: SparkSession, path: str) -> DataFrame:
    """Size and file count of the one table stored at ``path``, one row."""
    sums = W.folder_sums(spark.createDataFrame([("", path)], "key string, folder string"))
    return sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("num_files", "size_in_bytes")])


def folder_row_counts(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Rows in each of many Parquet folders, whatever their schemas, from one job.

    No column is read: the row counts come from the footers of the files, spread over the tasks.
    A folder that none of the files read lies in has no count, rather than one of 0.
    """
    files = spark.read.schema(T.StructType([])).option("recursiveFileLookup", "true").parquet(*folders)
    # File paths come URL-encoded and with their scheme.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    by_file = files.groupBy(plain_path(path).alias("file")).agg(F.count("*").alias("n"))
    # Files without rows are there as well.
    there = data_files(spark, list(folders)).select(plain_path(F.col("path")).alias("file"), F.lit(0).cast("bigint").alias("n"))
    by_file = by_file.unionAll(there)
    names = spark.createDataFrame([(f, _qualified(spark, f)) for f in folders], "path string, full string").distinct()
    # A file lies in every folder above it; the one asked for is found by equality.
    parts = F.split("file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    by_folder = by_file.select(F.explode(above).alias("folder"), "n").groupBy("folder").agg(F.sum("n").alias("n"))
    joined = names.join(by_folder, plain_path(F.col("full")) == F.col("folder"), "left")
    return joined.select("path", F.col("n").alias("row_count"))


def _qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its file system, as files read from it are named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def plain_path(path: Column) -> Column:
    """A path without the scheme of the local file system."""
    return F.regexp_replace(path, "^file:/*", "/")


def with_fqn(listing: DataFrame) -> DataFrame:
    return listing.withColumn("table_fqn", N.fqn("catalog", "schema_name", "table_name"))


def copyable(listing: DataFrame, only_tables: bool = True) -> DataFrame:
    """Permanent tables; views and foreign tables only when asked for."""
    kept = listing.filter(~F.coalesce("is_temporary", F.lit(False)))
    if only_tables:
        kept = kept.filter(F.upper("table_type").isin("MANAGED", "EXTERNAL"))
    return kept


def permanent_tables(listing: DataFrame) -> DataFrame:
    """Listings that cannot tell a view from a table only say what is temporary."""
    return listing.filter(~F.coalesce("is_temporary", F.lit(False)))


def external_tables(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("table_type") == "EXTERNAL").select(
        "catalog", "schema_name", "table_name", "table_type", "location"
    )


def of_format(listing: DataFrame, fmt: str = "parquet") -> DataFrame:
    return listing.filter(F.lower("format") == fmt)


def existing(df: DataFrame, listing: DataFrame, name_cols: list[str]) -> DataFrame:
    """Rows whose table is in the listing."""
    return _against(df, listing, name_cols, "left_semi")


def missing(df: DataFrame, listing: DataFrame, name_cols: list[str]) -> DataFrame:
    """Rows whose table is not in the listing."""
    return _against(df, listing, name_cols, "left_anti")


def _against(df: DataFrame, listing: DataFrame, name_cols: list[str], how: str) -> DataFrame:
    listed = ["catalog", "schema_name", "table_name"][: len(name_cols)]
    keys = listing.select(*[F.col(c).alias(n) for c, n in zip(listed, name_cols)])
    return df.join(keys, name_cols, how)


def requested_and_usable(requested: DataFrame, listing: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Requested tables that exist and have the right format; the rest is left out."""
    return existing(requested, of_format(listing, fmt), S.SOURCE_NAME)


def tables_per_schema(listing: DataFrame) -> DataFrame:
    return listing.groupBy("catalog", "schema_name").agg(F.count("*").alias("tables"))
