"""Is the target equal to the source?  Counts, checksums, profiles, schemas and row differences.

Comparisons of two tables are a tagged union and one aggregate, not a join of two aggregates: both
sides are combined in their tasks first and shuffled once, and however often one row is repeated
it leaves each task as a single row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import keybits as B
from tableferry.functions import measures as M
from tableferry.functions import rowcode as R
from tableferry.session import settle

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_UNORDERED = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


# --- counts -------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table; an empty one counts zero."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def paired_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows of source and target of each pair, side by side, with the row-count verdict."""
    source = row_counts({name: p[0] for name, p in pairs.items()})
    target = row_counts({name: p[1] for name, p in pairs.items()})
    sides = source.select("table_name", "row_count", F.lit(0).alias("other")).union(
        target.select("table_name", F.lit(0), F.col("row_count"))
    )
    return count_parity(
        sides.groupBy("table_name").agg(F.sum("row_count").alias("src_rows"), F.sum("other").alias("tgt_rows"))
    )


def count_parity(counts: DataFrame) -> DataFrame:
    """Verdict and text on (src_rows, tgt_rows); a difference is told with its sign."""
    s, t = F.col("src_rows"), F.col("tgt_rows")
    delta = t - s
    signed = F.concat(F.when(delta > 0, "+").otherwise(""), F.format_number(delta, 0))
    text = F.concat(F.lit("src="), F.format_number(s, 0), F.lit(" tgt="), F.format_number(t, 0))
    return counts.withColumns(
        {
            "passed": s == t,
            "detail": F.when(s == t, text).otherwise(F.concat(text, F.lit(" DELTA="), signed)),
        }
    )


# --- checksums ----------------------------------------------------------------


def checksum(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "XXHASH64",
    by: Sequence[str] = (),
) -> DataFrame:
    """Row count and sum of row hashes, over all rows or per value of ``by``; order never matters."""
    words = _named(R.row_words(df, columns, algorithm))
    return df.select(*by, *words).groupBy(*by).agg(F.count("*").alias("row_count"), _checksum([F.col(f"_h{i}") for i in range(len(words))]).alias("checksum"))


def _named(words: list[Column]) -> list[Column]:
    return [w.alias(f"_h{i}") for i, w in enumerate(words)]


def _checksum(words: list[Column]) -> Column:
    """Sums of the words of the row hashes; several are kept apart, in one text."""
    sums = [F.coalesce(R.exact_hash_sum(w), F.lit(0)).cast("decimal(38,0)") for w in words]
    return sums[0] if len(sums) == 1 else F.concat_ws(":", *[s.cast("string") for s in sums])


def common_columns(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """Columns to compare that both sides have, and those that the target lacks."""
    wanted, there = list(columns) if columns else source.columns, set(target.columns)
    return [c for c in wanted if c in there], [c for c in wanted if c not in there]


def compare_checksums(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str] | None = None,
    algorithm: str = "XXHASH64",
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts and checksums of both sides per value of ``by`` (one row without), with ``matched``.

    Columns that the target lacks are left out of the sums, and nothing matches then.
    """
    both_have, missing = common_columns(source, target, columns)
    # Columns of two types are compared by their text, as in the row comparison.
    as_text = R.retyped(source, target, both_have)
    side = lambda df, n: df.select(
        *by, F.lit(n).alias("_side"), *_named(R.row_words(df, both_have, algorithm, as_text))
    )
    both = side(source, 0).union(side(target, 1))
    names = both.columns[len(by) + 1 :]
    of = lambda n: [F.when(F.col("_side") == n, F.col(c)) for c in names]
    out = both.groupBy(*by).agg(
        F.count(of(0)[0]).alias("src_rows"),
        F.count(of(1)[0]).alias("tgt_rows"),
        _checksum(of(0)).alias("src_checksum"),
        _checksum(of(1)).alias("tgt_checksum"),
    )
    same = (F.col("src_rows") == F.col("tgt_rows")) & (F.col("src_checksum") == F.col("tgt_checksum"))
    return out.withColumn("matched", same & F.lit(not missing))


# --- row differences ----------------------------------------------------------


def hash_frequency(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each row occurs, by the MD5 of its encoding."""
    return df.select(R.row_md5(df, columns).alias("row_hash")).groupBy("row_hash").agg(F.count("*").alias("n"))


_KEY = ["hash_hi", "hash_lo"]
# So many keys that differ are sent to all tasks as they are, more of them as a bit map.
FEW_KEYS = 100_000
# Buckets of the row comparison that may be broadcast.
MOST_BUCKETS = 1 << 20


def _keyed(df: DataFrame, percent: float, columns: Sequence[str], as_text: Sequence[str], *extra: Column) -> DataFrame:
    hi, lo = R.row_key(df, columns, as_text)
    rows = df.select(hi.alias("hash_hi"), lo.alias("hash_lo"), *extra)
    return rows if percent >= 100 else rows.filter(R.sampled(F.col("hash_hi"), percent))


def _both_sides(source: DataFrame, target: DataFrame, percent: float, columns: Sequence[str] | None) -> DataFrame:
    columns, _ = common_columns(source, target, columns)
    as_text = R.retyped(source, target, columns)
    count = lambda n, name: F.lit(n).cast("bigint").alias(name)
    both = _keyed(source, percent, columns, as_text, count(1, "src"), count(0, "tgt")).union(
        _keyed(target, percent, columns, as_text, count(0, "src"), count(1, "tgt"))
    )
    return both.groupBy(*_KEY).agg(F.sum("src").alias("src_count"), F.sum("tgt").alias("tgt_count"))


def row_differences(
    source: DataFrame, target: DataFrame, percent: float = 100.0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Keys of rows that do not occur equally often on both sides, with how often they do.

    What is shuffled is a 128-bit key and two counts per distinct row of a task.  A sample is
    chosen by the content of the rows, so both sides choose the same ones.
    """
    return _both_sides(source, target, percent, columns).filter(F.col("src_count") != F.col("tgt_count"))


def differing_rows(source: DataFrame, target: DataFrame, percent: float = 100.0) -> DataFrame:
    """The rows themselves, each once, with how often either side has it.

    A second pass over both tables, joined to the keys that differ: few of them are broadcast, of many a bit map of fixed
    size, so that nothing but the differing rows, and a small share of others, is moved.
    """
    columns, _ = common_columns(source, target)
    as_text = R.retyped(source, target, columns)
    # Read by both sides: written once.
    found = settle(row_differences(source, target, percent), "differences")

    def side(df: DataFrame) -> DataFrame:
        return _keyed(df, percent, columns, as_text, *[F.col(f"`{c}`") for c in columns])

    rows = [side(source), side(target)]
    if found.count() <= FEW_KEYS:
        met = reduce(DataFrame.unionByName, rows).join(F.broadcast(found), _KEY)
    else:
        bits = settle(B.marked(found, "hash_hi"), "bits")
        met = reduce(DataFrame.unionByName, [B.only_marked(r, "hash_hi", bits) for r in rows]).join(found, _KEY)
    one = F.first(F.struct(*[F.col(f"`{c}`") for c in columns], "src_count", "tgt_count")).alias("row")
    return met.groupBy(*_KEY).agg(one).select("row.*")


# Rows taken in the first pass of a stratified sample, as a multiple of those wanted.
_SAMPLE_EXCESS = 4


def stratified_differences(source: DataFrame, target: DataFrame, by: Sequence[str], per_part: int = 100) -> DataFrame:
    """Sampled rows that do not occur equally often on both sides: part, ``row_hash``, src_count, tgt_count.

    The sample of a part is the ``per_part`` different rows, of either side, whose SHA-256 comes first; so every part is looked at,
    small ones wholly, and another engine can draw the same one. A first pass keeps the rows whose hash is below a bound made from the part's
    row count; only parts in which that leaves too few different rows are read whole, with equal rows counted in the tasks.
    """
    columns, _ = common_columns(source, target)
    parts = [f"part_{c}" for c in by]

    def side(df: DataFrame, src: int) -> DataFrame:
        counts = [F.lit(n).cast("bigint").alias(c) for n, c in ((src, "src_count"), (1 - src, "tgt_count"))]
        return df.select(*[F.col(c).alias(f"part_{c}") for c in by], R.row_sha256(df, columns).alias("row_hash"), *counts)

    both = side(source, 1).unionAll(side(target, 0))
    sizes = settle(both.groupBy(*parts).agg(F.count("*").alias("n")), "sizes")
    # Hashes are even over 60 bits, so a share of that range holds about that share of the different rows.
    whole = (1 << 60) - 1
    share = F.lit(float(_SAMPLE_EXCESS * per_part)) / F.col("n")
    bounds = sizes.withColumn("bound", F.when(share < 1, (share * float(1 << 60)).cast("bigint")).otherwise(whole))
    head = F.conv(F.substring("row_hash", 1, 15), 16, 10).cast("bigint")

    def same(some: DataFrame) -> DataFrame:
        return some.select(*[F.col(p).alias(f"of_{p}") for p in parts], *[c for c in some.columns if c not in parts])

    of_part = [F.col(p).eqNullSafe(F.col(f"of_{p}")) for p in parts]

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*parts, "row_hash").agg(F.sum("src_count").alias("src_count"), F.sum("tgt_count").alias("tgt_count"))

    first = settle(counted(both.join(same(bounds), of_part).filter(head <= F.col("bound"))), "sample")
    found = same(first.groupBy(*parts).agg(F.count("*").alias("found")))
    cut = bounds.filter(F.col("bound") < whole).join(found, of_part, "left").filter(F.coalesce("found", F.lit(0)) < per_part)
    short = same(settle(cut.select(*parts), "short"))
    sample = first.join(short, of_part, "left_anti").unionByName(counted(both.join(short, of_part, "left_semi")))
    ranked = sample.withColumn("rank", F.row_number().over(Window.partitionBy(*parts).orderBy("row_hash")))
    wrong = ranked.filter((F.col("rank") <= per_part) & (F.col("src_count") != F.col("tgt_count")))
    return wrong.select(*[F.col(p).alias(c) for p, c in zip(parts, by, strict=True)], "row_hash", "src_count", "tgt_count")


def differing_parts(
    source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Values of ``by`` whose checksums differ."""
    return compare_checksums(source, target, columns, by=by).filter(~F.col("matched")).select(*by)


def row_differences_by_part(
    source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``row_differences``, with the rows of equal parts left out before the shuffle.

    A first pass over the checksums per part shuffles a row per part; only rows of parts that
    differ are hashed again and shuffled.  Pays off on a copy that is right nearly everywhere.
    """
    # Read by both sides: written once.
    parts = settle(differing_parts(source, target, by, columns), "parts")
    named = parts.select(*[F.col(c).alias(f"_p_{c}") for c in by])
    equal = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in by])
    keep = lambda df: df.join(named, equal, "left_semi")
    return row_differences(keep(source), keep(target), columns=columns or source.columns)


def _bucketed(source: DataFrame, target: DataFrame, percent: float, buckets: int) -> DataFrame:
    """Keys of both sides, tagged 1 and -1, with a bucket taken from the key; ``buckets`` is a power of two."""
    if buckets & (buckets - 1):
        raise ValueError("the number of buckets has to be a power of two")
    if buckets > MOST_BUCKETS:
        raise ValueError(f"at most {MOST_BUCKETS} buckets: those that differ are broadcast")
    columns, _ = common_columns(source, target)
    as_text = R.retyped(source, target, columns)
    # A mask of the key is never NULL, so the join on it asks for no filter of its own.
    bucket = F.col("hash_hi").bitwiseAND(F.lit(buckets - 1).cast("bigint")).alias("bucket")

    def keys(df: DataFrame, sign: int) -> DataFrame:
        return _keyed(df, percent, columns, as_text).select("*", bucket, F.lit(sign).alias("side"))

    return keys(source, 1).union(keys(target, -1))


def _bucket_sums(both: DataFrame) -> DataFrame:
    of = lambda sign, c: F.when(F.col("side") == sign, F.col(c))
    total = lambda sign: F.coalesce(R.exact_hash_sum(of(sign, "hash_lo")), F.lit(0).cast("decimal(38,0)"))
    return both.groupBy("bucket").agg(
        F.count(of(1, "side")).alias("src_rows"),
        F.count(of(-1, "side")).alias("tgt_rows"),
        total(1).alias("src_sum"),
        total(-1).alias("tgt_sum"),
    )


def _differences_in(both: DataFrame, sums: DataFrame) -> DataFrame:
    wrong = sums.filter((F.col("src_rows") != F.col("tgt_rows")) | (F.col("src_sum") != F.col("tgt_sum"))).select("bucket")
    # At most one row per bucket: the broadcast cannot grow with the tables.
    left = both.join(F.broadcast(wrong), "bucket", "left_semi")
    count = lambda sign: F.count(F.when(F.col("side") == sign, 1))
    counts = left.groupBy(*_KEY).agg(count(1).alias("src_count"), count(-1).alias("tgt_count"))
    return counts.filter(F.col("src_count") != F.col("tgt_count"))


def row_differences_by_bucket(
    source: DataFrame, target: DataFrame, percent: float = 100.0, buckets: int = 4096
) -> DataFrame:
    """``row_differences`` that shuffles next to nothing where next to nothing is wrong.

    Rows fall in buckets by their key.  The first pass shuffles one sum per bucket and task.
    Buckets whose sums agree are done; the second pass shuffles the keys of the others only, and
    Spark leaves it out altogether when there are none.
    """
    both = _bucketed(source, target, percent, buckets)
    return _differences_in(both, settle(_bucket_sums(both), "sums"))


def integrity(source: DataFrame, target: DataFrame, percent: float = 100.0, buckets: int = 4096) -> DataFrame:
    """Verdict of the row comparison, one row; an empty source passes, a sample that holds no row of a full one does not."""
    both = _bucketed(source, target, percent, buckets)
    # Read twice, at most one row per bucket: written once.
    sums = settle(_bucket_sums(both), "sums")
    zero = F.lit(0).cast("bigint")
    rows = sums.agg(F.coalesce(F.sum("src_rows"), zero).alias("rows_sampled"), zero.alias("hash_mismatches"))
    wrong = _differences_in(both, sums).agg(zero.alias("rows_sampled"), F.count("*").alias("hash_mismatches"))
    totals = rows.unionByName(wrong).agg(
        F.sum("rows_sampled").alias("rows_sampled"), F.sum("hash_mismatches").alias("hash_mismatches")
    )
    _, missing = common_columns(source, target)
    none = F.col("rows_sampled") == 0
    # A sample may miss all rows of a table that has some; only a table without any needs no comparison.
    empty = percent >= 100 or source.isEmpty()
    # --- fixed values: texts of the verdicts
    text = F.concat(
        F.format_number("rows_sampled", 0), F.lit(" rows sampled, "), F.col("hash_mismatches"), F.lit(" hash mismatches")
    )
    skipped = "empty table — skip hash"
    # --- end of fixed values
    nothing = F.when(none & F.lit(empty), skipped).when(none, "no row of the table is in the sample")
    lacking = F.lit(f"missing in tgt: {', '.join(missing)}") if missing else F.lit(None).cast("string")
    clean = F.when(none, F.lit(empty)).otherwise(F.col("hash_mismatches") == 0)
    return totals.withColumns({"passed": clean & F.lit(not missing), "detail": F.coalesce(lacking, nothing, text)})


# --- schemas ------------------------------------------------------------------


def schema_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, type and place of every column of every table."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, f.name, f.dataType.simpleString(), i)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")


def schema_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of ``schema_rows`` that are missing, extra or of another type in the target."""
    s = source.select("table_name", "column_name", F.col("data_type").alias("src_type"))
    t = target.select("table_name", "column_name", F.col("data_type").alias("tgt_type"))
    kind = (
        F.when(F.col("tgt_type").isNull(), "missing")
        .when(F.col("src_type").isNull(), "extra")
        .when(F.col("src_type") != F.col("tgt_type"), "type_mismatch")
    )
    joined = s.join(t, ["table_name", "column_name"], "full_outer").withColumn("difference", kind)
    return joined.filter(F.col("difference").isNotNull())


def schema_match(source: DataFrame, target: DataFrame) -> DataFrame:
    """Schema verdict per table, with what is wrong in the text."""
    diff = schema_differences(source, target)

    def of(kind: str, text: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(F.col("difference") == kind, text))), ", ")

    retyped = F.concat("column_name", F.lit(": "), "src_type", F.lit(" -> "), "tgt_type")
    issues = diff.groupBy("table_name").agg(
        of("missing", F.col("column_name")).alias("missing"),
        of("extra", F.col("column_name")).alias("extra"),
        of("type_mismatch", retyped).alias("retyped"),
    )
    sizes = source.groupBy("table_name").agg(F.count("*").alias("columns"))
    part = lambda label, c: F.when(F.col(c) != "", F.concat(F.lit(label), F.col(c)))
    text = F.concat_ws(
        "; ", part("missing in tgt: ", "missing"), part("extra in tgt: ", "extra"), part("type mismatches: ", "retyped")
    )
    joined = sizes.join(issues, "table_name", "left")
    passed = F.col("missing").isNull()
    return joined.select(
        "table_name",
        passed.alias("passed"),
        F.when(passed, F.concat("columns", F.lit(" cols match"))).otherwise(text).alias("detail"),
    )


def column_sets(source: Column, target: Column) -> Column:
    """Of two arrays of column names: what only one has, and what both have."""
    return F.struct(
        F.sort_array(F.array_except(source, target)).alias("missing"),
        F.sort_array(F.array_except(target, source)).alias("extra"),
        F.sort_array(F.array_intersect(source, target)).alias("common"),
    )


MEAN_TOLERANCE = 1e-9


# --- profiles -----------------------------------------------------------------


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, NULL count, minimum, maximum and mean of each column, from one pass over the table."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns else df.columns
    none = F.lit(None)
    aggs: list[Column] = [F.count("*").alias("_rows")]
    rows = []
    for i, name in enumerate(names):
        c, dtype = F.col(f"`{name}`"), fields[name]
        ordered = not isinstance(dtype, _UNORDERED)
        aggs.append(F.count(c).alias(f"_n{i}"))
        if ordered:
            aggs += [F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}")]
        if isinstance(dtype, _NUMERIC):
            aggs.append(F.avg(c).cast("double").alias(f"_avg{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
                (F.col(f"_lo{i}") if ordered else none).cast("string").alias("min_value"),
                (F.col(f"_hi{i}") if ordered else none).cast("string").alias("max_value"),
                (F.col(f"_avg{i}") if isinstance(dtype, _NUMERIC) else none).cast("double").alias("avg_value"),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def compare_profiles(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of two profiles side by side with ``matched``; means may differ by ``MEAN_TOLERANCE`` of their size."""
    measures = ["row_count", "null_count", "min_value", "max_value", "avg_value"]
    s = source.select("column_name", *[F.col(m).alias(f"src_{m}") for m in measures])
    t = target.select("column_name", *[F.col(m).alias(f"tgt_{m}") for m in measures])
    exact = [F.col(f"src_{m}").eqNullSafe(F.col(f"tgt_{m}")) for m in measures if m != "avg_value"]
    # The mean of doubles depends on the order in which they are added.
    a, b = F.col("src_avg_value"), F.col("tgt_avg_value")
    near = a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= MEAN_TOLERANCE * F.greatest(F.abs(a), F.abs(b)), F.lit(False))
    same = reduce(Column.__and__, [*exact, near])
    return s.join(t, "column_name", "full_outer").withColumn("matched", same)


# --- validation modes ---------------------------------------------------------

MODES = {
    "NONE": [],
    "COUNT": ["COUNT"],
    "CHECKSUM": ["CHECKSUM"],
    "COLUMN_SAMPLE": ["COLUMN_SAMPLE"],
    "ALL": ["COUNT", "CHECKSUM", "COLUMN_SAMPLE"],
}


def validate_copy(
    source: DataFrame,
    target: DataFrame,
    mode: str = "COUNT",
    columns: Sequence[str] | None = None,
    tolerance_pct: float = 0.0,
    algorithm: str = "XXHASH64",
) -> DataFrame:
    """Checks of a validation mode on one copy: a row (check_name, passed, detail) for each."""
    checks = []
    wanted = MODES[mode.upper()]
    if "COUNT" in wanted:
        counts = paired_counts({"copy": (source, target)})
        ok = M.within_tolerance(F.col("src_rows"), F.col("tgt_rows"), tolerance_pct)
        checks.append(counts.select(F.lit("COUNT").alias("check_name"), ok.alias("passed"), "detail"))
    if "CHECKSUM" in wanted:
        sums = compare_checksums(source, target, columns, algorithm)
        text = F.concat(F.lit("src="), "src_checksum", F.lit(" tgt="), "tgt_checksum")
        checks.append(sums.select(F.lit("CHECKSUM").alias("check_name"), F.col("matched").alias("passed"), text.alias("detail")))
    if "COLUMN_SAMPLE" in wanted:
        names = list(columns) if columns else source.columns
        compared = compare_profiles(profile(source, names), profile(target, common_columns(source, target, names)[0]))
        bad = F.sort_array(F.collect_list(F.when(~F.coalesce("matched", F.lit(False)), F.col("column_name"))))
        checks.append(
            compared.agg(bad.alias("bad")).select(
                F.lit("COLUMN_SAMPLE").alias("check_name"),
                (F.size("bad") == 0).alias("passed"),
                F.when(F.size("bad") == 0, "all columns match")
                .otherwise(F.concat(F.lit("columns differ: "), F.array_join("bad", ", ")))
                .alias("detail"),
            )
        )
    if not checks:
        return source.sparkSession.createDataFrame([], "check_name string, passed boolean, detail string")
    return reduce(DataFrame.unionByName, checks)
