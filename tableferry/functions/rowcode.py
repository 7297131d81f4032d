"""Row encodings and hashes that are equal only for equal rows.

Each column is written as its length, a colon and its text, NULL as a bare dash, so that neither
a separator inside a value nor the place of a NULL can make two different rows read the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _canonical(col: Column, dtype: T.DataType) -> Column:
    """Text of a value, whatever its type; map entries are put in key order first."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.MapType):
        entry = lambda e: F.concat(
            _sized(_canonical(e["key"], dtype.keyType)), _sized(_canonical(e["value"], dtype.valueType))
        )
        return F.array_join(F.array_sort(F.transform(F.map_entries(col), entry)), "")
    if isinstance(dtype, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: _sized(_canonical(x, dtype.elementType))), "")
    if isinstance(dtype, T.StructType):
        parts = F.concat(*[_sized(_canonical(col[f.name], f.dataType)) for f in dtype.fields])
        return F.when(col.isNotNull(), parts)
    return col.cast("string")


def _sized(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def encoded(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Encoding of the given columns (all by default) of each row of ``df``."""
    names = list(columns) if columns else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(F.lit(""), *[_sized(_canonical(F.col(f"`{n}`"), types[n])) for n in names])


def row_md5(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.md5(encoded(df, columns))


def row_sha256(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.sha2(encoded(df, columns), 256)


def _hashable(col: Column, dtype: T.DataType) -> Column:
    """Maps have no order and cannot be hashed; their encoding can."""
    nested = isinstance(dtype, (T.MapType, T.ArrayType, T.StructType))
    return _canonical(col, dtype) if nested else col


def _hashed_parts(df: DataFrame, columns: Sequence[str] | None, as_text: Sequence[str] = ()) -> list[Column]:
    """What a row hash reads: the values, and a bit for each NULL, which xxHash64 would skip.

    A double also gives the sign of a zero.  Columns in ``as_text`` are read as their text.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    parts, nulls = [], []
    for name in columns or df.columns:
        col, dtype = F.col(f"`{name}`"), fields[name]
        nulls.append(col.isNull())
        if name in as_text:
            parts.append(_canonical(col, dtype))
            continue
        parts.append(_hashable(col, dtype))
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            # Only a zero is turned to text, to see its sign.
            parts.append((col == 0) & col.cast("string").startswith("-"))
    return [*parts, *nulls]


def row_words(df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "XXHASH64", as_text: Sequence[str] = ()) -> list[Column]:
    """Hash of each row as longs: one of xxHash64, or all 256 bits of SHA-256 in eight words of 32."""
    if algorithm.upper() == "SHA256":
        digest = row_sha256(df, columns)
        return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]
    if algorithm.upper() != "XXHASH64":
        raise ValueError(f"unknown checksum algorithm {algorithm!r}")
    return [F.xxhash64(*_hashed_parts(df, columns, as_text))]


def row_key(df: DataFrame, columns: Sequence[str] | None = None, as_text: Sequence[str] = ()) -> tuple[Column, Column]:
    """128 bits that tell rows apart: two xxHash64 chains that start from different values.

    Made in generated code from the columns as they are stored, with no text in between.
    """
    parts = _hashed_parts(df, columns, as_text)
    return F.xxhash64(*parts), F.xxhash64(F.lit(0x5EED), *parts)


def retyped(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns that the two frames hold in different types: their hashes have to be those of the text."""
    kinds = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    return [f.name for f in a.schema.fields if (columns is None or f.name in columns) and kinds.get(f.name) != f.dataType.simpleString()]


def exact_hash_sum(h: Column) -> Column:
    """Sum of 64-bit hashes as decimal(38,0), without overflow.

    The three limbs (21, 21 and the signed upper 22 bits) are summed as plain longs, so the
    aggregate stays in generated code; each holds for two trillion rows in a group.
    """
    mask = F.lit((1 << 21) - 1)
    low = F.sum(h.bitwiseAND(mask)).cast("decimal(38,0)")
    mid = F.sum(F.shiftrightunsigned(h, 21).bitwiseAND(mask)).cast("decimal(38,0)")
    top = F.sum(F.shiftright(h, 42)).cast("decimal(38,0)")
    joined = top * F.lit(1 << 42).cast("decimal(14,0)") + mid * F.lit(1 << 21).cast("decimal(8,0)") + low
    return joined.cast("decimal(38,0)")


def sampled(key: Column, percent: float) -> Column:
    """Is a row with this key in the sample?  Decided by its content, so equal rows of two tables agree.

    63 bits of the key are compared with the share, however small it is.
    """
    bound = min((1 << 63) - 1, int(percent / 100 * (1 << 63)))
    return F.shiftrightunsigned(key, 1) < F.lit(bound).cast("bigint")
