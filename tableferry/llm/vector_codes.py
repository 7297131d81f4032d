"""Product codes of vectors, trained by active-entry Lloyd rounds in exact integers.

Components become ``floor(scale * x)``; every vector is cut into ``parts`` equal parts, and each part position
has a codebook of ``entries`` entries. A round assigns every part to its nearest entry (ties to the lower index)
and puts the floor of its parts' mean in each used entry's place. The assignment and its exact distance are kept
from round to round, next to the vector. A part whose entry did not move since is compared with the moved entries
alone, as all others are as far from it as before; a part whose entry moved is compared with all.

Spark moves a row of sums per part, entry, position and task in each round. The driver sees the codebooks and their sums
(parts * entries rows), never vectors. A round reads the last one's state from the shared folder and writes its own;
the state before is removed once the new one stands, so two are kept at most, and a lost executor repeats one round.

Vectors that are null, empty or hold a null or non-finite component are left out, and so are those
whose number of components is not the one of the smallest id's vector or is no multiple of ``parts``.
Rows of one id are told apart by their vectors' order when the first codebooks are chosen; null ids come last and are
coded like any other. With fewer rows than ``entries`` codebooks are shorter. No rows: no result. Components so large that a
distance may not fit a long end with ValueError, as no long could tell it. Columns not named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import forget, settled_at

# So many different labels (8 to 40 bytes each) are sent to every task; more are joined by a shuffle.
BROADCAST_LABELS = 500_000

STATE = "vec_id long, label {label}, vector array<int>, codes binary, far array<long>"


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vector): scaled down to integers, without rows that hold no whole finite vector."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = vectors.select("vec_id", F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    held = known.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    return held.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x)).alias("vector"))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lowest of equals, and its squared distance."""
    codes, far = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
    for e, entry in enumerate(book):
        d = ((x - entry) ** 2).sum(axis=1)
        better = d < far
        codes[better], far[better] = e, d[better]
    return codes, far


def renewed(x: np.ndarray, book: np.ndarray, moved: np.ndarray, codes: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, given the assignment to the last book and which entries have moved since."""
    codes, far = codes.copy(), far.copy()
    lost = moved[codes]
    held = np.flatnonzero(~lost)
    if len(held) and moved.any():
        part, c, d = x[held], codes[held], far[held]
        for e in np.flatnonzero(moved):
            new = ((part - book[e]) ** 2).sum(axis=1)
            better = (new < d) | ((new == d) & (e < c))
            c[better], d[better] = e, new[better]
        codes[held], far[held] = c, d
    if lost.any():
        codes[lost], far[lost] = nearest(x[lost], book)
    return codes, far


def _vectors_of(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("vector")).flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(batch.num_rows, parts, -1)


def _round(books: np.ndarray, moved: np.ndarray | None):
    """Map over batches of vectors (and their last assignments) to their new assignments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors_of(batch, parts)
            if moved is None:
                found = [nearest(x[:, p], books[p]) for p in range(parts)]
            else:
                old = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
                was = batch.column(4).flatten().to_numpy().reshape(-1, parts)
                found = [renewed(x[:, p], books[p], moved[p], old[:, p], was[:, p]) for p in range(parts)]
            codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            far = np.stack([d for _, d in found], axis=1)
            edges = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * parts)
            columns = [*batch.columns[:3], pa.array([c.tobytes() for c in codes], pa.binary()), pa.ListArray.from_arrays(edges, pa.array(far.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "codes", "far"])

    return run


def _sums(parts: int, entries: int, width: int):
    """A task's members and their component sums per part and entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors_of(batch, parts)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], x[:, p])
        p, e = np.nonzero(count)
        if len(p):
            q, r = np.repeat(np.arange(len(p)), width), np.tile(np.arange(width), len(p))
            columns = [p[q], e[q], r, count[p, e][q], total[p, e].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["part", "entry", "position", "n", "total"])

    return run


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries' new places: floors of their members' means; unused entries stay."""
    parts, entries, width = books.shape
    local = state.select("vector", "codes").mapInArrow(_sums(parts, entries, width), "part long, entry long, position long, n long, total long")
    new = books.copy()
    for r in local.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r.part, r.entry, r.position] = r.total // r.n
    return new


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def trained(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (parts, entries, width) and every vector's state: vec_id, label, vector, codes (a byte per part), far.

    ``vectors`` has vec_id, embedding and label. At most 256 entries, so that a code is a byte.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, scale)
    label = whole.schema["label"].dataType.simpleString()
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "vector").where(F.size("vector") % parts == 0).limit(1).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64), spark.createDataFrame([], STATE.format(label=label))
    size = len(first[0].vector)
    fit = whole.where(F.size("vector") == size)
    top = fit.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    if 4 * size * int(top) ** 2 >= 1 << 63:
        raise ValueError(f"components of {top} after scaling: squared distances may not fit a long")
    fit = fit.withColumn("vector", F.col("vector").cast("array<int>"))
    start = [r.vector for r in fit.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    schema = STATE.format(label=label)
    state, at = settled_at(fit.mapInArrow(_round(books, None), schema), "codes")
    for _ in range(rounds):
        new = _means(state, books)
        moved = (new != books).any(axis=2)
        if not moved.any():
            break  # the same books give the same assignment, in this round and all others
        books, old = new, at
        state, at = settled_at(state.mapInArrow(_round(books, moved), schema), "codes")
        forget(spark, old)
    return books, state


def encoded(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """Per vector: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256, label, codes.

    ``error``: squared distances summed over the parts; ``label_error``: errors summed over the rows of a label, null ones together.
    """
    books, state = trained(vectors, parts, entries, rounds, scale)
    one = state.select("vec_id", "label", "codes", F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    sums, _ = settled_at(one.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    joined = one.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"), "label", "codes")
