"""Document-term counts as shards of a sparse matrix, with words encoded by one dictionary of all texts.

A word is a longest run of characters other than U+0020 and U+0009 to U+000D, case kept. Tasks pack texts into shards
of about ``SHARD_BYTES``: rows in compressed form, columns numbered within the shard, and the shard's own vocabulary, dealt into
buckets by a checksum. Only vocabularies meet: a bucket's different words are numbered, the numbers go back to
their shards, and the columns are renumbered. A word that stands everywhere is sent once a shard, never once a document.

Null texts and texts without words are empty rows. A text is a row of one shard, however long. Repeated rows are rows of their own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from tableferry.llm.shared import LARGE_ROWS, settled_at, shuffle_width, small_batches

SHARD_BYTES = 8 << 20
# Text whose vocabulary entries make up a bucket on average; the number of buckets follows the input.
BUCKET_BYTES = 32 << 20

_SHARD = "shard long, facts array<struct<{facts}>>, row_ends array<int>, columns array<int>, counts array<int>, vocabulary array<struct<bucket:int, words:binary>>"
MATRIX = "shard long, facts array<struct<{facts}>>, row_ends array<int>, columns array<long>, counts array<int>"


class _Shard:
    """Rows gathered so far, over columns in order of appearance."""

    def __init__(self):
        self.column = defaultdict(count().__next__)
        self.facts, self.ends, self.columns, self.counts, self.bytes, self.entries = [], [], [], [], 0, 0

    def add(self, fact: tuple, text: bytes) -> None:
        words = text.split()  # bytes are split at exactly the six separators
        columns, counts = np.unique(np.fromiter(map(self.column.__getitem__, words), np.int32, len(words)), return_counts=True)
        self.facts.append(fact)
        self.entries += len(columns)
        self.ends.append(self.entries)
        self.columns.append(columns)
        self.counts.append(counts.astype(np.int32))
        self.bytes += len(text) + 64

    def batch(self, shard: int, buckets: int, schema: pa.Schema) -> pa.RecordBatch:
        dealt = defaultdict(list)
        for word in self.column:
            dealt[xxh32_intdigest(word) % buckets].append(word)
        order = [(b, sorted(dealt[b])) for b in sorted(dealt)]
        place = np.empty(len(self.column), np.int32)
        for k, word in enumerate(w for _, words in order for w in words):
            place[self.column[word]] = k
        row = {
            "shard": shard,
            "facts": self.facts,
            "row_ends": np.array(self.ends, np.int32),
            "columns": place[np.concatenate(self.columns)] if self.entries else np.empty(0, np.int32),
            "counts": np.concatenate(self.counts) if self.entries else np.empty(0, np.int32),
            "vocabulary": [{"bucket": b, "words": b" ".join(words)} for b, words in order],
        }
        return pa.RecordBatch.from_arrays([_cell(row[f.name], f.type) for f in schema], schema=schema)


def _cell(value, kind: pa.DataType) -> pa.Array:
    """A column of one row."""
    if isinstance(value, np.ndarray):
        return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), pa.array(value, kind.value_type))
    return pa.array([value], kind)


def _shards(buckets: int, schema: pa.Schema, fact: Callable[[bytes], tuple], kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        names = [f.name for f in schema.field("facts").type.value_type]
        shard = _Shard()
        for batch in batches:
            texts = batch.column(kept)
            carried = [batch.column(k).to_pylist() for k in range(kept)]
            for k in range(batch.num_rows):
                text = (texts[k].as_py() or "").encode()
                shard.add(dict(zip(names, (*(c[k] for c in carried), *fact(text)), strict=True)), text)
                if shard.bytes >= SHARD_BYTES:
                    yield shard.batch(next(number), buckets, schema)
                    shard = _Shard()
        if shard.facts:
            yield shard.batch(next(number), buckets, schema)

    return run


def _numbered(table: pa.Table) -> pa.Table:
    """The words of a bucket get the numbers of their order; every shard's words are told by these."""
    lists = pc.split_pattern(table.column("words").combine_chunks(), b" ")
    words = lists.flatten().dictionary_encode()
    number = np.empty(len(words.dictionary), np.int32)
    number[pc.array_sort_indices(words.dictionary).to_numpy()] = np.arange(len(number), dtype=np.int32)
    edges = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).astype(np.int32)
    ranks = number[words.indices.to_numpy()]
    return pa.table([table.column("shard"), table.column("bucket"), pa.ListArray.from_arrays(pa.array(edges), pa.array(ranks))], names=["shard", "bucket", "ranks"])


def _renumbered(buckets: int, schema: pa.Schema):
    def run(shards: pa.Table, numbers: pa.Table) -> pa.Table:
        order = np.argsort(numbers.column("bucket").to_numpy())
        ranks, bucket = numbers.column("ranks").combine_chunks(), numbers.column("bucket").to_numpy()
        of = [ranks[int(k)].values.to_numpy().astype(np.int64) * buckets + int(bucket[k]) for k in order]
        whole = np.concatenate(of) if of else np.empty(0, np.int64)
        local = shards.column("columns").combine_chunks().flatten().to_numpy()
        columns = pa.ListArray.from_arrays(pa.array([0, len(local)], pa.int32()), pa.array(whole[local]))
        return pa.table([shards.column("shard"), shards.column("facts"), shards.column("row_ends"), columns, shards.column("counts")], schema=schema)

    return run


def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def term_matrix(docs: DataFrame, carried: list[str], facts: str, fact: Callable[[bytes], tuple], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary) of the texts.

    ``matrix``: a row per shard: the facts of its documents, ends of their rows, column numbers, counts. ``facts`` names, as DDL of
    a struct, the ``carried`` columns and then what ``fact`` tells of a text's bytes. ``dictionary``: bucket, rank, word; a word's
    column is rank * buckets + bucket, the same in every shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-int(size) // BUCKET_BYTES))
    stored, whole = _SHARD.format(facts=facts), MATRIX.format(facts=facts)
    cut = docs.select(*carried, text).mapInArrow(_shards(buckets, _arrow(stored, spark), fact, len(carried)), stored)
    shards, _ = settled_at(cut, "term-shards", LARGE_ROWS)
    parts = shards.select("shard", F.explode("vocabulary").alias("v")).select("shard", "v.bucket", "v.words")
    numbers = parts.groupBy("bucket").applyInArrow(_numbered, "shard long, bucket int, ranks array<int>")
    rows = shards.select("shard", "facts", "row_ends", "columns", "counts")
    matrix = rows.groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(_renumbered(buckets, _arrow(whole, spark)), whole)
    words = parts.select("bucket", F.explode(F.split(F.col("words").cast("string"), " ")).alias("word")).distinct()
    dictionary = words.groupBy("bucket").agg(F.sort_array(F.collect_list("word")).alias("w")).select("bucket", F.posexplode("w").alias("rank", "word"))
    return matrix, dictionary


def row_totals(matrix: DataFrame, facts: str) -> DataFrame:
    """Per row of the matrix: its facts, the sum of its counts (words) and the number of its entries (different words).

    Built-in functions: a second Python worker next to each one that renumbers would double what these hold.
    """
    names = [f.split(":")[0] for f in facts.split(", ")]
    start = "coalesce(get(row_ends, i - 1), 0)"
    told = ", ".join(f"'{n}', f.{n}" for n in names)
    rows = f"""transform(facts, (f, i) -> named_struct({told},
      'n_words', aggregate(slice(counts, {start} + 1, row_ends[i] - {start}), 0L, (a, x) -> a + x), 'n_different', bigint(row_ends[i] - {start})))"""
    return matrix.select(F.inline(F.expr(rows)))
