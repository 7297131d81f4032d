"""Removal of passages that stand in an earlier document too, by FM-indexes over shards of passages.

A window is ``length`` words in a row. Searching every document in an index of every other shard would
cost the square of the input, so shards are made by content: each window belongs to its rarest-looking
word triple (the least hash among its triples), and neighbouring windows of one triple form a piece.
Windows of equal words have equal triples, so all places where a window stands meet in one shard.

Each shard drops pieces whose triple no other document has, builds an FM-index over the different
pieces left, and streams the windows of the pieces through it by backward search. The interval of a
window gives the smallest document it starts in. Documents are never compared in pairs.

Equal pieces of one batch of documents travel once, with a list of places. Triples in more than
``HEAVY_SHARE`` of all pieces (common phrases, passages shared by very many documents) are split by the second triple of their windows, the
least but for the first: neighbouring windows of one pair of triples stay together, so a shared passage costs a document a few pieces and spans, not one
for each window, and equal windows still meet. Heavy triples number at most 2 / HEAVY_SHARE.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tableferry.llm.fm_index import FMIndex
from tableferry.llm.shared import runs, settle, shuffle_width, small_batches, texts_of
from tableferry.llm.words import Words, mix, slices

TRIPLE = 3
HEAVY_SHARE = 1 / 5000
# Pieces of a shard, on average (about 5 MB of text).
SHARD_PIECES = 50_000
# A run of windows of one triple is cut at this many, so that texts of one repeated word make no long pieces.
PIECE_WINDOWS = 64
# A task holds so many places, or so many bytes of different pieces with what their entries take, before it sends them off.
FLUSH_PIECES = 400_000
FLUSH_BYTES, ENTRY_BYTES = 96 << 20, 300
_ZSTD = pa.Codec("zstd", 6)


def pieces(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window (word number), number of windows, triple hash and row of every piece of a slice."""
    none = np.zeros(0, np.int64)
    h = words.hashes()
    if len(h) < length:
        return none, none, none.astype(np.uint64), none
    at = np.flatnonzero(np.arange(len(h)) + length <= words.first[words.rows + 1])
    _, triples = words.ngrams(h, TRIPLE)
    grams = np.zeros(len(h), np.uint64)
    grams[words.ngrams(h, TRIPLE)[0]] = triples
    least = grams[at].copy()
    for k in range(1, length - TRIPLE + 1):
        np.minimum(least, grams[at + k], out=least)
    if not len(at):
        return none, none, least, none
    row = words.rows[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(new | (since % PIECE_WINDOWS == 0))
    return at[first], np.diff(np.append(first, len(at))), least[first], row[first]


def by_second_triple(words: Words, length: int, first: np.ndarray, many: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of some pieces: first word, whether another second triple than the window before has it, and that triple."""
    h = words.hashes()
    grams = np.zeros(len(h), np.uint64)
    at, triples = words.ngrams(h, TRIPLE)
    grams[at] = triples
    begin = np.repeat(first, many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    least, none = np.repeat(key, many), np.uint64(0xFFFFFFFFFFFFFFFF)
    second = np.full(len(begin), none)
    for k in range(length - TRIPLE + 1):
        g = grams[begin + k]
        np.minimum(second, np.where(g == least, none, g), out=second)
    new = np.ones(len(begin), bool)
    new[1:] = second[1:] != second[:-1]
    new[(np.cumsum(many) - many)] = True
    return begin, new, second


def heavy_triples(docs: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """Triples of more than ``HEAVY_SHARE`` of all pieces, and the number of pieces.

    A triple above the share overall is above it in some task, so each task names only such ones.
    """

    def local(batches):
        total, seen = 0, []
        for batch in batches:
            for _, _, words in slices(batch.column("text")):
                keys = pieces(words, length)[2]
                total += len(keys)
                seen.append(keys)
                if len(seen) > 64:
                    yield named(np.concatenate(seen))
                    seen = []
        if seen:
            yield named(np.concatenate(seen))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["triple", "n"])

    def named(keys: np.ndarray) -> pa.RecordBatch:
        keys, count = np.unique(keys, return_counts=True)
        many = count > max(4, HEAVY_SHARE * count.sum())
        return pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(count[many].astype(np.int64))], names=["triple", "n"])

    counted = docs.mapInArrow(local, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    counted = settle(counted, "triples")
    total = counted.where("triple IS NULL").agg(F.sum("n")).first()[0] or 0
    rows = counted.where(F.col("triple").isNotNull() & (F.col("n") > max(32, HEAVY_SHARE / 2 * total))).select("triple").collect()
    return np.sort(np.array([r.triple for r in rows], np.int64).view(np.uint64)), total


class _Parcels:
    """Pieces of a batch by shard: equal ones once, with the places where they stand."""

    def __init__(self, shards: int):
        self.shards, self.n, self.bytes = shards, 0, 0
        self.by_shard: dict[int, dict[bytes, list]] = {}

    def add(self, shard: int, tag: int, text: bytes, doc: int, start: int) -> None:
        found = self.by_shard.setdefault(shard, {}).setdefault(text, [tag])
        if len(found) == 1:
            self.bytes += len(text) + ENTRY_BYTES
        found.append(doc)
        found.append(start)
        self.n += 1

    def full(self) -> bool:
        return self.n >= FLUSH_PIECES or self.bytes >= FLUSH_BYTES

    def flush(self):
        for shard, found in self.by_shard.items():
            tags = np.array([v[0] for v in found.values()], np.uint32)
            sizes = np.array([len(k) for k in found], np.int32)
            places = np.array([len(v) // 2 for v in found.values()], np.int32)
            at = np.array([x for v in found.values() for x in v[1:]], np.int64).reshape(-1, 2)
            numbers = (sizes, tags, places, np.diff(at[:, 0], prepend=0), at[:, 1].astype(np.int32))
            body = b"".join((b"".join(found), *map(_planes, numbers)))
            packed = _ZSTD.compress(body, asbytes=True)
            yield shard, struct.pack("<qqqq", len(found), int(sizes.sum()), len(at), len(body)) + packed
        self.by_shard, self.n, self.bytes = {}, 0, 0


def _planes(numbers: np.ndarray) -> bytes:
    """First bytes of all numbers, then all second bytes, and so on: they compress better."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _unpacked(parcel: bytes):
    n, size, places, whole = struct.unpack("<qqqq", parcel[:32])
    body = _ZSTD.decompress(parcel[32:], decompressed_size=whole, asbytes=True)
    out, at = [body[:size]], size
    for kind, many in ((np.int32, n), (np.uint32, n), (np.int32, n), (np.int64, places), (np.int32, places)):
        wide = np.dtype(kind).itemsize * many
        planes = np.frombuffer(body[at : at + wide], np.uint8).reshape(-1, many)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += wide
    out[4] = np.cumsum(out[4])
    return out


def shipped(docs: DataFrame, length: int, heavy: np.ndarray, shards: int) -> DataFrame:
    """The pieces of all documents as parcels (shard, parcel)."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def ship(batches):
        parcels = _Parcels(shards)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, _, words in slices(batch.column("text")):
                first, many, key, row = pieces(words, length)
                split = np.isin(key, shared.value)
                if split.any():
                    begin, new, second = by_second_triple(words, length, first[split], many[split], key[split])
                    runs_of = np.append(np.flatnonzero(new), len(begin))
                    each = np.repeat(np.flatnonzero(split), many[split])[runs_of[:-1]]
                    first = np.concatenate((first[~split], begin[runs_of[:-1]]))
                    many = np.concatenate((many[~split], np.diff(runs_of)))
                    key = np.concatenate((key[~split], mix(key[each] ^ mix(second[runs_of[:-1]]))))
                    row = np.concatenate((row[~split], row[each]))
                shard = ((key >> np.uint64(32)) % np.uint64(shards)).tolist()
                tag = (key & np.uint64(0xFFFFFFFF)).tolist()
                data = words.data.tobytes()
                begins, ends = words.starts[first].tolist(), words.ends[first + many + length - 2].tolist()
                starts = (first - words.first[row]).tolist()
                for s, t, x, y, r, w in zip(shard, tag, begins, ends, row.tolist(), starts, strict=True):
                    doc = ids[a + r]
                    if doc is not None:
                        parcels.add(s, t, data[x:y], doc, w)
                if parcels.full():
                    yield rows(parcels)
        yield rows(parcels)

    def rows(parcels: _Parcels) -> pa.RecordBatch:
        found = list(parcels.flush())
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], names=["shard", "parcel"])

    return docs.mapInArrow(ship, "shard int, parcel binary")


def repeated(parcels: list[bytes], length: int):
    """For one shard: (doc, first, last) word spans whose windows start in a smaller document too."""
    texts, tags, docs, starts, owner = [], [], [], [], []
    n = 0
    for parcel in parcels:
        body, sizes, tag, places, doc, start = _unpacked(parcel)
        ends = np.cumsum(sizes)
        texts.append((body, ends - sizes, ends))
        tags.append(tag)
        docs.append(doc)
        starts.append(start)
        owner.append(np.repeat(np.arange(len(tag)) + n, places))
        n += len(tag)
    tags, docs, starts, owner = (np.concatenate(x) for x in (tags, docs, starts, owner))
    # Triples of one document only cannot hold a repeated window.
    _, kind = np.unique(tags, return_inverse=True)
    low = np.full(kind.max() + 1, np.iinfo(np.int64).max)
    high = np.full(kind.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, kind[owner], docs)
    np.maximum.at(high, kind[owner], docs)
    wanted = (low < high)[kind]
    # Different word sequences left, and the smallest document of each.
    number: dict[bytes, int] = {}
    piece = np.full(n, -1)
    base = 0
    for body, begin, end in texts:
        m = len(begin)
        for i in np.flatnonzero(wanted[base : base + m]).tolist():
            piece[base + i] = number.setdefault(b" ".join(body[begin[i] : end[i]].split()), len(number))
        base += m
    if not number:
        return
    use = piece[owner] >= 0
    docs, starts, owner = docs[use], starts[use], piece[owner[use]]
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, owner, docs)
    # The text: word numbers from 1, a 0 after each piece.
    vocabulary: dict[bytes, int] = {}
    symbols, sizes = [], []
    for text in number:
        ws = text.split(b" ")
        symbols.extend([vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws])
        symbols.append(0)
        sizes.append(len(ws))
    text, sizes = np.array(symbols, np.int64), np.array(sizes, np.int64)
    index = FMIndex(text, length)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    windows = sizes - length + 1
    of_piece = np.repeat(np.arange(len(sizes)), windows)
    first_window = np.concatenate(([0], np.cumsum(windows)))
    offset = np.arange(len(of_piece)) - first_window[of_piece]
    hit, lo, hi = index.matches(text, begin[of_piece] + offset, length)
    earliest = least[of_piece]
    if len(hit):
        holder = np.repeat(least, sizes + 1)[index.order]
        lo_all, which = np.unique(lo, return_inverse=True)
        hi_all = np.zeros(len(lo_all), np.int64)
        hi_all[which] = hi
        holder = np.append(holder, np.iinfo(np.int64).max)
        low = np.minimum.reduceat(holder, np.column_stack((lo_all, hi_all)).ravel())[::2]
        earliest[hit] = low[which]
    # Every place of a piece against its windows.
    many = windows[owner]
    place = np.repeat(np.arange(len(owner)), many)
    step = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
    gone = earliest[first_window[owner][place] + step] < docs[place]
    place, step = place[gone], step[gone]
    if not len(place):
        return
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (step[1:] != step[:-1] + 1)
    edge = np.flatnonzero(new)
    end = np.append(edge[1:], len(place)) - 1
    yield docs[place[edge]], starts[place[edge]] + step[edge], starts[place[end]] + step[end] + length - 1


_SPANS = "doc_id long, first int, last int"


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """Word spans (both ends included) of every document that stand in one of a smaller doc_id."""
    docs = texts_of(docs)
    small_batches(docs.sparkSession)
    heavy, total = heavy_triples(docs, length)
    width = shuffle_width(docs.sparkSession)
    shards = max(width, -(-total // SHARD_PIECES))

    def search(batches):
        held, shard = [], None
        for batch in batches:
            for s, parcel in zip(batch.column("shard").to_pylist(), batch.column("parcel"), strict=True):
                if s != shard and held:
                    yield from out(held)
                    held = []
                shard = s
                held.append(parcel.as_py())
        if held:
            yield from out(held)

    def out(held):
        for doc, first, last in repeated(held, length):
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], names=["doc_id", "first", "last"])

    parcels = shipped(docs, length, heavy, shards).repartition(width, "shard").sortWithinPartitions("shard")
    return parcels.mapInArrow(search, _SPANS)


ADDED = ("n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """The rows of ``docs`` with text lacking repeated words, and n_words, n_removed, kept_sha256 (replaced where there).

    A word goes if a window of ``length`` words over it also starts in a document of smaller doc_id.
    doc_id is taken to be unique; rows without one lose nothing. Null texts count as empty ones and
    come back empty. White space around words that stay is kept; the digest joins them by one space.
    """
    docs = docs.drop(*ADDED)
    spans = repeated_spans(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    fields = docs.schema.fields
    at = docs.columns.index("text")
    schema = StructType([*fields[:at], StructField("text", StringType()), *fields[at + 1 :], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])

    def cut(batches):
        for batch in batches:
            texts, many, gone, digests = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                words = (text or "").encode().split()
                keep = np.ones(len(words), bool)
                if found:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, [s["first"] for s in found], 1)
                    np.add.at(edge, [s["last"] + 1 for s in found], -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                texts.append(text or "" if keep.all() else _kept_text(text, keep))
                many.append(len(keep))
                gone.append(int((~keep).sum()))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            columns = [batch.column(f.name) for f in fields]
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array(many, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.join(spans, "doc_id", "left").select(*docs.columns, "_spans").mapInArrow(cut, schema)


def _kept_text(text: str, keep: np.ndarray) -> str:
    (_, _, words), = slices(pa.array([text]), most=1 << 62)
    edges = runs(keep)
    parts = []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        if keep[s]:
            stop = words.starts[e] if e < len(keep) else len(words.data)
            parts.append(words.data[words.starts[s] : stop].tobytes())
    return b"".join(parts).decode("utf-8", "replace").rstrip(" \t\n\v\f\r")
