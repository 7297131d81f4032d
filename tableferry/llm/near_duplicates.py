"""MinHash near-duplicates by a join over inverted lists of signature coordinates.

Every document's word shingles give a signature of ``COORDINATES`` minima. Documents with equal
shingle sets are one class, so a thousand copies weigh as one row. A class is posted under
coordinate-value pairs, a prefix of the first ``POSTED`` coordinates in a common order. Two classes that agree in so
many of these as ``agreeing_least`` says share one of their first ``POSTED - agreeing_least + 1`` pairs in any
common order, so only these are posted. Pairs held by more than a thousandth of the classes come last in
the order: passages shared by very many documents rarely open a list.

Lists are merged in passes. In each of the first passes every list's members meet one of them, another one
in each pass, and what is confirmed is settled as components: members of one component are skipped from then on, for no
further link could change anything. A member that all others have met leaves the list, so short lists, which are most, are soon used up. These
passes go on while they shrink the lists. Then each list is cut into parts of about ``BLOCK`` members, and all members of a part that are still
in different components meet within a task. Lists of several parts that are not one component by then go on to a last pass: their members outside the list's largest
component meet all others, in blocks of parts; the members of the largest component, mostly by far the most, are sent once per block of the others.
A pair counts collisions over two bits of each coordinate, in the first list that holds both, and is looked at further only above a match threshold, pairs with hubs over
``SCREENED`` coordinates before over all; then it is confirmed on full shingle sets. Pairs with hubs are rows, no more than the lists have. Those of a block are never
written out, as a family of near copies has as many as the square of its size: the block's members that have a partner get their full sets, meet once more, and
leave only links that join two components each, fewer than the block has members.

Nulls and texts without words have an empty set and are linked with nothing.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tableferry.llm.components import components
from tableferry.llm.shared import by_ids, runs, settle, shuffle_width, small_batches, texts_of
from tableferry.llm.words import mix, slices

COORDINATES, POSTED = 2048, 32
# A pair of the similarity asked for agrees in fewer posted coordinates than are counted on with at most this probability.
MISSED = 1e-8
# Two bits of each coordinate are compared; pairs more than so many standard deviations below what the
# similarity asked for gives on average are not confirmed.
BELOW = 5.0
# A coordinate-value pair in more than this share of the classes is posted last.
HEAVY_SHARE = 0.001
HEAVY_LEAST = 50
# Passes through hubs end when the lists keep more than this share of their rows.
STILL = 0.8
BLOCK = 1024
WORDS_OF_BITS = [f"s{j}" for j in range(COORDINATES // 32)]
# Coordinates that pairs are screened by before all are looked at.
SCREENED = 512
SCREEN = WORDS_OF_BITS[: SCREENED // 32]
_LOW_BITS = np.uint64(0x5555555555555555)

_FACTORS = np.random.default_rng(11).integers(1, 1 << 32, (COORDINATES, 2), dtype=np.uint32)
_FACTORS[:, 0] |= np.uint32(1)


def shingle_sets(texts: pa.Array, size: int):
    """For each text in turn its row number and sorted distinct shingle hashes."""
    for a, b, words in slices(texts, lower=True):
        h = words.hashes()
        at, grams = words.ngrams(h, size)
        ends = np.searchsorted(at, words.first)
        for row in range(b - a):
            n = words.first[row + 1] - words.first[row]
            if n >= size:
                yield a + row, np.unique(grams[ends[row] : ends[row + 1]])
            elif n:
                short = h[words.first[row] : words.first[row + 1]]
                yield a + row, mix(np.array([int((short * (2 * np.arange(n, dtype=np.uint64) + np.uint64(3))).sum() + n)], np.uint64))
            else:
                yield a + row, np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDINATES`` 32-bit minima per set; the sets are not empty."""
    flat, starts = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k, (x, y) in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat(flat * x + y, starts)
    return out


def two_bits(signature: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, 32 coordinates to a long."""
    bits = ((signature >> np.uint32(3)) & np.uint32(3)).astype(np.uint64).reshape(len(signature), COORDINATES // 32, 32)
    return (bits << (2 * np.arange(32, dtype=np.uint64))).sum(2, dtype=np.uint64)


def most_misses(percent: int, coordinates: int = COORDINATES) -> int:
    """Largest number of so many coordinates whose two bits may differ for a pair to be confirmed."""
    m = percent / 100 + (1 - percent / 100) / 4
    return int(coordinates * (1 - m) + BELOW * (coordinates * m * (1 - m)) ** 0.5)


def agreeing_least(percent: int) -> int:
    """How many of the posted coordinates a pair is counted on to agree in; at least one."""
    s, below, least = percent / 100, 0.0, 0
    while least < POSTED and (below := below + comb(POSTED, least) * s**least * (1 - s) ** (POSTED - least)) <= MISSED:
        least += 1
    return max(1, least)


_SKETCH = "doc_id long, n_shingles long, set_key binary, posted binary, " + ", ".join(f"{c} long" for c in WORDS_OF_BITS)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    def sketch(batches):
        for batch in batches:
            ids, held = batch.column("doc_id"), []
            for row, found in shingle_sets(batch.column("text"), size):
                held.append((row, found))
                if len(held) >= 500:
                    yield flush(ids, held)
                    held = []
            if held:
                yield flush(ids, held)

    def flush(ids, held):
        full = [k for k, (_, s) in enumerate(held) if len(s)]
        sig = signatures([held[k][1] for k in full]) if full else np.zeros((0, COORDINATES), np.uint32)
        at = np.full(len(held), -1)
        at[full] = np.arange(len(full))
        at = pa.array(at, mask=at < 0)
        bits = two_bits(sig).view(np.int64)
        keys = pa.array([hashlib.blake2b(held[k][1].tobytes(), digest_size=16).digest() for k in full], pa.binary())
        posted = pa.array([g.tobytes() for g in sig[:, :POSTED]], pa.binary())
        columns = [keys, posted, *(pa.array(np.ascontiguousarray(bits[:, j])) for j in range(bits.shape[1]))]
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array([r for r, _ in held])), pa.array([len(s) for _, s in held], pa.int64()), *(c.take(at) for c in columns)],
            names=["doc_id", "n_shingles", "set_key", "posted", *WORDS_OF_BITS],
        )

    return texts_of(docs).mapInArrow(sketch, _SKETCH)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, POSTED)


def _slots(signature: np.ndarray) -> np.ndarray:
    """Coordinate and value in one long."""
    return (np.arange(POSTED, dtype=np.int64) << 32) | signature.astype(np.int64)


def heavy_slots(classes: DataFrame, n: int) -> np.ndarray:
    """Coordinate-value pairs of more than ``HEAVY_SHARE`` of the classes, at most 2 * ``POSTED`` / share of them.

    A pair above the share overall is above it in some task's rows, so tasks name only such ones.
    """

    def local(batches):
        kept = [_slots(_matrix(b.column("posted"))).ravel() for b in batches if b.num_rows]
        if kept:
            slots, count = np.unique(np.concatenate(kept), return_counts=True)
            many = count > max(1, HEAVY_SHARE * sum(map(len, kept)) / POSTED)
            yield pa.RecordBatch.from_arrays([pa.array(slots[many]), pa.array(count[many].astype(np.int64))], names=["slot", "n"])

    found = classes.select("posted").mapInArrow(local, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    least = max(HEAVY_LEAST, HEAVY_SHARE / 2 * n)
    return np.array(sorted(r.slot for r in found.where(F.col("n") > least).select("slot").collect()), np.int64)


def with_prefix(classes: DataFrame, heavy: np.ndarray, percent: int) -> DataFrame:
    """``classes`` with the coordinate-value pairs that each is posted under, as longs in one binary."""
    posts = POSTED - agreeing_least(percent) + 1
    shared = classes.sparkSession.sparkContext.broadcast(heavy)

    def post(batches):
        for batch in batches:
            slots = _slots(_matrix(batch.column("posted")))
            order = np.argsort(np.isin(slots, shared.value), axis=1, kind="stable")[:, :posts]
            prefix = pa.array([r.tobytes() for r in np.take_along_axis(slots, order, 1)], pa.binary())
            at = batch.schema.get_field_index("posted")
            yield pa.RecordBatch.from_arrays([prefix if k == at else c for k, c in enumerate(batch.columns)], names=["prefix" if k == at else n for k, n in enumerate(batch.schema.names)])

    schema = StructType([StructField("prefix", f.dataType) if f.name == "posted" else f for f in classes.schema.fields])
    return classes.mapInArrow(post, schema)


def postings(classes: DataFrame) -> DataFrame:
    def post(batches):
        for batch in batches:
            slots = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.int64)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.repeat(ids, len(slots) // max(1, len(ids))))], names=["slot", "id"])

    return classes.select("id", "prefix").mapInArrow(post, "slot long, id long")


def misses(x: str, y: str, words: list[str]) -> Column:
    """In how many coordinates of these words the two bits of two rows differ."""
    return reduce(lambda p, q: p + q, [
        F.expr(f"bit_count(({x}.{c} ^ {y}.{c} | shiftrightunsigned({x}.{c} ^ {y}.{c}, 1)) & {int(_LOW_BITS)}L)") for c in words
    ])


def agreeing(pairs: DataFrame, bits: DataFrame, words: list[str], percent: int) -> DataFrame:
    """Pairs (a, b) that differ in no more coordinates of these words than the similarity gives."""
    x = bits.select(F.col("id").alias("a"), *words).alias("x")
    y = bits.select(F.col("id").alias("b"), *words).alias("y")
    return pairs.join(x, "a").join(y, "b").where(misses("x", "y", words) <= most_misses(percent, 32 * len(words))).select("a", "b")


def with_hubs(lists: DataFrame, turn: int) -> DataFrame:
    """Lists with one member each as ``hub``, another one in every turn.

    The members of one family are in many lists together; the order of hubs is that of their ids' hashes, so it mostly has one hub in all.
    """
    hubs = lists.groupBy("slot").agg(F.min_by(F.struct("id", "comp"), F.xxhash64(F.lit(turn), "id")).alias("hub"))
    return lists.join(hubs, "slot")


def through_hubs(lists: DataFrame) -> DataFrame:
    """Pairs of lists' members with their hubs, in different components."""
    return lists.where("comp <> hub.comp").select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()


def full_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(id, members): the sorted shingle hashes of the documents of these ids."""

    def sets(batches):
        for batch in batches:
            ids, rows, found = batch.column("doc_id"), [], []
            for row, s in shingle_sets(batch.column("text"), size):
                rows.append(row)
                found.append(s.tobytes())
                if len(rows) >= 200:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(found, pa.binary())], names=["id", "members"])
                    rows, found = [], []
            if rows:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(found, pa.binary())], names=["id", "members"])

    # A document of many pairs is named once.
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    return settle(by_ids(texts_of(docs), wanted, "left_semi").mapInArrow(sets, "id long, members binary"), "sets")


def parts_of(lists: DataFrame) -> DataFrame:
    """Blocks of the first pass through parts: each list's members, a part's to one block."""
    sized = lists.join(lists.groupBy("slot").agg(F.count("*").alias("n")), "slot")
    return sized.select("slot", _own("n").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "id", "comp", F.lit(True).alias("outside"))


def blocks_of(lists: DataFrame) -> DataFrame:
    """Blocks of the last pass, of lists with several parts.

    Members outside the list's most frequent component (left) meet all others (right); either side is cut into
    parts by id, and each pair of parts is a block: a member on the right is sent once per part of the left.
    """
    of_comp = lists.groupBy("slot", "comp").agg(F.count("*").alias("m"))
    large = of_comp.groupBy("slot").agg(F.max_by("comp", F.struct("m", "comp")).alias("large"), F.sum("m").alias("n"), F.max("m").alias("m"))
    sized = lists.join(large, "slot").withColumns({"outside": F.col("comp") != F.col("large"), "lefts": _parts("n - m"), "rights": _parts("n")})
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.where("outside").select("slot", _own("n - m").alias("i"), every("rights").alias("j"), F.lit(0).alias("side"), "id", "comp", "outside")
    right = sized.select("slot", every("lefts").alias("i"), _own("n").alias("j"), F.lit(1).alias("side"), "id", "comp", "outside")
    return left.unionAll(right)


def _parts(n: str) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.expr(n) / BLOCK)).cast("int")


def _own(n: str) -> Column:
    """A member's part of so many members."""
    return F.pmod(F.xxhash64("id"), _parts(n)).cast("int")


_MEMBER = "slot long, i int, j int, side int, id long, comp long, outside boolean"


def _block_by_block(blocks: DataFrame, look, schema: str) -> DataFrame:
    """What ``look`` makes of tables of whole blocks, the left side of each first."""

    def meet(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            cut = _last_group(table)
            rest = table.slice(cut)
            if cut:
                yield from look(table.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from look(rest)

    width = shuffle_width(blocks.sparkSession)
    return blocks.repartition(width, "slot", "i", "j").sortWithinPartitions("slot", "i", "j", "side").mapInArrow(meet, schema)


def _edges(table: pa.Table):
    """Start, start of the right side and end of each block that has two members to meet."""
    edges, side = runs(_group_key(table)), table.column("side").to_numpy()
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        m = s + int(np.searchsorted(side[s:e], 1))
        # A part on its own meets itself.
        if s < m and (m < e or m - s > 1):
            yield s, m, e


def partnered(blocks: DataFrame, classes: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The members of ``blocks`` that agree with one of another component, in the blocks of the first list that holds both."""
    most = most_misses(percent)

    def look(table):
        ids, comp, slot = (table.column(c).to_numpy() for c in ("id", "comp", "slot"))
        prefix = np.frombuffer(b"".join(table.column("prefix").to_pylist()), np.int64).reshape(table.num_rows, -1)
        bits = np.column_stack([table.column(c).to_numpy().view(np.uint64) for c in WORDS_OF_BITS])
        found = np.zeros(table.num_rows, bool)
        for s, m, e in _edges(table):
            r = m if m < e else s
            for at in range(s, m, 16):
                upto = min(m, at + 16)
                p, q = np.nonzero(comp[at:upto, None] != comp[None, r:e])
                p, q = p + at, q + r
                # Two of one side meet once.
                p, q = (x[ids[p] < ids[q]] for x in (p, q)) if r == s else (p, q)
                x = bits[p] ^ bits[q]
                near = np.bitwise_count((x | (x >> np.uint64(1))) & _LOW_BITS).sum(1, dtype=np.int64) <= most
                p, q = p[near], q[near]
                # The first list that holds both, in the order of the left one.
                shared = (prefix[p][:, :, None] == prefix[q][:, None, :]).any(2)
                here = prefix[p, shared.argmax(1)] == slot[s]
                found[p[here]] = found[q[here]] = True
        if found.any():
            yield from table.select(_NAMES).filter(pa.array(found)).to_batches()

    held = classes.select("id", "prefix").join(bits.select("id", *WORDS_OF_BITS), "id")
    return _block_by_block(blocks.join(held, "id").select(*_NAMES, "prefix", *WORDS_OF_BITS), look, _MEMBER)


def joined_up(members: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of each block's members: confirmed on full sets, each joining two components of the block."""

    def look(table):
        ids, comp = (table.column(c).to_numpy() for c in ("id", "comp"))
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("members").combine_chunks()]
        a, b = [], []
        for s, m, e in _edges(table):
            for p, q in _forest(comp[s:e], sets[s:e], m - s, percent):
                a.append(min(ids[s + p], ids[s + q]))
                b.append(max(ids[s + p], ids[s + q]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    full = full_sets(docs, members, size)
    return _block_by_block(members.join(full, "id").select(*_NAMES, "members"), look, "a long, b long")


_NAMES = [c.split()[0] for c in _MEMBER.split(", ")]


def _forest(comp: np.ndarray, sets: list[np.ndarray], lefts: int, percent: int):
    """Pairs of the first ``lefts`` members and the others, or of them all if there are no others, that are similar and join components."""
    right = lefts if lefts < len(sets) else 0
    size = np.array([len(x) for x in sets])
    flat = np.concatenate(sets[right:])
    starts = np.cumsum([0, *size[right:]])[:-1]
    values, flat = np.unique(flat, return_inverse=True)
    group = comp.copy()
    for p in range(lefts):
        if (group[right:] == group[p]).all():
            continue
        at = np.minimum(np.searchsorted(values, sets[p]), len(values) - 1)
        has = np.zeros(len(values), np.int64)
        has[at[values[at] == sets[p]]] = 1
        shared = np.add.reduceat(has[flat], starts)
        for q in (right + np.flatnonzero(100 * shared >= percent * (size[p] + size[right:] - shared))).tolist():
            if group[p] != group[q]:
                group[group == group[q]] = group[p]
                yield p, q


def _group_key(table: pa.Table) -> np.ndarray:
    s, i, j = (table.column(c).to_numpy() for c in ("slot", "i", "j"))
    new = np.zeros(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return np.cumsum(new)


def _last_group(table: pa.Table) -> int:
    key = _group_key(table)
    return int(np.searchsorted(key, key[-1])) if len(key) else 0


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets have 100 * intersection >= percent * union."""
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))
    full = full_sets(docs, ends, size)

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = full.select(F.col("id").alias("a"), F.col("members").alias("x"))
    y = full.select(F.col("id").alias("b"), F.col("members").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    ``docs`` needs doc_id (unique) and text; other columns are ignored. Rows with equal shingle sets
    are always in one component.
    """
    small_batches(docs.sparkSession)
    known = settle(sketches(docs, size), "sketches")
    bits = known.where("set_key IS NOT NULL").select(F.col("doc_id").alias("id"), *WORDS_OF_BITS)
    # A class carries its posted coordinates alone; sketches are fetched by id, from those of all documents.
    classes = settle(known.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("posted").alias("posted")).where("id IS NOT NULL"), "classes")
    classes = settle(with_prefix(classes, heavy_slots(classes, classes.count()), percent), "classes")
    posted = postings(classes)
    shared = posted.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1").select("slot")
    lists = settle(posted.join(shared, "slot").withColumn("comp", F.col("id")), "lists")
    links, named, turn, rows, hubs = None, None, 0, lists.count(), True
    while hubs and (links is None or rows):
        lists = settle(with_hubs(lists, turn), "hubs")
        near = settle(agreeing(through_hubs(lists), bits, SCREEN, percent), "screened")
        pairs = settle(agreeing(near, bits, WORDS_OF_BITS, percent), "pairs")
        if links is None or not pairs.isEmpty():
            links, named = _with(links, confirmed(pairs, docs, size, percent))
        lists = _several(lists.where("id <> hub.id").select("slot", "id", "comp"), named)
        turn, before, rows = turn + 1, rows, lists.count()
        hubs = rows <= STILL * before
    for blocks in (parts_of, blocks_of):
        if not rows:
            break
        members = settle(partnered(blocks(lists), classes, bits, percent), "members")
        if not members.isEmpty():
            links, named = _with(links, joined_up(members, docs, size, percent))
        if blocks is parts_of:
            # Members of a list of one part have all met.
            long = lists.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("slot")
            lists = _several(lists.join(long, "slot", "left_semi"), named)
            rows = lists.count()

    of_class = classes.join(named, "id", "left").select("set_key", F.coalesce("component_id", "id").alias("component_id"))
    out = known.join(of_class, "set_key", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _with(links: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with those found, and the components of all."""
    links = settle(found if links is None else links.unionAll(found), "links")
    return links, settle(components(links), "components")


def _several(lists: DataFrame, named: DataFrame) -> DataFrame:
    """Lists by the components known now, without those that are in one."""
    now = lists.drop("comp").join(named.select("id", F.col("component_id").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = now.groupBy("slot").agg((F.min("comp") < F.max("comp")).alias("mixed")).where("mixed").select("slot")
    return settle(now.join(mixed, "slot", "left_semi").select("slot", "id", "comp"), "lists")
