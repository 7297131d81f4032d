"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages, overlapping windows that cover the whole text, over the words that the
benchmark uses. Two distributed passes fit the latent space: one counts in how many passages a word
stands (TF-IDF; words in more than ``COMMON`` of all passages are left out, but for an item's ``RAREST``
words), the other is the randomised SVD: with A the passages' matrix and R a random one, every task sums
A'AR over its passages, and an orthogonal basis of the sum spans the right singular vectors.
A third pass projects every passage, takes benchmark items of enough cosine similarity and enough of the item's
own latent length as candidates, and checks them on words: the longest common subsequence with the
item must be ``SURE`` of its words, or ``LIKELY`` with the answer, its last ``ANSWER`` words, given too.

The benchmark is a stated query set. It is cut into blocks of about ``BLOCK_WORDS`` words, each searched by
itself, so that what a task holds is bounded. Nothing of a document is shuffled.

Null texts count as empty; items without words match nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import settle, texts_of
from tableferry.llm.words import slices, split

COMMON, RAREST = 0.005, 8
STEP_WORDS = 32
RANK, RANK_MOST = 64, 256
COSINE, CONTAINED = 0.3, 0.35
SURE, LIKELY, ANSWER, ANSWER_SHARE = 0.7, 0.5, 6, 0.67
BLOCK_WORDS = 15_000
# Words that may be inserted before or after an item's telling words.
ROOM = 12


class Benchmark:
    """Words of a block of items; what passes find out is added."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        texts = [(t or "").lower().encode() for _, t in items]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        words = split(data, offsets)
        h = words.hashes()
        self.words = [h[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.vocabulary = np.unique(h)
        longest = max(map(len, self.words), default=0)
        self.step = max(STEP_WORDS, -(-longest // 2))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the vocabulary, -1 for other words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def weighed(self, seen: np.ndarray, passages: int) -> None:
        """Weights of words by the number of passages they stand in; 0 for common words."""
        idf = np.log((1 + passages) / (1 + seen)) + 0.1
        keep = seen <= max(3, COMMON * passages)
        for words in self.words:
            at = np.unique(self.numbers(words))
            keep[at[np.argsort(seen[at], kind="stable")[:RAREST]]] = True
        self.idf = np.where(keep, idf, 0.0).astype(np.float32)
        rows = np.zeros((len(self.words), len(self.vocabulary)), np.float32)
        for i, words in enumerate(self.words):
            at, n = np.unique(self.numbers(words), return_counts=True)
            rows[i, at] = self.idf[at] * n
        self.rows = rows
        self.sets = [set(w.tolist()) for w in self.words]
        # Where a telling word stands first and last in its item.
        self.telling = []
        for words in self.words:
            places: dict[int, tuple[int, int]] = {}
            for k in np.flatnonzero(self.idf[self.numbers(words)] > 0).tolist():
                w = int(words[k])
                places[w] = (places.get(w, (k, k))[0], k)
            self.telling.append(places)

    def based(self, sums: np.ndarray) -> None:
        """Orthogonal basis of the latent space, from the sums of A'AR."""
        self.basis = np.linalg.qr(sums.astype(np.float64))[0].astype(np.float32)
        self.latent = self.rows @ self.basis
        self.length = np.linalg.norm(self.latent, axis=1)
        self.toward = self.basis @ self.latent.T


def _passages(words, bench: Benchmark):
    """Kept words of a slice by half passage: number, half-passage key, row of each half passage and its count per row."""
    number = bench.numbers(words.hashes())
    at = np.flatnonzero(number >= 0)
    halves = -(-np.diff(words.first) // bench.step)
    base = np.concatenate(([0], np.cumsum(halves)))
    row = words.rows[at]
    half = base[row] + (at - words.first[row]) // bench.step
    return number[at], half, base


def document_frequencies(docs: DataFrame, bench: Benchmark) -> tuple[np.ndarray, int]:
    shared = docs.sparkSession.sparkContext.broadcast(bench)

    def count(batches):
        b = shared.value
        seen, passages = np.zeros(len(b.vocabulary), np.int64), 0
        for batch in batches:
            for _, _, words in slices(batch.column("text"), lower=True):
                number, half, base = _passages(words, b)
                passages += int(base[-1])
                pair = np.unique(half * len(b.vocabulary) + number)
                seen += np.bincount(pair % len(b.vocabulary), minlength=len(b.vocabulary)) if len(pair) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(seen)), -1)), pa.array(np.append(seen, passages))], names=["word", "n"])

    rows = docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out, passages = np.zeros(len(bench.vocabulary)), 0
    for r in rows:
        if r.word < 0:
            passages = r.n
        else:
            out[r.word] = r.n
    return out, passages


def _halves(number: np.ndarray, half: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighed words and their half passages, in order."""
    keep = idf[number] > 0
    return number[keep], half[keep]


def _half_sums(table: np.ndarray, number: np.ndarray, half: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half passages that hold weighed words, and the sum of the words' rows of ``table`` in each."""
    first = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
    out = np.empty((len(first), table.shape[1]), np.float32)
    # In parts that stay in the cache.
    edges = np.append(first, len(half))
    for a in range(0, len(first), 256):
        b = min(len(first), a + 256)
        part = slice(edges[a], edges[b])
        out[a:b] = np.add.reduceat(table[number[part]] * idf[number[part], None], first[a:b] - edges[a])
    return half[first], out


def _passage_sums(halves: np.ndarray, sums: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages, each a half passage and the next one of its text, and their sums."""
    later = ~begins[halves]
    passages = np.unique(np.concatenate((halves, halves[later] - 1)))
    out = np.zeros((len(passages), sums.shape[1]), np.float32)
    out[np.searchsorted(passages, halves)] = sums
    out[np.searchsorted(passages, halves[later] - 1)] += sums[later]
    return passages, out


def _begins(base: np.ndarray) -> np.ndarray:
    out = np.zeros(int(base[-1]) + 1, bool)
    out[base[:-1]] = True
    return out


def latent_sums(docs: DataFrame, bench: Benchmark, rank: int) -> np.ndarray:
    """A'AR over all passages of all documents: words by ``rank`` columns, as sums of task sums."""
    shared = docs.sparkSession.sparkContext.broadcast(bench)
    width = len(bench.vocabulary)
    block = 64

    def partial(batches):
        b = shared.value
        random = _random(width, rank)
        total = np.zeros((width, rank), np.float32)
        for batch in batches:
            for _, _, words in slices(batch.column("text"), lower=True):
                number, half, base = _passages(words, b)
                number, half = _halves(number, half, b.idf)
                if not len(number):
                    continue
                begins = _begins(base)
                passages, y = _passage_sums(*_half_sums(random, number, half, b.idf), begins)
                # A word adds to the passage that its half begins and to the one before.
                add = y[np.searchsorted(passages, half)]
                later = np.flatnonzero(~begins[half])
                add[later] += y[np.searchsorted(passages, half[later] - 1)]
                order = np.argsort(number, kind="stable")
                edge = np.flatnonzero(np.append(True, number[order][1:] != number[order][:-1]))
                word = number[order][edge]
                total[word] += np.add.reduceat(add[order], edge) * b.idf[word, None]
        starts = range(0, width, block)
        yield pa.RecordBatch.from_arrays([pa.array(list(starts), pa.int64()), pa.array([total[s : s + block].tobytes() for s in starts], pa.binary())], names=["start", "sums"])

    def add(table):
        parts = [np.frombuffer(x.as_buffer(), np.float32) for x in table.column("sums")]
        return pa.table({"start": table.column("start").slice(0, 1), "sums": pa.array([np.sum(parts, 0).astype(np.float32).tobytes()], pa.binary())})

    found = docs.mapInArrow(partial, "start long, sums binary").groupBy("start").applyInArrow(add, "start long, sums binary").collect()
    out = np.zeros((width, rank), np.float32)
    for r in found:
        out[r.start : r.start + block] = np.frombuffer(r.sums, np.float32).reshape(-1, rank)
    # The items are passages, too, and weigh as much as all others together, so that the space has room for them.
    own = bench.rows.T @ (bench.rows @ _random(width, rank))
    return out + own * max(1.0, float(np.linalg.norm(out)) / max(float(np.linalg.norm(own)), 1e-9))


def _random(width: int, rank: int) -> np.ndarray:
    return np.random.default_rng(17).normal(size=(width, rank)).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a row of bits per step."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    ones = (1 << len(a)) - 1
    row = ones
    for x in b:
        m = row & places.get(x, 0)
        row = ((row + m) | (row - m)) & ones if m else row
    return len(a) - row.bit_count()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, overlap, has_answer): items whose text a document holds, one row for each pair.

    ``similarity`` is the best latent cosine of a passage, ``overlap`` the share of the item's words in its longest
    common subsequence with the passage's surroundings. Documents without an id are searched, too, and
    come out under null.
    """
    docs = texts_of(docs)
    items = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-words // BLOCK_WORDS))
    out = None
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        found = _leaks_of(docs, Benchmark([(r.item_id, r.text) for r in part.distinct().collect()]))
        found = settle(found, "leaks") if blocks > 1 else found
        out = found if out is None else out.unionAll(found)
    return out


_FOUND = "doc_id long, item_id long, similarity double, overlap double, has_answer boolean"


def _leaks_of(docs: DataFrame, bench: Benchmark) -> DataFrame:
    if len(bench.vocabulary):
        bench.weighed(*document_frequencies(docs, bench))
        rank = min(len(bench.vocabulary), RANK_MOST, RANK + len(bench.ids))
        bench.based(latent_sums(docs, bench, rank))
    shared = docs.sparkSession.sparkContext.broadcast(bench)

    def search(batches):
        b = shared.value
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), []
            for a, _, words in slices(batch.column("text"), lower=True):
                if len(b.vocabulary):
                    out += [(ids[a + row], *rest) for row, *rest in _found(words, b)]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
                names = ["doc_id", "item_id", "similarity", "overlap", "has_answer"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return docs.mapInArrow(search, _FOUND)


def _found(words, b: Benchmark):
    """(row, item, similarity, overlap, has answer) of a slice's texts."""
    number, half, base = _passages(words, b)
    number, half = _halves(number, half, b.idf)
    if not len(number):
        return
    begins = _begins(base)
    passages, dots = _passage_sums(*_half_sums(b.toward, number, half, b.idf), begins)
    near, item = np.nonzero((dots >= CONTAINED * b.length**2) & (b.length > 0))
    if not len(near):
        return
    norm = np.zeros(len(passages), np.float32)
    for p in np.unique(near).tolist():
        low, high = np.searchsorted(half, passages[p]), np.searchsorted(half, passages[p], "right")
        if not begins[passages[p] + 1]:
            high = np.searchsorted(half, passages[p] + 1, "right")
        held = number[low:high]
        norm[p] = np.linalg.norm(b.idf[held] @ b.basis[held])
    cosine = dots[near, item] / (b.length[item] * np.maximum(norm[near], 1e-9))
    ok = cosine >= COSINE
    best: dict[tuple[int, int], tuple] = {}
    h = words.hashes()
    for p, i, c in zip(passages[near[ok]].tolist(), item[ok].tolist(), cosine[ok].tolist(), strict=True):
        row = int(np.searchsorted(base, p, "right")) - 1
        low, high = words.first[row], words.first[row + 1]
        begin = low + (p - base[row]) * b.step
        wanted = b.words[i]
        region = h[max(low, begin - b.step) : min(high, begin + 3 * b.step)].tolist()
        # Only where the item can lie by its telling words: each with the item's words before and after it, and room for inserted ones.
        telling = [(k, *b.telling[i][w]) for k, w in enumerate(region) if w in b.telling[i]]
        if not telling:
            continue
        start, end = min(k - last for k, _, last in telling), max(k + len(wanted) - first for k, first, _ in telling)
        region = region[max(0, start - ROOM) : end + ROOM]
        # Too few of the item's words in any order cannot be enough of them in its own.
        if sum(w in b.sets[i] for w in region) < LIKELY * len(wanted):
            continue
        overlap = common_subsequence(wanted.tolist(), region) / len(wanted)
        tail = wanted[-ANSWER:].tolist()
        answer = common_subsequence(tail, region) >= ANSWER_SHARE * len(tail)
        if overlap >= SURE or (overlap >= LIKELY and answer):
            old = best.get((row, i))
            if old is None or (overlap, c) > (old[1], old[0]):
                best[(row, i)] = (c, overlap, answer)
    for (row, i), (c, overlap, answer) in best.items():
        yield row, b.ids[i], min(1.0, float(c)), overlap, answer
