"""Toxicity: read disguised words through a noisy channel, then score the restored text.

A character trigram model is counted over every text of the corpus. A word is doubtful if it mixes
letters with look-alike signs ("1d10t"), hides a letter behind a star ("id*ot"), sets separators between
single characters ("i.d.i.o.t"), or repeats a letter three times ("idiooot"); signs around a word are taken off. For a
doubtful word a lattice holds the letters that each sign may stand for (a star: any; a single star is read in all 26 ways), in two readings (runs cut to one or to two
letters); Viterbi finds the likeliest path under the model and the channel's costs. Three or more single characters in a
row ("i d i o t") are read as one word, with and without their first or last, and by a lattice with a possible word border before each letter, so that
words beside a spelled one, or several of them, come apart. Words of letters alone have a single path: themselves.

The score rests on whole words and word beginnings whose presence in labelled texts speaks for
toxicity: on the most telling one, and on the sum over words of their most telling one. Signs and weights are learned on a bounded sample
of labelled rows (``SAMPLE`` of each label, chosen by a hash of the id). Only the text is read; null counts as an empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tableferry.llm.quality import chosen, held_out
from tableferry.llm.shared import settle, texts_of
from tableferry.llm.words import Words, _power, mix, slices

SAMPLE = {0: 4000, 1: 4000}
PREFIXES = (4, 5, 6)
# A sign must stand in this share of the sampled toxic texts (so at most words per text / share of them are
# kept) and be this many times as frequent there as elsewhere.
SIGN_SHARE, SIGN_LEAST, SIGN_RATIO = 0.004, 4, 20.0
THRESHOLD = 0.7

# --- fixed values: which letters a sign may stand for
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c"}
# --- end of fixed values
SEPARATORS, MASKS = b".-_*", b"*"
SPELLED, PIECE = 3, 64
SUBSTITUTED, KEPT_SIGN, MASKED = -1.5, -12.0, -2.0
LETTERS = 26
OTHER, SIGN, SYMBOLS = 27, 28, 29  # 0: white space, 1 to 26: letters, 27: bytes of other letters

_CLASS = np.full(256, SIGN, np.int64)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
for _c in range(26):
    _CLASS[97 + _c] = _CLASS[65 + _c] = _c + 1
_CLASS[128:] = OTHER
_IS_LETTER = (_CLASS >= 1) & (_CLASS <= OTHER)
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[[ord(c) for c in LOOKALIKES]] = True
_CHOICES = np.full((256, 3), -1)
for _b in range(256):
    _found = [ord(x) - 96 for x in LOOKALIKES.get(chr(_b), "")]
    _CHOICES[_b, : 1 + len(_found)] = [*_found, _CLASS[_b]] if _found else [_CLASS[_b]]
_COST = np.where(_CHOICES[:, :1] == _CLASS[:, None], 0.0, SUBSTITUTED) * np.ones((1, 3))
for _c in LOOKALIKES:
    _COST[ord(_c)] = [KEPT_SIGN if x == SIGN else SUBSTITUTED for x in _CHOICES[ord(_c)]]
_COST[_CHOICES < 0] = -np.inf
_IS_MASK, _IS_SEPARATOR = np.zeros(256, bool), np.zeros(256, bool)
_IS_MASK[list(MASKS)] = True
_IS_SEPARATOR[list(SEPARATORS)] = True
# The same table with all letters for a mask, used only for words that hold one.
_WIDE_CHOICES = np.full((256, LETTERS), -1)
_WIDE_CHOICES[:, :3] = _CHOICES
_WIDE_COST = np.full((256, LETTERS), -np.inf)
_WIDE_COST[:, :3] = _COST
_WIDE_CHOICES[_IS_MASK] = np.arange(1, LETTERS + 1)
_WIDE_COST[_IS_MASK] = MASKED


def trigrams(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, counted over all texts; 29 * 29 * 29 at most."""

    def count(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for _, _, words in slices(batch.column("text"), lower=True):
                c = np.concatenate(([0], _CLASS[words.data], [0]))
                total += np.bincount(c[:-2] * SYMBOLS**2 + c[1:-1] * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    rows = texts_of(docs).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(SYMBOLS**3)
    for r in rows:
        total[r.gram] = r.n
    three = total.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.01
    two = three.sum(0, keepdims=True)
    return np.log(0.9 * three / three.sum(2, keepdims=True) + 0.1 * two / two.sum(2, keepdims=True)).astype(np.float32)


def _collapsed(word: bytes, most: int) -> bytes:
    out = bytearray()
    for b in word:
        if _IS_LETTER[b] or _IS_SIGN[b] or _IS_MASK[b]:
            if _IS_MASK[b] or len(out) < most or any(x != b for x in out[-most:]):
                out.append(b)
    return bytes(out)


def viterbi(words: list[bytes], model: np.ndarray, borders: bool = False) -> tuple[list[bytes], np.ndarray]:
    """The likeliest letters of words of one length, and their log probability per letter.

    With ``borders`` white space may stand before each letter; it is in the text that comes back.
    """
    n, length = len(words), len(words[0])
    seen = np.frombuffer(b"".join(words), np.uint8).reshape(n, length)
    wide = bool(_IS_MASK[seen].any())
    options, cost = (_WIDE_CHOICES[seen], _WIDE_COST[seen]) if wide else (_CHOICES[seen], _COST[seen])
    k = options.shape[2]
    safe = np.maximum(options, 0)
    # Best score of a path by whether a border stands before its last letter and by its last two choices; white
    # space stands before and after the word.
    score = np.full((n, 2, k, k), -np.inf, np.float32)
    score[:, 1, 0, :] = model[0, 0, safe[:, 0]] + cost[:, 0]
    before = np.zeros((n, k), np.int64)
    back = []
    for t in range(1, length):
        last, this = safe[:, t - 1], safe[:, t]
        # What precedes the last letter: the one before it, or a border.
        ahead = np.stack((np.broadcast_to(before[:, :, None], (n, k, k)), np.zeros((n, k, k), np.int64)), 1)
        joined = score[..., None] + model[ahead[..., None], last[:, None, None, :, None], this[:, None, None, None, :]]
        ways = [joined]
        if borders:
            apart = (score + model[ahead, last[:, None, None, :], 0])[..., None] + model[last[:, :, None], 0, this[:, None, :]][:, None, None]
            ways.append(apart)
        flat = [w.reshape(n, 2 * k, k, k) for w in ways]
        back.append([w.argmax(1) for w in flat])
        score = np.full((n, 2, k, k), -np.inf, np.float32)
        for i, w in enumerate(flat):
            score[:, i] = w.max(1) + cost[:, t][:, None, :]
        before = last
    ahead = np.stack((np.broadcast_to(before[:, :, None], (n, k, k)), np.zeros((n, k, k), np.int64)), 1)
    ended = (score + model[ahead, safe[:, -1][:, None, None, :], 0]).reshape(n, -1)
    best, value = ended.argmax(1), ended.max(1)
    path, border = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
    row, at = np.arange(n), best % k
    prev, flag = best // k % k, best // (k * k)
    path[:, -1] = safe[row, length - 1, at]
    for t in range(length - 1, 0, -1):
        border[:, t] = flag
        path[:, t - 1] = safe[row, t - 1, prev]
        came = back[t - 1][0][row, prev, at]
        if borders:
            came = np.where(flag == 1, back[t - 1][1][row, prev, at], came)
        prev, at, flag = came % k, prev, came // k
    letters = np.where((path >= 1) & (path <= LETTERS), path + 96, seen).astype(np.uint8)
    texts = [letters[i].tobytes() for i in range(n)]
    if borders:
        texts = [b" ".join(x.tobytes() for x in np.split(letters[i], np.flatnonzero(border[i]))) for i in range(n)]
    return texts, value / (length + 1)


def restored(words: list[bytes], model: np.ndarray) -> list[bytes]:
    """The likeliest plain spelling of doubtful words."""
    best: dict[int, tuple[float, bytes]] = {}
    by_length: dict[int, list[tuple[int, bytes]]] = {}
    for i, word in enumerate(words):
        for reading in {_collapsed(word, 1), _collapsed(word, 2)}:
            if reading:
                by_length.setdefault(len(reading), []).append((i, reading))
    for found in by_length.values():
        for part in _shares(found):
            for (i, _), text, value in zip(part, *viterbi([r for _, r in part], model), strict=True):
                if i not in best or (value, text) > best[i]:
                    best[i] = (value, text)
    return [best[i][1] if i in best else w for i, w in enumerate(words)]


def _shares(found: list[tuple[int, bytes]]):
    """Parts of words of one length that the lattice takes at once: fewer of those with masks, as it is wide for them."""
    for masked in (False, True):
        mine = [x for x in found if any(m in x[1] for m in MASKS) == masked]
        step = max(1, (400 if masked else 200_000) // len(found[0][1]))
        for a in range(0, len(mine), step):
            yield mine[a : a + step]


def _filled(word: bytes) -> list[bytes]:
    """A word with one hidden letter has 26 readings; the lattice chooses where more are hidden."""
    hidden = [i for i, b in enumerate(word) if _IS_MASK[b]]
    if len(hidden) != 1:
        return [word]
    return [word[: hidden[0]] + bytes([97 + c]) + word[hidden[0] + 1 :] for c in range(LETTERS)]


def spelled_out(runs: list[bytes], model: np.ndarray) -> list[list[bytes]]:
    """Words that runs of single characters may mean: each run as one word, also without a word of one letter before
    or after it, and as the words it falls into.

    Long runs are read in pieces of ``PIECE`` characters that overlap by half.
    """
    pieces: dict[bytes, list[int]] = {}
    for i, run in enumerate(runs):
        for a in range(0, max(1, len(run) - PIECE // 2), PIECE // 2):
            pieces.setdefault(run[a : a + PIECE], []).append(i)
    by_length: dict[int, list[tuple[int, bytes]]] = {}
    for piece in pieces:
        by_length.setdefault(len(piece), []).append((0, piece))
    words: list[list[bytes]] = [[] for _ in runs]
    for found in by_length.values():
        for part in _shares(found):
            for (_, piece), text in zip(part, viterbi([r for _, r in part], model, borders=True)[0], strict=True):
                for i in pieces[piece]:
                    words[i] += text.split(b" ")
    ways = [restored([r[a : len(r) - z] for r in runs], model) for a, z in ((0, 0), (1, 0), (0, 1))]
    return [list(dict.fromkeys([*alone, *ws])) for *alone, ws in zip(*ways, words, strict=True)]


def _trimmed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without the signs before the first and after the last letter or digit.

    Signs that may stand for a letter stay at the start, but for an opening bracket; a word of signs alone is empty.
    """
    if not len(words.ends):
        return words.starts, words.ends
    solid = _IS_LETTER[words.data] | ((words.data >= 48) & (words.data <= 57))
    last = np.maximum.accumulate(np.where(solid, np.arange(len(solid)), -1)) + 1
    ends = np.maximum(last[words.ends - 1], words.starts)
    opening = solid | (_IS_SIGN[words.data] & (words.data != ord("(")))
    following = np.minimum.accumulate(np.where(opening, np.arange(len(solid)), len(solid))[::-1])[::-1]
    return np.minimum(following[words.starts], ends), ends


def doubtful(words: Words, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray, list[bytes], np.ndarray]:
    """Doubtful words of a slice and the number of each, runs of single characters and the number of the first word of each."""
    data = words.data
    if not len(ends):
        return [], np.zeros(0, np.int64), [], np.zeros(0, np.int64)

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[ends] - total[starts]

    run = np.zeros(len(data), bool)
    if len(data) > 2:
        run[:-2] = _IS_LETTER[data[:-2]] & (data[:-2] < 128) & (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:])
    letters, parted = within(_IS_LETTER[data]), within(_IS_SEPARATOR[data])
    # Separators between single characters: at least as many as letters and look-alikes but one.
    apart = (parted >= 2) & (parted >= letters + within(_IS_SIGN[data]) - 1)
    odd = ((letters > 0) & ((within(_IS_SIGN[data]) > 0) | (within(_IS_MASK[data]) > 0) | apart)) | (within(run) > 0)
    at = np.flatnonzero(odd & (ends > starts))
    text = data.tobytes()
    found = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
    found = [w.translate(None, SEPARATORS) if p else w for w, p in zip(found, apart[at].tolist(), strict=True)]
    readings = [_filled(w) for w in found]
    at, found = np.repeat(at, [len(r) for r in readings]), [w for r in readings for w in r]
    # Single characters in a row, in one text, are spelled out; signs around each do not count.
    single = np.concatenate(([False], (ends - starts == 1), [False]))
    split = np.concatenate(([True], words.rows[1:] != words.rows[:-1]))
    begin = np.flatnonzero(single[1:-1] & (~single[:-2] | split))
    stop = np.flatnonzero(single[1:-1] & (~single[2:] | np.append(split[1:], True))) + 1
    long = stop - begin >= SPELLED
    runs = [data[starts[a:b]].tobytes() for a, b in zip(begin[long].tolist(), stop[long].tolist(), strict=True)]
    return found, at, runs, begin[long]


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def signs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of whole words and of their beginnings, and the row of each."""
    keys, at = [_span_hashes(data, starts, ends, 0)], [rows]
    for k in PREFIXES:
        long = ends - starts > k
        keys.append(_span_hashes(data, starts[long], starts[long] + k, k))
        at.append(rows[long])
    return np.concatenate(keys), np.concatenate(at)


def all_signs(texts: pa.Array, model: np.ndarray):
    """(first row, rows, sign hashes, row of each, word of each) of every slice, of the text as it is and as restored."""
    for a, b, words in slices(texts, lower=True):
        starts, ends = _trimmed(words)
        keys, at = signs(words.data, starts, ends, np.arange(len(ends)))
        found, which, runs, first = doubtful(words, starts, ends)
        # Different doubtful words are read once.
        number: dict[bytes, int] = {}
        plain = [number.setdefault(w, len(number)) for w in found]
        read = restored(list(number), model)
        spelled: dict[bytes, int] = {}
        named = [spelled.setdefault(r, len(spelled)) for r in runs]
        readings = spelled_out(list(spelled), model) if runs else []
        texts_read = [read[i] for i in plain] + [w for i in named for w in readings[i]]
        if texts_read:
            # A reading counts as the word that it was read from, a word of a run as one beyond the slice's words.
            n = sum(len(readings[i]) for i in named)
            owner = np.concatenate((which, len(ends) + np.arange(n)))
            rows = np.concatenate((words.rows, np.repeat(words.rows[first], [len(readings[i]) for i in named])))
            stops = np.cumsum([len(w) for w in texts_read])
            begins = stops - [len(w) for w in texts_read]
            more, where = signs(np.frombuffer(b"".join(texts_read), np.uint8), begins, stops, owner)
            keys, at = np.concatenate((keys, more)), np.concatenate((at, where))
        else:
            rows = words.rows
        yield a, b, keys, rows[at], at


class ToxicityModel:
    def __init__(self, model: np.ndarray, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.model, self.keys, self.weights = model, keys[order], weights[order]
        self.slope, self.many, self.offset = 1.0, 0.0, -4.0

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text the largest weight of a sign in it, and the logarithm of the sum of its words' largest weights."""
        out = np.zeros((len(texts), 2))
        if not len(self.keys):
            return out
        for a, b, keys, rows, word in all_signs(texts, self.model):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            if not hit.any():
                continue
            weight, row, word = self.weights[at[hit]], rows[hit], word[hit]
            best = np.zeros(b - a)
            np.maximum.at(best, row, weight)
            out[a:b, 0] = best
            order = np.lexsort((-weight, word))
            first = order[np.concatenate(([True], word[order][1:] != word[order][:-1]))]
            out[a:b, 1] = np.log1p(np.bincount(row[first], weight[first], minlength=b - a))
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.slope * features[:, 0] + self.many * features[:, 1] + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def calibrated(self, features: np.ndarray, y: np.ndarray) -> ToxicityModel:
        """Newton's steps of a logistic regression with a small ridge."""
        if not len(y):
            return self
        x = np.column_stack((features, np.ones(len(y))))
        w = np.array([self.slope, self.many, self.offset])
        ridge = np.array([0.01, 0.01, 0.001]) * len(y) / 100
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
            w = w - np.linalg.solve(hess, x.T @ (p - y) + ridge * w)
        self.slope, self.many, self.offset = w
        return self


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    model = trigrams(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Half of the sample finds the signs, the other half sets the weights.
    picked = F.broadcast(chosen(labels, label, SAMPLE))
    sample = settle(texts_of(docs).join(picked, "doc_id").withColumn("half", F.xxhash64(F.lit(1), "doc_id") % 2 == 0), "sample")

    def count(batches):
        for batch in batches:
            for _, _, keys, rows, _ in all_signs(batch.column("text"), shared.value):
                pair = np.unique(np.column_stack((keys.view(np.int64), rows)), axis=0)
                key, n = np.unique(pair[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["sign", "n1"])

    sides = {r.label: r.n for r in sample.where("half").groupBy("label").agg(F.count("*").alias("n")).collect()}
    t, c = sides.get(1, 0), sides.get(0, 0)
    least = max(SIGN_LEAST, SIGN_SHARE * t)
    toxic = sample.where("half AND label = 1").mapInArrow(count, "sign long, n1 long").groupBy("sign").agg(F.sum("n1").alias("n1")).where(F.col("n1") >= least)
    named = {r.sign: r.n1 for r in toxic.collect()}
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(list(named), np.int64)))

    def clean(batches):
        for batch in batches:
            for _, _, keys, rows, _ in all_signs(batch.column("text"), shared.value):
                hit = np.isin(keys.view(np.int64), wanted.value)
                pair = np.unique(np.column_stack((keys[hit].view(np.int64), rows[hit])), axis=0)
                key, n = np.unique(pair[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["sign", "n"])

    elsewhere = {r.sign: r.n for r in sample.where("half AND label = 0").mapInArrow(clean, "sign long, n long").groupBy("sign").agg(F.sum("n").alias("n")).collect()}
    ratio = {k: (n + 0.5) / (t + 1) / ((elsewhere.get(k, 0) + 0.5) / (c + 1)) for k, n in named.items()}
    kept = [k for k, r in ratio.items() if r >= SIGN_RATIO]
    found = ToxicityModel(model, np.array(kept, np.int64).view(np.uint64), np.log(np.array([ratio[k] for k in kept])))
    other = _featured(sample.where("NOT half").select("doc_id", "text", "label"), found).select("label", "x", "y").collect()
    return found.calibrated(np.array([(r.x, r.y) for r in other]).reshape(-1, 2), np.array([r.label for r in other], float))


def _featured(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField("x", DoubleType()), StructField("y", DoubleType())])

    def add(batches):
        for batch in batches:
            f = shared.value.features(batch.column("text"))
            yield batch.append_column("x", pa.array(f[:, 0])).append_column("y", pa.array(f[:, 1]))

    return docs.mapInArrow(add, schema)


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted; columns of these names are replaced."""
    kept = docs.drop("held_out", "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType())])

    def score(batches):
        for batch in batches:
            found = shared.value
            yield batch.append_column("score", pa.array(found.scores(found.features(batch.column("text")))))

    out = kept.mapInArrow(score, schema)
    return out.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= THRESHOLD).cast("int")})
