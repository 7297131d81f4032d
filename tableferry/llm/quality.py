"""Quality classifier: a convolutional network over bytes, written in numpy.

Bytes are embedded; learned filters of ``WIDTH`` bytes slide over the whole text in steps of ``STRIDE``;
the text is cut into overlapping chunks of ``2 * HOP`` bytes that begin every ``HOP`` bytes and together cover it,
and each filter is max-pooled over every chunk. The mean and the maximum over all chunks feed one
logistic unit. Only the text is read.

The network is fitted on a bounded sample of labelled rows (``SAMPLE`` of each label, of texts up to
``SAMPLE_CHARS`` characters, chosen by a hash of the id); scoring covers every whole text. Null counts
as an empty text, which has a score like any other.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

EMBED, WIDTH, STRIDE, FILTERS, HOP = 6, 8, 4, 16, 128
SAMPLE, SAMPLE_CHARS, EPOCHS, BATCH = {0: 900, 1: 2700}, 20_000, 5, 32
SCORE_BYTES = 1 << 20


def held_out(key: str = "doc_id") -> Column:
    """Rows kept out of every fit: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, each: dict[int, int] = SAMPLE) -> list[tuple[str, int]]:
    """At most ``each`` training rows (text, label) of each label; more of the good ones, so that short clean texts stay."""
    rows = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen(labels, label, each)), "doc_id")
    return [(r.text, r.label) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "label").collect()]


def chosen(labels: DataFrame, label: str, each: dict[int, int]) -> DataFrame:
    """(doc_id, label) of at most ``each`` training rows of each label, by a hash of the id: a bounded number."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    parts = [marked.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in each.items()]
    return reduce(DataFrame.unionAll, parts)


class ByteNetwork:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.params = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": rng.normal(0, 0.3, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "offset": np.zeros(1, np.float32),
        }
        self.params["embed"][0] = 0

    @staticmethod
    def _laid(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts padded with zero bytes to whole hops, and the first hop of each."""
        sizes = np.diff(offsets)
        hops = -(-(sizes + WIDTH - STRIDE) // HOP)
        first = np.concatenate(([0], np.cumsum(hops)))
        laid = np.zeros(int(first[-1]) * HOP, np.uint8)
        shift = np.repeat(first[:-1] * HOP - offsets[:-1], sizes)
        laid[np.arange(offsets[0], offsets[-1]) + shift] = data[offsets[0] : offsets[-1]]
        return laid, first

    def _pooled(self, laid: np.ndarray, first: np.ndarray):
        """Filter maxima per hop and, per text, which hop pairs are chunks."""
        p, half = self.params, STRIDE * EMBED
        blocks = p["embed"][laid].reshape(-1, half)
        act = blocks @ p["filters"][:half]
        act[:-1] += (blocks @ p["filters"][half:])[1:]
        act += p["bias"]
        per = HOP // STRIDE
        act[first[1:] * per - 1] = 0  # the last block is padding
        by_hop = act.reshape(-1, per, FILTERS)
        return blocks, by_hop, np.maximum(by_hop.max(1), 0)

    @staticmethod
    def _chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second hop of every chunk, and the first chunk of each text."""
        hops = np.diff(first)
        many = np.maximum(hops - 1, 1)
        at = np.concatenate(([0], np.cumsum(many)))
        a = np.repeat(first[:-1] - at[:-1], many) + np.arange(at[-1])
        return a, a + np.repeat((hops > 1).astype(np.int64), many), at

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        laid, first = self._laid(data, offsets)
        _, _, hop = self._pooled(laid, first)
        a, b, at = self._chunks(first)
        chunk = np.maximum(hop[a], hop[b])
        mean = np.add.reduceat(chunk, at[:-1]) / np.diff(at)[:, None]
        z = np.concatenate((mean, np.maximum.reduceat(chunk, at[:-1])), 1) @ self.params["weights"] + self.params["offset"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _gradients(self, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, half, per = self.params, STRIDE * EMBED, HOP // STRIDE
        laid, first = self._laid(data, offsets)
        blocks, by_hop, hop = self._pooled(laid, first)
        a, b, at = self._chunks(first)
        chunk, many = np.maximum(hop[a], hop[b]), np.diff(at)
        features = np.concatenate((np.add.reduceat(chunk, at[:-1]) / many[:, None], np.maximum.reduceat(chunk, at[:-1])), 1)
        z = features @ p["weights"] + p["offset"]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        back = error[:, None] * p["weights"]
        g_chunk = np.repeat(back[:, :FILTERS] / many[:, None], many, 0)
        top = chunk == np.repeat(features[:, FILTERS:], many, 0)
        g_chunk += np.repeat(back[:, FILTERS:], many, 0) * top / np.repeat(np.add.reduceat(top.astype(np.float32), at[:-1]), many, 0)
        g_hop = np.zeros_like(hop)
        left = hop[a] >= hop[b]
        np.add.at(g_hop, a, g_chunk * left)
        np.add.at(g_hop, b, g_chunk * ~left)
        g_hop *= hop > 0
        where = np.arange(len(hop))[:, None] * per + by_hop.argmax(1)
        g_filters, g_blocks = np.zeros_like(p["filters"]), np.zeros_like(blocks)
        nxt = np.minimum(where + 1, len(blocks) - 1)
        for k in range(FILTERS):
            g = g_hop[:, k]
            g_filters[:half, k] = g @ blocks[where[:, k]]
            g_filters[half:, k] = g @ blocks[nxt[:, k]]
            np.add.at(g_blocks, where[:, k], g[:, None] * p["filters"][:half, k])
            np.add.at(g_blocks, nxt[:, k], g[:, None] * p["filters"][half:, k])
        flat = g_blocks.reshape(-1, EMBED)
        used = np.flatnonzero(flat.any(1))
        g_embed = np.zeros_like(p["embed"])
        np.add.at(g_embed, laid[used], flat[used])
        g_embed[0] = 0
        return {"embed": g_embed, "filters": g_filters, "bias": g_hop.sum(0), "weights": features.T @ error + 1e-4 * p["weights"], "offset": np.array([error.sum()])}

    def fit(self, rows: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 3) -> ByteNetwork:
        """Adam over shuffled batches; the two labels weigh as they come in ``rows``."""
        if not rows:
            return self
        rng, raw = np.random.default_rng(seed), [t.encode() for t, _ in rows]
        y = np.array([v for _, v in rows], np.float32)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        s = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                pick, step = order[at : at + BATCH], step + 1
                offsets = np.concatenate(([0], np.cumsum([len(raw[i]) for i in pick])))
                grads = self._gradients(np.frombuffer(b"".join(raw[i] for i in pick), np.uint8), offsets, y[pick])
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.params[k] = (self.params[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality") -> ByteNetwork:
    return ByteNetwork().fit(labelled_sample(docs, labels, label))


def scored(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted; columns of these names are replaced."""
    kept = docs.drop("held_out", "score", "predicted")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            out, a = [], 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SCORE_BYTES, "right")) - 1)
                out.append(shared.value.scores(data, offsets[a : b + 1]))
                a = b
            yield batch.append_column("score", pa.array(np.concatenate(out).astype(np.float64)))

    out = kept.mapInArrow(score, schema)
    return out.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= 0.5).cast("int")})
