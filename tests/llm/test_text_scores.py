"""Classifiers by their accuracy on rows they did not see, and their behaviour on awkward texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tableferry.llm import quality, toxicity
from tests.llm.helpers import frame

ODD = [(-1, None), (-2, ""), (-3, "x"), (-4, "a b c d e f"), (-5, "z" * 200_000), (-6, "ok " * 50_000)]


def labelled(seed: int, bad, n: int = 400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text, mark = [rng.choice(words) for _ in range(rng.randint(5, 120))], rng.random() < 0.4
        rows.append((i, bad(rng, text) if mark else " ".join(text)))
        labels.append((i, int(not mark), int(mark)))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def accuracy(got, labels, column):
    want = {d: (q, t)[column] for d, q, t in labels}
    rows = [r for r in got if r.doc_id in want and r.held_out]
    assert rows and all(r.held_out == held(r.doc_id) for r in got)
    return sum(r.predicted == want[r.doc_id] for r in rows) / len(rows)


def test_quality(spark):
    rows, labels = labelled(1, lambda rng, t: " ".join(w.upper() + rng.choice(["!!", "$$$", "###"]) for w in t))
    docs = frame(spark, rows + ODD)
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality.scored(docs, quality.fitted(docs, marks)).collect()
    assert len(got) == len(rows) + len(ODD) and accuracy(got, labels, 0) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.lang == "en" for r in got)


def test_network_pools_the_whole_text():
    net = quality.ByteNetwork()
    data = np.random.default_rng(0).integers(1, 255, 5000).astype(np.uint8)
    whole = net.scores(data, np.array([0, 5000]))
    assert np.allclose(whole, net.scores(np.concatenate((data[:70], data)), np.array([0, 70, 5070]))[1:], atol=1e-5)
    # A change at the very end counts.
    other = data.copy()
    other[-8:] = 33
    assert not np.allclose(whole, net.scores(other, np.array([0, 5000])), atol=1e-7)


def test_gradients_are_slopes():
    net = quality.ByteNetwork(2)
    rng = np.random.default_rng(1)
    data, offsets, y = rng.integers(1, 255, 900).astype(np.uint8), np.array([0, 100, 420, 900]), np.array([0.0, 1.0, 1.0])

    def loss():
        p = net.scores(data, offsets).astype(float)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net._gradients(data, offsets, y)
    for name, at in (("offset", (0,)), ("weights", (3,)), ("weights", (20,)), ("bias", (2,)), ("filters", (5, 2))):
        value, step = net.params[name][at], 2e-2
        net.params[name][at] = value + step
        up = loss()
        net.params[name][at] = value - step
        down = loss()
        net.params[name][at] = value
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=4e-3)


DISGUISES = ["idiot", "1d10t", "idiooot", "i d i o t", "scum", "5cum", "s c u m", "m0r0n", "moron"]
DISGUISES += ["(idiot", '"idiot', "a i d i o t", "i.d.i.o.t", "i-d-i-o-t", "i d i o t.", "id*ot", "s c u m m o r o n", "'m 0 r 0 n!", "i*d*i*o*t", "(1d10t)"]


def test_toxicity_and_disguised_words(spark):
    def insult(rng, t):
        for w in rng.sample(["idiot", "moron", "scum"], 2):
            t.insert(rng.randrange(len(t)), w)
        return " ".join(t)

    rows, labels = labelled(2, insult, 600)
    hidden = [(1000 + i, f"tresalo {w} nanires loti") for i, w in enumerate(DISGUISES)]
    docs = frame(spark, rows + ODD + hidden)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, toxicity.fitted(docs, marks)).collect()
    assert accuracy(got, labels, 1) > 0.97
    found = {r.doc_id: r for r in got}
    assert all(found[d].predicted == 1 for d, _ in hidden), [(t, found[d].score) for d, t in hidden]
    assert all(found[d].predicted == 0 for d, _ in ODD)


def test_models_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, ODD)
    for m, label in ((quality, "quality"), (toxicity, "toxic")):
        got = m.scored(docs, m.fitted(docs, empty, label)).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert m.scored(frame(spark, []), m.fitted(frame(spark, []), empty, label)).count() == 0


def test_best_path_with_borders_is_the_best_of_all():
    """The lattice with masks and borders against every reading."""
    import itertools

    rng = np.random.default_rng(5)
    model = np.log(rng.dirichlet(np.ones(29) / 4, (29, 29)) + 1e-4).astype(np.float32)
    for word in (b"a1bc", b"x*", b"*1", b"0!a", b"q"):
        wide = b"*" in word
        table = (toxicity._WIDE_CHOICES, toxicity._WIDE_COST) if wide else (toxicity._CHOICES, toxicity._COST)
        choices = [[(o, c) for o, c in zip(table[0][b], table[1][b], strict=True) if o >= 0] for b in word]
        best = (-np.inf, None)
        for path in itertools.product(*choices):
            for cuts in itertools.product((False, True), repeat=len(word) - 1):
                symbols = [0, 0, path[0][0]]
                for (o, _), cut in zip(path[1:], cuts, strict=True):
                    symbols += [0, o] if cut else [o]
                symbols.append(0)
                value = sum(c for _, c in path) + sum(model[symbols[i], symbols[i + 1], symbols[i + 2]] for i in range(len(symbols) - 2))
                best = max(best, (value, symbols))
        text, value = toxicity.viterbi([word], model, borders=True)
        assert value[0] * (len(word) + 1) == pytest.approx(best[0], rel=1e-4)
        assert [len(p) for p in text[0].split(b" ")] == [len(list(g)) for k, g in itertools.groupby(best[1][2:-1], lambda x: x == 0) if not k]


def test_best_path_is_the_best_of_all():
    """Viterbi against every reading of short words."""
    import itertools

    rng = np.random.default_rng(3)
    model = np.log(rng.dirichlet(np.ones(29), (29, 29))).astype(np.float32)
    for word in (b"a1b", b"1!0", b"$3x", b"x"):
        choices = [[(o, c) for o, c in zip(toxicity._CHOICES[b], toxicity._COST[b], strict=True) if o >= 0] for b in word]
        best = -np.inf
        for path in itertools.product(*choices):
            symbols = [0, 0, *(o for o, _ in path), 0]
            best = max(best, sum(c for _, c in path) + sum(model[symbols[i], symbols[i + 1], symbols[i + 2]] for i in range(len(symbols) - 2)))
        assert toxicity.viterbi([word], model)[1][0] * (len(word) + 1) == pytest.approx(best, rel=1e-4)
