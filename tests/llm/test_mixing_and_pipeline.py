"""Mixing, decontamination and the pipeline against plain computations on small data."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableferry.llm import decontamination, mixing
from tests.llm.helpers import frame

LANGUAGES = {"xx": ["la", "le", "lo", "mi", "mo"], "yy": ["ka", "ke", "ta", "te"], "zz": ["su", "so", "sa", "ra"]}


def texts(seed: int, n: int):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choices(list(LANGUAGES), [6, 3, 1])[0]
        rows.append((i, " ".join(rng.choice(LANGUAGES[lang]) for _ in range(rng.randint(1, 40))), lang))
    return rows


def test_rates_meet_the_targets(spark):
    rows = texts(1, 150)
    odd = [(1000, None), (1001, ""), (1002, "la " * 20_000), (1003, "la ka"), (1003, "la ka"), (None, "su")]
    docs = frame(spark, [(i, t) for i, t, _ in rows] + odd).withColumn("tokens", F.lit(1))
    labelled = spark.createDataFrame([(t, lang) for _, t, lang in rows[:60]] + [(None, "xx"), ("la", None)], "text string, domain string")
    weights = {"xx": 0.2, "yy": 0.3, "zz": 0.5}
    got = mixing.mixed(docs, labelled, weights, total=50_000.0).collect()
    assert len(got) == len(rows) + len(odd) and all(r.rate >= 0 and abs(r.copies - r.rate) <= 1 for r in got)
    # The rates are those of a plain projected gradient, and what they give meets the targets.
    model = mixing.learned(labelled)
    known = mixing.posteriors(docs, model).collect()
    p = [[r[f"p{k}"] for k in range(3)] for r in known]
    t = [r.tokens for r in known]
    assert all(abs(sum(x) - 1) < 1e-9 for x in p)
    own = [sum(a * b[k] for a, b in zip(t, p, strict=True)) for k in range(3)]
    goal = [50_000 * weights[d] for d in model.domains]
    rate = [1.0] * len(p)
    for _ in range(mixing.STEPS):
        now = [sum(r * a * b[k] for r, a, b in zip(rate, t, p, strict=True)) for k in range(3)]
        if all(abs(x - g) <= mixing.TOLERANCE * g for x, g in zip(now, goal, strict=True)):
            break
        gap = [(x - g) / max(o, 1.0) for x, g, o in zip(now, goal, own, strict=True)]
        rate = [max(0.0, r - sum(a * g for a, g in zip(b, gap, strict=True))) for r, b in zip(rate, p, strict=True)]
    assert all(abs(x - g) <= 1e-3 * g for x, g in zip(now, goal, strict=True))
    key = lambda i, n: (i is None, i or 0, n)
    assert [r for _, r in sorted((key(r.doc_id, r.tokens), r.rate) for r in got)] == pytest.approx([x for _, x in sorted((key(r.doc_id, r.tokens), x) for r, x in zip(known, rate, strict=True))], rel=1e-6)


def test_posterior_is_that_of_naive_bayes(spark):
    labelled = spark.createDataFrame([("la le la", "a"), ("ka", "b"), ("ka ka", "b")], "text string, domain string")
    model = mixing.learned(labelled)
    assert model.domains == ["a", "b"] and model.prior == pytest.approx([math.log(1 / 3), math.log(2 / 3)])
    got = mixing.posteriors(spark.createDataFrame([(1, "la la"), (2, "ka"), (3, None)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert got[0].p0 > 0.9 and got[1].p1 > 0.9 and got[2].p0 == pytest.approx(1 / 3) and [r.tokens for r in got] == [2, 1, 0]


def test_default_targets_thin_out_nothing(spark):
    rows = texts(2, 200)
    labelled = spark.createDataFrame([(t, lang) for _, t, lang in rows], "text string, domain string")
    got = mixing.mixed(frame(spark, [(i, t) for i, t, _ in rows]), labelled).collect()
    assert min(r.rate for r in got) >= 1 and {r.domain for r in got} == set(LANGUAGES)


def test_mixing_of_nothing(spark):
    none = spark.createDataFrame([], "text string, domain string")
    assert [r.rate for r in mixing.mixed(frame(spark, [(1, "a")]), none).collect()] == [1.0]
    some = spark.createDataFrame([("a", "x")], "text string, domain string")
    assert mixing.mixed(frame(spark, []), some).count() == 0


def benchmark(seed: int, n: int = 25):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(15, 60)))) for i in range(n)]


def test_leaks_are_found_and_nothing_else(spark):
    rng = random.Random(9)
    items = benchmark(3)
    common = [rng.choice(items)[1].split()[0] for _ in range(30)]
    words = common + ["".join(rng.choice("klmnrstaeiou") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    fill = lambda k: " ".join(rng.choice(words) for _ in range(k))
    rows, want = [(900, None), (901, ""), (902, fill(30_000))], set()
    for i in range(120):
        if i % 3 == 0:
            item, text = rng.choice(items)
            parts = text.split()
            if i % 2:
                # A paraphrase: every sixth word is another one, some are left out.
                parts = [rng.choice(words) if k % 6 == 2 else w for k, w in enumerate(parts) if k % 11 != 5]
            rows.append((i, f"{fill(rng.randint(0, 300))} {' '.join(parts).upper()} {fill(rng.randint(0, 300))}"))
            want.add((i, item))
        else:
            rows.append((i, fill(rng.randint(1, 400))))
    got = decontamination.leaks(frame(spark, rows), spark.createDataFrame([*items, (99, None), (98, ""), (None, "x y")], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0 <= r.similarity <= 1 and decontamination.LIKELY <= r.overlap <= 1 for r in got)


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    items = benchmark(4)
    docs = frame(spark, [(i, f"some words {t} and more words") for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 300)
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == whole == {(i, i) for i, _ in items}


def test_items_of_ordinary_words_stand_word_for_word(spark):
    """The few telling words of an item lie close together, at its begin, middle or end."""
    rng = random.Random(6)
    usual = [f"u{i}" for i in range(60)]
    items = []
    for i in range(30):
        words = [rng.choice(usual) for _ in range(rng.choice([59, 100, 150, 200]))]
        at = (0, len(words) // 2, len(words) - 8)[i % 3]
        words[at : at + 8] = [f"r{i}y{k}" for k in range(8)]
        items.append((i, " ".join(words)))
    other = [" ".join(rng.choice(usual) for _ in range(rng.randint(100, 400))) for _ in range(150)]
    rows = [(i, f"{other[i]} {t} {other[i + 30]}") for i, t in items] + [(100 + k, t) for k, t in enumerate(other)]
    got = decontamination.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.overlap) for r in got} == {(i, i, 1.0) for i, _ in items}


def test_leaks_of_nothing(spark):
    bench = spark.createDataFrame(benchmark(1, 2), "item_id long, text string")
    assert decontamination.leaks(frame(spark, []), bench).count() == 0
    assert decontamination.leaks(frame(spark, [(1, "a b c")]), bench.limit(0)).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]


def test_pipeline_on_the_smallest_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = whole, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "mixing":
            assert out.columns == whole.columns
        path = corpus_pipeline.new_folder(spark, "test")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.count())
        assert docs.select("doc_id").exceptAll(whole.select("doc_id")).isEmpty()
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.6 * whole.count()
    last = docs.select("doc_id", "rate", "copies").collect()
    assert {(r.doc_id, r.copies) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "copies").collect()} == {(r.doc_id, r.copies) for r in last}
    assert all(r.copies >= 1 for r in last)
