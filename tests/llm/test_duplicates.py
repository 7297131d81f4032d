"""Substring and near-duplicate removal against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tableferry.llm import components as comps
from tableferry.llm import near_duplicates as nd
from tableferry.llm import substring_dedup as sd
from tableferry.llm.components import components
from tableferry.llm.fm_index import FMIndex
from tests.llm.helpers import WORD, corpus, frame


def without_repeats(rows, length):
    words = {d: WORD.findall(t or "") for d, t in rows}
    first: dict[tuple, int] = {}
    for d in words:
        for i in range(len(words[d]) - length + 1):
            k = tuple(words[d][i : i + length])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, ws in words.items():
        gone = set()
        for i in range(len(ws) - length + 1):
            if first[tuple(ws[i : i + length])] < d:
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[d] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages(spark, seed):
    rows = corpus(seed)
    got = sd.without_repeats(frame(spark, rows), 13).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == without_repeats(rows, 13)
    # The text returned holds just the kept words, and other columns are as they were.
    for r in got:
        assert hashlib.sha256(" ".join(WORD.findall(r.text)).encode()).hexdigest() == r.kept_sha256
        assert (r.lang, r.score) == ("en", "x")


def test_heavy_triples_are_split(spark, monkeypatch):
    monkeypatch.setattr(sd, "HEAVY_SHARE", 1e-9)
    heavy, total = sd.heavy_triples(frame(spark, corpus(3) * 40, False), 13)
    assert total and len(heavy)
    rows = corpus(3)
    docs = frame(spark, rows, False)
    monkeypatch.setattr(sd, "heavy_triples", lambda docs, length: (heavy, total))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sd.without_repeats(docs, 13).collect()}
    assert got == without_repeats(rows, 13)


def test_no_documents_and_no_ids(spark):
    assert sd.without_repeats(frame(spark, []), 13).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    got = sd.without_repeats(frame(spark, [(None, text), (None, text), (5, text), (9, text), (9, text)]), 13).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (5, 0), (9, 30), (9, 30)]


def test_index_counts_all_windows():
    rng = np.random.default_rng(0)
    text = np.append(rng.integers(1, 6, 2000), 0)
    at = np.arange(1996)
    hit, low, high = FMIndex(text, 5).matches(text, at, 5)
    seen: dict[tuple, int] = {}
    for i in at:
        seen[tuple(text[i : i + 5])] = seen.get(tuple(text[i : i + 5]), 0) + 1
    assert {int(h): int(b - a) for h, a, b in zip(hit, low, high, strict=True)} == {i: n for i in range(1996) if (n := seen[tuple(text[i : i + 5])]) > 1}


def groups(rows, size, percent):
    sets = {}
    for d, t in rows:
        ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)} if len(ws) >= size else ({tuple(ws)} if ws else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    rows = corpus(4, 120)
    got = nd.near_duplicates(frame(spark, rows), size, percent).collect()
    want = groups(rows, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == want[r.doc_id][1]) for r in got)


def test_lists_are_cut_into_blocks(spark, monkeypatch):
    """Members of one list that meet only in the last pass."""
    monkeypatch.setattr(nd, "BLOCK", 3)
    monkeypatch.setattr(nd, "STILL", 0.0)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(14):
        words = list(base)
        words[4 * i : 4 * i + i % 4] = [f"x{i}y{k}" for k in range(i % 4)]
        rows.append((i, " ".join(words)))
    got = nd.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows, 3, 85)


def test_a_large_family_of_different_near_copies(spark):
    """All values of the family are heavy; what a member shares with it has to be posted all the same."""
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 600):
        words = list(base)
        for place in random.Random(i).sample(range(2, 298, 8), 6):
            words[place] = f"x{i}y{place}"
        rows.append((i, " ".join(words)))
    want = groups(rows, 5, 80)
    assert {c for _, c in want.values()} == {0}
    got = nd.near_duplicates(frame(spark, rows), 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


@pytest.mark.parametrize(("block", "changes"), [(1024, 5), (100, 5), (100, 4)])
def test_no_step_has_as_many_rows_as_a_family_has_pairs(spark, monkeypatch, block, changes):
    """Near copies of one text that are mostly just below the similarity asked for, or just above it."""
    made = []

    def counted(df, purpose="settled", settle=nd.settle):
        out = settle(df, purpose)
        made.append((out.count(), purpose))
        return out

    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "settle", counted)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for place in random.Random(i).sample(range(2, 298, 4), changes):
            words[place] = f"x{i}y{place}"
        rows.append((i, " ".join(words)))
    got = nd.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows, 3, 85)
    # 400 classes have 20 postings each and 79,800 pairs.
    assert max(made)[0] <= 20 * 400, max(made)


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefixes_of_agreeing_signatures_meet(percent):
    """Whichever coordinates differ, and whichever values are posted last."""
    least, rng = nd.agreeing_least(percent), np.random.default_rng(percent)
    posts = nd.POSTED - least + 1
    for _ in range(300):
        x = rng.integers(0, 1 << 32, nd.POSTED, dtype=np.uint32)[None]
        y = x.copy()
        y[0, rng.permutation(nd.POSTED)[least:]] += np.uint32(1)
        heavy = nd._slots(x)[0][rng.permutation(nd.POSTED)[: rng.integers(0, nd.POSTED + 1)]]
        if rng.random() < 0.5:
            heavy = np.intersect1d(nd._slots(x), nd._slots(y))
        kept = [nd._slots(z)[0][np.argsort(np.isin(nd._slots(z)[0], heavy), kind="stable")[:posts]] for z in (x, y)]
        assert len(np.intersect1d(*kept))


def test_near_duplicates_of_nothing(spark):
    assert nd.near_duplicates(frame(spark, []), 3, 85).count() == 0
    got = nd.near_duplicates(frame(spark, [(1, None), (2, ""), (3, None)]), 3, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 10 for i in range(10, 41)} | {i: 100 for i in range(100, 130)}


@pytest.mark.parametrize("rows", [7, 100, 100_000])
def test_components_of_several_tasks(spark, monkeypatch, rows):
    monkeypatch.setattr(comps, "TASK_ROWS", rows)
    rng = random.Random(rows)
    links = [(rng.randrange(600), rng.randrange(600)) for _ in range(300)]
    parent = list(range(600))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = [(r.id, r.component_id) for r in components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect()]
    assert len(got) == len(dict(got))
    assert dict(got) == {x: root(x) for x in {x for link in links if link[0] != link[1] for x in link}}


def test_a_shared_passage_gives_a_document_a_few_spans(spark):
    """One passage of 100 words in very many documents, all of its triples heavy."""
    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(5)] + passage + [f"b{i}x{k}" for k in range(5)])) for i in range(2000)]
    docs = frame(spark, rows, False)
    heavy, _ = sd.heavy_triples(sd.texts_of(docs), 30)
    assert len(heavy)
    spans = sd.repeated_spans(docs, 30).collect()
    assert len({r.doc_id for r in spans}) == 1999 and len(spans) < 25 * 1999
    got = {r.doc_id: r.n_removed for r in sd.without_repeats(docs, 30).select("doc_id", "n_removed").collect()}
    assert got == {i: 100 if i else 0 for i in range(2000)}
