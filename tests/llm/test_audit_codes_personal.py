"""Filter audit, vector codes and personal data against plain computations."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tableferry.llm import filter_audit, personal_data, term_matrix, vector_codes
from tests.llm.helpers import corpus


def audit_rows():
    rng = random.Random(4)
    rows = [(i, t, rng.choice(["a", "b", None, "b"])) for i, t in corpus(9, 80)]
    marked = [(100 + i, " ".join(rng.choice(["Word", "x", "y1", "#", "ok", "é", "LOUD"]) for _ in range(rng.choice([10, 70]))), "c") for i in range(40)]
    copies = [(200 + i, rows[20][1], rng.choice("abc")) for i in range(30)]
    return rows + marked + copies + [(None, rows[20][1], "a"), (None, None, "a"), (205, copies[5][1], "a"), (7, "different text of a known id", "b")]


def plain_audit(rows, labels):
    quality, toxic = defaultdict(list), defaultdict(list)
    for d, q, t in labels:
        if d is not None:
            quality[d].append(q if q is not None else -1)
            toxic[d].append(t if t is not None else -1)
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    found = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ["A"] * (len(words) < 50) + ["B"] * (100 * len(set(words)) < 65 * len(words)) + ["C"] * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        fails += ["D"] * bool(re.search("[#$%&*|]", t)) + ["E"] * (d is not None and least[t] < d)
        found[part or ""].append((set(fails), max(quality.get(d, [0])) == 1, max(toxic.get(d, [0])) == 1))
    out = set()
    for part, docs in found.items():
        removed_of = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                failing = sum(f in x[0] for x in docs)
                left = [x for x in left if f not in x[0]]
                removed_of[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), failing - len(gone), sum(x[0] == {f} for x in docs), sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out |= {(*s[:-1], removed_of[s[-1]]) for s in steps}
    return out


@pytest.mark.parametrize("shard", [8 << 20, 1500])
def test_audit_of_all_orders(spark, monkeypatch, shard):
    monkeypatch.setattr(term_matrix, "SHARD_BYTES", shard)
    rows = audit_rows()
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 220, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (9, None, None), (4000, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "7 AS n_words", "'x' AS part", "1 AS failed", "2 AS id").repartition(3)
    got = filter_audit.audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS n"))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r) for r in got.select(*names).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audited(docs, labels).count() == 0
    one = filter_audit.audited(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string"), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and sum(r.removed for r in one) == 120


def test_matrix_holds_every_count(spark, monkeypatch):
    monkeypatch.setattr(term_matrix, "SHARD_BYTES", 900)
    rows = corpus(3, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    matrix, dictionary = term_matrix.term_matrix(docs, ["doc_id"], "doc_id:bigint, size:bigint", lambda b: (len(b),))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = [r.rank * buckets + r.bucket for r in dictionary.collect()]
    word_of = {r.rank * buckets + r.bucket: r.word for r in dictionary.collect()}
    assert len(words) == len(set(words)) == len({w for _, t in rows for w in (t or "").split()})
    shards = matrix.collect()
    assert len(shards) > 5
    got = {}
    for s in shards:
        start = 0
        for fact, end in zip(s.facts, s.row_ends, strict=True):
            got[fact.doc_id] = {word_of[c]: n for c, n in zip(s.columns[start:end], s.counts[start:end], strict=True)}
            start = end
    assert got == {i: dict(Counter((t or "").split())) for i, t in rows}


def test_row_totals_need_no_python_worker(spark):
    facts = "doc_id:bigint, marked:boolean"
    rows = [(0, [(7, True), (None, None), (7, True)], [2, 2, 3], [5, 9, 5], [1, 4, 2]), (1, [(8, False)], [0], [], []), (2, [], [], [], [])]
    totals = term_matrix.row_totals(spark.createDataFrame(rows, term_matrix.MATRIX.format(facts=facts)), facts)
    assert totals.dtypes == [("doc_id", "bigint"), ("marked", "boolean"), ("n_words", "bigint"), ("n_different", "bigint")]
    assert Counter(map(tuple, totals.collect())) == Counter([(7, True, 5, 2), (None, None, 0, 0), (7, True, 2, 1), (8, False, 0, 0)])
    assert "InArrow" not in totals._jdf.queryExecution().toString()


def test_shards_of_a_task_are_written_in_bounded_pieces(spark, monkeypatch):
    """24 rows of about 2 MB from one task: what Parquet holds at once does not grow with their number."""
    monkeypatch.setattr(term_matrix, "SHARD_BYTES", 1)
    paths, real = [], term_matrix.settled_at

    def settled_at(*a):
        frame, path = real(*a)
        paths.append(path)
        return frame, path

    monkeypatch.setattr(term_matrix, "settled_at", settled_at)
    docs = spark.range(24).coalesce(1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 150000), i -> hex(xxhash64(id, i) & 16777215)), ' ') AS text")
    term_matrix.term_matrix(docs, ["doc_id"], "doc_id:bigint, size:bigint", lambda b: (len(b),))
    metas = [pq.ParquetFile(f).metadata for f in Path(paths[0]).glob("*.parquet")]
    groups = [m.row_group(k) for m in metas for k in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 24 and sum(g.total_byte_size for g in groups) > 30 << 20
    assert max(g.total_byte_size for g in groups) < 20 << 20


def plain_codes(vectors, parts=8, entries=16, rounds=6, scale=4096):
    clean = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    clean.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = next(len(v) for _, v, _ in clean if len(v) % parts == 0)
    clean = [r for r in clean if len(r[1]) == size]
    d = size // parts
    cut = [[tuple(v[p * d : p * d + d]) for p in range(parts)] for _, v, _ in clean]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        members = defaultdict(list)
        for c in cut:
            for p in range(parts):
                members[p, nearest(c[p], books[p])[1]].append(c[p])
        for (p, e), xs in members.items():
            books[p][e] = tuple(sum(col) // len(xs) for col in zip(*xs, strict=True))
    out = []
    for (i, _, label), c in zip(clean, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(f for f, _ in best), label))
    total = Counter()
    for _, _, e, label in out:
        total[label] += e
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=str)


def code_rows(seed, n, width=16):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, -0.25, 0.1, rng.gauss(0, 0.3)]) for _ in range(width)], rng.choice([1, 2, None])) for i in range(5, n)]
    rows += [(1, None, 1), (2, [], 1), (3, [None] * width, 1), (4, [float("nan")] * width, 1), (n, [float("inf")] + [0.0] * (width - 1), 2), (n + 1, [0.5] * 8, 1), (n + 2, [0.5] * 5, 2)]
    return rows + [(None, rows[3][1], None), rows[7], rows[7], (9, rows[30 % len(rows)][1], 3)]


@pytest.mark.parametrize(("seed", "n"), [(1, 200), (2, 60), (3, 14)])
def test_codes_are_those_of_plain_rounds(spark, seed, n):
    rows = code_rows(seed, n)
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema)
    stored = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = vector_codes.encoded(df.selectExpr("*", "1 AS error", "'x' AS codes", "2 AS far", "3 AS vector", "4 AS of").repartition(3))
    assert sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()], key=str) == plain_codes(stored)


def test_codes_of_nothing_and_of_too_much(spark, monkeypatch):
    schema = "vec_id long, embedding array<double>, label string"
    assert vector_codes.encoded(spark.createDataFrame([(1, None, "a")], schema)).count() == 0
    assert vector_codes.encoded(spark.createDataFrame([(1, [1.0] * 5, "a")], schema)).count() == 0
    with pytest.raises(ValueError, match="may not fit"):
        vector_codes.encoded(spark.createDataFrame([(1, [1e9] * 8, "a")], schema))
    with pytest.raises(ValueError, match="one byte"):
        vector_codes.trained(spark.createDataFrame([], schema), entries=300)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    rows = code_rows(6, 40)
    got = vector_codes.encoded(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rounds=2)
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == plain_codes(rows, rounds=2)


def test_renewed_assignment_is_the_full_one():
    rng = np.random.default_rng(3)
    for _ in range(40):
        x, book = rng.integers(-4, 5, (200, 3)), rng.integers(-4, 5, (7, 3))
        codes, far = vector_codes.nearest(x, book)
        new = book.copy()
        new[rng.integers(0, 7, 2)] += rng.integers(-1, 2, (2, 3))
        again = vector_codes.renewed(x, new, (new != book).any(axis=1), codes, far)
        assert all((a == b).all() for a, b in zip(again, vector_codes.nearest(x, new), strict=True))


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def plain_spans(text: str | None) -> list[str]:
    out = []
    for kind, pattern in FORMATS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}
            if good[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PIECES = [
    *["a", "b.", "@", ".", "-", "_", "+", "1", "23", "4567", "255", "300", "0255", " ", " ", "(", ")", "é", "😀", "\n", "%", "a@b.c", "1.2.3.4"],
    *["+1 (509) 555-1234", "4111 1111 1111 1111", "4111111111111111", "0000000000000000000", "a at b dot c", "1[.]2[.]3[.]4", "030 123 4567"],
]


def test_base_spans_are_those_of_the_plain_formats(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 50)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (None, "a@b.cd"), (2002, rows[3][1]), (2002, rows[3][1]), (2003, "+1 (509) 555-1234 1.2.3.4 " * 600), (2004, "12 " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS base", "1 AS proposed", "'s' AS spans", "2 AS kind").repartition(4)
    got = personal_data.personal_data(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = plain_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in FORMATS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and len(spans) == len(set(spans))
        order = [(list(FORMATS).index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in spans)]
        assert order == sorted(order)
        # What is added overlaps nothing else.
        added = sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in set(spans) - set(want))
        assert all(b <= c for (_, b), (c, _) in zip(added, added[1:], strict=False))
        base = [tuple(map(int, w.split(":")[1:])) for w in want]
        assert r.doc_id == 2003 or not any(a < d and c < b for a, b in added for c, d in base)


def card(rng, good: bool) -> str:
    while True:
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        if luhn(digits) == good:
            return digits


def test_trees_add_what_looks_like_the_base_and_nothing_else(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        rows.append((i, f"pay by card {card(rng, True)} today"))
        rows.append((1000 + i, f"order number {card(rng, False)} is on its way"))
        rows.append((2000 + i, f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now, item {rng.randint(10**8, 10**9)} left"))
    dotted = "{0}.{1}.{2}.{3}"
    planted = {5000 + i: card(rng, True) for i in range(20)}
    rows += [(i, "pay by card " + dotted.format(c[:4], c[4:8], c[8:12], c[12:]) + " today") for i, c in planted.items()]
    rows += [(6000 + i, f"call 1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now") for i in range(20)]
    rows += [(7000 + i, f"clean words, {rng.randint(1, 10**6)} of them, page {card(rng, False)} and {rng.randint(10**7, 10**12)}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = personal_data.settle(personal_data.candidates(docs))
    model = personal_data.fitted(found)
    # No negatives or no positives at all: nothing is learned of these kinds.
    assert model.thresholds[0] == model.thresholds[1] == math.inf and max(model.thresholds[2:]) < math.inf
    got = {r.doc_id: r for r in personal_data.personal_data(docs).collect()}
    assert all(got[i].spans == "card:12:31" and got[i].n_card == 0 for i in planted)
    assert sum(got[i].spans.startswith("phone:5:") for i in range(6000, 6020)) == 20
    assert all(got[i].spans == "" for i in [*range(1000, 1400), *range(7000, 7050)])
    # The same table gives the same trees.
    assert personal_data.fitted(found).trees == model.trees


def test_overlapping_choices_keep_the_best(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        spans = [(a := rng.randint(0, 120), a + rng.randint(1, 25), rng.random() < 0.2, rng.randint(0, 3), float(rng.randint(0, 5))) for _ in range(rng.randint(0, 30))]
        rows.append((k, sorted(spans)))
    rows.append((99, sorted((3 * k, 3 * k + 2, False, 1, 1.0) for k in range(2000))))
    schema = "id long, spans array<struct<start:bigint,end:bigint,sure:boolean,kind:tinyint,score:double>>"
    better = lambda x, y: x["score"] > y["score"]
    got = spark.createDataFrame(rows, schema).select("id", personal_data._resolved(F.col("spans"), better).alias("kept")).collect()
    for r in got:
        spans = dict(rows)[r.id]
        sure = [s for s in spans if s[2]]
        kept = [tuple(s) for s in r.kept]
        assert all(not s[2] for s in kept)
        assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:], strict=False))
        assert not any(s[0] < t[1] and t[0] < s[1] for s in kept for t in sure)
        if r.id == 99:
            assert len(kept) == 2000
        for s in spans:
            if not s[2] and not any(s[0] < t[1] and t[0] < s[1] for t in spans if t is not s):
                assert s in kept


def test_personal_data_of_nothing(spark):
    assert personal_data.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = personal_data.personal_data(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert got[0].spans == "" and got[0].base_sha256 == hashlib.sha256(b"").hexdigest() and got[0].n_phone == 0
