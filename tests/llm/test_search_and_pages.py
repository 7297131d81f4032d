"""Top-k, HTML text, archives and URL filters against brute force and round trips."""

from __future__ import annotations

import base64
import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import html_text, topk, url_filters, warc
from tableferry.llm.html_text import Node
from tableferry.session import new_folder


def best(vectors, k, every):
    clean = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in clean:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in clean if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-0.2, 0.0, 0.11, rng.gauss(0, 0.2)]) for _ in range(6)]) for i in range(150)]
    vectors += [(150, None), (151, []), (152, [None] * 6), (153, [float("nan")] * 6), (154, [float("inf")] + [0.0] * 5), (160, [0.5] * 4), (180, [0.25] * 4)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<float>, score int, rank string")
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == best(stored, 20, 20)


def test_top_k_of_mixed_magnitudes(spark, monkeypatch):
    """Queries much larger than the members of other shards."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    rng = np.random.default_rng(8)
    whole = rng.integers(-60, 61, (240, 64))
    whole[:4] = rng.integers(-900_000, 900_001, (4, 64))
    rows = [(i, (v / 64).tolist()) for i, v in enumerate(whole)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 8, 20).collect()
    want = {}
    for q in range(8):
        score = whole @ whole[q]
        best = sorted((i for i in range(240) if i != q), key=lambda i: (-score[i], i))[:20]
        want[q] = [(i, int(score[i])) for i in best]
    assert {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in range(8)} == want


def test_top_k_stops_early_where_few_can_qualify():
    rng = np.random.default_rng(8)
    flat = np.floor(64 * rng.normal(size=(3000, 16))).astype(np.int64)
    # Members apart from all others: whoever asks for them is done after the first look.
    near = np.where(np.arange(16) % 2, 1, -1) * (5000 + rng.integers(0, 50, (25, 16)))
    vectors, ids = np.concatenate((flat, near)), np.arange(3025)
    lists = topk.SortedLists(ids, vectors)
    asked = np.concatenate((np.arange(40), np.arange(3000, 3025)))
    for q, (found, score) in zip(asked, lists.top(asked, vectors[asked], 20), strict=True):
        scores = vectors @ vectors[q]
        want = sorted((i for i in ids if i != q), key=lambda i: (-scores[i], i))[:20]
        assert found.tolist() == want and score.tolist() == [scores[i] for i in want]
    n = len(ids)
    assert (lists.read[40:] == int(n * topk.DEPTHS[0])).all() and (lists.read <= int(n * topk.DEPTHS[-1])).all()


def test_top_k_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") % 20 == 0).count() == 0


def page(body: str, shared: str = "Read our terms") -> str:
    return (
        f"<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>"
        f"<div class='cookie-notice'>We use</div><div id=content><p>{shared}</p><div>{body}</div><p>{shared} again</p></div>"
        f"<div class=\"comments\"><p>first!</p></div><form>Name <input></form><aside>more</aside><footer>&copy; us</footer><script>var a='<p>x</p>';</script></body></html>"
    )


def test_main_text(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", page(f"<p>Text &amp; <b>bold</b>\n number {i}<p>second<br>line {i}")) for i in range(12)]
    rows += [
        (100, "http://solo.org/", "<article><header><h1>Head</h1></header><p>A&nbsp;b &lt;c&gt; caf&eacute; &#8364;<ul><li>one<li>two</ul><section class=comments>no</section></article><p>out"),
        (101, None, None), (102, "http://h0.org/x", ""), (103, "not a url", "plain text"), (104, "http://h1.org/y", "<p>" + "word " * 60_000 + "</p>"),
        (105, "http://solo.org/2", "<div><p>un<closed <i>tag"), (100, "http://solo.org/", "<nav>menu only</nav>"),
    ]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    got = html_text.main_text(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    for i in range(12):
        # What all pages of the host share is template, though nothing names it so.
        assert by[i][0].text == f"Text & bold number {i}\nsecond line {i}"
    assert sorted(r.text for r in by[100]) == ["", "Head\nA b <c> café €\none\ntwo"]
    assert [by[i][0].text for i in (101, 102, 103)] == ["", "", "plain text"]
    assert len(by[104][0].text) == 60_000 * 5 - 1 and by[105][0].text.startswith("un")
    assert html_text.main_text(docs.limit(0)).count() == 0


def tree(text: str) -> Node:
    return html_text._load(json.loads(text))


def plain_match(x: Node, y: Node) -> int:
    """Largest matching by trying every order-keeping choice."""
    if x.label != y.label:
        return 0

    def over(a, b):
        if not a or not b:
            return 0
        return max(over(a[1:], b), over(a, b[1:]), plain_match(a[0], b[0]) + over(a[1:], b[1:]))

    return (2 if x.label == "#" and x.text == y.text else 1) + over(x.children, y.children)


def test_alignment_is_the_largest(subtests=None):
    rng = random.Random(2)

    def grown(depth):
        if depth == 0 or rng.random() < 0.3:
            return Node("#", rng.choice("ab"))
        return Node(rng.choice("xy"), "", [grown(depth - 1) for _ in range(rng.randint(0, 3))])

    for _ in range(60):
        a, b = Node("r", "", [grown(2), grown(2)]), Node("r", "", [grown(2), grown(2)])
        pairs = html_text.aligned(a, b)
        assert sum(2 if p.label == "#" and p.text == q.text else 1 for p, q in pairs) == plain_match(a, b)


def test_deep_and_wide_pages_and_names_in_articles(spark):
    words = [f"word{i} of the text" for i in range(6000)]
    deep = "".join(f"<div>{w}" for w in words[:5000]) + "".join(f"</div>tail{i}" for i in range(5000))
    named = [(c, i) for i, c in enumerate(["social-science", "share-price-analysis", "search-results", "related-work", "share-buttons", "related posts", "comment-body", "site-footer"])]
    article = "<article>" + "".join(f'<div class="{c}"><p>part {i}</p></div>' for c, i in named) + "</article>"
    deep_main = "<div>menu text" * 400 + "<article><p>kept</p></article>"
    rows = [(1, None, deep), (2, "http://d.org/1", article), (3, "http://e.org/", deep_main), (4, None, "<article>" * 3000 + "x")]
    wide = [(10 + k, "http://wide.org/", "<body>" + "<p>same start</p>" * 400 + f"<p>own {k}</p>" + "<p>same end</p>" * 400 + "</body>") for k in range(8)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows + wide, "page_id long, url string, html string")).collect()}
    assert got[1].split("\n") == [*words[:5000], *(f"tail{i}" for i in range(5000))]
    assert got[2] == "part 0\npart 1\npart 2\npart 3"
    assert (got[3], got[4]) == ("kept", "x")
    assert all(got[10 + k] == f"own {k}" for k in range(8))


def test_template_counts_all_pages(spark):
    def body(k, head, tail):
        return f"<html><body><div>{head}</div><div><p>story {k} one</p><p>story {k} two</p></div><div>{tail}</div></body></html>"

    # A notice that nearly all pages but some carry, and a paragraph that 60 % of them share.
    rows = [(k, "http://big.org/", body(k, "Big site", "All rights").replace("<div><p>", "<div><p>Stock line</p><p>" if k % 5 < 3 else "<div><p>", 1).replace("</body>", "<ul><li>Call us</ul></body>" if k % 10 else "</body>")) for k in range(200)]
    # Two layouts of one host, neither on four fifths of its pages.
    rows += [(1000 + k, "http://two.org/", body(k, "News of two", "Terms of news")) for k in range(30)]
    table = "<html><body><table><tr><td>Shop of two<tr><td><ul><li>item {0} red<li>item {0} blue</ul><tr><td>Terms of shop</table></body></html>"
    rows += [(2000 + k, "http://two.org/", table.format(k)) for k in range(30)]
    # Copies say nothing about what is constant.
    rows += [(3000 + k, "http://copies.org/", "<p>the one text</p><div>and more</div>") for k in range(50)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html_text.main_text(docs).collect()}
    for k in range(200):
        assert got[k] == ("Stock line\n" if k % 5 < 3 else "") + f"story {k} one\nstory {k} two"
    for k in range(30):
        assert got[1000 + k] == f"story {k} one\nstory {k} two"
        assert got[2000 + k] == f"item {k} red\nitem {k} blue"
    assert all(got[3000 + k] == "the one text\nand more" for k in range(50))


def ranked(spark, pages) -> list[str]:
    """Different pages in the order in which bases are taken from them."""
    return [r.html for r in spark.createDataFrame([(h,) for h in dict.fromkeys(pages)], "html string").orderBy(F.xxhash64("html")).collect()]


# Layouts of which no two have half of their nodes in common.
FORMS = [
    "<p>{0} one<p>{0} two<p>{0} three<p>{0} four", "<ul><li>{0} one<li>{0} two<li>{0} three<li>{0} four</ul>", "<table><tr><td>{0} one<td>{0} two<tr><td>{0} three<td>{0} four</table>",
    "<section><h2>{0} one</h2><h3>{0} two</h3><h4>{0} three</h4><h5>{0} four</h5></section>", "<dl><dt>{0} one<dd>{0} two<dt>{0} three<dd>{0} four</dl>", "<blockquote><pre>{0} one</pre><pre>{0} two</pre><pre>{0} three</pre><pre>{0} four</pre></blockquote>",
]


def formed(form: int, name: str) -> str:
    return f"<html><body><div>All of us</div>{FORMS[form].format(name)}{FORMS[form].format('Our rules')}</body></html>"


def test_layouts_beyond_the_first_pages(spark):
    parts = [f"{{}} {n}" for n in ("one", "two", "three", "four")]
    # Two layouts that are on few pages of the host, none of them among those that bases are taken from first; one page each of three others.
    named = [(0, f"story {k}") for k in range(600)]
    for form, name, n in ((1, "list", 12), (2, "row", 12), (3, "lone a", 1), (4, "lone b", 1), (5, "lone c", 1)):
        of = {formed(form, f"{name} {k}"): f"{name} {k}" for k in range(200)}
        named += [(form, of[h]) for h in ranked(spark, of)[-n:]]
    assert all("<p>story" in h for h in ranked(spark, [formed(*n) for n in named])[:10])
    rows = [(i, "http://many.org/", formed(*n)) for i, n in enumerate(named)]
    # A host whose first pages by hash differ in a comment only.
    odd = ranked(spark, [f"<!-- {k} --><p>Gone" for k in range(500)])[:10]
    rows += [(5000 + i, "http://odd.org/", h) for i, h in enumerate(odd)]
    late = ranked(spark, [formed(3, f"late {k}") for k in range(400)])[-20:]
    assert ranked(spark, odd + late)[:10] == odd
    rows += [(6000 + i, "http://odd.org/", h) for i, h in enumerate(late)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.main_text(docs).collect()}
    for i, (form, name) in enumerate(named):
        # Layouts of one page have in common only what stands at one path in all of them.
        own = [p.format(name) for p in parts]
        assert got[i].split("\n") == (own if form < 3 else own + [p.format("Our rules") for p in parts])
    for i, h in enumerate(late):
        name = h.split("<h2>")[1].split(" one")[0]
        assert got[6000 + i].split("\n") == [p.format(name) for p in parts]
    assert all(got[5000 + i] == "Gone" for i in range(10))


def walked(pages: list[str], order: list[str]) -> list[str]:
    """Texts of a host's pages by one walk over all of them, in memory."""
    layouts: list[html_text.Layout] = []
    of = {}
    for html in order:
        root = html_text.parse(html)
        if html_text.blocks(root)[0] and html_text.slots(root, layouts) is None:
            layouts.append(html_text.Layout(html_text.parse(html)))
    for html in set(pages):
        root = html_text.parse(html)
        found, main = html_text.blocks(root)
        number, at = html_text.slots(root, layouts) if found else (None, {})
        keys = [(number, at.get(id(n), path), n.text) for path, n in found]
        of[html] = (number, keys, [(-1, path, n.text) for path, n in found], main)
    sizes: dict = {}
    for number, _, paths, _ in of.values():
        sizes.setdefault(number, set()).add(tuple(paths))
    few = {number for number, different in sizes.items() if len(different) <= html_text.CONSTANT_LEAST}
    counts, total = {}, {}
    for number, paths, keys in {(n, tuple(p), tuple(p if n in few else k)) for n, k, p, _ in of.values() if p}:
        layout = -1 if number in few else number
        total[layout] = total.get(layout, 0) + 1
        for key in set(keys):
            counts[layout, key] = counts.get((layout, key), 0) + 1
    out = []
    for html in pages:
        number, keys, paths, main = of[html]
        layout, keys = (-1, paths) if number in few else (number, keys)
        left = [keys[i] for i in main if not ((n := counts.get((layout, keys[i]), 0)) > html_text.CONSTANT_LEAST and n >= html_text.CONSTANT_SHARE * total[layout])]
        out.append("\n".join(text for _, _, text in left))
    return out


@pytest.mark.parametrize("first, more, chars", [(10, 1000, 4 << 20), (3, 3, 4 << 20), (3, 50, 2000)])
def test_passes_give_what_one_walk_over_all_pages_gives(spark, monkeypatch, first, more, chars):
    monkeypatch.setattr(html_text, "FIRST_PAGES", first)
    monkeypatch.setattr(html_text, "MORE_PAGES", more)
    monkeypatch.setattr(html_text, "PASS_CHARS", chars)
    rng = random.Random(7)
    rows = []
    for host in range(4):
        for k in range((2, 40, 70, 120)[host]):
            form = min(int(rng.expovariate(0.9)), len(FORMS) - 1)
            html = rng.choice([formed(form, f"t{rng.randint(0, 60)}"), formed(form, f"u{k}").replace("All of us", rng.choice(["All of us", "Sale"])), f"<nav>{k}</nav>", f"bare {k}"] if rng.random() < 0.2 else [formed(form, f"v{k}")])
            rows.append((len(rows), f"http://walk{host}.org/", html))
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.main_text(docs).collect()}
    for host in range(4):
        here = [r for r in rows if r[1] == f"http://walk{host}.org/"]
        html = [h for _, _, h in here]
        assert [got[i] for i, _, _ in here] == walked(html, ranked(spark, html))


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    monkeypatch.setattr(warc, "FILE_BYTES", 400)
    rows = [(i, f"http://www.site{i % 3}.org/a?q={i}", f"<p>page {i % 7} é</p>") for i in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "http://x.org/\r\nWARC-Type: x", "\r\n\r\n" * 3), (53, "http://long.org/", "z" * 300_000), (5, "http://www.site2.org/a?q=5", "<p>page 5 é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = warc.archive_round_trip(spark, pages, with_payload=True).collect()
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", 0), i)
    assert len(got) == len(rows)
    html = {i: h or "" for i, _, h in rows}
    for r in got:
        raw = html[r.page_id].encode()
        to = last[html[r.page_id]]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if to == r.page_id else ("revisit", to))
        assert bytes(r.payload) == (raw if r.record_type == "response" else b"")
    assert warc.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_lookup_finds_only_what_is_there(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    pages = spark.createDataFrame([(i, f"http://b{i}.org/", f"text {i}") for i in range(20)], "page_id long, url string, html string")
    archives, index = new_folder(spark, "a"), new_folder(spark, "i")
    directory = warc.write_index(warc.write_archives(pages, archives), index)
    asked = spark.createDataFrame([(3, "http://b3.org/"), (4, "http://b3.org/"), (9, "http://a.org/"), (9, "http://zz.org/"), (19, "HTTP://B19.org:80/#x")], "page_id long, url string")
    got = warc.lookup(asked, directory, index, archives, True).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(3, b"text 3"), (19, b"text 19")]
    root = warc.Directory(directory)
    lines = [line for name in root.names for line in root.lines(name)[0]]
    assert len(lines) >= 7 and lines == sorted(lines) and root.keys == sorted(root.keys)


def test_repeated_captures_and_odd_urls_are_all_read(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "_SENT_ROWS", 2)
    monkeypatch.setattr(warc.Directory, "HELD", 1)
    rows = [(1, "http://a.org/x", "a"), (1, "http://a.org/x", "bbbb"), (2, "http://a.org/y", "c"), (2, "https://a.org/y#z", "dd"), (None, None, "e"), (None, "", "ff")]
    # Rows that repeat a capture run over many blocks; a url with an empty line is the target of revisits.
    rows += [(7, "http://many.org/", f"text {i % 5}") for i in range(40)]
    rows += [(8, "http://x.org/\r\n\r\nWARC-Type: y", "same"), (6, "http://x.org/", "same"), (5, "http://x.org/\n\n", "same"), (5, "http://x.org/%0A%0A", "same")]
    rows += [(i, f"http://b{i}.org/", f"{i}") for i in range(100, 130)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = warc.archive_round_trip(spark, pages, with_payload=True).collect()
    digests = sorted((i if i is not None else -1, len(h), warc.digest(h.encode())) for i, _, h in rows)
    assert sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest) for r in got) == digests
    assert sorted((r.page_id, r.refers_to) for r in got if r.record_type == "revisit") == [(5, 8), (5, 8), (6, 8)]


def test_url_keys():
    assert warc.url_key("http://User@www.Example.org:80/A/b?c#d") == "org,example,www)/A/b?c"
    assert warc.url_key("https://x.org") == "org,x)/"


def test_url_filters(spark):
    entries = [
        ("l", "block", "Bad.org", "add", 10), ("l", "block", "bad.org", "remove", 20), ("l", "block", "bad.org", "add", 20), ("l", "block", "bad.org", "remove", 30),
        ("m", "allow", "www.bad.org/ok", "add", 0), ("m", "block", "www.bad.org/ok", "add", 25), ("l", "block", None, "add", 1), ("n", "block", "once.org", "add", 5),
        ("n", "block", "once.org", "add", 5), ("n", "block", "once.org", "remove", 5), ("n", "block", "Dotted.org./a", "add", 5), ("n", "block", "", "add", 5),
    ]
    asked = [
        (1, "http://bad.org/x", 9, True), (2, "http://bad.org/x", 10, False), (3, "http://a.b.BAD.org:8080/", 19, False), (4, "http://bad.org", 20, True), (5, "http://notbad.org/", 15, True),
        (6, "http://www.bad.org/ok/page", 15, True), (7, "http://www.bad.org/okay", 15, False), (8, "http://www.bad.org/ok?q", 26, True), (9, None, 15, True), (10, "http://bad.org/", None, True),
        (11, "junk", 15, True), (12, "http://once.org/", 6, True), (13, "http://BAD.org./x", 15, False), (14, "http://www.bad.org.:80/ok/1", 15, True),
        (15, "http://dotted.org/a/b", 15, False), (16, "http://./", 15, True),
    ]
    captures = spark.createDataFrame([a[:3] for a in asked] + [asked[1][:3]], "page_id long, url string, fetched_at long").withColumn("pattern", F.lit("x"))
    history = spark.createDataFrame(entries, "list string, verdict string, pattern string, action string, at long")
    got = {r.page_id: r for r in url_filters.judged(captures, history).collect()}
    assert {i: r.kept for i, r in got.items()} == {a[0]: a[3] for a in asked}
    assert (got[6].pattern, got[6].n_active, got[8].n_active) == ("www.bad.org/ok", 2, 2)
    assert url_filters.judged(captures.limit(0), history).count() == 0
    assert all(r.kept for r in url_filters.judged(captures, history.limit(0)).collect())
