"""Main text of web pages by wrapper induction.

Pages become small trees of block elements; markup within a block is part of its text. Elements that
by name, class, id or role are menus, headers, footers, sidebars, notices, adverts, forms, scripts or
comments are left out at once. For each host pages are aligned by simple tree matching and give a base tree per
layout: taken in the order of a hash of their html, a page that fits no base before it is the base of one more layout.
This goes over all pages in passes. A pass takes the next ``FIRST_PAGES`` (later ``MORE_PAGES``) different pages of each host
among those that fit no base yet, makes bases of them and aligns all that is left with these; the last pass leaves none. So
the bases are those of one walk over all pages, whatever is dealt to a pass. What is constant is counted over all pages, too: a block
that equals the base's is counted at that slot, any other by its path and text. Blocks that stand in nearly all
pages (of different content) of a layout are template, slots that vary are content. Layouts of at most ``CONSTANT_LEAST`` pages
are counted together as one more, by path and text. Where a page has an article or main element, only what lies in it is taken.

Every page is extracted whole. Null html is an empty page; a page that nothing is left of has an
empty text, and pages without a host have no template. Elements nested more than ``DEPTH`` deep are blocks of the
element at that depth. Inside an article a class or id counts as furniture only if all its words fit. Templates are sent to all tasks only if they measure under ``BROADCAST_BYTES``; else they are
joined by host, where Spark may split the rows of a large one. A pass holds only its own bases, and a layout has no more constants than 1.25 times the
blocks of its average page. The passes of a host grow with its layouts, as does what a page that fits few of them is aligned with.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.shared import forget, settle
from tableferry.session import new_folder

# Different pages of a host that a pass takes bases from: the first pass, and each one over the pages that fit none yet. Beyond the first number
# they have no more than so many characters.
FIRST_PAGES, MORE_PAGES = 10, 1000
PASS_CHARS = 4 << 20
SLOTS = 16
# A block is constant if it is on this share of a layout's pages, and on more than so many.
CONSTANT_SHARE, CONSTANT_LEAST = 0.8, 2
# Share of the smaller tree that has to match for a page to have a base's layout.
SAME_LAYOUT = 0.5
BROADCAST_BYTES = 16 << 20
# Elements nested deeper than this are taken as blocks of the element at that depth.
DEPTH = 150

# --- fixed values: elements and words of the HTML standard and of common page layouts
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
DROPPED = {"aside", "button", "dialog", "fieldset", "footer", "form", "head", "menu", "nav", "select", "svg", "math", "object", "canvas", "audio", "video", "label"}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}
DROPPED_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "commentlist", "disqus", "consent", "cookie", "cookies", "gdpr", "notice", "notices", "notification", "alert", "disclaimer", "footer", "masthead", "menu", "menus", "modal", "nav",
    "navbar", "navigation", "newsletter", "pager", "pagination", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "share", "sharing",
    "sidebar", "sidebars", "skip", "social", "sponsor", "sponsored", "sponsors", "subscribe", "subscription", "topbar", "toolbar", "widget", "widgets", "login", "signup", "search", "copyright", "header",
}
# Words that go with those: a name of such words alone is furniture in an article, too ("share-buttons", not "share-price").
FITTING_WORDS = {
    "area", "article", "articles", "author", "avatar", "bar", "block", "body", "bottom", "box", "button", "buttons", "close", "col", "column", "container", "content", "count", "date", "entry", "form",
    "global", "group", "head", "heading", "holder", "icon", "icons", "inner", "input", "item", "items", "label", "layer", "left", "level", "link", "links", "list", "main", "media", "meta", "node", "outer",
    "page", "panel", "placeholder", "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "stories", "story", "text", "thread", "title", "to", "tools", "top", "unit", "user", "view", "wrap", "wrapper", "zone",
}
MAIN = {"article", "main"}
# --- end of fixed values
CLOSES_P = BLOCKS - {"option", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "summary", "body", "html", "head"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
_NAMED = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    label: str
    text: str = ""
    children: list[Node] = field(default_factory=list)
    dropped: bool = False


def _is_dropped(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is page furniture; a header in an article holds its title and stays."""
    if tag in DROPPED:
        return True
    if tag == "header":
        return not inside
    if not attributes or tag in ("html", "body") or (tag in MAIN and not inside):
        return False
    for m in _NAMED.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in DROPPED_ROLES:
            return True
        if name in ("class", "id") and _names_furniture(value, inside):
            return not (inside and tag in ("header", "h1", "h2") and "comment" not in value)
    return False


def _names_furniture(value: str, inside: bool) -> bool:
    """Whether a class or id names page furniture; in an article each of a name's words has to fit furniture."""
    for token in value.split() if inside else [value]:
        words = _WORD.findall(token)
        if not DROPPED_WORDS.isdisjoint(words) and (not inside or all(w in DROPPED_WORDS or w in FITTING_WORDS for w in words)):
            return True
    return False


def parse(page: str) -> Node:
    """Tree of block elements; inline runs become nodes "#" with their text. Furniture is cut off."""
    root = Node("root")
    # Open elements: tag, node, and whether an article or main element is open around what lies in it.
    stack: list[tuple[str, Node, bool]] = [("root", root, False)]
    opened: Counter[str] = Counter()
    inline: list[str] = []

    def flush() -> None:
        if inline:
            text = " ".join(entities.unescape("".join(inline)).split())
            inline.clear()
            node = stack[-1][1]
            if text and not node.dropped:
                node.children.append(Node("#", text))

    def close(upto: int) -> None:
        flush()
        opened.subtract(tag for tag, _, _ in stack[upto:])
        del stack[upto:]

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            inline.append(page[at:])
            break
        if m.start() > at:
            inline.append(page[at : m.start()])
        at = m.end()
        if m.group(1):
            tag, attributes = m.group(1).lower(), m.group(2)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag in CLOSES_P and opened["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in ("td", "th", "li", "div", "section", "article", "blockquote", "table", "body", "button"):
                        break
            if tag in SIBLINGS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in SIBLINGS[tag]:
                        close(i)
                        if tag != "tr":
                            break
                    elif stack[i][0] in ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select") or (tag != "tr" and stack[i][0] == "tr"):
                        break
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    inline.append(" ")
                continue
            _, parent, inside = stack[-1]
            furniture = _is_dropped(tag, attributes, inside)
            if tag not in BLOCKS and not furniture:
                continue
            flush()
            if len(stack) > DEPTH and not (furniture or parent.dropped or (tag in MAIN and not inside)):
                # Blocks below that depth are blocks of the node there.
                node = parent
            else:
                node = Node(tag, dropped=parent.dropped or furniture)
                if not node.dropped:
                    parent.children.append(node)
            if not attributes.endswith("/") or tag in BLOCKS:
                stack.append((tag, node, inside or tag in MAIN))
                opened[tag] += 1
        elif m.group(3):
            tag = m.group(3).lower()
            for i in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
        elif not m.group(0).startswith(("<!", "<?", "</")):
            inline.append(m.group(0))
    flush()
    return root


def main_roots(root: Node) -> list[Node]:
    """The article or main elements that lie in no other; the whole page where there is none."""
    found: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.label in MAIN:
            found.append(node)
        else:
            stack.extend(reversed(node.children))
    return found or [root]


def aligned(x: Node, y: Node) -> list[tuple[Node, Node]]:
    """Matched nodes of two trees whose roots have one label, by simple tree matching."""
    pairs: list[tuple[Node, Node]] = []
    _match(x, y, pairs)
    return pairs


def _match(x: Node, y: Node, pairs: list | None) -> int:
    """Size of the largest matching that keeps order and parents; equal texts count twice."""
    if x.label != y.label:
        return 0
    if pairs is not None:
        pairs.append((x, y))
    score = 2 if x.label == "#" and x.text == y.text else 1
    a, b = x.children, y.children
    # Equal subtrees at either end: a largest matching pairs them.
    end = min(len(a), len(b))
    head = next((i for i in range(end) if not _equal(a[i], b[i])), end)
    tail = next((i for i in range(end - head) if not _equal(a[-1 - i], b[-1 - i])), end - head)
    if head + tail:
        front = sum(_match(p, q, pairs) for p, q in zip(a[:head], b[:head], strict=True))
        back: list | None = None if pairs is None else []
        score += front + sum(_match(p, q, back) for p, q in zip(a[len(a) - tail :], b[len(b) - tail :], strict=True))
        a, b = a[head : len(a) - tail], b[head : len(b) - tail]
        if a and b:
            score += _matched_children(a, b, pairs)
        if pairs is not None:
            pairs += back
        return score
    return score + _matched_children(a, b, pairs) if a and b else score


def _equal(x: Node, y: Node) -> bool:
    return x.label == y.label and x.text == y.text and len(x.children) == len(y.children) and all(map(_equal, x.children, y.children))


def _matched_children(a: list[Node], b: list[Node], pairs: list | None) -> int:
    """Size of the largest order-keeping matching between two lists of trees."""
    if len(a) == 1 and len(b) == 1:
        return _match(a[0], b[0], pairs)
    weight = [[_match(p, q, None) if p.label == q.label else 0 for q in b] for p in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        above, row, w = best[i], best[i + 1], weight[i]
        for j in range(len(b)):
            v = above[j] + w[j]
            row[j + 1] = max(v, above[j + 1], row[j])
    if pairs is not None:
        i, j = len(a), len(b)
        chosen = []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                chosen.append((a[i], b[j]))
        for p, q in reversed(chosen):
            _match(p, q, pairs)
    return best[-1][-1]


def _dump(node: Node) -> list:
    return [node.label, node.text, [_dump(c) for c in node.children]]


def _load(data: list) -> Node:
    return Node(data[0], data[1], [_load(c) for c in data[2]])


def _nodes(root: Node):
    """All nodes in page order, each with the labels above it."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        yield path, node
        below = f"{path}/{node.label}"
        stack.extend((below, child) for child in reversed(node.children))


def _places(root: Node) -> Counter[str]:
    """Number of nodes by their labels and those above them."""
    return Counter(f"{path}/{node.label}" for path, node in _nodes(root))


class Layout:
    """Base tree of a layout, its places and the number of each of its slots."""

    def __init__(self, base: Node):
        self.base = base
        self.places = _places(base)
        self.size = self.places.total()
        self.slots = {id(node): i for i, (_, node) in enumerate(_nodes(base)) if node.label == "#"}

    def fitted(self, root: Node, places: Counter[str]) -> list[tuple[Node, Node]] | None:
        """The alignment of a page that has this layout, else None."""
        least = SAME_LAYOUT * min(self.size, places.total())
        # Matched nodes have one place, so no more than these can match.
        if sum(min(n, self.places[p]) for p, n in places.items() if p in self.places) < least:
            return None
        pairs = aligned(self.base, root)
        return pairs if len(pairs) >= least else None


def induced(pages: Iterable[Node]) -> str:
    """Base trees of the layouts of some pages as JSON: a base is a page that fits no base before it."""
    layouts: list[Layout] = []
    for tree in pages:
        places = _places(tree)
        # A page without blocks has no layout; all would fit it.
        if any(p.endswith("/#") for p in places) and all(layout.fitted(tree, places) is None for layout in layouts):
            layouts.append(Layout(tree))
    return json.dumps([_dump(layout.base) for layout in layouts])


def _layouts(template: str) -> list[Layout]:
    return [Layout(_load(base)) for base in json.loads(template)]


def slots(root: Node, layouts: list[Layout]) -> tuple[int, dict[int, int]] | None:
    """Number of the first of these layouts that a page fits and, by node, the slots of blocks that equal the base's; None if it fits none."""
    places = _places(root)
    for number, layout in enumerate(layouts):
        if (pairs := layout.fitted(root, places)) is not None:
            return number, {id(y): layout.slots[id(x)] for x, y in pairs if x.label == "#" and x.text and x.text == y.text}
    return None


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def blocks(root: Node) -> tuple[list[tuple[str, Node]], list[int]]:
    """All blocks of a page with the labels above them, and which of them are in its article."""
    found = [(path, node) for path, node in _nodes(root) if node.label == "#"]
    main = {id(node) for part in main_roots(root) for _, node in _nodes(part)}
    return found, [i for i, (_, node) in enumerate(found) if id(node) in main]


def host_of(url: str = "url"):
    after = F.substring_index(F.lower(F.coalesce(url, F.lit(""))), "://", -1)
    return F.regexp_extract(after, r"^(?:[^/?#@]*@)?([^/?#]*)", 1)


def bases(pages: DataFrame, most: int) -> DataFrame:
    """(host, template) of the hosts with enough pages: the base trees of the ``most`` different pages of the smallest hashes.

    Only hashes are sorted; the pages that these choose are fetched after that.
    """
    # Pages without a host have nothing in common. Copies of one page have one rank.
    ranked = pages.select("host", "html", F.xxhash64("html").alias("rank")).where("host <> '' AND html <> ''")
    order = Window.partitionBy("host").orderBy("rank")
    sizes = ranked.groupBy("host", "rank").agg(F.max(F.length("html")).alias("size"))
    # The first of a host are among the first of its slots, which several tasks sort.
    slot = Window.partitionBy("host", F.pmod("rank", F.lit(SLOTS))).orderBy("rank")
    sizes = sizes.withColumn("n", F.row_number().over(slot)).where(F.col("n") <= most).drop("n")
    before = sizes.withColumns({"n": F.row_number().over(order), "chars": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    first = before.where((F.col("n") <= most) & ((F.col("n") <= FIRST_PAGES) | (F.col("chars") <= PASS_CHARS)))
    chosen = _with(ranked, settle(first.select("host", "rank"), "first"), ["host", "rank"], F.lit(8), "left_semi")

    def induce(table):
        different = sorted(zip(table.column("rank").to_pylist(), table.column("html").to_pylist(), strict=True))
        # So few pages are all that there are, and nothing in them is constant.
        made = induced(parse(html) for _, html in different) if len(different) > CONSTANT_LEAST else None
        return pa.table({"host": pa.array([table.column("host")[0].as_py()] if made else [], pa.string()), "template": pa.array([made] if made else [], pa.string())})

    return settle(chosen.groupBy("host", "rank").agg(F.min("html").alias("html")).groupBy("host").applyInArrow(induce, "host string, template string"), "bases")


def _with(rows: DataFrame, known: DataFrame, on: list[str], weight, how: str = "left") -> DataFrame:
    """Rows and what is known of their host, layout or hash; few bytes are broadcast, many are joined."""
    total = known.agg(F.coalesce(F.sum(weight + F.length("host")), F.lit(0))).first()[0]
    return rows.join(F.broadcast(known) if total < BROADCAST_BYTES else known, on, how)


class _Cache:
    """Layouts by template, for the rows of a task; they hold no more templates than a broadcast."""

    def __init__(self):
        self.known: dict[str, list[Layout]] = {}
        self.held = 0

    def __getitem__(self, template: str) -> list[Layout]:
        if template not in self.known:
            if self.held > BROADCAST_BYTES:
                self.known.clear()
                self.held = 0
            self.known[template] = _layouts(template)
            self.held += len(template)
        return self.known[template]


_BLOCKS = {
    "page_id": pa.int64(), "url": pa.string(), "host": pa.string(), "html": pa.string(), "layout": pa.int32(), "page": pa.int64(),
    "keys": pa.list_(pa.int64()), "paths": pa.list_(pa.int64()), "main": pa.list_(pa.int32()), "texts": pa.list_(pa.string()),
}
_BLOCKS_SCHEMA = "page_id long, url string, host string, html string, layout int, page long, keys array<long>, paths array<long>, main array<int>, texts array<string>"


def in_layouts(pages: DataFrame) -> DataFrame:
    """Every page with its layout and blocks, parsed and aligned once for each pass that it takes.

    layout is null without a host or blocks, -1 for the last pages of a host that are too few for one. Of all blocks: the keys they are counted
    by in the layout (keys) and in no layout (paths); of those in the article: their places among all (main) and texts. page is equal for copies.
    What a pass leaves is written apart, and removed once the next pass is through.
    """
    rest = pages.select("page_id", "url", host_of().alias("host"), "html")
    done: list[DataFrame] = []
    last = None
    while True:
        before = len(done) << 16

        def assign(batches, before=before):
            known = _Cache()
            for batch in batches:
                rows = []
                for page_id, url, host, html, template in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "html", "template")), strict=True):
                    root = parse(html or "")
                    found, main = blocks(root)
                    texts = [found[i][1].text for i in main]
                    if not host or not found:
                        rows.append((page_id, url, host, None, None, None, [], [], [], texts))
                        continue
                    fit = (-1, {}) if template is None else slots(root, known[template])
                    if fit is None:
                        rows.append((page_id, url, host, html, None, None, None, None, None, None))
                        continue
                    layout = before + fit[0] if template is not None else -1
                    paths = [_number(f"-1 {path}\0{node.text}") for path, node in found]
                    keys = paths if layout < 0 else [_number(f"{layout} {fit[1].get(id(node), path)}\0{node.text}") for path, node in found]
                    rows.append((page_id, url, host, None, layout, _number(" ".join(map(str, paths))), keys, paths, main, texts))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_BLOCKS.values())], names=list(_BLOCKS))

        joined = _with(rest, bases(rest, MORE_PAGES if done else FIRST_PAGES), ["host"], F.length("template"))
        found = joined.select("page_id", "url", "host", "html", "template").mapInArrow(assign, _BLOCKS_SCHEMA).withColumn("open", F.col("html").isNotNull())
        path = new_folder(pages.sparkSession, "blocks")
        found.write.option("compression", "zstd").partitionBy("open").parquet(path)
        if last:
            forget(pages.sparkSession, f"{last}/open=true")
        last = path
        found = pages.sparkSession.read.schema(found.schema).parquet(path)
        done.append(found.where("NOT open").drop("html", "open"))
        rest = found.where("open").select("page_id", "url", "host", "html")
        if rest.isEmpty():
            return reduce(DataFrame.unionAll, done)


def counted_in(rows: DataFrame) -> DataFrame:
    """Pages with the layout they are counted in and their keys there: layouts of few pages are counted as one."""
    sizes = rows.where("layout IS NOT NULL").groupBy("host", "layout").agg(F.count_distinct("page").alias("pages"))
    joined = _with(rows, settle(sizes, "layouts"), ["host", "layout"], F.lit(16))
    few = F.col("pages") <= CONSTANT_LEAST
    return joined.withColumns({"layout": F.when(few, -1).otherwise(F.col("layout")), "keys": F.when(few, F.col("paths")).otherwise(F.col("keys"))}).drop("pages", "paths")


def templates(rows: DataFrame) -> DataFrame:
    """(host, layout, constant): the keys of the blocks that are constant, of layouts that have some.

    Blocks are counted over all pages; copies of a page count once.
    """
    seen = rows.where("layout IS NOT NULL").groupBy("host", "layout", "page").agg(F.first("keys").alias("keys"))
    seen = settle(seen.withColumn("keys", F.array_distinct("keys")), "keys")
    # A block on most pages is counted within each task before it is sent.
    counted = seen.select("host", "layout", F.explode("keys").alias("key")).groupBy("host", "layout", "key").agg(F.count("*").alias("n"))
    totals = seen.groupBy("host", "layout").agg(F.count("*").alias("pages"))
    constant = counted.where(F.col("n") > CONSTANT_LEAST).join(totals, ["host", "layout"]).where(F.col("n") >= CONSTANT_SHARE * F.col("pages"))
    return settle(constant.groupBy("host", "layout").agg(F.collect_list("key").alias("constant")), "templates")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = counted_in(in_layouts(pages))
    joined = _with(rows, templates(rows), ["host", "layout"], 8 * F.size("constant"))

    def extract(batches):
        for batch in batches:
            out = []
            for keys, main, texts, constant in zip(*(batch.column(c).to_pylist() for c in ("keys", "main", "texts", "constant")), strict=True):
                left = frozenset(constant or ())
                out.append("\n".join(text for i, text in zip(main, texts, strict=True) if keys[i] not in left) if left else "\n".join(texts))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    done = joined.select("page_id", "url", "keys", "main", "texts", "constant").mapInArrow(extract, "page_id long, url string, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
