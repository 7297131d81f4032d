"""Personal data in texts: strict formats, and further spans chosen by boosted trees. Built-in functions only.

Base spans are the leftmost non-overlapping matches of a kind's format that pass its check. Generators propose further spans, which may
overlap each other and the base: addresses spelled with "at" and "dot", addresses with bracketed dots, cards with other
separators or lengths, phones without a plus, plain numbers. Format and context of every proposal become small whole numbers. Marks
that define a base format (the plus, the at sign) are none of them, so that what is learned carries over.

Labels come from the corpus itself: base spans are positive; proposals that fail a check of their kind are negative (a wrong check digit, a
number over 255, an address without a dot, a phone of one block of digits); the rest is scored only. Labelled spans are counted by
their features, over all documents, and each round of boosting sums gradients by kind, feature and value over these counts; the
driver sees only such sums (at most ``len(KINDS) * 2 * len(FEATURES) * TOP`` rows). A kind's threshold is the least score from which on
labelled spans of held-out documents are right in ``PRECISION`` of cases; a kind with fewer than ``LEAST_HELD`` held-out
positives or negatives adds nothing. Chosen spans that overlap a base span, or a better chosen one, are left out.

The texts are read once; a text's spans stay in its row and are worked on in arrays in time that grows with their number, so a very long text
costs what its length costs. Null texts are empty and have no spans. Repeated rows are rows of their own; a null id is learned from and
scored like any other. Empty tables give no rows. Positions are code points, ends exclusive. Columns not named are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.shared import settle

KINDS = ("email", "ip", "card", "phone")

# Base formats. They match what the plain patterns of the contract match, written so that a start is tried once a run of characters
# and no repetition is taken back; the card's allows for its 16 to 19 digits at once.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Further proposals; several generators may serve one kind.
_AT, _DOT = (rf"(?: ?[\[({{] ?(?i:{w}) ?[\])}}] ?| (?i:{w}) )" for w in ("at", "dot"))
GENERATORS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++(?:@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+|{_AT}[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++)",
    "ip": r"[0-9](?<![0-9.][0-9])[0-9]*+(?:(?:\.|\[\.\]|\(\.\)| ?[\[(](?i:dot)[\])] ?)[0-9]++){3,}+",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20./-][0-9])(?:[\x20./-]?[0-9]){11,18}+(?![\x20./-]?[0-9])",
    "phone": r"[0-9(](?<![0-9A-Za-z+.][0-9(])[0-9]{0,5}+\)?(?:[\x20./-]{1,2}\(?[0-9]{2,6}+\)?){1,5}+(?![0-9])",
    "phone digits": r"[0-9](?<![0-9A-Za-z+.][0-9])[0-9]{6,14}+(?![0-9A-Za-z])",
}

# Words that may announce a kind in the text just before it.
CUES = {"email": "mail|contact|write to", "ip": "ip|host|server|addr", "card": "card|visa|credit|pay", "phone": "tel|phone|call|fax|mobile"}
CONTEXT = 24

FEATURES = ("digits", "groups", "length", "last", "spaces", "dashes", "dots", "round", "luhn", "octets", "before", "after", "cue")
# Largest value of a feature.
TOP = 24

ROUNDS, RATE, SMOOTHING = 10, 0.6, 1.0
PRECISION, LEAST_HELD = 0.99, 20
# Elements of an array that are put together at once; whole arrays are made of such blocks.
BLOCK = 256


def _running(sizes: Column) -> Column:
    """Sums of the elements before each, block by block, as an array that grows by one element is copied each time."""
    none = F.array().cast("array<long>")
    start = F.struct(F.lit(0).cast("long").alias("sum"), none.alias("at"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["at"], F.array(acc["sum"])).alias("at"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, BLOCK))
    local = F.transform(blocks, lambda b: F.aggregate(b, start, add))
    offsets = F.aggregate(F.transform(local, lambda b: b["sum"]), start, add, lambda acc: acc["at"])
    whole = F.flatten(F.zip_with(local, offsets, lambda b, o: F.transform(b["at"], lambda x: x + o)))
    return F.when(F.size(sizes) > 0, whole).otherwise(none)


def _matches(texts: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """A column per pattern: its matches as (start, end, match, before, after). A pattern goes with a condition that texts without a match may fail."""
    names = list(patterns)
    found = texts.select(
        "*", *(F.when(holds, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"m {n}") for n, (p, holds) in patterns.items())
    )
    cut = found.select("*", *(F.when(F.size(f"m {n}") > 0, F.split("text", p, -1)).alias(f"g {n}") for n, (p, _) in patterns.items()))

    def sizes(n: str) -> Column:
        gaps = F.transform(F.slice(f"g {n}", 1, F.size(f"m {n}")), lambda g: F.length(g).cast("long"))
        return F.coalesce(F.zip_with(gaps, f"m {n}", lambda g, m: g + F.length(m)), F.array().cast("array<long>"))

    sized = cut.select("*", *(sizes(n).alias(f"s {n}") for n in names))
    summed = sized.select("*", *(_running(F.col(f"s {n}")).alias(f"p {n}") for n in names))

    def places(n: str) -> Column:
        # Zipped rather than looked up by index: an optimiser may move a column's expression to where it is used, into the loop.
        k = F.size(f"m {n}")
        gaps = F.coalesce(F.col(f"g {n}"), F.array().cast("array<string>"))
        whole = F.arrays_zip(F.col(f"m {n}").alias("match"), F.col(f"p {n}").alias("at"), F.slice(gaps, 1, k).alias("gap"), F.slice(gaps, 2, k).alias("next"))

        def place(z: Column) -> Column:
            start = z["at"] + F.length(z["gap"])
            before, after = F.lower(F.right(z["gap"], F.lit(CONTEXT))), F.left(z["next"], F.lit(1))
            return F.struct(start.alias("start"), (start + F.length(z["match"])).alias("end"), z["match"].alias("match"), before.alias("before"), after.alias("after"))

        return F.transform(whole, place).alias(n)

    return summed.select(*(F.col(c) for c in texts.columns if c != "text"), *(places(n) for n in names))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _numbers(match: Column) -> Column:
    return F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))


def _luhn(digits: Column) -> Column:
    def add(acc: Column, k: Column) -> Column:
        v = F.substring(digits, -k, F.lit(1)).cast("int")
        return acc + F.when(k % 2 == 0, 2 * v - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _octets(match: Column) -> Column:
    return F.forall(_numbers(match), lambda x: F.rlike(x, F.lit("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))


def _passes(kind: str, match: Column) -> Column:
    """Whether a match of the base format is personal data."""
    if kind == "ip":
        return _octets(match)
    if kind == "card":
        return _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _fails(kind: str, match: Column) -> Column:
    """Whether a proposal cannot be of its kind; null where nothing tells."""
    digits, groups = F.length(_digits(match)), F.size(_numbers(match))
    wrong = {
        "email": ~match.contains(".") & match.contains("@"),
        "ip": ~_octets(match) | (groups != 4),
        "card": ~_luhn(_digits(match)) | ((groups == 1) & (digits < 16)),
        "phone": (groups == 1) | ~digits.between(8, 15),
    }[kind]
    return F.when(wrong, F.lit(True))


def _features(kind: str, place: Column) -> list[Column]:
    match = place["match"]
    digits = _digits(match)

    def sign(c: Column) -> Column:
        return (
            F.when(F.length(c) == 0, 0).when(F.rlike(c, F.lit(r"[\x09-\x0D\x20]")), 1).when(F.rlike(c, F.lit("[A-Za-z]")), 2)
            .when(F.rlike(c, F.lit("[0-9]")), 3).when(F.rlike(c, F.lit(r"[\"'=:]")), 4).otherwise(5)
        )

    values = {
        "digits": F.length(digits),
        "groups": F.size(_numbers(match)),
        "length": F.length(match) / 4,
        "last": F.length(F.regexp_extract(F.right(match, F.lit(TOP + 1)), "([A-Za-z0-9]*)[^A-Za-z0-9]*$", 1)),
        "spaces": match.contains(" "),
        "dashes": match.contains("-"),
        "dots": match.contains("."),
        "round": F.rlike(match, F.lit("[()]")),
        "luhn": (F.length(digits) > 0) & _luhn(digits),
        "octets": _octets(match),
        "before": sign(F.right(place["before"], F.lit(1))),
        "after": sign(place["after"]),
        "cue": F.rlike(place["before"], F.lit(rf"\b(?:{CUES[kind]})")),
    }
    return [F.least(values[f].cast("int"), F.lit(TOP)).cast("tinyint").alias(f) for f in FEATURES]


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, proposed): spans of the base formats and all proposals of each text, with kind, start, end, label and features.

    A label is 1 or 0, and null where none is known.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    at, spelled = F.col("text").contains("@"), F.lower("text").contains("dot")
    digits = F.rlike("text", F.lit("[0-9]"))
    patterns = {f"base {k}": (p, {"email": at, "phone": F.col("text").contains("+")}.get(k, digits)) for k, p in BASE.items()}
    patterns |= {f"more {g}": (p, at | spelled if g == "email" else digits) for g, p in GENERATORS.items()}
    found = _matches(texts, patterns)

    def spans(kind: str, name: str, label) -> Column:
        def span(p: Column) -> Column:
            return F.struct(F.lit(KINDS.index(kind)).cast("tinyint").alias("kind"), p["start"].alias("start"), p["end"].alias("end"), label(p["match"]).cast("tinyint").alias("label"), *_features(kind, p))

        return F.transform(name, span)

    def wrong(kind: str):
        return lambda match: F.when(_fails(kind, match), 0)

    def right(kind: str):
        return lambda place: _passes(kind, place["match"])

    base = [spans(k, f"kept {k}", lambda m: F.lit(1)) for k in KINDS]
    more = [spans(g.split()[0], f"more {g}", wrong(g.split()[0])) for g in GENERATORS]
    kept = found.select("doc_id", *(F.filter(f"base {k}", right(k)).alias(f"kept {k}") for k in KINDS), *(F.col(f"more {g}") for g in GENERATORS))
    return kept.select("doc_id", F.concat(*base).alias("base"), F.concat(*more).alias("proposed"))


def _resolved(spans: Column, better) -> Column:
    """Of spans sorted by start, those that are not ``sure``, overlap no sure one, and no better one next to them.

    The last one is open until the next starts behind it; the settled ones are kept in blocks.
    """
    kind = "struct<start:bigint,end:bigint,sure:boolean,kind:tinyint,score:double>"
    none = F.array().cast(f"array<{kind}>")
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.lit(0).cast("long").alias("reach"), none.alias("block"), F.array().cast(f"array<array<{kind}>>").alias("done"))

    def put(acc: Column, open_: Column, reach: Column, closed: Column) -> Column:
        """The state with another open span; the one open before is settled if it is ``closed``."""
        block = F.when(closed & acc["open"].isNotNull(), F.concat(acc["block"], F.array(acc["open"]))).otherwise(acc["block"])
        full = F.size(block) >= BLOCK
        return F.struct(
            open_.alias("open"), reach.alias("reach"), F.when(full, none).otherwise(block).alias("block"), F.when(full, F.concat(acc["done"], F.array(block))).otherwise(acc["done"]).alias("done")
        )

    def step(acc: Column, x: Column) -> Column:
        meets = acc["open"].isNotNull() & (x["start"] < acc["open"]["end"])
        nothing = F.lit(None).cast(kind)
        return (
            F.when(x["sure"], put(acc, nothing, F.greatest(acc["reach"], x["end"]), ~meets))
            .when(x["start"] < acc["reach"], acc)
            .when(meets, put(acc, F.when(better(x, acc["open"]), x).otherwise(acc["open"]), acc["reach"], F.lit(False)))
            .otherwise(put(acc, x, acc["reach"], F.lit(True)))
        )

    last = lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["block"], F.when(acc["open"].isNotNull(), F.array(acc["open"])).otherwise(none))))
    return F.aggregate(spans, start, step, last)


class Trees:
    """Boosted trees of two levels per kind, and the thresholds from which on proposals are taken."""

    def __init__(self):
        self.prior = [0.0] * len(KINDS)
        # Per kind and round: (feature, at most, left leaf or split, right leaf or split), a split being (feature, at most, left, right).
        self.trees: list[list[tuple]] = [[] for _ in KINDS]
        self.thresholds = [math.inf] * len(KINDS)

    def score(self, kind: Column, feature) -> Column:
        """Log odds; ``feature`` gives the column of a feature's name."""

        def leaf(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            f, most, left, right = node
            return F.when(feature(FEATURES[f]) <= most, leaf(left)).otherwise(leaf(right))

        of_kind = [sum((leaf(t) for t in self.trees[k]), F.lit(float(self.prior[k]))) for k in range(len(KINDS))]
        out = F.when(kind == 0, of_kind[0])
        for k in range(1, len(KINDS)):
            out = out.when(kind == k, of_kind[k])
        return out


def _best_split(cells: dict[tuple[int, int], tuple[float, float]]) -> tuple[float, int, int] | None:
    """Gain, feature and value of the best cut of one node, from sums of gradients and curvatures by (feature, value)."""

    def worth(g: float, h: float) -> float:
        return g * g / (h + SMOOTHING)

    best = None
    for f in sorted({f for f, _ in cells}):
        values = sorted(v for g, v in cells if g == f)
        all_g, all_h = (sum(cells[f, v][i] for v in values) for i in (0, 1))
        g = h = 0.0
        for v in values[:-1]:
            g, h = g + cells[f, v][0], h + cells[f, v][1]
            gain = worth(g, h) + worth(all_g - g, all_h - h) - worth(all_g, all_h)
            if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = (gain, f, v)
    return best


def _leaf(cells: dict[tuple[int, int], tuple[float, float]]) -> float:
    f = min(f for f, _ in cells)
    g, h = (sum(c[i] for (e, _), c in cells.items() if e == f) for i in (0, 1))
    return round(RATE * g / (h + SMOOTHING), 6)


def fitted(found: DataFrame) -> Trees:
    """Trees and thresholds from the labelled spans of ``candidates``; documents with crc32(id) mod 3 = 1 are held out for the thresholds."""
    model = Trees()
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1).alias("held")
    spans = found.select(held, F.explode(F.filter(F.concat("base", "proposed"), lambda s: s["label"].isNotNull())).alias("s")).select("held", "s.kind", "s.label", *(f"s.{f}" for f in FEATURES))
    counted = settle(spans.groupBy("held", "kind", "label", *FEATURES).agg(F.count("*").alias("n")), "patterns")
    train = counted.where("NOT held")
    sizes = {(r.kind, r.label): r.n for r in train.groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()}
    alive = [k for k in range(len(KINDS)) if sizes.get((k, 0)) and sizes.get((k, 1))]
    for k in alive:
        model.prior[k] = round(math.log(sizes[k, 1] / sizes[k, 0]), 6)

    def sums(splits: dict[int, tuple[int, int]] | None) -> dict[tuple[int, int], dict[tuple[int, int], tuple[float, float]]]:
        """Gradients and curvatures by (kind, side of the split) and then (feature, value)."""
        side = F.lit(0)
        if splits:
            side = F.when(F.lit(False), 0)
            for k, (f, most) in splits.items():
                side = side.when(F.col("kind") == k, (F.col(FEATURES[f]) > most).cast("int"))
        chance = 1 / (1 + F.exp(-model.score(F.col("kind"), F.col)))
        rows = train.where(F.col("kind").isin(alive)).select("kind", F.coalesce(side, F.lit(0)).alias("side"), "n", "label", chance.alias("p"), F.array(*FEATURES).alias("x"))
        cells = rows.select("kind", "side", (F.col("n") * (F.col("label") - F.col("p"))).alias("g"), (F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h"), F.posexplode("x").alias("f", "v"))
        out: dict = {}
        for r in cells.groupBy("kind", "side", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            out.setdefault((r.kind, r.side), {})[r.f, r.v] = (r.g, r.h)
        return out

    for _ in range(ROUNDS if alive else 0):
        top = {k: best[1:] for (k, _), cells in sums(None).items() if (best := _best_split(cells))}
        if not top:
            break
        nodes = sums(top)
        for k, (f, most) in top.items():
            sides = []
            for s in (0, 1):
                cells = nodes[k, s]
                cut = _best_split(cells)
                if cut:
                    _, f2, v2 = cut
                    left = {c: x for c, x in cells.items() if c[0] == f2 and c[1] <= v2}
                    right = {c: x for c, x in cells.items() if c[0] == f2 and c[1] > v2}
                    sides.append((f2, v2, _leaf(left), _leaf(right)))
                else:
                    sides.append(_leaf(cells))
            model.trees[k].append((f, most, *sides))
    _calibrate(model, counted.where("held"), alive)
    return model


def _calibrate(model: Trees, held: DataFrame, alive: list[int]) -> None:
    """Per kind the least of 200 steps of chance from which on the held-out labelled spans are right often enough."""
    chance = F.floor(200 / (1 + F.exp(-model.score(F.col("kind"), F.col)))).cast("int")
    bins: dict[int, dict[int, list[int]]] = {}
    for r in held.where(F.col("kind").isin(alive)).groupBy("kind", chance.alias("bin"), "label").agg(F.sum("n").alias("n")).collect():
        bins.setdefault(r.kind, {}).setdefault(r.bin, [0, 0])[r.label] += r.n
    for k, of_bin in bins.items():
        wrong, right = (sum(c[i] for c in of_bin.values()) for i in (0, 1))
        if min(wrong, right) < LEAST_HELD:
            continue
        w = r = 0
        for b in sorted(of_bin, reverse=True):
            w, r = w + of_bin[b][0], r + of_bin[b][1]
            if b == 0 or r < PRECISION * (w + r):
                break
            model.thresholds[k] = math.log(b / (200 - b)) if b < 200 else math.log(199.5 / 0.5)


def chosen(found: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, base, added): base spans and the proposals taken besides, as (kind, start, end, score), sorted by kind and start."""
    limits = F.array(*(F.lit(float(t)) for t in model.thresholds))

    def plain(s: Column, sure: bool, score: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(sure).alias("sure"), s["kind"].alias("kind"), score.alias("score"))

    base = F.transform("base", lambda s: plain(s, True, F.lit(math.inf)))
    scored = F.transform("proposed", lambda s: plain(s, False, model.score(s["kind"], lambda f: s[f])))
    scored = F.filter(scored, lambda s: s["score"] >= limits[s["kind"].cast("int")])
    rows = found.select("doc_id", base.alias("base"), scored.alias("scored"))
    better = lambda x, y: (x["score"] > y["score"]) | ((x["score"] == y["score"]) & (x["end"] - x["start"] > y["end"] - y["start"]))
    added = F.when(F.size("scored") > 0, _resolved(F.array_sort(F.concat("base", "scored")), better)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,sure:boolean,kind:tinyint,score:double>>"))

    def sorted_spans(column: str | Column) -> Column:
        return F.array_sort(F.transform(column, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))))

    return rows.select("doc_id", sorted_spans("base").alias("base"), sorted_spans(added).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"].cast("int")], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of base spans by kind, SHA-256 of their list, the list of all spans, and ``base`` and ``added`` as arrays."""
    found = settle(candidates(docs), "candidates")
    rows = chosen(found, fitted(found))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "added"))).alias("spans"), "base", "added")
