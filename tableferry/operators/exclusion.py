"""Exclusion rules: which rule, if any, takes a table out of a selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.functions import keybits as B
from tableferry.functions import names as N
from tableferry.session import settle

_SEP = "\x1f"
# So many rules (a few hundred bytes each) are sent to all tasks; more are joined by a shuffle.
BROADCAST_RULES = 100_000


def describe_rule() -> Column:
    """Text of a rule, such as ``schema:cat_0.sch_1``."""
    depth = F.when(F.col("exclude_type") == "catalog", 1).when(F.col("exclude_type") == "schema", 2).otherwise(3)
    names = F.array("catalog", "schema_name", "table_name")
    return F.concat(F.col("exclude_type"), F.lit(":"), F.array_join(F.slice(names, F.lit(1), depth), "."))


_DEPTHS = {"catalog": 1, "schema": 2, "table": 3}


def checked_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules that can be applied, their type in lower case, and the others with a ``reason``.

    A rule needs a known type and a pattern for each name that its type covers.
    """
    kind = F.lower(F.trim("exclude_type"))
    depth = F.coalesce(*[F.when(kind == k, n) for k, n in _DEPTHS.items()])
    globs = F.slice(F.array("catalog", "schema_name", "table_name"), F.lit(1), F.coalesce(depth, F.lit(0)))
    reason = (
        F.when(F.col("ordinal").isNull(), "no place in the order")
        .when(depth.isNull(), F.concat(F.lit("unknown type: "), F.coalesce("exclude_type", F.lit("none"))))
        .when(F.exists(globs, lambda g: g.isNull()), "a pattern is missing")
    )
    judged = rules.withColumn("reason", reason)
    good = judged.filter("reason IS NULL").drop("reason").withColumn("exclude_type", kind)
    return good, judged.filter("reason IS NOT NULL")


_KEY_CHARS = (64, 32, 16, 8, 4, 2, 1)
# Lengths of an end that stands alone: it is all there is to tell names apart.
_END_CHARS = (64, 48, 32, 24, 16, 12, 8, 7, 6, 5, 4, 3, 2, 1)
# Inner pieces are looked up at their own length, up to this one, behind heads of the first length that has few enough of them.
_MOST_INNER = 16
_HEAD_CHARS = (4, 2, 1)


def _step(length: Column, steps: tuple[int, ...]) -> Column:
    """The largest of a few lengths that fits; 0 for an empty text."""
    return F.coalesce(*[F.when(length >= n, n) for n in steps], F.lit(0))


def _indexed(rules: DataFrame) -> DataFrame:
    """Rules with their regular expression and the literal pieces of their pattern that a name has to hold.

    The pattern covers as many names as the type does. Its literal start and end are taken, at one of a few lengths; a pattern that
    has neither gives the head of its longest literal piece, which may lie anywhere. Of rules with one pattern only the first
    can be the first that matches a name, so the others are left out.
    """
    depth = F.coalesce(*[F.when(F.col("exclude_type") == k, n) for k, n in _DEPTHS.items()])
    globs = F.slice(F.array("catalog", "schema_name", "table_name"), F.lit(1), depth)
    # The separator closes the last name of a rule that ends before the table name.
    close = F.when(depth < 3, _SEP).otherwise("")
    whole = F.lower(F.concat(F.array_join(globs, _SEP), close))
    told = F.struct("ordinal", "exclude_type", describe_rule().alias("rule_text"))
    kept = rules.groupBy(depth.alias("d"), whole.alias("whole")).agg(F.min(told).alias("r"), F.min_by(globs, told).alias("globs"))
    body = F.concat(F.array_join(F.transform("globs", lambda g: N.glob_body(g, _SEP)), _SEP), F.when(F.col("d") < 3, _SEP).otherwise(""))
    # Bracket groups stand for one of several characters, so they are no literals.
    plain = F.regexp_replace("whole", r"\[!?\]?[^\]]*\]", "*")
    start, end = F.regexp_extract(plain, r"(?s)^([^*?]*)", 1), F.regexp_extract(plain, r"(?s)([^*?]*)$", 1)
    longest = F.array_max(F.transform(F.split(plain, "[*?]"), lambda x: F.struct(F.length(x).alias("n"), x.alias("text"))))["text"]
    inner = F.when((F.length(start) == 0) & (F.length(end) == 0), F.left(longest, F.lit(_MOST_INNER))).otherwise("")
    cut = kept.select("r.*", "d", F.concat(F.lit("(?s)^"), body, F.lit(r"\z")).alias("regex"), start.alias("start"), end.alias("end"), inner.alias("inner"))
    sized = cut.withColumns({"n": _step(F.length("start"), _KEY_CHARS), "m": F.when(F.col("start") == "", _step(F.length("end"), _END_CHARS)).otherwise(_step(F.length("end"), _KEY_CHARS)), "g": F.length("inner")})
    return sized.withColumn("key", _key("d", "n", "m", "g", F.expr("left(start, n)"), F.expr("right(end, m)"), "inner")).drop("start", "end")


def _key(*parts: str | Column) -> Column:
    """Hash of a look-up: its lengths and its pieces. Two look-ups of one hash cost a comparison more, as patterns decide."""
    return F.xxhash64(*parts)


def _heads(inner: DataFrame) -> tuple[int, DataFrame]:
    """Length and table (head, lens) of the first characters of inner pieces, with the lengths that pieces of a head have."""
    sizes = inner.agg(*[F.count_distinct("d", F.left("inner", F.lit(n))).alias(f"n{n}") for n in _HEAD_CHARS]).first()
    most = next((n for n in _HEAD_CHARS if sizes[f"n{n}"] <= BROADCAST_RULES), 1)
    size = _step(F.col("g"), tuple(n for n in _HEAD_CHARS if n <= most))
    head = _key("d", size, F.left("inner", size))
    return most, inner.groupBy(head.alias("head")).agg(F.collect_set("g").alias("lens"))


def candidate_pairs(selection: DataFrame, rules: DataFrame) -> DataFrame | None:
    """(names, ordinal, exclude_type, rule_text, regex, cut): names with the rules whose literal pieces they hold. None without rules.

    Any number of rules goes one way: an equi join on those pieces. A name is looked up once per
    combination of lengths that the rules have; where a rule has neither a literal start nor an end, with each of its own pieces
    that begins like one of a rule. Selected names are made distinct first, so that what fills the selection is not multiplied by
    the rules; with the rules broadcast, behind a check of their number, the names stay where that has put them. More rules are
    joined by a shuffle of the look-ups that a bit map of the rules' keys lets pass, so look-ups that meet no rule are not moved.
    """
    indexed = settle(_indexed(checked_rules(rules)[0]), "rules")
    # Combinations of a few lengths, and how many rules there are, in one job.
    kinds = indexed.groupBy("d", "n", "m", "g").agg(F.count("*").alias("rules")).collect()
    if not kinds:
        return None
    lower = [F.lower(F.col(c)) for c in S.SOURCE_NAME]
    cuts = {d: F.concat(F.concat_ws(_SEP, *lower[:d]), F.lit(_SEP if d < 3 else "")) for d in (1, 2, 3)}
    most, heads = _heads(indexed.where("g > 0")) if any(r.g for r in kinds) else (0, None)
    sizes = {(r.d, 0, 0, next(n for n in _HEAD_CHARS if n <= min(r.g, most))) for r in kinds if r.g}
    asks = sorted({(r.d, r.n, r.m, 0) for r in kinds if not r.g} | sizes)
    ask = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(k, "dnmh", strict=True)]) for k in asks])).alias("k")
    named = selection.select(*S.SOURCE_NAME).distinct().select(*S.SOURCE_NAME, *[c.alias(f"cut{d}") for d, c in cuts.items()])
    asked = named.select("*", ask)
    cut = F.coalesce(*[F.when(F.col("k.d") == d, F.col(f"cut{d}")) for d in cuts])
    asked = asked.select(*S.SOURCE_NAME, cut.alias("cut"), "k.*")
    fixed = _key("d", "n", "m", F.lit(0), F.expr("left(cut, n)"), F.expr("right(cut, m)"), F.lit(""))
    if heads is None:
        asked = asked.withColumn("key", fixed)
    else:
        # Look-ups of starts and ends have no head, meet none and stay.
        places = F.when(F.col("h") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.greatest(F.length("cut") - F.col("h") + 1, F.lit(1))))
        asked = asked.withColumn("at", F.explode(places)).withColumn("head", F.when(F.col("h") > 0, _key("d", "h", F.expr("substring(cut, at, h)"))))
        asked = asked.join(F.broadcast(heads), "head", "left").where("h = 0 OR lens IS NOT NULL")
        asked = asked.withColumn("len", F.explode(F.coalesce("lens", F.array(F.lit(0))))).where("len = 0 OR at + len - 1 <= length(cut)")
        inner = _key("d", F.lit(0), F.lit(0), "len", F.lit(""), F.lit(""), F.expr("substring(cut, at, len)"))
        asked = asked.withColumn("key", F.when(F.col("len") == 0, fixed).otherwise(inner))
    small = indexed.select("key", "ordinal", "exclude_type", "rule_text", "regex")
    if sum(r.rules for r in kinds) <= BROADCAST_RULES:
        return asked.select(*S.SOURCE_NAME, "cut", "key").join(F.broadcast(small), "key").drop("key")
    asked = B.only_marked(asked.select(*S.SOURCE_NAME, "cut", "key"), "key", settle(B.marked(small, "key"), "bits"))
    return asked.join(small, "key").drop("key")


def judged_by_rules(selection: DataFrame, rules: DataFrame) -> DataFrame:
    """The selection with number, type and text of the first rule that matches, NULL if none does."""
    columns = {"rule_ordinal": "bigint", "exclusion_type": "string", "exclusion_rule": "string"}
    pairs = candidate_pairs(selection, rules)
    if pairs is None:
        return selection.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items()})
    hits = pairs.filter(F.rlike("cut", F.col("regex")))
    first = hits.groupBy(*S.SOURCE_NAME).agg(F.min(F.struct("ordinal", "exclude_type", "rule_text")).alias("r"))
    told = [F.col(f"r.{c}").cast(kind).alias(name) for c, (name, kind) in zip(("ordinal", "exclude_type", "rule_text"), columns.items(), strict=True)]
    return selection.join(first.select(*S.SOURCE_NAME, *told), S.SOURCE_NAME, "left")


def first_rule(selection: DataFrame, rules: DataFrame) -> DataFrame:
    """The selection with ``rule_ordinal`` of the first rule that matches. Rules that ``checked_rules`` sorts out match nothing."""
    return judged_by_rules(selection, rules).drop("exclusion_type", "exclusion_rule")


def apply_exclusions(selection: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into the kept rows and the excluded ones with type and text of the rule."""
    judged = judged_by_rules(selection, rules)
    told = ["rule_ordinal", "exclusion_type", "exclusion_rule"]
    return judged.filter(F.col("rule_ordinal").isNull()).drop(*told), judged.filter(F.col("rule_ordinal").isNotNull())


def coverage(selection: DataFrame, onboarded: DataFrame, excluded: DataFrame) -> DataFrame:
    """Do onboarded and excluded tables add up to what was resolved?  One row."""
    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("part"))

    parts = [tagged(selection, "resolved"), tagged(onboarded, "onboarded"), tagged(excluded, "excluded")]
    count = lambda part: F.count(F.when(F.col("part") == part, 1)).alias(part)
    return (
        reduce(DataFrame.unionByName, parts)
        .agg(count("resolved"), count("onboarded"), count("excluded"))
        .withColumn("complete", F.col("onboarded") + F.col("excluded") == F.col("resolved"))
    )


def uncovered(selection: DataFrame, onboarded: DataFrame, excluded: DataFrame) -> DataFrame:
    """Selected tables that are neither onboarded nor excluded."""
    seen = onboarded.select(*S.SOURCE_NAME).unionByName(excluded.select(*S.SOURCE_NAME))
    return selection.select(*S.SOURCE_NAME).join(seen, S.SOURCE_NAME, "left_anti")
