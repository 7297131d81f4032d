"""URL filters with a history: list entries become validity intervals, captures are judged as of their fetch.

An entry names a pattern (a host with all hosts below it, "example.org", or a host and the beginning of its
path in whole segments, "example.org/a/b"), a list, a verdict ("block" or "allow"), and whether it was added or
removed at a time. Of the entries active when a capture was fetched, the longest pattern decides, "allow" before
"block" among equals.

Every capture is joined by equality on the patterns that could match it, then by time; intervals of one
list and pattern do not overlap. A host of very many captures is a large key on the captures' side only,
which Spark may split. Everything is built-in functions.

Dots at the end of a host, of a capture or a pattern, mean the same host and are taken off.

Captures of null url or time match nothing and are kept; rows that repeat a capture are one. Entries
with a null in pattern, list, verdict, action or time are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, pattern, since, until): from an addition to the next event of the same list, verdict and pattern.

    Of events at one time a removal counts last. ``until`` is null for what is still in force.
    """
    pattern = F.regexp_replace(F.lower("pattern"), r"^([^/]*?)\.+(?=/|\z)", "$1")
    whole = entries.select("list", "verdict", pattern.alias("pattern"), "action", "at").dropna().distinct()
    turn = Window.partitionBy("list", "verdict", "pattern").orderBy("at", F.when(F.col("action") == "add", 0).otherwise(1))
    following = whole.withColumn("until", F.lead("at").over(turn))
    return following.where("action = 'add' AND (until IS NULL OR until > at)").select("list", "verdict", "pattern", F.col("at").alias("since"), "until")


def patterns_of(url: Column) -> Column:
    """All patterns that match a URL: its host's suffixes, and its host with every beginning of its path."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"\.+\z", "")
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    begun = F.transform(parts, lambda _, i: F.concat(host, F.lit("/"), F.lower(F.array_join(F.slice(parts, 1, i + 1), "/"))))
    return F.when(host != "", F.array_distinct(F.concat(suffixes, begun)))


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (page_id, url, fetched_at): n_active, pattern and list that decide, kept.

    ``entries``: (list, verdict, pattern, action, at).
    """
    whole = captures.select("page_id", "url", "fetched_at").distinct()
    asked = whole.select("page_id", "url", "fetched_at", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    valid = intervals(entries)
    active = asked.join(valid, "pattern").where((F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until"))))
    rank = F.struct(F.length("pattern"), (F.col("verdict") == "allow").alias("allow"), "pattern", "list")
    decided = active.groupBy("page_id", "url", "fetched_at").agg(F.count("*").alias("n_active"), F.max(rank).alias("top"))
    on = " AND ".join(f"w.{c} <=> d.{c}" for c in whole.columns)
    joined = whole.alias("w").join(decided.alias("d"), F.expr(on), "left").select("w.*", "n_active", "top")
    return joined.select(
        "page_id", "url", "fetched_at", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("top.pattern").alias("pattern"),
        F.col("top.list").alias("list"), F.coalesce(F.col("top.allow"), F.lit(True)).alias("kept"),
    )
