"""Column expressions for names, globs and list cells."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F


def fqn(*parts: str | Column) -> Column:
    """Dot-joined full name."""
    return F.concat_ws(".", *parts)


def blank_to_null(col: str | Column) -> Column:
    trimmed = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(trimmed != "", trimmed)


def or_default(col: str | Column, default: str | Column) -> Column:
    """Trimmed value, or the default where it is blank."""
    return F.coalesce(blank_to_null(col), F.trim(F.col(default) if isinstance(default, str) else default))


def glob_body(pattern: Column, sep: str = "") -> Column:
    """Regular expression, without anchors, equal to a lower-cased shell glob.

    ``*`` and ``?`` cross every character but ``sep``; a ``[`` without its ``]`` is a plain character.
    """
    # Bracket groups are one token each, so that what is in them is not taken for a wildcard.
    tokens = F.regexp_extract_all(F.lower(pattern), F.lit(r"(?s)(\[!?\]?[^\]]*\]|.)"), 1)
    anything = f"[^{sep}]" if sep else "."

    def one(t: Column) -> Column:
        body = F.regexp_replace(t, r"^\[!?|\]$", "")
        safe = F.regexp_replace(body, r"([\\\[\]&^~|])", r"\\$1")
        group = F.concat(F.when(t.startswith("[!"), F.lit(f"[^{sep}")).otherwise(F.lit("[")), safe, F.lit("]"))
        return (
            F.when(t == "*", F.lit(anything + "*"))
            .when(t == "?", F.lit(anything))
            .when((F.length(t) > 2) & t.startswith("["), group)
            .otherwise(F.regexp_replace(t, r"([^\w\s])", r"\\$1"))
        )

    return F.array_join(F.transform(tokens, one), "")


def glob_regex(pattern: Column) -> Column:
    """Anchored regular expression equal to a lower-cased shell glob."""
    return F.concat(F.lit("(?s)^"), glob_body(pattern), F.lit(r"\z"))


def like_glob(name: Column, glob: str) -> Column:
    """Does a name match a glob known to the caller?  Without wildcards it is an equality."""
    if not any(c in glob for c in "*?["):
        return F.lower(name) == glob.lower()
    # The pattern is a literal, so that it is compiled once and not per row.
    regex = fnmatch.translate(glob.lower())
    return F.lower(name).rlike("^" + regex.removesuffix(r"\Z").removesuffix(r"\z") + r"\z")


def literal_prefix(pattern: Column) -> Column:
    """Characters of a glob before its first wildcard, lower-cased."""
    return F.regexp_extract(F.lower(pattern), r"(?s)^([^*?\[]*)", 1)


def matches_any(name: Column, regexes: Column) -> Column:
    """Does a name match one of an array of regular expressions?  NULL array: no."""
    return F.coalesce(F.exists(regexes, lambda r: F.rlike(F.lower(name), r)), F.lit(False))


def glob_regexes(patterns: Column) -> Column:
    return F.transform(patterns, glob_regex)


def list_cell(cell: Column) -> Column:
    """Decode a list literal such as ``['a', '*b*']`` to an array; a bad or blank cell is empty.

    Quotes and backslashes may be escaped in a text; ``None``, ``True`` and ``False`` read as their names.
    """
    text = F.trim(F.coalesce(cell, F.lit("")))
    item = r"""('(?:[^'\\]|\\['"\\])*'|"(?:[^"\\]|\\['"\\])*")"""
    other = r"([-+]?\d+(?:\.\d+)?|None|True|False)"
    entry = f"(?:{item}|{other})"
    is_list = text.rlike(rf"^[\[(]\s*(?:{entry}\s*(?:,\s*{entry}\s*)*,?)?\s*[\])]$")
    # One quoted string in parentheses is a string, which reads as one entry all the same.
    is_scalar = text.rlike(f"^{entry}$")
    entries = F.regexp_extract_all(text, F.lit(f"({entry})"), 1)
    bare = lambda e: F.regexp_replace(F.regexp_replace(e, r"""^['"]|['"]$""", ""), r"""\\(['"\\])""", "$1")
    plain = F.transform(entries, lambda e: F.trim(bare(e)))
    return F.when(is_list | is_scalar, plain).otherwise(F.array().cast("array<string>"))


def name_list(text: Column) -> Column:
    """Entries of a JSON array or of a comma-separated text, trimmed, blanks dropped."""
    t = F.trim(text)
    parsed = F.when(t.startswith("["), F.from_json(t, "array<string>"))
    items = F.coalesce(parsed, F.split(t, ","))
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
