from __future__ import annotations

import fnmatch
import hashlib
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.functions import measures as M
from tableferry.functions import names as N
from tableferry.functions import rowcode as R

quick = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
GLOBS = ["*", "tmp_*", "t?", "[ab]*", "[!ab]*", "a[", "x.y*", "*_%", "", "[]]x", "[^a]b", "a+b", "*[0-9]", "[a-c]?[!x]*"]
NAMES = ["tmp_1", "TMP_x", "t1", "a1", "b", "c1", "a[", "x.y1", "xay1", "q_%", "", "]x", "^b", "ab", "a+b", "aab", "z9", "bcd", "line\nbreak"]


def test_globs_match_like_a_shell(spark):
    pairs = spark.createDataFrame([(n, g) for n in NAMES for g in GLOBS], "name string, glob string")
    got = pairs.select("name", "glob", N.matches_any(F.col("name"), F.array(N.glob_regex(F.col("glob")))).alias("hit")).collect()
    for r in got:
        assert r["hit"] == fnmatch.fnmatchcase(r["name"].lower(), r["glob"].lower()), (r["name"], r["glob"])


@pytest.mark.parametrize("glob", GLOBS)
def test_known_globs_match_like_a_shell(spark, glob):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    hits = {r[0] for r in names.filter(N.like_glob(F.col("name"), glob)).collect()}
    assert hits == {n for n in NAMES if fnmatch.fnmatchcase(n.lower(), glob.lower())}


def test_list_cells(spark):
    cells = {
        "['a','*b*']": ["a", "*b*"], "": [], "  ": [], "[]": [], "['x y' , \"z\"]": ["x y", "z"], "('a', 'b')": ["a", "b"],
        "['broken": [], "plain": [], "'one'": ["one"], "[1, 'a']": ["1", "a"], "['a',]": ["a"], "['a,b']": ["a,b"], "['a' 'b']": [],
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string").select("c", N.list_cell(F.col("c")).alias("l"))
    assert {r["c"]: r["l"] for r in df.collect()} == cells


def test_name_lists(spark):
    texts = {'["a.b", "c"]': ["a.b", "c"], "a, b ,,c": ["a", "b", "c"], "": [], "[]": [], "one": ["one"]}
    df = spark.createDataFrame([(c,) for c in texts], "c string").select("c", N.name_list(F.col("c")).alias("l"))
    assert {r["c"]: r["l"] for r in df.collect()} == texts


def test_class_bounds_and_unmeasured(spark):
    gib = 1024 ** 3
    sizes = {None: "UNKNOWN", 0: "SMALL", 10 * gib - 1: "SMALL", 10 * gib: "MEDIUM", 100 * gib: "LARGE", 1000 * gib - 1: "LARGE", 1000 * gib: "XLARGE"}
    df = spark.createDataFrame([(s,) for s in sizes], "b bigint")
    got = df.select("b", M.workload_class(F.col("b")).alias("c"), M.gib(F.col("b")).alias("g")).collect()
    assert {r["b"]: r["c"] for r in got} == sizes
    assert {r["b"]: r["g"] for r in got}[None] is None


def test_outcome_texts(spark):
    texts = {
        "SUCCESS:batch=b,chunk=3,ok=5,fail=0": (5, 0), "PARTIAL_FAILURE:batch=b,chunk=1,ok=2,fail=3": (2, 3), "SUCCESS": (7, 0),
        "FAILED: boom": (0, 7), "SUCCESS ok=x,fail=1": (7, 0),
    }
    df = spark.createDataFrame([(c,) for c in texts], "c string").select("c", M.outcome_counts(F.col("c"), F.lit(7)).alias("o"))
    assert {r["c"]: tuple(r["o"]) for r in df.collect()} == texts


def test_rows_that_join_alike_hash_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a"), ("__NULL__", "a"), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    for h in (R.row_md5(df), R.row_sha256(df), R.row_words(df)[0]):
        assert df.select(h).distinct().count() == len(rows)


def test_maps_hash_by_content(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 2, 'b', 1)")
    for h in (R.row_md5(df), R.row_words(df)[0], R.row_key(df)[1]):
        assert df.select(h).distinct().count() == 2


@quick
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=50))
def test_hash_sum_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "h bigint")
    assert df.agg(R.exact_hash_sum(F.col("h"))).first()[0] == Decimal(sum(values))


def test_sha_hash_keeps_all_bits(spark):
    df = spark.createDataFrame([("k", 3)], "a string, b int")
    digest = hashlib.sha256(b"1:k1:3").hexdigest()
    assert list(df.select(*R.row_words(df, algorithm="SHA256")).first()) == [int(digest[i : i + 8], 16) for i in range(0, 64, 8)]
    with pytest.raises(ValueError):
        R.row_words(df, algorithm="CRC")


def test_row_keys_tell_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(*R.row_key(df)).distinct().count() == len(rows)
    zero = spark.createDataFrame([(0.0,), (-0.0,), (None,), (float("nan"),), (-1.0,)], "d double")
    assert zero.select(*R.row_key(zero)).distinct().count() == 5


def test_sample_depends_on_content_only(spark):
    df = spark.range(5000).withColumn("t", F.col("id").cast("string"))
    again = df.repartition(7, "t")
    a, b = ({r[0] for r in d.filter(R.sampled(R.row_key(d)[0], 10.0)).collect()} for d in (df, again))
    assert a == b and 350 < len(a) < 650
