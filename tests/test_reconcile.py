from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import checks.reconcile_queries  # noqa: F401
from checks.fixtures import Fixtures
from checks.registry import QUERIES
from tableferry.functions import keybits as B
from tableferry.operators import checks as K
from tableferry.operators import gate as G
from tableferry.operators import reconcile as Q
from tableferry.sources import generators as Gen

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Fixtures(spark, DIR)


def test_a_table_does_not_differ_from_itself(t):
    other = t.lineitem.repartition(5, "l_suppkey")
    assert Q.row_differences(t.lineitem, other).isEmpty()
    assert Q.compare_checksums(t.lineitem, other).first()["matched"]
    assert Q.integrity(t.lineitem, other, 5.0).first()["passed"]


def test_multiplicity_counts(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    b = spark.createDataFrame([("x",), ("y",), ("y",)], "v string")
    assert sorted((r["src_count"], r["tgt_count"]) for r in Q.row_differences(a, b).collect()) == [(1, 2), (2, 1)]
    assert not Q.compare_checksums(a, b).first()["matched"]


def _by_key(df):
    return {(r["hash_hi"], r["hash_lo"]): (r["src_count"], r["tgt_count"]) for r in df.collect()}


def test_sampled_differences_are_the_full_ones_within_the_sample(t):
    full = _by_key(Q.row_differences(t.src_rows, t.tgt_rows))
    sampled = _by_key(Q.row_differences(t.src_rows, t.tgt_rows, 30.0))
    assert sampled == {k: n for k, n in full.items() if (k[0] % (1 << 64)) >> 1 < int(0.3 * (1 << 63))} and sampled


def test_a_sample_that_holds_nothing_is_no_pass(spark):
    a = spark.range(200_000)
    got = Q.integrity(a, a.filter("id % 2 = 0"), 1e-9).first()
    assert (got["rows_sampled"], got["passed"], got["detail"]) == (0, False, "no row of the table is in the sample")
    none = Q.integrity(a.limit(0), a.limit(0), 0.001).first()
    assert none["passed"] and none["detail"] == "empty table — skip hash"
    found = Q.integrity(a, a.filter("id % 2 = 0"), 0.5).first()
    assert 500 < found["rows_sampled"] < 1500 and not found["passed"]


def test_other_types_with_the_same_text_are_equal(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    assert Q.row_differences(a, a.withColumn("k", F.col("k").cast("bigint"))).isEmpty()
    assert Q.differing_rows(a, a.withColumn("k", (F.col("k") + 1).cast("string"))).count() == 2


def test_differences_by_brute_force(t):
    s, g = (Counter(map(tuple, df.collect())) for df in (t.src_rows, t.tgt_rows))
    want = sorted((s[k], g[k]) for k in s.keys() | g.keys() if s[k] != g[k])
    rows = Q.differing_rows(t.src_rows, t.tgt_rows)
    by_bucket = Q.row_differences_by_bucket(t.src_rows, t.tgt_rows, buckets=16)
    assert Q.integrity(t.src_rows, t.tgt_rows, buckets=64).first()["hash_mismatches"] == len(want)
    for out in (by_bucket, Q.row_differences(t.src_rows, t.tgt_rows), Q.row_differences_by_part(t.src_rows, t.tgt_rows, ["l_returnflag"]), rows):
        assert sorted((r["src_count"], r["tgt_count"]) for r in out.collect()) == want


def test_one_wrong_row_in_many_is_found(spark):
    a = spark.range(20000).withColumn("v", F.col("id") * 3)
    b = a.withColumn("v", F.when(F.col("id") == 777, -1).otherwise(F.col("v")))
    found = Q.row_differences_by_bucket(a, b)
    assert sorted((r["src_count"], r["tgt_count"]) for r in found.collect()) == [(0, 1), (1, 0)]
    sampled = Q.integrity(a, b, 100.0).first()
    assert (sampled["rows_sampled"], sampled["hash_mismatches"], sampled["passed"]) == (20000, 2, False)
    with pytest.raises(ValueError):
        Q.row_differences_by_bucket(a, b, buckets=1000)


def test_equal_parts_are_left_out(spark):
    a = spark.createDataFrame([("p", 1), ("q", 2), (None, 3)], "part string, v int")
    b = spark.createDataFrame([("p", 1), ("q", 9), (None, 4)], "part string, v int")
    assert {r[0] for r in Q.differing_parts(a, b, ["part"]).collect()} == {"q", None}
    assert Q.row_differences_by_part(a, b, ["part"]).count() == 4


def test_empty_source_passes_the_hash_check(spark):
    empty = spark.createDataFrame([], "v string")
    r = Q.integrity(empty, spark.createDataFrame([("x",)], "v string")).first()
    assert r["passed"] and r["detail"].startswith("empty table")


def test_counts_of_empty_tables_are_zero(spark):
    empty = spark.createDataFrame([], "v string")
    r = Q.paired_counts({"e": (empty, empty), "f": (empty, spark.range(2))}).orderBy("table_name").collect()
    assert [(x["src_rows"], x["tgt_rows"], x["passed"]) for x in r] == [(0, 0, True), (0, 2, False)]
    assert r[1]["detail"] == "src=0 tgt=2 DELTA=+2"


@pytest.mark.parametrize("mode,names", [("NONE", []), ("COUNT", ["COUNT"]), ("checksum", ["CHECKSUM"]), ("COLUMN_SAMPLE", ["COLUMN_SAMPLE"]), ("ALL", ["CHECKSUM", "COLUMN_SAMPLE", "COUNT"])])
def test_modes(t, mode, names):
    out = Q.validate_copy(t.orders, t.orders, mode).collect()
    assert sorted(r["check_name"] for r in out) == names and all(r["passed"] for r in out)


def test_count_tolerance(spark):
    a, b = spark.range(1000), spark.range(1001)
    assert Q.validate_copy(a, b, "COUNT", tolerance_pct=0.1).first()["passed"]
    assert not Q.validate_copy(a, b, "COUNT").first()["passed"]


def test_profile_of_every_kind_of_column(spark):
    spec = next(s for s in Gen.SPECS if s.table_name == "complex_types_table")
    df = Gen.generate(spark, spec, 20).withColumn("maybe", F.when(F.col("id") > 4, F.col("id")))
    rows = {r["column_name"]: r for r in Q.profile(df).collect()}
    assert rows["maybe"]["null_count"] == 5 and rows["maybe"]["min_value"] == "5" and rows["maybe"]["avg_value"] == 12.0
    assert rows["attributes"]["row_count"] == 20 and rows["attributes"]["min_value"] is None
    assert Q.row_differences(df, df.repartition(3)).isEmpty()


def test_wide_table_profile_matches_itself(spark):
    spec = next(s for s in Gen.SPECS if s.table_name == "wide_schema_table")
    df = Gen.generate(spark, spec, 50)
    p = Q.profile(df)
    assert p.count() == 121 and Q.compare_profiles(p, p).filter("NOT matched").isEmpty()


def test_metric_check_texts(spark):
    rows = spark.createDataFrame([(0, 0), (0, 5), (1000, 1010), (1000, 1011), (32, 33)], "s bigint, t bigint")
    got = [r[0] for r in rows.select(K.metric_check("size_bytes", F.col("s"), F.col("t"), 1.0)).collect()]
    assert [g["passed"] for g in got] == [True, False, True, False, False]
    assert [g["message"] for g in got] == [
        "size_bytes src=0 tgt=0", "size_bytes src=0 tgt=5 (target non-zero when source is 0)",
        "size_bytes src=1,000 tgt=1,010 diff=1.00% (tol=1.0%) ✓", "size_bytes src=1,000 tgt=1,011 diff=1.10% (tol=1.0%) ✗ EXCEEDS TOLERANCE",
        "size_bytes src=32 tgt=33 diff=3.12% (tol=1.0%) ✗ EXCEEDS TOLERANCE",
    ]


def test_fail_fast_names_the_first_failure(spark):
    report = spark.createDataFrame([("a", "t1", True, ""), ("b", "t2", False, "no")], "check_name string, table_name string, passed boolean, detail string")
    with pytest.raises(AssertionError, match="Check 'b' failed for table 't2': no"):
        K.raise_on_first_failure(report)
    K.raise_on_first_failure(report.filter("passed"))


def test_generated_tables_are_stable(spark):
    for spec in Gen.SPECS:
        rows = min(spec.rows, 30)
        df = Gen.generate(spark, spec, rows)
        assert df.count() == rows and Q.row_differences(df, Gen.generate(spark, spec, rows).repartition(3)).isEmpty()
    assert Gen.bulk_table(spark, "iot", "dim_iot_01", 7).count() == 7


@pytest.mark.parametrize("few", [0, 100_000])
def test_many_differing_rows_are_found_by_a_bit_map(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW_KEYS", few)
    a = spark.range(20000).selectExpr("id % 15000 AS k", "if(id % 7 = 0, null, 'x') AS v")
    b = a.withColumn("v", F.when(F.col("k") % 10 != 0, F.col("v"))).where("k % 97 <> 5")
    got = Q.differing_rows(a, b)
    both = a.selectExpr("*", "1 AS s", "0 AS g").unionAll(b.selectExpr("*", "0", "1"))
    want = both.groupBy("k", "v").agg(F.sum("s"), F.sum("g")).where("sum(s) <> sum(g)")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect()))) and got.count() > 1000


def test_a_bit_map_loses_no_key_and_lets_few_others_pass(spark):
    rows = spark.range(200000).select("id", F.xxhash64("id").alias("h"))
    met = B.only_marked(rows, "h", B.marked(rows.where("id % 100 = 3"), "h"))
    assert met.where("id % 100 = 3").count() == 2000 and met.count() < 2020


def test_the_shuffled_copy_is_not_dealt_to_a_fixed_number_of_tasks(spark, tmp_path):
    spark.range(1000).selectExpr("id AS l_orderkey", "id % 50 AS l_suppkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("11", "23"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = QUERIES["checksum_ignores_order"].run(Fixtures(spark, str(tmp_path)))
            assert f", {n})" in "".join(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(l_suppkey" in x).replace(f", {n}, ", f", {n})")
            assert tuple(out.first()) == (1000, 1000, True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_settings_of_schemas_do_not_deal_the_selection_by_schema(spark):
    selection = spark.createDataFrame([("c", "s", f"t{i}") for i in range(20)], "source_catalog string, source_schema string, source_table string")
    settings = spark.createDataFrame([("SCHEMA", "c", "s", None, "DISABLE"), ("TABLE", "c", "s", "t1", "ENABLE")], "level string, catalog string, schema_name string, table_name string, value string")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = G.effective_setting(selection, settings)
        assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2
        assert {r["source_table"]: r["value"] for r in out.collect()} == {f"t{i}": "ENABLE" if i == 1 else "DISABLE" for i in range(20)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
