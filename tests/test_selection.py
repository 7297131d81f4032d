from __future__ import annotations

import fnmatch
import os

import pytest
from pyspark.sql import functions as F

from tableferry import schemas as S
from tableferry.operators import exclusion as E
from tableferry.operators import gate as G
from tableferry.operators import selection as X
from tableferry.session import new_folder
from tableferry.sources import file_walk as W
from tableferry.sources import listing as L
from tableferry.sources import selection_inputs as I


def listing(spark, names, table_type="MANAGED"):
    rows = [(*n.split("."), table_type, False, "parquet", None) for n in names]
    return spark.createDataFrame(rows, S.LISTING)


def write_text(spark, text, name="in.csv"):
    folder = new_folder(spark, "text")
    os.makedirs(folder)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def sources(df):
    return sorted(".".join(r) for r in df.select(*S.SOURCE_NAME).collect())


# Three mapping rows over ten tables select exactly seven.
SEVEN = """clone_type,source_catalog,source_schema,source_table,target_catalog,target_schema,target_table,exclude_schemas,exclude_tables
table,shop,finance,dim_finance_01,copy,finance,dim_finance_01_renamed,,
schema,shop,hr,,copy,hr,,,['hr_table1']
catalog,shop,,,copy,,,['hr'],"['*lineage*','dim_finance_03']"
"""
TEN = [
    "shop.finance.dim_finance_01", "shop.finance.dim_finance_02", "shop.finance.dim_finance_03", "shop.finance.fact_finance_txn",
    "shop.finance.data_lineage_log", "shop.hr.dim_hr_01", "shop.hr.dim_hr_02", "shop.hr.dim_hr_03", "shop.hr.fact_hr_payroll", "shop.hr.hr_table1",
]


def test_three_mapping_rows_give_seven_tables(spark):
    raw = I.read_table_file(spark, write_text(spark, SEVEN))
    assert I.is_row_level(raw)
    chosen = X.first_wins(X.expand(I.good(I.mappings(raw)), listing(spark, TEN)))
    rows = {r["source_table"]: r for r in chosen.collect()}
    assert sorted(rows) == ["dim_finance_01", "dim_finance_02", "dim_hr_01", "dim_hr_02", "dim_hr_03", "fact_finance_txn", "fact_hr_payroll"]
    assert rows["dim_finance_01"]["target_table"] == "dim_finance_01_renamed"
    assert {r["target_catalog"] for r in rows.values()} == {"copy"}


def test_130_tables_less_a_schema_and_a_table(spark):
    names = [f"bulk.{s}.{k}_{s}_{i:02d}" for s in ("finance", "iot", "marketing", "ops", "sales") for k in ("dim", "fact") for i in range(1, 14)]
    assert len(names) == 130
    rules = I.good(I.exclusion_rules(I.read_table_file(spark, write_text(
        spark, "exclude_type,catalog,schema,table\nschema,BULK,iot,\ntable,bulk,finance,dim_finance_01\n,bulk,x,\nschema,bulk,,\n"))))
    assert rules.count() == 2
    selection = X.with_target_defaults(listing(spark, names).select(
        F.monotonically_increasing_id().alias("ordinal"), F.col("catalog").alias("source_catalog"), F.col("schema_name").alias("source_schema"),
        F.col("table_name").alias("source_table"), *[F.lit("").alias(c) for c in S.TARGET_NAME]))
    kept, excluded = E.apply_exclusions(selection, rules)
    assert (kept.count(), excluded.count()) == (103, 27)
    texts = {r["exclusion_rule"]: r["n"] for r in excluded.groupBy("exclusion_rule").agg(F.count("*").alias("n")).collect()}
    assert texts == {"schema:BULK.iot": 26, "table:bulk.finance.dim_finance_01": 1}
    row = E.coverage(selection, kept, excluded).first()
    assert row["complete"] and row["resolved"] == 130
    assert E.uncovered(selection, kept, excluded).isEmpty()


def test_no_rules_exclude_nothing(spark):
    selection = spark.createDataFrame([("c", "s", "t", "c", "s", "t", 1)], S.SELECTION)
    kept, excluded = E.apply_exclusions(selection, I.no_rules(spark))
    assert kept.count() == 1 and excluded.isEmpty()


def test_first_matching_rule_is_the_one_of_plain_matching(spark):
    rules = [
        (1, "schema", "cat_0", "sch_1", ""), (2, "table", "cat_*", "sch_*", "tmp_*"), (3, "catalog", "CAT_2", "", ""), (4, "table", "cat_1", "sch_3", "st?g*"),
        (5, "catalog", "*_3", "", ""), (6, "schema", "cat_[45]", "*x", ""), (7, "table", "*", "*", "*_9"), (8, "schema", "cat", "sch", ""),
        (9, "table", "cat_1", "?ch_5", "[!t]*"),
    ]
    frame = spark.createDataFrame(rules, S.RULES)
    names = [(f"Cat_{c}", f"sch_{s}{e}", f"{t}_{i}", "a", "b", "c") for c in range(7) for s in range(1, 6) for e in ("", "x") for t in ("tmp", "stag", "t") for i in (1, 9)]
    selection = spark.createDataFrame([(*n, i) for i, n in enumerate(names)], S.SELECTION)
    got = {r["ordinal"]: r["rule_ordinal"] for r in E.first_rule(selection, frame).collect()}

    def first(name):
        for at, kind, *globs in rules:
            depth = ["catalog", "schema", "table"].index(kind) + 1
            if all(fnmatch.fnmatchcase(n.lower(), g.lower()) for n, g in zip(name[:depth], globs[:depth], strict=True)):
                return at
        return None

    assert got == {i: first(n) for i, n in enumerate(names)} and len(set(got.values())) > 6


def test_rules_that_cannot_be_applied_are_told_and_match_nothing(spark):
    frame = spark.createDataFrame([(1, "Table", "c", "s", "t"), (2, "table", "c", "s", None), (3, "column", "c", "s", "t"), (None, "catalog", "c", "", "")], S.RULES)
    good, bad = E.checked_rules(frame)
    assert [(r["ordinal"], r["exclude_type"]) for r in good.collect()] == [(1, "table")]
    assert {r["ordinal"]: r["reason"] for r in bad.collect()} == {2: "a pattern is missing", 3: "unknown type: column", None: "no place in the order"}
    selection = spark.createDataFrame([("c", "s", "t", "a", "b", "c", 1), ("c", "s", "u", "a", "b", "c", 2)], S.SELECTION)
    assert {r["ordinal"]: r["rule_ordinal"] for r in E.first_rule(selection, frame).collect()} == {1: 1, 2: None}


def test_lines_of_several_files_keep_the_order_of_names_and_lines(spark, tmp_path):
    for k, lines in (("b", 400), ("a", 3), ("c", 30)):
        (tmp_path / f"{k}.csv").write_text("name\n" + "".join(f"{k}{i}\n" for i in range(lines)))
    got = [r["name"] for r in I.read_table_file(spark, str(tmp_path)).orderBy("ordinal").collect()]
    assert got == [f"{k}{i}" for k, n in (("a", 3), ("b", 400), ("c", 30)) for i in range(n)]


def test_names_of_many_partitions_are_numbered_in_order(spark):
    params = spark.range(3000).selectExpr("concat('c', id, ', d', id) AS names").repartition(1).repartition(1500)
    got = I.parameter_mappings(params, "catalog").collect()
    assert len({r["ordinal"] for r in got}) == len(got) == 6000
    by = {r["source_catalog"]: r["ordinal"] for r in got}
    assert all(by[f"c{i}"] < by[f"d{i}"] for i in range(3000))


def test_document_forms(spark):
    names = ["lake.a.customers", "lake.a.orders", "lake.a.tmp_scratch", "lake.b.transactions", "lake.b.staging_load"]
    newer = {"migration": {"mappings": [
        {"type": "catalog", "source": "lake", "exclude_schemas": ["b"], "exclude_tables": ["tmp_*"]},
        {"source_catalog": "lake", "source_schema": "b", "target_schema": "b2", "exclude_tables": ["staging_*"]},
        {"type": "table", "source_catalog": "lake", "source_schema": "a", "source_table": "customers", "target_schema": "c", "target_table": "customers_copy"},
    ]}}
    expanded = X.expand(I.good(I.document_mappings(spark, newer)), listing(spark, names))
    assert sources(expanded) == ["lake.a.customers", "lake.a.customers", "lake.a.orders", "lake.b.transactions"]
    # First wins on the source; the later rename is told, not lost.
    assert sources(X.first_wins(expanded)) == ["lake.a.customers", "lake.a.orders", "lake.b.transactions"]
    dup = X.later_duplicates(expanded).first()
    assert (dup["source_table"], dup["selected"], dup["reason"]) == ("customers", 2, "DUPLICATE_SOURCE")
    older = {"migration": {"selection": {"type": "table", "tables": [{"source_catalog": "lake", "source_schema": "z", "source_table": "q"}]}}}
    assert sources(X.expand(I.good(I.document_mappings(spark, older)), listing(spark, names))) == ["lake.z.q"]
    pointed = write_text(spark, SEVEN, "list.csv")
    by_csv = {"migration": {"csv_path": "list.csv", "mappings": newer["migration"]["mappings"]}}
    rows = I.document_mappings(spark, by_csv, os.path.join(os.path.dirname(pointed), "doc.yaml"))
    assert I.good(rows).count() == 3


def test_quoted_cells_and_bad_rows(spark):
    text = SEVEN + ",,,,,,,,\nview,shop,a,b,,,,,\nschema,shop,,,,,,,\n,shop,hr,plain,,,,,\n"
    rows = I.mappings(I.read_table_file(spark, write_text(spark, text)))
    assert sorted(r["reason"] for r in I.bad(rows).collect()) == ["missing source_catalog", "missing source_schema", "unknown clone_type"]
    lists = {r["scope"]: r["exclude_tables"] for r in I.good(rows).filter("scope <> 'table'").collect()}
    assert lists == {"schema": ["hr_table1"], "catalog": ["*lineage*", "dim_finance_03"]}
    plain = I.good(rows).filter("source_table = 'plain'").first()
    assert plain["scope"] == "table" and plain["target_table"] == "plain"


# Five tables, all blocked; seven, five of them blocked; five, none blocked.
SETTINGS = [
    ("CATALOG", "src", "", None, "DISABLE"), ("CATALOG", "cat_b", "", None, "ENABLE"), ("SCHEMA", "src", "sa_on", None, "ENABLE"),
    ("TABLE", "src", "sa_mixed", "t_m_on", "ENABLE"), ("SCHEMA", "src", "sa_mixed", None, "INHERIT"),
]
BLOCKED = {"src.sa_mixed.t_m_on": "TABLE", "src.sa_on.t_sch1": "SCHEMA", "src.sa_on.t_sch2": "SCHEMA", "cat_b.sb.t_b1": "CATALOG", "cat_b.sb.t_b2": "CATALOG"}
CLEAN = ["src.sa_mixed.t_m_ok", "src.clean.t_single"]


def gated(spark, names):
    df = spark.createDataFrame([tuple(n.split(".")) for n in names], "source_catalog string, source_schema string, source_table string")
    return G.setting_gate(df, spark.createDataFrame(SETTINGS, S.SETTINGS))


def test_gate_scenarios(spark):
    rows = {".".join(r[:3]): r for r in gated(spark, [*BLOCKED, *CLEAN]).collect()}
    assert {n for n, r in rows.items() if r["blocked"]} == set(BLOCKED)
    assert {n: rows[n]["level"] for n in BLOCKED} == BLOCKED
    assert rows["src.sa_on.t_sch1"]["source_name"] == "src.sa_on" and rows["src.sa_mixed.t_m_on"]["source_name"] is None
    G.raise_if_blocked(gated(spark, CLEAN))
    with pytest.raises(RuntimeError, match="5 source table.*cat_b.sb.t_b1 \\(PREDICTIVE_OPTIMIZATION_ENABLED\\)"):
        G.raise_if_blocked(gated(spark, list(BLOCKED)))


def test_unknown_setting_blocks(spark):
    r = gated(spark, ["nowhere.s.t"]).first()
    assert r["blocked"] and r["gate_code"] == "PREDICTIVE_OPTIMIZATION_UNKNOWN" and r["value"] is None


def test_listing_of_the_session(spark):
    spark.range(3).createOrReplaceTempView("listed_view")
    rows = L.session_listing(spark).filter("table_name = 'listed_view'").collect()
    assert rows and all(r["is_temporary"] for r in rows)
    assert L.copyable(L.session_listing(spark)).filter("table_name = 'listed_view'").isEmpty()


def test_listing_tells_format_and_location(spark):
    where = new_folder(spark, "listed")
    spark.sql("CREATE SCHEMA IF NOT EXISTS `odd_schema`")
    try:
        spark.sql(f"CREATE TABLE `odd_schema`.plain (a INT, `Provider: x` STRING COMMENT 'Type: VIEW') USING parquet LOCATION '{where}'")
        spark.sql("CREATE TABLE `odd_schema`.own USING json AS SELECT 1 AS a")
        spark.sql("CREATE VIEW `odd_schema`.seen AS SELECT 1 AS a")
        rows = {r["table_name"]: r for r in L.session_listing(spark).filter("schema_name = 'odd_schema'").collect()}
        assert set(rows) == {"plain", "own", "seen"}
        told = {k: (r["table_type"], r["format"], r["is_temporary"]) for k, r in rows.items()}
        assert told == {"plain": ("EXTERNAL", "parquet", False), "own": ("MANAGED", "json", False), "seen": ("VIEW", None, False)}
        assert rows["plain"]["location"].endswith(where) and rows["own"]["location"] and rows["seen"]["location"] is None
        listed = L.session_listing(spark)
        wanted = listed.filter("schema_name = 'odd_schema'").selectExpr("catalog source_catalog", "schema_name source_schema", "table_name source_table")
        assert [r["source_table"] for r in L.requested_and_usable(wanted, listed).collect()] == ["plain"]
    finally:
        spark.sql("DROP SCHEMA `odd_schema` CASCADE")


def test_rivals_for_a_target(spark):
    rows = [(0, "c", "s", "a", "t", "x", "One"), (1, "c", "s", "b", "t", "x", "ONE"), (2, "c", "S", "A", "t", "x", "one"), (3, "c", "s", "d", "t", "x", "two"), (4, "c", "s", "e", None, "x", "one"), (5, "c", "s", "d", "t", "x", "two")]
    selection = spark.createDataFrame(rows, f"ordinal bigint, {', '.join(c + ' string' for c in [*S.SOURCE_NAME, *S.TARGET_NAME])}")
    assert [r[3:7] for r in X.target_conflicts(selection).collect()] == [(2, 3, 0, 2)]
    assert {r["ordinal"]: r["target_rivals"] for r in X.with_target_rivals(selection).collect()} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    assert X.target_conflicts(selection.limit(0)).isEmpty()


def test_folder_stats_are_those_of_the_files(spark):
    root = "/root/testdata/sf0.001"
    rows = {r["table_fqn"]: r for r in L.folder_stats(spark, root, "c.s.").collect()}
    for f in os.listdir(root):
        r = rows[f"c.s.{f.removesuffix('.parquet')}"]
        assert r["size_in_bytes"] == os.path.getsize(f"{root}/{f}") and r["num_files"] == 1
        assert r["location"] == f"{root}/{f}"


def test_files_are_listed_by_level_and_hidden_ones_are_not(spark, monkeypatch):
    monkeypatch.setattr(W, "FOLDERS_PER_TASK", 3)
    root = new_folder(spark, "walk")
    want = {}
    for table in ("plain", "deep", "odd é =1", "empty"):
        want[table] = [0, 0]
        for depth in range({"plain": 1, "deep": 6, "odd é =1": 2, "empty": 0}[table]):
            for k in range(4):
                folder = "/".join([root, table, *[f"_k{d}={k}" for d in range(depth)]])
                os.makedirs(f"{folder}/_temporary", exist_ok=True)
                for name in ("a.parquet", ".a.crc", "_SUCCESS", "_temporary/b.parquet"):
                    with open(f"{folder}/{name}", "wb") as f:
                        f.write(b"x" * (depth + 1))
                if k == 0 or depth:
                    want[table][0] += 1
                    want[table][1] += depth + 1
    os.makedirs(f"{root}/empty/none")
    for prefix in ("", "file://"):
        got = {r["table_fqn"]: [r["num_files"], r["size_in_bytes"]] for r in L.folder_stats(spark, prefix + root).collect()}
        assert got == {k: v for k, v in want.items() if v[0]}
    places = [("t", f"{root}/deep"), ("t", f"{root}/plain"), ("file", f"{root}/plain/a.parquet"), ("gone", f"{root}/gone"), ("none", None), ("empty", f"{root}/empty")]
    got = {r[0]: (r["num_files"], r["size_in_bytes"]) for r in L.located_stats(spark.createDataFrame(places, "table_fqn string, location string")).collect()}
    both = tuple(a + b for a, b in zip(want["deep"], want["plain"]))
    assert got == {"t": both, "file": (1, 1), "gone": (0, None), "none": (0, None), "empty": (0, None)}
    nothing = spark.createDataFrame([], "table_fqn string, location string")
    assert L.located_stats(nothing).isEmpty()
    assert L.path_stats(spark, f"{root}/gone").first().asDict() == {"num_files": 0, "size_in_bytes": 0}


def test_longest_prefix_wins_and_a_missing_one_is_told(spark):
    tables = spark.createDataFrame([("abfss://a@x/deep/t",), ("abfss://a@x/t",), ("s3://none/t",)], "location string")
    rules = spark.createDataFrame([("abfss://a@x", "gs://a"), ("abfss://a@x/deep", "gs://d")], "src_prefix string, tgt_prefix string")
    got = {r[0]: (r[1], r[2]) for r in X.remapped_locations(tables, rules).collect()}
    assert got == {"abfss://a@x/deep/t": ("gs://d/t", None), "abfss://a@x/t": ("gs://a/t", None), "s3://none/t": (None, "NO_PREFIX_RULE")}


def test_rules_meet_only_names_that_hold_their_literal_pieces(spark):
    names = [("cat", f"s{i % 7}", f"{['t', 'Tmp', 'x_old'][i % 3]}_{i}", i) for i in range(900)]
    selection = spark.createDataFrame(names, "source_catalog string, source_schema string, source_table string, ordinal int")
    globs = [("table", "*", "*", "*_old_17*"), ("table", "*", "*", "*_8[89]?"), ("table", "*", "*", "[a-t]*_51"), ("schema", "*", "*3", None), ("table", "c*", "?5", "TMP*1")]
    globs += [("table", "*", "*", f"*_{k}") for k in range(2000, 2600)] + [("table", "*", "*", f"*q{k}*") for k in range(300)]
    rules = spark.createDataFrame([(i, *g) for i, g in enumerate(globs)], S.RULES)
    got = {r["ordinal"]: r["rule_ordinal"] for r in E.first_rule(selection, rules).collect()}
    want = {}
    for c, sch, t, i in names:
        hits = [k for k, (kind, gc, gs, gt) in enumerate(globs) if fnmatch.fnmatchcase(c, gc.lower()) and fnmatch.fnmatchcase(sch, gs.lower()) and (kind == "schema" or fnmatch.fnmatchcase(t.lower(), gt.lower()))]
        want[i] = min(hits, default=None)
    assert got == want and len(set(got.values())) > 4
    # 905 rules and 900 names: all pairs would be 814,500.
    pairs = E.candidate_pairs(selection, rules).count()
    assert pairs < 3000, pairs


def test_rules_of_one_pattern_count_once_and_inner_pieces_are_met_whole(spark):
    names = [("cat", f"sch_{i % 5}", f"t_{1000000 + 37 * i}", i) for i in range(2000)]
    selection = spark.createDataFrame(names, "source_catalog string, source_schema string, source_table string, ordinal int")
    globs = [("schema", "*", "*_3", None)] * 300 + [("table", "*", "*", f"*{1000000 + k}*") for k in range(0, 80000, 40)] + [("table", "*", "*", "?*_1000037"), ("table", "*", "*", "*7*")]
    rules = spark.createDataFrame([(i, *g) for i, g in enumerate(globs)], S.RULES)

    def first(row):
        hits = (k for k, (kind, _, gs, gt) in enumerate(globs) if fnmatch.fnmatchcase(row[1], gs) and (kind == "schema" or fnmatch.fnmatchcase(row[2], gt)))
        return next(hits, None)

    want = {row[3]: first(row) for row in names}
    for most in (E.BROADCAST_RULES, 100, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(E, "BROADCAST_RULES", most)
            assert {r["ordinal"]: r["rule_ordinal"] for r in E.first_rule(selection, rules).collect()} == want
    # 400 names end so, 50 hold a number, half hold a seven; 300 rules of one pattern made 120,000 pairs.
    assert E.candidate_pairs(selection, rules).count() < 6000
