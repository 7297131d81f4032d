"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import decontamination, filter_audit, html_text, mixing, near_duplicates, personal_data, quality, substring_dedup, topk, toxicity, url_filters, vector_codes, warc
from tableferry.llm.shared import by_ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


@registered(
    f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format("translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS l FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
  ELSE list_transform(range(1, len(l) - 1), lambda i: array_to_string(l[i:i+2], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id WHERE r.c < e.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN m ON m.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
)
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@registered(
    f"""
WITH w AS (SELECT doc_id, {WORDS.format("COALESCE(text, '')")} AS l FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(l) - 11)) AS p, l FROM w WHERE len(l) >= 13),
k AS (SELECT doc_id, p, array_to_string(l[p:p+12], ' ') AS s FROM x),
f AS (SELECT s, min(doc_id) AS d FROM k GROUP BY s),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM k JOIN f USING (s) WHERE f.d < k.doc_id),
v AS (SELECT doc_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS i FROM w),
o AS (SELECT v.doc_id, count(*) FILTER (WHERE g.i IS NOT NULL) AS gone,
  string_agg(t, ' ' ORDER BY v.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM v LEFT JOIN g ON g.doc_id = v.doc_id AND g.i = v.i GROUP BY v.doc_id)
SELECT w.doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(COALESCE(gone, 0) AS BIGINT) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM w LEFT JOIN o USING (doc_id)"""
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.without_repeats(table(spark, sf_dir, "documents"), length=13)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


@registered()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return quality.scored(docs, quality.fitted(docs, labels)).select("doc_id", "held_out", "score", "predicted")


@registered()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity.scored(docs, toxicity.fitted(docs, labels)).select("doc_id", "held_out", "score", "predicted")


@registered("""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@registered("""
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, upper(sha1(b)) AS x FROM p),
c AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(x, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS g FROM h),
t AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST((g[CAST(j // 4 + 1 AS BIGINT)] >> (15 - 5 * CAST(j % 4 AS INT))) & 31 AS BIGINT) + 1, 1)), '') AS d FROM c),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS r FROM t)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> r THEN r END AS refers_to FROM m""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@registered()
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@registered()
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as domains, learned from the documents that ``labels`` covers; small languages are lifted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = by_ids(docs, table(spark, sf_dir, "labels"), "left_semi").select("text", F.col("lang").alias("domain"))
    return mixing.mixed(docs, labelled)


def list_entries(pages: DataFrame) -> DataFrame:
    """A history of list entries made from the pages' own hosts, paths and domains."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    first = F.regexp_extract("url", r"^[a-z]+://[^/?#]*/([^/?#]*)", 1)
    names = pages.select(host.alias("h"), first.alias("s")).where("h <> ''").distinct()
    kinds = [("hosts", F.col("h")), ("paths", F.concat("h", F.lit("/"), "s")), ("domains", F.substring_index("h", ".", -2))]
    patterns = reduce(DataFrame.unionAll, [names.select(F.lit(k).alias("list"), p.alias("pattern")).distinct() for k, p in kinds])
    m = patterns.where("NOT pattern LIKE '%/'").withColumn("m", F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("long"))
    verdict = m.withColumn("verdict", F.expr("CASE WHEN list = 'paths' AND m % 2 = 0 THEN 'allow' ELSE 'block' END"))
    add = verdict.select("list", "verdict", "pattern", F.lit("add").alias("action"), F.expr("m % 100").alias("at"))
    remove = verdict.where("m % 3 <> 0").select("list", "verdict", "pattern", F.lit("remove"), F.expr("m % 100 + 20 + m % 30"))
    again = verdict.where("m % 5 < 3").select("list", "verdict", "pattern", F.lit("add"), F.expr("m % 100 + 70"))
    return add.unionAll(remove).unionAll(again)


@registered("""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h, regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]*)', 1) AS s,
  regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1) AS path, page_id * 7919 % 200 AS fetched_at FROM pages),
k AS (SELECT DISTINCT 'hosts' AS list, h AS pattern FROM p WHERE h <> '' UNION SELECT DISTINCT 'paths', h || '/' || s FROM p WHERE h <> '' AND s <> ''
  UNION SELECT DISTINCT 'domains', array_to_string(string_split(h, '.')[-2:], '.') FROM p WHERE h <> ''),
m AS (SELECT *, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS m FROM k),
e AS (SELECT *, m % 100 AS since, CASE WHEN m % 3 <> 0 THEN m % 100 + 20 + m % 30 WHEN m % 5 < 3 THEN m % 100 + 70 END AS until FROM m
  UNION ALL SELECT *, m % 100 + 70, NULL FROM m WHERE m % 5 < 3),
a AS (SELECT p.page_id, p.url, p.fetched_at, e.pattern, e.list, e.list = 'paths' AND e.m % 2 = 0 AS allow FROM p JOIN e
  ON (CASE WHEN e.list = 'paths' THEN starts_with(lower(h || path) || '/', lower(e.pattern) || '/') ELSE h = e.pattern OR ends_with(h, '.' || e.pattern) END)
  AND e.since <= p.fetched_at AND (e.until IS NULL OR p.fetched_at < e.until)),
r AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, allow DESC, pattern DESC, list DESC) AS k FROM a)
SELECT p.page_id, p.url, p.fetched_at, CAST(COALESCE(r.n, 0) AS BIGINT) AS n_active, lower(r.pattern) AS pattern, r.list AS list, COALESCE(r.allow, true) AS kept
FROM p LEFT JOIN r ON r.page_id = p.page_id AND r.k = 1""")
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("page_id * 7919 % 200"))
    return url_filters.judged(captures, list_entries(pages))


@registered()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered(
    f"""
WITH t AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
w AS (SELECT *, {WORDS.format("text")} AS l FROM t),
m AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS least FROM w),
f AS (SELECT doc_id, part, CAST(len(l) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(l)) < 65 * len(l) AS INT)
  + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INT)
  + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(COALESCE(doc_id > least, false) AS INT) AS bits FROM m),
g AS (SELECT part, bits, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM f LEFT JOIN labels USING (doc_id) GROUP BY ALL),
p AS (SELECT a || b || c || d || e AS filter_order FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS a(a), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS b(b),
  (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS c(c), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS d(d), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS e(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
s AS (SELECT filter_order, step, 1 << CAST(ascii(substr(filter_order, step, 1)) - 65 AS INT) AS b,
  CAST(COALESCE(list_sum(list_transform(range(1, step), lambda j: 1 << CAST(ascii(substr(filter_order, j, 1)) - 65 AS INT))), 0) AS BIGINT) AS a
  FROM p, range(1, 6) AS r(step)),
x AS (SELECT part, filter_order, CAST(step AS INT) AS step, b, sum(n) FILTER (WHERE bits & (a | b) = 0) AS kept,
  sum(n) FILTER (WHERE bits & b <> 0 AND bits & a = 0) AS removed, sum(n) FILTER (WHERE bits & b <> 0 AND bits & a <> 0) AS redundant,
  sum(n) FILTER (WHERE bits = b) AS unique_fails, sum(good) FILTER (WHERE bits & b <> 0 AND bits & a = 0) AS good_lost,
  sum(toxic) FILTER (WHERE bits & b <> 0 AND bits & a = 0) AS toxic_lost FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(COALESCE(kept, 0) AS BIGINT) AS kept, CAST(COALESCE(removed, 0) AS BIGINT) AS removed, CAST(COALESCE(redundant, 0) AS BIGINT) AS redundant,
  CAST(COALESCE(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(COALESCE(good_lost, 0) AS BIGINT) AS good_lost, CAST(COALESCE(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(COALESCE(sum(removed) OVER (PARTITION BY part, b), 0) AS BIGINT) AS shapley FROM x"""
)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return filter_audit.audited(docs, table(spark, sf_dir, "labels"))


def _lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds written out one after the other, each assigning every part anew."""
    whole = f"""k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v FROM k, range({parts}) AS r(part)),
i AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k),
b0 AS MATERIALIZED (SELECT part, entry, v AS c FROM i JOIN d USING (vec_id) WHERE entry < {entries})"""
    steps = [whole]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, part, v, min({{'far': far, 'entry': entry}}) AS best FROM (
  SELECT vec_id, label, part, v, entry, list_sum(list_transform(range(1, len(v) + 1), lambda j: (v[j] - c[j]) * (v[j] - c[j]))) AS far
  FROM d JOIN b{r} USING (part)) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT part, best.entry AS entry, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, len(v) + 1) AS q(j) GROUP BY ALL),
n{r} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM m{r} GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT part, entry, COALESCE(n{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN n{r} USING (part, entry))""")
    return f"""
WITH {", ".join(steps)},
e AS (SELECT vec_id, label, string_agg(lpad(format('{{:x}}', best.entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.far) AS BIGINT) AS error FROM a{rounds} GROUP BY ALL),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS x FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s.x AS codebooks_sha256 FROM e, s"""


@registered(_lloyd_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.encoded(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@registered()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.personal_data(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
