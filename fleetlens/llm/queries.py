"""Registered queries of the subpackage, each beside its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    chat,
    decontaminate,
    host_trust,
    katz,
    language,
    licences,
    mixing,
    near_vectors,
    ngram_join,
    repeats,
    spelling,
    subword,
    token_alignment,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A-Z lower-cased, nothing else; null counts as empty.
FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
TOKENS = rf"regexp_extract_all({FOLD}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS i
        FROM (SELECT *, least(13, len(w)) AS l FROM b WHERE len(w) > 0))),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
tok AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
run AS (
  SELECT doc_id, n, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS g
  FROM tok),
hit AS (
  SELECT r.doc_id, r.i, win.l, win.item
  FROM run r CROSS JOIN (SELECT DISTINCT l FROM win) s
  JOIN win ON win.l = s.l AND win.g = array_to_string(r.g[1:s.l], ' ')
  WHERE r.i + s.l - 1 <= r.n),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontamination", DECONTAMINATION_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


NGRAM_JOIN_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {TOKENS} AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
run AS (
  SELECT doc_id, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g, i FROM tok),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g FROM run WHERE len(g) = 3 OR i = 1),
sized AS MATERIALIZED (
  SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
pair AS MATERIALIZED (
  SELECT x, y FROM common JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
twoway AS MATERIALIZED (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, twoway.y FROM reach r JOIN twoway ON r.other = twoway.x)
SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM reach JOIN sized USING (doc_id) GROUP BY doc_id, n
"""


@query("op2_ngram_join", NGRAM_JOIN_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_query(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_chat_formatting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op7_url_filter", host_trust.judge_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_trust.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_near_vectors")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_licence_scan", licences.scan_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op10_katz_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_query(table(spark, sf_dir, "documents"))


REPEATS_SQL = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS g
  FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS i FROM d WHERE length(h) >= 100)),
low AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g),
hit AS (SELECT doc_id, i FROM win JOIN low USING (g) WHERE least < doc_id),
mark AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS lead FROM hit),
run AS (
  SELECT doc_id, min(i) AS s, max(i) + 49 AS e
  FROM (SELECT *, sum(lead) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM mark) GROUP BY doc_id, k),
cut AS (
  SELECT doc_id, s, e, substr(h, 2 * e + 1, 2 * (coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s), length(h) // 2 + 1) - e - 1)) AS rest
  FROM run JOIN d USING (doc_id)),
gone AS (
  SELECT doc_id, min(s) AS s, count(*) AS n_spans, sum(e - s + 1) AS n_removed, string_agg(rest, '' ORDER BY s) AS rest
  FROM cut GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans > 0 THEN substr(h, 1, 2 * (s - 1)) || rest ELSE h END)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


@query("op11_repeats", REPEATS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))[0]


SPELLING_SQL = rf"""
WITH RECURSIVE bits(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
run AS (
  SELECT doc_id, unnest(regexp_extract_all({FOLD}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
seen AS (SELECT doc_id, r, count(*) AS n FROM run GROUP BY ALL),
hashed AS (
  SELECT r, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
             string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                       ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))),
           lambda h, x: xor(h >> 8, t[CAST(xor(h, x) & 255 AS INTEGER) + 1])), 4294967295) AS h
  FROM seen, crc),
made AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, CAST(h % length(r) AS INTEGER)) || substr(r, CAST(h % length(r) AS INTEGER) + 2)
              ELSE r END AS word, n FROM hashed),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gap AS MATERIALIZED (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS g
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM w)),
pair AS (
  SELECT a.word AS x, b.word AS y FROM gap a JOIN gap b ON a.p = b.p AND a.g = b.g AND a.word <> b.word
  UNION SELECT gap.word, w.word FROM gap JOIN w ON gap.g = w.word
  UNION SELECT w.word, gap.word FROM gap JOIN w ON gap.g = w.word),
near AS MATERIALIZED (
  SELECT x, count(*) AS n_near, max(w.n) AS most,
         min(struct_pack(less := -w.n, code := encode(y), word := y)).word AS best
  FROM pair JOIN w ON w.word = y GROUP BY x),
step AS MATERIALIZED (SELECT x AS word, best AS form, most AS form_n FROM near JOIN w ON w.word = x WHERE most >= 2 * n),
walk(word, root) AS (
  SELECT word, form FROM step UNION ALL SELECT walk.word, form FROM walk JOIN step ON walk.root = step.word),
ends AS (SELECT word, root FROM walk WHERE root NOT IN (SELECT word FROM step))
SELECT w.word, form, coalesce(root, w.word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM w LEFT JOIN near ON near.x = w.word LEFT JOIN step ON step.word = w.word LEFT JOIN ends ON ends.word = w.word
"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
