"""URL filter: rules first, link-graph propagation for the rest.

Hosts get trust by personalised PageRank from the hosts of urls that an allow rule fits, along host edges,
and distrust in the same way from the hosts of blocked urls, along reversed edges: who links to a bad host
is doubtful. Edges are links between hosts, taken from absolute ``href``s and weighted by the number of
pages, and ties between a host and its parent domain (both directions, weight 1). A host whose distrust
exceeds ``THRESHOLD`` times its trust is blocked; a host that neither reaches is allowed.

Edges and ranks are aggregated before they are shuffled; edges of a source with very many targets are
dealt into ``SALTS`` parts by target, and its rank is copied to each part.

Nulls, ties and odd rows: a null url, or one without ``://``, has empty host and path, fits no rule and
takes no part in the graph, so it is allowed; of rules of equal length that fit, the first by text wins;
a null html has no links; repeated rows count each time; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.store import keep, shared_folder

#: (verdict, host and path); fixed by the query's contract.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
DAMPING, ROUNDS, THRESHOLD = 0.85, 12, 1.0
SALTS, CUT = 8, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    # what follows the first "://"
    rest = F.when(
        F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))
    )
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def best_rule(rules: list[tuple[str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits columns host and path, else null."""
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in reversed(ranked):
        name, _, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between hosts; pages has host and html."""
    target = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)href\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"), 1))
    links = (
        pages.where("host <> ''")
        .select(F.col("host").alias("src"), target.alias("dst"))
        .withColumn("dst", F.translate("dst", UPPER, LOWER))
        .where("dst <> src")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    hosts = pages.select("host").union(links.select("dst")).where("host <> ''").distinct()
    parent = F.expr("substring(host, instr(host, '.') + 1)")
    up = hosts.where("length(host) - length(replace(host, '.', '')) >= 2").select(
        F.col("host").alias("src"), parent.alias("dst")
    )
    ties = up.union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1.0))
    return links.union(ties).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, rank) after ``rounds`` steps; seeds (kind, host, mass) add up to 1 a kind,
    edges (kind, src, dst, weight)."""
    shared_folder(seeds.sparkSession)
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    steps = keep(
        edges.join(out, ["kind", "src"])
        .withColumn("salt", F.pmod(F.xxhash64("dst"), F.lit(SALTS)))
        .select("kind", "src", "salt", "dst", (F.col("weight") / F.col("total")).alias("share")),
        "host_edges",
    )
    base = seeds.select("kind", "host", (F.col("mass") * (1 - DAMPING)).alias("rank"))
    rank = seeds.select("kind", "host", F.col("mass").alias("rank"))
    for k in range(rounds):
        spread = rank.select(
            "kind", F.col("host").alias("src"), "rank", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        ).withColumn("salt", F.col("salt").cast("long"))
        moved = spread.join(steps, ["kind", "src", "salt"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * DAMPING).alias("rank")
        )
        rank = moved.union(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % CUT == CUT - 1:
            rank = rank.checkpoint()
    return rank


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust and distrust of its host."""
    host, path = split_url(F.col("url"))
    pages = pages.select("page_id", "url", "html", host.alias("host"), path.alias("path"))
    pages = pages.withColumn("found", best_rule(rules))
    counts = pages.where("found is not null and host <> ''").groupBy("found.verdict", "host").agg(F.count("*").alias("n"))
    sums = counts.groupBy("verdict").agg(F.sum("n").alias("total"))
    seeds = keep(
        counts.join(sums, "verdict").select(
            F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"),
            "host",
            (F.col("n") / F.col("total")).alias("mass"),
        ),
        "seeds",
    )
    edges = keep(host_edges(pages.select("host", "html")), "edges")
    ways = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    ranks = propagate(seeds, ways)
    hosts = keep(
        ranks.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
        ),
        "hosts",
    )
    judged = pages.drop("html", "url").join(hosts, "host", "left")
    own = F.when(F.col("distrust") > F.col("trust") * THRESHOLD, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def judge_sql() -> str:
    """The same judgement in DuckDB SQL, its rounds written out."""
    ranked = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    cases = []
    for verdict, rule in ranked:
        name, _, rest = rule.partition("/")
        cases.append((verdict, rule, f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"))
    rule_case = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for _, r, c in cases) + " END"
    verdict_case = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for v, _, c in cases) + " END"
    fold = f"'{UPPER}', '{LOWER}'"
    rounds = reduce(
        lambda sql, k: sql
        + f""",
r{k + 1} AS MATERIALIZED (
  SELECT kind, host, sum(rank) AS rank FROM (
    SELECT s.kind, s.dst AS host, r.rank * s.share * {DAMPING} AS rank FROM r{k} r JOIN step s ON r.kind = s.kind AND r.host = s.src
    UNION ALL SELECT kind, host, mass * {1 - DAMPING} FROM seed) GROUP BY ALL)""",
        range(ROUNDS),
        "",
    )
    return rf"""
WITH cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
page AS MATERIALIZED (
  SELECT page_id, html, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {fold}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS MATERIALIZED (SELECT page_id, host, path, {rule_case} AS rule, {verdict_case} AS verdict FROM page),
n AS (SELECT verdict, host, count(*) AS n FROM ruled WHERE rule IS NOT NULL GROUP BY ALL),
seed AS MATERIALIZED (
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host,
         n / sum(n) OVER (PARTITION BY verdict) AS mass FROM n),
link AS MATERIALIZED (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1)), {fold}) AS dst
    FROM page WHERE host <> '') WHERE src <> dst GROUP BY ALL),
host AS (SELECT host FROM page WHERE host <> '' UNION SELECT dst FROM link),
up AS (SELECT host AS src, substr(host, instr(host, '.') + 1) AS dst FROM host WHERE length(host) - length(replace(host, '.', '')) >= 2),
edge AS MATERIALIZED (
  SELECT src, dst, sum(weight) AS weight FROM (
    SELECT * FROM link UNION ALL SELECT src, dst, 1 FROM up UNION ALL SELECT dst, src, 1 FROM up) GROUP BY ALL),
way AS (SELECT 'trust' AS kind, src, dst, weight FROM edge UNION ALL SELECT 'distrust', dst, src, weight FROM edge),
step AS MATERIALIZED (SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) AS share FROM way),
r0 AS (SELECT kind, host, mass AS rank FROM seed){rounds},
score AS (
  SELECT host, sum(CASE kind WHEN 'trust' THEN rank ELSE 0 END) AS trust,
         sum(CASE kind WHEN 'trust' THEN 0 ELSE rank END) AS distrust FROM r{ROUNDS} GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN distrust > trust * {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN score USING (host)
"""
