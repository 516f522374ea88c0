"""Registered queries: admission limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators import admission
from fleetlens.params import ROLE_RATES
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

# Rates that deny a part of this sparse log: requests per second and role.
SLOW_RATES = {"admin": 1 / 20_000, "operator": 1 / 40_000, "viewer": 1 / 60_000, "service": 1 / 50_000, "guest": 1 / 90_000}
BURST = 2.0
WINDOW = 86_400
WINDOW_RATES = {"admin": 3 / WINDOW, "operator": 2 / WINDOW, "viewer": 1 / WINDOW, "service": 2 / WINDOW, "guest": 1 / WINDOW}

RATE_SQL = """CASE role WHEN 'admin' THEN 1/20000.0::DOUBLE WHEN 'operator' THEN 1/40000.0::DOUBLE WHEN 'viewer' THEN 1/60000.0::DOUBLE
  WHEN 'service' THEN 1/50000.0::DOUBLE WHEN 'guest' THEN 1/90000.0::DOUBLE ELSE 10.0 END"""
LIMIT_SQL = "CASE role WHEN 'admin' THEN 3 WHEN 'operator' THEN 2 WHEN 'viewer' THEN 1 WHEN 'service' THEN 2 WHEN 'guest' THEN 1 ELSE 864000 END"

BUCKET_SQL = f"""log AS (SELECT *, epoch_us(ts) / 1e6 AS at_s, row_number() OVER (PARTITION BY key ORDER BY ts, id) AS rn FROM requests),
firsts AS (SELECT key, {RATE_SQL} AS refill FROM log WHERE rn = 1), bucket AS (
  SELECT l.key, l.id, l.role, l.rn, l.at_s, refill, true AS allowed, {BURST}::DOUBLE - 1 AS tokens FROM log l JOIN firsts USING (key) WHERE rn = 1
  UNION ALL
  SELECT key, id, role, rn, at_s, refill, level >= 1 AS allowed, CASE WHEN level >= 1 THEN level - 1 ELSE level END FROM (
    SELECT n.key, n.id, n.role, n.rn, n.at_s, b.refill, least({BURST}::DOUBLE, b.tokens + (n.at_s - b.at_s) * b.refill) AS level
    FROM bucket b JOIN log n ON n.key = b.key AND n.rn = b.rn + 1))"""


def _bucket(spark, sf):
    return admission.token_bucket(telemetry.requests(spark, sf), BURST, SLOW_RATES)


@query(
    "token_bucket",
    f"""WITH RECURSIVE {t.REQUESTS}, {BUCKET_SQL} SELECT key, id, role, round(refill, 9) AS "limit", allowed,
  CAST(trunc(tokens) AS BIGINT) AS remaining, round(CASE WHEN tokens >= 1 THEN 0.0 ELSE (1 - tokens) / refill END, 3) AS reset_after
FROM bucket""",
)
def _(spark, sf):
    out = _bucket(spark, sf)
    return out.select(
        "key", "id", "role", F.round("limit", 9).alias("limit"), "allowed", "remaining",
        F.round("reset_after", 3).alias("reset_after"),
    )


@query(
    "token_bucket_denied_by_role",
    f"""WITH RECURSIVE {t.REQUESTS}, {BUCKET_SQL} SELECT role, count(*) AS requests, count(*) FILTER (NOT allowed) AS denied
FROM bucket GROUP BY role""",
)
def _(spark, sf):
    return admission.denied_by_role(_bucket(spark, sf))


SLIDING_SQL = f"""log AS (SELECT *, epoch_us(ts) / 1e6 AS at_s, {LIMIT_SQL} AS lim,
    row_number() OVER (PARTITION BY key ORDER BY ts, id) AS rn FROM requests), sliding AS (
  SELECT key, id, role, rn, at_s, lim, true AS allowed, [at_s] AS held FROM log WHERE rn = 1
  UNION ALL
  SELECT key, id, role, rn, at_s, lim, len(live) < lim, CASE WHEN len(live) < lim THEN list_append(live, at_s) ELSE live END FROM (
    SELECT n.key, n.id, n.role, n.rn, n.at_s, n.lim, list_filter(s.held, lambda x: x > n.at_s - {WINDOW}) AS live
    FROM sliding s JOIN log n ON n.key = s.key AND n.rn = s.rn + 1))"""


def _sliding(spark, sf):
    return admission.sliding_window(telemetry.requests(spark, sf), WINDOW, WINDOW_RATES)


@query(
    "sliding_window",
    f"""WITH RECURSIVE {t.REQUESTS}, {SLIDING_SQL} SELECT key, id, role, lim::BIGINT AS "limit", allowed,
  greatest(0, lim - len(held))::BIGINT AS remaining,
  round(CASE WHEN len(held) = 0 THEN 0.0 ELSE greatest(0.0, held[1] + {WINDOW} - at_s) END, 3) AS reset_after FROM sliding""",
)
def _(spark, sf):
    out = _sliding(spark, sf)
    return out.select(
        "key", "id", "role", "limit", "allowed", "remaining", F.round("reset_after", 3).alias("reset_after")
    )


FIXED_SQL = f"""ranked AS (SELECT *, {LIMIT_SQL}::BIGINT AS lim, time_bucket(INTERVAL '1 day', ts) AS window_start,
    row_number() OVER (PARTITION BY key, time_bucket(INTERVAL '1 day', ts) ORDER BY ts, id) AS rnk FROM requests)"""


def _fixed(spark, sf):
    return admission.fixed_window(telemetry.requests(spark, sf), WINDOW, WINDOW_RATES)


@query(
    "fixed_window",
    f"""WITH {t.REQUESTS}, {FIXED_SQL} SELECT key, id, window_start, lim AS "limit", rnk <= lim AS allowed,
  greatest(0, lim - rnk)::BIGINT AS remaining,
  round(epoch_us(window_start) / 1e6 + {WINDOW} - epoch_us(ts) / 1e6, 3) AS reset_after FROM ranked""",
)
def _(spark, sf):
    out = _fixed(spark, sf)
    return out.select(
        "key", "id", "window_start", "limit", "allowed", "remaining", F.round("reset_after", 3).alias("reset_after")
    )


@query(
    "limiter_stats",
    f"""WITH RECURSIVE {t.REQUESTS}, {SLIDING_SQL}, {FIXED_SQL}
SELECT 'sliding_window' AS strategy, count(DISTINCT key) AS tracked_keys, count(*) FILTER (allowed) AS allowed,
  count(*) FILTER (NOT allowed) AS denied FROM sliding
UNION ALL SELECT 'fixed_window', count(DISTINCT key), count(*) FILTER (rnk <= lim), count(*) FILTER (rnk > lim) FROM ranked""",
)
def _(spark, sf):
    return admission.limiter_stats(_sliding(spark, sf), "sliding_window").unionByName(
        admission.limiter_stats(_fixed(spark, sf), "fixed_window")
    )


@query(
    "role_limits",
    f"""WITH {t.REQUESTS} SELECT id, CASE WHEN id % 7 = 0 THEN 'contractor' ELSE role END AS role,
  CASE WHEN id % 7 = 0 THEN 10.0::DOUBLE ELSE CASE role WHEN 'admin' THEN 10000.0 WHEN 'operator' THEN 5000.0
    WHEN 'viewer' THEN 1000.0 WHEN 'service' THEN 5000.0 ELSE 3000.0 END::DOUBLE END AS rate FROM requests""",
)
def _(spark, sf):
    r = telemetry.requests(spark, sf)
    named = r.withColumn("role", F.when(F.col("id") % 7 == 0, "contractor").otherwise(F.col("role")))
    rates = spark.createDataFrame(list(ROLE_RATES.items()), "role string, rate double")
    return admission.with_role_rate(named, rates).select("id", "role", "rate")


@query(
    "idle_limiter_keys",
    f"""WITH {t.REQUESTS} SELECT key, round(epoch_us(max(ts)) / 1e6, 3) AS last_seen FROM requests GROUP BY key
HAVING epoch_us({t.AS_OF}) / 1e6 - epoch_us(max(ts)) / 1e6 > 3600""",
)
def _(spark, sf):
    from fleetlens.functions.clock import epoch

    r = telemetry.requests(spark, sf)
    now = r.agg(F.max(epoch("ts"))).first()[0]
    return rounded(admission.idle_keys(r, now), 3)


@query(
    "limiter_lives_after_reset",
    f"""WITH {t.REQUESTS}, resets AS (SELECT key, ts FROM requests WHERE endpoint = 'signup' AND id % 20 = 3)
SELECT r.key, r.id, (SELECT count(*) FROM resets s WHERE s.key = r.key AND s.ts <= r.ts) AS life FROM requests r""",
)
def _(spark, sf):
    r = telemetry.requests(spark, sf)
    resets = r.filter((F.col("endpoint") == "signup") & (F.col("id") % 20 == 3)).select("key", "ts")
    return admission.reset_keys(r, resets).select("key", "id", "life")
