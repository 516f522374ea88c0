"""Registered queries: worker registry, retention, entitlements, ingest parsing."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetlens.functions.clock import since
from fleetlens.operators import registry
from fleetlens.params import RETENTION_DAYS, ROLE_PERMISSIONS
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import readers, telemetry

PERMISSION_SQL = "VALUES " + ", ".join(f"('{r}', '{p}')" for r, ps in ROLE_PERMISSIONS.items() for p in ps)
ROLES = f"granted(role, permission) AS ({PERMISSION_SQL})"


@query(
    "registry_sync",
    f"""WITH {t.WORKERS}, live AS (
  SELECT 'worker-' || user_id AS worker_id, max(substr(md5(CAST(event_id AS VARCHAR)), 1, 12)) AS cid FROM events
  WHERE ts >= {t.AS_OF} - INTERVAL 6 HOUR GROUP BY 1
  UNION ALL SELECT 'spare-' || event_type, max(substr(md5(CAST(event_id AS VARCHAR)), 1, 12)) FROM events
  WHERE ts >= {t.AS_OF} - INTERVAL 6 HOUR GROUP BY 1)
SELECT worker_id, CASE WHEN l.cid IS NOT NULL THEN l.cid ELSE container_id END AS container_id,
  coalesce(registered_at, {t.AS_OF}) AS registered_at,
  CASE WHEN l.cid IS NOT NULL THEN {t.AS_OF} ELSE last_heartbeat END AS last_heartbeat,
  CASE WHEN l.cid IS NOT NULL THEN 'active' WHEN status = 'active' THEN 'terminated' ELSE status END AS status
FROM workers w FULL OUTER JOIN live l USING (worker_id)""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    e = telemetry.events(spark, sf)
    recent = e.filter(since(e, "ts", now, hours=6))
    cid = F.substring(F.md5(F.col("event_id").cast("string")), 1, 12).alias("container_id")
    names = F.array(
        F.concat(F.lit("fleet-worker_"), F.col("user_id").cast("string")),
        F.concat(F.lit("fleet-spare_"), F.col("event_type")),
    )
    snapshot = recent.select(F.explode(names).alias("name"), cid)
    return registry.sync_registry(t.workers(spark, sf, now), snapshot, now, prefix="fleet-")


def _later(spark, sf) -> datetime:
    """A fortnight on, so that every policy removes a part of the month's rows."""
    return t.as_of(spark, sf) + timedelta(days=14)


@query(
    "retention_report",
    f"""WITH {t.ALERTS}, {t.predictions_sql(False)}, later AS (SELECT {t.AS_OF} + INTERVAL 14 DAY AS n)
SELECT 'metrics' AS table_name, count(*) FILTER ("timestamp" >= n - INTERVAL 30 DAY) AS kept,
  count(*) FILTER ("timestamp" < n - INTERVAL 30 DAY) AS removed FROM metrics, later
UNION ALL SELECT 'anomalies', count(*) FILTER (detected_at >= n - INTERVAL 90 DAY), count(*) FILTER (detected_at < n - INTERVAL 90 DAY)
  FROM anomalies, later
UNION ALL SELECT 'alerts', count(*) FILTER (raised_at >= n - INTERVAL 20 DAY OR NOT resolved),
  count(*) FILTER (NOT (raised_at >= n - INTERVAL 20 DAY OR NOT resolved)) FROM alerts, later
UNION ALL SELECT 'predictions', count(*) FILTER (predicted_at >= n - INTERVAL 7 DAY), count(*) FILTER (predicted_at < n - INTERVAL 7 DAY)
  FROM predictions, later""",
)
def _(spark, sf):
    tables = {
        "metrics": telemetry.metrics(spark, sf),
        "anomalies": t.anomalies(spark, sf),
        "alerts": t.alerts(spark, sf, t.as_of(spark, sf)),
        "predictions": t.predictions(spark, sf),
    }
    return registry.retention_report(tables, _later(spark, sf), RETENTION_DAYS | {"alerts": 20})


@query(
    "metrics_retained",
    f"""WITH {t.METRICS} SELECT * FROM metrics WHERE "timestamp" >= {t.AS_OF} + INTERVAL 14 DAY - INTERVAL 30 DAY""",
)
def _(spark, sf):
    return registry.retained(telemetry.metrics(spark, sf), "metrics", _later(spark, sf))


@query(
    "alerts_retained",
    f"""WITH {t.ALERTS} SELECT * FROM alerts WHERE raised_at >= {t.AS_OF} + INTERVAL 14 DAY - INTERVAL 20 DAY OR NOT resolved""",
)
def _(spark, sf):
    alerts = t.alerts(spark, sf, t.as_of(spark, sf))
    return registry.retained(alerts, "alerts", _later(spark, sf), {"alerts": 20})


def _users(spark, sf):
    """Each user's roles: that of the request log, a second one, and an unknown one."""
    r = telemetry.requests(spark, sf)
    second = F.when(F.col("key") % 3 == 0, "service").when(F.col("key") % 3 == 1, "auditor").otherwise("viewer")
    return r.select(F.col("key").alias("user_id"), F.array("role", second).alias("roles"))


USERS = t.REQUESTS + """, users AS (SELECT key AS user_id, id, endpoint, [role, CASE WHEN key % 3 = 0 THEN 'service'
  WHEN key % 3 = 1 THEN 'auditor' ELSE 'viewer' END] AS roles FROM requests)"""
ENTITLED = f"""{USERS}, {ROLES}, entitled AS (SELECT DISTINCT user_id, permission FROM
  (SELECT DISTINCT user_id, unnest(roles) AS role FROM users) JOIN granted USING (role))"""


@query("user_permissions", f"WITH {ENTITLED} SELECT * FROM entitled")
def _(spark, sf):
    return registry.user_permissions(_users(spark, sf), registry.role_table(spark))


REQUIRED = """CASE endpoint WHEN 'view' THEN ['metrics:read'] WHEN 'click' THEN ['scaling:read', 'scaling:write']
  WHEN 'purchase' THEN ['config:admin', 'predictions:write'] ELSE ['user:write'] END"""


def _requests_with_needs(spark, sf):
    r = telemetry.requests(spark, sf)
    second = F.when(F.col("key") % 3 == 0, "service").when(F.col("key") % 3 == 1, "auditor").otherwise("viewer")
    lits = lambda *names: F.array(*[F.lit(n) for n in names])
    needs = (
        F.when(F.col("endpoint") == "view", lits("metrics:read"))
        .when(F.col("endpoint") == "click", lits("scaling:read", "scaling:write"))
        .when(F.col("endpoint") == "purchase", lits("config:admin", "predictions:write"))
        .otherwise(lits("user:write"))
    )
    return r.select("id", F.col("key").alias("user_id"), F.array("role", second).alias("roles"), needs.alias("required"))


@query(
    "access_audit",
    f"""WITH {USERS}, {ROLES}, need AS (SELECT id, user_id, roles, {REQUIRED} AS required FROM users), judged AS (
  SELECT roles, required, list(DISTINCT permission) FILTER (permission IS NOT NULL) AS granted FROM
    (SELECT DISTINCT roles, required, unnest(roles) AS role FROM need) d LEFT JOIN granted g ON g.role = d.role GROUP BY roles, required)
SELECT id, user_id, n.roles, n.required, coalesce(list_has_any(granted, n.required), false) AS has_any,
  coalesce(list_has_all(granted, n.required), false) AS has_all
FROM need n JOIN judged j ON j.roles = n.roles AND j.required = n.required""",
)
def _(spark, sf):
    return registry.access_audit(_requests_with_needs(spark, sf))


def _needed(spark, sf):
    return _requests_with_needs(spark, sf).select("id", "user_id", F.col("required")[0].alias("permission"))


NEEDED = f"{ENTITLED}, needed AS (SELECT id, user_id, ({REQUIRED})[1] AS permission FROM users)"


@query("granted_requests", f"WITH {NEEDED} SELECT * FROM needed SEMI JOIN entitled USING (user_id, permission)")
def _(spark, sf):
    owned = registry.user_permissions(_users(spark, sf), registry.role_table(spark))
    return registry.granted_requests(_needed(spark, sf), owned)


@query("denied_requests", f"WITH {NEEDED} SELECT * FROM needed ANTI JOIN entitled USING (user_id, permission)")
def _(spark, sf):
    owned = registry.user_permissions(_users(spark, sf), registry.role_table(spark))
    return registry.denied_requests(_needed(spark, sf), owned)


@query(
    "role_summary_in_use",
    f"""WITH {t.REQUESTS}, {ROLES}, s AS (SELECT role, list_sort(list(DISTINCT permission)) AS permissions,
    count(DISTINCT permission) AS permission_count FROM granted GROUP BY role), used AS (
  SELECT role, count(*) AS requests FROM requests GROUP BY role)
SELECT s.role, permissions, permission_count, CASE s.role WHEN 'admin' THEN 'Full system access'
  WHEN 'operator' THEN 'Manage scaling and workloads' WHEN 'viewer' THEN 'Read-only monitoring access'
  WHEN 'service' THEN 'Service-to-service authentication' ELSE 'Limited public read access' END AS description, requests
FROM s JOIN used USING (role)""",
)
def _(spark, sf):
    used = telemetry.requests(spark, sf).groupBy("role").agg(F.count("*").alias("requests"))
    return registry.role_summary(registry.role_table(spark)).join(used, "role")


# --- ingest parsing over the whole event table ---------------------------------------

M_OUT = 'node_id, "timestamp", cpu_usage, memory_usage, latency_ms, requests_per_sec, disk_usage'


def damaged_entries(metrics):
    """Stream entries of metric rows; two in ten lack a field or hold no number."""
    coded = readers.encode_entries(metrics, keep=["id"])
    without = lambda name: F.map_filter("entry", lambda k, v: k != F.lit(name))
    broken = F.map_concat(without("cpu_usage"), F.create_map(F.lit("cpu_usage"), F.lit("n/a")))
    kind = F.col("id") % 10
    entry = F.when(kind == 0, without("latency_ms")).when(kind == 1, broken).otherwise(F.col("entry"))
    return coded.select("id", entry.alias("entry"))


def _entries(spark, sf):
    return damaged_entries(telemetry.metrics(spark, sf))


@query("entries_parsed", f"WITH {t.METRICS} SELECT {M_OUT} FROM metrics WHERE id % 10 > 1")
def _(spark, sf):
    good, _rejected = readers.parse_entries(_entries(spark, sf))
    return good.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("entries_rejected", "SELECT event_id AS id FROM events WHERE event_id % 10 <= 1")
def _(spark, sf):
    _good, rejected = readers.parse_entries(_entries(spark, sf))
    return rejected.select("id")


@query(
    "requests_normalised",
    f"""WITH {t.METRICS} SELECT CASE WHEN id % 4 = 0 THEN 'api-client' ELSE node_id END AS node_id, "timestamp", cpu_usage,
  memory_usage, latency_ms, requests_per_sec, CASE WHEN id % 3 = 0 THEN 0.0 ELSE disk_usage END AS disk_usage
FROM metrics WHERE id % 11 > 0""",
)
def _(spark, sf):
    """JSON bodies that mix long and short field names, with fields left out."""
    m = telemetry.metrics(spark, sf)
    eid = F.col("id")
    body = F.to_json(
        F.struct(
            F.when(eid % 4 != 0, F.col("node_id")).alias("node_id"),
            F.when(eid % 2 == 0, F.col("cpu_usage")).alias("cpu_usage"),
            F.when(eid % 2 == 1, F.col("cpu_usage")).alias("cpu"),
            F.when(eid % 11 > 0, F.col("memory_usage")).alias("memory"),
            F.col("latency_ms").alias("latency"),
            F.col("requests_per_sec").alias("rps"),
            F.when(eid % 3 != 0, F.col("disk_usage")).alias("disk"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    out = readers.parse_json_requests(m.select(body.alias("body")), "body", datetime(2024, 2, 1))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "bulk_requests_exploded",
    f"""WITH {t.METRICS} SELECT {M_OUT} FROM metrics WHERE id // 25 % 6 > 0""",
)
def _(spark, sf):
    """Bulk bodies of 25 metrics; each sixth body is empty and is refused whole."""
    m = telemetry.metrics(spark, sf)
    one = F.struct(
        "node_id", F.col("cpu_usage").alias("cpu"), "memory_usage", "latency_ms", F.col("requests_per_sec").alias("rps"),
        "disk_usage", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    bodies = m.groupBy(F.floor(F.col("id") / 25).alias("body_id")).agg(F.collect_list(one).alias("metrics"))
    empty = F.filter("metrics", lambda x: F.lit(False))
    bodies = bodies.withColumn("metrics", F.when(F.col("body_id") % 6 == 0, empty).otherwise(F.col("metrics")))
    body = bodies.select(F.to_json(F.struct("metrics")).alias("body"))
    rows, _refused = readers.explode_bulk(body, "body", datetime(2024, 2, 1))
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
