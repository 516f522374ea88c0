"""Registered queries: tables, files and documents that are written and read back, refusals, production alert rules."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch_us, instant
from fleetlens.functions.present import rounded
from fleetlens.functions.quantiles import exact_percentiles
from fleetlens.operators import admission, counters, summaries
from fleetlens.plans import admission_queries as adm
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.session import checkpoint_dir, ensure_utc
from fleetlens.sources import readers, telemetry, writers


def _room(spark: SparkSession) -> str:
    ensure_utc(spark)
    return f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"


@query(
    "predictions_stored",
    f"""WITH {t.PREDICTIONS} SELECT predicted_at, horizon_minutes, predicted_rps, lower_bound, upper_bound, confidence, model_name
FROM predictions""",
)
def _(spark, sf):
    """Forecasts appended in two parts, read back as one table."""
    made, path = t.predictions(spark, sf), _room(spark)
    odd = F.hour("predicted_at") % 2 == 1
    for part in (made.where(odd), made.where(~odd)):
        writers.write_predictions(part, path)
    columns = ["predicted_at", "horizon_minutes", "predicted_rps", "lower_bound", "upper_bound", "confidence", "model_name"]
    return spark.read.parquet(path).select(*columns)


@query(
    "scaling_events_stored",
    f"""WITH RECURSIVE {t.OBSERVED_SCALING} SELECT node_id, triggered_at, action, prev_replicas, new_replicas, reason FROM scaling_events
UNION ALL SELECT NULL, {t.AS_OF}, 'manual_scale', (SELECT count(*) FILTER (status = 'active')::INT FROM (
  WITH {t.WORKERS} SELECT * FROM workers)), 3, 'manual request by operator-2'""",
)
def _(spark, sf):
    """Decisions and one manual request, appended to the same table."""
    path, now = _room(spark), t.as_of(spark, sf)
    events = t.scaling_events(spark, sf, observed=True)
    writers.write_scaling_events(events, path)
    manual = writers.manual_scale_event(t.workers(spark, sf, now), 3, "operator-2", now)
    manual = manual.withColumn("triggered_at", F.col("triggered_at").cast(events.schema["triggered_at"].dataType))
    writers.write_scaling_events(manual.withColumn("node_id", F.lit(None).cast("string")).select(*events.columns), path)
    return spark.read.parquet(path).select(*events.columns)


@query(
    "load_history_read",
    f"""WITH {t.REQUESTS} SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) // 1000000 AS "Timestamp", endpoint AS "Name",
  count(DISTINCT key)::INT AS "User Count", round(count(*) / 3600.0, 6) AS "Requests/s" FROM requests GROUP BY ALL""",
)
def _(spark, sf):
    """An hourly load history as a CSV file with more columns than are read, found by their names."""
    r = telemetry.requests(spark, sf)
    hours = r.groupBy(F.window("ts", "1 hour").alias("_w"), "endpoint").agg(
        F.count_distinct("key").cast("int").alias("User Count"), F.round(F.count("*") / 3600.0, 6).alias("Requests/s")
    )
    rows = hours.select(
        F.lit("GET").alias("Type"),
        F.col("Requests/s"),
        F.col("endpoint").alias("Name"),
        F.col("User Count"),
        F.unix_seconds(F.col("_w.start").cast("timestamp")).alias("Timestamp"),
    )
    path = _room(spark)
    rows.write.csv(path, header=True)
    return readers.read_load_history(spark, path)


@query(
    "results_regressed",
    f"""WITH {t.REQUESTS}, split AS (SELECT endpoint AS test_name, ts >= {t.AS_OF} - INTERVAL 15 DAY AS recent,
    quantile_cont(duration_s, 0.99) AS p99_ms FROM requests GROUP BY ALL)
SELECT c.test_name, round(c.p99_ms, 6) AS "current", round(b.p99_ms, 6) AS baseline, c.p99_ms > b.p99_ms * 1.05 AS regressed
FROM split c JOIN split b ON c.test_name = b.test_name AND c.recent AND NOT b.recent""",
)
def _(spark, sf):
    """Results of two runs saved as documents with their metadata, then compared as read back."""
    r, now = telemetry.requests(spark, sf), t.as_of(spark, sf)
    recent = F.col("ts") >= instant(r, "ts", now - timedelta(days=15))
    room = _room(spark)
    for name, rows, at in (("current", r.filter(recent), now), ("baseline", r.filter(~recent), now - timedelta(days=15))):
        p99 = exact_percentiles(rows.withColumnRenamed("endpoint", "test_name"), ["test_name"], "duration_s", {"p99_ms": 0.99})
        writers.save_result(p99, f"{room}/{name}", f"latency_{name}", at)
    read = lambda name: spark.read.json(f"{room}/{name}").where(F.col("_metadata.test_name") == f"latency_{name}")
    return rounded(summaries.regressions(read("current"), read("baseline"), factor=1.05))


@query(
    "requests_refused",
    """SELECT event_id AS id, CASE WHEN event_id % 13 = 0 THEN 'not a JSON object' ELSE 'missing or unreadable value' END AS reason
FROM events WHERE event_id % 13 = 0 OR event_id % 11 = 0 OR event_id % 17 = 0""",
)
def _(spark, sf):
    """Single requests: broken bodies, a missing value, a time that does not parse."""
    m, n = telemetry.metrics(spark, sf), F.col("id")
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.to_json(
        F.struct(
            "node_id",
            F.col("cpu_usage").alias("cpu"),
            F.when(n % 11 > 0, F.col("memory_usage")).alias("memory"),
            F.col("latency_ms").alias("latency"),
            F.col("requests_per_sec").alias("rps"),
            F.when(n % 17 == 0, "yesterday").otherwise(time).alias("timestamp"),
        )
    )
    broken = F.when(n % 2 == 0, F.substring(body, 1, 20)).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    bodies = m.select("id", F.when(n % 13 == 0, broken).otherwise(body).alias("body"))
    _rows, refused = readers.split_json_requests(bodies, "body", datetime(2024, 2, 1))
    return refused.select("id", "reason")


KEPT_DAYS = {"metrics": 10, "alerts": 5}


@query(
    "retention_applied",
    f"""WITH {t.ALERTS}, cut AS (
  SELECT 'metrics' AS table_name, CAST("timestamp" AS DATE) AS d, "timestamp" >= {t.AS_OF} - INTERVAL 10 DAY AS keep,
    CAST({t.AS_OF} - INTERVAL 10 DAY AS DATE) AS edge FROM metrics
  UNION ALL SELECT 'alerts', CAST(raised_at AS DATE), raised_at >= {t.AS_OF} - INTERVAL 5 DAY OR NOT resolved,
    CAST({t.AS_OF} - INTERVAL 5 DAY AS DATE) FROM alerts), per AS (
  SELECT table_name, d, edge, count(*) FILTER (NOT keep) AS removed, count(*) FILTER (keep) AS kept FROM cut GROUP BY ALL)
SELECT table_name, strftime(d, '%Y-%m-%d') AS date, CASE WHEN d < edge AND kept = 0 THEN 'dropped' ELSE 'rewritten' END AS action,
  removed, kept, (SELECT count(*) FROM cut c WHERE c.table_name = per.table_name AND keep) AS rows_left
FROM per WHERE removed > 0""",
)
def _(spark, sf):
    """Retention carried out on stored tables; open alerts of old dates stay."""
    from fleetlens.operators.registry import apply_retention

    now, room, out = t.as_of(spark, sf), _room(spark), None
    alerts = t.alerts(spark, sf, now).withColumn("date", F.to_date("raised_at"))
    writers.write_metrics(telemetry.metrics(spark, sf), f"{room}/metrics")
    alerts.write.partitionBy("date").parquet(f"{room}/alerts")
    for name in ("metrics", "alerts"):
        done = apply_retention(spark, f"{room}/{name}", name, now, KEPT_DAYS)
        left = spark.read.parquet(f"{room}/{name}").count()
        rows = done.select(F.lit(name).alias("table_name"), "date", "action", "removed", "kept", F.lit(left).alias("rows_left"))
        out = rows if out is None else out.unionByName(rows)
    return out


TTL_S = 43_200


@query(
    "token_bucket_idle_ttl",
    f"""WITH RECURSIVE {t.REQUESTS}, {adm.BUCKET_SQL.replace("least(", f"CASE WHEN n.at_s - b.at_s >= {TTL_S} THEN {adm.BURST}::DOUBLE ELSE least(").replace("b.refill) AS level", "b.refill) END AS level")}
SELECT key, id, allowed, CAST(trunc(tokens) AS BIGINT) AS remaining FROM bucket""",
)
def _(spark, sf):
    """Buckets that are idle for twelve hours are forgotten and start full."""
    log = telemetry.requests(spark, sf)
    out = admission.token_bucket(log, adm.BURST, adm.SLOW_RATES, idle_ttl_s=TTL_S)
    return out.select("key", "id", "allowed", "remaining")


# --- the production alert rules -----------------------------------------------------

FAST, MINUTE_S = 60, 60
FAST_SQL = f"""fast AS (SELECT event_id, event_type, value, 'node-' || CAST(user_id % 8 AS VARCHAR) AS node_id,
    make_timestamp((low + (epoch_us(ts) - low) // {FAST}) // 60000000 * 60000000) AS t,
    CAST(event_id * 37 % 100 AS DOUBLE) AS held
  FROM events, (SELECT min(epoch_us(ts)) AS low FROM events))"""


def _spells_sql(source: str, rule: str, condition: str, hold_s: int, key: str) -> str:
    return f"""SELECT '{rule}' AS rule, {key} AS series, min(t) AS active_since, max(t) AS active_until,
  min(t) + INTERVAL {hold_s} SECOND AS firing_at, (epoch_us(max(t)) - epoch_us(min(t))) / 1e6 AS held_seconds
FROM (SELECT *, sum(br) OVER (PARTITION BY {key} ORDER BY t) AS island
  FROM (SELECT *, CASE WHEN NOT is_on OR coalesce(epoch_us(t) - epoch_us(lag(t) OVER (PARTITION BY {key} ORDER BY t)) > {MINUTE_S}000000, false)
      THEN 1 ELSE 0 END AS br
    FROM (SELECT *, coalesce({condition}, false) AS is_on FROM {source}) a) b) c
WHERE is_on GROUP BY {key}, island HAVING epoch_us(max(t)) - epoch_us(min(t)) >= {hold_s}000000"""


def _fast(spark: SparkSession, sf: str) -> DataFrame:
    """The events replayed at sixty times their speed, by the minute."""
    e = telemetry.events(spark, sf)
    low = e.agg(F.min(epoch_us("ts"))).first()[0] or 0
    minute = F.floor((low + F.floor((epoch_us("ts") - low) / FAST)) / 60_000_000) * 60_000_000
    return e.select(
        "event_type",
        "value",
        F.concat(F.lit("node-"), (F.col("user_id") % 8).cast("string")).alias("node_id"),
        F.timestamp_micros(minute.cast("bigint")).cast("timestamp_ntz").alias("t"),
        (F.col("event_id") * 37 % 100).cast("double").alias("held"),
    )


@query(
    "alert_rules_in_production",
    f"""WITH {FAST_SQL},
failed AS (SELECT 'all' AS s, t, count(*) FILTER (event_type = 'error') / count(*) AS v FROM fast GROUP BY t),
slow AS (SELECT event_type AS s, t, quantile_cont(value / 100, 0.95) AS v FROM fast GROUP BY ALL),
held AS (SELECT node_id AS s, t, max(held) AS v FROM fast GROUP BY ALL),
minutes AS (SELECT 'all' AS s, t, sum(held) AS x, count(*) AS n FROM fast GROUP BY t),
growth AS (SELECT s, t, sum(x) OVER a / sum(n) OVER a - sum(x) OVER b / sum(n) OVER b AS v FROM minutes
  WINDOW a AS (ORDER BY t ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), b AS (ORDER BY t ROWS BETWEEN 59 PRECEDING AND 30 PRECEDING))
{_spells_sql('failed', 'HighErrorRate', 'v > 0.05', 120, 's')}
UNION ALL {_spells_sql('slow', 'HighLatency', 'v > 0.5', 300, 's')}
UNION ALL {_spells_sql('held', 'DBConnectionExhaustion', 'v > 40', 60, 's')}
UNION ALL {_spells_sql('growth', 'MemoryLeak', 'v > 0', 900, 's')}""",
)
def _(spark, sf):
    """The four rules with their own thresholds and hold times, evaluated every minute."""
    e = _fast(spark, sf)
    every = e.withColumn("series", F.lit("all"))
    failed = every.groupBy("series", "t").agg((F.count_if(F.col("event_type") == "error") / F.count("*")).alias("v"))
    slow = exact_percentiles(e.withColumns({"series": F.col("event_type"), "_s": F.col("value") / 100}), ["series", "t"], "_s", {"v": 0.95})
    held = e.groupBy(F.col("node_id").alias("series"), "t").agg(F.max("held").alias("v"))
    minutes = every.groupBy("series", "t").agg(F.sum("held").alias("x"), F.count("*").alias("n"))
    order = Window.partitionBy("series").orderBy("t")
    mean = lambda w: F.sum("x").over(w) / F.sum("n").over(w)
    growth = minutes.withColumn("v", mean(order.rowsBetween(-29, 0)) - mean(order.rowsBetween(-59, -30)))
    out = None
    for rule, points in (("HighErrorRate", failed), ("HighLatency", slow), ("DBConnectionExhaustion", held), ("MemoryLeak", growth)):
        spells = counters.alert_rule(points, ["series"], rule, "v", MINUTE_S)
        out = spells if out is None else out.unionByName(spells)
    return out
