"""Registered queries: aggregates, KPIs and reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from fleetlens.functions.clock import instant
from fleetlens.functions.present import rounded
from fleetlens.functions.quantiles import exact_percentiles
from fleetlens.functions.skew import side_by_side
from fleetlens.operators import summaries
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

DAY = f"\"timestamp\" >= {t.AS_OF} - INTERVAL 1440 MINUTE"
SUMMARY = """round(avg(cpu_usage), 6) AS avg_cpu, round(avg(memory_usage), 6) AS avg_mem,
       round(avg(latency_ms), 6) AS avg_latency, round(avg(requests_per_sec), 6) AS avg_rps,
       count(DISTINCT node_id) AS node_count"""


@query("fleet_summary", f"WITH {t.METRICS} SELECT {SUMMARY} FROM metrics WHERE {DAY}")
def _(spark, sf):
    return rounded(summaries.fleet_summary(telemetry.metrics(spark, sf), 1440, t.as_of(spark, sf)))


@query(
    "fleet_summary_without_rows",
    f"WITH {t.METRICS} SELECT {SUMMARY} FROM metrics WHERE \"timestamp\" >= {t.AS_OF} + INTERVAL 1 DAY",
)
def _(spark, sf):
    later = t.as_of(spark, sf) + timedelta(days=1, minutes=5)
    return rounded(summaries.fleet_summary(telemetry.metrics(spark, sf), 5, later))


@query(
    "system_status",
    f"""WITH {t.ANOMALIES}, {t.WORKERS}, {t.predictions_sql(False)}
SELECT 'operational' AS status, (SELECT count(*) FROM workers WHERE status = 'active') AS active_workers,
  (SELECT count(DISTINCT node_id) FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 300 MINUTE) AS nodes_reporting,
  round(coalesce((SELECT max(anomaly_score) FROM anomalies WHERE detected_at >= {t.AS_OF} - INTERVAL 600 MINUTE), 0.0), 3)
    AS latest_anomaly_score,
  round((SELECT predicted_rps FROM predictions ORDER BY predicted_at DESC LIMIT 1), 2) AS predicted_rps,
  {t.AS_OF} AS "timestamp" """,
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return summaries.system_status(
        t.workers(spark, sf, now),
        telemetry.metrics(spark, sf),
        t.anomalies(spark, sf),
        t.predictions(spark, sf),
        now,
        node_minutes=300,
        anomaly_minutes=600,
    )


@query(
    "average_cpu",
    f"""WITH {t.METRICS} SELECT round(coalesce(avg(cpu_usage), 0.0), 6) AS avg_cpu, count(*) > 0 AS has_data
FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 120 MINUTE""",
)
def _(spark, sf):
    return rounded(summaries.average_cpu(telemetry.metrics(spark, sf), 120, t.as_of(spark, sf)))


@query(
    "load_resampled",
    f"""WITH {t.METRICS} SELECT time_bucket(INTERVAL '5 minutes', "timestamp") AS ds,
       round(avg(requests_per_sec), 9) AS y FROM metrics GROUP BY 1""",
)
def _(spark, sf):
    return rounded(summaries.resample_mean(telemetry.metrics(spark, sf), "timestamp", "requests_per_sec"), 9)


@query(
    "load_resampled_by_node",
    f"""WITH {t.METRICS} SELECT node_id, time_bucket(INTERVAL '1 hour', "timestamp") AS ds,
       round(sum(requests_per_sec), 6) AS y FROM metrics GROUP BY 1, 2""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    return rounded(summaries.resample_mean(m, "timestamp", "requests_per_sec", ["node_id"], "1 hour", "sum"))


@query(
    "nodes_with_enough_samples",
    f"WITH {t.METRICS} SELECT node_id, count(*) AS rows FROM metrics WHERE {DAY} GROUP BY 1 HAVING count(*) >= 30",
)
def _(spark, sf):
    return summaries.enough_samples(telemetry.metrics(spark, sf), 1440, 30, t.as_of(spark, sf))


@query(
    "scaling_action_counts",
    f"""WITH RECURSIVE {t.SCALING} SELECT count(*) FILTER (action = 'scale_up') AS scale_up,
  count(*) FILTER (action = 'scale_down') AS scale_down, count(*) FILTER (action = 'no_change') AS no_change
FROM scaling_events""",
)
def _(spark, sf):
    return summaries.action_counts(t.scaling_events(spark, sf))


@query(
    "anomaly_kpis",
    f"""WITH {t.ANOMALIES} SELECT count(*) AS anomalies, count(*) FILTER (anomaly_score >= 0.8) AS critical_scores,
  greatest(coalesce(max(anomaly_score), 0.0), 0.0) AS max_score FROM anomalies""",
)
def _(spark, sf):
    return summaries.anomaly_kpis(t.anomalies(spark, sf))


@query(
    "alert_kpis",
    f"""WITH {t.ALERTS} SELECT count(*) FILTER (severity = 'warning') AS visible,
  count(*) FILTER (NOT resolved) AS unresolved, count(*) FILTER (severity = 'critical') AS critical FROM alerts""",
)
def _(spark, sf):
    return summaries.alert_kpis(t.alerts(spark, sf, t.as_of(spark, sf)), "warning")


@query(
    "worker_kpis",
    f"""WITH {t.WORKERS} SELECT count(*) AS registered, count(*) FILTER (status = 'active') AS active,
  count(*) FILTER (epoch_us({t.AS_OF}) - epoch_us(last_heartbeat) < 7200000000) AS fresh_heartbeats FROM workers""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return summaries.worker_kpis(t.workers(spark, sf, now), now, fresh_s=7200)


def _log(spark, sf):
    r = telemetry.requests(spark, sf)
    return r.withColumns(
        {
            "latency_ms": F.col("duration_s") * 1000,
            "error": F.when(F.col("status") != "200", F.concat(F.lit("HTTP "), F.col("status"))),
            "batch": F.lit(20),
        }
    )


LOG = t.REQUESTS + """, log AS (SELECT *, duration_s * 1000 AS latency_ms,
  CASE WHEN status <> '200' THEN 'HTTP ' || status END AS error, 20 AS batch FROM requests)"""
PCT = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p99_9": 0.999}
STATS = """round(min(latency_ms) FILTER (error IS NULL), 6) AS min{s},
  round(max(latency_ms) FILTER (error IS NULL), 6) AS max{s}, round(avg(latency_ms) FILTER (error IS NULL), 6) AS mean{s},
  round(stddev_pop(latency_ms) FILTER (error IS NULL), 6) AS stddev{s}"""


def _pct_sql(names, suffix):
    return ", ".join(
        f"round(quantile_cont(latency_ms, {PCT[n]}) FILTER (error IS NULL), 6) AS {n}{suffix}" for n in names
    )


REPORT = f"""count(*) FILTER (error IS NULL) AS samples, {STATS.format(s='_ms')}, {_pct_sql(PCT, '_ms')},
  count(error) AS error_count, list_sort(list(DISTINCT error) FILTER (error IS NOT NULL)) AS error_types,
  count(error) < count(*) FILTER (error IS NULL) * 0.05 AS success"""


@query("latency_report", f"WITH {LOG} SELECT {REPORT} FROM log")
def _(spark, sf):
    return rounded(summaries.latency_report(_log(spark, sf), "latency_ms", "error"))


@query(
    "latency_report_by_role",
    f"""WITH {LOG} SELECT role, {REPORT} FROM log GROUP BY role""",
)
def _(spark, sf):
    return rounded(summaries.latency_report(_log(spark, sf), "latency_ms", "error", ["role"]))


@query(
    "throughput_report",
    f"""WITH {LOG} SELECT coalesce(sum(batch) FILTER (error IS NULL), 0)::BIGINT AS total_sent,
  coalesce(sum(batch) FILTER (error IS NOT NULL), 0)::BIGINT AS total_failed, sum(batch)::BIGINT AS total_attempts,
  count(*) FILTER (error IS NULL) AS successful_requests, count(error) AS failed_requests,
  {STATS.format(s='_latency_ms')}, {_pct_sql(['p50', 'p95', 'p99', 'p99_9'], '_latency_ms')},
  floor(sum(batch) FILTER (error IS NULL) / 600.0)::BIGINT AS achieved_rps,
  round(count(*) FILTER (error IS NULL) / 600.0, 6) AS request_rps,
  round(coalesce(sum(batch) FILTER (error IS NOT NULL), 0) / sum(batch), 6) AS error_rate,
  coalesce(sum(batch) FILTER (error IS NOT NULL), 0) / sum(batch) < 0.05 AS success FROM log""",
)
def _(spark, sf):
    return rounded(summaries.throughput_report(_log(spark, sf), "latency_ms", "error", "batch", 600.0))


@query(
    "error_breakdown",
    f"WITH {LOG} SELECT error, count(*) AS errors FROM log WHERE error IS NOT NULL GROUP BY error",
)
def _(spark, sf):
    return summaries.error_breakdown(_log(spark, sf), "error")


@query(
    "resource_profile_by_node",
    f"""WITH {t.METRICS} SELECT node_id, round(epoch_us(max("timestamp")) / 1e6 - epoch_us(min("timestamp")) / 1e6, 6) AS duration_seconds,
  count(*) AS total_measurements, arg_min(memory_usage, ("timestamp", id)) AS initial_mb, max(memory_usage) AS peak_mb,
  arg_max(memory_usage, ("timestamp", id)) AS final_mb,
  arg_max(memory_usage, ("timestamp", id)) - arg_min(memory_usage, ("timestamp", id)) AS growth_mb,
  round(avg(memory_usage), 6) AS avg_mb, round(avg(cpu_usage), 6) AS avg_percent, max(cpu_usage) AS peak_percent,
  min(cpu_usage) AS min_percent FROM metrics GROUP BY node_id""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    return rounded(summaries.resource_profile(m, "timestamp", "memory_usage", "cpu_usage", ["node_id"]))


def _load_stats(spark, sf):
    """Per-endpoint statistics and the total, in the load-test file's layout."""
    r = telemetry.requests(spark, sf)
    path = F.when(F.col("method") == "POST", F.lit("/api/metrics/bulk")).otherwise(
        F.concat(F.lit("/api/"), F.col("endpoint"))
    )
    cells = [
        F.count("*").alias("Request Count"),
        F.count_if(F.col("status") == "500").alias("Failure Count"),
        F.avg("ms").alias("Average Response Time"),
        (F.count("*") / 600.0).alias("Requests/s"),
    ]
    timed = r.select(
        F.col("method").alias("Type"), path.alias("Name"), "status", (F.col("duration_s") * 1000).alias("ms")
    )
    tails = {"95%": 0.95, "99%": 0.99}
    named = ["Type", "Name"]
    each = timed.groupBy(*named).agg(*cells).join(exact_percentiles(timed, named, "ms", tails), named)
    total = side_by_side(timed.agg(*cells), exact_percentiles(timed, [], "ms", tails))
    total = total.select(F.lit(None).cast("string").alias("Type"), F.lit("Aggregated").alias("Name"), "*")
    return each.unionByName(total)


def _load_history(spark, sf):
    e = telemetry.events(spark, sf)
    hours = e.groupBy(F.window("ts", "1 hour").alias("_w")).agg(
        F.count_distinct("user_id").cast("int").alias("User Count"), (F.count("*") / 3600.0).alias("Requests/s")
    )
    return hours.select(
        F.unix_seconds(F.col("_w.start").cast("timestamp")).alias("Timestamp"),
        "User Count",
        F.lit("Aggregated").alias("Name"),
        "Requests/s",
    )


STATS_SQL = t.REQUESTS + """, named AS (SELECT method AS "Type", CASE WHEN method = 'POST' THEN '/api/metrics/bulk'
    ELSE '/api/' || endpoint END AS "Name", status, duration_s FROM requests)"""


@query(
    "load_test_summary",
    f"""WITH {STATS_SQL} SELECT count(*) AS total_requests, count(*) FILTER (status = '500') AS failures,
  round(avg(duration_s * 1000), 6) AS avg_ms, round(quantile_cont(duration_s * 1000, 0.95), 6) AS p95_ms,
  round(quantile_cont(duration_s * 1000, 0.99), 6) AS p99_ms,
  round(count(*) / 600.0, 6) AS sustained_rps,
  (count(*) FILTER ("Name" = '/api/metrics/bulk') * 20)::BIGINT AS estimated_metrics,
  (SELECT round(max(n) / 3600.0, 6) FROM (SELECT count(*) AS n FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts))) AS peak_rps,
  (SELECT max(n)::INT FROM (SELECT count(DISTINCT user_id) AS n FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts))) AS peak_users
FROM named""",
)
def _(spark, sf):
    return rounded(summaries.load_test_summary(_load_stats(spark, sf), _load_history(spark, sf), 20))


@query(
    "load_test_endpoints",
    f"""WITH {STATS_SQL} SELECT "Type" AS method, "Name" AS endpoint, count(*) AS requests,
  count(*) FILTER (status = '500') AS failures, round(quantile_cont(duration_s * 1000, 0.95), 6) AS p95_ms,
  round(quantile_cont(duration_s * 1000, 0.99), 6) AS p99_ms
FROM named GROUP BY ALL""",
)
def _(spark, sf):
    return rounded(summaries.load_test_endpoints(_load_stats(spark, sf)))


@query(
    "load_window_transitions",
    f"""WITH RECURSIVE {t.SCALING}, bounds AS (
  SELECT min(b) AS lo, max(b) AS hi FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS b, count(*) AS n FROM events GROUP BY 1)
  WHERE n >= (SELECT 2 * avg(n) FROM (SELECT count(*) AS n FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts))) * 0.9)
SELECT e.* FROM scaling_events e, bounds WHERE action <> 'no_change' AND prev_replicas <> new_replicas
  AND (lo IS NULL OR triggered_at BETWEEN lo AND hi) ORDER BY triggered_at, node_id LIMIT 20""",
)
def _(spark, sf):
    """The busy hours' range bounds the decisions: one row of bounds, read as literals."""
    hours = _load_history(spark, sf)
    mean = hours.agg(F.avg("Requests/s").alias("m")).first()["m"]
    busy = hours.filter(F.col("Requests/s") >= mean * 2 * 0.9)
    return summaries.window_transitions(busy, t.scaling_events(spark, sf), tie=["node_id"])


@query(
    "decision_stats_by_node",
    f"""WITH RECURSIVE {t.DECISIONS} SELECT node_id, count(*) AS decisions_made, round(avg(action), 6) AS average_action,
  round(min(action), 6) AS min_action, round(max(action), 6) AS max_action, count(*) FILTER (is_emergency) AS emergency_count,
  round(count(*) FILTER (is_emergency) * 100.0 / count(*), 6) AS emergency_percentage
FROM (SELECT * FROM decided QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY triggered_at DESC) <= 100)
GROUP BY node_id""",
)
def _(spark, sf):
    d = t.decisions(spark, sf).withColumnRenamed("triggered_at", "step")
    return rounded(summaries.decision_stats(d, 100, ["node_id"]))


CONTROL = (
    t.CONTROL_INPUTS + ", " + t.control_sql("1.0", "0.05", "0.5", "-5.0", "10.0", "inputs", "node_id", "15.0")
)


def _control(spark, sf):
    from fleetlens.operators.scaling import replay_control

    steps = t.control_inputs(spark, sf).select("node_id", "triggered_at", "utilization", F.lit(15.0).alias("dt"))
    return replay_control(steps, ["node_id"], "triggered_at", "utilization", "dt").withColumnRenamed(
        "triggered_at", "step"
    )


@query(
    "control_error_stats_by_node",
    f"""WITH RECURSIVE {CONTROL} SELECT node_id, count(*) AS error_history_length, round(avg(error), 6) AS error_mean,
  round(CASE WHEN count(*) > 1 THEN stddev_samp(error) ELSE 0.0 END, 6) AS error_std, round(min(error), 6) AS error_min,
  round(max(error), 6) AS error_max, round(arg_max(error, rn), 6) AS last_error,
  round(arg_max(integral_error, rn), 6) AS integral_error
FROM (SELECT * FROM controlled QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY rn DESC) <= 1000) GROUP BY node_id""",
)
def _(spark, sf):
    return rounded(summaries.control_error_stats(_control(spark, sf), 1000, ["node_id"]))


@query(
    "control_stability_by_node",
    f"""WITH RECURSIVE {CONTROL}, late AS (SELECT node_id, stddev_pop(error) AS late_oscillation FROM
    (SELECT * FROM controlled QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY rn DESC) <= 5) GROUP BY node_id)
SELECT c.node_id, round(avg(error), 6) AS error_mean, round(stddev_pop(error), 6) AS error_std,
  round(var_pop(action), 6) AS action_variance, min(triggered_at) FILTER (abs(error) < 5) AS settling_step,
  round(max(error), 6) AS max_error, round(any_value(late_oscillation), 6) AS late_oscillation
FROM controlled c JOIN late l ON c.node_id = l.node_id GROUP BY c.node_id""",
)
def _(spark, sf):
    return rounded(summaries.control_stability(_control(spark, sf), ["node_id"]))


@query(
    "table_freshness",
    f"""WITH {t.METRICS} SELECT count(*) AS rows, max("timestamp") AS newest, count(*) FILTER ({DAY}) AS recent_rows FROM metrics""",
)
def _(spark, sf):
    return summaries.table_freshness(telemetry.metrics(spark, sf), "timestamp", 1440, t.as_of(spark, sf))


@query(
    "p99_regressions",
    f"""WITH {t.REQUESTS}, split AS (SELECT endpoint AS test_name, ts >= {t.AS_OF} - INTERVAL 15 DAY AS recent,
    quantile_cont(duration_s, 0.99) AS p99_ms FROM requests GROUP BY ALL)
SELECT c.test_name, round(c.p99_ms, 6) AS "current", round(b.p99_ms, 6) AS baseline, c.p99_ms > b.p99_ms * 1.05 AS regressed
FROM split c JOIN split b ON c.test_name = b.test_name AND c.recent AND NOT b.recent""",
)
def _(spark, sf):
    from fleetlens.functions.quantiles import exact_percentiles

    r = telemetry.requests(spark, sf)
    recent = F.col("ts") >= instant(r, "ts", t.as_of(spark, sf) - timedelta(days=15))
    p99 = lambda rows: exact_percentiles(
        rows.withColumnRenamed("endpoint", "test_name"), ["test_name"], "duration_s", {"p99_ms": 0.99}
    )
    return rounded(summaries.regressions(p99(r.filter(recent)), p99(r.filter(~recent)), factor=1.05))


@query(
    "ingest_completeness",
    f"""WITH {t.METRICS}, c AS (SELECT count(*) FILTER ("timestamp" < {t.AS_OF} - INTERVAL 15 DAY) AS start_count,
    count(*) AS end_count FROM metrics WHERE node_id LIKE 'node-4%')
SELECT start_count, end_count, end_count - start_count AS ingested, 500 AS expected,
  round((end_count - start_count) / 500.0, 6) AS success_rate, end_count - start_count >= 475 AS passed FROM c""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    before = m.filter(F.col("timestamp") < instant(m, "timestamp", t.as_of(spark, sf) - timedelta(days=15)))
    return rounded(summaries.ingest_completeness(before, m, "node-4", 500))
