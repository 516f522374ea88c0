"""Registered queries: reads, facets and chart series."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from fleetlens.functions import present
from fleetlens.functions.clock import epoch_us
from fleetlens.operators import reads
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

M_COLS = 'node_id, "timestamp", cpu_usage, memory_usage, latency_ms, requests_per_sec, disk_usage'


@query(
    "metrics_recent",
    f"""WITH {t.METRICS} SELECT {M_COLS} FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 1440 MINUTE
ORDER BY "timestamp" DESC, id DESC LIMIT 5000""",
)
def _(spark, sf):
    return reads.get_metrics(telemetry.metrics(spark, sf), minutes=1440, limit=5000, as_of=t.as_of(spark, sf))


@query(
    "metrics_recent_node",
    f"""WITH {t.METRICS} SELECT {M_COLS} FROM metrics
WHERE node_id = 'node-3' AND "timestamp" >= {t.AS_OF} - INTERVAL 1440 MINUTE
ORDER BY "timestamp" DESC, id DESC LIMIT 500""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    return reads.get_metrics(m, node_id="node-3", minutes=1440, limit=500, as_of=t.as_of(spark, sf))


@query(
    "anomalies_newest",
    f"""WITH {t.ANOMALIES} SELECT id, node_id, detected_at, anomaly_type, metric_name, metric_value, threshold,
       anomaly_score, description FROM anomalies WHERE detected_at >= {t.AS_OF} - INTERVAL 1440 MINUTE
ORDER BY detected_at DESC, id DESC LIMIT 1000""",
)
def _(spark, sf):
    return reads.get_anomalies(t.anomalies(spark, sf), minutes=1440, limit=1000, as_of=t.as_of(spark, sf))


@query(
    "predictions_newest",
    f"""WITH {t.PREDICTIONS} SELECT predicted_at, horizon_minutes, predicted_rps, predicted_cpu, confidence,
       lower_bound, upper_bound, spike_probability, model_name FROM predictions
ORDER BY predicted_at DESC LIMIT 100""",
)
def _(spark, sf):
    return reads.get_predictions(t.predictions(spark, sf), limit=100)


@query(
    "scaling_events_newest",
    f"""WITH RECURSIVE {t.SCALING}, numbered AS (
  SELECT epoch_us(triggered_at) // 3600000000 * 1000 + CAST(substr(node_id, 6) AS BIGINT) AS id, * FROM scaling_events)
SELECT id, triggered_at, action, prev_replicas, new_replicas, reason FROM numbered
ORDER BY triggered_at DESC, id DESC LIMIT 500""",
)
def _(spark, sf):
    hour = F.floor(epoch_us("triggered_at") / 3_600_000_000)
    node = F.substring("node_id", 6, 10).cast("bigint")
    events = t.scaling_events(spark, sf).withColumn("id", hour * 1000 + node)
    return reads.get_scaling_events(events, limit=500)


@query(
    "alerts_newest",
    f"""WITH {t.ALERTS} SELECT id, raised_at, severity, node_id, alert_type, message, resolved FROM alerts
WHERE raised_at >= {t.AS_OF} - INTERVAL 14400 MINUTE ORDER BY raised_at DESC, id DESC LIMIT 500""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return reads.get_alerts(t.alerts(spark, sf, now), minutes=14400, limit=500, as_of=now)


@query(
    "alerts_open",
    f"""WITH {t.ALERTS} SELECT id, raised_at, severity, node_id, alert_type, message, resolved FROM alerts
WHERE raised_at >= {t.AS_OF} - INTERVAL 43200 MINUTE AND NOT resolved
ORDER BY raised_at DESC, id DESC LIMIT 500""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return reads.get_alerts(t.alerts(spark, sf, now), minutes=43200, unresolved_only=True, limit=500, as_of=now)


@query("workers_by_registration", f"WITH {t.WORKERS} SELECT * FROM workers ORDER BY registered_at DESC, worker_id")
def _(spark, sf):
    return reads.get_workers(t.workers(spark, sf, t.as_of(spark, sf)))


@query(
    "anomalies_of_node_and_type",
    f"WITH {t.ANOMALIES} SELECT * FROM anomalies WHERE node_id = 'node-5' AND anomaly_type = 'rule_based'",
)
def _(spark, sf):
    return reads.filter_anomalies(t.anomalies(spark, sf), "node-5", "rule_based")


@query("alerts_critical_tab", f"WITH {t.ALERTS} SELECT * FROM alerts WHERE lower(severity) = 'critical'")
def _(spark, sf):
    return reads.filter_severity(t.alerts(spark, sf, t.as_of(spark, sf)), "Critical")


@query(
    "scale_transitions",
    f"""WITH RECURSIVE {t.SCALING} SELECT node_id, triggered_at, action, prev_replicas, new_replicas, reason
FROM scaling_events WHERE action <> 'no_change' AND prev_replicas <> new_replicas
  AND triggered_at >= {t.AS_OF} - INTERVAL 10 DAY AND triggered_at <= {t.AS_OF} - INTERVAL 2 DAY
ORDER BY triggered_at, node_id, prev_replicas, new_replicas, reason LIMIT 20""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return reads.scale_transitions(t.scaling_events(spark, sf), now - timedelta(days=10), now - timedelta(days=2))


@query("node_prefix_count", f"WITH {t.METRICS} SELECT count(*) AS rows FROM metrics WHERE node_id LIKE 'node-1%'")
def _(spark, sf):
    return reads.count_by_prefix(telemetry.metrics(spark, sf), "node-1")


@query(
    "invalid_rows_purged",
    "SELECT event_id, value - 5 AS metric_value FROM events WHERE NOT (value - 5 < 0)",
)
def _(spark, sf):
    e = telemetry.events(spark, sf).select("event_id", (F.col("value") - 5).alias("metric_value"))
    return reads.purge_invalid(e)


@query(
    "latest_row_per_node",
    f"""WITH {t.METRICS} SELECT * FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 1440 MINUTE
QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY "timestamp" DESC, id DESC) = 1""",
)
def _(spark, sf):
    return reads.latest_per_node(telemetry.metrics(spark, sf), 1440, t.as_of(spark, sf))


@query(
    "latest_prediction",
    f"""WITH {t.PREDICTIONS} SELECT predicted_rps,
       coalesce(nullif(upper_bound, 0), nullif(predicted_rps, 0), 0.0) AS upper_bound, spike_probability,
       confidence, model_name FROM predictions ORDER BY predicted_at DESC LIMIT 1""",
)
def _(spark, sf):
    return reads.latest_prediction(t.predictions(spark, sf))


@query(
    "chart_first_per_second",
    f"""WITH {t.METRICS}, firsts AS (SELECT strftime("timestamp", '%H:%M:%S') AS label, * EXCLUDE (node_id) FROM metrics
QUALIFY row_number() OVER (PARTITION BY strftime("timestamp", '%H:%M:%S') ORDER BY "timestamp", id) = 1)
SELECT * EXCLUDE (id) FROM firsts ORDER BY "timestamp" DESC LIMIT 50""",
)
def _(spark, sf):
    return reads.chart_by_second(telemetry.metrics(spark, sf))


@query(
    "chart_newest_series",
    f"""WITH {t.METRICS} SELECT * FROM (SELECT "timestamp", cpu_usage, latency_ms FROM metrics
ORDER BY "timestamp" DESC, id DESC LIMIT 120) ORDER BY "timestamp" """,
)
def _(spark, sf):
    return reads.chart_series(telemetry.metrics(spark, sf), "timestamp", ["cpu_usage", "latency_ms"], 120)


@query("facet_nodes", f"WITH {t.ANOMALIES} SELECT DISTINCT node_id FROM anomalies ORDER BY node_id")
def _(spark, sf):
    return reads.facet_values(t.anomalies(spark, sf), "node_id")


@query("facet_metrics", f"WITH {t.ANOMALIES} SELECT DISTINCT metric_name FROM anomalies ORDER BY metric_name")
def _(spark, sf):
    return reads.facet_values(t.anomalies(spark, sf), "metric_name")


@query(
    "last_rows_per_node",
    f"""WITH {t.METRICS} SELECT * FROM metrics
QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY "timestamp" DESC, id DESC) <= 288""",
)
def _(spark, sf):
    return reads.last_n_per_series(telemetry.metrics(spark, sf), ["node_id"], "timestamp", 288)


@query(
    "active_nodes",
    f"""WITH {t.METRICS} SELECT DISTINCT node_id FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 240 MINUTE""",
)
def _(spark, sf):
    return reads.active_nodes(telemetry.metrics(spark, sf), 240, t.as_of(spark, sf))


@query(
    "presented_metrics",
    f"""WITH {t.METRICS} SELECT id, regexp_replace(regexp_replace(format('{{:,}}', CAST(trunc(CAST(printf('%.1f', latency_ms) AS DOUBLE)) AS BIGINT))
         || '.' || right(printf('%.1f', latency_ms), 1), '\\.0$', ''), '^-0$', '0')
         || ' ms' AS latency,
       CAST(CAST(memory_usage AS BIGINT) AS VARCHAR) || '%' AS memory,
       strftime("timestamp", '%H:%M:%S') AS time,
       strftime("timestamp", '%b %-d, %H:%M:%S') AS datetime,
       CASE WHEN epoch_us({t.AS_OF}) - epoch_us("timestamp") >= 172800000000
              THEN CAST((epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 86400000000 AS VARCHAR) || ' days ago'
            WHEN epoch_us({t.AS_OF}) - epoch_us("timestamp") >= 86400000000 THEN '1 day ago'
            WHEN epoch_us({t.AS_OF}) - epoch_us("timestamp") >= 7200000000
              THEN CAST((epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 3600000000 AS VARCHAR) || ' hours ago'
            WHEN epoch_us({t.AS_OF}) - epoch_us("timestamp") >= 3600000000 THEN '1 hour ago'
            WHEN (epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 60000000 > 1
              THEN CAST((epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 60000000 AS VARCHAR) || ' minutes ago'
            WHEN (epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 60000000 = 1 THEN '1 minute ago'
            WHEN (epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 1000000 = 1 THEN '1 second ago'
            ELSE CAST((epoch_us({t.AS_OF}) - epoch_us("timestamp")) // 1000000 AS VARCHAR) || ' seconds ago' END AS age
FROM metrics""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    return m.select(
        "id",
        present.fmt_ms("latency_ms").alias("latency"),
        present.fmt_percent("memory_usage").alias("memory"),
        present.fmt_short_time("timestamp").alias("time"),
        present.fmt_datetime("timestamp").alias("datetime"),
        present.age_label(m, "timestamp", t.as_of(spark, sf)).alias("age"),
    )


@query(
    "anomaly_tones",
    f"""WITH {t.ANOMALIES} SELECT id, anomaly_score,
       CASE WHEN anomaly_score >= 0.8 THEN 'bad' WHEN anomaly_score >= 0.5 THEN 'warn' ELSE 'good' END AS score_tone,
       CASE WHEN anomaly_score > 0.8 THEN 'bad' ELSE 'warn' END AS alert_tone,
       replace(anomaly_type, '_', ' ') AS kind
FROM anomalies""",
)
def _(spark, sf):
    from fleetlens.operators.anomaly import severity

    a = t.anomalies(spark, sf).withColumn("_severity", severity("anomaly_score"))
    return a.select(
        "id",
        "anomaly_score",
        present.anomaly_tone("anomaly_score").alias("score_tone"),
        present.severity_tone("_severity").alias("alert_tone"),
        present.action_label("anomaly_type").alias("kind"),
    )


