"""Derived tables of the registered queries, in Spark and in SQL.

Everything comes from ``events``: the telemetry tables by row expressions, and
anomalies, alerts, workers, forecasts and scaling events by the operators.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.clock import since
from fleetlens.operators import anomaly, forecast, scaling
from fleetlens.operators.summaries import resample_mean
from fleetlens.params import EMA_CONFIDENCE, HORIZON_MINUTES, MODEL_EMA, ScalerPolicy
from fleetlens.sources import telemetry

ACTIVE_HOURS = 12
RESOLVED_DAYS = 7


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    """Newest event time, as a literal for the time filters."""
    return telemetry.events(spark, sf_dir).agg(F.max("ts")).first()[0]


def workers(spark: SparkSession, sf_dir: str, now: datetime) -> DataFrame:
    e = telemetry.events(spark, sf_dir)
    name = F.concat(F.lit("worker-"), F.col("user_id").cast("string"))
    rows = e.groupBy(name.alias("worker_id")).agg(
        F.min("ts").alias("registered_at"), F.max("ts").alias("last_heartbeat")
    )
    return rows.select(
        "worker_id",
        F.substring(F.md5("worker_id"), 1, 12).alias("container_id"),
        "registered_at",
        "last_heartbeat",
        F.when(since(rows, "last_heartbeat", now, hours=ACTIVE_HOURS), "active")
        .otherwise("terminated")
        .alias("status"),
    )


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = anomaly.flag_rules(telemetry.metrics(spark, sf_dir))
    part = F.when(F.col("metric_name") == "cpu", 0).when(F.col("metric_name") == "memory", 1).otherwise(2)
    return flagged.withColumn("id", F.col("id") * 10 + part).withColumnRenamed("timestamp", "detected_at")


def alerts(spark: SparkSession, sf_dir: str, now: datetime) -> DataFrame:
    raised = anomaly.alerts_from_anomalies(anomalies(spark, sf_dir))
    done = ~since(raised, "raised_at", now, days=RESOLVED_DAYS)
    return raised.withColumns(
        {
            "resolved": done,
            "resolved_at": F.when(done, F.col("raised_at") + F.expr("INTERVAL 1 HOUR")),
        }
    )


def hourly(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    m = telemetry.metrics(spark, sf_dir)
    return resample_mean(m, "timestamp", "requests_per_sec", keys, "1 hour")


def predictions(spark: SparkSession, sf_dir: str, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    rolled = forecast.rolling_ema_forecast(hourly(spark, sf_dir, keys), keys)
    p = F.round("predicted", 6)
    return rolled.select(
        *keys,
        F.col("ds").alias("predicted_at"),
        F.lit(HORIZON_MINUTES).alias("horizon_minutes"),
        p.alias("predicted_rps"),
        F.lit(None).cast("double").alias("predicted_cpu"),
        F.lit(EMA_CONFIDENCE).alias("confidence"),
        p.alias("lower_bound"),
        p.alias("upper_bound"),
        F.lit(0.0).alias("spike_probability"),
        F.lit(MODEL_EMA).alias("model_name"),
    )


def control_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly steps per node: utilization, forecast, share of slow requests, and the replicas observed (a replica
    reports once an hour)."""
    m = telemetry.metrics(spark, sf_dir)
    facts = m.groupBy("node_id", F.window("timestamp", "1 hour").alias("_w")).agg(
        F.round(F.avg("cpu_usage"), 4).alias("utilization"),
        F.round(F.avg((F.col("latency_ms") > 800).cast("double")), 4).alias("spike_probability"),
        F.count("*").alias("workers"),
    )
    facts = facts.select("node_id", F.col("_w.start").alias("triggered_at"), "utilization", "spike_probability", "workers")
    ahead = predictions(spark, sf_dir, ["node_id"]).select(
        "node_id", F.col("predicted_at").alias("triggered_at"), "predicted_rps", "upper_bound", "model_name"
    )
    return facts.join(ahead, ["node_id", "triggered_at"])


def decisions(
    spark: SparkSession, sf_dir: str, policy: ScalerPolicy = ScalerPolicy(), observed: bool = False
) -> DataFrame:
    """Decisions on the hourly steps; a step finds the last one's target, or the replicas observed."""
    steps = control_inputs(spark, sf_dir)
    return scaling.replay_decisions(steps if observed else steps.drop("workers"), ["node_id"], policy)


def scaling_events(
    spark: SparkSession, sf_dir: str, policy: ScalerPolicy = ScalerPolicy(), observed: bool = False
) -> DataFrame:
    return scaling.scaling_events(decisions(spark, sf_dir, policy, observed), policy)


# --- the same tables in SQL ---------------------------------------------------------

AS_OF = "(SELECT max(ts) FROM events)"

METRICS = """metrics AS (
  SELECT event_id AS id, 'node-' || CAST(user_id % 8 AS VARCHAR) AS node_id, ts AS "timestamp",
         least(value, 100.0) AS cpu_usage, CAST(event_id * 37 % 100 AS DOUBLE) AS memory_usage,
         value * 8 AS latency_ms, 50 + value * 2.5 AS requests_per_sec,
         CAST(40 + event_id % 10 AS DOUBLE) AS disk_usage
  FROM events)"""

REQUESTS = """requests AS (
  SELECT event_id AS id, ts, user_id AS key,
         ['admin', 'operator', 'viewer', 'service', 'guest'][CAST(user_id % 5 AS INT) + 1] AS role,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
         event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN '500'
              WHEN event_type = 'signup' AND event_id % 10 = 0 THEN '404' ELSE '200' END AS status,
         value / 100 AS duration_s, 1 AS tokens
  FROM events)"""

SPANS = """spans AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN 'trace_root' ELSE event_type END AS name,
         CAST(event_id // 5 AS VARCHAR) AS trace_id, CAST(event_id AS VARCHAR) AS span_id,
         CASE WHEN event_id % 5 <> 0 THEN CAST(event_id // 5 * 5 AS VARCHAR) END AS parent_span_id,
         epoch_us(ts) / 1e6 AS start_time,
         CASE WHEN event_id % 50 <> 7 THEN epoch_us(ts) / 1e6 + value / 1000 END AS end_time,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status,
         CASE WHEN event_type = 'error' THEN 'failed after ' || CAST(value AS VARCHAR) || ' ms' END AS error
  FROM events)"""

WORKERS = f"""workers AS (
  SELECT worker_id, substr(md5(worker_id), 1, 12) AS container_id, registered_at, last_heartbeat,
         CASE WHEN last_heartbeat >= {AS_OF} - INTERVAL {ACTIVE_HOURS} HOUR
              THEN 'active' ELSE 'terminated' END AS status
  FROM (SELECT 'worker-' || CAST(user_id AS VARCHAR) AS worker_id,
               min(ts) AS registered_at, max(ts) AS last_heartbeat
        FROM events GROUP BY 1))"""

FLAGS = METRICS + """, flags AS (
  SELECT id, node_id, "timestamp", metric_name, metric_value, threshold,
         round(least(1.0, 0.5 + (metric_value - threshold) / threshold), 3) AS anomaly_score,
         text || ': ' || printf('%.1f', metric_value) || ' exceeds threshold ' || shown AS description
  FROM (SELECT id, node_id, "timestamp", 'cpu' AS metric_name, cpu_usage AS metric_value,
               85.0::DOUBLE AS threshold, 'High CPU usage' AS text, '85.0' AS shown FROM metrics
        UNION ALL
        SELECT id, node_id, "timestamp", 'memory', memory_usage, 90.0, 'High Memory usage', '90.0' FROM metrics
        UNION ALL
        SELECT id, node_id, "timestamp", 'latency', latency_ms, 500.0, 'High Latency', '500.0' FROM metrics)
  WHERE metric_value > threshold)"""

ANOMALIES = FLAGS + """, anomalies AS (
  SELECT id * 10 + CASE metric_name WHEN 'cpu' THEN 0 WHEN 'memory' THEN 1 ELSE 2 END AS id, node_id,
         "timestamp" AS detected_at, 'rule_based' AS anomaly_type, metric_name, metric_value, threshold,
         anomaly_score, description
  FROM flags)"""

ALERTS = ANOMALIES + f""", alerts AS (
  SELECT id, detected_at AS raised_at,
         CASE WHEN anomaly_score > 0.8 THEN 'critical' ELSE 'warning' END AS severity,
         node_id, anomaly_type AS alert_type, description AS message,
         detected_at < {AS_OF} - INTERVAL {RESOLVED_DAYS} DAY AS resolved,
         CASE WHEN detected_at < {AS_OF} - INTERVAL {RESOLVED_DAYS} DAY
              THEN detected_at + INTERVAL 1 HOUR END AS resolved_at
  FROM anomalies)"""


def ema_sql(values: str, steps: int = HORIZON_MINUTES) -> str:
    """Forecast of a list, folded in the same order as in Spark."""
    half = f"(len({values}) // 2)"
    ema = f"list_reduce({values}, lambda acc, x: x * 0.3 + acc * 0.7)"
    head = f"list_sum(list_slice({values}, 1, {half})) / {half}"
    return (
        f"CASE WHEN {half} > 0 THEN greatest(0.0, {ema} + ({ema} - {head}) / {half} * {steps}) ELSE 0.0 END"
    )


def predictions_sql(keyed: bool) -> str:
    key = "node_id, " if keyed else ""
    part = "PARTITION BY node_id " if keyed else ""
    return f"""hourly AS (
  SELECT {key}time_bucket(INTERVAL '1 hour', "timestamp") AS ds, avg(requests_per_sec) AS y
  FROM metrics GROUP BY ALL), rolled AS (
  SELECT {key}ds, y, list(y) OVER ({part}ORDER BY ds ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS v
  FROM hourly), predictions AS (
  SELECT {key}ds AS predicted_at, 10 AS horizon_minutes, round({ema_sql('v')}, 6) AS predicted_rps,
         CAST(NULL AS DOUBLE) AS predicted_cpu, 0.6::DOUBLE AS confidence,
         round({ema_sql('v')}, 6) AS lower_bound, round({ema_sql('v')}, 6) AS upper_bound,
         0.0::DOUBLE AS spike_probability, 'ema_fallback' AS model_name
  FROM rolled)"""


PREDICTIONS = METRICS + ", " + predictions_sql(False)

def control_inputs_sql(observed: bool) -> str:
    """Hourly steps, with the observed replicas or without."""
    workers, count = (" f.workers,", ", count(*)::INT AS workers") if observed else ("", "")
    return METRICS + ", " + predictions_sql(True) + f""", inputs AS (
  SELECT f.node_id, f.triggered_at, f.utilization, f.spike_probability, p.predicted_rps, p.upper_bound,
         p.model_name,{workers} row_number() OVER (PARTITION BY f.node_id ORDER BY f.triggered_at) AS rn
  FROM (SELECT node_id, time_bucket(INTERVAL '1 hour', "timestamp") AS triggered_at,
               round(avg(cpu_usage), 4) AS utilization,
               round(avg(CASE WHEN latency_ms > 800 THEN 1.0 ELSE 0.0 END), 4) AS spike_probability{count}
        FROM metrics GROUP BY ALL) f
  JOIN predictions p ON p.node_id = f.node_id AND p.predicted_at = f.triggered_at)"""


CONTROL_INPUTS, CARRIED_INPUTS = control_inputs_sql(True), control_inputs_sql(False)


def control_sql(kp: str, ki: str, kd: str, low: str, high: str, source: str, keys: str, dt: str) -> str:
    """Recursive replay of the control loop over ``source`` (keys, rn, utilization)."""
    k = [c.strip() for c in keys.split(",")]
    same = " AND ".join(f"n.{c} = p.{c}" for c in k)
    cols = ", ".join(f"n.{c}" for c in k)
    return f"""control AS (
  SELECT {keys}, rn, triggered_at, utilization, 70.0 - utilization AS error,
         CAST(0.0 AS DOUBLE) AS slope,
         least(100.0, greatest(-100.0, (70.0 - utilization) * {dt})) AS integral_error
  FROM {source} WHERE rn = 1
  UNION ALL
  SELECT {cols}, n.rn, n.triggered_at, n.utilization, 70.0 - n.utilization,
         ((70.0 - n.utilization) - p.error) / {dt},
         least(100.0, greatest(-100.0, p.integral_error + (70.0 - n.utilization) * {dt}))
  FROM control p JOIN {source} n ON {same} AND n.rn = p.rn + 1), controlled AS (
  SELECT {keys}, rn, triggered_at, utilization, error, {kp} * error AS p_term, {ki} * integral_error AS i_term,
         {kd} * slope AS d_term, integral_error,
         least({high}, greatest({low}, {kp} * error + {ki} * integral_error + {kd} * slope)) AS action
  FROM control)"""


def decisions_sql(min_interval_s: float = 15.0, dt: str = "15.0", observed: bool = False) -> str:
    """Recursive replay of the decisions: loop, forecast and spike parts, replicas (observed, or the last target)."""
    body = f"""
  SELECT s.*, CASE WHEN held THEN prev_integral
                   ELSE least(100.0, greatest(-100.0, prev_integral + (70.0 - utilization) * {dt})) END AS integral,
         CASE WHEN held THEN prev_error ELSE 70.0 - utilization END AS error,
         CASE WHEN held THEN prev_at ELSE triggered_at END AS decided_at,
         CASE WHEN held THEN 0.0 ELSE least(3.0, greatest(-3.0, (70.0 - utilization)
              + 0.05 * least(100.0, greatest(-100.0, prev_integral + (70.0 - utilization) * {dt}))
              + 0.5 * CASE WHEN prev_error IS NULL THEN 0.0
                           ELSE ((70.0 - utilization) - prev_error) / {dt} END)) END AS pid_component,
         CASE WHEN held OR upper_util <= 80.5 THEN 0.0
              ELSE -least(2.4000000000000004, 0.1 * (upper_util - 80.5) / 10.0) END AS forecast_component,
         CASE WHEN NOT held AND spike_probability > 0.6 THEN -2.4000000000000004::DOUBLE ELSE 0.0::DOUBLE END AS spike_component,
         NOT held AND spike_probability > 0.6 AS is_emergency,
         CASE WHEN held THEN waited END AS held_back_s"""
    raw = f"""
  SELECT b.*, CASE WHEN held THEN 0.0 ELSE least(3.0, greatest(-3.0,
              (pid_component + forecast_component + spike_component)
              * CASE WHEN is_emergency THEN 1.5 ELSE 1.0 END)) END AS raw_action
  FROM ({body} FROM (%s) s) b"""
    act = f"""
  SELECT r.*, CASE WHEN abs(raw_action) < 0.5 THEN 0.0 ELSE raw_action END AS action,
         CASE WHEN abs(raw_action) < 0.5 THEN prev_replicas
              WHEN raw_action < 0 THEN least(8, prev_replicas + CAST(ceil(-raw_action) AS INT))
              ELSE greatest(1, prev_replicas - CAST(ceil(raw_action) AS INT)) END AS new_replicas
  FROM ({raw}) r"""
    util = "least(100.0, {n}.upper_bound / ({w} * 300.0) * 100)"
    at_first, at_next = ("n.workers", "n.workers") if observed else ("1", "p.new_replicas")
    first = f"""SELECT n.*, CAST(0.0 AS DOUBLE) AS prev_integral, CAST(NULL AS DOUBLE) AS prev_error,
         CAST(NULL AS TIMESTAMP) AS prev_at, {at_first} AS prev_replicas, {util.format(n='n', w=at_first)} AS upper_util,
         CAST(NULL AS DOUBLE) AS waited, false AS held
  FROM inputs n WHERE n.rn = 1"""
    following = f"""SELECT n.*, p.integral, p.error, p.decided_at, {at_next},
         {util.format(n='n', w=at_next)},
         (epoch_us(n.triggered_at) - epoch_us(p.decided_at)) / 1e6,
         (epoch_us(n.triggered_at) - epoch_us(p.decided_at)) / 1e6 < {min_interval_s}
  FROM decided p JOIN inputs n ON n.node_id = p.node_id AND n.rn = p.rn + 1"""
    names = (
        f"node_id, triggered_at, utilization, spike_probability, predicted_rps, upper_bound, model_name, {'workers, ' if observed else ''}rn, "
        "prev_integral, prev_error, prev_at, prev_replicas, upper_util, waited, held"
    )
    nxt = f"SELECT * FROM ({following}) AS q({names})"
    return f"decided AS ({act % first} UNION ALL {act % nxt})"


DECISIONS = CARRIED_INPUTS + ", " + decisions_sql()
OBSERVED_DECISIONS = CONTROL_INPUTS + ", " + decisions_sql(observed=True)


def reason_sql(min_interval_s: float = 15.0) -> str:
    return f"""CASE
    WHEN held_back_s IS NOT NULL THEN printf('Thrashing prevention: %.0fs since last decision (min: %.0fs)', held_back_s, {min_interval_s}::DOUBLE)
    WHEN abs(raw_action) < 0.5 THEN printf('Scaling action %.2f below minimum magnitude %.2f', raw_action, 0.5::DOUBLE)
    WHEN is_emergency THEN printf('LSTM SPIKE ALERT: Spike probability %.1f%% exceeds threshold %.1f%%', spike_probability * 100, 60.0::DOUBLE)
    WHEN upper_util > 80.5 THEN printf('Prophet detected predicted peak %.1f%% exceeds headroom threshold %.1f%%', upper_util, 80.5::DOUBLE)
    ELSE printf('PID: %+.2f, Prophet: %+.2f, LSTM: %+.2f', pid_component, forecast_component, spike_component) END
    || printf('; cpu=%.1f; predicted_rps=%.1f; upper_util=%.1f; spike_probability=%.2f; model=%s',
              utilization, predicted_rps, upper_util, spike_probability, model_name)"""


def scaling_events_sql(min_interval_s: float = 15.0) -> str:
    return f"""scaling_events AS (
  SELECT node_id, triggered_at,
         CASE WHEN new_replicas > prev_replicas THEN 'scale_up'
              WHEN new_replicas < prev_replicas THEN 'scale_down' ELSE 'no_change' END AS action,
         prev_replicas, new_replicas, {reason_sql(min_interval_s)} AS reason
  FROM decided)"""


SCALING = DECISIONS + ", " + scaling_events_sql()
OBSERVED_SCALING = OBSERVED_DECISIONS + ", " + scaling_events_sql()
