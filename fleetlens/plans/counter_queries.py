"""Registered queries: counters, gauges and histograms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators import counters as c
from fleetlens.params import HISTOGRAM_EDGES
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

DAY_S, HOUR_S, SCRAPE_S, WINDOW_S = 86_400, 3_600, 600, 21_600
SERIES = ["method", "endpoint", "status"]
EDGES = HISTOGRAM_EDGES["http_request_duration_seconds"]


def counter_sql(keys: str, source: str = "requests", time: str = "ts", name: str = "samples") -> str:
    """Running count per label set, one sample per scrape, restarted each day."""
    return f"""{name} AS (SELECT ts, {keys}, CAST(sum(n) OVER (PARTITION BY {keys}, life ORDER BY ts) AS DOUBLE) AS value
  FROM (SELECT time_bucket(INTERVAL '10 minutes', {time}) + INTERVAL 10 MINUTE AS ts, {keys}, count(*) AS n,
               time_bucket(INTERVAL '1 day', time_bucket(INTERVAL '10 minutes', {time}) + INTERVAL 10 MINUTE) AS life
        FROM {source} GROUP BY ALL))"""


def increase_sql(keys: str, samples: str = "samples", window_s: int = WINDOW_S, step_s: int = HOUR_S, name: str = "grown") -> str:
    """Growth inside (t - window, t] on an aligned grid."""
    w, s = window_s * 1_000_000, step_s * 1_000_000
    return f"""{name}_d AS (SELECT *, lag(ts) OVER s AS prev_ts, CASE WHEN value < lag(value) OVER s THEN value
    ELSE value - lag(value) OVER s END AS delta FROM {samples} WINDOW s AS (PARTITION BY {keys} ORDER BY ts)),
  {name}_g AS (SELECT *, unnest(range((CAST(ceil(epoch_us(ts) / {s}) AS BIGINT)) * {s},
      (epoch_us(ts) + {w} - 1) // {s} * {s} + 1, {s}::BIGINT)) AS tu FROM {name}_d),
  {name} AS (SELECT {keys}, make_timestamp(tu) AS t, sum(delta) FILTER (epoch_us(prev_ts) > tu - {w}) AS increase,
      count(*) AS n, arg_min(value, ts) AS first_value, min(ts) AS first_ts, max(ts) AS last_ts, tu
    FROM {name}_g GROUP BY {keys}, tu HAVING count(*) > 1)"""


def _samples(spark, sf, keys=SERIES):
    return c.counter_samples(telemetry.requests(spark, sf), keys, "ts", SCRAPE_S, DAY_S)


def _rates(spark, sf, keys=SERIES):
    return c.rate(_samples(spark, sf, keys), keys, WINDOW_S, HOUR_S)


KEYS = "method, endpoint, status"
BASE = f"{t.REQUESTS}, {counter_sql(KEYS)}"
GROWN = f"{BASE}, {increase_sql(KEYS)}"
RATES = f"{GROWN}, rates AS (SELECT {KEYS}, t, increase / {WINDOW_S}.0 AS rate FROM grown)"


@query("counter_samples", f"WITH {BASE} SELECT * FROM samples")
def _(spark, sf):
    return _samples(spark, sf)


@query("request_rate", f"WITH {RATES} SELECT {KEYS}, t, round(rate, 9) AS rate FROM rates")
def _(spark, sf):
    return rounded(_rates(spark, sf), 9)


@query(
    "request_rate_extrapolated",
    f"""WITH {GROWN}, e AS (SELECT *, (epoch_us(last_ts) - epoch_us(first_ts)) / 1e6 AS sampled,
    epoch_us(first_ts) / 1e6 - (tu / 1e6 - {WINDOW_S}) AS to_start, tu / 1e6 - epoch_us(last_ts) / 1e6 AS to_end FROM grown),
  f AS (SELECT *, sampled / (n - 1) AS gap FROM e),
  h AS (SELECT *, CASE WHEN to_start >= gap * 1.1 THEN gap / 2 ELSE to_start END AS head,
    CASE WHEN increase > 0 AND first_value >= 0 THEN sampled * first_value / increase END AS to_zero,
    CASE WHEN to_end >= gap * 1.1 THEN gap / 2 ELSE to_end END AS tail FROM f)
SELECT {KEYS}, t, round(increase * ((sampled + least(head, to_zero) + tail) / sampled) / {WINDOW_S}.0, 9) AS rate FROM h""",
)
def _(spark, sf):
    return rounded(c.rate(_samples(spark, sf), SERIES, WINDOW_S, HOUR_S, extrapolate=True), 9)


@query("request_increase", f"WITH {GROWN} SELECT {KEYS}, t, increase FROM grown")
def _(spark, sf):
    return c.increase(_samples(spark, sf), SERIES, WINDOW_S, HOUR_S)


@query(
    "requests_per_minute",
    f"WITH {RATES} SELECT {KEYS}, t, round(rate * 60, 9) AS per_minute FROM rates",
)
def _(spark, sf):
    return rounded(c.per_minute(_samples(spark, sf), SERIES, WINDOW_S, HOUR_S), 9)


@query(
    "request_rate_by_endpoint",
    f"WITH {RATES} SELECT endpoint, t, round(sum(rate), 9) AS rate FROM rates GROUP BY endpoint, t",
)
def _(spark, sf):
    return rounded(c.sum_by(_rates(spark, sf), ["endpoint"]), 9)


@query(
    "request_rate_by_status",
    f"WITH {RATES} SELECT status, t, round(sum(rate), 9) AS rate FROM rates GROUP BY status, t",
)
def _(spark, sf):
    return rounded(c.sum_by(_rates(spark, sf), ["status"]), 9)


@query("server_error_rate", f"WITH {RATES} SELECT {KEYS}, t, round(rate, 9) AS rate FROM rates WHERE status LIKE '5__'")
def _(spark, sf):
    return rounded(c.matching(_rates(spark, sf), "status", "5.."), 9)


@query(
    "status_class_rates",
    f"""WITH {RATES} SELECT t, round(coalesce(sum(rate) FILTER (status LIKE '2__'), 0.0), 9) AS rate_2xx,
  round(coalesce(sum(rate) FILTER (status LIKE '4__'), 0.0), 9) AS rate_4xx,
  round(coalesce(sum(rate) FILTER (status LIKE '5__'), 0.0), 9) AS rate_5xx FROM rates GROUP BY t""",
)
def _(spark, sf):
    return rounded(c.status_class_rates(_rates(spark, sf)), 9)


ERR = "round(sum(CASE WHEN status LIKE '5__' THEN rate ELSE 0.0 END) / nullif(sum(rate), 0) * 100, 6) AS error_percent"


@query("error_percentage", f"WITH {RATES} SELECT t, {ERR} FROM rates GROUP BY t")
def _(spark, sf):
    return rounded(c.error_percentage(_rates(spark, sf)))


@query(
    "error_percentage_by_method",
    f"WITH {RATES} SELECT method, t, {ERR} FROM rates GROUP BY method, t",
)
def _(spark, sf):
    return rounded(c.error_percentage(_rates(spark, sf), ["method"]))


EDGE_LIST = ", ".join(f"({e}::DOUBLE)" for e in EDGES) + ", ('inf'::DOUBLE)"
HIST = f"""{t.REQUESTS}, edges(le) AS (VALUES {EDGE_LIST}), per AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) + INTERVAL 10 MINUTE AS ts, endpoint, le,
         count(*) FILTER (duration_s <= le) AS n FROM requests, edges GROUP BY ALL), samples AS (
  SELECT ts, endpoint, le, CAST(sum(n) OVER (PARTITION BY endpoint, le, time_bucket(INTERVAL '1 day', ts) ORDER BY ts) AS DOUBLE) AS value
  FROM per)"""


def _histogram(spark, sf):
    return c.histogram_samples(
        telemetry.requests(spark, sf), ["endpoint"], "duration_s", EDGES, "ts", SCRAPE_S, DAY_S
    )


@query("histogram_samples", f"WITH {HIST} SELECT * FROM samples")
def _(spark, sf):
    return _histogram(spark, sf)


HRATES = f"{HIST}, {increase_sql('endpoint, le')}, hr AS (SELECT endpoint, t, le, increase / {WINDOW_S}.0 AS rate FROM grown)"


def quantile_sql(q: float, name: str, keys: str = "endpoint, t", source: str = "hr", value: str = "rate") -> str:
    return f"""{name}_c AS (SELECT *, max({value}) OVER (PARTITION BY {keys} ORDER BY le) AS c FROM {source}), {name}_b AS (
  SELECT *, coalesce(lag(c) OVER w, 0.0) AS below, coalesce(lag(le) OVER w, 0.0) AS lower_edge,
    max(c) FILTER (le = 'inf') OVER (PARTITION BY {keys}) AS total, max(le) FILTER (le < 'inf') OVER (PARTITION BY {keys}) AS last_edge
  FROM {name}_c WINDOW w AS (PARTITION BY {keys} ORDER BY le)), {name} AS (
  SELECT {keys}, arg_min(CASE WHEN le = 'inf' THEN last_edge
      ELSE lower_edge + (le - lower_edge) * coalesce(({q} * total - below) / nullif(c - below, 0), 0.0) END, le) AS quantile
  FROM {name}_b WHERE total > 0 AND c >= {q} * total GROUP BY {keys})"""


def _quantile(q: float, label: str) -> None:
    @query(
        f"latency_{label}",
        f"WITH {HRATES}, {quantile_sql(q, 'q')} SELECT endpoint, t, round(quantile, 6) AS quantile FROM q",
    )
    def _(spark, sf):
        rates = c.rate(_histogram(spark, sf), ["endpoint", "le"], WINDOW_S, HOUR_S)
        return rounded(c.histogram_quantile(rates, ["endpoint"], q))


for _q, _label in [(0.5, "p50"), (0.95, "p95"), (0.99, "p99"), (0.999, "p999")]:
    _quantile(_q, _label)


@query(
    "histogram_buckets",
    f"""WITH {t.REQUESTS}, edges(le) AS (VALUES {EDGE_LIST})
SELECT method, endpoint, le, count(*) FILTER (duration_s <= le) AS count FROM requests, edges GROUP BY ALL""",
)
def _(spark, sf):
    return c.bucket_counts(telemetry.requests(spark, sf), ["method", "endpoint"], "duration_s", EDGES)


SUMS = f"""{t.REQUESTS}, {counter_sql('endpoint')}, {increase_sql('endpoint')}, sums AS (
  SELECT ts, endpoint, sum(v) OVER (PARTITION BY endpoint, time_bucket(INTERVAL '1 day', ts) ORDER BY ts) AS value FROM (
    SELECT time_bucket(INTERVAL '10 minutes', ts) + INTERVAL 10 MINUTE AS ts, endpoint, sum(duration_s) AS v FROM requests GROUP BY ALL)),
{increase_sql('endpoint', 'sums', name='summed')}, means AS (
  SELECT g.endpoint, g.t, (s.increase / {WINDOW_S}.0) / nullif(g.increase / {WINDOW_S}.0, 0) AS mean
  FROM grown g JOIN summed s ON s.endpoint = g.endpoint AND s.t = g.t)"""


def _means(spark, sf):
    r = telemetry.requests(spark, sf)
    sums = c.value_sum_samples(r, ["endpoint"], "duration_s", "ts", SCRAPE_S, DAY_S)
    return c.mean_from_sums(
        c.rate(sums, ["endpoint"], WINDOW_S, HOUR_S), _rates(spark, sf, ["endpoint"]), ["endpoint"]
    )


@query("mean_latency", f"WITH {SUMS} SELECT endpoint, t, round(mean, 9) AS mean FROM means")
def _(spark, sf):
    return rounded(_means(spark, sf), 9)


@query(
    "latency_against_earlier",
    f"""WITH {SUMS} SELECT n.endpoint, n.t, round(n.mean, 9) AS now, round(e.mean, 9) AS earlier, n.mean > e.mean * 1.5 AS exceeds
FROM means n JOIN means e ON e.endpoint = n.endpoint AND n.t = e.t + INTERVAL 1 HOUR""",
)
def _(spark, sf):
    return rounded(c.against_earlier(_means(spark, sf), ["endpoint"], "mean", HOUR_S, 1.5), 9)


@query(
    "latency_gauge",
    f"WITH {t.REQUESTS} SELECT endpoint, round(avg(duration_s), 6) AS avg, round(max(duration_s), 6) AS max FROM requests GROUP BY endpoint",
)
def _(spark, sf):
    r = telemetry.requests(spark, sf)
    return rounded(c.gauge_stats(r, ["endpoint"], "duration_s"))


@query(
    "apdex",
    f"""WITH {t.REQUESTS} SELECT endpoint, round((count(*) FILTER (duration_s <= 0.2)
  + (count(*) FILTER (duration_s <= 1.0) - count(*) FILTER (duration_s <= 0.2)) * 0.5) / count(*), 6) AS apdex
FROM requests GROUP BY endpoint""",
)
def _(spark, sf):
    return rounded(c.apdex(telemetry.requests(spark, sf), ["endpoint"], "duration_s"))


@query(
    "slow_requests",
    f"""WITH {t.REQUESTS} SELECT endpoint, round(count(*) FILTER (duration_s > 0.5) / count(*), 6) AS above_500ms,
  round(count(*) FILTER (duration_s > 1.0) / count(*), 6) AS above_1s FROM requests GROUP BY endpoint""",
)
def _(spark, sf):
    limits = {"above_500ms": 0.5, "above_1s": 1.0}
    return rounded(c.slow_share(telemetry.requests(spark, sf), ["endpoint"], "duration_s", limits))


@query(
    "ratio_metrics",
    f"""WITH {t.METRICS} SELECT node_id, round(count(*) FILTER (cpu_usage < 50) / count(*), 6) AS cache_hit_ratio,
  round(avg(memory_usage) / 100 * 100, 6) AS connection_percent, round(max(requests_per_sec) / 1024 / 1024, 9) AS megabytes
FROM metrics GROUP BY node_id""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    agg = m.groupBy("node_id").agg(
        F.count_if(F.col("cpu_usage") < 50).alias("hits"),
        F.count_if(F.col("cpu_usage") >= 50).alias("misses"),
        F.avg("memory_usage").alias("used"),
        F.max("requests_per_sec").alias("bytes"),
    )
    return agg.select(
        "node_id",
        F.round(c.hit_ratio("hits", "misses"), 6).alias("cache_hit_ratio"),
        F.round(c.used_percent(F.col("used"), F.lit(100)), 6).alias("connection_percent"),
        F.round(c.megabytes("bytes"), 9).alias("megabytes"),
    )


def hold_sql(source: str, keys: str, condition: str, hold_s: int, step_s: int) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    key = f"{keys}, " if keys else ""
    return f"""on_off AS (SELECT {key}t, coalesce({condition}, false) AS is_on FROM {source}), marks AS (
  SELECT *, CASE WHEN NOT is_on OR coalesce(epoch_us(t) - epoch_us(lag(t) OVER w) > {step_s}000000, false) THEN 1 ELSE 0 END AS br
  FROM on_off WINDOW w AS ({part}ORDER BY t)), isl AS (
  SELECT *, sum(br) OVER ({part}ORDER BY t) AS island FROM marks), spells AS (
  SELECT {key}min(t) AS active_since, max(t) AS active_until FROM isl WHERE is_on GROUP BY {key}island)
SELECT {key}active_since, active_until, active_since + INTERVAL {hold_s} SECOND AS firing_at,
  (epoch_us(active_until) - epoch_us(active_since)) / 1e6 AS held_seconds
FROM spells WHERE epoch_us(active_until) - epoch_us(active_since) >= {hold_s}000000"""


@query(
    "alert_high_error_rate",
    f"""WITH {RATES}, err AS (SELECT t, {ERR} FROM rates GROUP BY t),
{hold_sql('err', '', 'error_percent > 20', 10800, HOUR_S)}""",
)
def _(spark, sf):
    points = rounded(c.error_percentage(_rates(spark, sf)))
    return c.hold_alerts(points, [], F.col("error_percent") > 20, 10_800, HOUR_S)


@query(
    "alert_high_latency",
    f"""WITH {HRATES}, {quantile_sql(0.95, 'q')}, {hold_sql('q', 'endpoint', 'quantile > 0.5', 7200, HOUR_S)}""",
)
def _(spark, sf):
    rates = c.rate(_histogram(spark, sf), ["endpoint", "le"], WINDOW_S, HOUR_S)
    points = c.histogram_quantile(rates, ["endpoint"], 0.95)
    return c.hold_alerts(points, ["endpoint"], F.col("quantile") > 0.5, 7_200, HOUR_S)


@query(
    "alert_high_connections",
    f"""WITH {t.METRICS}, g AS (SELECT node_id, time_bucket(INTERVAL '1 hour', "timestamp") AS t, max(memory_usage) AS v
  FROM metrics GROUP BY ALL), {hold_sql('g', 'node_id', 'v > 40', 3600, HOUR_S)}""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf)
    hours = m.groupBy("node_id", F.window("timestamp", "1 hour").alias("_w")).agg(F.max("memory_usage").alias("v"))
    points = hours.select("node_id", F.col("_w.start").alias("t"), "v")
    return c.hold_alerts(points, ["node_id"], F.col("v") > 40, 3_600, HOUR_S)


@query(
    "alert_memory_growth",
    f"""WITH {t.METRICS}, g AS (SELECT node_id, time_bucket(INTERVAL '1 hour', "timestamp") AS t, avg(memory_usage) AS v
  FROM metrics GROUP BY ALL), growth AS (SELECT node_id, t, v - lag(v) OVER (PARTITION BY node_id ORDER BY t) AS d FROM g),
{hold_sql('growth', 'node_id', 'd > 0', 3600, HOUR_S)}""",
)
def _(spark, sf):
    from pyspark.sql import Window

    m = telemetry.metrics(spark, sf)
    hours = m.groupBy("node_id", F.window("timestamp", "1 hour").alias("_w")).agg(F.avg("memory_usage").alias("v"))
    order = Window.partitionBy("node_id").orderBy("t")
    points = hours.select("node_id", F.col("_w.start").alias("t"), "v").withColumn(
        "d", F.col("v") - F.lag("v").over(order)
    )
    return c.hold_alerts(points, ["node_id"], F.col("d") > 0, 3_600, HOUR_S)


@query(
    "instant_values",
    f"""WITH {BASE} SELECT {KEYS}, ts, value FROM samples
QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY ts DESC) = 1""",
)
def _(spark, sf):
    return c.instant_values(_samples(spark, sf), SERIES)


@query(
    "service_states",
    f"""WITH {t.METRICS} SELECT node_id, "timestamp", CAST(id % 3 AS DOUBLE) AS value,
  ['CLOSED', 'HALF_OPEN', 'OPEN'][CAST(id % 3 AS INT) + 1] AS circuit,
  CASE WHEN id % 3 = 1 THEN 'healthy' ELSE 'degraded' END AS health FROM metrics
QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY "timestamp" DESC) = 1""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf).withColumn("value", (F.col("id") % 3).cast("double"))
    latest = c.instant_values(m, ["node_id"], "timestamp")
    return latest.withColumns(
        {"circuit": c.state_name(F.col("value")), "health": c.health_name(F.col("value"))}
    )


@query(
    "detections_by_type",
    f"""WITH {t.ANOMALIES}, {counter_sql('anomaly_type, metric_name', 'anomalies', 'detected_at')}, latest AS (
  SELECT * FROM samples QUALIFY row_number() OVER (PARTITION BY anomaly_type, metric_name ORDER BY ts DESC) = 1)
SELECT metric_name, sum(value) AS total, round(sum(value) / sum(sum(value)) OVER (), 6) AS share FROM latest GROUP BY metric_name""",
)
def _(spark, sf):
    keys = ["anomaly_type", "metric_name"]
    samples = c.counter_samples(t.anomalies(spark, sf), keys, "detected_at", SCRAPE_S, DAY_S)
    return c.totals_with_share(samples, keys, "metric_name").withColumn("share", F.round("share", 6))


@query(
    "anomaly_increase",
    f"""WITH {t.ANOMALIES}, {counter_sql('anomaly_type, metric_name', 'anomalies', 'detected_at')},
{increase_sql('anomaly_type, metric_name')} SELECT anomaly_type, metric_name, t, increase FROM grown""",
)
def _(spark, sf):
    keys = ["anomaly_type", "metric_name"]
    samples = c.counter_samples(t.anomalies(spark, sf), keys, "detected_at", SCRAPE_S, DAY_S)
    return c.increase(samples, keys, WINDOW_S, HOUR_S)


@query(
    "scaling_decision_rate",
    f"""WITH RECURSIVE {t.SCALING}, {counter_sql('action', 'scaling_events', 'triggered_at')}, {increase_sql('action')}
SELECT action, t, round(increase / {WINDOW_S}.0 * 60, 9) AS per_minute FROM grown""",
)
def _(spark, sf):
    samples = c.counter_samples(t.scaling_events(spark, sf), ["action"], "triggered_at", SCRAPE_S, DAY_S)
    return rounded(c.per_minute(samples, ["action"], WINDOW_S, HOUR_S), 9)


@query(
    "prediction_counter",
    f"""WITH {t.METRICS}, {t.predictions_sql(True)}, {counter_sql('horizon_minutes', 'predictions', 'predicted_at')} SELECT * FROM samples""",
)
def _(spark, sf):
    p = t.predictions(spark, sf, ["node_id"])
    return c.counter_samples(p, ["horizon_minutes"], "predicted_at", SCRAPE_S, DAY_S)


@query(
    "rate_over_range",
    f"""WITH {t.REQUESTS}, {counter_sql('endpoint')}, {increase_sql('endpoint')}
SELECT endpoint, t, round(increase / {WINDOW_S}.0, 9) AS rate FROM grown
WHERE t >= TIMESTAMP '2024-01-08' AND t <= TIMESTAMP '2024-01-15'""",
)
def _(spark, sf):
    return rounded(
        c.rate(
            _samples(spark, sf, ["endpoint"]),
            ["endpoint"],
            WINDOW_S,
            HOUR_S,
            start=datetime(2024, 1, 8),
            end=datetime(2024, 1, 15),
        ),
        9,
    )
