"""Registered queries: forecasts, their quality, spike sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators import forecast, spikes
from fleetlens.params import HISTORY_MINUTES
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry


def series_sql(keyed: bool = False, width: str = "5 minutes", minutes: int = HISTORY_MINUTES) -> str:
    key = "node_id, " if keyed else ""
    return f"""{t.METRICS}, series AS (
  SELECT {key}time_bucket(INTERVAL '{width}', "timestamp") AS ds, avg(requests_per_sec) AS y FROM metrics
  WHERE "timestamp" >= {t.AS_OF} - INTERVAL {minutes} MINUTE GROUP BY ALL)"""


def _series(spark, sf, keys=None, width="5 minutes"):
    m = telemetry.metrics(spark, sf)
    return forecast.load_series(m, keys, as_of=t.as_of(spark, sf), width=width)


@query(
    "ema_forecast",
    f"""WITH {series_sql()}, v AS (SELECT list(y ORDER BY ds) AS v FROM series)
SELECT len(v)::INT AS n, round({t.ema_sql('v')}, 6) AS predicted, 0.6::DOUBLE AS confidence FROM v""",
)
def _(spark, sf):
    return rounded(forecast.ema_forecast(_series(spark, sf)))


@query(
    "ema_forecast_by_node",
    f"""WITH {series_sql(True)}, v AS (SELECT node_id, list(y ORDER BY ds) AS v FROM series GROUP BY node_id)
SELECT node_id, len(v)::INT AS n, round({t.ema_sql('v')}, 6) AS predicted, 0.6::DOUBLE AS confidence FROM v""",
)
def _(spark, sf):
    return rounded(forecast.ema_forecast(_series(spark, sf, ["node_id"]), ["node_id"]))


@query(
    "rolling_ema_by_node",
    f"""WITH {t.METRICS}, {t.predictions_sql(True)}
SELECT node_id, ds, round(y, 6) AS y, round({t.ema_sql('v')}, 6) AS predicted FROM rolled""",
)
def _(spark, sf):
    return rounded(forecast.rolling_ema_forecast(t.hourly(spark, sf, ["node_id"]), ["node_id"]))


SEASONAL_SUMS = (
    series_sql()
    + """, base AS (
  SELECT count(*) AS n, max(ds) AS last_ds, (max(epoch_us(ds)) - min(epoch_us(ds))) / 1e6 / 86400 AS training_days,
         regr_slope(y, epoch_us(ds) / 1e6 / 86400) AS slope, regr_intercept(y, epoch_us(ds) / 1e6 / 86400) AS intercept
  FROM series HAVING count(*) >= 2016), rows AS (
  SELECT s.*, intercept + slope * (epoch_us(ds) / 1e6 / 86400) AS trend,
         (epoch_us(ds) // 1000000 % 86400) // 300 AS slot, (epoch_us(ds) // 1000000 // 86400) % 7 AS dow
  FROM series s, base), daily AS (
  SELECT slot, coalesce(sum(y) / nullif(sum(trend), 0), 1.0) AS daily FROM rows GROUP BY slot), weekly AS (
  SELECT dow, coalesce(sum(y) / nullif(sum(trend * daily), 0), 1.0) AS weekly
  FROM rows JOIN daily USING (slot) GROUP BY dow), spread AS (
  SELECT stddev_samp(y - trend * daily * weekly) AS sigma
  FROM rows JOIN daily USING (slot) JOIN weekly USING (dow)), recent AS (
  SELECT * FROM series ORDER BY ds DESC LIMIT 288), newest AS (
  SELECT arg_max(y, ds) AS current_value, list(y ORDER BY ds DESC)[2] AS previous_value,
         coalesce(stddev_samp(y), 0.0) AS recent_std FROM recent), future AS (
  SELECT step, last_ds + step * INTERVAL 5 MINUTE AS target, base.*, newest.*, sigma
  FROM base, newest, spread, range(1, 13) AS r(step)), ahead AS (
  SELECT f.*, intercept + slope * (epoch_us(target) / 1e6 / 86400) AS trend,
         (intercept + slope * (epoch_us(target) / 1e6 / 86400)) * coalesce(daily, 1.0) * coalesce(weekly, 1.0) AS p,
         coalesce(sigma, 0.0) * 1.96 AS margin
  FROM future f LEFT JOIN daily ON slot = (epoch_us(target) // 1000000 % 86400) // 300
  LEFT JOIN weekly ON dow = (epoch_us(target) // 1000000 // 86400) % 7)"""
)

# the same with factors that are means of ratios
SEASONAL = SEASONAL_SUMS.replace("sum(y) / nullif(sum(trend), 0)", "avg(y / nullif(trend, 0))").replace(
    "sum(y) / nullif(sum(trend * daily), 0)", "avg(y / nullif(trend, 0) / nullif(daily, 0))"
)


@query(
    "seasonal_forecast_hour",
    f"""WITH {SEASONAL_SUMS} SELECT (step * 5)::INT AS time_offset_minutes, target, round(p, 6) AS predicted_value,
  round(p - margin, 6) AS lower_bound, round(p + margin, 6) AS upper_bound, round(trend, 6) AS trend,
  round(current_value, 6) AS current_value, round(previous_value, 6) AS previous_value,
  round(recent_std, 6) AS recent_std, n, round(training_days, 6) AS training_days FROM ahead""",
)
def _(spark, sf):
    return rounded(forecast.seasonal_forecast(_series(spark, sf), horizon_minutes=60, factors="sum"))


CARD = """round(p, 2) AS predicted_value, round(current_value, 2) AS current_value, round(p - margin, 2) AS lower_bound,
  round(p + margin, 2) AS upper_bound, round((p + margin) - (p - margin), 2) AS margin_of_error,
  CASE WHEN p > current_value THEN 'increasing' ELSE 'decreasing' END AS trend,
  round((p - previous_value) / (previous_value + 1e-6), 3) AS trend_value,
  round(CASE WHEN p + margin > current_value * 1.5 THEN greatest(0.0, least(1.0,
    (p + margin - current_value * 1.5) / (current_value + 1e-6) / 2)) ELSE 0.0 END, 2) AS spike_probability,
  round(greatest(0.3, least(0.95, CASE WHEN recent_std > 0
    THEN 1.0 / (1.0 + ((p + margin) - (p - margin)) / (recent_std + 1e-6)) ELSE 0.9 END)), 2) AS confidence"""


@query(
    "forecast_card",
    f"""WITH {SEASONAL_SUMS}, one AS (SELECT *, (p - current_value) / current_value * 100 AS change FROM ahead WHERE step = 2)
SELECT {CARD}, CASE WHEN current_value = 0 THEN ''
    WHEN change > 100 THEN printf('⚠️ SPIKE ALERT: %.0f%% increase predicted', abs(change))
    WHEN change > 50 THEN printf('⚠️ SURGE: %.0f%% increase detected', abs(change))
    WHEN change < -50 THEN printf('⚠️ DROP ALERT: %.0f%% decrease predicted', abs(change)) ELSE '' END AS warning
FROM one""",
)
def _(spark, sf):
    return forecast.next_10_minutes(_series(spark, sf), factors="sum")


@query(
    "forecast_best_model",
    f"""WITH {SEASONAL}, card AS (SELECT {CARD} FROM ahead WHERE step = 2)
SELECT 'fleet' AS series, {t.AS_OF} AS predicted_at, 10 AS horizon_minutes, predicted_value AS predicted_rps,
  CAST(NULL AS DOUBLE) AS predicted_cpu, confidence, lower_bound, upper_bound, spike_probability,
  'prophet_lstm' AS model_name FROM card""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    series = _series(spark, sf).withColumn("series", F.lit("fleet"))
    out = forecast.predict(series, None, ["series"], now)
    return out.withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))


@query("forecast_best_model_by_node")
def _(spark, sf):
    """Every node from the model its history allows."""
    now = t.as_of(spark, sf)
    series = _series(spark, sf, ["node_id"], "30 minutes")
    return forecast.predict(series, None, ["node_id"], now)


@query("arima_forecast_by_node")
def _(spark, sf):
    return forecast.arima_forecast(_series(spark, sf, ["node_id"], "1 hour"), ["node_id"])


@query(
    "model_choice",
    f"""WITH {t.METRICS}, counts AS (
  SELECT node_id, width_s, count(DISTINCT epoch_us("timestamp") // (width_s::BIGINT * 1000000)) AS n
  FROM metrics, (VALUES (300), (21600), (2592000)) w(width_s) GROUP BY ALL)
SELECT node_id, width_s, n, CASE WHEN n >= 2016 THEN 'prophet_lstm' WHEN n >= 8 THEN 'arima_fallback'
  WHEN n >= 1 THEN 'ema_fallback' ELSE 'insufficient_data' END AS model_name FROM counts""",
)
def _(spark, sf):
    """The model that each node's history allows at three bucket widths."""
    widths = F.explode(F.array(F.lit(300), F.lit(21_600), F.lit(2_592_000))).alias("width_s")
    buckets = telemetry.metrics(spark, sf).select("node_id", F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("_s"), widths)
    buckets = buckets.select("node_id", "width_s", F.floor(F.col("_s") / F.col("width_s")).alias("_b")).distinct()
    counts = buckets.groupBy("node_id", "width_s").agg(F.count("*").alias("n"))
    return forecast.choose_model(counts, ["node_id", "width_s"])


@query(
    "models_due_for_training",
    f"""WITH {t.METRICS}, cut AS (SELECT node_id, "timestamp", time_bucket(INTERVAL '5 minutes', "timestamp") AS b FROM metrics),
counts AS (
  SELECT node_id, count(DISTINCT b) AS n FROM cut GROUP BY 1
  UNION ALL SELECT 'fleet', count(DISTINCT b) FROM cut), reg AS (
  SELECT node_id, min("timestamp") + INTERVAL 710 HOUR + CAST(right(node_id, 1) AS INT) * 2 * INTERVAL 1 HOUR AS trained_at
  FROM cut GROUP BY node_id)
SELECT c.node_id, n, trained_at, (trained_at IS NULL OR epoch_us({t.AS_OF}) - epoch_us(trained_at) >= 21600000000)
  AND n >= 2016 AS retrain FROM counts c LEFT JOIN reg r ON r.node_id = c.node_id""",
)
def _(spark, sf):
    """Every node's series and the fleet's, which has no fitted model yet."""
    m = telemetry.metrics(spark, sf)
    buckets = m.select("node_id", F.window("timestamp", "5 minutes").alias("_w")).distinct()
    fleet = buckets.select("_w").distinct().agg(F.lit("fleet").alias("node_id"), F.count("*").alias("n"))
    counts = buckets.groupBy("node_id").agg(F.count("*").alias("n")).unionByName(fleet)
    shift = F.expr("make_dt_interval(0, 710 + CAST(right(node_id, 1) AS INT) * 2)")
    registry = m.groupBy("node_id").agg(F.min("timestamp").alias("_first"))
    registry = registry.select("node_id", (F.col("_first") + shift).alias("trained_at"))
    return forecast.needs_training(counts, registry, ["node_id"], t.as_of(spark, sf))


@query(
    "forecast_against_actual",
    f"""WITH {t.METRICS}, {t.predictions_sql(True)}, actuals AS (
  SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS target, avg(requests_per_sec) AS actual
  FROM metrics GROUP BY ALL)
SELECT p.node_id, predicted_at, p.predicted_at + INTERVAL 10 MINUTE AS target, predicted_rps, round(actual, 6) AS actual
FROM predictions p LEFT JOIN actuals a ON a.node_id = p.node_id AND a.target = predicted_at + INTERVAL 10 MINUTE""",
)
def _(spark, sf):
    from fleetlens.operators.summaries import resample_mean

    keys = ["node_id"]
    observed = resample_mean(telemetry.metrics(spark, sf), "timestamp", "requests_per_sec", keys)
    pairs = forecast.against_actual(t.predictions(spark, sf, keys), observed, keys)
    return rounded(pairs.select("node_id", "predicted_at", "target", "predicted_rps", "actual"))


@query(
    "forecast_mape_by_node",
    f"""WITH {t.METRICS}, {t.predictions_sql(True)}, actuals AS (
  SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS target, avg(requests_per_sec) AS actual
  FROM metrics GROUP BY ALL)
SELECT p.node_id, round(avg(abs((actual - predicted_rps) / (actual + 1e-6))) * 100, 6) AS mape
FROM predictions p LEFT JOIN actuals a ON a.node_id = p.node_id AND a.target = predicted_at + INTERVAL 10 MINUTE
GROUP BY p.node_id""",
)
def _(spark, sf):
    from fleetlens.operators.summaries import resample_mean

    keys = ["node_id"]
    observed = resample_mean(telemetry.metrics(spark, sf), "timestamp", "requests_per_sec", keys)
    pairs = forecast.against_actual(t.predictions(spark, sf, keys), observed, keys)
    return rounded(forecast.mape(pairs, keys))


SEQ = f"""{series_sql(True, '1 hour')}, newest AS (SELECT * FROM series
  QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY ds DESC) <= 288), lists AS (
  SELECT node_id, list(y ORDER BY ds) AS v FROM newest GROUP BY node_id), seqs AS (
  SELECT node_id, list_concat(list_transform(range(288 - len(v)), lambda i: v[1]), v) AS seq FROM lists), moments AS (
  SELECT node_id, seq, list_sum(seq) / 288 AS m,
         sqrt(list_sum(list_transform(seq, lambda x: (x - list_sum(seq) / 288) * (x - list_sum(seq) / 288))) / 288) AS s
  FROM seqs)"""


def _seqs(spark, sf):
    return spikes.sequences(_series(spark, sf, ["node_id"], "1 hour"), ["node_id"])


@query(
    "sequences_normalised",
    f"""WITH {SEQ}, z AS (SELECT node_id, seq, list_transform(seq, lambda x: (x - m) / CASE WHEN s < 1e-6 THEN 1.0 ELSE s END) AS z
  FROM moments)
SELECT node_id, (pos - 1)::INT AS pos, round(seq[pos], 9) AS y, round(z[pos], 9) AS z FROM z, range(1, 289) AS r(pos)""",
)
def _(spark, sf):
    z = spikes.z_normalise(_seqs(spark, sf))
    pairs = F.posexplode(F.arrays_zip("seq", "z")).alias("pos", "p")
    return rounded(z.select("node_id", pairs).select("node_id", "pos", F.col("p.seq").alias("y"), F.col("p.z").alias("z")), 9)


@query(
    "sequence_features",
    f"""WITH {SEQ}, z AS (SELECT node_id, seq, list_transform(seq, lambda x: (x - m) / CASE WHEN s < 1e-6 THEN 1.0 ELSE s END) AS z
  FROM moments)
SELECT node_id, round(list_sum(z[151:288]) / 138 - list_sum(z[1:150]) / 150, 6) AS level_shift,
  round((list_sum(seq[151:288]) / 138) / (list_sum(seq[1:150]) / 150), 6) AS tail_ratio,
  round(list_max(z), 6) AS max_z,
  round(list_sum(list_transform(range(1, 288), lambda i: z[i] * z[i + 1])) / 287, 6) AS lag1 FROM z""",
)
def _(spark, sf):
    return rounded(spikes.sequence_features(_seqs(spark, sf)).drop("seq"))


def _day_seqs(spark, sf):
    """Every node's load shape, day by day."""
    keys = ["node_id", "day"]
    daily = telemetry.metrics(spark, sf).withColumn("day", F.to_date("timestamp"))
    series = daily.groupBy(*keys, F.window("timestamp", "5 minutes").alias("_w")).agg(F.avg("requests_per_sec").alias("y"))
    return spikes.sequences(series.select(*keys, F.col("_w.start").alias("ds"), "y"), keys)


@query("spike_classifier_quality")
def _(spark, sf):
    """Fit on three quarters of the planted day shapes, judge on the rest; the model goes through its table."""
    keys = ["node_id", "day"]
    planted = spikes.plant_spikes(_day_seqs(spark, sf), keys)
    held_out = F.pmod(F.xxhash64(*keys, F.lit("split")), F.lit(4)) == 0
    model = spikes.fit_spike_model(planted.where(~held_out), "all", t.as_of(spark, sf))
    scored = spikes.score_with_models(planted.where(held_out).withColumn("model", F.lit("all")), model, "model")
    return spikes.classifier_quality(scored)


def _features_sql(source: str, keys: str) -> str:
    """Features of edge-padded sequences in ``source`` (keys, v)."""
    return f"""(SELECT {keys}, list_sum(z[151:288]) / 138 - list_sum(z[1:150]) / 150 AS f1,
    coalesce((list_sum(seq[151:288]) / 138) / nullif(list_sum(seq[1:150]) / 150, 0), 1.0) AS f2, list_max(z) AS f3,
    list_sum(list_transform(range(1, 288), lambda i: z[i] * z[i + 1])) / 287 AS f4
  FROM (SELECT *, list_transform(seq, lambda x: (x - m) / CASE WHEN s < 1e-6 THEN 1.0 ELSE s END) AS z
    FROM (SELECT *, sqrt(list_sum(list_transform(seq, lambda x: (x - m) * (x - m))) / 288) AS s
      FROM (SELECT *, list_sum(seq) / 288 AS m
        FROM (SELECT *, list_concat(list_transform(range(288 - len(v)), lambda i: v[1]), v) AS seq FROM {source})))))"""


MODELS_SQL = "count(*) AS n_rows, " + ", ".join(f"avg(f{i}) AS m{i}, coalesce(stddev_samp(f{i}), 0) AS s{i}" for i in range(1, 5))
MARGIN = f"{spikes.PRIOR_INTERCEPT}::DOUBLE" + "".join(
    f" + CASE WHEN s{i} > 0 THEN (f{i} - m{i}) / s{i} * {w}::DOUBLE ELSE 0 END"
    for i, w in enumerate(spikes.PRIOR_WEIGHTS, 1)
)


@query(
    "spike_scores_by_node",
    f"""WITH {t.METRICS}, buckets AS (
  SELECT node_id, CAST("timestamp" AS DATE) AS day, time_bucket(INTERVAL '5 minutes', "timestamp") AS ds, avg(requests_per_sec) AS y
  FROM metrics GROUP BY ALL), days AS (
  SELECT node_id, day, list(y ORDER BY ds) AS v FROM buckets GROUP BY ALL), models AS (
  SELECT node_id, date_trunc('week', day) + INTERVAL 7 DAY AS trained_at, {MODELS_SQL}
  FROM {_features_sql('days', 'node_id, day')} GROUP BY ALL), newest AS (
  SELECT * FROM models WHERE trained_at <= {t.AS_OF} QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY trained_at DESC) = 1),
last_day AS (SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY day DESC) = 1)
SELECT node_id, day, trained_at, n_rows, round(1 / (1 + exp(-({MARGIN}))), 6) AS spike_probability
FROM {_features_sql('last_day', 'node_id, day')} JOIN newest USING (node_id)""",
)
def _(spark, sf):
    """Weekly model versions per node; the newest day is scored by the newest version trained by then."""
    seqs = _day_seqs(spark, sf)
    week = F.date_trunc("week", "day") + F.expr("INTERVAL 7 DAYS")
    versions = spikes.prior_models(spikes.sequence_features(seqs), F.col("node_id"), week)
    newest = spikes.models_as_of(versions, t.as_of(spark, sf))
    last = seqs.groupBy("node_id").agg(F.max_by(F.struct("day", "seq"), "day").alias("_d")).select("node_id", "_d.*")
    scored = spikes.score_with_models(last, newest, "node_id")
    size = newest.select(F.col("model_key").alias("node_id"), "n_rows")
    out = scored.join(size, "node_id").withColumn("trained_at", F.col("trained_at").cast("timestamp_ntz"))
    return rounded(out.select("node_id", "day", "trained_at", "n_rows", "spike_probability"))


CASCADE_FLEET = SEASONAL_SUMS.replace("series AS (", "series AS MATERIALIZED (", 1)


@query(
    "forecast_cascade",
    f"""WITH {CASCADE_FLEET}, buckets AS (
  SELECT CAST("timestamp" AS DATE) AS day, time_bucket(INTERVAL '5 minutes', "timestamp") AS ds, avg(requests_per_sec) AS y
  FROM metrics GROUP BY ALL), days AS (SELECT day, list(y ORDER BY ds) AS v FROM buckets GROUP BY day), model AS (
  SELECT {MODELS_SQL} FROM {_features_sql('days', 'day')}), newest_seq AS (
  SELECT 1 AS one, list(y ORDER BY ds) AS v FROM recent), score AS (
  SELECT 1 / (1 + exp(-({MARGIN}))) AS odds FROM {_features_sql('newest_seq', 'one')}, model), card AS (
  SELECT {CARD} FROM ahead WHERE step = 2), failed AS (
  SELECT 'errors-' || CAST(user_id AS VARCHAR) AS scope, time_bucket(INTERVAL '5 minutes', ts) AS ds, avg(50 + value * 2.5) AS y
  FROM events WHERE event_type = 'error' AND ts >= {t.AS_OF} - INTERVAL {HISTORY_MINUTES} MINUTE GROUP BY ALL), lists AS (
  SELECT scope, list(y ORDER BY ds) AS v FROM failed GROUP BY scope), users AS (
  SELECT DISTINCT 'errors-' || CAST(user_id AS VARCHAR) AS scope FROM events), low AS (
  SELECT scope, coalesce(len(v), 0) AS n, round({t.ema_sql('v')}, 2) AS p FROM users LEFT JOIN lists USING (scope))
SELECT 'fleet' AS scope, 10 AS horizon_minutes, predicted_value AS predicted_rps, confidence, lower_bound, upper_bound,
  round(odds, 3) AS spike_probability, 'prophet_lstm' AS model_name FROM card, score
UNION ALL SELECT scope, 10, CASE WHEN n > 0 THEN p ELSE 0.0 END, CASE WHEN n > 0 THEN 0.6 ELSE 0.0 END,
  CASE WHEN n > 0 THEN p ELSE 0.0 END, CASE WHEN n > 0 THEN p ELSE 0.0 END, 0.0,
  CASE WHEN n > 0 THEN 'ema_fallback' ELSE 'insufficient_data' END FROM low WHERE n < 8""",
)
def _(spark, sf):
    """The whole cascade: the fleet with the classifier's probability, each user's failed requests below it.

    Rows of the autoregressive model are left to ``forecast_best_model_by_node``; SQL has no counterpart for them.
    """
    now = t.as_of(spark, sf)
    events = telemetry.events(spark, sf)
    errors = F.concat(F.lit("errors-"), F.col("user_id").cast("string"))
    scopes = F.array_compact(F.array(F.lit("fleet"), F.when(F.col("event_type") == "error", errors)))
    load = events.select(F.col("ts").alias("timestamp"), (F.lit(50) + F.col("value") * 2.5).alias("requests_per_sec"), F.explode(scopes).alias("scope"))
    series = forecast.load_series(load, ["scope"], as_of=now)
    wanted = events.select(F.explode(F.array(F.lit("fleet"), errors)).alias("scope")).distinct()
    days = telemetry.metrics(spark, sf).groupBy(F.to_date("timestamp").alias("day"), F.window("timestamp", "5 minutes").alias("_w"))
    days = days.agg(F.avg("requests_per_sec").alias("y")).select("day", F.col("_w.start").alias("ds"), "y")
    fleet = spikes.sequence_features(spikes.sequences(days, ["day"]))
    models = spikes.prior_models(fleet, F.lit("fleet"), F.lit(now))
    newest = spikes.sequences(series.where("scope = 'fleet'"), ["scope"])
    scores = spikes.score_with_models(newest, models, "scope")
    out = forecast.predict(series, wanted, ["scope"], now, spike_scores=scores, factors="sum")
    return out.where("model_name <> 'arima_fallback'").drop("predicted_at", "predicted_cpu")


@query(
    "detector_quality",
    f"""WITH {t.METRICS}, c AS (SELECT node_id, count(*) FILTER (s > 0.5 AND failed) AS tp, count(*) FILTER (s > 0.5 AND NOT failed) AS fp,
  count(*) FILTER (NOT s > 0.5 AND failed) AS fn, count(*) FILTER (NOT s > 0.5 AND NOT failed) AS tn
  FROM (SELECT node_id, least(value / 100, 1.0) AS s, event_type = 'error' AS failed FROM metrics JOIN events ON id = event_id)
  GROUP BY node_id)
SELECT *, round(coalesce(tp / (tp + fp), 0.0), 6) AS "precision", round(coalesce(tp / (tp + fn), 0.0), 6) AS recall,
  round(coalesce(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 0.0), 6) AS f1 FROM c""",
)
def _(spark, sf):
    """How well high values tell the requests that failed, per node."""
    scored = telemetry.events(spark, sf).select(
        F.concat(F.lit("node-"), (F.col("user_id") % 8).cast("string")).alias("node_id"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("spike_probability"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )
    return rounded(spikes.classifier_quality(scored, keys=["node_id"]))
