"""Registered queries: the streaming operators, run to the end of their input.

The events file is the stream's source. Results go to a Parquet table under the
session's checkpoint folder and are read back from there.
"""

from __future__ import annotations

import time as time_module
import uuid

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.plans import admission_queries as adm
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.session import STATE_STORE, checkpoint_dir, ensure_utc
from fleetlens.sources import telemetry
from fleetlens.streaming import detect, stateful, windows
from fleetlens.streaming.ingest import start_ingest, start_table, write_ingest_batch


def _room(spark) -> str:
    ensure_utc(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _run(spark, rows, room=None):
    """Run the stream to the end of its input and read the table of its ``room`` (default: a new one)."""
    room = room or _room(spark)
    start_table(rows, f"{room}/table", f"{room}/offsets", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{room}/table")
    times = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp"]
    return out.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def exact_mean(column: str) -> str:
    """Mean from an exact decimal sum, which no order of the rows changes; to ten digits, where means of values with
    three decimals are no ties."""
    return f"round(CAST(sum(CAST({column} AS DECIMAL(28, 9))) AS DOUBLE) / count({column}), 10)"


@query(
    "stream_load_resampled",
    f"""WITH {t.METRICS} SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS ds,
  round(avg(requests_per_sec), 6) AS y, count(*) AS samples FROM metrics GROUP BY 1, 2
HAVING time_bucket(INTERVAL '5 minutes', any_value("timestamp")) + INTERVAL 5 MINUTE
  <= date_trunc('millisecond', {t.AS_OF}) - INTERVAL 10 MINUTE""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf, streaming=True)
    return rounded(_run(spark, windows.tumbling_mean(m, keys=["node_id"])))


@query(
    "stream_sliding_summary",
    f"""WITH {t.METRICS}, w AS (SELECT *, unnest(range(epoch_us("timestamp") // 3600000000 * 3600000000 - 5 * 3600000000,
    epoch_us("timestamp") // 3600000000 * 3600000000 + 1, 3600000000)) + 6 * 3600000000 AS e FROM metrics)
SELECT make_timestamp(e) AS at, {exact_mean('cpu_usage')} AS avg_cpu, {exact_mean('memory_usage')} AS avg_mem,
  {exact_mean('latency_ms')} AS avg_latency, {exact_mean('requests_per_sec')} AS avg_rps, count(DISTINCT node_id) AS node_count
FROM w GROUP BY e HAVING make_timestamp(e) <= date_trunc('millisecond', {t.AS_OF}) - INTERVAL 10 MINUTE""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf, streaming=True)
    return rounded(_run(spark, windows.sliding_summary(m, "6 hours", "1 hour")), 10)


@query(
    "stream_rule_anomalies",
    f"""WITH {t.FLAGS} SELECT id, node_id, "timestamp" AS detected_at, 'rule_based' AS anomaly_type, metric_name, metric_value,
  threshold, anomaly_score, description FROM flags""",
)
def _(spark, sf):
    return _run(spark, detect.detect(telemetry.metrics(spark, sf, streaming=True)))


@query(
    "stream_alerts",
    f"""WITH {t.ANOMALIES} SELECT id // 10 AS id, detected_at AS raised_at,
  CASE WHEN anomaly_score > 0.8 THEN 'critical' ELSE 'warning' END AS severity, node_id, anomaly_type AS alert_type,
  description AS message FROM anomalies""",
)
def _(spark, sf):
    room = _room(spark)
    detect.start_detector(
        telemetry.metrics(spark, sf, streaming=True),
        f"{room}/anomalies",
        f"{room}/alerts",
        f"{room}/offsets",
        available_now=True,
    ).awaitTermination()
    alerts = spark.read.parquet(f"{room}/alerts")
    return alerts.select(
        "id", F.col("raised_at").cast("timestamp_ntz").alias("raised_at"), "severity", "node_id", "alert_type", "message"
    )


def _ingested(spark, sf):
    """Both tables after the stream has ended and its last batch was written a second time."""
    from fleetlens.plans.registry_queries import damaged_entries

    room = _room(spark)
    entries = damaged_entries(telemetry.metrics(spark, sf, streaming=True)).select("entry")
    for running in start_ingest(entries, f"{room}/metrics", f"{room}/rejects", f"{room}/offsets", available_now=True):
        running.awaitTermination()
    again = damaged_entries(telemetry.metrics(spark, sf)).select("entry")
    write_ingest_batch(again, 0, f"{room}/metrics", f"{room}/rejects")
    return room


@query(
    "stream_ingest",
    f"""WITH {t.METRICS} SELECT node_id, "timestamp", cpu_usage, memory_usage, latency_ms, requests_per_sec, disk_usage
FROM metrics WHERE id % 10 > 1""",
)
def _(spark, sf):
    out = spark.read.parquet(f"{_ingested(spark, sf)}/metrics").drop("date", "batch")
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "stream_ingest_rejects",
    f"""WITH {t.METRICS} SELECT node_id, epoch_us("timestamp")::VARCHAR AS us, id % 10 = 1 AS has_latency,
  CASE WHEN id % 10 = 1 THEN 'n/a' ELSE round(cpu_usage, 6)::VARCHAR END AS cpu, round(memory_usage, 6) AS memory_usage,
  CASE WHEN id % 10 = 1 THEN round(latency_ms, 6) END AS latency_ms, round(requests_per_sec, 6) AS requests_per_sec,
  disk_usage FROM metrics WHERE id % 10 <= 1""",
)
def _(spark, sf):
    """The rejected entries as whole rows, each of their fields read back."""
    fields = "node_id string, timestamp string, cpu_usage string, memory_usage string, latency_ms string, requests_per_sec string, disk_usage string"
    rows = spark.read.schema(f"entry struct<{fields.replace(' string', ': string')}>").json(f"{_ingested(spark, sf)}/rejects")
    e = lambda name: F.col(f"entry.{name}")
    six = lambda name: F.round(e(name).cast("double"), 6)
    cpu = F.when(e("cpu_usage").try_cast("double").isNull(), e("cpu_usage")).otherwise(six("cpu_usage").cast("string"))
    return rows.select(
        e("node_id").alias("node_id"),
        F.rint(e("timestamp").cast("decimal(30,6)") * 1_000_000).cast("long").cast("string").alias("us"),
        e("latency_ms").isNotNull().alias("has_latency"),
        cpu.alias("cpu"),
        *[six(n).alias(n) for n in ("memory_usage", "latency_ms", "requests_per_sec", "disk_usage")],
    )


SLICES, LATE_MINUTES, TTL_S = 4, 10, 43_200


def _sliced(spark, sf, late):
    """The metrics as a stream of ``SLICES`` micro-batches in the order of time: each row whose ``late`` is true
    comes two slices after its own, and every third row comes twice, once in the next slice."""
    room = _room(spark)
    m = telemetry.metrics(spark, sf)
    bounds = m.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    span = (bounds["high"] - bounds["low"]).total_seconds()
    from fleetlens.functions.clock import epoch

    start = m.agg(F.min(epoch("timestamp"))).first()[0]
    own = F.least(F.floor((epoch("timestamp") - start) / span * SLICES), F.lit(SLICES - 1))
    sent = F.when(late & (own < SLICES - 2), F.array(own + 2)).when(
        F.col("id") % 3 == 0, F.array(own, F.least(own + 1, F.lit(SLICES - 1)))
    )
    rows = m.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = rows.withColumn("_slice", F.explode(sent.otherwise(F.array(own))))
    for number in range(SLICES):  # files are read in the order in which they were written
        rows.where(F.col("_slice") == number).drop("_slice").coalesce(1).write.mode("append").parquet(f"{room}/in")
        time_module.sleep(0.05)
    return spark.readStream.schema(rows.drop("_slice").schema).option("maxFilesPerTrigger", 1).parquet(f"{room}/in")


OWN_SLICE = f"""span AS (SELECT min(epoch_us("timestamp")) AS low, max(epoch_us("timestamp")) - min(epoch_us("timestamp")) AS wide FROM metrics),
placed AS (SELECT m.*, least(floor((epoch_us("timestamp") - low) / 1e6 / (wide / 1e6) * {SLICES}), {SLICES - 1}) AS own FROM metrics m, span)"""


@query(
    "stream_late_and_repeated",
    f"""WITH {t.METRICS}, {OWN_SLICE} SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS ds,
  round(avg(requests_per_sec), 6) AS y, count(*) AS samples FROM placed WHERE NOT (id % 7 = 2 AND own < {SLICES - 2}) GROUP BY 1, 2
HAVING time_bucket(INTERVAL '5 minutes', any_value("timestamp")) + INTERVAL 5 MINUTE
  <= date_trunc('millisecond', {t.AS_OF}) - INTERVAL {LATE_MINUTES} MINUTE""",
)
def _(spark, sf):
    """Means over four micro-batches with repeated rows, counted once, and rows too late to count."""
    late = F.col("id") % 7 == 2
    # a row may be repeated one slice later, which is within the span of the data
    rows = _sliced(spark, sf, late).withWatermark("timestamp", f"{LATE_MINUTES} minutes")
    once = rows.dropDuplicates(["node_id", "timestamp"])
    return rounded(_run(spark, windows.tumbling_mean(once, keys=["node_id"], delay=None)))


@query(
    "stream_token_bucket",
    f"""WITH RECURSIVE {t.REQUESTS}, {adm.BUCKET_SQL} SELECT key, id, allowed, CAST(trunc(tokens) AS BIGINT) AS remaining,
  round(CASE WHEN tokens >= 1 THEN 0.0 ELSE (1 - tokens) / refill END, 3) AS reset_after FROM bucket""",
)
def _(spark, sf):
    log = telemetry.requests(spark, sf, streaming=True)
    _room(spark)
    out = _run(spark, stateful.token_bucket(log, adm.BURST, adm.SLOW_RATES, ttl_s=None))
    return out.select("key", "id", "allowed", "remaining", F.round("reset_after", 3).alias("reset_after"))


@query(
    "stream_sliding_window",
    f"""WITH RECURSIVE {t.REQUESTS}, {adm.SLIDING_SQL} SELECT key, id, allowed, greatest(0, lim - len(held))::BIGINT AS remaining
FROM sliding""",
)
def _(spark, sf):
    log = telemetry.requests(spark, sf, streaming=True)
    out = _run(spark, stateful.sliding_window(log, adm.WINDOW, adm.WINDOW_RATES, ttl_s=None))
    return out.select("key", "id", "allowed", "remaining")


UNORDERED_S = 86_400


def _out_of_order(spark, rows, time, judge, key="id"):
    """``judge`` over ``SLICES`` micro-batches in which each row is up to a day late.

    A slice is written by many tasks and read as one micro-batch; the query goes on from its checkpoint.
    """
    from fleetlens.functions.clock import epoch

    room = _room(spark)
    low, high = rows.agg(F.min(epoch(time)), F.max(epoch(time))).first()
    late = F.pmod(F.xxhash64(key), F.lit(UNORDERED_S))
    place = F.floor((epoch(time) + late - low) / ((high - low + UNORDERED_S) or 1) * SLICES)
    placed = rows.withColumn(time, F.col(time).cast("timestamp")).withColumn("_slice", place)
    for number in range(SLICES):
        placed.where(F.col("_slice") == number).drop("_slice").write.mode("append").parquet(f"{room}/in")
        stream = spark.readStream.schema(placed.drop("_slice").schema).parquet(f"{room}/in")
        out = _run(spark, judge(stream), room)
    return out


PASSED = f"CAST(ceil(epoch_us(ts) / 1000) AS BIGINT) <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - {UNORDERED_S}000"
ORDERED_BUCKET_SQL = f"""log AS (SELECT *, epoch_us(ts) / 1e6 AS at_s, endpoint = 'signup' AND id % 20 = 3 AS wipe,
  row_number() OVER (PARTITION BY key ORDER BY ts, id) AS rn FROM requests),
firsts AS (SELECT key, {adm.RATE_SQL} AS refill FROM log WHERE rn = 1), bucket AS (
  SELECT l.key, l.id, l.ts, l.rn, l.at_s, refill, CASE WHEN NOT wipe THEN true END AS allowed,
    CASE WHEN NOT wipe THEN {adm.BURST}::DOUBLE - 1 END AS tokens FROM log l JOIN firsts USING (key) WHERE rn = 1
  UNION ALL
  SELECT key, id, ts, rn, at_s, refill, CASE WHEN NOT wipe THEN level >= 1 END,
    CASE WHEN wipe THEN NULL WHEN level >= 1 THEN level - 1 ELSE level END FROM (
    SELECT n.key, n.id, n.ts, n.rn, n.at_s, n.wipe, b.refill, CASE WHEN b.tokens IS NULL OR n.at_s - b.at_s >= {TTL_S} THEN {adm.BURST}::DOUBLE
      ELSE least({adm.BURST}::DOUBLE, b.tokens + (n.at_s - b.at_s) * b.refill) END AS level
    FROM bucket b JOIN log n ON n.key = b.key AND n.rn = b.rn + 1))"""


@query(
    "stream_token_bucket_in_order",
    f"""WITH RECURSIVE {t.REQUESTS}, {ORDERED_BUCKET_SQL} SELECT key, id, allowed, CAST(trunc(tokens) AS BIGINT) AS remaining
FROM bucket WHERE {PASSED}""",
)
def _(spark, sf):
    """Requests that come up to a day late over four micro-batches, with resets and an idle limit."""
    log = telemetry.requests(spark, sf)
    log = log.withColumn("reset", (F.col("endpoint") == "signup") & (F.col("id") % 20 == 3))
    delay = f"{UNORDERED_S} seconds"
    judge = lambda stream: stateful.token_bucket(stream, adm.BURST, adm.SLOW_RATES, ttl_s=TTL_S, delay=delay)
    out = _out_of_order(spark, log, "ts", judge)
    return out.select("key", "id", "allowed", "remaining")


@query(
    "stream_sliding_window_in_order",
    f"""WITH RECURSIVE {t.REQUESTS}, {adm.SLIDING_SQL.replace("SELECT key, id, role, rn, at_s, lim, true", "SELECT key, id, ts, role, rn, at_s, lim, true").replace("SELECT key, id, role, rn, at_s, lim, len", "SELECT key, id, ts, role, rn, at_s, lim, len").replace("SELECT n.key, n.id, n.role", "SELECT n.key, n.id, n.ts, n.role")}
SELECT key, id, allowed, greatest(0, lim - len(held))::BIGINT AS remaining FROM sliding WHERE {PASSED}""",
)
def _(spark, sf):
    delay = f"{UNORDERED_S} seconds"
    judge = lambda stream: stateful.sliding_window(stream, adm.WINDOW, adm.WINDOW_RATES, delay=delay)
    out = _out_of_order(spark, telemetry.requests(spark, sf), "ts", judge)
    return out.select("key", "id", "allowed", "remaining")


@query(
    "stream_decisions_in_order",
    f"""WITH RECURSIVE {t.OBSERVED_DECISIONS} SELECT node_id, triggered_at, round(action, 6) AS action, is_emergency, prev_replicas, new_replicas
FROM decided WHERE epoch_us(triggered_at) <= (SELECT epoch_us(max(triggered_at)) FROM inputs) - {UNORDERED_S}000000""",
)
def _(spark, sf):
    """The replay's hourly steps as a stream that is up to a day out of order."""
    steps = t.control_inputs(spark, sf).withColumn("workers", F.col("workers").cast("int"))
    delay = f"{UNORDERED_S} seconds"
    judge = lambda stream: stateful.scaling_decisions(stream, ["node_id"], delay=delay)
    out = _out_of_order(spark, steps, "triggered_at", judge, "triggered_at")
    return rounded(out.select("node_id", "triggered_at", "action", "is_emergency", "prev_replicas", "new_replicas"))


LOOP_INPUTS = f"""{t.METRICS}, inputs AS (SELECT *, upper_bound AS predicted_rps, '' AS model_name,
    row_number() OVER (PARTITION BY node_id ORDER BY triggered_at) AS rn FROM (
  SELECT node_id, time_bucket(INTERVAL '1 hour', "timestamp") AS triggered_at, avg(cpu_usage) AS utilization,
    avg(requests_per_sec) AS upper_bound, avg(CASE WHEN latency_ms > 800 THEN 1.0::DOUBLE ELSE 0.0 END) AS spike_probability,
    count(*)::INT AS workers FROM metrics GROUP BY 1, 2)
  WHERE triggered_at + INTERVAL 1 HOUR <= date_trunc('millisecond', {t.AS_OF}) - INTERVAL 10 MINUTE), ordered AS (
  SELECT node_id, triggered_at, utilization, spike_probability, predicted_rps, upper_bound, model_name, workers, rn FROM inputs)"""


@query(
    "stream_scaling_decisions",
    f"""WITH RECURSIVE {LOOP_INPUTS}, {t.decisions_sql(observed=True).replace("FROM inputs", "FROM ordered").replace("JOIN inputs", "JOIN ordered")}
SELECT node_id, triggered_at, round(action, 6) AS action, is_emergency, prev_replicas, new_replicas FROM decided""",
)
def _(spark, sf):
    """Decisions on the stream of closed hourly load windows, one loop per node."""
    m = telemetry.metrics(spark, sf, streaming=True)
    hours = m.withWatermark("timestamp", "10 minutes").groupBy("node_id", F.window("timestamp", "1 hour").alias("_w"))
    steps = hours.agg(
        F.avg("cpu_usage").alias("utilization"),
        F.avg("requests_per_sec").alias("upper_bound"),
        F.avg((F.col("latency_ms") > 800).cast("double")).alias("spike_probability"),
        F.count("*").cast("int").alias("workers"),
    )
    steps = steps.select(
        "node_id", F.col("_w.start").alias("triggered_at"), "utilization", "upper_bound", "spike_probability", "workers"
    )
    out = _run(spark, stateful.scaling_decisions(steps, ["node_id"]))
    return rounded(out.select("node_id", "triggered_at", "action", "is_emergency", "prev_replicas", "new_replicas"))


@query(
    "stream_silent_nodes",
    f"""WITH {t.METRICS} SELECT node_id, date_trunc('millisecond', max("timestamp")) AS last_seen,
  date_trunc('millisecond', max("timestamp")) + INTERVAL 30 MINUTE AS silent_at FROM metrics GROUP BY node_id
HAVING date_trunc('millisecond', max("timestamp")) + INTERVAL 30 MINUTE <= date_trunc('millisecond', {t.AS_OF}) - INTERVAL 1 MINUTE""",
)
def _(spark, sf):
    m = telemetry.metrics(spark, sf, streaming=True)
    return _run(spark, stateful.silent_nodes(m, 1_800))
