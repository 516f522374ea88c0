"""Registered queries: traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators import traces
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

NOW = f"(epoch_us({t.AS_OF}) / 1e6)"
DUR = f"(coalesce(nullif(end_time, 0), {NOW}) - start_time) * 1000"
SPAN_COLS = "name, trace_id, span_id, parent_span_id, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time, status, error"


def _now(spark, sf) -> float:
    from fleetlens.functions.clock import epoch

    return telemetry.events(spark, sf).agg(F.max(epoch("ts"))).first()[0]


def _flat(df):
    return rounded(df.drop("attributes", "events"))


@query("span_durations", f"WITH {t.SPANS} SELECT {SPAN_COLS}, round({DUR}, 3) AS duration_ms FROM spans")
def _(spark, sf):
    out = traces.with_duration(telemetry.spans(spark, sf), _now(spark, sf))
    return _flat(out.withColumn("duration_ms", F.round("duration_ms", 3)))


ROLLUP = f"""rollup AS (SELECT trace_id, arg_min(span_id, (parent_span_id IS NOT NULL, start_time, span_id)) AS root_span_id,
  arg_min(start_time, (parent_span_id IS NOT NULL, start_time, span_id)) AS start_time,
  arg_min({DUR}, (parent_span_id IS NOT NULL, start_time, span_id)) AS duration_ms,
  count(*) FILTER (name <> 'trace_root') AS span_count FROM spans GROUP BY trace_id)"""


@query(
    "trace_rollup",
    f"""WITH {t.SPANS}, {ROLLUP} SELECT trace_id, root_span_id, round(start_time, 6) AS start_time,
  round(duration_ms, 3) AS duration_ms, span_count FROM rollup""",
)
def _(spark, sf):
    out = traces.trace_rollup(telemetry.spans(spark, sf), _now(spark, sf))
    return rounded(out.withColumn("duration_ms", F.round("duration_ms", 3)))


@query(
    "trace_export",
    f"""WITH {t.SPANS}, {ROLLUP}, kept AS (
  SELECT CAST(event_id AS VARCHAR) AS span_id, props FROM events)
SELECT trace_id, 'api' AS service, 'production' AS environment, round(r.start_time, 6) AS trace_start_time,
  round(r.duration_ms, 3) AS trace_duration_ms, span_count,
  row_number() OVER (PARTITION BY trace_id ORDER BY s.start_time, s.span_id) AS position,
  name, s.span_id, parent_span_id, round(s.start_time, 6) AS start_time, round(end_time, 6) AS end_time,
  json_extract_string(props, '$.k') AS attribute_k, status, error,
  round({DUR.replace("start_time", "s.start_time")}, 3) AS duration_ms
FROM spans s JOIN rollup r USING (trace_id) JOIN kept USING (span_id)""",
)
def _(spark, sf):
    out = traces.export_traces(telemetry.spans(spark, sf), _now(spark, sf), "api", "production")
    times = {name: F.round(name, 3) for name in ("duration_ms", "trace_duration_ms")}
    flat = out.withColumn("attribute_k", F.col("attributes")["k"]).drop("attributes")
    return rounded(flat.withColumns(times).withColumn("position", F.col("position").cast("long")))


@query("spans_of_trace", f"WITH {t.SPANS} SELECT {SPAN_COLS} FROM spans WHERE trace_id = '7'")
def _(spark, sf):
    return _flat(traces.trace_spans(telemetry.spans(spark, sf), "7"))


@query("span_lookup", f"WITH {t.SPANS} SELECT {SPAN_COLS} FROM spans WHERE span_id = '42'")
def _(spark, sf):
    return _flat(traces.find_span(telemetry.spans(spark, sf), "42"))


@query("tracer_stats", f"WITH {t.SPANS} SELECT count(*) AS active_spans, count(DISTINCT trace_id) AS active_traces FROM spans")
def _(spark, sf):
    return traces.tracer_stats(telemetry.spans(spark, sf))


@query(
    "spans_kept",
    f"""WITH {t.SPANS} SELECT {SPAN_COLS} FROM spans WHERE end_time IS NULL OR end_time >= {NOW} - 86400""",
)
def _(spark, sf):
    return _flat(traces.expire_spans(telemetry.spans(spark, sf), _now(spark, sf), 86_400))


@query("error_spans", f"WITH {t.SPANS} SELECT {SPAN_COLS} FROM spans WHERE status = 'ERROR'")
def _(spark, sf):
    return _flat(traces.error_spans(telemetry.spans(spark, sf)))


@query(
    "trace_ids_from_headers",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN md5(CAST(event_id AS VARCHAR))
  WHEN event_type = 'view' THEN 'x-' || event_id WHEN event_type = 'error' THEN 'c-' || event_id
  ELSE 'generated' END AS trace_id FROM events""",
)
def _(spark, sf):
    """Headers of each kind built per event; generated ids are shown as such."""
    e = telemetry.events(spark, sf)
    kind, eid = F.col("event_type"), F.col("event_id").cast("string")
    parent = F.concat(F.lit("00-"), F.md5(eid), F.lit("-b7ad6b7169203331-01"))
    headers = F.create_map(
        F.lit("traceparent"), F.when(kind == "click", parent).when(kind == "signup", "malformed").otherwise(""),
        F.lit("x-trace-id"), F.when(kind == "view", F.concat(F.lit("x-"), eid)).otherwise(""),
        F.lit("x-correlation-id"), F.when(kind.isin("view", "error"), F.concat(F.lit("c-"), eid)),
    )
    found = e.select("event_id", headers.alias("headers")).select(
        "event_id", traces.trace_id_from_headers("headers").alias("trace_id")
    )
    made = F.col("trace_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4")
    return found.withColumn("trace_id", F.when(made, "generated").otherwise(F.col("trace_id")))
