"""Trace analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.skew import ordered_rank

ROOT_NAME = "trace_root"
SLOT_SECONDS = 60.0


def trace_id_from_headers(headers: str) -> Column:
    """Trace id of a header map: W3C traceparent, then custom headers, then a new id."""
    h = F.col(headers)
    parts = F.split(h["traceparent"], "-")
    from_parent = F.when((h["traceparent"] != "") & (F.size(parts) >= 2), parts[1])
    given = lambda name: F.nullif(h[name], F.lit(""))
    return F.coalesce(from_parent, given("x-trace-id"), given("x-correlation-id"), F.uuid())


def duration_ms(as_of: float) -> Column:
    """Span duration; open spans are measured up to ``as_of`` (epoch seconds)."""
    end = F.coalesce(F.nullif(F.col("end_time"), F.lit(0.0)), F.lit(float(as_of)))
    return (end - F.col("start_time")) * 1000


def with_duration(spans: DataFrame, as_of: float) -> DataFrame:
    return spans.withColumn("duration_ms", duration_ms(as_of))


def trace_rollup(spans: DataFrame, as_of: float) -> DataFrame:
    """One row per trace: root, start, duration and request-level span count.

    The root is the earliest span without a parent, or the earliest span.
    """
    order = F.struct(
        F.col("parent_span_id").isNotNull().alias("has_parent"),
        "start_time",
        "span_id",
        "name",
        duration_ms(as_of).alias("duration_ms"),
    )
    return (
        spans.groupBy("trace_id")
        .agg(F.min(order).alias("r"), F.count_if(F.col("name") != ROOT_NAME).alias("span_count"))
        .select(
            "trace_id",
            F.col("r.span_id").alias("root_span_id"),
            F.col("r.start_time").alias("start_time"),
            F.col("r.duration_ms").alias("duration_ms"),
            "span_count",
        )
    )


def export_traces(
    spans: DataFrame, as_of: float, service: str, environment: str, slot_s: float = SLOT_SECONDS
) -> DataFrame:
    """Traces with their spans: one row per span, beside the roll-up of its trace.

    ``position`` counts the spans of a trace from 1 by (start_time, span_id). It is ranked inside slots
    of ``slot_s`` seconds, so that a trace of any size has the same shape and no task holds a whole one.
    """
    heads = trace_rollup(spans, as_of).select(
        "trace_id",
        F.col("start_time").alias("trace_start_time"),
        F.col("duration_ms").alias("trace_duration_ms"),
        "span_count",
    )
    slot = F.coalesce(F.floor(F.col("start_time") / slot_s), F.lit(-1).cast("long"))
    slotted = with_duration(spans, as_of).withColumn("_slot", slot)
    ranked = ordered_rank(slotted, ["trace_id"], "_slot", [F.col("start_time"), F.col("span_id")], "position")
    columns = [c for c in spans.columns if c != "trace_id"]
    return ranked.join(heads, "trace_id").select(
        "trace_id",
        F.lit(service).alias("service"),
        F.lit(environment).alias("environment"),
        "trace_start_time",
        "trace_duration_ms",
        "span_count",
        "position",
        *columns,
        "duration_ms",
    )


def trace_spans(spans: DataFrame, trace_id: str) -> DataFrame:
    return spans.filter(F.col("trace_id") == trace_id)


def find_span(spans: DataFrame, span_id: str) -> DataFrame:
    return spans.filter(F.col("span_id") == span_id)


def tracer_stats(spans: DataFrame) -> DataFrame:
    return spans.agg(F.count("*").alias("active_spans"), F.count_distinct("trace_id").alias("active_traces"))


def expire_spans(spans: DataFrame, as_of: float, older_than_s: float = 3600) -> DataFrame:
    """Spans that stay: open ones, and ended ones not older than the limit."""
    ended = F.coalesce(F.nullif(F.col("end_time"), F.lit(0.0)), F.lit(float("inf")))
    return spans.filter(ended >= as_of - older_than_s)


def error_spans(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("status") == "ERROR")
