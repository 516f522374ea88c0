"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_ts, _s, _d, _i, _l, _b = (
    T.TimestampType(),
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


METRIC_VALUES = ["cpu_usage", "memory_usage", "latency_ms", "requests_per_sec", "disk_usage"]
METRIC_COLUMNS = ["node_id", "timestamp", *METRIC_VALUES]

METRICS = _struct(
    ("node_id", _s, False),
    ("timestamp", _ts, False),
    *[(name, _d, False) for name in METRIC_VALUES],
)
ANOMALIES = _struct(
    ("node_id", _s, False),
    ("detected_at", _ts, False),
    ("anomaly_type", _s, False),
    ("metric_name", _s, False),
    ("metric_value", _d, False),
    ("threshold", _d, True),
    ("anomaly_score", _d, False),
    ("description", _s, True),
)
PREDICTIONS = _struct(
    ("predicted_at", _ts, False),
    ("horizon_minutes", _i, False),
    ("predicted_rps", _d, False),
    ("predicted_cpu", _d, True),
    ("confidence", _d, True),
    ("lower_bound", _d, True),
    ("upper_bound", _d, True),
    ("spike_probability", _d, True),
    ("model_name", _s, True),
)
SCALING_EVENTS = _struct(
    ("triggered_at", _ts, False),
    ("action", _s, False),
    ("prev_replicas", _i, False),
    ("new_replicas", _i, False),
    ("reason", _s, True),
)
ALERTS = _struct(
    ("raised_at", _ts, False),
    ("severity", _s, False),
    ("node_id", _s, True),
    ("alert_type", _s, False),
    ("message", _s, False),
    ("resolved", _b, False),
    ("resolved_at", _ts, True),
)
WORKERS = _struct(
    ("worker_id", _s, False),
    ("container_id", _s, True),
    ("registered_at", _ts, False),
    ("last_heartbeat", _ts, False),
    ("status", _s, False),
)
STREAM_ENTRY = T.MapType(_s, _s)
SPAN_EVENT = _struct(
    ("name", _s, True), ("timestamp", _d, True), ("attributes", T.MapType(_s, _s), True)
)
SPANS = _struct(
    ("name", _s, False),
    ("trace_id", _s, False),
    ("span_id", _s, False),
    ("parent_span_id", _s, True),
    ("start_time", _d, False),
    ("end_time", _d, True),
    ("attributes", T.MapType(_s, _s), True),
    ("events", T.ArrayType(SPAN_EVENT), True),
    ("status", _s, False),
    ("error", _s, True),
)

# One metric of a bulk request; every alias is a nullable field of its own.
INGEST_REQUEST = T.StructType(
    [
        T.StructField(name, _d if name not in ("node_id", "timestamp") else _s)
        for name in [
            "node_id",
            "cpu_usage",
            "cpu",
            "memory_usage",
            "memory",
            "latency_ms",
            "latency",
            "requests_per_sec",
            "rps",
            "disk_usage",
            "disk",
            "timestamp",
        ]
    ]
)
BULK_REQUEST = T.StructType([T.StructField("metrics", T.ArrayType(INGEST_REQUEST))])

# Columns of a load-test statistics file.
LOAD_STATS = T.StructType(
    [
        T.StructField("Type", _s),
        T.StructField("Name", _s),
        T.StructField("Request Count", _l),
        T.StructField("Failure Count", _l),
        T.StructField("Median Response Time", _d),
        T.StructField("Average Response Time", _d),
        T.StructField("Min Response Time", _d),
        T.StructField("Max Response Time", _d),
        T.StructField("Average Content Size", _d),
        T.StructField("Requests/s", _d),
        T.StructField("Failures/s", _d),
        *[
            T.StructField(f"{p}%", _d)
            for p in ["50", "66", "75", "80", "90", "95", "98", "99", "99.9", "99.99", "100"]
        ],
    ]
)
