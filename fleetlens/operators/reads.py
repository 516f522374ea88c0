"""Filters, newest-first reads, facets and chart series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import instant, resolve_as_of, since
from fleetlens.functions.skew import newest_per_key
from fleetlens.schemas import METRIC_COLUMNS, METRIC_VALUES

ANOMALY_READ = [
    "id", "node_id", "detected_at", "anomaly_type", "metric_name",
    "metric_value", "threshold", "anomaly_score", "description",
]
PREDICTION_READ = [
    "id", "predicted_at", "horizon_minutes", "predicted_rps", "predicted_cpu",
    "confidence", "lower_bound", "upper_bound", "spike_probability", "model_name",
]
SCALING_READ = ["id", "triggered_at", "action", "prev_replicas", "new_replicas", "reason"]
ALERT_READ = ["id", "raised_at", "severity", "node_id", "alert_type", "message", "resolved"]
WORKER_READ = ["worker_id", "container_id", "registered_at", "last_heartbeat", "status"]

MAX_MINUTES = 1440


def _check(name: str, value: int, low: int | None, high: int | None) -> None:
    if low is not None and value < low:
        raise ValueError(f"{name} must be >= {low}, got {value}")
    if high is not None and value > high:
        raise ValueError(f"{name} must be <= {high}, got {value}")


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _newest(df: DataFrame, column: str) -> list[Column]:
    tie = [F.col("id").desc()] if "id" in df.columns else []
    return [F.col(column).desc(), *tie]


def _top(df: DataFrame, column: str, columns: list[str], limit: int) -> DataFrame:
    return df.orderBy(*_newest(df, column)).limit(limit).select(*_present(df, columns))


def lookback(df: DataFrame, column: str, minutes: int, as_of: datetime | None = None) -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``."""
    _check("minutes", minutes, 1, None)
    as_of = resolve_as_of(df, column, as_of)
    if as_of is None:
        return df.limit(0)
    return df.filter(since(df, column, as_of, minutes=minutes))


def get_metrics(
    metrics: DataFrame,
    node_id: str | None = None,
    minutes: int = 30,
    limit: int = 500,
    as_of: datetime | None = None,
) -> DataFrame:
    """Newest metric samples, optionally of one node."""
    _check("minutes", minutes, 1, MAX_MINUTES)
    _check("limit", limit, 0, 5000)
    rows = lookback(metrics, "timestamp", minutes, as_of)
    if node_id:
        rows = rows.filter(F.col("node_id") == node_id)
    return _top(rows, "timestamp", METRIC_COLUMNS, limit)


def get_anomalies(
    anomalies: DataFrame, minutes: int = 60, limit: int = 100, as_of: datetime | None = None
) -> DataFrame:
    _check("minutes", minutes, 1, MAX_MINUTES)
    _check("limit", limit, 0, 1000)
    return _top(lookback(anomalies, "detected_at", minutes, as_of), "detected_at", ANOMALY_READ, limit)


def get_predictions(predictions: DataFrame, limit: int = 20) -> DataFrame:
    _check("limit", limit, 0, 100)
    return _top(predictions, "predicted_at", PREDICTION_READ, limit)


def get_scaling_events(events: DataFrame, limit: int = 50) -> DataFrame:
    _check("limit", limit, 0, 500)
    return _top(events, "triggered_at", SCALING_READ, limit)


def get_alerts(
    alerts: DataFrame,
    minutes: int = 60,
    unresolved_only: bool = False,
    limit: int = 100,
    as_of: datetime | None = None,
) -> DataFrame:
    _check("limit", limit, 0, 500)
    rows = lookback(alerts, "raised_at", minutes, as_of)
    if unresolved_only:
        rows = rows.filter(~F.col("resolved"))
    return _top(rows, "raised_at", ALERT_READ, limit)


def get_workers(workers: DataFrame) -> DataFrame:
    rows = workers.orderBy(F.col("registered_at").desc(), F.col("worker_id"))
    return rows.select(*_present(workers, WORKER_READ))


def filter_anomalies(
    anomalies: DataFrame, node_id: str | None = None, anomaly_type: str | None = None
) -> DataFrame:
    if node_id:
        anomalies = anomalies.filter(F.col("node_id") == node_id)
    if anomaly_type:
        anomalies = anomalies.filter(F.col("anomaly_type") == anomaly_type)
    return anomalies


def filter_severity(alerts: DataFrame, tab: str = "all") -> DataFrame:
    return alerts if tab == "all" else alerts.filter(F.lower("severity") == tab.lower())


def scale_transitions(
    events: DataFrame, start: datetime | None = None, end: datetime | None = None, limit: int = 20
) -> DataFrame:
    """Decisions that changed the replica count, oldest first, then by node."""
    rows = events.filter((F.col("action") != "no_change") & (F.col("prev_replicas") != F.col("new_replicas")))
    if start is not None:
        rows = rows.filter(F.col("triggered_at") >= instant(events, "triggered_at", start))
    if end is not None:
        rows = rows.filter(F.col("triggered_at") <= instant(events, "triggered_at", end))
    ties = [c for c in ("node_id", "prev_replicas", "new_replicas", "reason") if c in events.columns]
    return rows.orderBy("triggered_at", *ties).limit(limit)


def count_by_prefix(metrics: DataFrame, prefix: str) -> DataFrame:
    return metrics.filter(F.col("node_id").startswith(prefix)).agg(F.count("*").alias("rows"))


def purge_invalid(df: DataFrame, column: str = "metric_value") -> DataFrame:
    """Keep-set of the purge of negative values; NULLs are kept as SQL DELETE does."""
    return df.filter(~F.coalesce(F.col(column) < 0, F.lit(False)))


def latest_per_node(
    metrics: DataFrame, minutes: int | None = 2, as_of: datetime | None = None
) -> DataFrame:
    """Newest row of each node inside the lookback; ties go to the larger id."""
    rows = lookback(metrics, "timestamp", minutes, as_of) if minutes else metrics
    return newest_per_key(rows, ["node_id"], _newest(metrics, "timestamp"))


def latest_prediction(predictions: DataFrame) -> DataFrame:
    """One row: the newest forecast, or defaults when there is none.

    A zero upper bound or forecast counts as missing.
    """
    newest = F.max(
        F.struct(
            "predicted_at", *([F.col("id")] if "id" in predictions.columns else []),
            "predicted_rps", "upper_bound", "spike_probability", "confidence", "model_name",
        )
    ).alias("p")
    zero = F.lit(0.0)
    rps, upper = F.col("p.predicted_rps"), F.col("p.upper_bound")
    return predictions.agg(newest).select(
        F.coalesce(rps, zero).alias("predicted_rps"),
        F.coalesce(F.nullif(upper, zero), F.nullif(rps, zero), zero).alias("upper_bound"),
        F.coalesce(F.col("p.spike_probability"), zero).alias("spike_probability"),
        F.coalesce(F.col("p.confidence"), zero).alias("confidence"),
        F.when(F.col("p").isNull(), "none")
        .otherwise(F.coalesce(F.nullif(F.col("p.model_name"), F.lit("")), F.lit("unknown")))
        .alias("model_name"),
    )


def chart_by_second(metrics: DataFrame, last: int = 50) -> DataFrame:
    """First sample of each displayed second, then the newest ``last`` in order."""
    columns = ["timestamp", *(["id"] if "id" in metrics.columns else []), *METRIC_VALUES]
    first = F.min(F.struct(*columns)).alias("m")
    seconds = metrics.groupBy(F.date_format("timestamp", "HH:mm:ss").alias("label")).agg(first)
    newest = seconds.orderBy(F.col("m.timestamp").desc()).limit(last)
    return newest.select("label", *[F.col(f"m.{c}").alias(c) for c in columns if c != "id"]).orderBy("timestamp")


def chart_series(df: DataFrame, time: str, columns: list[str], last: int) -> DataFrame:
    """The newest ``last`` rows, oldest first, with a subset of columns."""
    tie = [F.col("id")] if "id" in df.columns else []
    newest = df.orderBy(*_newest(df, time)).limit(last)
    return newest.orderBy(F.col(time), *tie).select(time, *columns)


def facet_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def last_n_per_series(df: DataFrame, keys: list[str], time: str, n: int) -> DataFrame:
    return newest_per_key(df, keys, _newest(df, time), n)


def active_nodes(metrics: DataFrame, minutes: int = 5, as_of: datetime | None = None) -> DataFrame:
    return lookback(metrics, "timestamp", minutes, as_of).select("node_id").distinct()
