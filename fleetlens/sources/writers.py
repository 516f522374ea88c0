"""Appends and exports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import instant
from fleetlens.operators.anomaly import alerts_from_anomalies
from fleetlens.operators.summaries import active_workers
from fleetlens.schemas import METRIC_COLUMNS


def write_metrics(metrics: DataFrame, path: str, files_per_date: int | None = None) -> None:
    """Append metric rows, partitioned by date and sorted by node inside files.

    ``files_per_date`` spreads each date over that many tasks by a hash of the
    row, so that a hot node or date is not written by one task.
    """
    out = metrics.select(*METRIC_COLUMNS).withColumn("date", F.to_date("timestamp"))
    if files_per_date:
        salt = F.pmod(F.xxhash64("node_id", "timestamp"), F.lit(files_per_date))
        out = out.repartition("date", salt)
    (
        out.sortWithinPartitions("date", "node_id", "timestamp")
        .write.mode("append")
        .partitionBy("date")
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_anomalies_and_alerts(anomalies: DataFrame, anomalies_path: str, alerts_path: str) -> None:
    """Each anomaly is stored and raises one alert.

    Both tables are written from one computation, so a costly detector runs
    once; the cache holds anomalies only and spills to disk.
    """
    kept = anomalies.persist()
    try:
        append(kept, anomalies_path)
        append(alerts_from_anomalies(kept), alerts_path)
    finally:
        kept.unpersist()


def write_predictions(predictions: DataFrame, path: str) -> None:
    append(predictions, path)


def write_scaling_events(events: DataFrame, path: str) -> None:
    append(events, path)


def manual_scale_event(workers: DataFrame, target: int, user: str, at: datetime) -> DataFrame:
    """One event row: from the number of active workers to the requested target."""
    if target < 1:
        raise ValueError("target must be >= 1")
    return active_workers(workers).select(
        F.lit(at).alias("triggered_at"),
        F.lit("manual_scale").alias("action"),
        F.col("active_workers").cast("int").alias("prev_replicas"),
        F.lit(target).cast("int").alias("new_replicas"),
        F.lit(f"manual request by {user}").alias("reason"),
    )


def scaling_events_between(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows of the scaling export: real decisions inside the range, oldest first."""
    t = F.col("triggered_at")
    inside = (t >= instant(events, "triggered_at", start)) & (t <= instant(events, "triggered_at", end))
    return (
        events.filter(inside & (F.col("action") != "no_change"))
        .select("triggered_at", "action", "prev_replicas", "new_replicas", "reason")
        .orderBy("triggered_at")
    )


def export_scaling_csv(events: DataFrame, path: str, start: datetime, end: datetime) -> None:
    scaling_events_between(events, start, end).write.mode("overwrite").csv(path, header=True)


def save_result(result: DataFrame, path: str, test_name: str, saved_at: datetime) -> None:
    """Store a benchmark result with its metadata as JSON."""
    meta = F.struct(F.lit(test_name).alias("test_name"), F.lit(saved_at.isoformat()).alias("timestamp"))
    result.withColumn("_metadata", meta).write.mode("overwrite").json(path)
