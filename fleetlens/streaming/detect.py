"""Streaming rule detection with the anomaly and alert tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators.anomaly import alerts_from_anomalies, flag_rules
from fleetlens.params import Thresholds


def detect(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Each arriving row is judged once, so an anomaly is emitted once per
    (node, time, metric) and not again on every cycle."""
    return flag_rules(metrics, thresholds).withColumnRenamed("timestamp", "detected_at")


def start_detector(
    metrics: DataFrame,
    anomalies_path: str,
    alerts_path: str,
    checkpoint: str,
    thresholds: Thresholds = Thresholds(),
    available_now: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Write anomalies and their alerts of each micro-batch.

    A batch owns the folder ``batch_id=N`` of both tables and overwrites it, so
    a batch that is replayed after a failure leaves the same rows once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        found = batch.persist()
        try:
            found.write.mode("overwrite").parquet(f"{anomalies_path}/batch_id={batch_id}")
            alerts_from_anomalies(found).write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")
        finally:
            found.unpersist()

    writer = (
        detect(metrics, thresholds)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
