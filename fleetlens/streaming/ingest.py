"""Streaming ingest: parse entries, keep good rows, quarantine the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.sources.readers import flag_entries, good_entries, parse_entries, rejected_entries


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def deduplicate(metrics: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated (node, time) rows that arrive within the delay (off by default)."""
    return metrics.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["node_id", "timestamp"])


def write_ingest_batch(entries: DataFrame, batch_id: int, table_path: str, rejects_path: str) -> None:
    """One micro-batch into both tables, parsed once.

    The batch id is a partition of each table and a batch overwrites its own partitions, so a replayed batch
    leaves both tables as they were.
    """
    flagged = flag_entries(entries).persist()
    try:
        good = good_entries(flagged).withColumns({"date": F.to_date("timestamp"), "batch": F.lit(batch_id)})
        bad = rejected_entries(flagged).withColumn("batch", F.lit(batch_id))
        for rows, path, parts, kind in (
            (good, table_path, ["date", "batch"], "parquet"),
            (bad, rejects_path, ["batch"], "json"),
        ):
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
            writer.format(kind).save(path)
    finally:
        flagged.unpersist()


def start_ingest(
    entries: DataFrame,
    table_path: str,
    rejects_path: str,
    checkpoint: str,
    dedup_delay: str | None = None,
    available_now: bool = False,
    interval: str = "2 seconds",
) -> list[StreamingQuery]:
    """Metric rows by date and rejected entries from one read of the source.

    Offsets live in the checkpoint and each batch writes its own partitions, so a lost executor or driver replays
    a batch without losing or doubling rows. Late rows are stored like any other. With ``dedup_delay`` repeated
    rows are dropped first, which needs state: then the rejects are a query of their own.
    """
    if not dedup_delay:
        both = entries.writeStream.option("checkpointLocation", f"{checkpoint}/entries").foreachBatch(
            lambda batch, number: write_ingest_batch(batch, number, table_path, rejects_path)
        )
        return [_trigger(both, available_now, interval).start()]
    good, rejects = parse_entries(entries)
    dated = deduplicate(good, dedup_delay).withColumn("date", F.to_date("timestamp"))
    table = (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", table_path)
        .option("checkpointLocation", f"{checkpoint}/metrics")
    )
    refused = (
        rejects.writeStream.format("json")
        .outputMode("append")
        .option("path", rejects_path)
        .option("checkpointLocation", f"{checkpoint}/rejects")
    )
    return [_trigger(w, available_now, interval).start() for w in (table, refused)]


def start_table(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Append a stream to a Parquet table with exactly-once commits."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now, interval).start()
