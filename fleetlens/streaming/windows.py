"""Windowed aggregates over the metric stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_mean(
    metrics: DataFrame,
    value: str = "requests_per_sec",
    keys: list[str] | None = None,
    width: str = "5 minutes",
    delay: str | None = "10 minutes",
) -> DataFrame:
    """Mean per closed window. Rows later than ``delay`` (None: the stream's own watermark) no longer change it."""
    y = F.col(value)
    usable = metrics.filter(y.isNotNull() & ~F.isnan(y))
    usable = usable.withWatermark("timestamp", delay) if delay else usable
    return (
        usable.groupBy(*(keys or []), F.window("timestamp", width).alias("_w"))
        .agg(F.avg(y).alias("y"), F.count("*").alias("samples"))
        .select(*(keys or []), F.col("_w.start").alias("ds"), "y", "samples")
    )


def sliding_summary(
    metrics: DataFrame, width: str = "5 minutes", slide: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Fleet summary of the last ``width`` at every ``slide``, with the exact number of nodes.

    Two stateful steps: sums per (window, node), then per window, so the state is one row per node and window and a
    node is counted once however often it reports.
    """
    names = {"avg_cpu": "cpu_usage", "avg_mem": "memory_usage", "avg_latency": "latency_ms", "avg_rps": "requests_per_sec"}
    # decimal sums: the mean does not depend on the order in which rows arrive
    exact = {c: F.col(c).cast("decimal(28,9)") for c in names.values()}
    sums = [f(x).alias(f"{f.__name__}_{c}") for c, x in exact.items() for f in (F.sum, F.count)]
    nodes = metrics.withWatermark("timestamp", delay).groupBy(F.window("timestamp", width, slide).alias("_w"), "node_id")
    whole = nodes.agg(*sums).groupBy("_w")
    mean = lambda c: F.try_divide(F.sum(f"sum_{c}").cast("double"), F.sum(f"count_{c}"))
    means = [mean(c).alias(n) for n, c in names.items()]
    out = whole.agg(*means, F.count("node_id").alias("node_count"))
    return out.select(F.col("_w.end").alias("at"), *names, "node_count")
