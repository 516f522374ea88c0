"""Aggregates: fleet summaries, KPIs, percentile and load reports."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch, instant, resolve_as_of, since
from fleetlens.functions.present import exact_round, severity_tone
from fleetlens.functions.quantiles import approximate_percentiles, exact_percentiles
from fleetlens.functions.skew import newest_per_key, side_by_side
from fleetlens.operators.reads import latest_prediction, lookback

LATENCY_PROBS = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p99_9": 0.999}
THROUGHPUT_PROBS = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p99_9": 0.999}
SUCCESS_SHARE = 0.05


def fleet_summary(
    metrics: DataFrame, minutes: int = 5, as_of: datetime | None = None, approx_nodes: bool = False
) -> DataFrame:
    """Averages over all nodes; NULL averages and a zero count when there are no rows."""
    nodes = F.approx_count_distinct("node_id") if approx_nodes else F.count_distinct("node_id")
    return lookback(metrics, "timestamp", minutes, as_of).agg(
        F.avg("cpu_usage").alias("avg_cpu"),
        F.avg("memory_usage").alias("avg_mem"),
        F.avg("latency_ms").alias("avg_latency"),
        F.avg("requests_per_sec").alias("avg_rps"),
        nodes.alias("node_count"),
    )


def active_workers(workers: DataFrame) -> DataFrame:
    return workers.agg(F.count_if(F.col("status") == "active").alias("active_workers"))


def system_status(
    workers: DataFrame,
    metrics: DataFrame,
    anomalies: DataFrame,
    predictions: DataFrame,
    as_of: datetime,
    node_minutes: int = 5,
    anomaly_minutes: int = 10,
) -> DataFrame:
    """Four aggregates in one row, rounded as the status page shows them."""
    nodes = lookback(metrics, "timestamp", node_minutes, as_of).agg(
        F.count_distinct("node_id").alias("nodes_reporting")
    )
    worst = lookback(anomalies, "detected_at", anomaly_minutes, as_of).agg(
        F.max("anomaly_score").alias("latest_anomaly_score")
    )
    forecast = latest_prediction(predictions).select("predicted_rps")
    row = side_by_side(active_workers(workers), nodes, worst, forecast)
    return row.select(
        F.lit("operational").alias("status"),
        F.coalesce("active_workers", F.lit(0)).alias("active_workers"),
        F.coalesce("nodes_reporting", F.lit(0)).alias("nodes_reporting"),
        exact_round(F.coalesce("latest_anomaly_score", F.lit(0.0)), 3).alias("latest_anomaly_score"),
        exact_round(F.coalesce("predicted_rps", F.lit(0.0)), 2).alias("predicted_rps"),
        instant(metrics, "timestamp", as_of).alias("timestamp"),
    )


def average_cpu(
    metrics: DataFrame, minutes: int = 2, as_of: datetime | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Mean CPU; no rows count as 0.0, and ``has_data`` tells the two apart."""
    return lookback(metrics, "timestamp", minutes, as_of).groupBy(*(keys or [])).agg(
        F.coalesce(F.avg("cpu_usage"), F.lit(0.0)).alias("avg_cpu"),
        (F.count("*") > 0).alias("has_data"),
    )


def resample_mean(
    df: DataFrame,
    time: str,
    value: str,
    keys: list[str] | None = None,
    width: str = "5 minutes",
    agg: str = "avg",
) -> DataFrame:
    """Mean (or sum) per aligned bucket; missing values and empty buckets drop out."""
    y = F.col(value).cast("double")
    fn = {"avg": F.avg, "sum": F.sum}[agg]
    usable = df.filter(y.isNotNull() & ~F.isnan(y) & F.col(time).isNotNull())
    return (
        usable.groupBy(*(keys or []), F.window(time, width).alias("_w"))
        .agg(fn(y).alias("y"))
        .select(*(keys or []), F.col("_w.start").alias("ds"), "y")
    )


def enough_samples(
    metrics: DataFrame, minutes: int = 60, minimum: int = 30, as_of: datetime | None = None
) -> DataFrame:
    """Nodes with at least ``minimum`` rows in the window, with their counts."""
    return (
        lookback(metrics, "timestamp", minutes, as_of)
        .groupBy("node_id")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") >= minimum)
    )


def action_counts(events: DataFrame) -> DataFrame:
    n = lambda action: F.count_if(F.col("action") == action).alias(action)
    return events.agg(n("scale_up"), n("scale_down"), n("no_change"))


def anomaly_kpis(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        F.count("*").alias("anomalies"),
        F.count_if(F.col("anomaly_score") >= 0.8).alias("critical_scores"),
        F.greatest(F.coalesce(F.max("anomaly_score"), F.lit(0.0)), F.lit(0.0)).alias("max_score"),
    )


def alert_kpis(alerts: DataFrame, tab: str = "all") -> DataFrame:
    shown = F.lit(True) if tab == "all" else F.lower("severity") == tab.lower()
    return alerts.agg(
        F.count_if(shown).alias("visible"),
        F.count_if(~F.col("resolved")).alias("unresolved"),
        F.count_if(severity_tone("severity") == "bad").alias("critical"),
    )


def worker_kpis(workers: DataFrame, as_of: datetime, fresh_s: float = 120) -> DataFrame:
    age = epoch(instant(workers, "last_heartbeat", as_of)) - epoch("last_heartbeat")
    return workers.agg(
        F.count("*").alias("registered"),
        F.count_if(F.lower("status") == "active").alias("active"),
        F.count_if(age < fresh_s).alias("fresh_heartbeats"),
    )


def _latency_stats(value: Column, suffix: str) -> list[Column]:
    return [
        F.min(value).alias(f"min{suffix}"),
        F.max(value).alias(f"max{suffix}"),
        F.avg(value).alias(f"mean{suffix}"),
        F.stddev_pop(value).alias(f"stddev{suffix}"),
    ]


def _join_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left") if keys else side_by_side(left, right)


def latency_report(
    log: DataFrame, latency: str, error: str, keys: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Latency distribution of the successful requests and the error share.

    A row is a success when ``error`` is NULL. Percentiles are exact with
    linear interpolation; ``approximate`` uses a one-pass sketch.
    """
    keys = keys or []
    ok = F.col(error).isNull()
    value = F.when(ok, F.col(latency))
    base = log.groupBy(*keys).agg(
        F.count(value).alias("samples"),
        *_latency_stats(value, "_ms"),
        F.count(error).alias("error_count"),
        F.array_sort(F.collect_set(error)).alias("error_types"),
    )
    probs = {f"{name}_ms": p for name, p in LATENCY_PROBS.items()}
    quantile = approximate_percentiles if approximate else exact_percentiles
    out = _join_keys(base, quantile(log.filter(ok), keys, latency, probs), keys)
    return out.withColumn(
        "success", (F.col("samples") > 0) & (F.col("error_count") < F.col("samples") * SUCCESS_SHARE)
    )


def throughput_report(
    log: DataFrame, latency: str, error: str, batch: str, duration_s: float, keys: list[str] | None = None
) -> DataFrame:
    """Rates, error rate and latency distribution of a request log.

    ``batch`` is the number of metrics each request carried.
    """
    keys = keys or []
    ok = F.col(error).isNull()
    value = F.when(ok, F.col(latency))
    base = log.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(ok, F.col(batch))), F.lit(0)).alias("total_sent"),
        F.coalesce(F.sum(F.when(~ok, F.col(batch))), F.lit(0)).alias("total_failed"),
        F.count_if(ok).alias("successful_requests"),
        F.count_if(~ok).alias("failed_requests"),
        *_latency_stats(value, "_latency_ms"),
    )
    probs = {f"{name}_latency_ms": p for name, p in THROUGHPUT_PROBS.items()}
    out = _join_keys(base, exact_percentiles(log.filter(ok), keys, latency, probs), keys)
    attempts = F.col("total_sent") + F.col("total_failed")
    rate = F.coalesce(F.try_divide(F.col("total_failed"), attempts), F.lit(1.0))
    return out.withColumns(
        {
            "total_attempts": attempts,
            "achieved_rps": F.floor(F.col("total_sent") / duration_s),
            "request_rps": F.col("successful_requests") / duration_s,
            "error_rate": rate,
            "success": (F.col("successful_requests") > 0) & (rate < SUCCESS_SHARE),
        }
    )


def error_breakdown(log: DataFrame, error: str) -> DataFrame:
    return log.filter(F.col(error).isNotNull()).groupBy(error).agg(F.count("*").alias("errors"))


def resource_profile(
    df: DataFrame, time: str, memory: str, cpu: str, keys: list[str] | None = None
) -> DataFrame:
    """First, last and peak memory, growth, CPU range and duration of a profile."""
    order = F.struct(F.col(time), *([F.col("id")] if "id" in df.columns else []))
    initial, final = F.min_by(memory, order), F.max_by(memory, order)
    return df.groupBy(*(keys or [])).agg(
        (F.max(epoch(time)) - F.min(epoch(time))).alias("duration_seconds"),
        F.count("*").alias("total_measurements"),
        initial.alias("initial_mb"),
        F.max(memory).alias("peak_mb"),
        final.alias("final_mb"),
        (final - initial).alias("growth_mb"),
        F.avg(memory).alias("avg_mb"),
        F.avg(cpu).alias("avg_percent"),
        F.max(cpu).alias("peak_percent"),
        F.min(cpu).alias("min_percent"),
    )


def load_test_summary(
    stats: DataFrame, history: DataFrame, batch_size: int = 1, bulk: str = "/api/metrics/bulk",
    single: str = "/api/metrics",
) -> DataFrame:
    """The one-row summary of a load test."""
    is_total = F.col("Name") == "Aggregated"
    total = lambda c: F.max(F.when(is_total, F.col(f"`{c}`")))
    posts = (~is_total) & (F.col("Type") == "POST")
    sent = F.when(posts & (F.col("Name") == bulk), F.col("Request Count") * batch_size).when(
        posts & (F.col("Name") == single), F.col("Request Count")
    )
    summary = stats.agg(
        total("Request Count").alias("total_requests"),
        total("Failure Count").alias("failures"),
        total("Average Response Time").alias("avg_ms"),
        total("95%").alias("p95_ms"),
        total("99%").alias("p99_ms"),
        total("Requests/s").alias("sustained_rps"),
        F.coalesce(F.sum(sent), F.lit(0)).alias("estimated_metrics"),
    )
    peaks = history.filter(is_total).agg(
        F.coalesce(F.max("Requests/s"), F.lit(0.0)).alias("peak_rps"),
        F.coalesce(F.max("User Count"), F.lit(0)).alias("peak_users"),
    )
    return side_by_side(summary, peaks)


def load_test_endpoints(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("Name") != "Aggregated").select(
        F.col("Type").alias("method"),
        F.col("Name").alias("endpoint"),
        F.col("Request Count").alias("requests"),
        F.col("Failure Count").alias("failures"),
        F.col("`95%`").alias("p95_ms"),
        F.col("`99%`").alias("p99_ms"),
    )


def decision_stats(decisions: DataFrame, last: int | None = 100, keys: list[str] | None = None) -> DataFrame:
    """Statistics over the kept decisions (the newest ``last`` of each series)."""
    keys = keys or []
    rows = newest_per_key(decisions, keys, [F.col("step").desc()], last) if last else decisions
    return rows.groupBy(*keys).agg(
        F.count("*").alias("decisions_made"),
        F.coalesce(F.avg("action"), F.lit(0.0)).alias("average_action"),
        F.min("action").alias("min_action"),
        F.max("action").alias("max_action"),
        F.count_if("is_emergency").alias("emergency_count"),
        F.try_divide(F.count_if("is_emergency") * 100.0, F.count("*")).alias("emergency_percentage"),
    )


def control_error_stats(steps: DataFrame, last: int | None = 1000, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    rows = newest_per_key(steps, keys, [F.col("step").desc()], last) if last else steps
    return rows.groupBy(*keys).agg(
        F.count("*").alias("error_history_length"),
        F.avg("error").alias("error_mean"),
        F.when(F.count("*") > 1, F.stddev_samp("error")).otherwise(F.lit(0.0)).alias("error_std"),
        F.min("error").alias("error_min"),
        F.max("error").alias("error_max"),
        F.max_by("error", "step").alias("last_error"),
        F.max_by("integral_error", "step").alias("integral_error"),
    )


def control_stability(
    steps: DataFrame, keys: list[str] | None = None, tail: int = 5, band: float = 5.0
) -> DataFrame:
    """How calmly a controller settles: spread, late oscillation, settling step."""
    keys = keys or []
    whole = steps.groupBy(*keys).agg(
        F.avg("error").alias("error_mean"),
        F.stddev_pop("error").alias("error_std"),
        F.var_pop("action").alias("action_variance"),
        F.min(F.when(F.abs("error") < band, F.col("step"))).alias("settling_step"),
        F.max("error").alias("max_error"),
    )
    late = (
        newest_per_key(steps, keys, [F.col("step").desc()], tail)
        .groupBy(*keys)
        .agg(F.stddev_pop("error").alias("late_oscillation"))
    )
    return _join_keys(whole, late, keys)


def table_freshness(df: DataFrame, time: str, minutes: int, as_of: datetime | None = None) -> DataFrame:
    as_of = resolve_as_of(df, time, as_of)
    recent = F.lit(False) if as_of is None else since(df, time, as_of, minutes=minutes)
    return df.agg(
        F.count("*").alias("rows"), F.max(time).alias("newest"), F.count_if(recent).alias("recent_rows")
    )


def regressions(
    current: DataFrame, baseline: DataFrame, on: str = "test_name", metric: str = "p99_ms", factor: float = 1.5
) -> DataFrame:
    """Tests whose metric exceeds its baseline by more than ``factor``."""
    base = baseline.select(on, F.col(metric).alias("baseline"))
    joined = current.select(on, F.col(metric).alias("current")).join(base, on)
    return joined.withColumn("regressed", F.col("current") > F.col("baseline") * factor)


def ingest_completeness(
    before: DataFrame, after: DataFrame, prefix: str, expected: int, share: float = 0.95
) -> DataFrame:
    """Rows of the prefix that arrived between two states of the table."""
    mine = F.col("node_id").startswith(prefix)
    row = side_by_side(
        before.agg(F.count_if(mine).alias("start_count")), after.agg(F.count_if(mine).alias("end_count"))
    )
    arrived = F.col("end_count") - F.col("start_count")
    return row.select(
        "start_count",
        "end_count",
        arrived.alias("ingested"),
        F.lit(expected).alias("expected"),
        (arrived / F.lit(expected)).alias("success_rate"),
        (arrived >= F.floor(F.lit(expected) * share)).alias("passed"),
    )


def window_transitions(
    history: DataFrame, events: DataFrame, limit: int = 20, tie: list[str] | None = None
) -> DataFrame:
    """Real scale transitions while a load test ran.

    The window is the range of the history's total rows. Its two bounds are one
    row, so they are read and used as literals that prune the event table.
    """
    totals = history.filter((F.col("Name") == "Aggregated") & F.col("Timestamp").isNotNull())
    bounds = totals.agg(F.min("Timestamp").alias("lo"), F.max("Timestamp").alias("hi")).first()
    moved = events.filter((F.col("action") != "no_change") & (F.col("prev_replicas") != F.col("new_replicas")))
    if bounds["lo"] is not None:
        at = F.col("triggered_at")
        low = datetime.fromtimestamp(bounds["lo"], timezone.utc)
        high = datetime.fromtimestamp(bounds["hi"], timezone.utc)
        moved = moved.filter(
            (at >= instant(events, "triggered_at", low)) & (at <= instant(events, "triggered_at", high))
        )
    return moved.orderBy("triggered_at", *(tie or [])).limit(limit)
