"""Telemetry tables derived by Spark from the ``events`` table.

Each derivation is an expression per row or an aggregate, so it grows with the
events and filters and column selection reach the file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch
from fleetlens.session import ensure_utc

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
ROLE_ORDER = ["admin", "operator", "viewer", "service", "guest"]


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The events, or the stream of their file (whose times are instants)."""
    ensure_utc(spark)
    if not streaming:
        return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    files = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return files.withColumn("ts", F.col("ts").cast("timestamp"))


def metrics(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    e = events(spark, sf_dir, streaming)
    value = F.col("value")
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("node-"), (F.col("user_id") % 8).cast("string")).alias("node_id"),
        F.col("ts").alias("timestamp"),
        F.least(value, F.lit(100.0)).alias("cpu_usage"),
        (F.col("event_id") * 37 % 100).cast("double").alias("memory_usage"),
        (value * 8).alias("latency_ms"),
        (F.lit(50) + value * 2.5).alias("requests_per_sec"),
        (F.lit(40) + F.col("event_id") % 10).cast("double").alias("disk_usage"),
    )


def requests(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    e = events(spark, sf_dir, streaming)
    kind = F.col("event_type")
    roles = F.array(*[F.lit(r) for r in ROLE_ORDER])
    return e.select(
        F.col("event_id").alias("id"),
        "ts",
        F.col("user_id").alias("key"),
        F.element_at(roles, (F.col("user_id") % 5 + 1).cast("int")).alias("role"),
        F.when(kind.isin("signup", "purchase"), "POST").otherwise("GET").alias("method"),
        kind.alias("endpoint"),
        F.when(kind == "error", "500")
        .when((kind == "signup") & (F.col("event_id") % 10 == 0), "404")
        .otherwise("200")
        .alias("status"),
        (F.col("value") / 100).alias("duration_s"),
        F.lit(1).alias("tokens"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    first = F.floor(F.col("event_id") / 5) * 5
    is_root = F.col("event_id") % 5 == 0
    failed = F.col("event_type") == "error"
    start = epoch("ts")
    return e.select(
        F.when(is_root, "trace_root").otherwise(F.col("event_type")).alias("name"),
        F.floor(F.col("event_id") / 5).cast("string").alias("trace_id"),
        F.col("event_id").cast("string").alias("span_id"),
        F.when(~is_root, first.cast("string")).alias("parent_span_id"),
        start.alias("start_time"),
        F.when(F.col("event_id") % 50 != 7, start + F.col("value") / 1000).alias("end_time"),
        F.from_json("props", "map<string,string>").alias("attributes"),
        F.when(failed, "ERROR").otherwise("OK").alias("status"),
        F.when(failed, F.concat(F.lit("failed after "), F.col("value").cast("string"), F.lit(" ms"))).alias(
            "error"
        ),
    )
