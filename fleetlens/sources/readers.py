"""Batch and streaming readers, payload parsing and encoding."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens import schemas
from fleetlens.functions.clock import epoch_us
from fleetlens.params import (
    BULK_MAX,
    BULK_MIN,
    DEFAULT_DISK,
    DEFAULT_NODE,
    INGEST_ALIASES,
)
from fleetlens.schemas import METRIC_COLUMNS, METRIC_VALUES


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table, partitioned by ``date``."""
    return spark.read.parquet(path)


def read_metrics_stream(
    spark: SparkSession,
    path: str | None = None,
    files_per_trigger: int = 100,
    kafka: dict[str, str] | None = None,
) -> DataFrame:
    """Raw stream entries, one map of strings per row, in bounded batches.

    Files hold one JSON object per line. With ``kafka`` the options go to the
    Kafka source as they are (name ``maxOffsetsPerTrigger`` there to bound a
    batch) and the entry is the JSON of the record's value.
    """
    if kafka:
        raw = spark.readStream.format("kafka").options(**kafka).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schemas.STREAM_ENTRY).alias("entry"))
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )
    return lines.select(F.from_json("value", schemas.STREAM_ENTRY).alias("entry"))


def _typed(entry: str) -> dict[str, Column]:
    """A number is refused when it does not parse, like any missing key."""
    field = lambda name: F.col(entry)[name]
    seconds = F.trim(field("timestamp")).try_cast("double")
    finite = seconds.between(-62135596800.0, 253402300799.0)
    values = {name: F.trim(field(name)).try_cast("double") for name in METRIC_VALUES}
    return {
        "node_id": field("node_id"),
        "timestamp": F.when(finite, F.timestamp_micros(F.rint(seconds * 1e6).cast("long"))),
        **values,
    }


def flag_entries(df: DataFrame, entry: str = "entry") -> DataFrame:
    """Stream entries with their typed metric row (``_row``) and whether it is whole (``_complete``)."""
    typed = df.withColumn("_row", F.struct(*[c.alias(n) for n, c in _typed(entry).items()]))
    complete = F.col("_row.node_id").isNotNull()
    for name in METRIC_COLUMNS[1:]:
        complete = complete & F.col(f"_row.{name}").isNotNull()
    return typed.withColumn("_complete", F.coalesce(complete, F.lit(False)))


def good_entries(flagged: DataFrame) -> DataFrame:
    return flagged.filter("_complete").select("_row.*")


def rejected_entries(flagged: DataFrame) -> DataFrame:
    return flagged.filter("not _complete").drop("_row", "_complete")


def parse_entries(df: DataFrame, entry: str = "entry") -> tuple[DataFrame, DataFrame]:
    """Split stream entries into typed metric rows and rejected entries."""
    flagged = flag_entries(df, entry)
    return good_entries(flagged), rejected_entries(flagged)


def normalise_requests(df: DataFrame, received_at: datetime | Column, request: str = "request") -> DataFrame:
    """Resolve aliases and defaults of ingest requests into metric rows.

    Requests that lack a required value are kept out, as by the API's checks.
    """
    received = received_at if isinstance(received_at, Column) else F.lit(received_at)
    fields = set(df.schema[request].dataType.fieldNames())
    pick = lambda names: F.coalesce(*[F.col(request)[n] for n in names if n in fields])
    out = df.select(
        F.coalesce(F.col(request)["node_id"], F.lit(DEFAULT_NODE)).alias("node_id"),
        F.when(F.col(request)["timestamp"].isNull(), received.cast("timestamp"))
        .otherwise(F.col(request)["timestamp"].try_cast("timestamp"))
        .alias("timestamp"),
        *[pick(INGEST_ALIASES[n]).cast("double").alias(n) for n in METRIC_VALUES[:-1]],
        F.coalesce(pick(INGEST_ALIASES["disk_usage"]), F.lit(DEFAULT_DISK)).cast("double").alias("disk_usage"),
    )
    return out.dropna(subset=["timestamp", *METRIC_VALUES])


def refused_requests(df: DataFrame, request: str = "request") -> DataFrame:
    """The requests that ``normalise_requests`` keeps out: no usable value for a metric, or a time that
    does not parse."""
    fields = set(df.schema[request].dataType.fieldNames())
    return df.where(~_complete_metric(F.col(request), fields))


def parse_json_requests(df: DataFrame, column: str, received_at: datetime | Column) -> DataFrame:
    parsed = df.select(F.from_json(column, schemas.INGEST_REQUEST).alias("request"))
    return normalise_requests(parsed, received_at)


def split_json_requests(df: DataFrame, column: str, received_at: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """Metric rows of single JSON requests, and the refused requests with the reason: a body that is no JSON
    object, or one that lacks a usable value."""
    broken = F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT"), F.lit(False))
    parsed = df.withColumns({"_object": broken, "request": F.from_json(column, schemas.INGEST_REQUEST)})
    refused = refused_requests(parsed).withColumn(
        "reason", F.when(F.col("_object"), "missing or unreadable value").otherwise("not a JSON object")
    )
    return normalise_requests(parsed.where("_object"), received_at), refused.drop("_object", "request")


def explode_bulk(
    df: DataFrame, column: str, received_at: datetime | Column
) -> tuple[DataFrame, DataFrame]:
    """Bulk request bodies to metric rows; a body of a wrong size, or with any metric that would be
    refused on its own, is rejected whole."""
    if isinstance(df.schema[column].dataType, T.StringType):
        body = F.from_json(column, schemas.BULK_REQUEST)["metrics"]
    else:
        body = F.col(column)["metrics"]
    sized = df.withColumn("_metrics", body)
    fits = F.coalesce(F.size("_metrics").between(BULK_MIN, BULK_MAX), F.lit(False))
    fields = set(sized.schema["_metrics"].dataType.elementType.fieldNames())
    good = F.coalesce(F.forall("_metrics", lambda m: _complete_metric(m, fields)), F.lit(False))
    rows = sized.filter(fits & good).select(F.explode("_metrics").alias("request"))
    return normalise_requests(rows, received_at), sized.filter(~(fits & good)).drop("_metrics")


def _complete_metric(metric: Column, fields: set[str]) -> Column:
    ok = metric["timestamp"].isNull() | metric["timestamp"].try_cast("timestamp").isNotNull()
    for name in METRIC_VALUES[:-1]:
        given = [metric[n] for n in INGEST_ALIASES[name] if n in fields]
        ok = ok & (F.coalesce(*given).isNotNull() if given else F.lit(False))
    return F.coalesce(ok, F.lit(False))


def encode_entries(metrics: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Metric rows to stream entries: every field as text, time as epoch seconds."""
    us = epoch_us("timestamp")
    fraction = F.regexp_replace(F.lpad((us % 1_000_000).cast("string"), 6, "0"), "0+$", "")
    seconds = F.concat_ws(
        ".", F.floor(us / 1_000_000).cast("string"), F.when(fraction == "", "0").otherwise(fraction)
    )
    pairs = [F.lit("node_id"), F.col("node_id"), F.lit("timestamp"), seconds]
    for name in METRIC_VALUES:
        pairs += [F.lit(name), F.col(name).cast("string")]
    return metrics.select(*(keep or []), F.create_map(*pairs).alias("entry"))


def encode_json(metrics: DataFrame) -> DataFrame:
    return encode_entries(metrics).select(F.to_json("entry").alias("value"))


def read_load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.LOAD_STATS)


def read_load_history(spark: SparkSession, path: str) -> DataFrame:
    """Per-second history of a load test; columns are found by their header names."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        F.col("Timestamp").try_cast("long").alias("Timestamp"),
        F.col("User Count").try_cast("int").alias("User Count"),
        F.col("Name"),
        F.col("Requests/s").try_cast("double").alias("Requests/s"),
    )


def read_scaling_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.SCALING_EVENTS)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark result documents (one JSON document per file)."""
    return spark.read.json(path, multiLine=True)
