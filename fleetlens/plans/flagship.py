"""The flagship query: bucketed node load with rule flags."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators.anomaly import rule_scores
from fleetlens.plans.catalog import query
from fleetlens.plans.tables import FLAGS
from fleetlens.sources import telemetry


@query(
    "node_health",
    f"""WITH {FLAGS}, load AS (
  SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS bucket, count(*) AS samples,
         avg(cpu_usage) AS avg_cpu, avg(memory_usage) AS avg_mem, avg(latency_ms) AS avg_latency,
         avg(requests_per_sec) AS avg_rps FROM metrics GROUP BY ALL), raised AS (
  SELECT node_id, time_bucket(INTERVAL '5 minutes', "timestamp") AS bucket, count(*) AS anomalies,
         max(anomaly_score) AS worst_score FROM flags GROUP BY ALL)
SELECT l.node_id, l.bucket, samples, round(avg_cpu, 6) AS avg_cpu, round(avg_mem, 6) AS avg_mem,
       round(avg_latency, 6) AS avg_latency, round(avg_rps, 6) AS avg_rps,
       coalesce(anomalies, 0) AS anomalies, coalesce(worst_score, 0.0) AS worst_score
FROM load l LEFT JOIN raised r ON l.node_id = r.node_id AND l.bucket = r.bucket""",
)
def node_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan and one shuffle: exceeded limits are counted inside the bucket aggregate."""
    scores = rule_scores()
    hits = reduce(add, [F.count(score) for score in scores])
    out = telemetry.metrics(spark, sf_dir).groupBy("node_id", F.window("timestamp", "5 minutes").alias("_w")).agg(
        F.count("*").alias("samples"),
        F.avg("cpu_usage").alias("avg_cpu"),
        F.avg("memory_usage").alias("avg_mem"),
        F.avg("latency_ms").alias("avg_latency"),
        F.avg("requests_per_sec").alias("avg_rps"),
        hits.alias("anomalies"),
        F.coalesce(F.max(F.greatest(*scores)), F.lit(0.0)).alias("worst_score"),
    )
    return rounded(out.select("node_id", F.col("_w.start").alias("bucket"), *out.columns[2:]))
