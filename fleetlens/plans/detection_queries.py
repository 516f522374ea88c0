"""Registered queries: anomalies and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import anomaly
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry


@query(
    "rule_anomalies_cycle",
    f"""WITH {t.FLAGS} SELECT id, node_id, 'rule_based' AS anomaly_type, metric_name, metric_value, threshold,
  anomaly_score, description, {t.AS_OF} AS detected_at FROM flags
WHERE id IN (SELECT id FROM metrics WHERE "timestamp" >= {t.AS_OF} - INTERVAL 1440 MINUTE
             QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY "timestamp" DESC, id DESC) = 1)""",
)
def _(spark, sf):
    return anomaly.detect_rules(telemetry.metrics(spark, sf), minutes=1440, as_of=t.as_of(spark, sf))


@query(
    "rule_anomalies_all_rows",
    f"""WITH {t.FLAGS} SELECT id, node_id, "timestamp", 'rule_based' AS anomaly_type, metric_name, metric_value,
  threshold, anomaly_score, description FROM flags""",
)
def _(spark, sf):
    return anomaly.flag_rules(telemetry.metrics(spark, sf))


@query(
    "alerts_from_anomalies",
    f"""WITH {t.ANOMALIES} SELECT id, detected_at AS raised_at,
  CASE WHEN anomaly_score > 0.8 THEN 'critical' ELSE 'warning' END AS severity, node_id, anomaly_type AS alert_type,
  description AS message, false AS resolved, CAST(NULL AS TIMESTAMP) AS resolved_at FROM anomalies""",
)
def _(spark, sf):
    return anomaly.alerts_from_anomalies(t.anomalies(spark, sf))


@query(
    "outlier_scores_mapped",
    """SELECT event_id, round(least(1.0, greatest(0.01, 0.5 - (value - 50) / 100)), 6) AS score,
  CASE WHEN least(1.0, greatest(0.01, 0.5 - (value - 50) / 100)) > 0.8 THEN 'critical' ELSE 'warning' END AS severity
FROM events""",
)
def _(spark, sf):
    score = anomaly.outlier_score((F.col("value") - 50) / 100)
    return telemetry.events(spark, sf).select(
        "event_id", F.round(score, 6).alias("score"), anomaly.severity(score).alias("severity")
    )


@query("outliers_by_node")
def _(spark, sf):
    """Isolation forest per node over its whole history, reporting the last two days."""
    return anomaly.detect_outliers(
        telemetry.metrics(spark, sf), window_minutes=43_200, recent_minutes=2_880, as_of=t.as_of(spark, sf)
    )
