"""Rule detector, severities, alerts and the per-node outlier detector."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import instant, resolve_as_of, since
from fleetlens.functions.forest import grow_trees, score_rows
from fleetlens.functions.present import exact_round, fixed
from fleetlens.functions.quantiles import exact_percentiles
from fleetlens.functions.skew import newest_per_key
from fleetlens.operators.reads import latest_per_node, lookback
from fleetlens.params import RULE_TEXT, Thresholds
from fleetlens.session import cut_lineage

FEATURES = ["cpu_usage", "memory_usage", "latency_ms", "requests_per_sec"]
RULE_COLUMNS = {"cpu": "cpu_usage", "memory": "memory_usage", "latency": "latency_ms"}

# Fixed values of the outlier detector: trees, rows per tree, outlier share, seed.
TREES = 100
TREE_ROWS = 256
CONTAMINATION = 0.05
SEED = 42
MIN_ROWS = 30


def rule_score(value: Column, threshold: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(0.5) + (value - threshold) / threshold)


def outlier_score(decision: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.01), F.lit(0.5) - decision))


def severity(score: str | Column) -> Column:
    col = F.col(score) if isinstance(score, str) else score
    return F.when(col > 0.8, "critical").otherwise("warning")


def _decimals(value: float) -> str:
    return repr(float(value))


def rule_scores(thresholds: Thresholds = Thresholds()) -> list[Column]:
    """Per limit the score of a row that exceeds it, else null."""
    scores = []
    for name, limit in thresholds.as_dict().items():
        value, bound = F.col(RULE_COLUMNS[name]), F.lit(float(limit))
        scores.append(F.when(value > bound, exact_round(rule_score(value, bound), 3)))
    return scores


def flag_rules(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """One row per exceeded limit of each metric row (stateless, stream-safe)."""
    limits = thresholds.as_dict()
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric_name"),
                F.col(RULE_COLUMNS[name]).alias("metric_value"),
                F.lit(limit).cast("double").alias("threshold"),
                F.lit(RULE_TEXT[name]).alias("text"),
                F.lit(_decimals(limit)).alias("shown"),
            )
            for name, limit in limits.items()
        ]
    )
    any_limit = reduce(or_, [F.col(RULE_COLUMNS[name]) > limit for name, limit in limits.items()])
    keep = ["node_id", "timestamp", *(["id"] if "id" in metrics.columns else [])]
    rows = metrics.filter(any_limit).select(*keep, F.explode(checks).alias("c"))
    rows = rows.filter(F.col("c.metric_value") > F.col("c.threshold"))
    value, limit = F.col("c.metric_value"), F.col("c.threshold")
    return rows.select(
        *keep,
        F.lit("rule_based").alias("anomaly_type"),
        F.col("c.metric_name").alias("metric_name"),
        value.alias("metric_value"),
        limit.alias("threshold"),
        exact_round(rule_score(value, limit), 3).alias("anomaly_score"),
        F.concat(
            F.col("c.text"), F.lit(": "), fixed(value, 1), F.lit(" exceeds threshold "), F.col("c.shown")
        ).alias("description"),
    )


def detect_rules(
    metrics: DataFrame,
    thresholds: Thresholds = Thresholds(),
    minutes: int = 2,
    as_of: datetime | None = None,
) -> DataFrame:
    """One detection cycle: the newest row of each node against the limits."""
    as_of = resolve_as_of(metrics, "timestamp", as_of)
    flagged = flag_rules(latest_per_node(metrics, minutes, as_of), thresholds)
    return flagged.withColumn("detected_at", instant(metrics, "timestamp", as_of)).drop("timestamp")


def alerts_from_anomalies(anomalies: DataFrame) -> DataFrame:
    """One alert row per anomaly."""
    return anomalies.select(
        *(["id"] if "id" in anomalies.columns else []),
        F.col("detected_at").alias("raised_at"),
        severity("anomaly_score").alias("severity"),
        "node_id",
        F.col("anomaly_type").alias("alert_type"),
        F.coalesce("description", F.lit("Anomaly detected")).alias("message"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast(anomalies.schema["detected_at"].dataType).alias("resolved_at"),
    )


# ---------------------------------------------------------------------------
# Per-node isolation forest
# ---------------------------------------------------------------------------
#
# A tree looks at no more than TREE_ROWS rows of its node, drawn by hashes of the
# row. A row of a node with n rows offers itself to about TREES * 2 * TREE_ROWS / n
# trees, which its hash names (to all trees in a node of at most 2 * TREE_ROWS
# rows); a tree takes, of the rows offered, those with the lowest hash of (row,
# tree). Samples of parts of a node merge into the sample of the whole. Fitting is
# one small task per node; scoring and the contamination cut-off run over all
# rows, split into (node, slice) groups of bounded size.


def draw_samples(rows: DataFrame) -> DataFrame:
    """(node_id, FEATURES, _draw, _tree, _rank): the rows that each tree looks at.

    ``rows`` has (node_id, FEATURES, n_rows, _draw), where ``_draw`` is a hash of the row.
    """
    offers = F.lit(float(TREES)) * F.least(F.lit(1.0), F.lit(2.0 * TREE_ROWS) / F.col("n_rows"))
    chance = F.pmod(F.col("_draw"), F.lit(1_000_003)) / 1_000_003
    count = F.floor(offers + chance).cast("int")
    every = F.sequence(F.lit(0), F.lit(TREES - 1))
    named = F.transform(
        F.sequence(F.lit(1), count), lambda j: F.pmod(F.xxhash64("_draw", j), F.lit(TREES)).cast("int")
    )
    trees = F.when(F.col("n_rows") <= 2 * TREE_ROWS, every).when(count > 0, F.array_distinct(named))
    offered = rows.select("node_id", *FEATURES, "_draw", F.explode(trees).alias("_tree"))
    offered = offered.withColumn("_rank", F.xxhash64("_tree", "_draw"))
    return newest_per_key(offered, ["node_id", "_tree"], [F.col("_rank"), F.col("_draw")], TREE_ROWS)


def _fit_node(key: tuple, pool: pd.DataFrame) -> pd.DataFrame:
    pool = pool.sort_values(["_tree", "_rank", "_draw"])
    model = grow_trees(pool[FEATURES].to_numpy("float32"), pool["_tree"].to_numpy("int64"), TREES, SEED)
    return pd.DataFrame({"node_id": [key[0]], **{name: [value] for name, value in model.items()}})


FOREST_SCHEMA = (
    "node_id string, feature array<int>, cut array<double>, depth array<double>, cells int, scale double"
)


def _score_slice(key: tuple, rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
    columns = [*rows.columns.drop(["_slice"]), "raw_score"]
    if rows.empty or forest.empty:
        return pd.DataFrame({c: [] for c in columns})
    model = forest.iloc[0]
    out = rows.drop(columns=["_slice"])
    out["raw_score"] = score_rows(rows[FEATURES].to_numpy("float32"), model)
    return out[columns]


def detect_outliers(
    metrics: DataFrame,
    window_minutes: int = 60,
    recent_minutes: int = 2,
    min_rows: int = MIN_ROWS,
    contamination: float = CONTAMINATION,
    as_of: datetime | None = None,
    slice_rows: int = 200_000,
) -> DataFrame:
    """Multivariate outliers among each node's newest rows.

    The forest is fitted on the node's window, the cut-off is the
    ``contamination`` quantile of the window's scores, and rows of the recent
    slice that score below it are reported.
    """
    as_of = resolve_as_of(metrics, "timestamp", as_of)
    keep = ["node_id", "timestamp", *(["id"] if "id" in metrics.columns else []), *FEATURES]
    window = lookback(metrics, "timestamp", window_minutes, as_of).select(*keep)
    draw = F.xxhash64(*[F.col(c) for c in keep], F.lit(SEED))
    counts = window.groupBy("node_id").agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") >= min_rows)
    gated = window.join(counts, "node_id").withColumn("_draw", draw)
    slices = F.greatest(F.ceil(F.col("n_rows") / slice_rows), F.lit(1))
    sliced = gated.withColumn("_slice", F.pmod(F.col("_draw"), slices))

    pool = draw_samples(gated)
    tasks = int(metrics.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forests = (
        pool.repartition(tasks, "node_id")  # a given count is not coalesced: the work is CPU, not bytes
        .groupBy("node_id")
        .applyInPandas(_fit_node, FOREST_SCHEMA)
    )

    copies = forests.join(counts, "node_id").select(
        *forests.columns,
        F.explode(F.sequence(F.lit(0).cast("bigint"), slices.cast("bigint") - 1)).alias("_slice"),
    )
    types = {f.name: f.dataType.simpleString() for f in sliced.schema.fields}
    scored_schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", raw_score double"
    scored = (
        sliced.select(*keep, "_slice")
        .groupBy("node_id", "_slice")
        .cogroup(copies.groupBy("node_id", "_slice"))
        .applyInPandas(_score_slice, scored_schema)
    )
    scored = cut_lineage(scored)
    offset = exact_percentiles(scored, ["node_id"], "raw_score", {"cutoff": contamination})
    recent = scored.filter(since(scored, "timestamp", as_of, minutes=recent_minutes))
    decision = F.col("raw_score") - F.col("cutoff")
    flagged = recent.join(offset, "node_id").filter(decision < 0)
    return flagged.select(
        *[c for c in keep if c not in FEATURES and c != "timestamp"],
        instant(metrics, "timestamp", as_of).alias("detected_at"),
        F.lit("ml_based").alias("anomaly_type"),
        F.lit("composite").alias("metric_name"),
        F.col("cpu_usage").alias("metric_value"),
        F.lit(None).cast("double").alias("threshold"),
        exact_round(outlier_score(decision), 3).alias("anomaly_score"),
        F.format_string(
            "Isolation Forest outlier on %s: cpu=%s%% mem=%s%% lat=%sms rps=%s",
            "node_id", *[fixed(c, 1) for c in FEATURES],
        ).alias("description"),
    )
