"""Spike detection on day-long sequences."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.skew import newest_per_key
from fleetlens.params import DAY_BUCKETS

FLAT = 1e-6
FEATURES = ["level_shift", "tail_ratio", "max_z", "lag1"]
#: A table of these rows holds every version of every model; nothing in it is overwritten.
MODELS = (
    "model_key string, trained_at timestamp, n_rows bigint, means array<double>, scales array<double>, "
    "coefficients array<double>, intercept double, losses array<double>"
)
#: Weights of the standardised features before any labelled data: a raised, peaked, persistent tail is a spike.
PRIOR_WEIGHTS, PRIOR_INTERCEPT = [1.5, 1.0, 0.5, 0.5], -1.0


def sequences(
    series: DataFrame, keys: list[str], length: int = DAY_BUCKETS, time: str = "ds", value: str = "y"
) -> DataFrame:
    """The newest ``length`` values of each series, oldest first, edge-padded on the left."""
    newest = newest_per_key(series, keys, [F.col(time).desc()], length)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(time), F.col(value))))
    values = F.transform(ordered, lambda p: p[value])
    return (
        newest.groupBy(*keys)
        .agg(values.alias("_v"))
        .select(*keys, F.concat(F.array_repeat(F.col("_v")[0], F.lit(length) - F.size("_v")), "_v").alias("seq"))
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def mean_of(values: Column) -> Column:
    return _total(values) / F.size(values)


def std_of(values: Column) -> Column:
    """Population standard deviation of an array."""
    m = mean_of(values)
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m)) / F.size(values))


def z_normalise(df: DataFrame, column: str = "seq", name: str = "z") -> DataFrame:
    """Centre and scale each sequence; a flat one is only centred."""
    moments = df.withColumns({"_m": mean_of(F.col(column)), "_s": std_of(F.col(column))})
    scale = F.when(F.col("_s") < FLAT, 1.0).otherwise(F.col("_s"))
    return (
        moments.withColumn("_s", scale)
        .withColumn(name, F.transform(column, lambda x: (x - F.col("_m")) / F.col("_s")))
        .drop("_m", "_s")
    )


def check_length(df: DataFrame, column: str = "seq", length: int = DAY_BUCKETS) -> DataFrame:
    """Fail the job when a sequence has another length."""
    wrong = F.concat(F.lit(f"expected {length} points, got "), F.size(column).cast("string"))
    passed = F.when(F.size(column) != length, F.raise_error(wrong).cast(df.schema[column].dataType))
    return df.withColumn(column, passed.otherwise(F.col(column)))


def sequence_features(df: DataFrame, column: str = "seq", tail: int = 138) -> DataFrame:
    """Shape of a sequence: level shift, tail share, largest value, autocorrelation."""
    z = z_normalise(df, column, "_z")
    zc, x = F.col("_z"), F.col(column)
    n = F.size(zc)
    head = lambda a: F.slice(a, F.lit(1), n - tail)
    last = lambda a: F.slice(a, n - tail + 1, F.lit(tail))
    products = F.zip_with(F.slice(zc, F.lit(1), n - 1), F.slice(zc, F.lit(2), n - 1), lambda a, b: a * b)
    return z.withColumns(
        {
            "level_shift": mean_of(last(zc)) - mean_of(head(zc)),
            "tail_ratio": F.coalesce(F.try_divide(mean_of(last(x)), mean_of(head(x))), F.lit(1.0)),
            "max_z": F.array_max(zc),
            "lag1": mean_of(products),
        }
    ).drop("_z")


def train_spike_classifier(
    labelled: DataFrame, label: str = "label", max_iter: int = 20
) -> tuple[PipelineModel, list[float]]:
    """Fit on (seq, label) rows; returns the model and its loss history."""
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True),
        LogisticRegression(
            featuresCol="_features", labelCol=label, maxIter=max_iter, regParam=0.001,
            rawPredictionCol="_margin", probabilityCol="_probability", predictionCol="_prediction",
        ),
    ]
    model = Pipeline(stages=stages).fit(sequence_features(labelled))
    return model, list(model.stages[-1].summary.objectiveHistory)


def score_sequences(model: PipelineModel, df: DataFrame, length: int | None = DAY_BUCKETS) -> DataFrame:
    """Add ``spike_probability`` and ``normal_probability`` to (…, seq) rows."""
    rows = check_length(df, "seq", length) if length else df
    scored = model.transform(sequence_features(rows))
    p = vector_to_array("_probability")
    return scored.select(
        *df.columns, p[1].alias("spike_probability"), p[0].alias("normal_probability")
    )


# --- models as a table ----------------------------------------------------------------


def fit_spike_model(
    labelled: DataFrame, model_key: str, trained_at: datetime, label: str = "label", max_iter: int = 20
) -> DataFrame:
    """One row of the model table: fit on (seq, label), standardisation and weights in plain columns."""
    model, losses = train_spike_classifier(labelled, label, max_iter)
    scaler, weights = model.stages[1], model.stages[2]
    row = (
        model_key, trained_at, labelled.count(), scaler.mean.toArray().tolist(), scaler.std.toArray().tolist(),
        weights.coefficients.toArray().tolist(), float(weights.intercept), [float(x) for x in losses],
    )
    return labelled.sparkSession.createDataFrame([row], MODELS)


def prior_models(features: DataFrame, model_key: Column, trained_at: Column) -> DataFrame:
    """Model rows without labels: the features' own means and spreads with ``PRIOR_WEIGHTS``."""
    cells = features.groupBy(model_key.alias("model_key"), trained_at.alias("trained_at")).agg(
        F.count("*").alias("n_rows"),
        F.array(*[F.avg(f) for f in FEATURES]).alias("means"),
        F.array(*[F.coalesce(F.stddev_samp(f), F.lit(0.0)) for f in FEATURES]).alias("scales"),
    )
    return cells.withColumns(
        {
            "coefficients": F.array(*map(F.lit, PRIOR_WEIGHTS)),
            "intercept": F.lit(PRIOR_INTERCEPT),
            "losses": F.array().cast("array<double>"),
        }
    )


def append_models(models: DataFrame, path: str) -> None:
    """Add versions to the model table, one folder per day of training."""
    rows = models.withColumn("trained_on", F.to_date("trained_at"))
    rows.write.mode("append").partitionBy("trained_on").parquet(path)


def models_as_of(models: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The newest version of each model, or the newest one trained by ``as_of``."""
    if as_of is not None:
        models = models.where(F.col("trained_at") <= F.lit(as_of).cast(models.schema["trained_at"].dataType))
    rest = [c for c in models.columns if c not in ("model_key", "trained_on")]
    newest = models.groupBy("model_key").agg(F.max_by(F.struct(*rest), "trained_at").alias("_m"))
    return newest.select("model_key", "_m.*")


def score_with_models(df: DataFrame, models: DataFrame, model_key: str) -> DataFrame:
    """Add ``trained_at`` and ``spike_probability`` to (…, seq) rows from the model of each row's ``model_key``.

    The score is a column expression over the model's own columns, so it needs a join and nothing else; a row
    without a model has no score. A feature that did not vary in training adds nothing.
    """
    x = F.array(*FEATURES)
    scaled = F.transform(
        F.arrays_zip(x.alias("x"), F.col("_w.means").alias("m"), F.col("_w.scales").alias("s"), F.col("_w.coefficients").alias("c")),
        lambda f: F.when(f["s"] > 0, (f["x"] - f["m"]) / f["s"] * f["c"]).otherwise(0.0),
    )
    margin = F.col("_w.intercept") + _total(scaled)
    held = models.select(F.col("model_key").alias(model_key), F.struct("trained_at", "means", "scales", "coefficients", "intercept").alias("_w"))
    joined = sequence_features(df).join(held, model_key, "left")
    odds = F.when(F.col("_w").isNotNull(), 1 / (1 + F.exp(-margin)))
    return joined.select(*df.columns, F.col("_w.trained_at").alias("trained_at"), odds.alias("spike_probability"))


def plant_spikes(
    df: DataFrame, keys: list[str], column: str = "seq", share: int = 40, first: int = 110, last: int = 150
) -> DataFrame:
    """Lift the tail of ``share`` percent of the sequences by a factor of 2.5 to 5 and label them.

    Which sequence, from where and by how much is drawn by hashes of its keys, never from its values.
    """
    draw = lambda salt, n: F.pmod(F.xxhash64(*keys, F.lit(salt)), F.lit(n))
    factor = 2.5 + draw("height", 1000) / 400
    onset = first + draw("onset", last - first)
    lifted = F.transform(column, lambda x, i: F.when(i >= onset, x * factor).otherwise(x))
    chosen = draw("chosen", 100) < share
    return df.withColumns({column: F.when(chosen, lifted).otherwise(F.col(column)), "label": chosen.cast("int")})


def classifier_quality(
    scored: DataFrame, probability: str = "spike_probability", label: str = "label", threshold: float = 0.5,
    keys: list[str] | None = None,
) -> DataFrame:
    """Confusion counts with precision, recall and F1 (0 where undefined)."""
    flagged, real = F.col(probability) > threshold, F.col(label) == 1
    counts = scored.groupBy(*(keys or [])).agg(
        F.count_if(flagged & real).alias("tp"),
        F.count_if(flagged & ~real).alias("fp"),
        F.count_if(~flagged & real).alias("fn"),
        F.count_if(~flagged & ~real).alias("tn"),
    )
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp = F.col("tp")
    quality = counts.withColumns(
        {"precision": share(tp, tp + F.col("fp")), "recall": share(tp, tp + F.col("fn"))}
    )
    p, r = F.col("precision"), F.col("recall")
    return quality.withColumn("f1", share(p * r * 2, p + r))
