"""Load forecasts, their quality and the choice of a model."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.arma import forecast_mean
from fleetlens.functions.clock import epoch, instant
from fleetlens.functions.present import exact_round, fixed
from fleetlens.operators.reads import lookback
from fleetlens.operators.summaries import resample_mean
from fleetlens.params import (
    ARIMA_MIN_BUCKETS,
    DAY_BUCKETS,
    EMA_ALPHA,
    EMA_CONFIDENCE,
    FULL_HISTORY_BUCKETS,
    HISTORY_MINUTES,
    HORIZON_MINUTES,
    MODEL_ARIMA,
    MODEL_EMA,
    MODEL_NONE,
    MODEL_SEASONAL,
)

BUCKET_S = 300
EPS = 1e-6
Z95 = 1.96


def load_series(
    metrics: DataFrame,
    keys: list[str] | None = None,
    minutes: int = HISTORY_MINUTES,
    as_of: datetime | None = None,
    agg: str = "avg",
    width: str = "5 minutes",
) -> DataFrame:
    """Bucketed request-rate history ``(keys, ds, y)``.

    A series has at most ``minutes / width`` rows whatever the number of
    samples, which bounds every per-series step below.
    """
    return resample_mean(lookback(metrics, "timestamp", minutes, as_of), "timestamp", "requests_per_sec", keys, width, agg)


# --- one row per series ----------------------------------------------------------


#: How daily and weekly factors are taken: the mean of ratios, or ``"sum"`` for a ratio of sums.
FACTORS = "mean"


def _ranked(series: DataFrame, keys: list[str]) -> DataFrame:
    """Buckets with their rank from the newest, the series' size, first time and newest value."""
    whole = Window.partitionBy(*keys)
    newest = whole.orderBy(F.col("ds").desc_nulls_last())
    return series.select(*keys, "ds", "y").withColumns(
        {
            "_rank": F.row_number().over(newest),
            "_n": F.count("ds").over(whole),
            "_t0": F.min("ds").over(whole),
            "_last": F.first("y").over(newest),
        }
    )


def _ema_terms(alpha: float = EMA_ALPHA) -> dict[str, Column]:
    """Terms whose sums over a series are its exponential average and the sum of its first half.

    The average is closed: the newest value weighs alpha, each older one (1 - alpha) times the one after it, and
    the oldest keeps the whole rest.
    """
    age = F.col("_rank") - 1
    weight = F.when(F.col("_rank") == F.col("_n"), 1.0).otherwise(alpha) * F.pow(F.lit(1 - alpha), age)
    half = F.floor(F.col("_n") / 2)
    return {"_ema": F.col("y") * weight, "_head": F.when(F.col("_n") - F.col("_rank") < half, F.col("y"))}


def _ema_value(n: Column, ema: Column, head: Column, steps: int) -> Column:
    """Average plus trend, where the trend is its lift over the first half's mean.

    A single value has no first half; its forecast is zero.
    """
    half = F.floor(n / 2)
    trend = (ema - F.try_divide(head, half)) / F.nullif(half, F.lit(0))
    return F.when(half > 0, F.greatest(F.lit(0.0), ema + trend * steps)).otherwise(0.0)


def _spread_of(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from sums (of values near zero)."""
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), squares - total * total / n) / (n - 1)))


def _line(n: Column, x: Column, xx: Column, y: Column, xy: Column) -> tuple[Column, Column]:
    """Slope and level of the least-squares line from sums."""
    slope = F.try_divide(n * xy - x * y, n * xx - x * x)
    return slope, (y - slope * x) / F.nullif(n, F.lit(0))


def series_facts(series: DataFrame, keys: list[str] | None = None, factors: str = FACTORS) -> DataFrame:
    """One row per series with all that a forecast needs, from one pass over its buckets.

    Buckets are first summed per (weekday, day slot) cell: counts and sums of t, t*t, y, y*y and t*y are enough
    for the line, the factors and the residual spread, so what follows works on at most 2016 cells a series
    whatever the length of the history. A factor is the mean ratio of a bucket's value to the line (times the daily
    factor) in its cells, for which each bucket first learns its series' line; with ``factors="sum"`` it is the sum of
    values over that of the line instead. Series too short for the seasonal model keep their values as an ordered array.
    """
    keys = keys or []
    t = (epoch("ds") - epoch("_t0")) / 86400
    y, recent = F.col("y"), F.col("_rank") <= DAY_BUCKETS
    moved = F.when(recent, y - F.col("_last"))  # so that a flat stretch has no spread at all
    short = (F.col("_n") >= ARIMA_MIN_BUCKETS) & (F.col("_n") < FULL_HISTORY_BUCKETS)
    ranked = _ranked(series, keys).withColumn("_t", t)
    whole = Window.partitionBy(*keys)
    if factors == "mean":
        total = lambda value: F.sum(value).over(whole)
        at = F.col("_t")
        slope, level = _line(F.col("_n"), total(at), total(at * at), total(y), total(at * y))
        ranked = ranked.withColumns({"_slope": slope, "_level": level})
        ranked = ranked.withColumn("_ratio", F.try_divide(y, F.col("_level") + F.col("_slope") * at))
    else:
        ranked = ranked.withColumn("_ratio", F.lit(None).cast("double"))
    cells = ranked.withColumns({**_slots(ranked, "ds"), **_ema_terms()}).groupBy(*keys, "_slot", "_dow").agg(
        F.first("_n").alias("n"),
        F.min("_t0").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.count("ds").alias("c"),
        F.sum("_t").alias("st"),
        F.sum(F.col("_t") * F.col("_t")).alias("stt"),
        F.sum("y").alias("sy"),
        F.sum(y * y).alias("syy"),
        F.sum(F.col("_t") * y).alias("sty"),
        F.sum("_ratio").alias("sr"),
        F.count("_ratio").alias("cr"),
        F.sum(F.when(F.col("_rank") == 1, y)).alias("current"),
        F.sum(F.when(F.col("_rank") == 2, y)).alias("previous"),
        F.count(moved).alias("rc"),
        F.sum(moved).alias("rs"),
        F.sum(moved * moved).alias("rss"),
        F.sum("_ema").alias("ema"),
        F.sum("_head").alias("head"),
        F.collect_list(F.when(short, F.struct("ds", "y"))).alias("short"),
    )
    total = lambda name: F.sum(name).over(whole)
    slope, level = _line(total("c"), total("st"), total("stt"), total("sy"), total("sty"))
    line = cells.withColumns({"slope": slope, "level": level})
    line = line.withColumn("trend", F.col("level") * F.col("c") + F.col("slope") * F.col("st"))
    factor = lambda part, value, base: F.coalesce(
        F.try_divide(F.sum(value).over(part), F.sum(base).over(part)), F.lit(1.0)
    )
    by_slot, by_day, daily = Window.partitionBy(*keys, "_slot"), Window.partitionBy(*keys, "_dow"), F.col("daily")
    if factors == "mean":
        line = line.withColumn("daily", factor(by_slot, F.col("sr"), F.col("cr")))
        known = F.when(daily != 0, F.col("cr"))
        line = line.withColumn("weekly", factor(by_day, F.try_divide(F.col("sr"), daily), known))
    else:
        line = line.withColumn("daily", factor(by_slot, F.col("sy"), F.col("trend")))
        line = line.withColumn("weekly", factor(by_day, F.col("sy"), F.col("trend") * daily))
    f, a, b = F.col("daily") * F.col("weekly"), F.col("level"), F.col("slope")
    squares = (
        F.col("syy")
        - 2 * f * (a * F.col("sy") + b * F.col("sty"))
        + f * f * (a * a * F.col("c") + 2 * a * b * F.col("st") + b * b * F.col("stt"))
    )
    facts = line.withColumns({"rest": F.col("sy") - f * F.col("trend"), "rest2": squares}).groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("last_ds").alias("last_ds"),
        F.min("first_ds").alias("first_ds"),
        F.max("slope").alias("slope"),
        F.max("level").alias("level"),
        _spread_of(F.sum("c"), F.sum("rest"), F.sum("rest2")).alias("sigma"),
        F.sum("current").alias("current_value"),
        F.sum("previous").alias("previous_value"),
        F.coalesce(_spread_of(F.sum("rc"), F.sum("rs"), F.sum("rss")), F.lit(0.0)).alias("recent_std"),
        F.map_from_entries(F.collect_set(F.when(F.col("c") > 0, F.struct("_slot", "daily")))).alias("daily"),
        F.map_from_entries(F.collect_set(F.when(F.col("c") > 0, F.struct("_dow", "weekly")))).alias("weekly"),
        F.sum("ema").alias("ema"),
        F.sum("head").alias("head"),
        F.flatten(F.collect_list("short")).alias("short"),
    )
    days = (epoch("last_ds") - epoch("first_ds")) / 86400
    values = F.transform(F.array_sort("short"), lambda p: p["y"])
    return facts.withColumns({"training_days": days, "values": values}).drop("short")


# --- exponential average --------------------------------------------------------


def ema_of(values: Column, alpha: float = EMA_ALPHA) -> Column:
    rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.aggregate(rest, values[0], lambda acc, x: x * alpha + acc * (1 - alpha))


def ema_forecast_of(values: Column, steps: int, alpha: float = EMA_ALPHA) -> Column:
    """The exponential forecast of a short array of values."""
    half = F.floor(F.size(values) / 2).cast("int")
    head = F.aggregate(F.slice(values, F.lit(1), half), F.lit(0.0), lambda acc, x: acc + x)
    return _ema_value(F.size(values), ema_of(values, alpha), head, steps)


def ema_forecast(series: DataFrame, keys: list[str] | None = None, steps: int = HORIZON_MINUTES) -> DataFrame:
    """Exponential average plus trend of each series, from sums over its ranked buckets."""
    keys = keys or []
    sums = _ranked(series, keys).withColumns(_ema_terms()).groupBy(*keys).agg(
        F.count("ds").cast("int").alias("n"), F.sum("_ema").alias("_ema"), F.sum("_head").alias("_head")
    )
    return sums.where("n > 0").select(
        *keys,
        "n",
        _ema_value(F.col("n"), F.col("_ema"), F.col("_head"), steps).alias("predicted"),
        F.lit(EMA_CONFIDENCE).alias("confidence"),
    )


def rolling_ema_forecast(
    series: DataFrame, keys: list[str] | None = None, history: int = 12, steps: int = HORIZON_MINUTES
) -> DataFrame:
    """A forecast at every bucket from its ``history`` newest buckets."""
    keys = keys or []
    w = Window.partitionBy(*keys).orderBy("ds").rowsBetween(1 - history, 0)
    values = series.withColumn("_v", F.collect_list("y").over(w))
    return values.select(*keys, "ds", "y", ema_forecast_of(F.col("_v"), steps).alias("predicted"))


# --- autoregressive forecast ------------------------------------------------------

def _arima_fit(steps: int):
    """Mean and 80 % interval width of a series given as an array; null where the model does not fit."""

    @F.pandas_udf("mean double, width double")
    def fit(values: pd.Series) -> pd.DataFrame:
        found = [None if v is None or len(v) < ARIMA_MIN_BUCKETS else forecast_mean(np.asarray(v, float), steps) for v in values]
        return pd.DataFrame([f or (None, None) for f in found], columns=["mean", "width"]).astype("float64")

    return fit


def _arima_columns(fit: Column, ema: Column) -> dict[str, Column]:
    """Forecast, confidence and whether the fit was used, with the exponential forecast where it was not."""
    mean, width = fit["mean"], fit["width"]
    predicted = F.greatest(F.lit(0.0), mean)
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - width / (predicted + 1e-9) * 0.1))
    ok = mean.isNotNull() & ~F.isnan(mean) & width.isNotNull() & ~F.isnan(width)
    return {
        "predicted": F.when(ok, predicted).otherwise(ema),
        "confidence": F.when(ok, confidence).otherwise(EMA_CONFIDENCE),
        "fitted": ok,
    }


def arima_forecast(series: DataFrame, keys: list[str], steps: int = HORIZON_MINUTES) -> DataFrame:
    """ARIMA(2,1,2) mean forecast per series, EMA where it does not fit.

    The fit is a two-stage regression on one bucketed series (its rows are
    bounded by history / bucket width); series are spread over tasks.
    """
    ranked = _ranked(series, keys).withColumns(_ema_terms())
    lists = ranked.groupBy(*keys).agg(
        F.count("ds").cast("int").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("ds", "y"))), lambda p: p["y"]).alias("_v"),
        F.sum("_ema").alias("_ema"),
        F.sum("_head").alias("_head"),
    )
    fitted = lists.withColumn("_fit", _arima_fit(steps)("_v"))
    ema = _ema_value(F.col("n"), F.col("_ema"), F.col("_head"), steps)
    return fitted.withColumns(_arima_columns(F.col("_fit"), ema)).select(*keys, "n", "predicted", "confidence", "fitted")


# --- seasonal-trend forecast --------------------------------------------------------


def _slots(df: DataFrame, time: str) -> dict[str, Column]:
    seconds = F.floor(epoch(time)).cast("bigint")
    return {
        "_slot": F.floor((seconds % 86400) / BUCKET_S),
        "_dow": F.floor(seconds / 86400) % 7,
    }


def fit_seasonal(
    series: DataFrame,
    keys: list[str] | None = None,
    min_buckets: int = FULL_HISTORY_BUCKETS,
    factors: str = FACTORS,
) -> DataFrame:
    """Linear trend and multiplicative day-slot and weekday factors: one row per series with enough history."""
    return series_facts(series, keys, factors).filter(F.col("n") >= min_buckets)


def _ahead(model: DataFrame, keys: list[str], steps: Column) -> DataFrame:
    """Forecast of the given 5-minute steps after each model's newest bucket, with a 95 % interval."""
    future = model.withColumn("_step", F.explode(steps)).withColumn(
        "target", F.col("last_ds") + F.make_dt_interval(mins=F.col("_step") * 5)
    )
    future = future.withColumns(_slots(future, "target"))
    trend = F.col("level") + F.col("slope") * ((epoch("target") - epoch("first_ds")) / 86400)
    factor = lambda name, at: F.coalesce(F.try_element_at(F.col(name), F.col(at)), F.lit(1.0))
    future = future.withColumn("trend", trend)
    value = F.col("trend") * factor("daily", "_slot") * factor("weekly", "_dow")
    margin = F.coalesce("sigma", F.lit(0.0)) * Z95
    return future.withColumns(
        {
            "time_offset_minutes": F.col("_step") * 5,
            "predicted_value": value,
            "lower_bound": value - margin,
            "upper_bound": value + margin,
        }
    )


def seasonal_forecast(
    series: DataFrame | None,
    keys: list[str] | None = None,
    horizon_minutes: int = HORIZON_MINUTES,
    min_buckets: int = FULL_HISTORY_BUCKETS,
    model: DataFrame | None = None,
    factors: str = FACTORS,
) -> DataFrame:
    """Forecast of every 5-minute step up to the horizon, with a 95 % interval."""
    keys = keys or []
    model = model if model is not None else fit_seasonal(series, keys, min_buckets, factors)
    return _ahead(model, keys, F.sequence(F.lit(1), F.lit(horizon_minutes // 5))).select(
        *keys,
        "time_offset_minutes",
        "target",
        "predicted_value",
        "lower_bound",
        "upper_bound",
        "trend",
        "current_value",
        "previous_value",
        "recent_std",
        "n",
        "training_days",
    )


def spike_probability(upper: Column, current: Column) -> Column:
    limit = current * 1.5
    excess = F.try_divide(upper - limit, current + EPS) / 2
    return F.when(upper > limit, F.greatest(F.lit(0.0), F.least(F.lit(1.0), excess))).otherwise(0.0)


def interval_confidence(lower: Column, upper: Column, recent_std: Column) -> Column:
    ratio = (upper - lower) / (recent_std + EPS)
    raw = F.when(recent_std > 0, F.lit(1.0) / (ratio + 1)).otherwise(0.9)
    return F.greatest(F.lit(0.3), F.least(F.lit(0.95), raw))


def warning_text(predicted: Column, current: Column) -> Column:
    """Fixed wording by the size of the change."""
    change = F.try_divide(predicted - current, current) * 100
    shown = fixed(F.abs(change), 0)
    return (
        F.when(current == 0, "")
        .when(change > 100, F.concat(F.lit("⚠️ SPIKE ALERT: "), shown, F.lit("% increase predicted")))
        .when(change > 50, F.concat(F.lit("⚠️ SURGE: "), shown, F.lit("% increase detected")))
        .when(change < -50, F.concat(F.lit("⚠️ DROP ALERT: "), shown, F.lit("% decrease predicted")))
        .otherwise("")
    )


def trend_direction(predicted: Column, current: Column) -> Column:
    return F.when(predicted > current, "increasing").otherwise("decreasing")


def trend_value(predicted: Column, previous: Column) -> Column:
    return (predicted - previous) / (previous + EPS)


def next_10_minutes(
    series: DataFrame,
    keys: list[str] | None = None,
    min_buckets: int = FULL_HISTORY_BUCKETS,
    factors: str = FACTORS,
) -> DataFrame:
    """The full forecast card ten minutes ahead, one row per series."""
    keys = keys or []
    ahead = seasonal_forecast(series, keys, HORIZON_MINUTES, min_buckets, factors=factors).filter(
        F.col("time_offset_minutes") == HORIZON_MINUTES
    )
    p, cur = F.col("predicted_value"), F.col("current_value")
    lo, up = F.col("lower_bound"), F.col("upper_bound")
    return ahead.select(
        *keys,
        exact_round(p, 2).alias("predicted_value"),
        exact_round(cur, 2).alias("current_value"),
        exact_round(lo, 2).alias("lower_bound"),
        exact_round(up, 2).alias("upper_bound"),
        exact_round(up - lo, 2).alias("margin_of_error"),
        trend_direction(p, cur).alias("trend"),
        exact_round(trend_value(p, F.col("previous_value")), 3).alias("trend_value"),
        exact_round(spike_probability(up, cur), 2).alias("spike_probability"),
        exact_round(interval_confidence(lo, up, F.col("recent_std")), 2).alias("confidence"),
        warning_text(p, cur).alias("warning"),
    )


# --- model choice -------------------------------------------------------------------


def choose_model(counts: DataFrame, keys: list[str], trained: bool = True) -> DataFrame:
    full = F.lit(trained) & (F.col("n") >= FULL_HISTORY_BUCKETS)
    return counts.withColumn(
        "model_name",
        F.when(full, MODEL_SEASONAL)
        .when(F.col("n") >= ARIMA_MIN_BUCKETS, MODEL_ARIMA)
        .when(F.col("n") >= 1, MODEL_EMA)
        .otherwise(MODEL_NONE),
    )


def predict(
    series: DataFrame,
    wanted: DataFrame | None,
    keys: list[str],
    predicted_at: datetime,
    spike_scores: DataFrame | None = None,
    steps: int = HORIZON_MINUTES,
    factors: str = FACTORS,
) -> DataFrame:
    """Forecast rows for the series in ``wanted`` (default: all) from the best available model.

    All branches read one row of facts per series, so the buckets are read and shuffled once. ``spike_scores``
    (keys, spike_probability) replaces the interval-based probability of the seasonal model when a trained
    classifier is there; a series without a score keeps the interval's.
    """
    rows = series.select(*keys, "ds", "y")
    if wanted is not None:  # a wanted series without a bucket is one row without a time
        mark = wanted.select(*keys).distinct().select(*keys, F.lit(True).alias("_wanted"))
        rows = rows.withColumn("_wanted", F.lit(None).cast("boolean")).unionByName(mark, allowMissingColumns=True)
        named = Window.partitionBy(*keys)
        rows = rows.withColumn("_wanted", F.max("_wanted").over(named)).where("_wanted").drop("_wanted")
    facts = choose_model(series_facts(rows, keys, factors), keys)
    if spike_scores is not None:
        scores = spike_scores.select(*keys, F.col("spike_probability").alias("_score"))
        facts = facts.join(scores, keys, "left")
    else:
        facts = facts.withColumn("_score", F.lit(None).cast("double"))
    is_model = lambda name: F.col("model_name") == name
    ahead = _ahead(facts, keys, F.array(F.lit(HORIZON_MINUTES // 5)))
    ema = _ema_value(F.col("n"), F.col("ema"), F.col("head"), steps)
    ahead = ahead.withColumn("_flat", ema)
    ahead = ahead.withColumn("_fit", _arima_fit(steps)(F.when(is_model(MODEL_ARIMA), F.col("values"))))
    arima = _arima_columns(F.col("_fit"), F.col("_flat"))
    value, low, high = F.col("predicted_value"), F.col("lower_bound"), F.col("upper_bound")
    # per model: forecast, bounds, confidence and spike probability, before any rounding
    none = F.lit(0.0)
    raw = ahead.select(
        *keys,
        "model_name",
        F.when(is_model(MODEL_SEASONAL), F.array(value, low, high))
        .when(is_model(MODEL_ARIMA), F.array_repeat(arima["predicted"], 3))
        .when(is_model(MODEL_EMA), F.array_repeat(F.col("_flat"), 3))
        .otherwise(F.array_repeat(none, 3))
        .alias("_v"),
        F.when(is_model(MODEL_SEASONAL), interval_confidence(low, high, F.col("recent_std")))
        .when(is_model(MODEL_ARIMA), arima["confidence"])
        .when(is_model(MODEL_EMA), EMA_CONFIDENCE)
        .otherwise(none)
        .alias("_c"),
        F.when(is_model(MODEL_SEASONAL), spike_probability(high, F.col("current_value"))).otherwise(none).alias("_s"),
        F.when(is_model(MODEL_SEASONAL), F.col("_score")).alias("_score"),
    )
    rounded = F.transform("_v", lambda x: exact_round(x, 2))
    sure = F.when(is_model(MODEL_ARIMA), exact_round("_c", 3)).otherwise(exact_round("_c", 2))
    out = raw.withColumns({"_v": rounded, "_c": sure, "_s": F.coalesce("_score", exact_round("_s", 2))})
    return out.select(
        *keys,
        F.lit(predicted_at).alias("predicted_at"),
        F.lit(HORIZON_MINUTES).alias("horizon_minutes"),
        F.col("_v")[0].alias("predicted_rps"),
        F.lit(None).cast("double").alias("predicted_cpu"),
        F.col("_c").alias("confidence"),
        F.col("_v")[1].alias("lower_bound"),
        F.col("_v")[2].alias("upper_bound"),
        exact_round("_s", 3).alias("spike_probability"),
        "model_name",
    )


def needs_training(
    counts: DataFrame, registry: DataFrame, keys: list[str], as_of: datetime, max_age_minutes: float = 360
) -> DataFrame:
    """Which series are due for a fit: enough history, and no model or an old one."""
    joined = counts.join(registry.select(*keys, "trained_at"), keys, "left")
    age_s = epoch(instant(joined, "trained_at", as_of)) - epoch("trained_at")
    stale = F.col("trained_at").isNull() | (age_s >= max_age_minutes * 60)
    return joined.withColumn("retrain", stale & (F.col("n") >= FULL_HISTORY_BUCKETS))


# --- quality -------------------------------------------------------------------------


def against_actual(
    predictions: DataFrame, series: DataFrame, keys: list[str] | None = None, bucket_s: int = BUCKET_S
) -> DataFrame:
    """Each forecast beside the bucket it was made for (NULL when not observed)."""
    keys = keys or []
    us = bucket_s * 1_000_000
    aim = F.unix_micros(F.col("predicted_at").cast("timestamp")) + F.col("horizon_minutes") * 60_000_000
    kind = predictions.schema["predicted_at"].dataType
    target = F.timestamp_micros((F.floor(aim / us) * us).cast("bigint")).cast(kind)
    actual = series.select(*keys, F.col("ds").alias("target"), F.col("y").alias("actual"))
    return predictions.withColumn("target", target).join(actual, [*keys, "target"], "left")


def mape(pairs: DataFrame, keys: list[str] | None = None, predicted: str = "predicted_rps") -> DataFrame:
    a, p = F.col("actual"), F.col(predicted)
    return pairs.groupBy(*(keys or [])).agg((F.avg(F.abs((a - p) / (a + EPS))) * 100).alias("mape"))
