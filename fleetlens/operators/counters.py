"""Counter, gauge and histogram queries over samples ``(ts, series keys, le?, value)``."""

from __future__ import annotations

from datetime import datetime
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch, epoch_us, floor_time, instant
from fleetlens.functions.skew import newest_per_key, previous_sample
from fleetlens.params import APDEX_SATISFIED, APDEX_TOLERABLE, CIRCUIT_STATES, HOLD_RULES

Keys = list[str]
CHUNK_S = 6 * 3600


# --- samples from tables ----------------------------------------------------


def counter_samples(
    rows: DataFrame, keys: Keys, time: str = "ts", scrape_s: int = 600, restart_s: int | None = None
) -> DataFrame:
    """Running row counts per label set, one sample per scrape that saw a change.

    Rows are counted per scrape first, so only bucket counts are ordered. With
    ``restart_s`` the counter starts from zero in each aligned period, as the
    counter of a restarted process does.
    """
    scrape = floor_time(rows, time, scrape_s) + F.expr(f"INTERVAL {scrape_s} SECONDS")
    counts = rows.groupBy(*keys, scrape.alias("ts")).agg(F.count("*").alias("_n"))
    return _running(counts, keys, "_n", restart_s)


def _running(counts: DataFrame, keys: Keys, amount: str, restart_s: int | None) -> DataFrame:
    life = [floor_time(counts, "ts", restart_s).alias("_life")] if restart_s else []
    lives = counts.select("*", *life)
    w = (
        Window.partitionBy(*keys, *(["_life"] if restart_s else []))
        .orderBy("ts")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return lives.select("ts", *keys, F.sum(amount).over(w).cast("double").alias("value"))


def histogram_samples(
    rows: DataFrame,
    keys: Keys,
    value: str,
    edges: list[float],
    time: str = "ts",
    scrape_s: int = 600,
    restart_s: int | None = None,
) -> DataFrame:
    """Cumulative bucket counters per label set and edge (``le``, +Inf last)."""
    scrape = floor_time(rows, time, scrape_s) + F.expr(f"INTERVAL {scrape_s} SECONDS")
    bounds = [*edges, float("inf")]
    per_edge = [F.count_if(F.col(value) <= F.lit(e)).alias(f"_b{i}") for i, e in enumerate(bounds)]
    wide = rows.groupBy(*keys, scrape.alias("ts")).agg(*per_edge)
    pairs = F.array(
        *[F.struct(F.lit(e).alias("le"), F.col(f"_b{i}").alias("n")) for i, e in enumerate(bounds)]
    )
    long = wide.select("ts", *keys, F.inline(pairs))
    return _running(long, [*keys, "le"], "n", restart_s)


def bucket_counts(rows: DataFrame, keys: Keys, value: str, edges: list[float]) -> DataFrame:
    """Cumulative histogram of observations over the declared edges."""
    bounds = [*edges, float("inf")]
    per_edge = [F.count_if(F.col(value) <= F.lit(e)).alias(f"_b{i}") for i, e in enumerate(bounds)]
    wide = rows.groupBy(*keys).agg(*per_edge)
    pairs = F.array(
        *[F.struct(F.lit(e).alias("le"), F.col(f"_b{i}").alias("count")) for i, e in enumerate(bounds)]
    )
    return wide.select(*keys, F.inline(pairs))


# --- rates ------------------------------------------------------------------


def counter_deltas(samples: DataFrame, keys: Keys, chunk_s: int = CHUNK_S) -> DataFrame:
    """Growth since the preceding sample; a drop means a restart from zero."""
    chunk = floor_time(samples, "ts", chunk_s)
    with_prev = previous_sample(samples, keys, "ts", "value", chunk)
    delta = F.when(F.col("value") < F.col("prev_value"), F.col("value")).otherwise(
        F.col("value") - F.col("prev_value")
    )
    return with_prev.withColumn("delta", delta)


def _grid(pane_us: Column, window_us: int, step_us: int, origin: Column, end: Column | None, clip: bool) -> Column:
    """Evaluation times (microseconds) whose window ``(t - window, t]`` holds a pane."""
    first = F.ceil((pane_us - origin) / F.lit(step_us)) * step_us + origin
    last = F.floor((pane_us + F.lit(window_us - 1) - origin) / F.lit(step_us)) * step_us + origin
    if clip:
        first = F.greatest(first, origin)
    if end is not None:
        last = F.least(last, end)
    return F.when(first <= last, F.sequence(first, last, F.lit(step_us).cast("bigint")))


def increase(
    samples: DataFrame,
    keys: Keys,
    window_s: int,
    step_s: int | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """Counter growth inside ``(t - window, t]`` at each step of an aligned grid.

    Only pairs of samples that both lie in the window count, so the growth up
    to a window's first sample is left out. A window with one sample gives no
    row. ``extrapolate`` extends the growth to the window's edges in the way the
    PromQL functions do.

    Samples are folded into panes that divide both window and step before panes
    fan out to overlapping windows, so the fan-out does not grow with the number
    of samples.
    """
    step_s = step_s or window_s
    window_us, step_us = window_s * 1_000_000, step_s * 1_000_000
    pane_us = gcd(window_us, step_us)
    deltas = counter_deltas(samples, keys)
    kind = samples.schema["ts"].dataType
    origin = epoch_us(instant(samples, "ts", start)) if start else F.lit(0)
    limit = epoch_us(instant(samples, "ts", end)) if end else None
    pane = F.ceil((epoch_us("ts") - origin) / F.lit(pane_us)) * pane_us + origin
    panes = deltas.groupBy(*keys, pane.alias("_pane")).agg(
        F.sum("delta").alias("_sum"),
        F.count("*").alias("_n"),
        F.min("ts").alias("_first"),
        F.min_by("delta", "ts").alias("_first_delta"),
        F.min_by("value", "ts").alias("_first_value"),
        F.max("ts").alias("_last"),
    )
    points = _grid(F.col("_pane"), window_us, step_us, origin, limit, start is not None)
    grown = (
        panes.withColumn("_t", F.explode(points))
        .groupBy(*keys, "_t")
        .agg(
            F.sum("_sum").alias("_sum"),
            F.sum("_n").alias("_n"),
            F.min_by("_first_delta", "_first").alias("_first_delta"),
            F.min_by("_first_value", "_first").alias("_first_value"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
        .filter(F.col("_n") > 1)
        .withColumns(
            {
                "t": F.timestamp_micros("_t").cast(kind),
                "increase": F.col("_sum") - F.coalesce("_first_delta", F.lit(0.0)),
            }
        )
    )
    if not extrapolate:
        return grown.select(*keys, "t", "increase")
    first, last = epoch("_first"), epoch("_last")
    sampled = last - first
    gap = sampled / (F.col("_n") - 1)
    to_start = first - (epoch("t") - window_s)
    to_end = epoch("t") - last
    reach = gap * 1.1
    head = F.when(to_start >= reach, gap / 2).otherwise(to_start)
    to_zero = F.when(
        (F.col("increase") > 0) & (F.col("_first_value") >= 0),
        sampled * F.col("_first_value") / F.col("increase"),
    )
    head = F.least(head, to_zero)
    tail = F.when(to_end >= reach, gap / 2).otherwise(to_end)
    return grown.select(*keys, "t", (F.col("increase") * ((sampled + head + tail) / sampled)).alias("increase"))


def rate(samples: DataFrame, keys: Keys, window_s: int, step_s: int | None = None, **options) -> DataFrame:
    """Growth per second."""
    grown = increase(samples, keys, window_s, step_s, **options)
    return grown.select(*keys, "t", (F.col("increase") / float(window_s)).alias("rate"))


def per_minute(samples: DataFrame, keys: Keys, window_s: int, step_s: int | None = None, **options) -> DataFrame:
    rates = rate(samples, keys, window_s, step_s, **options)
    return rates.select(*keys, "t", (F.col("rate") * 60).alias("per_minute"))


def sum_by(rates: DataFrame, labels: Keys, value: str = "rate") -> DataFrame:
    return rates.groupBy(*labels, "t").agg(F.sum(value).alias(value))


def matching(df: DataFrame, label: str, pattern: str) -> DataFrame:
    """Label regex match, anchored at both ends."""
    return df.filter(F.col(label).rlike(f"^(?:{pattern})$"))


def status_class_rates(rates: DataFrame, status: str = "status", value: str = "rate") -> DataFrame:
    """Summed rates of the 2xx, 4xx and 5xx classes at each time."""
    total = lambda d: F.coalesce(
        F.sum(F.when(F.col(status).rlike(f"^(?:{d}..)$"), F.col(value))), F.lit(0.0)
    )
    return rates.groupBy("t").agg(
        total("2").alias("rate_2xx"), total("4").alias("rate_4xx"), total("5").alias("rate_5xx")
    )


def error_percentage(rates: DataFrame, labels: Keys | None = None, status: str = "status") -> DataFrame:
    """Share of 5xx in all requests, in percent."""
    failed = F.sum(F.when(F.col(status).rlike("^(?:5..)$"), F.col("rate")).otherwise(0.0))
    return rates.groupBy(*(labels or []), "t").agg(
        (F.try_divide(failed, F.sum("rate")) * 100).alias("error_percent")
    )


def histogram_quantile(buckets: DataFrame, keys: Keys, q: float, value: str = "rate") -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds the rank.

    ``buckets`` has one row per (keys, t, le). A rank in the +Inf bucket gives
    the last finite edge; an empty histogram gives NULL.
    """
    group = [*keys, "t"]
    order = Window.partitionBy(*group).orderBy("le")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    infinite = F.col("le") == float("inf")
    b = buckets.select(*group, "le", F.max(value).over(upto).alias("_c")).withColumns(
        {
            "_below": F.coalesce(F.lag("_c").over(order), F.lit(0.0)),
            "_lower": F.coalesce(F.lag("le").over(order), F.lit(0.0)),
            "_total": F.max(F.when(infinite, F.col("_c"))).over(whole),
            "_last": F.max(F.when(~infinite, F.col("le"))).over(whole),
        }
    )
    rank = F.lit(q) * F.col("_total")
    hit = b.filter((F.col("_total") > 0) & (F.col("_c") >= rank))
    lower = F.when((F.col("_lower") == 0.0) & (F.col("le") <= 0), F.col("le")).otherwise(F.col("_lower"))
    inside = lower + (F.col("le") - lower) * F.coalesce(
        F.try_divide(rank - F.col("_below"), F.col("_c") - F.col("_below")), F.lit(0.0)
    )
    found = F.when(infinite, F.col("_last")).otherwise(inside)
    picked = hit.groupBy(*group).agg(F.min_by(found, "le").alias("quantile"))
    return picked


def mean_from_sums(sum_rates: DataFrame, count_rates: DataFrame, keys: Keys) -> DataFrame:
    """Mean observation: growth of the sum over growth of the count."""
    left = sum_rates.withColumnRenamed("rate", "_sum")
    right = count_rates.withColumnRenamed("rate", "_count")
    return left.join(right, [*keys, "t"]).select(
        *keys, "t", F.try_divide(F.col("_sum"), F.col("_count")).alias("mean")
    )


def value_sum_samples(
    rows: DataFrame, keys: Keys, value: str, time: str = "ts", scrape_s: int = 600, restart_s: int | None = None
) -> DataFrame:
    """Running sum of an observed value, the ``_sum`` series of a histogram."""
    scrape = floor_time(rows, time, scrape_s) + F.expr(f"INTERVAL {scrape_s} SECONDS")
    sums = rows.groupBy(*keys, scrape.alias("ts")).agg(F.sum(value).alias("_v"))
    return _running(sums, keys, "_v", restart_s)


def gauge_stats(samples: DataFrame, labels: Keys, value: str = "value") -> DataFrame:
    return samples.groupBy(*labels).agg(F.avg(value).alias("avg"), F.max(value).alias("max"))


def apdex(rows: DataFrame, keys: Keys, duration: str) -> DataFrame:
    """(satisfied + half of the tolerated) over all."""
    satisfied = F.count_if(F.col(duration) <= APDEX_SATISFIED)
    tolerated = F.count_if(F.col(duration) <= APDEX_TOLERABLE)
    score = F.try_divide(satisfied + (tolerated - satisfied) * 0.5, F.count("*"))
    return rows.groupBy(*keys).agg(score.alias("apdex"))


def slow_share(rows: DataFrame, keys: Keys, duration: str, limits: dict[str, float]) -> DataFrame:
    """Share of requests above each limit."""
    return rows.groupBy(*keys).agg(
        *[
            F.try_divide(F.count_if(F.col(duration) > limit), F.count("*")).alias(name)
            for name, limit in limits.items()
        ]
    )


def hit_ratio(hits: str | Column, misses: str | Column) -> Column:
    h = F.col(hits) if isinstance(hits, str) else hits
    m = F.col(misses) if isinstance(misses, str) else misses
    return F.try_divide(h, h + m)


def used_percent(used: Column, limit: Column) -> Column:
    return F.try_divide(used, limit) * 100


def megabytes(column: str) -> Column:
    return F.col(column) / 1024 / 1024


# --- alerts, gauges, totals ---------------------------------------------------


def hold_alerts(
    points: DataFrame, keys: Keys, condition: Column, hold_s: float, step_s: float, time: str = "t"
) -> DataFrame:
    """Spells during which ``condition`` held at every step for at least ``hold_s``.

    A missing step ends a spell, as a series without a value ends an alert.
    """
    points = points.select(*keys, F.col(time).alias("_t"), F.coalesce(condition, F.lit(False)).alias("_on"))
    order = Window.partitionBy(*keys).orderBy("_t")
    gap = epoch("_t") - epoch(F.lag("_t").over(order)) > step_s
    breaks = F.when(~F.col("_on") | F.coalesce(gap, F.lit(False)), 1).otherwise(0)
    islands = points.withColumn("_break", breaks).withColumn(
        "_island", F.sum("_break").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    spells = (
        islands.filter("_on")
        .groupBy(*keys, "_island")
        .agg(F.min("_t").alias("active_since"), F.max("_t").alias("active_until"))
        .drop("_island")
    )
    held = epoch("active_until") - epoch("active_since")
    firing = F.col("active_since") + F.make_dt_interval(secs=F.lit(float(hold_s)))
    return spells.filter(held >= hold_s).withColumns({"firing_at": firing, "held_seconds": held})


def alert_rule(points: DataFrame, keys: Keys, rule: str, value: str, step_s: float, time: str = "t") -> DataFrame:
    """Spells of one of the production rules: ``value`` above the rule's threshold for the rule's hold time."""
    threshold, hold_s = HOLD_RULES[rule]
    spells = hold_alerts(points, keys, F.col(value) > threshold, hold_s, step_s, time)
    return spells.select(F.lit(rule).alias("rule"), *keys, "active_since", "active_until", "firing_at", "held_seconds")


def against_earlier(points: DataFrame, keys: Keys, value: str, offset_s: int, factor: float) -> DataFrame:
    """Compare each point with the one ``offset_s`` before it."""
    shifted = points.select(
        *keys,
        (F.col("t") + F.expr(f"INTERVAL {offset_s} SECONDS")).alias("t"),
        F.col(value).alias("earlier"),
    )
    joined = points.select(*keys, "t", F.col(value).alias("now")).join(shifted, [*keys, "t"])
    return joined.withColumn("exceeds", F.col("now") > F.col("earlier") * factor)


def instant_values(samples: DataFrame, keys: Keys, time: str = "ts") -> DataFrame:
    """Newest value of each series; of samples with the same time, the largest."""
    return newest_per_key(samples, keys, [F.col(time).desc(), F.col("value").desc()]).select(*keys, time, "value")


def state_name(value: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in CIRCUIT_STATES.items() for x in pair])
    return F.try_element_at(mapping, value.cast("int"))


def health_name(value: Column) -> Column:
    return F.when(value == 1, "healthy").otherwise("degraded")


def totals_with_share(samples: DataFrame, keys: Keys, label: str) -> DataFrame:
    """Newest counter totals by label with their share of the whole."""
    totals = instant_values(samples, keys).groupBy(label).agg(F.sum("value").alias("total"))
    return totals.withColumn("share", F.try_divide(F.col("total"), F.sum("total").over(Window.partitionBy())))
