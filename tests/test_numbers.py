"""Percentiles, rounding, counters and histograms on small fixtures."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions import present
from fleetlens.functions.quantiles import exact_percentiles, ordered_bits
from fleetlens.functions.skew import ordered_rank, previous_sample
from fleetlens.operators import counters, summaries

T0 = datetime(2024, 1, 1)
PROBS = {"p50": 0.5, "p95": 0.95, "p99_9": 0.999, "low": 0.0, "high": 1.0}


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 60_000])
def test_exact_percentiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.3, 5.0, rng.lognormal(0, 2, n))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_percentiles(df, [], "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_exact_percentiles_by_key_with_a_hot_key(spark):
    rng = np.random.default_rng(3)
    data = {"hot": rng.normal(0, 1, 50_000), "cold": rng.normal(5, 2, 40), "one": np.array([3.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs]
    out = exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", PROBS)
    for row in out.collect():
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.percentile(data[row["k"]], p * 100), rel=1e-12)


def test_bits_keep_the_order_of_doubles(spark):
    rng = np.random.default_rng(8)
    raw = np.frombuffer(rng.bytes(8 * 4000), "<f8")
    values = [float(v) for v in raw if np.isfinite(v)]
    values += [0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1.0, np.nextafter(1, 2), np.nextafter(1, 0), float("inf")]
    values += [1.7976931348623157e308, -1.7976931348623157e308, float("-inf"), 4.0, np.nextafter(4, 0), 0.1, 0.2]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = [(r["v"], r["b"]) for r in df.select("v", ordered_bits(F.col("v")).alias("b")).collect()]
    want = {v: int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1) for v, _ in rows}
    assert all(b == want[v] for v, b in rows)


@pytest.mark.parametrize("values", [range(20_000), [7.5] * 5000, [-1.0, 1.0] * 700, [1e-300, 1e300, -1e300, 0.0], [float("inf"), 1.0]])
def test_percentiles_of_sorted_and_constant_input(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_percentiles(df, [], "v", PROBS).first()
    with np.errstate(invalid="ignore"):
        for name, p in PROBS.items():
            want = np.percentile(np.array(values, float), p * 100)
            assert row[name] == pytest.approx(want, rel=1e-12) or not np.isfinite(want)


def test_exact_percentiles_of_nothing(spark):
    row = exact_percentiles(spark.createDataFrame([], "v double"), [], "v", {"p50": 0.5}).first()
    assert row["p50"] is None


def test_fixed_text_equals_python_formatting(spark):
    values = [0.125, 2.675, 90.55, 86.85, 204.35, 0.5, 1.5, 2.5, -0.125, -2.675, 1e-9, 12345.678, 0.05, 1.005, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select("v", *[present.fixed("v", d).alias(f"d{d}") for d in (0, 1, 2)]).collect()
    for r in out:
        for d in (0, 1, 2):
            assert float(r[f"d{d}"]) == float(f"{r['v']:.{d}f}"), (r, d)


def test_presented_numbers(spark):
    df = spark.createDataFrame([(1234.56,), (None,), (float("nan"),), (5.0,)], "v double")
    out = df.select(present.fmt_number("v", 1).alias("n"), present.fmt_ms("v").alias("ms"), present.fmt_ratio_percent("v").alias("p")).collect()
    assert [r["n"] for r in out] == ["1,234.6", "0", "0", "5"]
    assert out[0]["ms"] == "1,234.6 ms" and out[3]["p"] == "500%"


def test_ordered_rank_and_previous_sample(spark):
    rows = [("a" if i % 3 else "b", T0 + timedelta(seconds=i * 7), float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    slot = F.floor(F.unix_seconds("ts") / 60)
    ranked = ordered_rank(df.withColumn("s", slot), ["k"], "s", [F.col("ts")], "rank").collect()
    for key in "ab":
        mine = sorted((r for r in ranked if r["k"] == key), key=lambda r: r["ts"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
    lagged = previous_sample(df, ["k"], "ts", "value", slot).collect()
    for key in "ab":
        mine = sorted((r for r in lagged if r["k"] == key), key=lambda r: r["ts"])
        assert mine[0]["prev_value"] is None
        assert all(b["prev_value"] == a["value"] for a, b in zip(mine, mine[1:]))


def _samples(spark, values, every=60):
    rows = [("s", T0 + timedelta(seconds=every * i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp, value double")


def test_counter_reset(spark):
    df = _samples(spark, [10, 15, 3, 5])
    deltas = [r["delta"] for r in counters.counter_deltas(df, ["k"]).orderBy("ts").collect()]
    assert deltas == [None, 5.0, 3.0, 2.0]


def test_increase_leaves_out_pairs_that_cross_the_window(spark):
    out = counters.increase(_samples(spark, [0, 10, 20, 30, 40]), ["k"], 120, 60).orderBy("t").collect()
    assert [r["increase"] for r in out] == [10.0, 10.0, 10.0, 10.0]


def test_single_sample_and_long_gap_give_no_rate(spark):
    assert counters.rate(_samples(spark, [5]), ["k"], 300).count() == 0
    assert counters.rate(_samples(spark, [5, 9], every=3600), ["k"], 300).count() == 0


def test_extrapolated_rate_of_a_steady_counter(spark):
    df = _samples(spark, [i * 6 for i in range(1, 30)], every=15).filter("value > 6")
    out = counters.rate(df, ["k"], 60, 60, extrapolate=True).orderBy("t").collect()
    assert out[2]["rate"] == pytest.approx(0.4)


def _buckets(spark, counts):
    rows = [("s", T0, le, float(c)) for le, c in counts]
    return spark.createDataFrame(rows, "k string, t timestamp, le double, rate double")


INF = float("inf")


@pytest.mark.parametrize(
    "counts,q,expected",
    [
        ([(0.1, 0), (0.5, 10), (1.0, 10), (INF, 10)], 0.5, 0.3),
        ([(0.1, 5), (0.5, 10), (INF, 20)], 0.95, 0.5),
        ([(0.1, 4), (0.5, 4), (1.0, 8), (INF, 8)], 0.75, 0.75),
        ([(0.1, 10), (INF, 10)], 0.5, 0.05),
    ],
)
def test_histogram_quantile(spark, counts, q, expected):
    out = counters.histogram_quantile(_buckets(spark, counts), ["k"], q).first()
    assert out["quantile"] == pytest.approx(expected)


def test_histogram_quantile_of_nothing(spark):
    assert counters.histogram_quantile(_buckets(spark, [(0.1, 0), (INF, 0)]), ["k"], 0.5).count() == 0
    only_inf = counters.histogram_quantile(_buckets(spark, [(INF, 4)]), ["k"], 0.5).first()
    assert only_inf["quantile"] is None


def test_hold_alert_needs_the_whole_spell(spark):
    rows = [(T0 + timedelta(minutes=i), v) for i, v in enumerate([9, 9, 1, 9, 9, 9, 9, 1, 9])]
    df = spark.createDataFrame(rows, "t timestamp, v int")
    out = counters.hold_alerts(df, [], F.col("v") > 5, 120, 60).collect()
    assert len(out) == 1 and out[0]["held_seconds"] == 180.0
    assert out[0]["firing_at"] == T0 + timedelta(minutes=5)


def test_apdex_stays_inside_one(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.9,), (3.0,)], "d double")
    assert counters.apdex(df, [], "d").first()["apdex"] == pytest.approx((2 + 0.5) / 4)


def test_latency_report_without_success(spark):
    df = spark.createDataFrame([(1.0, "TimeoutError")], "ms double, err string")
    row = summaries.latency_report(df, "ms", "err").first()
    assert row["samples"] == 0 and row["error_count"] == 1 and row["success"] is False and row["p50_ms"] is None


def test_load_test_window(spark):
    stats = spark.createDataFrame(
        [("POST", "/api/metrics", 341196, 0, 240.65, 660.0, 900.0, 569.52), (None, "Aggregated", 353755, 0, 238.99, 660.0, 900.0, 590.48)],
        "Type string, Name string, `Request Count` long, `Failure Count` long, `Average Response Time` double, `95%` double, `99%` double, `Requests/s` double",
    )
    history = spark.createDataFrame([(1704067200, 10, "Aggregated", 5.0), (1704067300, 20, "Aggregated", 7.0)], "Timestamp long, `User Count` int, Name string, `Requests/s` double")
    row = summaries.load_test_summary(stats, history).first()
    assert row["estimated_metrics"] == 341196 and row["peak_users"] == 20 and row["peak_rps"] == 7.0
    assert math.isclose(row["sustained_rps"], 590.48)
