"""Forecasts, spike classifier and outlier detector against quality bars."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
import xxhash

from fleetlens.functions.arma import forecast_mean
from fleetlens.functions.forest import grow_forest, score_rows
from fleetlens.operators import anomaly, forecast, spikes
from fleetlens.params import MODEL_ARIMA, MODEL_EMA, MODEL_NONE, MODEL_SEASONAL

T0 = datetime(2024, 1, 1)


def _frame(spark, values, key="a"):
    pdf = pd.DataFrame({"k": key, "ds": [T0 + timedelta(minutes=5 * i) for i in range(len(values))], "y": np.asarray(values, float)})
    return spark.createDataFrame(pdf)


def _daily_weekly(n=4320, seed=1):
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    offsets = np.array([10, 15, 20, 25, 30, 5, 0])[(i // 288) % 7]
    return np.clip(200 + 50 * np.sin(2 * np.pi * i / 288) + offsets + rng.normal(0, 10, n), 50, 500)


def _ema(values, steps):
    level = values[0]
    for v in values[1:]:
        level = v * 0.3 + level * 0.7
    half = len(values) // 2
    return max(0.0, level + (level - sum(values[:half]) / half) / half * steps) if half else 0.0


@pytest.mark.parametrize("values", [[100, 110, 105, 120, 115], [50] * 20, [1, 2, 1, 2], [200] * 30, [7]])
def test_ema(spark, values):
    row = forecast.ema_forecast(_frame(spark, values)).first()
    assert row["confidence"] == 0.6 and row["predicted"] == pytest.approx(_ema([float(v) for v in values], 10))


def test_arima_short_series_falls_back(spark):
    both = _frame(spark, range(10, 40), "long").union(_frame(spark, [10, 12, 11], "short"))
    rows = {r["k"]: r for r in forecast.arima_forecast(both, ["k"]).collect()}
    assert rows["long"]["fitted"] and 40 <= rows["long"]["predicted"] <= 55
    assert not rows["short"]["fitted"] and rows["short"]["confidence"] == 0.6


def test_arima_of_constant_series():
    mean, width = forecast_mean(np.full(50, 5.0), 10)
    assert mean == pytest.approx(5.0) and width == pytest.approx(0.0, abs=1e-6)


def test_seasonal_needs_full_history(spark):
    assert forecast.seasonal_forecast(_frame(spark, [200.0] * 1440)).count() == 0


def test_seasonal_holdout_mape_and_bounds(spark):
    values = _daily_weekly()
    out = forecast.seasonal_forecast(_frame(spark, values[:4308]), horizon_minutes=60).orderBy("time_offset_minutes").collect()
    assert [r["time_offset_minutes"] for r in out] == list(range(5, 61, 5))
    actual = values[4308:4320]
    error = np.mean([abs((a - r["predicted_value"]) / (a + 1e-6)) for a, r in zip(actual, out)]) * 100
    assert error < 25
    assert all(r["lower_bound"] <= r["predicted_value"] <= r["upper_bound"] for r in out)


def test_model_choice(spark):
    counts = spark.createDataFrame([(0,), (1,), (7,), (8,), (2015,), (2016,)], "n int")
    got = [r["model_name"] for r in forecast.choose_model(counts, []).orderBy("n").collect()]
    assert got == [MODEL_NONE, MODEL_EMA, MODEL_EMA, MODEL_ARIMA, MODEL_ARIMA, MODEL_SEASONAL]


def test_predict_covers_every_wanted_series(spark):
    series = _frame(spark, _daily_weekly(2100), "full").union(_frame(spark, range(20, 60), "mid")).union(_frame(spark, [5, 6], "few"))
    wanted = spark.createDataFrame([("full",), ("mid",), ("few",), ("none",)], "k string")
    rows = {r["k"]: r for r in forecast.predict(series, wanted, ["k"], T0).collect()}
    assert {k: r["model_name"] for k, r in rows.items()} == {
        "full": MODEL_SEASONAL, "mid": MODEL_ARIMA, "few": MODEL_EMA, "none": MODEL_NONE,
    }
    assert rows["none"]["predicted_rps"] == 0.0 and rows["mid"]["lower_bound"] == rows["mid"]["upper_bound"]


def test_sequences_pad_and_normalise(spark):
    row = spikes.z_normalise(spikes.sequences(_frame(spark, [1.0, 2.0, 3.0]), ["k"])).first()
    assert len(row["seq"]) == 288 and row["seq"][:286] == [1.0] * 286 and row["seq"][-1] == 3.0
    assert np.mean(row["z"]) == pytest.approx(0, abs=1e-9) and np.std(row["z"]) == pytest.approx(1)
    flat = spikes.z_normalise(spikes.sequences(_frame(spark, [4.0] * 300), ["k"])).first()
    assert set(flat["z"]) == {0.0}


def _labelled(spark, n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rng.uniform(100, 200)
        seq = base + rng.normal(0, base * 0.05, 288)
        label = int(rng.random() >= 0.6)
        if label:
            seq[rng.integers(110, 150):] *= rng.uniform(2.5, 5.0)
        rows.append((i, [float(v) for v in seq], label))
    return spark.createDataFrame(rows, "id int, seq array<double>, label int")


def test_spike_classifier_quality(spark):
    model, losses = spikes.train_spike_classifier(_labelled(spark, 200, 1))
    assert losses[-1] < losses[0]
    scored = spikes.score_sequences(model, _labelled(spark, 100, 2))
    q = spikes.classifier_quality(scored).first()
    assert q["recall"] > 0.6 and q["precision"] > 0.5
    p = scored.first()
    assert p["spike_probability"] + p["normal_probability"] == pytest.approx(1)


def test_wrong_sequence_length_is_refused(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "seq array<double>")
    with pytest.raises(Exception, match="expected 288"):
        spikes.check_length(df).collect()


def test_forest_ranks_a_planted_outlier_first():
    rng = np.random.default_rng(0)
    data = rng.normal(50, 3, (400, 4)).astype("float32")
    data[17] = [99, 99, 900, 9]
    scores = score_rows(data, grow_forest(data, 100, 256, 42))
    assert scores.argmin() == 17 and -1 <= scores.min() < scores.max() < 0


def test_outliers_planted_and_share(spark):
    rng = np.random.default_rng(5)
    rows = []
    for node in ("a", "b"):
        for i in range(600):
            cpu, mem, lat, rps = rng.normal([40, 50, 100, 200], [3, 3, 8, 10]).tolist()
            rows.append((i, node, T0 + timedelta(seconds=5 * i), cpu, mem, lat, rps, 40.0))
    rows.append((9999, "a", T0 + timedelta(seconds=3000), 99.0, 97.0, 2500.0, 5.0, 40.0))
    rows += [(i, "tiny", T0 + timedelta(seconds=2990), 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(20)]
    schema = "id int, node_id string, timestamp timestamp, cpu_usage double, memory_usage double, latency_ms double, requests_per_sec double, disk_usage double"
    df = spark.createDataFrame(rows, schema)
    out = anomaly.detect_outliers(df, recent_minutes=60, slice_rows=100).collect()
    by_node = {n: [r for r in out if r["node_id"] == n] for n in ("a", "b", "tiny")}
    assert any(r["id"] == 9999 for r in by_node["a"]) and not by_node["tiny"]
    assert all(0.03 <= len(by_node[n]) / 600 <= 0.07 for n in ("a", "b"))
    top = max(by_node["a"], key=lambda r: r["anomaly_score"])
    assert top["id"] == 9999 and top["description"].startswith("Isolation Forest outlier on a: cpu=99.0%")
    assert all(0.01 <= r["anomaly_score"] <= 1 for r in out)


def test_drawn_samples_equal_a_plain_draw(spark):
    def spark_hash(*values):
        seed = 42
        for v in values:
            width = 4 if isinstance(v, np.int32) else 8
            seed = xxhash.xxh64_intdigest(int(v).to_bytes(width, "little", signed=True), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    rng = np.random.default_rng(2)
    rows = [("small", i, 300) for i in range(300)] + [("mid", i, 700) for i in range(700)] + [("large", i, 9000) for i in range(9000)]
    frame = spark.createDataFrame([(k, float(rng.random()), 0.0, 0.0, 0.0, n, int(rng.integers(-(1 << 62), 1 << 62))) for k, _, n in rows],
        "node_id string, cpu_usage double, memory_usage double, latency_ms double, requests_per_sec double, n_rows long, _draw long")
    got = {}
    for r in anomaly.draw_samples(frame).collect():
        got.setdefault((r["node_id"], r["_tree"]), set()).add(r["_draw"])
    want = {}
    for r in frame.collect():
        offers = 100 * min(1.0, 512 / r["n_rows"])
        if r["n_rows"] <= 512:
            trees = set(range(100))
        else:
            count = int(offers + r["_draw"] % 1_000_003 / 1_000_003)
            trees = {spark_hash(np.int64(r["_draw"]), np.int32(j)) % 100 for j in range(1, count + 1)}
        for t in trees:
            want.setdefault((r["node_id"], t), []).append((spark_hash(np.int32(t), np.int64(r["_draw"])), r["_draw"]))
    assert {k: {d for _, d in sorted(v)[:256]} for k, v in want.items()} == got
    assert len(got) == 300 and min(len(v) for v in got.values()) == 256


def test_cut_off_and_flags_equal_a_plain_forest(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        cpu, mem, lat, rps = rng.normal([40, 50, 100, 200], [3, 3, 8, 10]).tolist()
        rows.append((i, "a", T0 + timedelta(seconds=5 * i), cpu, mem, lat, rps, 40.0))
    schema = "id int, node_id string, timestamp timestamp, cpu_usage double, memory_usage double, latency_ms double, requests_per_sec double, disk_usage double"
    out = {r["id"]: r["anomaly_score"] for r in anomaly.detect_outliers(spark.createDataFrame(rows, schema), recent_minutes=60).collect()}
    data = np.array([r[3:7] for r in rows], "float32")
    scores = score_rows(data, grow_forest(data, 100, 256, 7))
    clear = np.argsort(scores)[:8]  # another draw of the forest agrees on the clear ones
    assert set(clear.tolist()) & set(out) and 0.03 * 400 <= len(out) <= 0.06 * 400
    assert np.mean([scores[i] for i in out]) < np.percentile(scores, 12)


def test_rule_scores(spark):
    rows = [("n", T0, 100.0, 100.0, 1000.0), ("m", T0, 85.0, 90.0, 500.0)]
    df = spark.createDataFrame(rows, "node_id string, timestamp timestamp, cpu_usage double, memory_usage double, latency_ms double")
    got = {r["metric_name"]: r["anomaly_score"] for r in anomaly.flag_rules(df).collect()}
    assert got == {"cpu": 0.676, "memory": 0.611, "latency": 1.0}
    assert math.isclose(0.5 + 15 / 85, 0.676, abs_tol=1e-3)


def test_seasonal_factors_are_means_of_ratios(spark):
    """Early spikes in one day slot weigh as much as late ones, though the trend grows."""
    i = np.arange(4032)
    rng = np.random.default_rng(8)
    y = (50 + 0.2 * i) * (1 + 0.3 * np.sin(2 * np.pi * i / 288)) + rng.normal(0, 3, len(i))
    y[(i % 288 == 1) & (i < 1000)] *= 4
    days = (i * 300 + T0.timestamp()) / 86400
    slope, level = np.polyfit(days - days[0], y, 1)
    trend = level + slope * (days - days[0])
    slot, dow = i % 288, (i // 288) % 7
    daily = np.array([(y / trend)[slot == s].mean() for s in range(288)])
    weekly = np.array([(y / trend / daily[slot])[dow == d].mean() for d in range(7)])
    at = len(i) + 1  # ten minutes ahead
    want = (level + slope * at * 300 / 86400) * daily[at % 288] * weekly[(at // 288) % 7]
    frame = _frame(spark, y)
    for out in (forecast.seasonal_forecast(frame, ["k"], 10), forecast.seasonal_forecast(frame, ["k"], 10, factors="mean")):
        got = out.where("time_offset_minutes = 10").first()["predicted_value"]
        assert got == pytest.approx(want, rel=1e-9)
    row = forecast.predict(frame, None, ["k"], T0).first()
    assert row["predicted_rps"] == pytest.approx(want, abs=0.006)
    sums = forecast.seasonal_forecast(frame, ["k"], 10, factors="sum").where("time_offset_minutes = 10").first()
    assert abs(sums["predicted_value"] - want) > 1
