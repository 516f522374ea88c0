"""Control loop and decisions: fixed cases, plain-Python folds and properties."""

import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.functions.control import (
    LoopState,
    ScalerState,
    control_step,
    decision_step,
    forecast_part,
    spike_part,
    target_workers,
)
from fleetlens.functions import scan
from fleetlens.operators import scaling, summaries
from fleetlens.params import GAIN_PRESETS, LIBRARY_POLICY, Gains, ScalerPolicy

P_ONLY = Gains(kp=1.0, ki=0.0, kd=0.0)
T0 = datetime(2024, 1, 1)


def test_proportional_term():
    assert control_step(LoopState(), 90.0, 1.0, P_ONLY)[1] == -20.0
    assert control_step(LoopState(), 50.0, 1.0, P_ONLY)[1] == 20.0


def test_double_gain_doubles_the_term():
    one = control_step(LoopState(), 90.0, 1.0, Gains(kp=1.0, ki=0, kd=0))[1]
    assert control_step(LoopState(), 90.0, 1.0, Gains(kp=2.0, ki=0, kd=0))[1] == 2 * one


def test_integral_is_bounded():
    state = LoopState()
    gains = Gains(ki=1.0, integral_max=50.0)
    for _ in range(100):
        integral = control_step(state, 95.0, 1.0, gains)[4]
    assert integral == -50.0


def test_first_step_has_no_derivative_and_reversal_does():
    state = LoopState()
    assert control_step(state, 90.0, 1.0, Gains())[3] == 0.0
    for _ in range(4):
        control_step(state, 90.0, 1.0, Gains())
    error, _, _, d, _, _ = control_step(state, 50.0, 1.0, Gains())
    assert error == 20.0 and d == 0.5 * 40.0


@pytest.mark.parametrize("utilization,dt", [(100.1, 1.0), (-0.1, 1.0), (50.0, -1.0)])
def test_bad_input_is_refused(utilization, dt):
    with pytest.raises(ValueError):
        control_step(LoopState(), utilization, dt, Gains())


@given(st.lists(st.floats(0, 100), min_size=1, max_size=50), st.floats(0, 120))
def test_action_and_integral_stay_in_bounds(values, dt):
    state = LoopState()
    for v in values:
        *_, integral, action = control_step(state, v, dt, Gains())
        assert -100 <= integral <= 100 and -5 <= action <= 10


def test_forecast_part_above_headroom():
    assert LIBRARY_POLICY.headroom_limit == pytest.approx(80.5)
    assert forecast_part(85.0, LIBRARY_POLICY) == pytest.approx(-0.045)
    assert forecast_part(80.0, LIBRARY_POLICY) == 0.0
    assert forecast_part(10_000.0, LIBRARY_POLICY) == -4.0


def test_emergency_multiplies_and_marks():
    assert spike_part(0.85, LIBRARY_POLICY) == -4.0 and spike_part(0.1, LIBRARY_POLICY) == 0.0
    state = ScalerState(LoopState(), 2)
    out = decision_step(state, 0.0, 70.0, 0.0, 0.85, 60.0, LIBRARY_POLICY)
    assert out[6] is True and out[4] == max(-5.0, -4.0 * 1.5)


def test_early_decision_is_held_back_and_leaves_the_loop_alone():
    state = ScalerState(LoopState(), 2)
    decision_step(state, 0.0, 90.0, 0.0, 0.0, 60.0, LIBRARY_POLICY)
    before = (state.loop.integral, state.loop.error, state.workers)
    out = decision_step(state, 10.0, 10.0, 0.0, 0.0, 60.0, LIBRARY_POLICY)
    assert out[5] == 0.0 and out[7] == 10.0
    assert (state.loop.integral, state.loop.error, state.workers) == before


def test_small_action_restarts_the_interval():
    policy = ScalerPolicy(min_interval_s=300.0)
    state = ScalerState(LoopState(), 2)
    out = decision_step(state, 0.0, 70.0, 0.0, 0.0, 15.0, policy)
    assert out[5] == 0.0 and state.decided_at == 0.0


def test_target_workers_bounds():
    p = ScalerPolicy()
    assert target_workers(2, -2.1, p) == 5 and target_workers(7, -3.0, p) == 8
    assert target_workers(5, 2.0, p) == 3 and target_workers(1, 3.0, p) == 1
    assert target_workers(4, 0.0, p) == 4


def _steps(spark, rows):
    return spark.createDataFrame(rows, "node_id string, t timestamp, u double, dt double")


def test_batch_replay_matches_a_plain_fold(spark):
    rows = []
    for n in range(5):
        rows += [(f"n{n}", T0 + timedelta(seconds=15 * i), (i * 37 + n * 11) % 101 * 1.0, 15.0) for i in range(200)]
    out = scaling.replay_control(_steps(spark, rows), ["node_id"], "t", "u", "dt").collect()
    got = {(r["node_id"], r["t"]): r["action"] for r in out}
    for n in range(5):
        state = LoopState()
        for node, t, u, dt in [r for r in rows if r[0] == f"n{n}"]:
            assert got[(node, t)] == control_step(state, u, dt, Gains())[-1]


def test_replay_fails_on_bad_utilization(spark):
    with pytest.raises(Exception, match="outside"):
        scaling.replay_control(_steps(spark, [("a", T0, 120.0, 1.0)]), ["node_id"], "t", "u", "dt").collect()


def test_presets_and_stability(spark):
    pattern = [20, 30, 40, 50, 60, 65, 68, 69, 70, 70, 70]
    rows = [("a", T0 + timedelta(seconds=i), float(u), 1.0) for i, u in enumerate(pattern)]
    out = scaling.replay_presets(_steps(spark, rows), ["node_id"], "t", "u", "dt", GAIN_PRESETS)
    calm = summaries.control_stability(out.withColumnRenamed("t", "step"), ["preset"]).collect()
    assert {r["preset"] for r in calm} == set(GAIN_PRESETS)
    assert all(r["late_oscillation"] < 2.0 for r in calm)


def test_golden_reason(spark):
    row = [(T0, "n", 77.6, 0.0, 0.0, 0.0, "none")]
    steps = spark.createDataFrame(
        row,
        "triggered_at timestamp, node_id string, utilization double, predicted_rps double, upper_bound double, "
        "spike_probability double, model_name string",
    )
    event = scaling.scaling_events(scaling.replay_decisions(steps, ["node_id"], start_workers=2)).first()
    assert (event["action"], event["prev_replicas"], event["new_replicas"]) == ("scale_up", 2, 5)
    assert event["reason"] == (
        "PID: -3.00, Prophet: +0.00, LSTM: +0.00; cpu=77.6; predicted_rps=0.0; upper_util=0.0; "
        "spike_probability=0.00; model=none"
    )


@settings(max_examples=30, deadline=None)
@given(st.floats(-3, 3), st.integers(1, 8))
def test_ceil_rule(action, n):
    p = ScalerPolicy()
    new = target_workers(n, action, p)
    assert abs(new - n) <= math.ceil(abs(action)) and 1 <= new <= max(8, n)


def test_column_target_matches_step(spark):
    rows = [(n, a / 4) for n in range(1, 9) for a in range(-12, 13)]
    df = spark.createDataFrame(rows, "n int, a double").withColumn(
        "t", scaling.target_workers(F.col("n"), F.col("a"))
    )
    assert all(r["t"] == target_workers(r["n"], r["a"], ScalerPolicy()) for r in df.collect())


def test_scan_of_one_long_series_equals_the_fold(spark):
    rng = random.Random(4)
    rows = [("hot", T0 + timedelta(seconds=7 * i), rng.uniform(0, 100), rng.choice([0.0, 1.0, 15.0])) for i in range(3000)]
    rows += [("cold", T0, 50.0, 1.0)]
    out = scaling.replay_control(_steps(spark, rows), ["node_id"], "t", "u", "dt")
    got = {(r["node_id"], r["t"]): (r["integral_error"], r["d_term"], r["action"]) for r in out.collect()}
    state = LoopState()
    for node, t, u, dt in rows[:-1]:
        _, _, _, d, integral, action = control_step(state, u, dt, Gains())
        assert got[(node, t)] == pytest.approx((integral, d, action), abs=1e-6)
    assert got[("cold", T0)][0] == 20.0


@pytest.mark.parametrize("chunk,length", [(4, 300), (7, 50), (256, 300), (4, 1)])
def test_clamped_sum_over_levels_of_chunks(spark, chunk, length):
    rng = random.Random(chunk)
    rows = [("a", i + 1, float(rng.randrange(-40, 41))) for i in range(length)] + [("b", 1, 500.0)]
    df = spark.createDataFrame(rows, "k string, r long, d double")
    out = scan.clamped_sum(df, ["k"], "r", F.col("d"), F.lit(-50.0), F.lit(60.0), "x", chunk)
    out = scan.previous(out, ["k"], "r", "d", "p", chunk)
    got = {(r["k"], r["r"]): (r["x"], r["p"]) for r in out.collect()}
    x, before = 0.0, None
    for k, r, d in rows[:-1]:
        x = min(max(x + d, -50.0), 60.0)
        assert got[(k, r)] == (x, before)
        before = d
    assert got[("b", 1)] == (60.0, None) and len(got) == length + 1


@pytest.mark.parametrize("wait", [0.0, 1.0, 90.0, 86_400.0, 200_000.0])
def test_pointer_jumping_takes_what_a_fold_takes(spark, wait):
    rng = random.Random(9)
    rows, at = [], 0.0
    for _ in range(1500):
        at += rng.choice([0.0, 0.5, 1.0, 30.0, 45.0, 60.0, 5000.0, 86_400.0])
        rows.append(("hot", at))
    rows += [("cold", 3.0), ("cold", 3.5)]
    df = spark.createDataFrame(rows, "k string, at double")
    got = sorted((r["k"], r["at"]) for r in scan.spaced_times(df, ["k"], "at", wait).collect())
    want, last = [], {}
    for k, at in rows:
        if wait <= 0 or k not in last or at - last[k] >= wait:
            last[k] = at
            want.append((k, at))
    assert got == sorted(set(want))


def test_replay_of_decisions_equals_the_fold(spark):
    rng, policy = random.Random(2), ScalerPolicy(min_interval_s=100.0)
    rows, at = [], 0
    for _ in range(700):
        at += rng.choice([10, 40, 60, 99, 100, 5000])
        rows.append((T0 + timedelta(seconds=at), "n", rng.uniform(0, 100), 1.0, rng.uniform(0, 900), rng.random(), "m", rng.randrange(1, 9)))
    schema = (
        "triggered_at timestamp, node_id string, utilization double, predicted_rps double, upper_bound double, "
        "spike_probability double, model_name string, workers int"
    )
    out = scaling.replay_decisions(spark.createDataFrame(rows, schema), ["node_id"], policy)
    got = {r["triggered_at"]: r for r in out.collect()}
    state = ScalerState(LoopState(), 1)
    for t, _, u, _, up, p, _, n in rows:
        want = decision_step(state, t.timestamp(), u, up, p, 15.0, policy, n)
        row = [got[t][c] for c in scaling.DECISION_OUTPUTS]
        assert [v is None for v in row] == [v is None for v in want]
        assert [v for v in row if v is not None] == pytest.approx([v for v in want if v is not None], abs=1e-6)
    assert any(r["held_back_s"] is not None for r in got.values())


@pytest.mark.parametrize("start,most", [(None, 8), (3, 8), (12, 20)])
def test_replay_without_observed_replicas_carries_the_last_target(spark, start, most):
    rng, policy = random.Random(6), ScalerPolicy(min_interval_s=100.0, max_workers=most)
    rows, at = [], 0
    for _ in range(700):
        at += rng.choice([10, 40, 99, 100, 5000])
        load = rng.choice([(rng.uniform(60, 80), 0.1), (rng.uniform(69.4, 70.6), 0.1), (70.0, 0.7)])
        rows.append((T0 + timedelta(seconds=at), "n", load[0], 1.0, rng.uniform(0, 6000), load[1], "m"))
    schema = (
        "triggered_at timestamp, node_id string, utilization double, predicted_rps double, upper_bound double, "
        "spike_probability double, model_name string"
    )
    out = scaling.replay_decisions(spark.createDataFrame(rows, schema), ["node_id"], policy, start)
    got = {r["triggered_at"]: r for r in out.collect()}
    state, seen = ScalerState(LoopState(), start or policy.min_workers), set()
    for t, _, u, _, up, p, _ in rows:
        want = decision_step(state, t.timestamp(), u, up, p, 15.0, policy)
        row = [got[t][c] for c in scaling.DECISION_OUTPUTS]
        assert [v is None for v in row] == [v is None for v in want]
        assert [v for v in row if v is not None] == pytest.approx([v for v in want if v is not None], abs=1e-6)
        seen.add(want[-1])
    assert len(seen) > 4
