"""One step of the capacity controller, shared by batch replay and streams."""

from __future__ import annotations

import math
from dataclasses import dataclass

from fleetlens.params import Gains, ScalerPolicy

MIN_DT = 0.001


def clip(value: float, low: float, high: float) -> float:
    return low if value < low else high if value > high else value


@dataclass
class LoopState:
    """What the control loop remembers between steps."""

    integral: float = 0.0
    error: float | None = None


def control_step(state: LoopState, utilization: float, dt: float, gains: Gains) -> tuple[float, ...]:
    """Returns (error, p_term, i_term, d_term, integral_error, action)."""
    if not 0.0 <= utilization <= 100.0:
        raise ValueError(f"utilization outside 0..100: {utilization}")
    if dt < 0:
        raise ValueError(f"negative time step: {dt}")
    dt = max(dt, MIN_DT)
    error = gains.setpoint - utilization
    slope = 0.0 if state.error is None else (error - state.error) / dt
    state.integral = clip(state.integral + error * dt, -gains.integral_max, gains.integral_max)
    state.error = error
    p, i, d = gains.kp * error, gains.ki * state.integral, gains.kd * slope
    return error, p, i, d, state.integral, clip(p + i + d, gains.action_min, gains.action_max)


@dataclass
class ScalerState:
    """Loop memory plus the last accepted decision and the replica count."""

    loop: LoopState
    workers: int
    decided_at: float | None = None


def predicted_utilization(upper_rps: float, workers: int, policy: ScalerPolicy) -> float:
    capacity = workers * policy.rps_per_worker
    return min(100.0, upper_rps / capacity * 100.0) if capacity > 0 else 0.0


def forecast_part(predicted: float, policy: ScalerPolicy) -> float:
    excess = predicted - policy.headroom_limit
    return -min(0.8 * abs(policy.gains.action_min), 0.1 * excess / 10.0) if excess > 0 else 0.0


def spike_part(probability: float, policy: ScalerPolicy) -> float:
    return 0.8 * policy.gains.action_min if probability > policy.spike_threshold else 0.0


def target_workers(workers: int, action: float, policy: ScalerPolicy) -> int:
    if action < 0:
        return min(policy.max_workers, workers + math.ceil(-action))
    if action > 0:
        return max(policy.min_workers, workers - math.ceil(action))
    return workers


def decision_step(
    state: ScalerState, at: float, utilization: float, upper_rps: float, probability: float, dt: float,
    policy: ScalerPolicy, workers: int | None = None,
) -> tuple:
    """One decision.

    Returns (upper_util, pid_part, forecast_part, spike_part, raw_action,
    action, is_emergency, held_back_s, prev_workers, new_workers). A decision
    that comes too soon is held back: it is zero and leaves the loop untouched.
    ``workers`` are the replicas observed now; without them the last target counts.
    """
    before = state.workers if workers is None else workers
    upper_util = predicted_utilization(upper_rps, before, policy)
    waited = None if state.decided_at is None else at - state.decided_at
    if waited is not None and waited < policy.min_interval_s:
        return upper_util, 0.0, 0.0, 0.0, 0.0, 0.0, False, waited, before, before
    pid = control_step(state.loop, utilization, dt, policy.gains)[-1]
    ahead, spike = forecast_part(upper_util, policy), spike_part(probability, policy)
    emergency = probability > policy.spike_threshold
    total = (pid + ahead + spike) * (policy.spike_boost if emergency else 1.0)
    raw = clip(total, policy.gains.action_min, policy.gains.action_max)
    action = raw if abs(raw) >= policy.min_magnitude else 0.0
    state.decided_at = at
    state.workers = target_workers(before, action, policy)
    return upper_util, pid, ahead, spike, raw, action, emergency, None, before, state.workers
