"""Capacity decisions: components, replay over history, what-if runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch
from fleetlens.functions.control import MIN_DT
from fleetlens.functions.present import fixed
from fleetlens.functions.scan import carried_state, clamped_sum, last_marked, previous, ranked, spaced_times
from fleetlens.functions.skew import side_by_side
from fleetlens.operators.reads import latest_prediction
from fleetlens.operators.summaries import active_workers, average_cpu
from fleetlens.params import Gains, ScalerPolicy
from fleetlens.session import cut_lineage

CONTROL_OUTPUTS = {
    "error": "double",
    "p_term": "double",
    "i_term": "double",
    "d_term": "double",
    "integral_error": "double",
    "action": "double",
}
DECISION_OUTPUTS = {
    "upper_util": "double",
    "pid_component": "double",
    "forecast_component": "double",
    "spike_component": "double",
    "raw_action": "double",
    "action": "double",
    "is_emergency": "boolean",
    "held_back_s": "double",
    "prev_replicas": "int",
    "new_replicas": "int",
}


# --- column forms -------------------------------------------------------------


def predicted_utilization(upper_rps: Column, workers: Column, policy: ScalerPolicy = ScalerPolicy()) -> Column:
    capacity = workers * policy.rps_per_worker
    return F.when(capacity > 0, F.least(F.lit(100.0), upper_rps / capacity * 100)).otherwise(0.0)


def forecast_component(peak: Column, policy: ScalerPolicy = ScalerPolicy()) -> Column:
    excess = peak - F.lit(policy.headroom_limit)
    bound = F.lit(0.8 * abs(policy.gains.action_min))
    return F.when(excess > 0, -F.least(bound, excess * 0.1 / 10.0)).otherwise(0.0)


def spike_component(probability: Column, policy: ScalerPolicy = ScalerPolicy()) -> Column:
    return F.when(probability > policy.spike_threshold, 0.8 * policy.gains.action_min).otherwise(0.0)


def combined_action(
    pid: Column, ahead: Column, spike: Column, emergency: Column, policy: ScalerPolicy = ScalerPolicy()
) -> Column:
    total = (pid + ahead + spike) * F.when(emergency, policy.spike_boost).otherwise(1.0)
    return F.greatest(F.lit(policy.gains.action_min), F.least(F.lit(policy.gains.action_max), total))


def effective_action(raw: Column, policy: ScalerPolicy = ScalerPolicy()) -> Column:
    return F.when(F.abs(raw) < policy.min_magnitude, 0.0).otherwise(raw)


def target_workers(workers: Column, action: Column, policy: ScalerPolicy = ScalerPolicy()) -> Column:
    n = workers.cast("int")
    return (
        F.when(action < 0, F.least(F.lit(policy.max_workers), n + F.ceil(-action).cast("int")))
        .when(action > 0, F.greatest(F.lit(policy.min_workers), n - F.ceil(action).cast("int")))
        .otherwise(n)
    )


def action_name(previous: Column, new: Column) -> Column:
    return F.when(new > previous, "scale_up").when(new < previous, "scale_down").otherwise("no_change")


def decision_reason(policy: ScalerPolicy = ScalerPolicy()) -> Column:
    """Text of a decision from its component columns (fixed wording)."""
    limit = F.lit(policy.headroom_limit)
    held = F.format_string(
        "Thrashing prevention: %ss since last decision (min: %ss)",
        fixed("held_back_s", 0),
        fixed(F.lit(policy.min_interval_s), 0),
    )
    small = F.format_string(
        "Scaling action %s below minimum magnitude %s", fixed("raw_action", 2), fixed(F.lit(policy.min_magnitude), 2)
    )
    spike = F.format_string(
        "LSTM SPIKE ALERT: Spike probability %s%% exceeds threshold %s%%",
        fixed(F.col("spike_probability") * 100, 1),
        fixed(F.lit(policy.spike_threshold * 100), 1),
    )
    ahead = F.format_string(
        "Prophet detected predicted peak %s%% exceeds headroom threshold %s%%", fixed("upper_util", 1), fixed(limit, 1)
    )
    parts = F.format_string(
        "PID: %s, Prophet: %s, LSTM: %s",
        fixed("pid_component", 2, plus=True),
        fixed("forecast_component", 2, plus=True),
        fixed("spike_component", 2, plus=True),
    )
    return (
        F.when(F.col("held_back_s").isNotNull(), held)
        .when(F.abs("raw_action") < policy.min_magnitude, small)
        .when(F.col("is_emergency"), spike)
        .when(F.col("upper_util") > limit, ahead)
        .otherwise(parts)
    )


def event_reason(policy: ScalerPolicy = ScalerPolicy()) -> Column:
    """The reason stored with a scaling event: decision text and its inputs."""
    inputs = F.format_string(
        "; cpu=%s; predicted_rps=%s; upper_util=%s; spike_probability=%s; model=%s",
        fixed("utilization", 1),
        fixed("predicted_rps", 1),
        fixed("upper_util", 1),
        fixed("spike_probability", 2),
        "model_name",
    )
    return F.concat(decision_reason(policy), inputs)


# --- replay -------------------------------------------------------------------


def _gain(gains: Gains | dict[str, Gains], name: str) -> Column:
    """A gain as a column: one value, or by the row's preset."""
    if isinstance(gains, Gains):
        return F.lit(float(getattr(gains, name)))
    pairs = [x for preset, g in gains.items() for x in (F.lit(preset), F.lit(float(getattr(g, name))))]
    return F.create_map(*pairs)[F.col("preset")]


def _loop(rows: DataFrame, keys: list[str], utilization: Column, dt: Column, gains: Gains | dict[str, Gains]) -> DataFrame:
    """``CONTROL_OUTPUTS`` for rows ranked by ``_rank``: P and D from neighbours, I as a scan of clamped sums."""
    fine = F.concat(F.lit("utilization outside 0..100: "), utilization.cast("string"))
    bad = F.when(~utilization.between(0, 100) | utilization.isNull() | F.isnan(utilization), F.raise_error(fine).cast("double"))
    past = F.concat(F.lit("negative time step: "), dt.cast("string"))
    wrong = F.when(dt < 0, F.raise_error(past).cast("double"))
    gain = lambda name: _gain(gains, name)
    steps = rows.withColumns(
        {
            "error": F.coalesce(bad, gain("setpoint") - utilization),
            "_dt": F.coalesce(wrong, F.greatest(dt.cast("double"), F.lit(MIN_DT))),
        }
    )
    steps = previous(steps, keys, "_rank", "error", "_before")
    bound = gain("integral_max")
    steps = clamped_sum(steps, keys, "_rank", F.col("error") * F.col("_dt"), -bound, bound, "integral_error")
    slope = F.coalesce((F.col("error") - F.col("_before")) / F.col("_dt"), F.lit(0.0))
    steps = steps.withColumns(
        {
            "p_term": gain("kp") * F.col("error"),
            "i_term": gain("ki") * F.col("integral_error"),
            "d_term": gain("kd") * slope,
        }
    )
    total = F.col("p_term") + F.col("i_term") + F.col("d_term")
    action = F.greatest(gain("action_min"), F.least(gain("action_max"), total))
    return steps.withColumn("action", action).drop("_before", "_dt")


def replay_control(
    steps: DataFrame, keys: list[str], order: str, utilization: str, dt: str, gains: Gains = Gains()
) -> DataFrame:
    """Run the control loop down each series of utilization steps.

    The integral is a scan of clamped sums over chunks of the series, so a long series spreads over many tasks.
    """
    rows = _loop(ranked(steps, keys, order), keys, F.col(utilization), F.col(dt), gains)
    return rows.select(*steps.columns, *CONTROL_OUTPUTS)


def replay_presets(
    steps: DataFrame, keys: list[str], order: str, utilization: str, dt: str, presets: dict[str, Gains]
) -> DataFrame:
    """What-if: the same steps under several gain settings, one series each."""
    names = F.array(*[F.lit(n) for n in presets])
    rows = ranked(steps, keys, order).withColumn("preset", F.explode(names))
    rows = _loop(rows, [*keys, "preset"], F.col(utilization), F.col(dt), presets)
    return rows.select(*steps.columns, "preset", *CONTROL_OUTPUTS)


def replay_decisions(
    steps: DataFrame,
    keys: list[str],
    policy: ScalerPolicy = ScalerPolicy(),
    start_workers: int | None = None,
    dt_s: float = 15.0,
) -> DataFrame:
    """Decision table of a history, with components and replicas before and after each step.

    ``steps`` has (keys, triggered_at, utilization, predicted_rps, upper_bound, spike_probability, model_name), one
    row per step and series, and may have ``workers``, the replicas observed at the step. Without it a step finds the
    target of the one before it, the first ``start_workers``; a target depends on the replicas it finds, so the moves
    of each step between the possible counts are composed down the series.
    A step less than the minimum interval after the last decision is held back: it decides nothing and leaves the
    loop untouched. Which steps those are depends on times alone and is found first; the loop then runs over the
    decisions.
    """
    first = policy.min_workers if start_workers is None else start_workers
    timed = ranked(steps.withColumn("_at", epoch("triggered_at")), keys, "triggered_at", "_step")
    taken = spaced_times(timed, keys, "_at", policy.min_interval_s)
    lead = timed.groupBy(*keys, "_at").agg(F.min("_step").alias("_step"))
    if policy.min_interval_s > 0:
        lead = lead.join(taken, [*keys, "_at"]).select(*keys, "_step", F.lit(True).alias("_taken"))
        marked = timed.join(lead, [*keys, "_step"], "left").withColumn("_taken", F.coalesce("_taken", F.lit(False)))
    else:
        marked = timed.withColumn("_taken", F.lit(True))
    marked = last_marked(marked, keys, "_step", F.when(F.col("_taken"), F.col("_at")), "_last")
    marked = cut_lineage(marked)
    made = ranked(marked.where("_taken"), keys, "_step")
    made = _loop(made, keys, F.col("utilization"), F.lit(dt_s), policy.gains)
    made = made.select(*keys, "_step", F.col("action").alias("_pid"))
    rows = marked.join(made, [*keys, "_step"], "left")
    held = ~F.col("_taken")
    zero = lambda column: F.when(held, 0.0).otherwise(column)
    emergency = F.col("spike_probability") > policy.spike_threshold
    if "workers" in steps.columns:
        rows = rows.withColumn("_n", F.col("workers").cast("int"))
    else:
        low, high = min(first, policy.min_workers), max(first, policy.max_workers)
        spike = spike_component(F.col("spike_probability"), policy)

        def target(n: Column) -> Column:
            ahead = forecast_component(predicted_utilization(F.col("upper_bound"), n, policy), policy)
            raw = combined_action(F.col("_pid"), ahead, spike, emergency, policy)
            return target_workers(n, zero(effective_action(raw, policy)), policy)

        moves = F.transform(F.sequence(F.lit(low), F.lit(high)), target)
        rows = cut_lineage(rows.withColumn("_moves", moves))
        rows = carried_state(rows, keys, "_step", F.col("_moves"), low, first, "_after").drop("_moves")
        rows = previous(rows, keys, "_step", "_after", "_n").withColumn("_n", F.coalesce("_n", F.lit(first)))
        rows = cut_lineage(rows)
    rows = rows.withColumn("upper_util", predicted_utilization(F.col("upper_bound"), F.col("_n"), policy))
    rows = rows.withColumns(
        {
            "pid_component": zero(F.col("_pid")),
            "forecast_component": zero(forecast_component(F.col("upper_util"), policy)),
            "spike_component": zero(spike_component(F.col("spike_probability"), policy)),
            "is_emergency": F.when(held, False).otherwise(emergency),
            "held_back_s": F.when(held, F.col("_at") - F.col("_last")),
        }
    )
    raw = combined_action(
        F.col("pid_component"), F.col("forecast_component"), F.col("spike_component"), F.col("is_emergency"), policy
    )
    rows = rows.withColumn("raw_action", zero(raw))
    rows = rows.withColumn("action", effective_action(F.col("raw_action"), policy))
    rows = rows.withColumns(
        {"prev_replicas": F.col("_n"), "new_replicas": target_workers(F.col("_n"), F.col("action"), policy)}
    )
    return rows.select(*[c for c in steps.columns if c != "workers"], *DECISION_OUTPUTS)


def scaling_events(decisions: DataFrame, policy: ScalerPolicy = ScalerPolicy()) -> DataFrame:
    """Decisions as rows of the scaling-event table."""
    keys = [c for c in decisions.columns if c == "node_id"]
    return decisions.select(
        *keys,
        "triggered_at",
        action_name(F.col("prev_replicas"), F.col("new_replicas")).alias("action"),
        "prev_replicas",
        "new_replicas",
        event_reason(policy).alias("reason"),
    )


def decision_inputs(
    metrics: DataFrame,
    predictions: DataFrame,
    workers: DataFrame,
    policy: ScalerPolicy = ScalerPolicy(),
    minutes: int = 2,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row of everything a decision needs: CPU, newest forecast, replicas."""
    row = side_by_side(
        average_cpu(metrics, minutes, as_of), latest_prediction(predictions), active_workers(workers)
    )
    n = F.col("active_workers")
    row = row.withColumn("current_workers", F.when(n > 0, n).otherwise(policy.min_workers).cast("int"))
    return row.drop("active_workers").withColumn(
        "upper_util", predicted_utilization(F.col("upper_bound"), F.col("current_workers"), policy)
    )
