"""Registered queries: capacity decisions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from fleetlens.functions.present import rounded
from fleetlens.operators import scaling
from fleetlens.params import GAIN_PRESETS, ScalerPolicy
from fleetlens.plans import tables as t
from fleetlens.plans.catalog import query
from fleetlens.sources import telemetry

SLOW_POLICY = replace(ScalerPolicy(), min_interval_s=9000.0)


@query(
    "decision_inputs",
    f"""WITH {t.METRICS}, {t.WORKERS}, {t.predictions_sql(False)}, cpu AS (
  SELECT coalesce(avg(cpu_usage), 0.0) AS avg_cpu, count(*) > 0 AS has_data FROM metrics
  WHERE "timestamp" >= {t.AS_OF} - INTERVAL 120 MINUTE), p AS (
  SELECT predicted_rps, coalesce(nullif(upper_bound, 0), nullif(predicted_rps, 0), 0.0) AS upper_bound,
    spike_probability, confidence, model_name FROM predictions ORDER BY predicted_at DESC LIMIT 1), w AS (
  SELECT greatest(count(*) FILTER (status = 'active'), 1)::INT AS current_workers FROM workers)
SELECT round(avg_cpu, 9) AS avg_cpu, has_data, p.*, current_workers,
  round(least(100.0, upper_bound / (current_workers * 300.0) * 100), 9) AS upper_util FROM cpu, p, w""",
)
def _(spark, sf):
    now = t.as_of(spark, sf)
    return rounded(
        scaling.decision_inputs(
            telemetry.metrics(spark, sf), t.predictions(spark, sf), t.workers(spark, sf, now), minutes=120, as_of=now
        ),
        9,
    )


@query(
    "decision_components",
    f"""WITH {t.CONTROL_INPUTS}, parts AS (SELECT node_id, triggered_at,
    least(100.0, upper_bound / (2 * 300.0) * 100) AS upper_util, spike_probability,
    least(3.0, greatest(-3.0, 70.0 - utilization)) AS pid FROM inputs), comps AS (
  SELECT *, CASE WHEN upper_util - 80.5 > 0 THEN -least(2.4000000000000004, (upper_util - 80.5) * 0.1 / 10.0) ELSE 0.0 END AS forecast_component,
    CASE WHEN spike_probability > 0.6 THEN -2.4000000000000004::DOUBLE ELSE 0.0::DOUBLE END AS spike_component FROM parts), raws AS (
  SELECT *, greatest(-3.0, least(3.0, (pid + forecast_component + spike_component)
      * CASE WHEN spike_probability > 0.6 THEN 1.5 ELSE 1.0 END)) AS raw_action FROM comps), acts AS (
  SELECT *, CASE WHEN abs(raw_action) < 0.5 THEN 0.0 ELSE raw_action END AS action FROM raws)
SELECT node_id, triggered_at, round(upper_util, 9) AS upper_util, round(forecast_component, 9) AS forecast_component,
  round(spike_component, 9) AS spike_component, round(action, 9) AS action,
  CASE WHEN action < 0 THEN least(8, 2 + CAST(ceil(-action) AS INT))
       WHEN action > 0 THEN greatest(1, 2 - CAST(ceil(action) AS INT)) ELSE 2 END AS target_workers,
  CASE WHEN action < 0 THEN 'scale_up' WHEN action > 0 THEN 'scale_down' ELSE 'no_change' END AS action_name
FROM acts""",
)
def _(spark, sf):
    """The stateless parts of a decision as columns, for two running workers."""
    two = F.lit(2)
    emergency = F.col("spike_probability") > 0.6
    pid = F.least(F.lit(3.0), F.greatest(F.lit(-3.0), 70.0 - F.col("utilization")))
    parts = t.control_inputs(spark, sf).withColumns(
        {
            "upper_util": scaling.predicted_utilization(F.col("upper_bound"), two),
            "spike_component": scaling.spike_component(F.col("spike_probability")),
        }
    )
    parts = parts.withColumn("forecast_component", scaling.forecast_component(F.col("upper_util")))
    raw = scaling.combined_action(pid, F.col("forecast_component"), F.col("spike_component"), emergency)
    acted = parts.withColumn("action", scaling.effective_action(raw))
    target = scaling.target_workers(two, F.col("action"))
    acted = acted.withColumns({"target_workers": target, "action_name": scaling.action_name(two, target)})
    return rounded(
        acted.select(
            "node_id", "triggered_at", "upper_util", "forecast_component", "spike_component", "action",
            "target_workers", "action_name",
        ),
        9,
    )


CONTROL_COLS = """round(error, 9) AS error, round(p_term, 9) AS p_term, round(i_term, 9) AS i_term, round(d_term, 9) AS d_term,
  round(integral_error, 9) AS integral_error, round(action, 9) AS action"""


def _steps(spark, sf):
    return t.control_inputs(spark, sf).select("node_id", "triggered_at", "utilization", F.lit(15.0).alias("dt"))


@query(
    "control_replay",
    f"""WITH RECURSIVE {t.CONTROL_INPUTS}, {t.control_sql('1.0', '0.05', '0.5', '-5.0', '10.0', 'inputs', 'node_id', '15.0')}
SELECT node_id, triggered_at, utilization, {CONTROL_COLS} FROM controlled""",
)
def _(spark, sf):
    out = scaling.replay_control(_steps(spark, sf), ["node_id"], "triggered_at", "utilization", "dt")
    return rounded(out.drop("dt"), 9)


@query(
    "control_replay_presets",
    f"""WITH RECURSIVE {t.CONTROL_INPUTS}, gains(preset, kp, ki, kd) AS (
  VALUES ('default', 1.0, 0.05, 0.5), ('aggressive', 2.0, 0.1, 1.0), ('conservative', 0.5, 0.02, 0.2)), fanned AS (
  SELECT i.node_id, i.rn, i.triggered_at, i.utilization, preset FROM inputs i, gains),
{t.control_sql('1', '1', '1', '-5.0', '10.0', 'fanned', 'node_id, preset', '15.0')}, tuned AS (
  SELECT c.node_id, c.preset, triggered_at, utilization, error, kp::DOUBLE * error AS p_term,
    ki::DOUBLE * integral_error AS i_term, kd::DOUBLE * d_term AS d_term, integral_error FROM controlled c JOIN gains USING (preset))
SELECT node_id, preset, triggered_at, utilization, round(error, 9) AS error, round(p_term, 9) AS p_term, round(i_term, 9) AS i_term,
  round(d_term, 9) AS d_term, round(integral_error, 9) AS integral_error,
  round(least(10.0, greatest(-5.0, p_term + i_term + d_term)), 9) AS action FROM tuned""",
)
def _(spark, sf):
    out = scaling.replay_presets(
        _steps(spark, sf), ["node_id"], "triggered_at", "utilization", "dt", GAIN_PRESETS
    )
    return rounded(out.drop("dt"), 9)


DECISION_COLS = """node_id, triggered_at, utilization, spike_probability, predicted_rps, upper_bound, model_name,
  round(upper_util, 9) AS upper_util, round(pid_component, 9) AS pid_component,
  round(forecast_component, 9) AS forecast_component, round(spike_component, 9) AS spike_component,
  round(raw_action, 9) AS raw_action, round(action, 9) AS action, is_emergency, round(held_back_s, 9) AS held_back_s,
  prev_replicas, new_replicas"""


@query("decision_replay", f"WITH RECURSIVE {t.DECISIONS} SELECT {DECISION_COLS} FROM decided")
def _(spark, sf):
    return rounded(t.decisions(spark, sf), 9)


@query(
    "decision_replay_held_back",
    f"WITH RECURSIVE {t.CARRIED_INPUTS}, {t.decisions_sql(9000.0)} SELECT {DECISION_COLS} FROM decided",
)
def _(spark, sf):
    return rounded(t.decisions(spark, sf, SLOW_POLICY), 9)


@query(
    "scaling_events_with_reasons",
    f"""WITH RECURSIVE {t.CARRIED_INPUTS}, {t.decisions_sql(9000.0)}, {t.scaling_events_sql(9000.0)}
SELECT node_id, triggered_at, action, prev_replicas, new_replicas, reason FROM scaling_events""",
)
def _(spark, sf):
    return t.scaling_events(spark, sf, SLOW_POLICY)


@query(
    "scaling_export",
    f"""WITH RECURSIVE {t.SCALING} SELECT triggered_at, action, prev_replicas, new_replicas, reason FROM scaling_events
WHERE triggered_at >= TIMESTAMP '2024-01-10' AND triggered_at <= TIMESTAMP '2024-01-20' AND action <> 'no_change'
ORDER BY triggered_at""",
)
def _(spark, sf):
    from datetime import datetime

    from fleetlens.sources.writers import scaling_events_between

    return scaling_events_between(t.scaling_events(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 20))


@query(
    "manual_scale",
    f"""WITH {t.WORKERS} SELECT {t.AS_OF} AS triggered_at, 'manual_scale' AS action,
  count(*) FILTER (status = 'active')::INT AS prev_replicas, 4 AS new_replicas,
  'manual request by operator-1' AS reason FROM workers""",
)
def _(spark, sf):
    from fleetlens.sources.writers import manual_scale_event

    now = t.as_of(spark, sf)
    event = manual_scale_event(t.workers(spark, sf, now), 4, "operator-1", now)
    return event.withColumn("triggered_at", F.col("triggered_at").cast("timestamp_ntz"))
