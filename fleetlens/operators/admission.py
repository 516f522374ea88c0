"""Admission limits over a request log ``(id, ts, key, role, tokens)``."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch, epoch_us, floor_time
from fleetlens.functions.limits import Admitted, Bucket, LevelTable, bucket_step, window_step
from fleetlens.functions.ordered import ordered_scan
from fleetlens.functions.skew import ordered_rank
from fleetlens.params import ROLE_RATES, UNKNOWN_ROLE_RATE

CAPACITY = 100.0
WINDOW_S = 60
IDLE_TTL_S = 3600
#: Requests of a stretch that one task decides.
CHUNK = 4096
OUTPUTS = {"allowed": "boolean", "remaining": "bigint", "reset_after": "double"}


def role_rate(role: str = "role", rates: dict[str, float] | None = None, default: float = UNKNOWN_ROLE_RATE) -> Column:
    """Rate of a role from the fixed table; unknown roles get the default."""
    table = rates or ROLE_RATES
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(role)), F.lit(float(default)))


def with_role_rate(log: DataFrame, rates: DataFrame, default: float = UNKNOWN_ROLE_RATE) -> DataFrame:
    """The same from a table ``(role, rate)``."""
    return log.join(rates.select("role", "rate"), "role", "left").withColumn(
        "rate", F.coalesce("rate", F.lit(float(default)))
    )


def _segments(log: DataFrame, quiet_s: Column, slot_s: float, chunk: int | None = None) -> DataFrame:
    """Number the stretches of each key that are parted by at least ``quiet_s``, and with ``chunk`` the requests of
    a stretch (``_rank``, from 0) and its pieces of so many (``_chunk``).

    After so long a pause the limiter's state is the same whatever came before,
    so stretches are independent and one key spreads over many tasks. Requests
    are first counted per time slot; only slots are ordered per key.
    """
    us = max(1, int(slot_s * 1_000_000))
    slotted = log.withColumn("_slot", F.floor(epoch_us("ts") / us))
    slots = slotted.groupBy("key", "_slot").agg(
        F.min(epoch("ts")).alias("_from"),
        F.max(epoch("ts")).alias("_to"),
        F.max(quiet_s).alias("_quiet"),
        F.count("*").alias("_n"),
    )
    order = Window.partitionBy("key").orderBy("_slot")
    pause = F.col("_from") - F.lag("_to").over(order)
    fresh = F.when(pause >= F.col("_quiet"), 1).otherwise(0)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = slots.withColumn("_fresh", fresh).withColumn("_segment", F.sum("_fresh").over(so_far))
    if not chunk:
        return slotted.join(numbered.select("key", "_slot", "_segment"), ["key", "_slot"]).drop("_slot")
    inside = Window.partitionBy("key", "_segment").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    numbered = numbered.select("key", "_slot", "_segment", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("key", "_slot").orderBy("ts", "id"))
    placed = slotted.join(numbered, ["key", "_slot"]).withColumn("_rank", F.col("_before") + rank - 1)
    return placed.withColumn("_chunk", F.floor(F.col("_rank") / chunk)).drop("_slot", "_before")


def token_bucket(
    log: DataFrame,
    capacity: float = CAPACITY,
    rates: dict[str, float] | None = None,
    idle_ttl_s: float | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Token-bucket decision of every request.

    A key's refill rate is that of its first request; with ``idle_ttl_s`` a
    bucket idle for longer is forgotten, and the next request sets the rate
    anew. A pause that refills the bucket parts a key into independent
    stretches, which are decided in parallel; a stretch of more than ``chunk``
    requests is decided in pieces, each from the level that tables of the pieces
    before it lead to.
    """
    rate = role_rate("role", rates)
    order = F.struct("ts", "id")
    life = ["key"]
    if idle_ttl_s:
        log = _segments(log, F.lit(float(idle_ttl_s)), idle_ttl_s).withColumnRenamed("_segment", "_life")
        life.append("_life")
    first = log.groupBy(*life).agg(F.min_by(rate, order).alias("refill"))
    rated = log.join(first, life)
    quiet = F.lit(float(capacity)) / F.col("refill")
    if idle_ttl_s:
        quiet = F.least(quiet, F.lit(float(idle_ttl_s)))
    slowest = min([*(rates or ROLE_RATES).values(), UNKNOWN_ROLE_RATE])
    # a pause that forgets the bucket must lie between two slots, or it would go unseen
    slot_s = min(capacity / slowest, idle_ttl_s or math.inf)
    parted = _segments(rated.withColumn("_q", quiet), F.col("_q"), slot_s, chunk)
    timed = parted.withColumn("_at", epoch("ts")).drop("_q", "_life")
    # the level at which each piece of a long stretch begins goes ahead of its requests
    starts = _levels_between(timed, capacity, chunk)
    blank = lambda column: F.lit(None).cast("double").alias(column)
    rows = timed.select("*", blank("_level"), blank("_since")).unionByName(starts, allowMissingColumns=True)

    def step(state: Bucket, row: tuple) -> tuple:
        at, need, refill, level, since = row
        if level == level and level is not None:
            state.tokens, state.at = level, since
            return None, None, None
        return bucket_step(state, at, need, refill, capacity)

    scanned = ordered_scan(
        rows, ["key", "_segment", "_chunk"], ["ts", "id"], ["_at", "tokens", "refill", "_level", "_since"], Bucket, step, OUTPUTS
    )
    kept = scanned.where("_level is null")
    return kept.drop("_at", "_segment", "_chunk", "_rank", "_level", "_since").withColumnRenamed("refill", "limit")


def _levels_between(timed: DataFrame, capacity: float, chunk: int) -> DataFrame:
    """(key, _segment, _chunk, _level, _since): the tokens left, and when, before each piece but the first.

    Each piece of a long stretch is summed up, on its own, in a table from the level at its first request to the
    level after its last; only these tables are then passed through in order, one small step a piece.
    """
    keys = ["key", "_segment", "_chunk"]
    sizes = timed.groupBy("key", "_segment").agg(F.max("_rank").alias("_most"))
    more = sizes.where(F.col("_most") >= chunk).select("key", "_segment", F.floor(F.col("_most") / chunk).alias("_ends"))
    long = timed.join(more, ["key", "_segment"]).where(F.col("_chunk") < F.col("_ends"))

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        at, need, refill = pdf["_at"].to_numpy(), pdf["tokens"].to_numpy(float), float(pdf["refill"].iloc[0])
        held = LevelTable.start()
        for gain, n in zip(np.maximum(np.diff(at, prepend=at[0]), 0.0) * refill, need):
            held = held.then(float(gain), float(n), capacity)
        one = pdf.iloc[[0]][keys].copy()
        one["_from"], one["_to"], one["refill"] = at[0], at[-1], refill
        one["_edges"], one["_values"], one["_fixed"] = [held.edges], [held.values], [held.fixed]
        return one

    kinds = ", ".join(f"`{k}` {long.schema[k].dataType.simpleString()}" for k in keys)
    tables = long.select(*keys, "_rank", "_at", "tokens", "refill").groupBy(*keys).applyInPandas(
        table,
        f"{kinds}, _from double, _to double, refill double, _edges array<double>, _values array<double>, _fixed array<boolean>",
    )

    def follow(state: Bucket, row: tuple) -> tuple:
        first, end, refill, edges, values, fixed = row
        level = capacity if state.tokens is None else min(capacity, state.tokens + max(0.0, first - state.at) * refill)
        held = LevelTable(np.asarray(edges, float), np.asarray(values, float), np.asarray(fixed, bool))
        state.tokens, state.at = held.after(level), end
        return state.tokens, end

    passed = ordered_scan(
        tables,
        ["key", "_segment"],
        ["_chunk"],
        ["_from", "_to", "refill", "_edges", "_values", "_fixed"],
        Bucket,
        follow,
        {"_level": "double", "_since": "double"},
    )
    return passed.select("key", "_segment", (F.col("_chunk") + 1).alias("_chunk"), "_level", "_since")


def sliding_window(
    log: DataFrame, window_s: int = WINDOW_S, rates: dict[str, float] | None = None
) -> DataFrame:
    """Sliding-window decision of every request; only admitted ones count."""
    limited = log.withColumn("limit", F.floor(role_rate("role", rates) * window_s).cast("bigint"))
    parted = _segments(limited, F.lit(float(window_s)), window_s)
    scanned = ordered_scan(
        parted.withColumn("_at", epoch("ts")),
        ["key", "_segment"],
        ["ts", "id"],
        ["_at", "limit"],
        Admitted,
        lambda state, r: window_step(state, r[0], r[1], window_s),
        OUTPUTS,
    )
    return scanned.drop("_at", "_segment")


def fixed_window(
    log: DataFrame, window_s: int = WINDOW_S, rates: dict[str, float] | None = None, slot_s: int | None = None
) -> DataFrame:
    """The first ``limit`` requests of each aligned window are admitted."""
    limited = log.withColumns(
        {
            "limit": F.floor(role_rate("role", rates) * window_s).cast("bigint"),
            "window_start": floor_time(log, "ts", window_s),
            "_slot": floor_time(log, "ts", slot_s or max(1, window_s // 60)),
        }
    )
    ranked = ordered_rank(limited, ["key", "window_start"], "_slot", [F.col("ts"), F.col("id")], "_rank")
    allowed = F.col("_rank") <= F.col("limit")
    left = F.greatest(F.lit(0), F.col("limit") - F.col("_rank"))
    reset = epoch("window_start") + window_s - epoch("ts")
    return ranked.withColumns({"allowed": allowed, "remaining": left, "reset_after": reset}).drop("_rank", "_slot")


def limiter_stats(decisions: DataFrame, strategy: str) -> DataFrame:
    return decisions.agg(
        F.lit(strategy).alias("strategy"),
        F.count_distinct("key").alias("tracked_keys"),
        F.count_if("allowed").alias("allowed"),
        F.count_if(~F.col("allowed")).alias("denied"),
    )


def denied_by_role(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("role").agg(
        F.count("*").alias("requests"), F.count_if(~F.col("allowed")).alias("denied")
    )


def idle_keys(log: DataFrame, as_of: float, ttl_s: float = IDLE_TTL_S) -> DataFrame:
    """Keys whose last request is older than the limit: their state is expired."""
    last = log.groupBy("key").agg(F.max(epoch("ts")).alias("last_seen"))
    return last.filter(as_of - F.col("last_seen") > ttl_s)


def reset_keys(log: DataFrame, resets: DataFrame) -> DataFrame:
    """Number the lives of each key that its reset events ``(key, ts)`` start.

    A request after a reset belongs to a new life, so grouping a limiter by
    (key, life) forgets what happened before. Resets are rare control events.
    """
    marked = log.withColumn("_reset", F.lit(0)).unionByName(
        resets.select("key", "ts", F.lit(1).alias("_reset")), allowMissingColumns=True
    )
    day = F.floor(epoch("ts") / 86400)
    fine = marked.withColumn("_day", day)
    per_day = fine.groupBy("key", "_day").agg(F.sum("_reset").alias("_n"))
    before = Window.partitionBy("key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select("key", "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = (
        Window.partitionBy("key", "_day").orderBy("ts", F.col("_reset").desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    numbered = fine.join(offsets, ["key", "_day"]).withColumn("life", F.col("_before") + F.sum("_reset").over(inside))
    return numbered.filter(F.col("_reset") == 0).drop("_reset", "_day", "_before")
