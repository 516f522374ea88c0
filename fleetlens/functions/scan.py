"""Ordered recurrences over long series without a sequential pass.

A series is cut into chunks of equal size by rank. Inside a chunk a recurrence is a prefix product of small
functions, built by doubling (step k joins what lies 2**k rows back); the last row of each chunk goes on to the
same scan over chunks, and every row then takes its chunk's carry. One hot series so spreads over its chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch
from fleetlens.functions.skew import ordered_rank, previous_sample
from fleetlens.session import cut_lineage

CHUNK = 256
#: Width of the time slots in which rows are sorted and counted, in seconds.
SLOT_S = 86_400


def _slot(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType.typeName()
    place = epoch(order) if kind.startswith(("timestamp", "date")) else F.col(order).cast("double")
    return F.floor(place / SLOT_S)


def ranked(df: DataFrame, keys: list[str], order: str, name: str = "_rank") -> DataFrame:
    """Rows with their 1-based rank in the series, written once."""
    slotted = ordered_rank(df.withColumn("_slot", _slot(df, order)), keys, "_slot", [F.col(order)], name)
    return cut_lineage(slotted.drop("_slot"))


def _clip(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def _then(first: Column, second: Column) -> Column:
    """The function x -> clip(x + a, low, high) of ``first`` followed by that of ``second``, in the same form."""
    low, high = second["low"], second["high"]
    return F.struct(
        (first["a"] + second["a"]).alias("a"),
        _clip(first["low"] + second["a"], low, high).alias("low"),
        _clip(first["high"] + second["a"], low, high).alias("high"),
    )


def _prefix(
    df: DataFrame, keys: list[str], rank: str, longest: int, chunk: int, then: Callable[[Column, Column], Column]
) -> DataFrame:
    """Replace ``_f`` by the product (by ``then``) of all functions of the series up to each row."""
    if longest <= 1:
        return df
    fine = [*keys, "_chunk"]
    rows = df.withColumn("_chunk", F.floor((F.col(rank) - 1) / chunk))
    w = Window.partitionBy(*fine).orderBy(rank)
    for k in range(math.ceil(math.log2(min(longest, chunk)))):
        back = F.lag("_f", 2**k).over(w)
        rows = rows.withColumn("_back", back)
        rows = rows.withColumn("_f", F.when(F.col("_back").isNull(), F.col("_f")).otherwise(then(F.col("_back"), F.col("_f"))))
    rows = rows.drop("_back")
    if longest <= chunk:
        return rows.drop("_chunk")
    ends = rows.where(F.col(rank) % chunk == 0).select(*keys, (F.col("_chunk") + 1).alias("_place"), "_f")
    ends = _prefix(ends, keys, "_place", longest // chunk, chunk, then)
    carried = ends.select(*keys, F.col("_place").alias("_chunk"), F.col("_f").alias("_carry"))
    joined = rows.join(carried, fine, "left")
    whole = F.when(F.col("_carry").isNull(), F.col("_f")).otherwise(then(F.col("_carry"), F.col("_f")))
    return joined.withColumn("_f", whole).drop("_carry", "_chunk")


def clamped_sum(
    df: DataFrame, keys: list[str], rank: str, delta: Column, low: Column, high: Column, name: str, chunk: int = CHUNK
) -> DataFrame:
    """Running ``x = clip(x + delta, low, high)`` from zero, in the order of ``rank`` (as given by ``ranked``).

    ``x -> clip(x + a, low, high)`` composes to the same form, so the running value is a prefix product. Sums are
    taken in another order than row by row, so the last bits may differ.
    """
    longest = df.agg(F.max(rank)).first()[0] or 0
    start = F.struct(delta.alias("a"), low.alias("low"), high.alias("high"))
    rows = _prefix(df.withColumn("_f", start), keys, rank, longest, chunk, _then)
    return rows.withColumn(name, _clip(F.col("_f.a"), F.col("_f.low"), F.col("_f.high"))).drop("_f")


def carried_state(
    df: DataFrame, keys: list[str], rank: str, moves: Column, low: int, first: int, name: str, chunk: int = CHUNK
) -> DataFrame:
    """The state after each row of a machine that starts in ``first``; ``moves`` lists what the row makes of each
    state from ``low`` on. Moves compose to moves, so the state is a prefix product as well."""
    longest = df.agg(F.max(rank)).first()[0] or 0
    then = lambda a, b: F.transform(a, lambda state: F.element_at(b, state - low + 1))
    rows = _prefix(df.withColumn("_f", moves), keys, rank, longest, chunk, then)
    return rows.withColumn(name, F.element_at("_f", first - low + 1)).drop("_f")


def previous(df: DataFrame, keys: list[str], rank: str, value: str, name: str, chunk: int = CHUNK) -> DataFrame:
    """The value of the preceding row (by rank); chunks hand theirs on by an equality join."""
    fine = [*keys, "_chunk"]
    rows = df.withColumn("_chunk", F.floor((F.col(rank) - 1) / chunk))
    ends = rows.where(F.col(rank) % chunk == 0).select(
        *keys, (F.col("_chunk") + 1).alias("_chunk"), F.struct(F.col(value).alias("v")).alias("_end")
    )
    inside = F.lag(value).over(Window.partitionBy(*fine).orderBy(rank))
    joined = rows.withColumn(name, inside).join(ends, fine, "left")
    lead = F.col(rank) % chunk == (1 % chunk)
    return joined.withColumn(name, F.when(lead, F.col("_end.v")).otherwise(F.col(name))).drop("_end", "_chunk")


def last_marked(df: DataFrame, keys: list[str], rank: str, value: Column, name: str, chunk: int = CHUNK) -> DataFrame:
    """The newest non-null ``value`` up to and including each row, for values that grow with the rank."""
    fine = [*keys, "_chunk"]
    rows = df.withColumns({"_chunk": F.floor((F.col(rank) - 1) / chunk), "_v": value})
    ends = rows.groupBy(*fine).agg(F.max("_v").alias("_most"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*fine, F.max("_most").over(before).alias("_before"))
    inside = F.max("_v").over(Window.partitionBy(*fine).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.withColumn("_inside", inside).join(ends, fine)
    return joined.withColumn(name, F.coalesce("_inside", "_before")).drop("_chunk", "_v", "_inside", "_before")


def _first_from(times: DataFrame, keys: list[str], at: str, wait: float) -> DataFrame:
    """(keys, at, to): the first time of the series that is at least ``wait`` after each time, or null."""
    fine = [*keys, "_slot"]
    rows = times.select(*keys, F.col(at).alias("_x"), F.lit(None).cast("double").alias("_from"))
    asks = times.select(*keys, (F.col(at) + wait).alias("_x"), F.col(at).alias("_from"))
    both = rows.unionByName(asks).withColumn("_slot", F.floor(F.col("_x") / SLOT_S))
    is_row = F.when(F.col("_from").isNull(), F.col("_x"))
    later = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(1, Window.unboundedFollowing)
    heads = both.groupBy(*fine).agg(F.min(is_row).alias("_head")).select(*fine, F.min("_head").over(later).alias("_next"))
    down = Window.partitionBy(*fine).orderBy(F.col("_x").desc(), F.col("_from").isNotNull())
    seen = both.withColumn("_here", F.min(is_row).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    asked = seen.where("_from is not null").join(heads, fine)
    return asked.select(*keys, F.col("_from").alias(at), F.coalesce("_here", "_next").alias("to"))


def spaced_times(df: DataFrame, keys: list[str], at: str, wait: float) -> DataFrame:
    """(keys, at) of the rows that are taken when each must be at least ``wait`` seconds after the one taken before.

    The first time at least ``wait`` after a taken one depends on times alone. A time after a pause of ``wait`` is
    always taken; from there the chain is marked by pointer jumping: each round adds what the marked rows point to
    and doubles all pointers, so rounds grow with the logarithm of the longest chain without a pause.
    """
    times = df.select(*keys, at).distinct()
    if wait <= 0:
        return times
    here = [*keys, at]
    gaps = previous_sample(times.withColumn("_v", F.lit(0)), keys, at, "_v", F.floor(F.col(at) / SLOT_S))
    paused = F.coalesce(F.col(at) - F.col(f"prev_{at}") >= wait, F.lit(True))
    first = gaps.select(*here, paused.alias("taken"))
    pointers = _first_from(times, keys, at, wait)
    goal = first.select(*keys, F.col(at).alias("to"), F.col("taken").alias("_known"))
    state = first.join(pointers, here).join(goal, [*keys, "to"], "left")
    state = cut_lineage(state.select(*here, "taken", F.when(~F.col("_known"), F.col("to")).alias("to")))
    while state.where("taken and to is not null").limit(1).count():
        hit = state.where("taken and to is not null").select(*keys, F.col("to").alias(at), F.lit(True).alias("_hit")).distinct()
        hop = state.select(*keys, F.col(at).alias("to"), F.col("to").alias("_beyond"))
        state = state.join(hit, here, "left").join(hop, [*keys, "to"], "left")
        state = cut_lineage(
            state.select(*here, (F.col("taken") | F.coalesce("_hit", F.lit(False))).alias("taken"), F.col("_beyond").alias("to"))
        )
    return state.where("taken").select(*here)
