"""Exact percentiles (linear interpolation) that never gather a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.session import cut_lineage

SKETCH_ACCURACY = 10_000
#: Bits of the value that one round of the selection looks at, and how many rows of wanted prefixes are broadcast
#: (more are joined by a shuffle).
DIGIT, BROADCAST_ROWS = 16, 100_000


def ordered_bits(value: Column) -> Column:
    """A long in the order of the doubles: sign, exponent and fraction as one number (both zeros are 0).

    Found by exact arithmetic: scaling by powers of two never rounds.
    """
    least, endless = F.lit(2.0**-1022), F.lit(float("inf"))
    size = F.when(F.abs(value) == endless, 1.0).otherwise(F.abs(value))
    guess = F.floor(F.log2(F.greatest(size, least)))
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    low = F.when(size < power(guess), guess - 1).when(size >= power(guess) * 2, guess + 1).otherwise(guess)
    exponent = F.greatest(F.least(low, F.lit(1023)), F.lit(-1022))
    fraction = ((F.greatest(size, least) / power(exponent) - 1) * 2.0**52).cast("long")
    normal = F.shiftleft((exponent + 1023).cast("long"), 52) + fraction
    tiny = (F.least(size, least) * 2.0**537 * 2.0**537).cast("long")
    bits = F.when(size < least, tiny).when(F.abs(value) == endless, F.lit(0x7FF0000000000000)).otherwise(normal)
    return F.when(value < 0, -bits).otherwise(bits)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per entry of ``probs``; without keys one row, of nulls for no values.

    A radix selection: equal values are counted first; then, 16 bits of the ordered value at a time, counts per
    prefix tell which prefix holds each wanted rank, and only values with such a prefix go on. After four rounds
    the prefix is the value. No step sorts or gathers the values of a group; a round's window runs over the at
    most 65,536 prefixes below one.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    values = data.groupBy(*keys, ordered_bits(F.col("_v")).alias("_bits")).agg(
        F.count("*").alias("_c"), F.first("_v").alias("_v")
    )
    values = cut_lineage(values)
    groups = values.select(*keys).distinct().count() if keys else 1
    few = groups * 2 * len(probs) <= BROADCAST_ROWS
    names = list(probs)
    ranks = F.array(*[F.lit(float(p)) for p in probs.values()])
    wanted = None
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefix = F.shiftright("_bits", shift)
        if wanted is None:
            cells = values.groupBy(*keys, prefix.alias("_prefix")).agg(F.sum("_c").alias("_c"), F.min("_v").alias("_v"))
            part = Window.partitionBy(*keys)
            cells = cells.withColumn("_n", F.sum("_c").over(part))
            rank = lambda p, n: p * (n - 1)
            both = F.flatten(
                F.transform(
                    ranks,
                    lambda p, i: F.array(
                        F.struct((i * 2).alias("at"), F.floor(rank(p, F.col("_n"))).alias("r")),
                        F.struct((i * 2 + 1).alias("at"), F.ceil(rank(p, F.col("_n"))).alias("r")),
                    ),
                )
            )
            cells = cells.withColumn("_ranks", both)
        else:
            held = wanted.withColumnRenamed("_prefix", "_above").drop("_v")
            held = F.broadcast(held) if few else held
            above = F.shiftright("_bits", shift + DIGIT)
            cells = values.select(*keys, "_c", "_v", prefix.alias("_prefix"), above.alias("_above")).join(
                held, [*keys, "_above"]
            )
            cells = cells.groupBy(*keys, "_above", "_prefix").agg(
                F.sum("_c").alias("_c"), F.min("_v").alias("_v"), F.first("_n").alias("_n"), F.first("_ranks").alias("_ranks")
            )
            part = Window.partitionBy(*keys, "_above")
        before = F.sum("_c").over(part.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
        cells = cells.withColumn("_before", before)
        inside = F.filter("_ranks", lambda t: (t["r"] >= F.col("_before")) & (t["r"] < F.col("_before") + F.col("_c")))
        moved = F.transform(inside, lambda t: F.struct(t["at"].alias("at"), (t["r"] - F.col("_before")).alias("r")))
        wanted = cells.withColumn("_ranks", moved).where(F.size("_ranks") > 0).select(*keys, "_prefix", "_n", "_v", "_ranks")
    found = wanted.select(*keys, "_n", "_v", F.explode("_ranks.at").alias("_at"))
    at = lambda i: F.max(F.when(F.col("_at") == i, F.col("_v")))
    ends = found.groupBy(*keys).agg(
        F.max("_n").alias("_n"), *[at(2 * i + s).alias(f"_{'az'[s]}{i}") for i in range(len(names)) for s in (0, 1)]
    )
    share = lambda p: F.lit(float(p)) * (F.col("_n") - 1) - F.floor(F.lit(float(p)) * (F.col("_n") - 1))
    low, high = lambda i: F.col(f"_a{i}"), lambda i: F.col(f"_z{i}")
    exact = lambda i, p: F.when(low(i) == high(i), low(i)).otherwise(low(i) + (high(i) - low(i)) * share(p))
    return ends.select(*keys, *[exact(i, p).alias(name) for i, (name, p) in enumerate(probs.items())])


def approximate_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Sketch form for dashboards: one pass, bounded memory, nearest sample."""
    array = F.percentile_approx(value, F.array(*[F.lit(float(p)) for p in probs.values()]), accuracy)
    out = df.groupBy(*keys).agg(array.alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])

