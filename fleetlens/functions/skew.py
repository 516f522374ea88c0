"""Building blocks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = list[str]


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns into one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def newest_per_key(df: DataFrame, keys: Keys, order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark turns ``row_number() <= n`` into a per-partition limit ahead of the
    shuffle, so at most ``n`` rows of a key leave each task however hot it is.
    """
    if not keys:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ordered_rank(df: DataFrame, keys: Keys, slot: str, order: list[Column], name: str) -> DataFrame:
    """1-based rank inside ``keys`` when ``slot`` (a monotone cut of the order) splits them.

    Slots are counted first and their running offsets joined back, so rows are
    sorted only inside one (keys, slot) and a hot key spreads over many tasks.
    """
    fine = [*keys, slot]
    before = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*fine)
        .agg(F.count("*").alias("_n"))
        .select(*fine, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(*fine).orderBy(*order))
    return (
        df.join(offsets, fine)
        .withColumn(name, F.col("_before") + inside)
        .drop("_before")
    )


def previous_sample(
    df: DataFrame, keys: Keys, ts: str, value: str, chunk: Column, order: list[Column] | None = None
) -> DataFrame:
    """Add ``prev_<ts>`` and ``prev_<value>`` of the preceding row of the series.

    The lag runs inside (keys, chunk); only the last row of each chunk crosses
    to the next one, through a table of one row per (keys, chunk). Rows are
    shuffled by (keys, chunk) once, for both.
    """
    order = order or [F.col(ts)]
    fine = [*keys, "_chunk"]
    df = df.withColumn("_chunk", chunk).repartition(*fine)
    w = Window.partitionBy(*fine).orderBy(*order)
    tails = df.groupBy(*fine).agg(F.max(ts).alias("_t"), F.max_by(value, ts).alias("_v")).select(
        *fine, F.struct(F.col("_t").alias(ts), F.col("_v").alias(value)).alias("_tail")
    )
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    carried = tails.select(*fine, F.lag("_tail").over(over_chunks).alias("_carry"))
    return (
        df.withColumns(
            {
                f"prev_{ts}": F.lag(ts).over(w),
                f"prev_{value}": F.lag(value).over(w),
                "_first": F.row_number().over(w) == 1,
            }
        )
        .join(carried, fine)
        .withColumns(
            {
                f"prev_{ts}": F.when(F.col("_first"), F.col(f"_carry.{ts}")).otherwise(F.col(f"prev_{ts}")),
                f"prev_{value}": F.when(F.col("_first"), F.col(f"_carry.{value}")).otherwise(
                    F.col(f"prev_{value}")
                ),
            }
        )
        .drop("_chunk", "_first", "_carry")
    )
