"""Presentation columns: rounded numbers, texts, tones and ages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import epoch, instant
from fleetlens.params import TONE_WORDS


def _num(value: str | Column) -> Column:
    col = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def exact_half(value: str | Column, digits: int, to_even: bool = True) -> Column:
    """Move a value that looks like a tie at ``digits`` to its true side.

    Spark rounds the shortest decimal text of a double half-up. The double
    itself lies a hair above or below that tie (or on it, then the even or the
    larger digit wins); the exact product error tells which.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    scale = float(10**digits)
    twice = v * (2 * scale)
    tie = F.rint(twice)
    split = v * 134217729.0
    high = split - (split - v)
    error = (high * (2 * scale) - tie) + (v - high) * (2 * scale)
    down, up = (tie - 1) / 2, (tie + 1) / 2
    away = F.when(v < 0, down).otherwise(up)
    even = F.when(down % 2 == 0, down).otherwise(up) if to_even else away
    settled = F.when(error < 0, down).when(error > 0, up).otherwise(even) / scale
    near = (F.abs(tie % 2) == 1) & (F.abs(twice - tie) <= F.abs(tie) * 4e-16)
    return F.when(near, settled).otherwise(v)


def exact_round(value: str | Column, digits: int) -> Column:
    """Number rounded half-even on its exact value."""
    return F.round(exact_half(value, digits), digits)


def fixed(value: str | Column, digits: int, plus: bool = False) -> Column:
    """Text with a fixed number of decimals, rounded on the exact value."""
    return F.format_string(f"%{'+' if plus else ''}.{digits}f", exact_half(value, digits))


def fmt_number(value: str | Column, digits: int = 0) -> Column:
    """Grouped thousands with at most ``digits`` decimals; missing shows as 0."""
    text = F.format_number(exact_half(_num(value), digits, to_even=False), digits)
    if digits == 0:
        return F.regexp_replace(text, "^-0$", "0")
    trimmed = F.regexp_replace(text, r"(\.\d*?)0+$", "$1")
    return F.regexp_replace(F.regexp_replace(trimmed, r"\.$", ""), "^-0$", "0")


def fmt_ms(value: str | Column) -> Column:
    return F.concat(fmt_number(value, 1), F.lit(" ms"))


def fmt_percent(value: str | Column, digits: int = 1) -> Column:
    return F.concat(fmt_number(value, digits), F.lit("%"))


def fmt_ratio_percent(value: str | Column, digits: int = 0) -> Column:
    return F.concat(fmt_number(_num(value) * 100, digits), F.lit("%"))


def fmt_datetime(column: str) -> Column:
    return F.coalesce(F.date_format(column, "MMM d, HH:mm:ss"), F.lit("Unknown"))


def fmt_short_time(column: str) -> Column:
    return F.coalesce(F.date_format(column, "HH:mm:ss"), F.lit("--:--"))


def age_seconds(df: DataFrame, column: str, as_of: datetime) -> Column:
    return epoch(instant(df, column, as_of)) - epoch(column)


def age_label(df: DataFrame, column: str, as_of: datetime) -> Column:
    """Relative age in whole seconds, minutes, hours or days."""
    s = age_seconds(df, column, as_of)

    def worded(amount: Column, unit: str) -> Column:
        n = F.floor(amount)
        return F.concat(n.cast("string"), F.lit(f" {unit}"), F.when(n == 1, "").otherwise("s"), F.lit(" ago"))

    return (
        F.when(F.col(column).isNull(), "unknown")
        .when(s < 60, worded(s, "second"))
        .when(s < 3600, worded(s / 60, "minute"))
        .when(s < 86400, worded(s / 3600, "hour"))
        .otherwise(worded(s / 86400, "day"))
    )


def action_label(column: str) -> Column:
    return F.replace(F.col(column), F.lit("_"), F.lit(" "))


def severity_tone(column: str) -> Column:
    word = F.lower(F.col(column))
    return (
        F.when(word.isin(TONE_WORDS["bad"]), "bad")
        .when(word.isin(TONE_WORDS["warn"]), "warn")
        .when(word.isin(TONE_WORDS["good"]), "good")
        .otherwise("neutral")
    )


def anomaly_tone(score: str | Column) -> Column:
    col = F.col(score) if isinstance(score, str) else score
    return F.when(col >= 0.8, "bad").when(col >= 0.5, "warn").otherwise("good")


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round the named (default: all) double columns for presentation."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})
