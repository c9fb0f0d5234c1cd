"""Time column helpers. Everything is UTC; durations are computed from integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def parse_timestamps(df: DataFrame, *names: str) -> DataFrame:
    """Lenient parse to UTC timestamps: unreadable text becomes NULL, never an error."""
    out = {}
    for name in names:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            out[name] = F.try_to_timestamp(F.col(name))
        elif not isinstance(kind, T.TimestampType):
            out[name] = F.col(name).cast("timestamp")
    return df.withColumns(out) if out else df


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_HOUR))


def at_or_before_zero(value: Column) -> Column:
    """Floor at zero, keeping NULL."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def floor_div(value: Column, divisor: int) -> Column:
    """Integer division rounding down, also for instants before 1970."""
    step = F.lit(divisor).cast("long")
    return ((value - F.pmod(value, step)) / step).cast("long")


def day_of(ts: Column | str) -> Column:
    return F.to_date(ts)


def month_of(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")
