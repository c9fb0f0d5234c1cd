"""Numeric column helpers: rounding, clipping, exact averages, safe correlation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_even(value: Column | str, digits: int) -> Column:
    """Round a double half-even on ``value * 10**digits``, as NumPy does."""
    factor = F.lit(float(10**digits))
    return F.rint(_col(value) * factor) / factor


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to ``[low, high]``; NULL stays NULL (``least``/``greatest`` would skip it)."""
    col = _col(value)
    out = None
    if low is not None:
        out = F.when(col < low, F.lit(low))
    if high is not None:
        out = F.when(col > high, F.lit(high)) if out is None else out.when(col > high, F.lit(high))
    return col if out is None else out.otherwise(col)


def to_double(value: Column | str, default: float | None = None) -> Column:
    """Lenient numeric parse: bad text becomes NULL, then ``default`` if one is given."""
    parsed = _col(value).try_cast("double")
    parsed = F.when(F.isnan(parsed), F.lit(None).cast("double")).otherwise(parsed)
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def share(condition: Column) -> Column:
    """Share of rows where the condition holds; NULL counts as false and stays in the denominator."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def fixed_avg(value: Column | str, scale: int) -> Column:
    """Average of values with ``scale`` decimals, summed as integers.

    The result does not depend on the order in which partitions are merged.
    """
    col = _col(value)
    factor = float(10**scale)
    total = F.sum(F.rint(col * factor).cast("long")).cast("double")
    return F.try_divide(total, F.count(col)) / F.lit(factor)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over complete pairs; NULL where either side has no variance."""
    a, b = _col(x).cast("double"), _col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
