"""Size checks behind every broadcast and every one-task step."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSION_ROWS = 100_000
SINGLE_TASK_ROWS = 1_000_000
GROUP_ROWS = 1_000_000


_counted: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def row_count(df: DataFrame) -> int:
    """Counted once per DataFrame object."""
    if df not in _counted:
        _counted[df] = df.count()
    return _counted[df]


def fits(df: DataFrame, max_rows: int) -> bool:
    return row_count(df) <= max_rows


def dimension(table: DataFrame, *columns: str, max_rows: int = DIMENSION_ROWS) -> DataFrame:
    """Columns of a small side with a broadcast hint, if the counted table is within the bound.

    Beyond it there is no hint, and the planner shuffles both sides.
    """
    side = table.select(*columns) if columns else table
    return F.broadcast(side) if fits(table, max_rows) else side


def largest_group(df: DataFrame, *keys: str) -> int:
    """Rows of the biggest key group (partial counts are combined before the shuffle)."""
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return top or 0
