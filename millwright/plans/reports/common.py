"""Filters and lists every report page uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def only(df: DataFrame, column: str, selected: Sequence[str] | None) -> DataFrame:
    """Membership filter; no selection means no filter."""
    return df.filter(F.col(column).isin(*selected)) if selected else df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
