"""Operators over a total order: row index, running sums, row-count windows per key.

A window over one hot key, or over no key at all, runs in a single task. The operators here range-partition
the rows by key *and* order columns instead, so a hot key spreads over many tasks, and carry what a partition
needs from the rows before it. A group that was counted and is small takes the plain window; both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from millwright.operators.sizing import GROUP_ROWS, SINGLE_TASK_ROWS, fits, largest_group
from millwright.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, 0)


def _sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally and pin every row's (partition, position).

    Storing the rows makes the pair stable: a recomputed range sort could cut the partitions elsewhere.
    """
    ranked = materialize(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    return ranked.withColumn("_part", F.shiftright("_pos", _ROW_BITS))


def _running(
    df: DataFrame, by: Sequence[str], order: str | Sequence[Column], sums: dict[str, Column], frame
) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(*frame)
    return df.withColumns({name: F.coalesce(F.sum(value).over(w), F.lit(0)) for name, value in sums.items()})


def row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Exact 0-based position of each row in a total order, without a single-task window."""
    parts = _sorted_parts(df, order)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per sorted partition, so the side is bounded by the shuffle partition count.
    starts = _running(sizes, (), "_part", {"_start": F.col("_n")}, _BEFORE).select("_part", "_start")
    position = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        parts.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position)
        .drop("_part", "_pos", "_start")
    )


def running_sums(
    df: DataFrame, order: Sequence[Column], sums: dict[str, str], max_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Inclusive running totals over a total order: ``sums`` maps output name to summed column.

    NULLs add nothing, so a total is 0 until the first value.
    """
    if fits(df, max_rows):
        return _running(df, (), order, {name: F.col(value) for name, value in sums.items()}, _UP_TO)
    parts = _sorted_parts(df, order)
    totals = parts.groupBy("_part").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in sums.items()])
    starts = _running(totals, (), "_part", {f"_s_{k}": F.col(f"_t_{k}") for k in sums}, _BEFORE)
    starts = starts.select("_part", *[f"_s_{k}" for k in sums])
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(*_UP_TO)
    joined = parts.join(F.broadcast(starts), "_part")
    own = {k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()}
    joined = joined.withColumns({k: F.col(f"_s_{k}") + total for k, total in own.items()})
    return joined.drop("_part", "_pos", *[f"_s_{k}" for k in sums])


def with_next_row(
    df: DataFrame, order: Sequence[Column], columns: Sequence[str], name: str = "next", max_rows: int = SINGLE_TASK_ROWS
) -> DataFrame:
    """Add a struct with ``columns`` of the following row in a total order; NULL at the last row."""
    row = F.struct(*columns)
    if fits(df, max_rows):
        return df.withColumn(name, F.lead(row).over(Window.orderBy(*order)))
    parts = _sorted_parts(df, order)
    # At most one row per sorted partition; empty partitions have none, so the next row may lie several further on.
    firsts = parts.groupBy("_part").agg(F.min_by(row, "_pos").alias("_first"))
    after = firsts.withColumn("_after", F.lead("_first").over(Window.orderBy("_part"))).select("_part", "_after")
    inside = F.lead(row).over(Window.partitionBy("_part").orderBy("_pos"))
    joined = parts.join(F.broadcast(after), "_part").withColumn(name, F.coalesce(inside, F.col("_after")))
    return joined.drop("_part", "_pos", "_after")


@dataclass(frozen=True)
class RollingRows:
    """Aggregate over the last ``rows`` rows of the key, the current one included unless ``skip_current``."""

    name: str
    aggregate: Callable[[], Column]
    rows: int
    skip_current: bool = False

    @property
    def frame(self) -> tuple[int, int]:
        return (-self.rows, -1) if self.skip_current else (1 - self.rows, 0)


@dataclass(frozen=True)
class LastBefore:
    """Last non-null value of ``column`` on any earlier row of the key."""

    name: str
    column: str


@dataclass(frozen=True)
class RowNumber:
    """1-based row number within the key."""

    name: str


Spec = RollingRows | LastBefore | RowNumber


def over_key_order(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    specs: Sequence[Spec],
    max_group_rows: int = GROUP_ROWS,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Add ordered per-key columns. ``order`` must be total within the key (end it with a unique id).

    Rows with a NULL key belong to no group: their new columns are NULL, whatever the number of rows.
    """
    if largest_group(df, key) <= max_group_rows:
        w = Window.partitionBy(key).orderBy(*order)
        out = df.withColumns({spec.name: _plain(spec, w) for spec in specs})
    else:
        out = _in_blocks(df, key, order, specs, block_rows)
    return out.withColumns({spec.name: F.when(F.col(key).isNotNull(), F.col(spec.name)) for spec in specs})


def _plain(spec: Spec, w: WindowSpec) -> Column:
    match spec:
        case RollingRows():
            return spec.aggregate().over(w.rowsBetween(*spec.frame))
        case LastBefore():
            return F.last(spec.column, ignorenulls=True).over(w.rowsBetween(*_BEFORE))
        case RowNumber():
            return F.row_number().over(w).cast("long")


def _in_blocks(df: DataFrame, key: str, order: Sequence[Column], specs: Sequence[Spec], block_rows: int) -> DataFrame:
    """Windows over fixed-size blocks of the sorted rows.

    Each block also receives the last rows of the block before it, enough for the longest row frame.
    State that reaches further back is one row per (block, key), accumulated over blocks and joined on the
    window's own partitioning.
    """
    reach = max([s.rows for s in specs if isinstance(s, RollingRows)], default=0)
    block_rows = max(block_rows, reach + 1)
    size = F.lit(block_rows).cast("long")
    indexed = row_index(df, [F.col(key).asc(), *order], "_idx")
    indexed = indexed.withColumn("_home", F.floor(F.col("_idx") / size).cast("long"))
    near_end = F.col("_idx") % size >= size - reach
    blocks = F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    spread = indexed.withColumn("_block", F.explode(blocks))

    w = Window.partitionBy("_block", key).orderBy("_idx")
    local = {}
    for spec in specs:
        if isinstance(spec, RollingRows):
            local[spec.name] = spec.aggregate().over(w.rowsBetween(*spec.frame))
        elif isinstance(spec, LastBefore):
            local[f"_in_{spec.name}"] = F.last(spec.column, ignorenulls=True).over(w.rowsBetween(*_BEFORE))
    out = spread.withColumns(local).filter(F.col("_block") == F.col("_home"))

    lasts = [s for s in specs if isinstance(s, LastBefore)]
    numbers = [s for s in specs if isinstance(s, RowNumber)]
    if lasts or numbers:
        state = indexed.groupBy(F.col("_home").alias("_block"), F.col(key)).agg(
            F.min("_idx").alias("_first"),
            *[
                F.max_by(s.column, F.when(F.col(s.column).isNotNull(), F.col("_idx"))).alias(f"_out_{s.name}")
                for s in lasts
            ],
        )
        per_key = Window.partitionBy(key).orderBy("_block")
        earlier = {
            f"_out_{s.name}": F.last(f"_out_{s.name}", ignorenulls=True).over(per_key.rowsBetween(*_BEFORE))
            for s in lasts
        }
        state = state.withColumns({**earlier, "_first": F.min("_first").over(per_key.rowsBetween(*_UP_TO))})
        out = out.join(state, ["_block", key], "left")
        for s in lasts:
            out = out.withColumn(s.name, F.coalesce(f"_in_{s.name}", f"_out_{s.name}"))
        for s in numbers:
            out = out.withColumn(s.name, F.col("_idx") - F.col("_first") + 1)
    return out.select(*df.columns, *[s.name for s in specs])
