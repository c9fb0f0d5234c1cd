"""Bulk load of CSV files into published tables, and keyed write-back of model outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millwright.config import DEFAULT, LoadConfig
from millwright.schemas import TABLES
from millwright.sources import files
from millwright.sources.readers import CheckedCsv, check_csv, with_defaults
from millwright.sources.versions import Stored, latest, publish, stage
from millwright.sources.writers import as_stored

LOAD_ORDER = ("plants", "machines", "work_orders", "machine_telemetry", "quality_inspections")
REJECTS = "rejects"


class RejectedRows(ValueError):
    """More lines of a file could not be read than the load allows."""


def load_csvs(
    spark: SparkSession, csv_dir: str, target_dir: str, limits: LoadConfig = DEFAULT.load
) -> dict[str, int]:
    """Replace the tables under ``target_dir`` with the CSV files; returns rows loaded per table.

    Tables are staged in load order and published together, so a load that fails, or a driver that is lost, leaves the old
    ones. Lines that cannot be read as the table's types go to the table ``rejects``, published with the others; a file with
    a larger share of them than ``limits`` allows fails the load, and the error names the folder with its rejects. Loaded
    and rejected rows add up to the lines of a file. A missing file is skipped.
    """
    base = latest(spark, target_dir)
    staged: dict[str, Stored] = {}
    counts: dict[str, int] = {}
    rejects: list[DataFrame] = []
    try:
        for table in LOAD_ORDER:
            rules = TABLES[table]
            try:
                checked = check_csv(spark, f"{csv_dir}/{table}.csv", rules.schema)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            seen = Observation()
            rows = checked.accepted(seen)
            staged[table] = stage(
                as_stored(with_defaults(rows, table), table), target_dir, table, rules.unique[0], limits.buckets)
            lines, bad = seen.get["lines"], seen.get["rejected"]
            counts[table] = lines - bad
            if bad:
                rejects.append(_named_rejects(table, checked))
            if bad > limits.max_reject_share * lines:
                where = stage(_all_rejects(spark, rejects), target_dir, REJECTS, ["file"], 1).parts.values()
                raise RejectedRows(f"{table}: {bad} of {lines} lines rejected, see {target_dir}/{', '.join(where)}")
        staged[REJECTS] = stage(_all_rejects(spark, rejects), target_dir, REJECTS, ["file"], 1)
    except BaseException:
        for table in staged.values():
            for path in table.parts.values():
                files.delete(spark, f"{target_dir}/{path}")
        raise
    publish(spark, target_dir, base, staged)
    return counts


def _named_rejects(table: str, checked: CheckedCsv) -> DataFrame:
    return checked.rejected().select(F.lit(table).alias("table"), "*")


def _all_rejects(spark: SparkSession, found: list[DataFrame]) -> DataFrame:
    if not found:
        kinds = "table string, file string, line string, reasons array<struct<column:string,value:string>>"
        return spark.createDataFrame([], kinds)
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out


def write_back(table: DataFrame, updates: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``table`` with ``columns`` replaced where ``updates`` has the key; other rows keep their values.

    ``updates`` must be unique on the key. Write the result to a new path, never over its own input.
    """
    keys = [key] if isinstance(key, str) else list(key)
    new = updates.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = table.join(new, keys, "left")
    values = {
        c: F.when(F.col("_hit"), F.col(f"_new_{c}").cast(table.schema[c].dataType)).otherwise(F.col(c)) for c in columns
    }
    return joined.withColumns(values).select(*table.columns)
