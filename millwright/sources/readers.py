"""Typed scans of the operational tables."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.schemas import TABLES
from millwright.session import use_utc
from millwright.sources.versions import latest, read_stored


@dataclass(frozen=True)
class Tables:
    """The five input tables as lazy DataFrames."""

    plants: DataFrame
    machines: DataFrame
    work_orders: DataFrame
    machine_telemetry: DataFrame
    quality_inspections: DataFrame

    def with_table(self, **tables: DataFrame) -> Tables:
        return replace(self, **tables)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill NULLs the stored schema declares a default for."""
    defaults = {c: v for c, v in TABLES[table].defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}) if defaults else df


def _or_empty(read, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An absent path gives an empty typed frame; every other error propagates."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False) -> DataFrame:
    """CSV with a header; an empty field is NULL. Columns are matched to the header by name.

    Values are read as text and parsed leniently, so an unreadable cell becomes NULL instead of failing the job.
    """

    def scan() -> DataFrame:
        raw = spark.read.option("header", True).option("nullValue", "").csv(path)
        present = {c.lower(): c for c in raw.columns}
        return raw.select(*[
            _parse(F.col(present[f.name.lower()]), f.dataType).alias(f.name)
            if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])

    return _or_empty(scan, spark, schema) if missing_ok else scan()


def _parse(text: F.Column, kind: T.DataType) -> F.Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast(kind)  # 12.0, but not 12.5
        return F.coalesce(text.try_cast(kind), whole)
    return text.try_cast(kind)


_LINE, _REASONS, _FILE = "_line", "_reasons", "_file"


@dataclass(frozen=True)
class CheckedCsv:
    """Every line of a CSV file with its parsed columns and the reasons, if any, for which it cannot be loaded."""

    rows: DataFrame
    columns: tuple[str, ...]

    def accepted(self, seen: Observation | None = None) -> DataFrame:
        """Lines without a reason; ``seen`` counts ``lines`` and ``rejected`` in the same pass."""
        bad = F.size(_REASONS) > 0
        rows = self.rows
        if seen is not None:
            rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected"))
        return rows.filter(~bad).select(*self.columns)

    def rejected(self) -> DataFrame:
        """One row for each line that has reasons: its file, its text, and the columns with their unreadable values.

        The reason for a line with too few or too many fields has no column, and the whole line as its value.
        """
        found = self.rows.filter(F.size(_REASONS) > 0)
        return found.select(F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), F.col(_REASONS).alias("reasons"))


def check_csv(spark: SparkSession, path: str, schema: T.StructType) -> CheckedCsv:
    """CSV like ``read_csv``, but a line is either accepted whole or rejected with reasons; no cell is lost silently.

    A column that the header lacks is NULL and no reason; columns that the schema lacks are left out.
    """
    header = spark.read.option("header", True).csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _LINE]])
    options = {"header": True, "nullValue": "", "columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    scanned = spark.read.schema(texts).options(**options).csv(path).select("*", F.col("_metadata.file_path").alias(_FILE))
    present = {c.lower(): F.col(f"`{c}`") for c in header}
    reasons = [F.when(F.col(_LINE).isNotNull(), _reason(F.lit(None).cast("string"), F.col(_LINE)))]
    parsed = []
    for f in schema.fields:
        text = present.get(f.name.lower(), F.lit(None).cast("string"))
        value = _parse(text, f.dataType)
        parsed.append(value.cast(f.dataType).alias(f.name))
        if f.name.lower() in present and not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(text.isNotNull() & value.isNull(), _reason(F.lit(f.name), text)))
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    rows = scanned.select(
        *parsed, F.array_compact(F.array(*reasons)).alias(_REASONS), line.alias(_LINE), F.col(_FILE))
    return CheckedCsv(rows, tuple(schema.names))


def _reason(column: Column, value: Column) -> Column:
    return F.struct(column.alias("column"), value.alias("value"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its types; one that the rows lack is NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, missing_ok: bool = False
) -> DataFrame:
    """Parquet scan; with a schema, only its columns are read and zone-less timestamps become UTC ones.

    A column that the files lack is NULL, as in the CSV reader.
    """

    def scan() -> DataFrame:
        df = spark.read.parquet(path)
        return df if schema is None else conform(df, schema)

    if missing_ok:
        return _or_empty(scan, spark, schema or T.StructType([]))
    return scan()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    columns: list[str] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel table scan over JDBC, split on a numeric key; projections are pushed to the database.

    The bounds only place the cuts: rows outside them are read too. There is no scan in a single task unless
    ``partitions`` is 1.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, partition_column, bounds, partitions))
    df = reader.options(**(properties or {})).load()
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, partition_column: str, bounds: tuple[int, int], partitions: int) -> dict[str, str]:
    low, high = bounds
    if partitions < 1 or low > high:
        raise ValueError("a partitioned scan needs at least one partition and a lower bound below the upper one")
    return {
        "url": url, "dbtable": table, "fetchsize": "10000", "partitionColumn": partition_column,
        "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions),
    }


def scan_predicates(keys: DataFrame, column: str, partitions: int) -> list[str]:
    """Conditions on a key that split a table into about equal parts: every row meets exactly one of them.

    ``keys`` is a sample of the table's keys; its quantiles, not equal steps, place the cuts, so clustered keys give even
    parts. A key that fills more than one part gets one of its own. NULL keys and keys beyond the sample are covered. For whole numbers,
    decimals, dates and zone-less timestamps, whose order is the same in any database; other kinds are refused.
    """
    kind = keys.schema[column].dataType
    ordered = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampNTZType)
    if not isinstance(kind, ordered):
        raise ValueError(f"{column}: no cuts for keys of type {kind.simpleString()}")
    if partitions < 1:
        raise ValueError("a scan needs at least one partition")
    shares = [i / partitions for i in range(1, partitions)]
    found = keys.agg(F.percentile_approx(column, shares, 100 * partitions).alias("q")).first()["q"] if shares else None
    cuts = found or []
    # A cut is (value, whether the value belongs to the part below it); a repeated quantile is cut on both sides.
    edges = sorted({(v, False) for v in cuts} | {(v, True) for v in cuts if cuts.count(v) > 1})
    if not edges:
        return ["1 = 1"]
    below = [f"{column} {'<=' if closed else '<'} {_literal(v)}" for v, closed in edges]
    above = [f"{column} {'>' if closed else '>='} {_literal(v)}" for v, closed in edges]
    middle = [f"{low} AND {high}" for low, high in zip(above, below[1:])]
    return [f"({below[0]} OR {column} IS NULL)", *middle, above[-1]]


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else str(value)


def read_jdbc_parts(
    spark: SparkSession, url: str, table: str, predicates: list[str], columns: list[str] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Table scan over JDBC with one task for each predicate, as ``scan_predicates`` makes them."""
    df = spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": "10000", **(properties or {})})
    return df.select(*columns) if columns else df


def read_published(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A table of the last published version, empty if that has none."""
    rows = read_stored(spark, root, latest(spark, root), name)
    return spark.createDataFrame([], schema) if rows is None else conform(rows, schema)


def read_tables(spark: SparkSession, path: str, fmt: str = "parquet", missing_ok: bool = True) -> Tables:
    """All five tables as published under ``path``, all of one version.

    Where nothing was published they come from ``path/<table>``, or from ``path/<table>.csv``.
    """
    use_utc(spark)
    version = latest(spark, path) if fmt == "parquet" else None
    frames = {}
    for field in fields(Tables):
        schema = TABLES[field.name].schema
        if fmt == "csv":
            df = read_csv(spark, f"{path}/{field.name}.csv", schema, missing_ok)
        elif field.name in version.tables:
            df = conform(read_stored(spark, path, version, field.name), schema)
        else:
            df = read_parquet(spark, f"{path}/{field.name}", schema, missing_ok or version.number > 0)
        frames[field.name] = with_defaults(df, field.name)
    return Tables(**frames)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _or_empty(lambda: spark.read.schema(schema).json(path), spark, schema)
