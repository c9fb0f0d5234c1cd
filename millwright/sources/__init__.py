"""Readers, writers, bulk load and keyed write-back."""

from millwright.sources.readers import Tables, read_csv, read_jdbc, read_metrics, read_parquet, read_tables
from millwright.sources.writers import write_csv, write_metrics, write_parquet, write_snapshots

__all__ = [
    "Tables", "read_csv", "read_jdbc", "read_metrics", "read_parquet", "read_tables", "write_csv", "write_metrics",
    "write_parquet", "write_snapshots",
]
