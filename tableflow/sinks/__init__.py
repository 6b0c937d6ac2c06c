"""Batch sinks: CSV, parquet, JDBC, catalog tables."""

from tableflow.sinks.files import (
    create_table_if_missing,
    insert_partitions,
    postgres_url,
    quote_ident,
    to_csv,
    to_jdbc,
    to_parquet,
    to_postgres,
)

__all__ = [name for name in dir() if not name.startswith("_")]
