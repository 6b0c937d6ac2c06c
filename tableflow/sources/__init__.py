"""Batch sources."""

from tableflow.sources.changes import fingerprint, write_changed_months
from tableflow.sources.drift import common_type, conform, conform_all, joined_schema, schema_drift
from tableflow.sources.files import inline_table, read_csv, read_jdbc, read_parquet
from tableflow.sources.monthly import (
    month_labels,
    month_reader,
    read_monthly_output,
    readin_monthly,
    split_by_month,
    write_monthly,
    write_monthly_tables,
)

__all__ = [name for name in dir() if not name.startswith("_")]
