"""Closing of idle files: one row when a base name has had no line for a while.

A text sink that keeps a file open per base name closes it after some idle
seconds.  Here that is keyed state with a processing-time timer: the state of a
base name holds what its lines add up to, every arrival sets the timer anew, and
when it runs out one "closed" row is emitted and the state is dropped.  A line
that arrives later opens the name again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tableflow.defaults import DEFAULT_IDLE_SECONDS
from tableflow.streaming.flows import FlowSpec, flow_session, spool_stream

CLOSED_SCHEMA = "name string, n_lines long, n_chars long"


def _added_up(lines: DataFrame, name_col: str, value_col: str) -> DataFrame:
    """Per batch of lines in a task and name: their number and characters, so a hot name is a few rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.table({"name": batch.column(0), "n": batch.column(1)}).group_by("name").aggregate(
                [([], "count_all"), ("n", "sum")])
            yield from sums.select(["name", "count_all", "n_sum"]).rename_columns(["name", "n_lines", "n_chars"]).cast(
                pa.schema([("name", pa.string()), ("n_lines", pa.int64()), ("n_chars", pa.int64())])).combine_chunks().to_batches()

    chars = F.coalesce(F.length(F.col(value_col)), F.lit(0)).cast("long")
    named = F.coalesce(F.col(name_col).cast("string"), F.lit(""))
    return lines.select(named.alias("name"), chars.alias("n")).mapInArrow(add, CLOSED_SCHEMA)


def closed_files(lines: DataFrame, idle_seconds: float = DEFAULT_IDLE_SECONDS, name_col: str = "basename",
                 value_col: str = "value") -> DataFrame:
    """``name, n_lines, n_chars`` of a stream of lines: a row each time a name was idle for ``idle_seconds``.

    The figures are those since the name was opened; a NULL name is ''.  Names
    are independent, and a name's state is three numbers whatever its size.
    The query that runs this needs a processing-time trigger: a timer is looked
    at with every trigger, also when no line arrives.
    """
    millis = int(idle_seconds * 1000)

    def close(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n_lines, n_chars = state.get
            state.remove()
            yield pd.DataFrame({"name": [key[0]], "n_lines": [n_lines], "n_chars": [n_chars]})
            return
        n_lines, n_chars = state.get if state.exists else (0, 0)
        for rows in batches:
            n_lines += int(rows["n_lines"].sum())
            n_chars += int(rows["n_chars"].sum())
        state.update((n_lines, n_chars))
        state.setTimeoutDuration(millis)

    return _added_up(lines, name_col, value_col).groupBy("name").applyInPandasWithState(
        close, CLOSED_SCHEMA, "n_lines long, n_chars long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_closing(lines: DataFrame, out_dir: str, checkpoint_dir: str, idle_seconds: float = DEFAULT_IDLE_SECONDS,
                  interval_seconds: float = 1.0, name_col: str = "basename", value_col: str = "value") -> StreamingQuery:
    """Write the closed rows of a stream of lines to ``out_dir`` (parquet, exactly once per batch).

    A name is closed at the first trigger after its timer ran out.
    """
    return (closed_files(lines, idle_seconds, name_col, value_col).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_dir).trigger(processingTime=f"{interval_seconds} seconds").start(out_dir))


def start_flow_closing(spark: SparkSession, spec: FlowSpec, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """The closed rows of a spool flow: its lines as the flow delivers them, its idle seconds as the limit."""
    lines = spool_stream(flow_session(spark, spec.charset), spec)
    return start_closing(lines, out_dir, checkpoint_dir, spec.idle_seconds)


def open_names(query: StreamingQuery) -> int:
    """Names that are open, by the query's last report; 0 before the first."""
    progress = query.lastProgress
    return sum(s["numRowsTotal"] for s in progress["stateOperators"]) if progress else 0


def _batch(query: StreamingQuery) -> tuple[int, int]:
    """Number of the last reported batch and the rows that it read; -1 and 0 before the first."""
    progress = query.lastProgress
    return (progress["batchId"], progress["numInputRows"]) if progress else (-1, 0)


def wait_until_read(query: StreamingQuery, timeout_seconds: float = 120) -> None:
    """Wait until a batch that began after this call found nothing new to read.

    (Timers make a batch of every trigger, so a query is never out of batches.)
    """
    deadline = time.monotonic() + timeout_seconds
    begun = _batch(query)[0] + 2  # the next one may have listed its files already
    while (last := _batch(query))[0] < begun or last[1]:
        _still_running(query, deadline, "lines are still being read")
        time.sleep(0.05)


def wait_until_closed(query: StreamingQuery, timeout_seconds: float = 120) -> None:
    """Wait until all lines that are there now have been read and every name is closed."""
    deadline = time.monotonic() + timeout_seconds
    wait_until_read(query, timeout_seconds)
    while open_names(query):
        _still_running(query, deadline, "names are still open")
        time.sleep(0.05)


def _still_running(query: StreamingQuery, deadline: float, what: str) -> None:
    if query.exception() is not None:
        raise query.exception()
    if time.monotonic() > deadline:
        raise TimeoutError(what)


def read_closed(spark: SparkSession, out_dir: str) -> DataFrame:
    """What :func:`start_closing` has committed."""
    return spark.read.schema(CLOSED_SCHEMA).parquet(out_dir)
