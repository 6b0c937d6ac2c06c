"""Idle base names are closed: one row each, state dropped."""

import os
import time

import pytest

from tableflow.session import scratch_path
from tableflow.streaming import FlowSpec, closed_files, read_closed, start_closing, start_flow_closing, wait_until_closed
from tableflow.streaming.idle import _added_up, open_names, wait_until_read


def _write(path, name, data: bytes):
    path = path.removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f".{name}"), "wb") as f:
        f.write(data)
    os.rename(os.path.join(path, f".{name}"), os.path.join(path, name))


def _rows(spark, out):
    return sorted((r.name, r.n_lines, r.n_chars) for r in read_closed(spark, out).collect())


def test_two_bursts_give_two_closed_rows_and_state_expires(spark):
    root = scratch_path(spark, "idle-t")
    spec = FlowSpec(f"{root}/spool", f"{root}/sink", max_line_length=4, idle_seconds=0.8)
    _write(f"{root}/spool", "a.txt", b"one\ntwo\nlonger\n")
    _write(f"{root}/spool", "b.txt", b"x\n\n")
    query = start_flow_closing(spark, spec, f"{root}/closed", f"{root}/ck")
    try:
        wait_until_closed(query, 40)
        # a line above the limit is two lines; an empty line is one without characters
        assert _rows(spark, f"{root}/closed") == [("a.txt", 4, 12), ("b.txt", 2, 1)]
        assert open_names(query) == 0
        _write(f"{root}/spool", "c.txt", b"later\n")
        wait_until_closed(query, 40)
        assert _rows(spark, f"{root}/closed") == [("a.txt", 4, 12), ("b.txt", 2, 1), ("c.txt", 2, 5)]
    finally:
        query.stop()


def test_a_name_opens_again_and_a_restart_keeps_open_names(spark):
    root = scratch_path(spark, "idle-t")
    lines = spark.createDataFrame([("n", "ab"), ("n", None), (None, "c")], "name string, value string")
    lines.write.parquet(f"{root}/spool/1")
    stream = spark.readStream.schema(lines.schema).parquet(f"{root}/spool/*")
    query = start_closing(stream, f"{root}/closed", f"{root}/ck", 30, 0.3, "name", "value")
    wait_until_read(query, 40)
    query.stop()  # both names are open
    assert _rows(spark, f"{root}/closed") == []
    lines.limit(1).write.parquet(f"{root}/spool/2")
    query = start_closing(stream, f"{root}/closed", f"{root}/ck", 0.6, 0.3, "name", "value")
    try:
        wait_until_read(query, 40)
        deadline = time.monotonic() + 60
        # the name with a new line has a new timer; the other keeps the long one it had
        while open_names(query) != 1 and time.monotonic() < deadline:
            time.sleep(0.1)
        assert open_names(query) == 1
    finally:
        query.stop()
    assert _rows(spark, f"{root}/closed") == [("n", 3, 4)]


def test_hot_names_are_added_up_before_the_shuffle(spark):
    lines = spark.range(50_000).selectExpr("IF(id % 3 = 0, concat('n', id % 100), 'hot') AS name", "'abc' AS value").coalesce(2)
    added = _added_up(lines, "name", "value")
    rows = added.collect()
    assert len(rows) < 50_000 / 10  # whatever the rows of an Arrow batch
    assert sum(r.n_lines for r in rows) == 50_000 and sum(r.n_chars for r in rows) == 150_000


def test_waiting_has_an_end(spark):
    root = scratch_path(spark, "idle-t")
    spark.createDataFrame([("n", "ab")], "name string, value string").write.parquet(f"{root}/spool")
    stream = spark.readStream.schema("name string, value string").parquet(f"{root}/spool")
    assert closed_files(stream, 1, "name").isStreaming
    query = start_closing(stream, f"{root}/closed", f"{root}/ck", 60, 0.3, "name", "value")
    try:
        with pytest.raises(TimeoutError, match="still"):
            wait_until_closed(query, 4)
    finally:
        query.stop()
