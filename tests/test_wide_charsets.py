"""Spools whose line feed is several bytes."""

import os
import random

import pytest

from tableflow.session import scratch_path
from tableflow.streaming import FlowSpec, read_flow_output, run_flows, write_spool
from tableflow.streaming.flows import line_separator

WIDE = ["UTF-16LE", "UTF-16BE", "utf_32le", "UTF-32BE"]
TEXT = "plain\ncafé — żółć\n\n日本語\r\n🙂 x\n" + "long" * 700 + "\nlast"


def _write(path, data: bytes):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "f.txt"), "wb") as f:
        f.write(data)


def _lines(spark, root, charset, **options):
    spec = FlowSpec(f"{root}/spool", f"{root}/sink", charset=charset, **options)
    run_flows(spark, {"wide": spec})
    return [r.value for r in read_flow_output(spark, spec).collect()]


@pytest.mark.parametrize("charset", WIDE)
def test_lines_are_those_of_the_text(spark, charset):
    root = scratch_path(spark, "wide").removeprefix("file:")
    codec = charset.replace("_", "-")
    _write(f"{root}/spool", "﻿".encode(codec) + (TEXT + "\n").encode(codec))
    got = _lines(spark, root, charset, max_line_length=2048)
    want = [x[i:i + 2048] for x in TEXT.split("\n") for i in range(0, max(len(x), 1), 2048)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE"])
def test_line_feed_bytes_across_two_characters_do_not_cut_a_line(spark, charset):
    # U+0A05 U+0100 has the bytes of a line feed inside in one byte order, U+0100 U+0A05 in the other
    lines = ["ਅĀ", "Āਅ", "a ਅĀ b Āਅ c", "ਅĀਅĀਅĀ", "Āਅ" * 9, "plain"]
    root = scratch_path(spark, "wide").removeprefix("file:")
    _write(f"{root}/spool", ("\n".join(lines) + "\n").encode(charset))
    assert sorted(_lines(spark, root, charset)) == sorted(lines)


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE"])
def test_a_file_in_many_parts(spark, charset):
    rng = random.Random(1)
    lines = ["".join(rng.choice("abcé日 ") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    root = scratch_path(spark, "wide").removeprefix("file:")
    _write(f"{root}/spool", ("\n".join(lines) + "\n").encode(charset))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7777")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert sorted(_lines(spark, root, charset)) == sorted(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_a_character_that_is_cut_off_fails(spark):
    root = scratch_path(spark, "wide").removeprefix("file:")
    _write(f"{root}/spool", "one\ntwo\n".encode("utf-16-le") + b"x")
    with pytest.raises(RuntimeError, match="inside a character"):
        _lines(spark, root, "UTF-16LE")


@pytest.mark.parametrize("charset", WIDE[:2])
def test_written_spools_have_the_charsets_bytes(spark, charset):
    root = scratch_path(spark, "wide").removeprefix("file:")
    df = spark.createDataFrame([(TEXT, "x")], "text string, flow string").coalesce(1)
    write_spool(df, f"{root}/out", "flow", charset=charset)
    folder = f"{root}/out/flow=x"
    data = b"".join(open(f"{folder}/{n}", "rb").read() for n in os.listdir(folder) if n.startswith("part-"))
    assert data == (TEXT + "\n").encode(charset)
    assert line_separator(charset).encode() == "\n".encode(charset)
