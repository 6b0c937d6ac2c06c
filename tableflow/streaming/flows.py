"""Spool-directory ingest with Structured Streaming.

A *flow* watches one directory of text files and delivers every line as a
text line into a sink directory, one output set per source file base name:

* lines are split at the line feed of the flow's charset, also where that is
  several bytes, and decoded from it (strict UTF-8 by default: bad bytes fail the
  batch, as an undeclared charset does in a spool agent);
* a line longer than ``max_line_length`` characters is cut and continues in
  the next line(s) (default 2048);
* the query is checkpointed, so a restart on the same checkpoint neither
  loses nor repeats lines, and the file sink commits exactly once per batch.

``run_flows`` starts one independent streaming query per flow spec, each
with its own checkpoint, so flows are added or stopped one by one.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tableflow.defaults import (
    DEFAULT_IDLE_SECONDS,
    DEFAULT_MAX_LINE_LENGTH,
    FLOW_KEY_CHARSET,
    FLOW_KEY_MAX_LINE,
    FLOW_KEY_SINK_DIR,
    FLOW_KEY_SPOOL_DIR,
)
from tableflow.functions.text import chunk_text, split_lines


# Charsets Spark's encode/decode accept without the legacy Java-charset switch.
_STANDARD_CHARSETS = {"utf-8", "us-ascii", "iso-8859-1", "utf-16le", "utf-16be"}
# Charsets whose line feed is several bytes: how many, and the place of the byte that is not 0.
_WIDE_CHARSETS = {"utf-16le": (2, 0), "utf-16be": (2, 1), "utf-32le": (4, 0), "utf-32be": (4, 3)}
# These leave the byte order to a mark at the start of a file, which its later parts do not see.
_UNORDERED_CHARSETS = ("utf-16", "utf-32", "ucs-2", "ucs-4", "iso-10646-ucs-2")


@dataclass(frozen=True)
class FlowSpec:
    spool_dir: str
    sink_dir: str
    charset: str | None = None
    max_line_length: int = DEFAULT_MAX_LINE_LENGTH
    checkpoint_dir: str | None = None
    available_now: bool = True
    interval_seconds: int = DEFAULT_IDLE_SECONDS
    # bounded micro-batches: a large backlog is drained in steps, not at once
    max_files_per_trigger: int | None = 1000
    archive_dir: str | None = None
    # a base name without a new line for so long is closed (see idle.py)
    idle_seconds: float = DEFAULT_IDLE_SECONDS

    def __post_init__(self) -> None:
        _check_charset(self.charset)


def _plain_name(charset: str | None) -> str:
    name = (charset or "").lower().replace("_", "-").removeprefix("x-")
    return re.sub(r"^(utf|ucs)-?([0-9]+)-?", r"\1-\2", name)


def _wide(charset: str | None) -> tuple[int, int] | None:
    return _WIDE_CHARSETS.get(_plain_name(charset))


def _check_charset(charset: str | None) -> None:
    if _wide(charset) is None and _plain_name(charset).startswith(_UNORDERED_CHARSETS):
        raise ValueError(f"charset {charset}: name the byte order, as in UTF-16LE")


def line_separator(charset: str | None) -> str:
    """The line feed of a charset, as the text whose UTF-8 bytes are the ones it has there."""
    wide = _wide(charset)
    return "\n" if wide is None else "\0" * wide[1] + "\n" + "\0" * (wide[0] - wide[1] - 1)


def whole_characters(lines: DataFrame, charset: str | None, col: str = "value") -> DataFrame:
    """Lines of a wide charset with those joined again that were cut inside two characters.

    The bytes of a line feed can also stand across two characters: then the pieces on
    both sides are no whole number of characters.  They follow each other where the
    file is read, and are joined there; if the rest of a line is in another part of
    the file, the read fails rather than give half characters.  A byte order mark at
    the start of a file is no part of its first line.  Other charsets pass.
    """
    wide = _wide(charset)
    if wide is None:
        return lines
    width, feed = wide[0], line_separator(charset).encode()
    mark = "\ufeff".encode(_plain_name(charset))
    others = [c for c in lines.columns if c not in (col, "_metadata")]
    held = lines.select(*[F.col(c) for c in others], F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_start"), F.col(col).cast("binary").alias(col))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_ = None, b""
        for batch in batches:
            kept, values = [], []
            at = [batch.schema.get_field_index(c) for c in ("_file", "_start", col)]
            for k, (file, start, value) in enumerate(zip(*(batch.column(i).to_pylist() for i in at))):
                if (file, start) != part:
                    if open_:
                        raise ValueError(f"a line of {part[0]} is cut between parts of the file inside a character")
                    part = (file, start)
                    value = value.removeprefix(mark) if start == 0 else value
                value = open_ + value
                if len(value) % width:
                    open_ = value + feed
                else:
                    open_ = b""
                    kept.append(k)
                    values.append(value)
            rows = batch.take(pa.array(kept, pa.int64()))
            columns = [rows.column(rows.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary())], [*others, col])
        if open_:
            raise ValueError(f"a line of {part[0]} is cut between parts of the file inside a character")

    kinds = dict(held.dtypes)
    return held.mapInArrow(join, ", ".join(f"`{c}` {kinds[c]}" for c in [*others, col]))


def _needs_legacy_charsets(charset: str | None) -> bool:
    return charset is not None and charset.lower() not in _STANDARD_CHARSETS


def flow_session(spark: SparkSession, charset: str | None) -> SparkSession:
    """A session for one flow; Java charsets are enabled there only."""
    if not _needs_legacy_charsets(charset):
        return spark
    s = spark.newSession()
    s.conf.set("spark.sql.legacy.javaCharsets", "true")
    return s


def decode_lines(lines: DataFrame, charset: str | None, col: str = "value") -> DataFrame:
    """Text-source lines keep their raw bytes; decode them from ``charset``.

    ``None`` means strict UTF-8: an invalid line fails the job.
    """
    c = F.col(col)
    if charset is None or charset.lower().replace("-", "") == "utf8":
        return lines.withColumn(col, F.validate_utf8(c))
    return lines.withColumn(col, F.decode(c.cast("binary"), charset))


def chunk_lines(lines: DataFrame, max_line_length: int, col: str = "value") -> DataFrame:
    """Cut long lines into ``max_line_length`` pieces (works on streams too)."""
    cols = [c for c in lines.columns if c != col]
    return lines.select(*cols, F.explode(chunk_text(F.col(col), max_line_length)).alias(col))


def spool_stream(spark: SparkSession, spec: FlowSpec) -> DataFrame:
    """Streaming frame (basename, value) of one spool directory."""
    # only a line feed ends a line: a carriage return is part of it
    reader = spark.readStream.format("text").option("lineSep", line_separator(spec.charset))
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
    if spec.archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", spec.archive_dir)
    lines = reader.load(spec.spool_dir)
    if _wide(spec.charset):
        lines = lines.withColumn("basename", F.col("_metadata.file_name")).select("basename", "value", "_metadata")
        raw = whole_characters(lines, spec.charset).select("basename", "value")
    else:
        raw = lines.select(F.col("_metadata.file_name").alias("basename"), F.col("value"))
    return chunk_lines(decode_lines(raw, spec.charset), spec.max_line_length)


def start_flow(spark: SparkSession, name: str, spec: FlowSpec) -> StreamingQuery:
    """Start one flow: spool dir -> decode -> cut -> text files per base name."""
    session = flow_session(spark, spec.charset)
    checkpoint = spec.checkpoint_dir or os.path.join(spec.sink_dir, "_checkpoint")
    writer = (
        spool_stream(session, spec)
        .writeStream.format("text")
        .outputMode("append")
        .partitionBy("basename")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    if spec.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{spec.interval_seconds} seconds")
    return writer.start(os.path.join(spec.sink_dir, "data"))


def run_flows(spark: SparkSession, flows: Mapping[str, FlowSpec], wait: bool = True) -> dict[str, StreamingQuery]:
    """One streaming query per flow; with ``wait`` block until every
    run-to-completion (``available_now``) flow has finished.  Continuous flows
    keep running; stop them through the returned handles.  If a flow fails (to
    start or later), the others that wait are let finish, every flow still
    running is stopped, and one error names all that failed."""
    queries: dict[str, StreamingQuery] = {}
    failed: dict[str, str] = {}
    for name, spec in flows.items():
        try:
            queries[name] = start_flow(spark, name, spec)
        except Exception as e:  # noqa: BLE001
            failed[name] = str(e)
            break
    if wait:
        for name, q in queries.items():
            if flows[name].available_now:
                try:
                    q.awaitTermination()
                except StreamingQueryException as e:
                    failed[name] = str(e)
    if failed:
        for q in queries.values():
            q.stop()
        raise RuntimeError("; ".join(f"flow {name} failed: {text}" for name, text in failed.items()))
    return queries


def read_flow_output(spark: SparkSession, spec: FlowSpec) -> DataFrame:
    """Committed output of a flow (the sink's metadata log hides partial files).

    ``basename`` stays text even for file names that look like numbers.
    """
    reader = spark.read.schema("value string, basename string").option("lineSep", "\n")
    return reader.text(os.path.join(spec.sink_dir, "data"))


def write_spool(
    docs: DataFrame,
    spool_root: str,
    flow_col: str,
    text_col: str = "text",
    charset: str | None = None,
) -> str:
    """Lay text out as spool files, one directory ``<flow_col>=<flow>`` per flow.

    Every ``\\n``-separated line of each text becomes one file line; with a
    ``charset`` the files hold that charset's bytes (written raw).  A Java
    charset is encoded in a separate session that allows it: the frame is
    handed over as a global temporary view, so the caller's session settings
    are never changed.
    """
    _check_charset(charset)
    spark = docs.sparkSession
    view = None
    if _needs_legacy_charsets(charset):
        view = f"tableflow_spool_{uuid.uuid4().hex}"
        docs.createOrReplaceGlobalTempView(view)
        docs = flow_session(spark, charset).table(f"global_temp.{view}")
    try:
        lines = docs.select(
            F.col(flow_col).cast("string").alias(flow_col),
            F.explode(split_lines(F.col(text_col))).alias("value"),
        )
        if charset is not None and charset.lower().replace("-", "") != "utf8":
            lines = lines.withColumn("value", F.encode(F.col("value"), charset).cast("string"))
        lines.write.mode("overwrite").partitionBy(flow_col).text(spool_root, lineSep=line_separator(charset))
    finally:
        if view is not None:
            spark.catalog.dropGlobalTempView(view)
    return spool_root


def specs_from_sections(sections: Mapping[str, Mapping[str, str]], **common) -> dict[str, FlowSpec]:
    """Flow specs from section-style options (one section per flow).

    Each section names ``spoolDir`` and ``HDFSDir`` and may add
    ``inputCharset`` and ``maxLineLength`` (both may be given); a ``DEFAULT``
    section is skipped.  ``common`` sets further ``FlowSpec`` fields for all.
    """
    specs = {}
    for name, opts in sections.items():
        if name == "DEFAULT":
            continue
        missing = [k for k in (FLOW_KEY_SPOOL_DIR, FLOW_KEY_SINK_DIR) if k not in opts]
        if missing:
            raise ValueError(f"flow {name!r} lacks {missing}")
        specs[name] = FlowSpec(
            spool_dir=opts[FLOW_KEY_SPOOL_DIR],
            sink_dir=opts[FLOW_KEY_SINK_DIR],
            charset=opts.get(FLOW_KEY_CHARSET),
            max_line_length=int(opts.get(FLOW_KEY_MAX_LINE, DEFAULT_MAX_LINE_LENGTH)),
            **common,
        )
    return specs
