"""Structured Streaming spool flows."""

from tableflow.streaming.flows import (
    DEFAULT_MAX_LINE_LENGTH,
    FlowSpec,
    chunk_lines,
    decode_lines,
    read_flow_output,
    run_flows,
    spool_stream,
    specs_from_sections,
    start_flow,
    write_spool,
)
from tableflow.streaming.idle import closed_files, read_closed, start_closing, start_flow_closing, wait_until_closed

__all__ = [name for name in dir() if not name.startswith("_")]
