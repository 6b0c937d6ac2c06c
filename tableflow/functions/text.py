"""Text helpers: line splitting, fixed-width line chunking, safe column names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the parquet/Hive column-name rules reject.
_UNSAFE_NAME = re.compile(r"[ ,;{}()\n\t=]+")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: str | Column) -> Column:
    """Split on ``\\n`` and keep empty lines (also a trailing one)."""
    return F.split(_col(text), "\n", -1)


def chunk_text(line: str | Column, max_len: int) -> Column:
    """Array of ``max_len``-character pieces; an empty line gives one empty piece.

    A line longer than the limit is cut and goes on in the next piece(s),
    exactly as a line-length-limited line reader does.
    """
    if max_len < 1:
        raise ValueError("max_len must be positive")
    s = _col(line)
    n_pieces = F.greatest(F.ceil(F.length(s) / F.lit(max_len)) - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), n_pieces.cast("int")),
        lambda i: F.substring(s, i * max_len + 1, F.lit(max_len)),
    )


def safe_name(name: str) -> str:
    """Replace runs of characters unsafe in stored column names with ``_``."""
    return _UNSAFE_NAME.sub("_", name)
