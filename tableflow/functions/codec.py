"""Cell value coding: 4-byte big-endian ints and charset text, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296
_TWO_31 = 2147483648


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_to_bytes4(c: str | Column) -> Column:
    """int -> 4 bytes, big-endian two's complement (like ``Bytes.toBytes(int)``).

    ``hex`` of a negative number is the 64-bit two's complement, so pad to 16
    hex digits first and keep the low 8.
    """
    x = _col(c).cast("bigint")
    return F.unhex(F.right(F.lpad(F.hex(x), 16, "0"), F.lit(8)))


def bytes4_to_int(c: str | Column) -> Column:
    """4 bytes big-endian -> int (like ``Bytes.toInt``); other lengths -> NULL."""
    b = _col(c)
    unsigned = F.conv(F.hex(b), 16, 10).cast("bigint")
    signed = F.when(unsigned >= _TWO_31, unsigned - _TWO_32).otherwise(unsigned)
    return F.when(F.length(b) == 4, signed.cast("int"))


def text_to_bytes(c: str | Column, charset: str = "UTF-8") -> Column:
    return F.encode(_col(c).cast("string"), charset)


def bytes_to_text(c: str | Column, charset: str = "UTF-8") -> Column:
    return F.decode(_col(c), charset)
