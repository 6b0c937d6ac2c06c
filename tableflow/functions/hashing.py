"""Row-key salting with the Java ``String.hashCode`` rule, as SQL expressions.

``hashCode`` is ``s[0]*31^(n-1) + ... + s[n-1]`` in 32-bit two's complement,
so the salt of a key is the same as the one a JVM bulk loader computes (keys
1..4 with 2 salts give 1,0,1,0).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_WRAP = 1 << 32


def java_string_hash(key: str | Column) -> Column:
    """Java ``String.hashCode`` of a string column, as a signed int in a bigint.

    A fold over the characters; one beyond U+FFFF counts as its two UTF-16 units.
    Deterministic, so filters pass it and it can be a join key.  NULL stays NULL.
    """
    k = _col(key).cast("string")

    def step(total: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        beyond = point - 0x10000
        pair = (total * 31 + F.shiftright(beyond, 10) + 0xD800) * 31 + beyond.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(point < 0x10000, total * 31 + point).otherwise(pair) % _WRAP

    unsigned = F.aggregate(F.split(k, ""), F.lit(0).cast("bigint"), step)
    return F.when(unsigned >= _WRAP // 2, unsigned - _WRAP).otherwise(unsigned)


def digits_required(modulus: int) -> int:
    """Width of the zero-padded salt: that of the largest one."""
    if modulus < 2:
        raise ValueError("salting needs at least 2 buckets")
    return len(str(modulus - 1))


def salt_prefix(key: str | Column, modulus: int, hash_col: Column | None = None) -> Column:
    """Zero-padded ``abs(hash) % modulus``; abs is taken in bigint (no overflow)."""
    h = java_string_hash(key) if hash_col is None else hash_col
    bucket = F.abs(h) % F.lit(modulus)
    return F.lpad(bucket.cast("string"), digits_required(modulus), "0")


def salted_key(key: str | Column, modulus: int, prefix: Column | None = None) -> Column:
    """``<salt>:<key>``."""
    p = salt_prefix(key, modulus) if prefix is None else prefix
    return F.concat_ws(":", p, _col(key).cast("string"))
