"""NULL-on-failure casts that stay fast on dirty text and keep readable values.

``try_cast`` to an integral type raises and catches an exception for every bad
value (tens of microseconds each), and turns the text ``12.7`` into NULL.  A regex
first finds the whole-number part of plain decimal text; only a part within the
type's bounds is cast, so fractions are cut off, overflow gives NULL, and neither
text of any other shape nor a number out of bounds ever reaches the cast.  Dates
are taken from the text by a regex of their fields before they are parsed; only
days that do not exist (31 February) still cost an exception.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# bits of the types, which bound their values
_INTEGRAL = {"tinyint": 8, "byte": 8, "smallint": 16, "short": 16, "int": 32, "integer": 32, "bigint": 64, "long": 64}
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_NUMBER_TEXT = r"^[\x00-\x20]*(?:[+-]?[0-9]+(?:\.[0-9]*)?|[+-]?\.[0-9]+)[\x00-\x20]*$"
_WHOLE_PART = r"[+-]?[0-9]+(?=[.\x00-\x20]|$)"
# pattern letters whose digits may be fewer than written, and what text they match
_FIELDS = {"y": r"[0-9]{4}", "M": r"[0-9]{1,2}", "d": r"[0-9]{1,2}", "H": r"[0-9]{1,2}", "m": r"[0-9]{1,2}", "s": r"[0-9]{1,2}"}


def _fits(whole: Column, bits: int) -> Column:
    """Whether the whole number in a text is within a type's bounds, by its digits alone."""
    digits = F.regexp_replace(whole, r"^[+-]?0*", "")
    most = str((1 << (bits - 1)) - 1)
    bound = F.when(whole.startswith("-"), F.lit(str(1 << (bits - 1)))).otherwise(F.lit(most))
    return (F.length(digits) < len(most)) | ((F.length(digits) == len(most)) & (digits <= bound))


def safe_try_cast(c: Column, target: str, source_type: str | None = None) -> Column:
    """``c.try_cast(target)``; text to an integral type keeps the part before the point."""
    bits = _INTEGRAL.get(target.lower())
    if bits and source_type == "string":
        whole = F.when(c.rlike(r"^[\x00-\x20]*[+-]?\."), F.lit("0")).otherwise(F.regexp_extract(c, _WHOLE_PART, 0))
        return F.when(c.rlike(_NUMBER_TEXT) & _fits(whole, bits), whole.try_cast(target))
    if bits and bits < 64 and source_type and source_type.startswith(_NUMERIC):
        limit = 1 << (bits - 1)
        return F.when((c > F.lit(-limit - 1)) & (c < F.lit(limit)), c.try_cast(target))
    return c.try_cast(target)


def relaxed_pattern(fmt: str) -> tuple[str, str] | None:
    """A regex for text that begins like ``fmt`` and the pattern that reads it, or
    None if ``fmt`` has other than plain numeric fields."""
    regex, pattern = "", ""
    for field in re.findall(r"([A-Za-z])(\1*)|([^A-Za-z])", fmt):
        letter, more, other = field
        if other:
            if other == "'":
                return None
            regex, pattern = regex + re.escape(other), pattern + other
        elif letter not in _FIELDS or (letter == "M" and len(more) > 1) or (letter == "y" and len(more) != 3):
            return None
        else:
            regex, pattern = regex + _FIELDS[letter], pattern + (letter * 4 if letter == "y" else letter)
    return rf"^\s*({regex})", pattern


def try_text_to_timestamp(c: Column, fmt: str) -> Column:
    """Text read by the fields of ``fmt``, also with fewer digits and with any text after them; else NULL."""
    relaxed = relaxed_pattern(fmt)
    if relaxed is None:
        return F.try_to_timestamp(c, F.lit(fmt))
    regex, pattern = relaxed
    # text without the fields gives NULL here and never reaches the parser
    head = F.nullif(F.regexp_extract(c, regex, 1), F.lit(""))
    return F.try_to_timestamp(head, F.lit(pattern))
