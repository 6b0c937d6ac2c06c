"""Column-expression builders (all JVM-side, no UDFs)."""

from tableflow.functions.codec import bytes4_to_int, bytes_to_text, int_to_bytes4, text_to_bytes
from tableflow.functions.conditions import case_chain
from tableflow.functions.hashing import digits_required, java_string_hash, salt_prefix, salted_key
from tableflow.functions.text import chunk_text, safe_name, split_lines

__all__ = [
    "bytes4_to_int",
    "bytes_to_text",
    "case_chain",
    "chunk_text",
    "digits_required",
    "int_to_bytes4",
    "java_string_hash",
    "safe_name",
    "salt_prefix",
    "salted_key",
    "split_lines",
    "text_to_bytes",
]
