"""Message keys and registry-framed values, as column expressions.

A framed value is one zero byte, the schema id as four big-endian bytes, then
the encoded record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the frame.
FRAME_MARK = b"\x00"
FRAME_BYTES = 5


def raw_key(name: str) -> Column:
    """A string column as a raw UTF-8 message key."""
    return F.encode(F.col(name), "UTF-8")


def key_text(name: str) -> Column:
    """A raw message key back to text."""
    return F.decode(F.col(name), "UTF-8")


def frame(payload: Column, schema_id: int) -> Column:
    head = FRAME_MARK + int(schema_id).to_bytes(4, "big")
    return F.concat(F.lit(bytearray(head)), payload)


def frame_schema_id(message: Column) -> Column:
    """The schema id of a framed value; null when the frame is not one."""
    number = F.conv(F.hex(F.substring(message, 2, 4)), 16, 10).cast("int")
    return F.when(_is_framed(message), number)


def unframe(message: Column) -> Column:
    """The payload of a framed value; null when the frame is not one."""
    rest = F.substr(message, F.lit(FRAME_BYTES + 1))
    return F.when(_is_framed(message), rest)


def _is_framed(message: Column) -> Column:
    return (F.octet_length(message) >= FRAME_BYTES) & (
        F.substring(message, 1, 1) == F.lit(bytearray(FRAME_MARK))
    )
