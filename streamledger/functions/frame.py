"""Five-byte wire frame: magic byte 0, 4-byte big-endian signed schema id, Avro datum.

All built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frame layout.
MAGIC_HEX = "00"
HEADER_BYTES = 5

# Verdicts of the frame check.
OK = "ok"
NULL_VALUE = "null_value"
TOO_SHORT = "too_short"
BAD_MAGIC = "bad_magic"
BAD_PAYLOAD = "bad_payload"  # frame fine, Avro datum does not decode
VERDICTS = (OK, NULL_VALUE, TOO_SHORT, BAD_MAGIC, BAD_PAYLOAD)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frame_verdict(value: Column | str) -> Column:
    """'ok' / 'null_value' / 'too_short' / 'bad_magic'. Exactly five bytes is ok."""
    v = _col(value)
    return (
        F.when(v.isNull(), F.lit(NULL_VALUE))
        .when(F.length(v) < HEADER_BYTES, F.lit(TOO_SHORT))
        .when(F.substring(v, 1, 1) != F.unhex(F.lit(MAGIC_HEX)), F.lit(BAD_MAGIC))
        .otherwise(F.lit(OK))
    )


def schema_id(value: Column | str) -> Column:
    """Bytes 2-5 as a big-endian signed 32-bit integer (NULL when the frame is short)."""
    v = _col(value)
    unsigned = F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long")
    signed = F.shiftright(F.shiftleft(unsigned, 32), 32).cast("int")
    return F.when(F.length(v) >= HEADER_BYTES, signed)


def payload(value: Column | str) -> Column:
    """The datum after the five-byte header (empty for a bare header)."""
    v = _col(value)
    return F.when(
        F.length(v) >= HEADER_BYTES, v.substr(F.lit(HEADER_BYTES + 1), F.length(v) - HEADER_BYTES)
    )


def schema_id_hex(sid: int | Column) -> Column:
    """Eight hex digits of a signed 32-bit schema id (two's complement)."""
    if isinstance(sid, int):
        return F.lit(f"{sid & 0xFFFFFFFF:08X}")
    return F.lpad(F.hex(_col(sid).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")


def add_frame(datum: Column | str, sid: int | Column) -> Column:
    """Prefix an Avro datum with the magic byte and schema id."""
    return F.concat(F.unhex(F.concat(F.lit(MAGIC_HEX), schema_id_hex(sid))), _col(datum))
