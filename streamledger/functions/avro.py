"""Avro binary encoding of flat records, written as Spark built-in expressions.

No Python runs per row: encoding builds hex text with ``hex``/``lpad`` and turns it into
bytes with ``unhex``, JVM-side in whole-stage codegen; only float and double fields take their
bytes from Arrow batches. Decoding lives in ``codec.py``.

Supported primitives: string, int, long, boolean, float, double, each optionally a
two-branch union with null (either branch order).

Encoding rules (Avro 1.x specification, binary encoding):
- int/long: zig-zag, then base-128 varint, low group first;
- string: long byte length, then UTF-8 bytes;
- boolean: one byte 0 or 1;
- float/double: IEEE 754 bits, little-endian;
- union: branch index as a long, then the branch value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import avro_type, null_index


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- encode


def zigzag(n: Column) -> Column:
    """Zig-zag of a 64-bit value, as an unsigned bit pattern held in a long."""
    n = n.cast("long")
    return F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63))


def _hex2(byte: Column) -> Column:
    return F.lpad(F.hex(byte), 2, "0")


def varint_hex(zz: Column, max_bytes: int) -> Column:
    """Hex text of the base-128 varint of an unsigned value (7 bits per byte)."""
    parts = []
    for k in range(max_bytes):
        rest = F.shiftrightunsigned(zz, 7 * k) if k else zz
        if 7 * (k + 1) < 64:
            more = F.shiftrightunsigned(zz, 7 * (k + 1)) != 0
            byte = rest.bitwiseAND(F.lit(127)).bitwiseOR(F.when(more, F.lit(128)).otherwise(F.lit(0)))
        else:  # last group of a 64-bit value: no continuation bit (shifts wrap at 64)
            byte = rest.bitwiseAND(F.lit(127))
        parts.append(_hex2(byte) if k == 0 else F.when(rest != 0, _hex2(byte)).otherwise(F.lit("")))
    return F.concat(*parts)


def _ieee_bytes(kind: str):
    """The little-endian IEEE 754 bytes of a number (NaN in its usual form): Spark has no
    expression for them, so they are taken from the Arrow batch."""

    @F.arrow_udf("binary")
    def convert(x: pa.Array) -> pa.Array:
        values = x.fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
        values[np.isnan(values)] = np.nan
        width = values.dtype.itemsize
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(values.tobytes())])
        return pc.if_else(x.is_valid(), raw.cast(pa.binary()), pa.scalar(None, pa.binary()))

    return convert


def _encode_value_hex_or_bytes(c: Column, atype: str) -> Column:
    """Binary Avro encoding of one non-null value."""
    if atype == "string":
        return F.concat(
            F.unhex(varint_hex(zigzag(F.octet_length(c)), 5)), F.encode(c, "UTF-8")
        )
    if atype == "int":
        return F.unhex(varint_hex(zigzag(c), 5))
    if atype == "long":
        return F.unhex(varint_hex(zigzag(c), 10))
    if atype == "boolean":
        return F.when(c, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    if atype == "float":
        return _ieee_bytes("<f4")(c.cast("float"))
    if atype == "double":
        return _ieee_bytes("<f8")(c.cast("double"))
    raise ValueError(f"unsupported Avro type {atype}")


def encode_field(c: Column | str, field: T.StructField) -> Column:
    c = _col(c)
    atype = avro_type(field)
    ni = null_index(field)
    value = _encode_value_hex_or_bytes(c, atype)
    if ni < 0:
        return F.when(
            c.isNull(), F.raise_error(F.lit(f"NULL in required field '{field.name}'"))
        ).otherwise(value)
    null_branch = "00" if ni == 0 else "02"
    value_branch = "02" if ni == 0 else "00"
    return F.when(c.isNull(), F.unhex(F.lit(null_branch))).otherwise(
        F.concat(F.unhex(F.lit(value_branch)), value)
    )


def encode_record(schema: T.StructType, columns: dict[str, Column] | None = None) -> Column:
    """Avro datum of a flat record; ``columns`` maps field name -> source column."""
    columns = columns or {}
    parts = [encode_field(columns.get(f.name, F.col(f.name)), f) for f in schema.fields]
    return F.concat(*parts)
