"""Decode Avro datums (flat records) into typed columns.

An Arrow UDF decodes whole Arrow batches with numpy, whatever is on the classpath: every step (varint, string, boolean, float,
union branch) runs over all rows of the batch at once, looping only over the fields and
over the at most 10 bytes of a varint, never over rows. Spark partitions the batches.

A datum that is truncated, has trailing bytes, a bad union index, a boolean byte other
than 0/1, invalid UTF-8, an over-long varint or an int out of 32-bit range is reported
through ``_decode_ok = false`` with NULL fields.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import avro_type, null_index
from ..session import ship_package

DECODE_OK = "_decode_ok"
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_PAD = 16  # zero bytes appended so reads past the end stay in bounds (and are flagged)


def _varint(data, pos, end, max_bytes):
    """Zig-zag varints at ``pos``: (value int64, next position, ok)."""
    n = len(pos)
    acc = np.zeros(n, dtype=np.uint64)
    done = np.zeros(n, dtype=bool)
    ok = np.ones(n, dtype=bool)
    nbytes = np.zeros(n, dtype=np.int64)
    last = len(data) - 1
    for k in range(max_bytes):
        p = pos + k
        b = data[np.clip(p, 0, last)].astype(np.uint64)
        active = ~done
        ok &= ~active | (p < end)
        if k == 9:  # the tenth byte of a 64-bit varint carries one bit
            ok &= ~active | (b <= 1)
        acc |= np.where(active, (b & np.uint64(0x7F)) << np.uint64(7 * k), np.uint64(0))
        stop = active & ((b & np.uint64(0x80)) == 0)
        nbytes[stop] = k + 1
        done |= stop
    ok &= done
    value = (acc >> np.uint64(1)).astype(np.int64) ^ -((acc & np.uint64(1)).astype(np.int64))
    return value, pos + nbytes, ok


def _read(atype, data, pos, end):
    """One value per row at ``pos``: (numpy values or Arrow array, next pos, ok)."""
    if atype in ("int", "long"):
        v, nxt, ok = _varint(data, pos, end, 5 if atype == "int" else 10)
        if atype == "int":
            ok &= (v >= _INT_MIN) & (v <= _INT_MAX)
        return v, nxt, ok
    if atype == "string":
        length, start, ok = _varint(data, pos, end, 10)
        ok &= (length >= 0) & (start + length <= end)
        return (start, np.where(ok, length, 0)), start + np.maximum(length, 0), ok
    if atype == "boolean":
        b = data[np.clip(pos, 0, len(data) - 1)]
        ok = (pos < end) & (b <= 1)
        return b == 1, pos + 1, ok
    if atype in ("float", "double"):
        width = 4 if atype == "float" else 8
        idx = np.clip(pos, 0, len(data) - width)[:, None] + np.arange(width)
        raw = np.ascontiguousarray(data[idx])
        vals = raw.view("<f4" if width == 4 else "<f8").reshape(-1)
        return vals, pos + width, pos + width <= end
    raise ValueError(f"unsupported Avro type {atype}")


def _strings(data, starts, lengths, present):
    """Arrow string array from byte ranges; rows with invalid UTF-8 become not-present."""
    lengths = np.where(present, lengths, 0).astype(np.int64)
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    # ranges lie in their records, so they are in order and apart: one mark a byte tells them
    some = lengths > 0
    marks = np.zeros(len(data) + 1, dtype=np.int8)
    marks[starts[some]] += 1
    marks[starts[some] + lengths[some]] -= 1
    body = data[np.cumsum(marks[:-1], dtype=np.int8).view(bool)]
    mask = pa.array(~present, type=pa.bool_())
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    )
    binary = pa.compute.if_else(mask, pa.scalar(None, pa.large_binary()), binary)
    try:
        return binary.cast(pa.large_string()), present
    except (pa.ArrowInvalid, UnicodeDecodeError):
        good = np.array(
            [v is None or _utf8(v) for v in binary.to_pylist()], dtype=bool
        )  # rare: only a batch holding invalid UTF-8 is checked value by value
        present = present & good
        binary = pa.compute.if_else(pa.array(~present), pa.scalar(None, pa.large_binary()), binary)
        return binary.cast(pa.large_string()), present


def _utf8(v: bytes) -> bool:
    try:
        v.decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


_ARROW_TYPES = {
    "int": pa.int32(),
    "long": pa.int64(),
    "boolean": pa.bool_(),
    "float": pa.float32(),
    "double": pa.float64(),
}


def decode_arrow(payloads: pa.Array, fields: list[tuple[str, str, int]]) -> pa.StructArray:
    """Decode a binary Arrow array; ``fields`` = (name, avro type, null branch or -1)."""
    arr = payloads.cast(pa.large_binary())
    n = len(arr)
    valid = np.asarray(arr.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset : arr.offset + n + 1]
    raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, dtype=np.uint8)
    data = np.concatenate([raw, np.zeros(_PAD, dtype=np.uint8)])
    pos = offsets[:-1].copy()
    end = offsets[1:].copy()
    ok = valid.copy()
    decoded = []
    for _name, atype, ni in fields:
        present = np.ones(n, dtype=bool)
        if ni >= 0:
            branch, vpos, bok = _varint(data, pos, end, 10)
            ok &= bok & ((branch == 0) | (branch == 1))
            present = branch != ni
        else:
            vpos = pos
        values, nxt, vok = _read(atype, data, vpos, end)
        ok &= ~present | vok
        pos = np.where(present, nxt, vpos)
        decoded.append((atype, values, present))
    ok &= pos == end
    children = [pa.array(ok, type=pa.bool_())]
    for atype, values, present in decoded:
        keep = present & ok
        if atype == "string":
            starts, lengths = values
            col, keep2 = _strings(data, starts, lengths, keep)
            ok &= ~keep | keep2  # invalid UTF-8 makes the whole record bad
            children.append(col)
        else:
            children.append(pa.array(values, mask=~keep, type=_ARROW_TYPES[atype]))
    if not ok.all():  # a late UTF-8 failure: blank every field of the bad rows
        bad = pa.array(~ok)
        children = [pa.array(ok, type=pa.bool_())] + [
            pa.compute.if_else(bad, pa.scalar(None, c.type), c) for c in children[1:]
        ]
    names = [DECODE_OK] + [name for name, _, _ in fields]
    return pa.StructArray.from_arrays(children, names=names)


def _decoded_type(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(DECODE_OK, T.BooleanType(), False)]
    fields += [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType(fields)


def _arrow_decoder(schema: T.StructType):
    fields = [(f.name, avro_type(f), null_index(f)) for f in schema.fields]

    def decode(payload: pa.Array) -> pa.Array:
        return decode_arrow(payload, fields)

    return F.arrow_udf(decode, _decoded_type(schema))


def decode_struct(payload_col: Column | str, schema: T.StructType, spark=None) -> Column:
    """A struct column ``(_decode_ok, field...)`` decoded from an Avro datum column."""
    col = F.col(payload_col) if isinstance(payload_col, str) else payload_col
    if spark is not None:
        ship_package(spark)
    return _arrow_decoder(schema)(col)


def decode_columns(
    df: DataFrame, schema: T.StructType, payload_col: str = "payload", keep_struct: bool = False
) -> DataFrame:
    """Add ``_decode_ok`` and one typed column per schema field."""
    tmp = "__decoded"
    out = df.withColumn(tmp, decode_struct(payload_col, schema, df.sparkSession))
    cols = [F.col(f"{tmp}.{DECODE_OK}").alias(DECODE_OK)]
    cols += [F.col(f"{tmp}.`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    out = out.select("*", *cols)
    return out if keep_struct else out.drop(tmp)
