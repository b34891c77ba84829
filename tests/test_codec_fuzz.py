"""The batch decoder against a plain per-record reference decoder, without Spark:
valid records from a small encoder, and arbitrary byte strings."""

import math
import struct

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from streamledger.functions.codec import decode_arrow

FIELDS = [("s", "string", 0), ("i", "int", -1), ("l", "long", 1), ("b", "boolean", -1), ("f", "float", -1), ("d", "double", 0)]


def _zz(v):
    return (v << 1) ^ (v >> 63)


def _varint(v):
    u = _zz(v) & (2**64 - 1)
    out = bytearray()
    while True:
        byte = u & 0x7F
        u >>= 7
        if u:
            out.append(byte | 0x80)
        else:
            out.append(byte)
            return bytes(out)


def _encode(rec):
    out = bytearray()
    for (name, atype, ni), v in zip(FIELDS, rec):
        if ni >= 0:
            if v is None:
                out += _varint(ni)
                continue
            out += _varint(1 - ni)
        if atype == "string":
            b = v.encode("utf-8")
            out += _varint(len(b)) + b
        elif atype in ("int", "long"):
            out += _varint(v)
        elif atype == "boolean":
            out.append(1 if v else 0)
        elif atype == "float":
            out += struct.pack("<f", v)
        else:
            out += struct.pack("<d", v)
    return bytes(out)


class Bad(Exception):
    pass


def _ref_long(buf, pos):
    result = shift = 0
    while True:
        if pos >= len(buf):
            raise Bad
        b = buf[pos]
        pos += 1
        if shift == 63 and b > 1:
            raise Bad
        result |= (b & 0x7F) << shift
        if not b & 0x80:
            return (result >> 1) ^ -(result & 1), pos
        shift += 7
        if shift > 63:
            raise Bad


def _ref_decode(buf):
    pos, out = 0, []
    for _name, atype, ni in FIELDS:
        if ni >= 0:
            br, pos = _ref_long(buf, pos)
            if br not in (0, 1):
                raise Bad
            if br == ni:
                out.append(None)
                continue
        if atype in ("int", "long"):
            v, pos = _ref_long(buf, pos)
            if atype == "int" and not -(2**31) <= v < 2**31:
                raise Bad
        elif atype == "string":
            n, pos = _ref_long(buf, pos)
            if n < 0 or pos + n > len(buf):
                raise Bad
            try:
                v = buf[pos : pos + n].decode("utf-8")
            except UnicodeDecodeError as exc:
                raise Bad from exc
            pos += n
        elif atype == "boolean":
            if pos >= len(buf) or buf[pos] > 1:
                raise Bad
            v, pos = buf[pos] == 1, pos + 1
        else:
            w, fmt = (4, "<f") if atype == "float" else (8, "<d")
            if pos + w > len(buf):
                raise Bad
            v, pos = struct.unpack_from(fmt, buf, pos)[0], pos + w
        out.append(v)
    if pos != len(buf):
        raise Bad
    return out


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b


def _check(payloads):
    got = decode_arrow(pa.array(payloads, type=pa.binary()), FIELDS).to_pylist()
    for p, g in zip(payloads, got):
        try:
            exp = None if p is None else _ref_decode(p)
        except Bad:
            exp = None
        assert g["_decode_ok"] == (exp is not None), (p, g)
        if exp is not None:
            assert all(_same(g[name], e) for (name, _, _), e in zip(FIELDS, exp)), (p, g, exp)
        else:
            assert all(g[name] is None for name, _, _ in FIELDS)


records = st.tuples(
    st.one_of(st.none(), st.text(max_size=30)),
    st.integers(-(2**31), 2**31 - 1),
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.booleans(),
    st.floats(width=32),
    st.one_of(st.none(), st.floats()),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(records, max_size=30))
def test_valid_records(recs):
    _check([_encode(r) for r in recs])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.binary(max_size=40)), max_size=30))
def test_arbitrary_bytes(blobs):
    _check(blobs)


@settings(max_examples=200, deadline=None)
@given(records, st.integers(0, 60), st.integers(0, 255), st.booleans())
def test_mutated_records(rec, at, byte, cut):
    raw = bytearray(_encode(rec))
    if raw:
        i = at % len(raw)
        if cut:
            raw = raw[:i]
        else:
            raw[i] = byte
    _check([bytes(raw), _encode(rec), None, b""])
