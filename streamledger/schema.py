"""Record spec (Avro record JSON or the legacy field array) -> Spark ``StructType``.

Rules of the generator's schema mapping:

1. A root JSON array is the legacy form ``[{name, data_type, nullable}]``; ``nullable``
   defaults to false.
2. A root object must have ``type`` equal to ``record`` (any case) and an array ``fields``.
3. A field type is a name, a union array, or an object whose ``type`` is a name.
4. A union containing ``"null"`` makes the field nullable. Unions with two non-null
   branches are rejected (picking one would corrupt decoding).
5. Type names are trimmed and lower-cased; ``name``/``data_type``/``type`` must be
   present and non-null.

Each field keeps its Avro type and the position of the null branch in field metadata,
because the wire encoding of a union depends on the declared branch order.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

# The Avro type names the generator accepts and their Spark types.
GENERATOR_TYPES = {
    "string": ("string", T.StringType()),
    "int": ("int", T.IntegerType()),
    "int32": ("int", T.IntegerType()),
    "boolean": ("boolean", T.BooleanType()),
}

# Further primitive names the codec (decode / encode) accepts.
CODEC_TYPES = {
    **GENERATOR_TYPES,
    "long": ("long", T.LongType()),
    "int64": ("long", T.LongType()),
    "float": ("float", T.FloatType()),
    "float32": ("float", T.FloatType()),
    "double": ("double", T.DoubleType()),
    "float64": ("double", T.DoubleType()),
}

AVRO_TYPE_KEY = "avro_type"
NULL_INDEX_KEY = "avro_null_index"  # -1: not a union, 0: ["null", T], 1: [T, "null"]


class SchemaSpecError(ValueError):
    """Raised for a record spec the mapping rules do not accept."""


@dataclass(frozen=True)
class _FieldSpec:
    """A field in one form, however it was declared: its name, the type names of its
    non-null branches, and where the null branch stands (-1 without one)."""

    name: str
    branches: tuple[str, ...]
    null_at: int


def _fail(where: str, problem: str) -> SchemaSpecError:
    return SchemaSpecError(f"record schema, {where}: {problem}")


def _scalar_text(node: Any, key: str, where: str) -> str:
    value = node.get(key) if isinstance(node, dict) else None
    if value is None:
        raise _fail(where, f"no {key!r}")
    return value if isinstance(value, str) else json.dumps(value)


def _truthy(value: Any) -> bool:
    """JSON true, a non-zero number or the text "true"."""
    return value.strip() == "true" if isinstance(value, str) else isinstance(value, (bool, int, float)) and bool(value)


def _branch(node: Any, where: str) -> str:
    """The type name of a branch: a name, or an object that names one."""
    name = node.get("type") if isinstance(node, dict) else node
    if not isinstance(name, str):
        raise _fail(where, f"{json.dumps(node)} names no primitive type")
    return name.strip().lower()


def _column_spec(node: Any, i: int) -> _FieldSpec:
    """An entry of the plain list form: name, data_type, nullable."""
    where = f"entry {i}"
    name = _scalar_text(node, "name", where)
    return _FieldSpec(name, (_branch(_scalar_text(node, "data_type", where), where),), 0 if _truthy(node.get("nullable")) else -1)


def _avro_spec(node: Any, i: int) -> _FieldSpec:
    """A field of an Avro record."""
    name = _scalar_text(node, "name", f"field {i}")
    where = f"field {name!r}"
    declared = node.get("type")
    union = declared if isinstance(declared, list) else [declared]
    names = [_branch(x, where) for x in union]
    return _FieldSpec(name, tuple(x for x in names if x != "null"), names.index("null") if "null" in names else -1)


def _normalise(root: Any) -> list[_FieldSpec]:
    if isinstance(root, list):
        return [_column_spec(x, i) for i, x in enumerate(root)]
    if not isinstance(root, dict):
        raise _fail("top level", "neither a record nor a list of columns")
    if _scalar_text(root, "type", "top level").lower() != "record" or not isinstance(root.get("fields"), list):
        raise _fail("top level", "a record with a list of fields is needed")
    return [_avro_spec(x, i) for i, x in enumerate(root["fields"])]


def schema_from_spec(spec: str | dict | list, codec_types: bool = False) -> T.StructType:
    """Map a record spec to a ``StructType``: either form is normalised to field specs, which
    are then checked in one place.

    ``codec_types=False`` accepts the generator's three types only (string, int,
    boolean); ``True`` also accepts long, float and double for decoding.
    """
    try:
        root = json.loads(spec) if isinstance(spec, str) else spec
    except json.JSONDecodeError as why:
        raise _fail("text", f"not JSON ({why})") from why
    allowed = CODEC_TYPES if codec_types else GENERATOR_TYPES
    out = T.StructType()
    for f in _normalise(root):
        if len(f.branches) != 1:
            raise _fail(f"field {f.name!r}", f"one type beside null is needed, not {list(f.branches)}")
        if f.branches[0] not in allowed:
            raise _fail(f"field {f.name!r}", f"type {f.branches[0]!r} is not one of {sorted(allowed)}")
        avro, dtype = allowed[f.branches[0]]
        out.add(T.StructField(f.name, dtype, f.null_at >= 0, {AVRO_TYPE_KEY: avro, NULL_INDEX_KEY: f.null_at}))
    if not out.fields:
        raise _fail("top level", "no fields")
    return out


def avro_type(field: T.StructField) -> str:
    """Avro primitive of a field; derived from the Spark type when metadata is absent."""
    meta = field.metadata or {}
    if AVRO_TYPE_KEY in meta:
        return meta[AVRO_TYPE_KEY]
    by_type = {
        T.StringType: "string",
        T.IntegerType: "int",
        T.LongType: "long",
        T.BooleanType: "boolean",
        T.FloatType: "float",
        T.DoubleType: "double",
    }
    for cls, name in by_type.items():
        if isinstance(field.dataType, cls):
            return name
    raise _fail(f"field {field.name!r}", f"{field.dataType.simpleString()} has no Avro type here")


def null_index(field: T.StructField) -> int:
    meta = field.metadata or {}
    if NULL_INDEX_KEY in meta:
        return int(meta[NULL_INDEX_KEY])
    return 0 if field.nullable else -1


def to_avro_json(schema: T.StructType, name: str = "Record", namespace: str | None = None) -> str:
    """Avro record JSON for a mapped schema, keeping each union's branch order."""
    fields = []
    for f in schema.fields:
        t = avro_type(f)
        ni = null_index(f)
        if ni == 0:
            fields.append({"name": f.name, "type": ["null", t], "default": None})
        elif ni == 1:
            fields.append({"name": f.name, "type": [t, "null"]})
        else:
            fields.append({"name": f.name, "type": t})
    doc = {"type": "record", "name": name, "fields": fields}
    if namespace:
        doc["namespace"] = namespace
    return json.dumps(doc, separators=(",", ":"))


# The record schema of the sample configuration.
SAMPLE_RECORD_SCHEMA = {
    "type": "record",
    "name": "TestRecord",
    "fields": [
        {"name": "string_column", "type": "string"},
        {"name": "numeric_column", "type": "int"},
        {"name": "boolean_column", "type": ["null", "boolean"], "default": None},
    ],
}
