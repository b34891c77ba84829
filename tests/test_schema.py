import pytest
from pyspark.sql import types as T

from streamledger.schema import SAMPLE_RECORD_SCHEMA, SchemaSpecError, null_index, schema_from_spec, to_avro_json


def test_sample_schema():
    s = schema_from_spec(SAMPLE_RECORD_SCHEMA)
    assert [f.name for f in s.fields] == ["string_column", "numeric_column", "boolean_column"]
    assert [type(f.dataType) for f in s.fields] == [T.StringType, T.IntegerType, T.BooleanType]
    assert [f.nullable for f in s.fields] == [False, False, True]
    assert null_index(s.fields[2]) == 0


def test_legacy_array_and_aliases():
    s = schema_from_spec('[{"name":"a","data_type":" INT32 "},{"name":"b","data_type":"String","nullable":true}]')
    assert isinstance(s["a"].dataType, T.IntegerType) and not s["a"].nullable
    assert isinstance(s["b"].dataType, T.StringType) and s["b"].nullable


def test_union_orders_and_type_objects():
    s = schema_from_spec(
        {"type": "RECORD", "fields": [
            {"name": "x", "type": ["int", "null"]},
            {"name": "y", "type": {"type": "int", "logicalType": "date"}},
        ]}
    )
    assert s["x"].nullable and null_index(s["x"]) == 1
    assert isinstance(s["y"].dataType, T.IntegerType)
    assert '"type":["int","null"]' in to_avro_json(s)


@pytest.mark.parametrize(
    "spec",
    [
        "",
        "   ",
        '"record"',
        '{"type":"enum","fields":[]}',
        '{"type":"record"}',
        '{"type":"record","fields":{}}',
        '{"type":"record","fields":[]}',
        '{"type":"record","fields":[{"type":"int"}]}',
        '{"type":"record","fields":[{"name":"a"}]}',
        '{"type":"record","fields":[{"name":"a","type":"long"}]}',
        '{"type":"record","fields":[{"name":"a","type":{"type":"array","items":"int"}}]}',
        '{"type":"record","fields":[{"name":"a","type":{"type":"record","fields":[]}}]}',
        '{"type":"record","fields":[{"name":"a","type":["int","string"]}]}',
        '[{"name":"a"}]',
    ],
)
def test_rejected_specs(spec):
    with pytest.raises(SchemaSpecError):
        schema_from_spec(spec)


def test_codec_types_accept_long_float_double():
    s = schema_from_spec('{"type":"record","fields":[{"name":"a","type":"long"},{"name":"b","type":"float"},{"name":"c","type":"double"}]}', codec_types=True)
    assert [type(f.dataType) for f in s.fields] == [T.LongType, T.FloatType, T.DoubleType]


def test_generator_options_from_connector_config():
    from streamledger.sources.config import generator_options

    cfg = {
        "name": "src",
        "config": {
            "task.messages.per.second": "60",
            "message.size.bytes": "0",
            "task.max.duration.seconds": "10",
            "record.schema.json": '[{"name":"a","data_type":"int"}]',
        },
    }
    o = generator_options(cfg)
    assert (o["rows_per_second"], o["string_bytes"], o["max_seconds"], o["run_indefinitely"], o["topic"]) == (60, 1, 10, False, "source-1")
    assert o["schema"].names == ["a"]
    with pytest.raises(SchemaSpecError):
        generator_options({"task.messages.per.second": "1"})
