import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamledger.functions import frame
from streamledger.functions.avro import encode_record
from streamledger.functions.codec import decode_columns
from streamledger.operators.decode import VERDICT, check_frames, decode_payload, require_ok, split_bad
from streamledger.schema import SAMPLE_RECORD_SCHEMA, schema_from_spec

SAMPLE = schema_from_spec(SAMPLE_RECORD_SCHEMA)


def _wire(spark, hexes):
    rows = [(None if h is None else bytes.fromhex(h), "t", 0, i) for i, h in enumerate(hexes)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint")


def test_frame_cases(spark):
    # Fixture F2 cases.
    df = _wire(spark, ["00000000070441410B0201", "000000000700FEFFFFFF0F00", "0000000007", "00FFFFFFFF", "01000000070441", "00000000", "", None])
    got = check_frames(df).orderBy("offset").select(VERDICT, "_schema_id", F.hex("_payload").alias("p")).collect()
    assert [r[0] for r in got] == ["ok", "ok", "ok", "ok", "bad_magic", "too_short", "too_short", "null_value"]
    assert [r[1] for r in got] == [7, 7, 7, -1, None, None, None, None]
    assert got[0][2] == "0441410B0201" and got[2][2] == ""


def test_decode_fixture_bytes(spark):
    df = _wire(spark, ["00000000070441410B0201", "000000000700FEFFFFFF0F00", "0000000007", "00000000070441410B02", "00000000070441410B020100"])
    got = decode_payload(df, SAMPLE).orderBy("offset").collect()
    assert (got[0].string_column, got[0].numeric_column, got[0].boolean_column, got[0][VERDICT]) == ("AA", -6, True, "ok")
    assert (got[1].string_column, got[1].numeric_column, got[1].boolean_column) == ("", 2147483647, None)
    # empty payload, truncated datum, trailing byte
    assert [r[VERDICT] for r in got[2:]] == ["bad_payload"] * 3
    assert all(r.string_column is None for r in got[2:])


def test_encode_known_bytes(spark):
    df = spark.createDataFrame([("AA", -6, True), ("", 2147483647, None)], "string_column string, numeric_column int, boolean_column boolean")
    got = [r[0] for r in df.select(F.hex(frame.add_frame(encode_record(SAMPLE), 7))).collect()]
    assert got == ["00000000070441410B0201", "000000000700FEFFFFFF0F00"]
    neg = spark.range(1).select(F.hex(frame.add_frame(F.lit(b""), -2)).alias("h")).first()[0]
    assert neg == "00FFFFFFFE"


def test_strict_and_permissive(spark):
    df = _wire(spark, ["00000000070441410B0201", "01000000070441410B0201"])
    ok, bad = split_bad(decode_payload(df, SAMPLE))
    assert ok.count() == 1 and bad.count() == 1
    try:
        require_ok(decode_payload(df, SAMPLE)).collect()
    except Exception as exc:  # noqa: BLE001
        assert "bad record" in str(exc)
    else:
        raise AssertionError("strict mode accepted a bad record")


WIDE = schema_from_spec(
    {"type": "record", "name": "W", "fields": [
        {"name": "s", "type": ["null", "string"]},
        {"name": "i", "type": "int"},
        {"name": "l", "type": ["long", "null"]},
        {"name": "b", "type": "boolean"},
        {"name": "f", "type": "float"},
        {"name": "d", "type": ["null", "double"]},
    ]},
    codec_types=True,
)

rows = st.tuples(
    st.one_of(st.none(), st.text(max_size=40)),
    st.integers(-(2**31), 2**31 - 1),
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.booleans(),
    st.floats(width=32, allow_nan=False),
    st.one_of(st.none(), st.floats(allow_nan=False)),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(rows, min_size=1, max_size=40))
def test_roundtrip_property(spark, data):
    df = spark.createDataFrame(data, "s string, i int, l long, b boolean, f float, d double")
    enc = df.select(*[F.col(c).alias("o_" + c) for c in df.columns], encode_record(WIDE, {c: F.col(c) for c in df.columns}).alias("p"))
    dec = decode_columns(enc, WIDE, payload_col="p").collect()
    for r in dec:
        assert r._decode_ok
        for c in ["s", "i", "l", "b", "d"]:
            assert r[c] == r["o_" + c]
        assert r.f == r.o_f or (math.isinf(r.f) and r.f == r.o_f)


def test_value_must_be_binary_and_kafka_needs_servers(spark):
    import pytest

    from streamledger.sources.wire import read_wire

    with pytest.raises(TypeError):
        check_frames(spark.createDataFrame([("x",)], "value string"))
    with pytest.raises(ValueError):
        read_wire(spark, topics=["t"])  # neither a wire folder nor bootstrap servers


def test_kafka_branches_reach_the_kafka_source(spark):
    """No Kafka connector jar here: the branches are driven up to Spark's lookup of the
    'kafka' data source, which is where a cluster with the connector takes over."""
    import pytest

    from streamledger.sinks.wire import encode_wire, publish
    from streamledger.sources.wire import read_wire

    with pytest.raises(Exception, match="(?i)kafka"):
        read_wire(spark, topics=["t"], bootstrap_servers="broker:9092", streaming=False)
    with pytest.raises(Exception, match="(?i)kafka"):
        read_wire(spark, topics=["t"], bootstrap_servers="broker:9092", streaming=True)
    rows = spark.createDataFrame([("AA", 1, True)], "string_column string, numeric_column int, boolean_column boolean")
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(encode_wire(rows, SAMPLE, 7, topic="t"), bootstrap_servers="broker:9092")
