from pyspark.sql import functions as F

from streamledger import session as S
from streamledger.plans.harness import integration_run
from streamledger.schema import SAMPLE_RECORD_SCHEMA, schema_from_spec
from streamledger.sinks import table as TB
from streamledger.sinks.wire import encode_wire, publish_stream
from streamledger.sources.generate import generate_stream
from streamledger.sources.wire import WIRE_DDL, read_wire
from streamledger.streaming.ingest import ingest


def test_integration_run_sample_config(spark):
    r = integration_run(spark, SAMPLE_RECORD_SCHEMA, rows_per_second=24, seconds=25, string_bytes=70, files_per_batch=2, drop_at_end=True).first()
    assert (r.expected_rows, r.overall_rows, r.highest_lsn, r.durable_lsn, r.snapshot_rows) == (600, 600, 600, 600, 600)
    assert r.progress_pct == 100 and r.counts_match and r.contents_match and r.batches == 2
    assert r.flush_count == 4  # one flush line per (batch, partition): each batch holds 2 of the 4 partitions


def test_generated_stream_published_and_ingested(spark):
    schema = schema_from_spec(SAMPLE_RECORD_SCHEMA)
    wire_dir, ck1, ck2 = (S.scratch_path(spark, n) for n in ("wire", "ck", "ck"))
    gen = generate_stream(spark, SAMPLE_RECORD_SCHEMA, rows_per_second=50, max_seconds=2, rows_per_batch=25, string_bytes=3)
    frames = encode_wire(gen, schema, 3, keep=["seq"]).select(
        "key", "value", F.lit("gen").alias("topic"), F.lit(0).alias("partition"),
        (F.col("seq") - 1).alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    q = publish_stream(frames, ck1, path=wire_dir, available_now=True)
    q.awaitTermination(120)
    published = spark.read.schema(WIRE_DDL).parquet(wire_dir)
    assert 0 < published.count() <= 100
    target = TB.ensure_table(spark, TB.target_for(spark, "gen", "t", S.scratch_path(spark, "wh")), schema)
    q = ingest(read_wire(spark, path=wire_dir), target, schema, ck2)
    q.awaitTermination(120)
    assert TB.read_table(spark, target).count() == published.count()


def test_harness_options_from_config():
    import pytest

    from streamledger.plans.harness import harness_options

    cfg = {
        "source": {"messages_per_second": 24, "message_size_bytes": 70, "run_indefinitely": False,
                   "max_duration_seconds": 25, "output_topic": "orders", "partitions": 3},
        "table": {"database": "shop", "name": "orders", "should_recreate_on_start": False,
                  "drop_table_on_completion": False, "avro_schema": SAMPLE_RECORD_SCHEMA},
    }
    o = harness_options(cfg)
    assert (o["rows_per_second"], o["seconds"], o["string_bytes"], o["recreate"], o["table"]) == (24, 25, 70, False, "orders")
    cfg["source"].update({"messages_per_second": "", "max_duration_seconds": None})
    o = harness_options(cfg)
    assert (o["rows_per_second"], o["seconds"]) == (60, 10)  # the harness fallback load
    cfg["source"]["run_indefinitely"] = True
    with pytest.raises(ValueError):
        harness_options(cfg)
