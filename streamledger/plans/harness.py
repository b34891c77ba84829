"""The reference's end-to-end check as one Spark job: create the table, generate and
publish the target number of rows, ingest them, summarise progress and flush metrics,
snapshot at the durable LSN and reconcile counts and contents.

Every step is a library call; the summary is one small DataFrame. Nothing is collected
except scalars (the durable LSN and the reconcile verdicts).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..functions.frame import OK
from ..functions.scalar import progress_pct, target_total
from ..operators.decode import VERDICT, decode_payload
from ..operators.monitor import flush_latency, overall_progress, parse_batch_lines, parse_flush_lines
from ..operators.verify import reconcile, reconcile_content
from ..sources.logs import read_metric_log
from ..schema import schema_from_spec
from ..sinks import table as TB
from ..sinks.wire import encode_wire, publish
from ..sources.generate import bounded, generate_rows
from ..sources.wire import read_wire
from ..streaming.ingest import STRICT, durable_lsn, ingest


def integration_run(
    spark: SparkSession,
    record_schema,
    rows_per_second: int = 10,
    seconds: int = 60,
    string_bytes: int = 200,
    schema_id: int = 1,
    database: str = "harness",
    table: str = "records",
    topic: str = "records",
    partitions: int = 4,
    files_per_batch: int | None = None,
    drop_at_end: bool = False,
    recreate: bool = True,
    warehouse: str | None = None,
) -> DataFrame:
    """Run the cycle and return one summary row (the numbers the harness prints).

    The table lives under ``warehouse`` (default: a fresh folder under the checkpoint
    root); an unbounded run (``seconds <= 0``) is refused, as it would never finish."""
    schema = schema_from_spec(record_schema)
    expected = target_total(rows_per_second, seconds)
    if expected <= 0:
        raise ValueError("integration_run needs a bounded load (rows_per_second x seconds > 0)")
    root = S.scratch_path(spark, "harness")
    target = TB.ensure_table(
        spark, TB.target_for(spark, database, table, warehouse or f"{root}/warehouse"), schema, recreate=recreate
    )
    started = time.monotonic()

    rows = bounded(generate_rows(spark, schema, expected, string_bytes=string_bytes, num_partitions=partitions), expected)
    frames = encode_wire(rows, schema, schema_id)
    # Producer side: one Spark partition per topic partition, offsets dense from 0 in each
    # (the row index inside the partition, the low 33 bits of the monotonically increasing id).
    wire = frames.select(
        "key", "value", F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    wire_dir = f"{root}/wire"
    publish(wire, path=wire_dir)

    log_dir = f"{root}/sink-log"
    q = ingest(read_wire(spark, path=wire_dir, max_files_per_trigger=files_per_batch), target, schema,
               f"{root}/checkpoint", mode=STRICT, metrics_path=log_dir)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    run_s = max(1.0, time.monotonic() - started)

    # Monitor as the reference does: from the sink's metric lines.
    log = read_metric_log(spark, log_dir)
    progress = overall_progress(parse_batch_lines(log))
    flushes = flush_latency(parse_flush_lines(log))
    ledger = TB.read_ledger(spark, target)
    durable = durable_lsn(ledger).first().durable_lsn
    snap_started = time.monotonic()
    snapshot = TB.snapshot_at(spark, target, durable or 0, path=f"{root}/snapshot")
    snapshot_rows = snapshot.count()
    snapshot_s = time.monotonic() - snap_started
    counts = reconcile(expected, {"table": TB.read_table(spark, target), "location": TB.read_location(spark, target.data_path), "snapshot": snapshot})
    fields = [f.name for f in schema.fields]
    sent = decode_payload(read_wire(spark, path=wire_dir, streaming=False), schema).where(F.col(VERDICT) == F.lit(OK))
    content = reconcile_content(
        sent.select("topic", "partition", "offset", *fields),
        TB.read_table(spark, target).select(F.col("_topic").alias("topic"), F.col("_partition").alias("partition"), "_offset", *fields),
        table_offset="_offset",
        content=fields,
    )
    batches = ledger.select("batch_id").distinct().count()
    summary = progress.select(
        F.col("total_completed").alias("overall_rows"),
        F.col("highest_lsn"),
        F.lit(batches).cast("long").alias("batches"),
        F.lit(flushes.first().asDict()["flush_count"]).cast("long").alias("flush_count"),
    ).select(
        "*",
        F.lit(expected).cast("long").alias("expected_rows"),
        progress_pct(F.col("overall_rows"), F.lit(expected)).alias("progress_pct"),
        F.lit(round(run_s, 3)).alias("overall_duration_s"),
        (F.col("overall_rows") / F.lit(run_s)).alias("overall_rps"),
        F.lit(durable).cast("long").alias("durable_lsn"),
        F.lit(snapshot_rows).cast("long").alias("snapshot_rows"),
        F.lit(round(snapshot_s, 3)).alias("snapshot_duration_s"),
        F.lit(bool(counts.agg(F.min(F.col("matches").cast("int"))).first()[0])).alias("counts_match"),
        F.lit(bool(content.agg(F.min((F.col("checksum_match") & (F.col("duplicates") == 0)).cast("int"))).first()[0])).alias("contents_match"),
    )
    if drop_at_end:
        summary = spark.createDataFrame(summary.collect(), summary.schema)  # one row, kept before the drop
        TB.drop_table(spark, target)
    return summary


# The harness config sections and keys read here, and the harness's
# fallback load when a value is empty (60 msg/s for 10 s, 200-byte strings).
FALLBACK_RATE, FALLBACK_SECONDS, FALLBACK_BYTES = 60, 10, 200


def harness_options(config: dict | str) -> dict:
    """``integration_run`` arguments from a harness config (``source`` and ``table``
    sections: messages_per_second, message_size_bytes, max_duration_seconds,
    run_indefinitely, output_topic, partitions; database, name, avro_schema,
    should_recreate_on_start, drop_table_on_completion). Booleans are read as given."""
    import json

    cfg = json.loads(config) if isinstance(config, str) else dict(config)
    src, tbl = cfg.get("source", {}) or {}, cfg.get("table", {}) or {}

    def num(value, default):
        return default if value in (None, "") else int(value)

    if str(src.get("run_indefinitely", False)).lower() == "true":
        raise ValueError("run_indefinitely has no end: give max_duration_seconds instead")
    return {
        "record_schema": tbl["avro_schema"],
        "rows_per_second": num(src.get("messages_per_second"), FALLBACK_RATE),
        "seconds": num(src.get("max_duration_seconds"), FALLBACK_SECONDS),
        "string_bytes": num(src.get("message_size_bytes"), FALLBACK_BYTES),
        "topic": src.get("output_topic") or "source-1",
        "partitions": num(src.get("partitions"), 1),
        "database": tbl.get("database") or "harness",
        "table": tbl.get("name") or "records",
        "recreate": bool(tbl.get("should_recreate_on_start", True)),
        "drop_at_end": bool(tbl.get("drop_table_on_completion", False)),
    }
