"""Query plans over the driver's ``events`` table, one per operator group.

``events`` plays the stream: topic ``events``, Kafka partition ``user_id % 4``, offset =
position in the partition by ``event_id`` (from 0). Records are encoded for real (Avro +
frame) and then damaged by rule, so the classifier runs on bytes:
``event_id % 97 = 0`` -> NULL value, ``% 89 = 0`` -> first byte 01, ``% 83 = 0`` -> cut to
4 bytes. Schema id 8 for ``user_id % 5 = 0``, else 7. The topic arrives in three parts by
``event_id``, one micro-batch each. Ingest-side plans write to fresh folders under the shared
checkpoint root.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..functions import frame
from ..functions.avro import encode_record
from ..functions.scalar import clamp_positive, progress_pct, qualified_name, table_uri, target_total, throughput
from ..operators import ledger as LG
from ..operators import monitor as M
from ..operators.decode import SCHEMA_ID, VERDICT, check_frames, decode_payload
from ..operators.sequence import assign_lsn, dense_number, running_totals, upsert_index
from ..operators.verify import reconcile, reconcile_content, reconcile_diff, reconcile_ranges
from ..schema import SAMPLE_RECORD_SCHEMA, schema_from_spec
from ..sinks import table as TB
from ..sinks.wire import publish
from ..sources.generate import bounded, bounded_stream, generate_from
from ..sources.logs import format_log_line, read_metric_log, utc_instant, utc_wall_clock
from ..sources.wire import WIRE_DDL, read_wire
from ..streaming.ingest import PERMISSIVE, STRICT, durable_lsn, ingest, ingest_batch
from ..streaming.sliding import sliding_metrics, sliding_to_table

# The record schema of the events wire, and its fault rules.
EVENT_RECORD = {
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_type", "type": "string"},
        {"name": "event_id", "type": "int"},
        {"name": "flag", "type": ["null", "boolean"], "default": None},
    ],
}
EVENT_SCHEMA = schema_from_spec(EVENT_RECORD)
TOPIC = "events"
PARTITIONS = 4
NULL_EVERY, MAGIC_EVERY, SHORT_EVERY = 97, 89, 83
REGISTERED_SCHEMA_ID = 7
#: Parts the topic arrives in, one micro-batch each, and files of a part (tasks that encode it).
WIRE_PARTS, PART_FILES = 3, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_wire(events: DataFrame, offsets: bool = True) -> DataFrame:
    """Events as Kafka-shaped wire records (see the module docstring). ``offsets=False``
    leaves the offset NULL and skips numbering, for consumers that only look at bytes."""
    rec = _records(events)
    if offsets:
        rec = dense_number(rec, ["partition"], "event_id", "offset", per_key=True, start=0)
    else:
        rec = rec.withColumn("offset", F.lit(None).cast("long"))
    return _encoded(rec)


def _records(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.when(F.col("event_id") % 7 != 0, F.col("value") > 50).alias("flag"),
    )


def _encoded(rec: DataFrame) -> DataFrame:
    datum = encode_record(
        EVENT_SCHEMA,
        {"event_type": F.col("event_type"), "event_id": F.col("event_id").cast("int"), "flag": F.col("flag")},
    )
    sid = F.when(F.col("user_id") % 5 == 0, F.lit(8)).otherwise(F.lit(REGISTERED_SCHEMA_ID))
    eid = F.col("event_id")
    # Faults are applied inside one expression so the encoder appears once in the plan.
    magic = F.when(eid % MAGIC_EVERY == 0, F.lit("01")).otherwise(F.lit(frame.MAGIC_HEX))
    header = F.unhex(F.concat(magic, frame.schema_id_hex(sid)))
    keep = F.when((eid % MAGIC_EVERY != 0) & (eid % SHORT_EVERY == 0), F.lit(4)).otherwise(F.lit(2**31 - 1))
    value = F.when(eid % NULL_EVERY == 0, F.lit(None).cast("binary")).otherwise(
        F.substring(F.concat(header, datum), F.lit(1), keep)
    )
    return rec.select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        utc_instant(F.col("ts")).alias("timestamp"),  # event time as UTC: no session-zone dependence
        F.lit(0).alias("timestampType"),
    )


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic: events encoded once (K2) and kept in the shared checkpoint folder, as a
    broker would keep them; consumers read it like a topic."""
    return spark.read.parquet(_wire_dir(spark, sf_dir))


# ----------------------------------------------------------------------------- frames, codec


def wire_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + P1 in one plan: encode every event, frame it, damage it, classify the bytes."""
    checked = check_frames(events_wire(table(spark, sf_dir, "events"), offsets=False))
    return checked.groupBy(F.col(VERDICT).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def decoded_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_payload(wire(spark, sf_dir), EVENT_SCHEMA)
    return d.where(F.col(VERDICT) == F.lit(frame.OK))


def wire_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_ok(spark, sf_dir).select(
        "topic", "partition", "offset", F.col(SCHEMA_ID).alias("schema_id"), "event_type", "event_id", "flag"
    )


def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over the events' sequence (event_id + 1): sample schema, 200-byte strings."""
    seq = table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("seq"))
    return generate_from(seq, "seq", SAMPLE_RECORD_SCHEMA, string_bytes=200, seed=0)


# ----------------------------------------------------------------------------- sequencing, index


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset -> LSN index: a projection of the ingested table (only these columns are
    read from Parquet), plus the event id and record time used by the metric plans."""
    t = TB.read_table(spark, _run_ingest(spark, sf_dir))
    return t.select(
        F.col("_topic").alias("topic"),
        F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"),
        F.col("_lsn").alias("lsn"),
        "event_id",
        F.col("_timestamp").alias("timestamp"),
    )


def lsn_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on its own: decode once, cut the lineage with a reliable checkpoint (in the
    shared checkpoint folder), then count and number from the checkpointed rows."""
    S.checkpoint_root(spark)
    ok = decoded_ok(spark, sf_dir).select("topic", "partition", "offset").checkpoint(eager=True)
    return assign_lsn(ok, base=0, out="lsn", reproducible=True).select("partition", "offset", "lsn")


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed position per partition: half of the last offset delivered."""
    w = wire(spark, sf_dir)
    return w.groupBy("topic", "partition").agg(F.floor(F.max("offset") / 2).cast("long").alias("upto"))


def flush_point_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LG.flush_point_by_partition(index(spark, sf_dir), commits(spark, sf_dir))


def flush_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 by the ledger: only batches that a commit cuts are read."""
    return TB.flush_point_of(spark, _run_ingest(spark, sf_dir), commits(spark, sf_dir))


def _pruned(spark: SparkSession, sf_dir: str):
    """J2 by the ledger: batches whose entries are all covered and durable aren't read."""
    target, com = _run_ingest(spark, sf_dir), commits(spark, sf_dir)
    flushed = TB.flush_point_of(spark, target, com).first()["flush_lsn"]
    return TB.prune_table_index(spark, target, com, flushed)


def index_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pruned(spark, sf_dir)[0].select("topic", "partition", "offset", "lsn")


def index_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pruned(spark, sf_dir)[1]


# ----------------------------------------------------------------------------- batch metrics, logs


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (task, batch) of sequenced records: task = event_id % 3, batch = event_id // 500."""
    idx = index(spark, sf_dir)
    return idx.groupBy(
        (F.col("event_id") % 3).alias("task_id"), F.floor(F.col("event_id") / 500).cast("long").alias("batch_id")
    ).agg(F.count(F.lit(1)).alias("rows"), F.max("lsn").alias("max_lsn"))


def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LG.batch_stats(batches(spark, sf_dir))


def _batch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch log lines rendered from the statistics; elapsed = rows x 0.25 ms."""
    stats = batch_stats(spark, sf_dir)
    elapsed = F.col("rows") * F.lit(0.25)
    stats = stats.withColumns({"elapsed_ms": elapsed, "rps": throughput(F.col("rows"), elapsed / 1000.0)})
    lines = M.format_batch_lines(stats)
    return lines.select("line", (F.col("batch_id") * 3 + F.col("task_id")).alias("line_no"), "batch_id")


def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse_batch_lines(_batch_lines(spark, sf_dir))
    return parsed.select("task_id", "processed", "total_completed", "elapsed_ms", "rps", "last_lsn")


def overall_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + P12: totals from the latest line per task; percent of the records on the wire."""
    parsed = M.parse_batch_lines(_batch_lines(spark, sf_dir))
    target = wire(spark, sf_dir).count()
    return M.overall_progress(parsed, order=("line_no",)).withColumn(
        "progress_pct", progress_pct(F.col("total_completed"), F.lit(target))
    )


def log_file_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + P11 + A3: batch lines written as a text log (UTC instant prefix, batch N at
    2024-01-01 + N minutes), read back as text and reduced to the last line per task."""
    path = S.scratch_path(spark, "sinklog")
    lines = _batch_lines(spark, sf_dir)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("batch_id").cast("int"))
    lines.select(format_log_line(at, F.concat(F.lit("INFO "), F.col("line"))).alias("value")).write.text(path)
    parsed = M.parse_batch_lines(read_metric_log(spark, path))
    return M.latest_per_task(parsed).select("task_id", "total_completed", "last_lsn")


def _flush_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flush log lines, one per (task, batch); elapsed = (batch % 7) x 1.5 + rows / 8 ms."""
    stats = batch_stats(spark, sf_dir).withColumns(
        {
            "elapsed_ms": (F.col("batch_id") % 7) * F.lit(1.5) + F.col("rows") / F.lit(8.0),
            "flushed_lsn": F.col("last_lsn"),
            "pruned_entries": F.col("rows"),
            "offsets": F.concat(F.lit("events-"), F.col("task_id").cast("string"), F.lit("="), F.col("total_completed").cast("string")),
        }
    )
    lines = M.format_flush_lines(stats)
    return lines.select("line", (F.col("batch_id") * 3 + F.col("task_id")).alias("line_no"))


def flush_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.flush_latency(M.parse_flush_lines(_flush_lines(spark, sf_dir)))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One probe per day: the running count of sequenced records by the end of the day."""
    day = F.date_trunc("day", utc_wall_clock(F.col("timestamp"))).cast("timestamp_ntz")
    per_day = index(spark, sf_dir).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    number = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")).cast("long")
    per_day = per_day.select("day", "n", number.alias("k"), F.lit("events").alias("series"))
    running = running_totals(per_day, ["series"], "k", sums={"total": "n"}, bucket_width=16)
    return running.select(
        (F.col("day") + F.expr("INTERVAL 1 DAY")).alias("probe_ts"), F.col("total").cast("long").alias("total_completed")
    )


def probe_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = probes(spark, sf_dir)
    start = p.agg((F.min("probe_ts") - F.expr("INTERVAL 1 DAY")).alias("at")).first()["at"]
    return M.probe_rates(p, start_ts=F.lit(str(start)).cast("timestamp_ntz"))


def target_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first probe at which half of the sequenced records are in."""
    p = probes(spark, sf_dir)
    target = index(spark, sf_dir).count() // 2
    return M.target_reached(p, target)


def sliding_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + T4 streaming: events written as a text log, read with ``readStream.text``,
    counted per 12 h window sliding by 5 h and event type in complete mode (watermark on
    the parsed instant), result kept in a table; window bounds as UTC wall clock."""
    log_dir, out, ck = (S.scratch_path(spark, n) for n in ("eventlog", "sliding", "ck-sliding"))
    ev = table(spark, sf_dir, "events")
    ev.select(format_log_line(F.col("ts"), F.concat(F.lit("event "), F.col("event_type"))).alias("value")).write.text(log_dir)
    lines = read_metric_log(spark, log_dir, streaming=True)
    parsed = lines.select("ts", F.regexp_extract("line", r"\sevent (\S+)$", 1).alias("event_type"))
    q = sliding_to_table(parsed, out, ck, ts="ts", keys=["event_type"], window="12 hours", slide="5 hours", watermark="1 day")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    res = spark.read.parquet(out)
    return res.select(
        utc_wall_clock(F.col("window_start")).alias("window_start"),
        utc_wall_clock(F.col("window_end")).alias("window_end"),
        "event_type",
        "n",
    )


#: Lateness that the append windows bear, and the share of early events that come last.
LATENESS_DAYS, LATE_EVERY = 1, 50


def sliding_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + T4 in append mode: the events' log in three files, one micro-batch each; every 50th
    event of the first third comes with the last file. A window is written once, when the
    watermark (a day behind) has passed it; what comes for it after the watermark of the batch
    before is dropped."""
    log_dir, out, ck = (S.scratch_path(spark, n) for n in ("eventlog", "sliding", "ck-sliding"))
    ev = _arriving(table(spark, sf_dir, "events"))
    text = format_log_line(F.col("ts"), F.concat(F.lit("event "), F.col("event_type"))).alias("value")
    for k in range(WIRE_PARTS):
        ev.where(F.col("part") == k).select(text).coalesce(1).write.mode("append").text(log_dir)
    lines = read_metric_log(spark, log_dir, streaming=True, max_files_per_trigger=1)
    parsed = lines.select("ts", F.regexp_extract("line", r"\sevent (\S+)$", 1).alias("event_type"))
    q = sliding_to_table(
        parsed, out, ck, ts="ts", keys=["event_type"], window="12 hours", slide="5 hours", watermark=f"{LATENESS_DAYS} day", mode="append"
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    res = spark.read.schema("window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, n BIGINT").parquet(out)
    return res.select(
        utc_wall_clock(F.col("window_start")).alias("window_start"),
        utc_wall_clock(F.col("window_end")).alias("window_end"),
        "event_type",
        "n",
    )


def _arriving(events: DataFrame) -> DataFrame:
    """The events with the ``part`` of the topic in which they come, the late ones last."""
    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.floor(F.col("event_id") * WIRE_PARTS / F.lit(int(last) + 1)).cast("int")
    late = (part == 0) & (F.col("event_id") % LATE_EVERY == 0)
    return events.withColumn("part", F.when(late, WIRE_PARTS - 1).otherwise(part))


def log_arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + A3 on lines without an instant: two files, of which the later one holds the earlier
    batches. The last line per task is the one written last, in a batch read (``via`` batch) and
    in a stream."""
    log_dir, out, ck = (S.scratch_path(spark, n) for n in ("bare-log", "latest", "ck-latest"))
    lines = _batch_lines(spark, sf_dir)
    half = lines.agg(F.max("batch_id")).first()[0] // 2
    for rows in (lines.where(F.col("batch_id") > half), lines.where(F.col("batch_id") <= half)):
        rows.select("line", "line_no").coalesce(1).sortWithinPartitions("line_no").select(F.col("line").alias("value")).write.mode("append").text(log_dir)
    latest = M.latest_per_task(M.parse_batch_lines(read_metric_log(spark, log_dir)))
    stream = M.latest_per_task(M.parse_batch_lines(read_metric_log(spark, log_dir, streaming=True, max_files_per_trigger=1)))

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.parquet(f"{out}/{batch_id}")

    stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    newest = max(int(n) for n in S.list_names(spark, out) if n.isdigit())
    both = latest.withColumn("via", F.lit("batch")).unionByName(spark.read.schema(latest.schema).parquet(f"{out}/{newest}").withColumn("via", F.lit("stream")))
    return both.select("via", "task_id", "total_completed", "last_lsn")


def generated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded stream of a tenth of the events a second for ten seconds, run by
    ``availableNow`` until it ends; then the last micro-batch once more, with the same rows."""
    rate = max(1, table(spark, sf_dir, "events").count() // 10)
    out, ck = S.scratch_path(spark, "generated"), S.scratch_path(spark, "ck-generated")
    stream = bounded_stream(spark, SAMPLE_RECORD_SCHEMA, rows_per_second=rate, max_seconds=10, string_bytes=20)

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def once() -> None:
        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    once()
    done = max(int(n) for n in S.list_names(spark, f"{ck}/commits") if n.isdigit())
    S.delete_path(spark, f"{ck}/commits/{done}")
    once()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(out)


def sliding_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return sliding_metrics(ev, ts="ts", keys=["event_type"], window="12 hours", slide="5 hours")


def task_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 over one status document per user: one task per event type the user has,
    FAILED for ``error`` with a trace, connector PAUSED when ``user_id % 11 = 0``.
    Documents are built from an aggregate (at most one task per event type)."""
    ev = table(spark, sf_dir, "events")
    per = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    per = per.select(
        "user_id",
        F.struct(
            F.col("event_type").alias("k"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("RUNNING").alias("state"),
            F.when(F.col("event_type") == "error", F.concat(F.lit("error events: "), F.col("n").cast("string"))).alias("trace"),
        ).alias("t"),
    )
    docs = per.groupBy("user_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    tasks = F.transform(
        F.col("ts"), lambda t, i: F.struct(i.alias("id"), t["state"].alias("state"), t["trace"].alias("trace"))
    )
    conn = F.struct(
        F.when(F.col("user_id") % 11 == 0, "PAUSED").otherwise("RUNNING").alias("state"),
        F.lit(None).cast("string").alias("trace"),
    )
    status = docs.select(
        "user_id",
        F.to_json(F.struct(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"), conn.alias("connector"), tasks.alias("tasks"))).alias("status_json"),
    )
    out = M.health(status)
    return out.select(
        "user_id", "connector_state", "tasks_not_running", "healthy", F.array_join("failed_traces", "; ").alias("failed_traces")
    )


def table_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 for one table per event type; the three location shapes of the harness."""
    ev = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    loc = (
        F.when(F.col("event_type").isin("click", "view"), F.lit("s3://lake/warehouse"))
        .when(F.col("event_type") == "error", F.lit("s3://lake/warehouse/"))
        .otherwise(F.concat(F.lit("s3://lake/warehouse/ingest/"), F.col("event_type")))
    )
    return ev.select(
        "event_type",
        qualified_name(F.lit("ingest"), F.col("event_type")).alias("qualified_name"),
        table_uri(loc, F.lit("ingest"), F.col("event_type")).alias("uri"),
        "rows",
    )


# ----------------------------------------------------------------------------- ingest (T1) and what reads it

_RUNS: dict[tuple[str, str, str], dict] = {}


def _wire_dir(spark: SparkSession, sf_dir: str) -> str:
    return _wire_run(spark, sf_dir)["path"]


def _wire_run(spark: SparkSession, sf_dir: str) -> dict:
    key = (spark.sparkContext.applicationId, sf_dir, "wire")
    if key not in _RUNS:
        path, numbered = S.scratch_path(spark, "wire"), S.scratch_path(spark, "numbered")
        events = table(spark, sf_dir, "events")
        # Narrow rows get their offsets first and are written by arrival; each part of the
        # topic is then encoded in offset ranges, a file each, which consumers can number in
        # place. A micro-batch takes the files of a part.
        last = events.agg(F.max("event_id")).first()[0] or 0
        part = F.floor(F.col("event_id") * WIRE_PARTS / F.lit(int(last) + 1)).cast("int")
        rec = dense_number(_records(events), ["partition"], "event_id", "offset", per_key=True, start=0)
        rec.withColumn("part", part).write.partitionBy("part").parquet(numbered)
        files = _publish_parts(spark, rec, numbered, path, PART_FILES)
        if len(set(files)) > 1:  # too few rows for as many ranges: one file each
            path = S.scratch_path(spark, "wire")
            files = _publish_parts(spark, rec, numbered, path, 1)
        _RUNS[key] = {"path": path, "files": files[0]}
    return _RUNS[key]


def _publish_parts(spark: SparkSession, rec: DataFrame, numbered: str, path: str, files: int) -> list[int]:
    """Encode and publish the parts of the topic one after the other; files of each."""
    out, before = [], 0
    for k in range(WIRE_PARTS):
        rows = spark.read.schema(rec.schema).parquet(f"{numbered}/part={k}")
        ranged = rows.repartitionByRange(files, "partition", "offset") if files > 1 else rows.coalesce(1)
        publish(_encoded(ranged.sortWithinPartitions("partition", "offset")), path=path)
        now = sum(n.endswith(".parquet") for n in S.list_names(spark, path))
        out.append(now - before)
        before = now
    return out


def read_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic as a stream, a part a micro-batch."""
    run = _wire_run(spark, sf_dir)
    return read_wire(spark, path=run["path"], max_files_per_trigger=run["files"])


def _ended(q) -> str | None:
    """Wait for a query; what ended it, if it failed."""
    try:
        q.awaitTermination()
    except StreamingQueryException as why:
        return str(why)
    return str(q.exception()) if q.exception() is not None else None


def _run_ingest(spark: SparkSession, sf_dir: str, run: str = "sink") -> TB.Target:
    """Ingest the wire folder with ``availableNow``, a part per micro-batch (permissive:
    faults are quarantined). Runs: ``replay`` drops the last commit marker and runs again;
    ``crash`` fails in the last batch when the batch is done but Spark's commit isn't,
    ``catalog`` between the batch's commit record and its catalog partition, and both run again;
    ``strict`` fails on the first bad record, with nothing committed, and then reads the good
    ones; ``again`` misses every fifth offset and then gets the whole topic as one batch."""
    key = (spark.sparkContext.applicationId, sf_dir, run)
    if key in _RUNS:
        return _RUNS[key]["target"]
    _wire_run(spark, sf_dir)
    target = TB.target_for(spark, "ingest", f"events_{run}", S.scratch_path(spark, "warehouse"))
    TB.ensure_table(spark, target, EVENT_SCHEMA, recreate=True)
    checkpoint = S.scratch_path(spark, "checkpoint")
    metrics = f"{target.location}/_sink_log"

    def fail_at_last(batch_id: int) -> None:
        if batch_id == WIRE_PARTS - 1:
            raise RuntimeError("crash of the last batch")

    def once(stream: DataFrame | None = None, mode: str = PERMISSIVE, **hooks) -> str | None:
        stream = read_parts(spark, sf_dir) if stream is None else stream
        return _ended(ingest(stream, target, EVENT_SCHEMA, checkpoint, mode=mode, metrics_path=metrics, **hooks))

    def failing(expected: str, problem: str | None) -> None:
        if problem is None or expected not in problem:
            raise RuntimeError(f"expected {expected!r}, got {problem}")

    if run in ("crash", "catalog"):
        hook = "on_durable" if run == "crash" else "on_committed"
        failing("crash of the last batch", once(**{hook: fail_at_last}))
        problem = once()
    elif run == "strict":
        failing("bad record", once(mode=STRICT))
        if TB.last_commit(spark, target) is not None:
            raise RuntimeError("a batch with a bad record was committed")
        problem = once(read_parts(spark, sf_dir).where(frame.frame_verdict("value") == F.lit(frame.OK)), STRICT)
    elif run == "again":
        problem = once(read_parts(spark, sf_dir).where("offset % 5 <> 4"))
    else:
        problem = once()
    if run == "replay" and problem is None:
        commits = sorted(int(n) for n in S.list_names(spark, f"{checkpoint}/commits") if n.isdigit())
        S.delete_path(spark, f"{checkpoint}/commits/{commits[-1]}")
        problem = once()
    elif run == "again" and problem is None:
        wire = spark.read.schema(WIRE_DDL).parquet(_wire_dir(spark, sf_dir))
        ingest_batch(wire, WIRE_PARTS, target, EVENT_SCHEMA, PERMISSIVE, metrics, checkpoint)
    if problem is not None:
        raise RuntimeError(problem)
    _RUNS[key] = {"target": target, "metrics": metrics}
    return target


def ingest_log_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + P11 + A3 on the ingest's own metric log: the last batch line per task (one
    task per topic partition) gives its total and highest LSN."""
    _run_ingest(spark, sf_dir)
    metrics = _RUNS[(spark.sparkContext.applicationId, sf_dir, "sink")]["metrics"]
    parsed = M.parse_batch_lines(read_metric_log(spark, metrics))
    return M.latest_per_task(parsed).select("task_id", "total_completed", "last_lsn")


def ingest_flush_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + A5 on the ingest's own flush lines: one per batch and partition, with the time that
    its commit took (which no SQL can know: only that it is there)."""
    _run_ingest(spark, sf_dir)
    metrics = _RUNS[(spark.sparkContext.applicationId, sf_dir, "sink")]["metrics"]
    flushes = M.parse_flush_lines(read_metric_log(spark, metrics))
    timed = M.flush_latency(flushes).select(
        "flush_count", ((F.col("flush_avg_ms") > 0) & (F.col("flush_max_ms") >= F.col("flush_avg_ms"))).alias("timed"),
        F.col("flush_max_line").contains(M.FLUSH_MARKER).alias("has_line"),
    )
    top = flushes.agg(F.max("flushed_lsn")).first()[0]
    return timed.withColumn("flushed_lsn", F.lit(top).cast("long"))


_TABLE_COLS = ["event_type", "event_id", "flag", "_topic", "_partition", "_offset", "_schema_id", "_lsn", "batch_id"]


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.read_table(spark, _run_ingest(spark, sf_dir)).select(*_TABLE_COLS)


def ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch delivered again: the table is unchanged."""
    return TB.read_table(spark, _run_ingest(spark, sf_dir, "replay")).select(*_TABLE_COLS)


def ingest_crash_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crash between the ledger write and Spark's commit, then a restart."""
    return TB.read_table(spark, _run_ingest(spark, sf_dir, "crash")).select(*_TABLE_COLS)


def ingest_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 strict over the good records; a bad one would fail the query."""
    return TB.read_table(spark, _run_ingest(spark, sf_dir, "strict")).select(*_TABLE_COLS)


def ingest_catalog_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + T2: a crash between a batch's commit record and its catalog partition, then a
    restart: the table by its name has every batch."""
    target = _run_ingest(spark, sf_dir, "catalog")
    return TB.read_by_name(spark, target.database, target.table).select(*_TABLE_COLS)


def ingest_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts come without every fifth offset, then the whole topic in a batch of another
    number: records that are committed already are found by the ledger's offset ranges and
    dropped, the others are new."""
    return TB.read_table(spark, _run_ingest(spark, sf_dir, "again")).select(*_TABLE_COLS)


def redelivered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of that run delivered anew and again, per partition."""
    led = TB.read_ledger(spark, _run_ingest(spark, sf_dir, "again"))
    return led.groupBy("batch_id").agg(
        F.sum("rows").alias("rows"), F.sum("quarantined").alias("quarantined"), F.sum("redelivered").alias("redelivered")
    )


def append_without_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the good records in three appends while Spark writes no success markers: a batch is
    committed by its record alone, so none is written over."""
    key = (spark.sparkContext.applicationId, sf_dir, "unmarked")
    if key not in _RUNS:
        target = TB.target_for(spark, "ingest", "events_unmarked", S.scratch_path(spark, "warehouse"))
        TB.ensure_table(spark, target, EVENT_SCHEMA, recreate=True)
        rows = decoded_ok(spark, sf_dir).select(
            *[f.name for f in EVENT_SCHEMA.fields], *[F.col(c).alias(f"_{c}") for c in ("topic", "partition", "offset")], SCHEMA_ID
        )
        marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
        spark.conf.set(marker, "false")
        try:
            for k in range(3):
                TB.append_rows(rows.where(F.col("event_id") % 3 == k), target)
        finally:
            spark.conf.unset(marker)
        _RUNS[key] = {"target": target}
    return TB.read_table(spark, _RUNS[key]["target"]).select(*_TABLE_COLS)


def ledger_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of an ingest whose older commit records are compacted to a Parquet table."""
    key = (spark.sparkContext.applicationId, sf_dir, "compacted")
    target = _run_ingest(spark, sf_dir, "compact")
    if key not in _RUNS:
        TB.compact_ledger(spark, target, keep=1)
        _RUNS[key] = {}
    led = TB.read_ledger(spark, target).select("batch_id", "partition", "rows", "quarantined", "min_offset", "max_offset", "min_lsn", "max_lsn")
    stored = TB.read_table(spark, target).groupBy("batch_id", F.col("_partition").alias("partition")).agg(F.count(F.lit(1)).alias("stored"))
    return led.join(stored, ["batch_id", "partition"])


def table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingested table through the catalog."""
    target = _run_ingest(spark, sf_dir)
    return TB.read_by_name(spark, target.database, target.table).select(*_TABLE_COLS)


def append_and_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + T1 on one table: the good records of two partitions by one append, then the others
    by a stream of three batches. Rows and LSN range per batch."""
    key = (spark.sparkContext.applicationId, sf_dir, "mixed")
    if key not in _RUNS:
        target = TB.target_for(spark, "ingest", "events_mixed", S.scratch_path(spark, "warehouse"))
        TB.ensure_table(spark, target, EVENT_SCHEMA, recreate=True)
        rows = decoded_ok(spark, sf_dir).where("partition < 2").select(
            "event_type", "event_id", "flag", *[F.col(c).alias(f"_{c}") for c in ("topic", "partition", "offset")]
        )
        TB.append_rows(rows, target)
        stream = read_parts(spark, sf_dir).where("partition >= 2")
        ingest(stream, target, EVENT_SCHEMA, S.scratch_path(spark, "checkpoint"), mode=PERMISSIVE).awaitTermination()
        _RUNS[key] = {"target": target}
    t = TB.read_table(spark, _RUNS[key]["target"])
    return t.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_lsn").alias("min_lsn"), F.max("_lsn").alias("max_lsn")
    )


def bounded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + P9 + P14: generated rows up to the target of a configured rate (half the events a
    second, cut to at least 1) over two seconds, or unlimited for no seconds."""
    events = table(spark, sf_dir, "events")
    n = events.count()
    rows = generate_from(events.select((F.col("event_id") + 1).alias("seq")), "seq", SAMPLE_RECORD_SCHEMA, string_bytes=0)
    out = None
    for name, rate, seconds in (("half", n // 4, 2), ("floor", -5, 3), ("unlimited", n, 0)):
        part = bounded(rows, target_total(clamp_positive(rate), seconds)).agg(
            F.count(F.lit(1)).alias("rows"), F.max("numeric_column").alias("last"), F.max(F.length("string_column")).alias("width")
        ).select(F.lit(name).alias("plan"), "rows", "last", "width")
        out = part if out is None else out.unionByName(part)
    return out


def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered entries are delivered again in batch 1 with new LSNs (base = the
    current count); the index keeps one entry per offset, the later one."""
    idx = index(spark, sf_dir).select("topic", "partition", "offset", "lsn", F.lit(0).cast("long").alias("batch_id"))
    total = idx.count()
    again = LG.covered_by(idx, commits(spark, sf_dir)).select(
        "topic", "partition", "offset", (F.col("lsn") + F.lit(total)).alias("lsn"), F.lit(1).cast("long").alias("batch_id")
    )
    return upsert_index(idx.unionByName(again))


def ledger_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over the real ingest ledger, one series per Kafka partition."""
    led = TB.read_ledger(spark, _run_ingest(spark, sf_dir))
    return LG.batch_stats(led.select("partition", "batch_id", "rows", "max_lsn"), task="partition")


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _run_ingest(spark, sf_dir)
    q = TB.read_quarantine(spark, target)
    return q.groupBy(F.col(VERDICT).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def snapshot_at_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 at the flush point of the ingested table."""
    target = _run_ingest(spark, sf_dir)
    flushed = TB.flush_point_of(spark, target, commits(spark, sf_dir)).first()["flush_lsn"]
    return TB.snapshot_at(spark, target, flushed).select(*_TABLE_COLS)


def table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _run_ingest(spark, sf_dir)
    return TB.table_status(spark, target).drop("location")


def durable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable_lsn(TB.read_ledger(spark, _run_ingest(spark, sf_dir)))


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expected = good records on the wire; readers = committed table, raw location, and a
    reader that has lost the first record of every partition."""
    target = _run_ingest(spark, sf_dir)
    expected = check_frames(wire(spark, sf_dir)).where(F.col(VERDICT) == frame.OK).agg(F.count(F.lit(1)).alias("expected"))
    rows = TB.read_table(spark, target)
    first = rows.groupBy("_topic", "_partition").agg(F.min("_offset").alias("_offset"))
    return reconcile(
        expected,
        {
            "table": rows,
            "location": TB.read_location(spark, target.data_path),
            "lossy": rows.join(first, ["_topic", "_partition", "_offset"], "left_anti"),
        },
    )


def reconcile_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good wire records vs the ingested table, per partition."""
    target = _run_ingest(spark, sf_dir)
    return reconcile_content(*_contents(spark, sf_dir, target), table_offset="_offset")


_CONTENT = ["event_type", "event_id", "flag", SCHEMA_ID]


def _contents(spark: SparkSession, sf_dir: str, target: TB.Target) -> tuple[DataFrame, DataFrame]:
    good = decoded_ok(spark, sf_dir).select("topic", "partition", "offset", *_CONTENT)
    tbl = TB.read_table(spark, target).select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"), "_offset", *_CONTENT
    )
    return good, tbl


def _damaged(good: DataFrame, tbl: DataFrame) -> DataFrame:
    first = tbl.groupBy("partition").agg(F.min("_offset").alias("__first"))
    marked = tbl.join(first, "partition").withColumn("__hit", F.col("_offset") == F.col("__first"))
    kept = marked.where(~(F.col("__hit") & (F.col("partition") == 0)))
    again = marked.where(F.col("__hit") & (F.col("partition") == 1))
    hit = F.col("__hit") & (F.col("partition") == 2)
    swap = F.col("flag").isNull() & (F.col("partition") == 3)
    damaged = kept.unionByName(again).withColumns(
        {
            "event_type": F.when(hit, F.lit("changed")).otherwise(F.col("event_type")),
            "flag": F.when(swap, F.lit(True)).otherwise(F.col("flag")),
            SCHEMA_ID: F.when(swap, F.lit(None).cast("int")).otherwise(F.col(SCHEMA_ID)),
        }
    )
    return damaged.select(*tbl.columns)


def reconcile_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 against a damaged copy of the table: partition 0 has lost its first row, partition 1
    has that row twice, in partition 2 its event type is changed, and in partition 3 flags and
    schema ids are exchanged for NULL where the flag is NULL."""
    good, tbl = _contents(spark, sf_dir, _run_ingest(spark, sf_dir))
    return reconcile_content(good, _damaged(good, tbl), table_offset="_offset")


def reconcile_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 row by row against that damaged copy, through trees of checksums."""
    good, tbl = _contents(spark, sf_dir, _run_ingest(spark, sf_dir))
    return reconcile_diff(good, _damaged(good, tbl), content=_CONTENT, table_offset="_offset", width=64)


def reconcile_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 by offset ranges against a copy that has lost long runs of partition 0, has runs of
    partition 1 twice and holds rows of partition 2 beyond the wire's end."""
    good, tbl = _contents(spark, sf_dir, _run_ingest(spark, sf_dir))
    tens = F.floor(F.col("_offset") / 10)
    kept = tbl.where((F.col("partition") != 0) | (tens % 7 > 2))
    again = tbl.where((F.col("partition") == 1) & (tens % 9 == 4))
    beyond = tbl.where((F.col("partition") == 2) & (F.col("_offset") < 25)).withColumn("_offset", F.col("_offset") + 10_000_000)
    return reconcile_ranges(good, kept.unionByName(again).unionByName(beyond), table_offset="_offset", width=64)


def schema_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + J3: register schema 7 for the table, flag frames by registration."""
    target = TB.target_for(spark, "ingest", "registry", S.scratch_path(spark, "warehouse"))
    TB.register_schema(spark, target, REGISTERED_SCHEMA_ID, EVENT_RECORD)
    frames = check_frames(wire(spark, sf_dir)).where(F.col(VERDICT) == frame.OK)
    flagged = TB.with_schema(frames, TB.read_registry(spark, target))
    return flagged.groupBy(F.col(SCHEMA_ID).alias("schema_id"), F.col("_schema_registered").alias("registered")).agg(
        F.count(F.lit(1)).alias("n")
    )
