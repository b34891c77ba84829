"""The ingest loop as a Structured Streaming query.

Each micro-batch: check frames, decode, apply the bad-record policy, drop records that are
committed already, number the good rows with dense LSNs in (topic, partition, offset) order,
write them and create the batch's commit record (the table protocol of
``sinks.table.append_rows``). Spark records ``commits/N`` in the checkpoint only after
``foreachBatch`` returns, so the record is the durability barrier (T2). A replayed batch whose
record exists is left as it is; one without is written again with the same LSNs, because its
base is the high-water mark of the record before. Records that come again in a batch of another
number are found by their offsets (T3). The checkpoint's path is the writer's name.

A batch costs the same however many came before: one job that decodes and measures it, one
write, one more for quarantined records if there are any, and the record.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import session as S
from ..functions import frame
from ..operators.decode import SCHEMA_ID, VERDICT, decode_payload, require_ok
from ..operators.monitor import BATCH_FORMAT, FLUSH_FORMAT
from ..operators.sequence import InPlace, plan_in_place
from ..operators.verify import reconcile_content
from ..sinks import table as TB
from ..sinks.table import Target

STRICT, PERMISSIVE = "strict", "permissive"


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    target: Target,
    schema: T.StructType,
    mode: str = STRICT,
    metrics_path: str | None = None,
    writer: str = "stream",
    on_committed: Callable[[int], None] | None = None,
) -> None:
    """Process one micro-batch (also usable on a static DataFrame): batch ``batch_id`` of
    ``writer``. Records whose offsets a committed batch holds are dropped (a batch itself holds
    no offset twice, as with Kafka). With ``metrics_path`` the batch's metric lines are written
    there too (see ``write_metric_lines``)."""
    spark = batch.sparkSession
    started = time.monotonic()
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"mode must be '{STRICT}' or '{PERMISSIVE}'")
    last = TB.last_commit(spark, target)
    done = TB.batch_of(spark, target, writer, batch_id, last)
    if done is not None:  # durable already: the crash was after the commit
        TB.append_rows(batch, target, batch_id, writer=writer, last=last)  # its catalog partition
        if metrics_path and S.path_exists(spark, target.commit_path(done)):  # else compacted long ago
            write_metric_lines(spark, target, done, metrics_path, 0.0, 0.0)
        return
    decoded = decode_payload(batch, schema)
    if mode == STRICT:
        decoded = require_ok(decoded)
    # Decoding runs in Python; its result is kept for the passes (measuring, then writing).
    kept = [decoded.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        rows, bad, plan = _measured(decoded, schema)
        known = {(t, p): top for t, p, _n, top, _lsn in (last or {}).get("totals", [])}
        ranges = _offset_ranges(plan)
        again: dict[tuple, int] = {}
        if any(lo <= known.get((t, p), -1) for t, p, lo, _hi, _n in ranges):
            plan.close()
            fresh = TB.without_delivered(spark, target, decoded, [r[:4] for r in ranges])
            kept.append(fresh.persist(StorageLevel.MEMORY_AND_DISK))
            rows, bad, plan = _measured(fresh, schema)
            left = {(t, p): n for t, p, _lo, _hi, n in _offset_ranges(plan)}
            again = {(t, p): n - left.get((t, p), 0) for t, p, _lo, _hi, n in ranges}
        kept.append(plan.summary)
        # K1 + W3 + record; the persisted batch reads back identically, so LSNs are numbered
        # in place when the batch's partitions are disjoint offset ranges.
        wrote = TB.append_rows(
            rows, target, batch_id, reproducible=True, started=started, writer=writer, quarantine=bad,
            plan=plan, bad_ranges=plan.extra, redelivered=again, last=last, on_committed=on_committed,
        )
    finally:
        for frame_ in kept:
            frame_.unpersist()
    if metrics_path:
        write_metric_lines(spark, target, wrote["batch_id"], metrics_path, wrote["write_s"], wrote["flush_s"])


def _measured(decoded: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame, InPlace]:
    """(good rows, bad records, their ranges per topic partition), measured in one job."""
    rows = decoded.where(F.col(VERDICT) == F.lit(frame.OK)).select(
        *[F.col(f.name) for f in schema.fields],
        F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
        F.col(SCHEMA_ID).alias("_schema_id"),
        F.col("timestamp").alias("_timestamp"),
    )
    bad = decoded.where(F.col(VERDICT) != F.lit(frame.OK)).select("key", "value", "topic", "partition", "offset", "timestamp", VERDICT)
    bad_ranges = bad.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))
    return rows, bad, plan_in_place(rows, ["_topic", "_partition"], "_offset", bad_ranges)


def _offset_ranges(plan: InPlace) -> list[tuple]:
    """(topic, partition, first offset, last offset, records) over good and bad records."""
    out: dict[tuple, list[int]] = {}
    for r in [*plan.ranges, *plan.extra]:
        lo, hi, n = out.get((r["_topic"], r["_partition"]), (r["lo"], r["hi"], 0))
        out[r["_topic"], r["_partition"]] = [min(lo, r["lo"]), max(hi, r["hi"]), n + r["n"]]
    return [(*k, *v) for k, v in out.items()]


def write_metric_lines(
    spark: SparkSession, target: Target, batch_id: int, path: str, batch_s: float, flush_s: float
) -> None:
    """The sink's two log lines per (topic, partition) of batch N, as one text file under
    ``path/batch_id=N`` (written once): a batch line with rows, running total and running max
    LSN (W1) and a flush line with the durable LSN and the next offset to commit, all as the
    batch's commit record has them. Each line starts with the UTC instant."""
    lines = TB.read_record(spark, target, batch_id)
    head, ranges = lines[0], lines[1:]
    totals = {(t, p): (n, top, lsn) for t, p, n, top, lsn in head["totals"]}
    at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"
    out, flushes = [], []
    for r in sorted(ranges, key=lambda r: (str(r["topic"]), r["partition"] or 0)):
        task = f"{r['topic']}-{r['partition']}"
        total, _top, lsn = totals[r["topic"], r["partition"]]
        rate = round(r["rows"] / max(0.001, batch_s), 2)
        out.append(f"{at} " + BATCH_FORMAT % (task, r["rows"], total, batch_s * 1000.0, rate, "" if lsn is None else lsn))
        flushes.append(f"{at} " + FLUSH_FORMAT % (task, head["high_lsn"], r["rows"], flush_s * 1000.0, f"{task}={r['max_offset'] + 1}"))
    S.create_once(spark, f"{path}/batch_id={int(batch_id)}/lines.txt", "".join(f"{x}\n" for x in out + flushes))


def _checkpoint_is_new(spark: SparkSession, checkpoint: str) -> bool:
    return not S.list_names(spark, f"{checkpoint}/offsets")


def ingest(
    wire_stream: DataFrame,
    target: Target,
    schema: T.StructType,
    checkpoint: str,
    mode: str = STRICT,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    metrics_path: str | None = None,
    on_durable: Callable[[int], None] | None = None,
    on_committed: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the ingest query. Refuses a fresh checkpoint on a table that a stream has
    written before: it would deliver the same records a second time. ``on_durable`` is called
    with each batch's number when the batch is done, ``on_committed`` with the table's number
    between the commit record and the catalog."""
    spark = wire_stream.sparkSession
    last = TB.last_commit(spark, target)
    if _checkpoint_is_new(spark, checkpoint) and last is not None and set(last["writers"]) - {"append"}:
        raise RuntimeError(f"{target.name} already has batches of a stream; reuse its checkpoint")

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, target, schema, mode, metrics_path, checkpoint.rstrip("/"), on_committed)
        if on_durable is not None:
            on_durable(batch_id)

    writer = wire_stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def durable_lsn(ledger: DataFrame) -> DataFrame:
    """The highest LSN whose batch is committed (NULL when nothing is durable)."""
    return ledger.agg(F.max("max_lsn").alias("durable_lsn"), F.count_distinct("batch_id").alias("batches"))


def replay_report(wire: DataFrame, table: DataFrame, content: list[str] | None = None) -> DataFrame:
    """Per partition, compare the delivered records with the table (duplicates, gaps,
    checksum) over the offsets the table covers: those up to its highest one."""
    ends = table.groupBy(F.col("_topic").alias("__t"), F.col("_partition").alias("__p")).agg(F.max("_offset").alias("__end"))
    covered = (F.col("topic") == F.col("__t")) & (F.col("partition") == F.col("__p")) & (F.col("offset") <= F.col("__end"))
    return reconcile_content(
        wire.join(ends, covered, "left_semi"), table.withColumnRenamed("_topic", "topic").withColumnRenamed("_partition", "partition"),
        keys=("topic", "partition"), offset="offset", table_offset="_offset", content=content,
    )
