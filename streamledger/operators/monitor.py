"""Run monitoring from sink metric lines and probes.

The reference greps text logs with awk every few seconds. Here the log is a text source
(batch or stream), fields are pulled with ``regexp_extract`` on whitespace-separated
``key=value`` tokens, and the summaries are aggregates. Per-task state uses ``max_by``
(partial aggregation: no group is gathered in one place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The markers and formats of the sink's two metric lines.
BATCH_MARKER = "Sink task batch:"
FLUSH_MARKER = "Sink task flush done:"
BATCH_FORMAT = "Sink task batch: task_id=%s processed=%d total_completed=%d elapsed_ms=%.3f rps=%.2f last_lsn=%s"
FLUSH_FORMAT = "Sink task flush done: task_id=%s flushed_lsn=%s pruned_entries=%d elapsed_ms=%.3f offsets={%s}"


def _token(line: Column, key: str) -> Column:
    """Value of the whitespace token ``key=value`` (commas removed), NULL when absent or blank."""
    raw = F.regexp_extract(line, rf"(?:^|\s){key}=(\S*)", 1)
    raw = F.regexp_replace(raw, ",", "")
    return F.when(raw != "", raw)


def format_batch_lines(stats: DataFrame) -> DataFrame:
    """Render batch statistics as the sink's batch log line (``line`` column)."""
    line = F.format_string(
        BATCH_FORMAT,
        F.col("task_id").cast("string"),
        F.col("rows"),
        F.col("total_completed"),
        F.col("elapsed_ms").cast("double"),
        F.col("rps").cast("double"),
        F.coalesce(F.col("last_lsn").cast("string"), F.lit("")),
    )
    return stats.select(line.alias("line"), *[c for c in stats.columns])


def format_flush_lines(flushes: DataFrame) -> DataFrame:
    """Render flush records as the sink's flush log line (``line`` column); a missing
    flushed LSN prints as -1, the sink's "nothing to flush" value."""
    line = F.format_string(
        FLUSH_FORMAT,
        F.col("task_id").cast("string"),
        F.coalesce(F.col("flushed_lsn").cast("string"), F.lit("-1")),
        F.col("pruned_entries"),
        F.col("elapsed_ms").cast("double"),
        F.col("offsets"),
    )
    return flushes.select(line.alias("line"), *[c for c in flushes.columns])


def parse_batch_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Batch lines -> task_id, total_completed, last_lsn, processed, elapsed_ms, rps.
    Lines without the marker, or with an empty task_id or total, are dropped."""
    L = F.col(line)
    parsed = lines.where(L.contains(BATCH_MARKER)).withColumns(
        {
            "task_id": _token(L, "task_id"),
            "total_completed": _token(L, "total_completed").try_cast("long"),
            "last_lsn": _token(L, "last_lsn").try_cast("long"),
            "processed": _token(L, "processed").try_cast("long"),
            "elapsed_ms": _token(L, "elapsed_ms").try_cast("double"),
            "rps": _token(L, "rps").try_cast("double"),
        }
    )
    return parsed.where(F.col("task_id").isNotNull() & _token(L, "total_completed").isNotNull())


def parse_flush_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Flush lines -> task_id, flushed_lsn, pruned_entries, elapsed_ms. Lines without
    an elapsed time are dropped. ``offsets={...}`` holds spaces, so tokens are matched one
    by one instead of splitting the line into a map."""
    L = F.col(line)
    parsed = lines.where(L.contains(FLUSH_MARKER)).withColumns(
        {
            "task_id": _token(L, "task_id"),
            "flushed_lsn": _token(L, "flushed_lsn").try_cast("long"),
            "pruned_entries": _token(L, "pruned_entries").try_cast("long"),
            "elapsed_ms": _token(L, "elapsed_ms").try_cast("double"),
        }
    )
    return parsed.where(_token(L, "elapsed_ms").isNotNull())


def _arrival(metrics: DataFrame, order: tuple[str, ...] | None) -> tuple[str, ...]:
    """The instant of a line, then its place in the log (or its number, without files)."""
    return order or ("ts", "arrival" if "arrival" in metrics.columns else "line_no")


def latest_per_task(metrics: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """A3: the last line seen per task (later lines overwrite earlier ones), plus the
    highest LSN the task ever reported. Lines come by ``order``: by default by their instant
    and, where they have none or the same, as they were written."""
    order = _arrival(metrics, order)
    keep = [c for c in ("total_completed", "last_lsn") if c in metrics.columns]
    latest = F.max_by(F.struct(*keep), F.struct(*order)).alias("__last")
    return metrics.groupBy("task_id").agg(latest, F.max("last_lsn").alias("max_lsn")).select(
        "task_id", *[F.col(f"__last.{c}").alias(c) for c in keep], "max_lsn"
    )


def overall_progress(metrics: DataFrame, order: tuple[str, ...] | None = None) -> DataFrame:
    """A4: total completed = sum of the latest total per task; highest LSN = max seen."""
    return latest_per_task(metrics, order).agg(
        F.coalesce(F.sum("total_completed"), F.lit(0)).cast("long").alias("total_completed"),
        F.count(F.lit(1)).alias("tasks"),
        F.max("max_lsn").alias("highest_lsn"),
    )


def flush_latency(flushes: DataFrame, line: str = "line", line_no: str = "line_no") -> DataFrame:
    """A5: count, average and max flush time, and the line holding the max. The first of
    equal maxima wins; a max of 0 keeps no line (the reference compares with ``>`` from 0).
    Zeros when there are no flush lines. Each line counts once."""
    ms = F.col("elapsed_ms")
    return flushes.agg(
        F.count(ms).alias("flush_count"),
        F.coalesce(F.avg(ms), F.lit(0.0)).alias("flush_avg_ms"),
        F.coalesce(F.max(ms), F.lit(0.0)).alias("flush_max_ms"),
        F.max_by(F.when(ms > 0, F.col(line)), F.struct(ms, -F.col(line_no))).alias("flush_max_line"),
    )


#: Seconds of a bucket of probes, and buckets of a bucket above them.
PROBE_BUCKET, PROBE_FANOUT = 3600, 1024


def with_previous(df: DataFrame, order: str, value: Column, out: str, width: int, fanout: int = PROBE_FANOUT, levels: int = 4) -> DataFrame:
    """Add ``out``: ``value`` of the row before in ``order`` (a long, unique; NULL for the
    first). Rows are ranked in buckets of ``width``; the first row of a bucket gets the last row
    of the bucket before, which is found the same way among buckets of ``fanout`` buckets. So no
    window holds more than a bucket, until after ``levels`` there is one."""
    bucket, own, before, carried = (f"__wp{levels}_{x}" for x in ("bucket", "own", "before", "carried"))
    start = F.col(order) - F.pmod(F.col(order), F.lit(int(width)))
    rows = df.withColumns({bucket: (start / F.lit(int(width))).cast("long") if levels else F.lit(0).cast("long"), own: value})
    ranked = rows.withColumn(before, F.lag(own).over(Window.partitionBy(bucket).orderBy(order)))
    if levels == 0:
        return ranked.withColumnRenamed(before, out).drop(bucket, own)
    last = rows.groupBy(bucket).agg(F.max_by(own, order).alias("last"))
    carry = with_previous(last, bucket, F.col("last"), carried, fanout, fanout, levels - 1).select(bucket, carried)
    return ranked.join(carry, bucket, "left").withColumn(out, F.coalesce(before, carried)).drop(bucket, own, before, carried)


def _micros(df: DataFrame, ts: str) -> Column:
    """A number that grows with the time, whatever the session's zone."""
    at = F.col(ts)
    if not isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_micros(at.cast("timestamp"))
    days = F.datediff(at, F.lit("1970-01-01").cast("date")).cast("long")
    of_day = (F.hour(at) * 3600 + F.minute(at) * 60).cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
    return days * 86_400_000_000 + of_day


def probe_rates(probes: DataFrame, start_ts: Column | None = None, ts: str = "probe_ts", total: str = "total_completed") -> DataFrame:
    """Rows and rate between consecutive probes, ``dt`` at least 1 s. The first probe
    compares with (start, 0); start defaults to the first probe itself. Probes are ranked in
    buckets of an hour that pass on their last row, so no task gets all of them."""
    row = F.struct(F.col(ts).alias("ts"), F.col(total).alias("total"))
    seen = with_previous(probes.withColumn("__micros", _micros(probes, ts)), "__micros", row, "__prev", PROBE_BUCKET * 1_000_000)
    first = start_ts if start_ts is not None else F.col(ts)
    prev_ts = F.coalesce(F.col("__prev.ts"), first)
    dt = F.greatest(F.lit(1), (F.unix_timestamp(F.col(ts)) - F.unix_timestamp(prev_ts))).cast("long")
    delta = (F.col(total) - F.coalesce(F.col("__prev.total"), F.lit(0))).cast("long")
    return seen.select(
        F.col(ts), F.col(total), delta.alias("delta_rows"), dt.alias("window_s"), (delta / dt).alias("probe_rps")
    )


def overall_rate(rows: Column, seconds: Column) -> Column:
    """Overall rows per second, seconds at least 1."""
    return rows.cast("double") / F.greatest(F.lit(1), seconds.cast("long"))


def target_reached(probes: DataFrame, target: int | Column, ts: str = "probe_ts", total: str = "total_completed") -> DataFrame:
    """L2: the first probe at which the total reaches the target (one row, NULLs if never)."""
    tgt = F.lit(target) if isinstance(target, int) else target
    hit = F.min_by(F.struct(F.col(ts).alias("probe_ts"), F.col(total).alias("total_completed")), F.col(ts))
    return probes.where(F.col(total) >= tgt).agg(hit.alias("__hit")).select("__hit.*")


# The Connect status document shape the harness reads.
STATUS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "connector",
            T.StructType([T.StructField("state", T.StringType()), T.StructField("trace", T.StringType())]),
        ),
        T.StructField(
            "tasks",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.IntegerType()),
                        T.StructField("state", T.StringType()),
                        T.StructField("trace", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def health(status: DataFrame, json_col: str = "status_json") -> DataFrame:
    """Per status document, tasks not RUNNING (a missing state counts as not running),
    overall health (connector RUNNING and every task RUNNING; no tasks counts as all
    running), the connector's trace and the traces of the tasks not running."""
    doc = F.from_json(F.col(json_col), STATUS_SCHEMA)
    tasks = F.coalesce(doc["tasks"], F.array().cast(STATUS_SCHEMA["tasks"].dataType))
    bad = F.filter(tasks, lambda t: ~F.coalesce(t["state"] == "RUNNING", F.lit(False)))
    running = F.coalesce(doc["connector"]["state"] == "RUNNING", F.lit(False))
    return status.select(
        "*",
        doc["connector"]["state"].alias("connector_state"),
        doc["connector"]["trace"].alias("connector_trace"),
        F.size(bad).alias("tasks_not_running"),
        (running & F.forall(tasks, lambda t: F.coalesce(t["state"] == "RUNNING", F.lit(False)))).alias("healthy"),
        F.transform(F.filter(bad, lambda t: t["trace"].isNotNull()), lambda t: t["trace"]).alias("failed_traces"),
    )
