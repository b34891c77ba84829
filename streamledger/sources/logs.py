"""Metric log lines from text files, batch or streaming.

Each line keeps its text; ``ts`` is parsed from a leading ISO-8601 instant when the log
has one (``docker compose logs -t`` style). ``arrival`` says where a line stands in the log:
when its file was last written, the file, the block of the file that a task reads and the
line's number in that task. So lines without an instant have an order, in a stream too, and
lines of one instant as well. ``line_no`` is a number for tie-breaks of a batch read (NULL in a
stream).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

# The timestamp prefix written and read by the log helpers.
TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
TS_PREFIX_REGEX = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z)\s"


def with_log_columns(lines: DataFrame, line: str = "value") -> DataFrame:
    prefix = F.regexp_extract(F.col(line), TS_PREFIX_REGEX, 1)
    line_no = F.lit(None).cast("long") if lines.isStreaming else F.monotonically_increasing_id()
    return lines.select(
        F.col(line).alias("line"),
        F.try_to_timestamp(F.when(prefix != "", prefix), F.lit(TS_PATTERN)).alias("ts"),
        line_no.alias("line_no"),
        *[c for c in lines.columns if c == "arrival"],
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task with their running number, in the order in which they are read."""
    n = 0
    for batch in batches:
        number = pa.array(range(n, n + batch.num_rows), pa.int64())
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, number], names=[*batch.schema.names, "number"])


def _with_arrival(lines: DataFrame) -> DataFrame:
    """``value`` and ``arrival`` of text lines. A stream knows no row number, so one is given
    as the lines pass through a task; a batch read has Spark's."""
    placed = lines.select(
        "value", F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    if lines.isStreaming:
        placed = placed.mapInArrow(_numbered, "value string, written timestamp, file string, block long, number long")
    else:
        placed = placed.withColumn("number", F.monotonically_increasing_id())
    return placed.select("value", F.struct("written", "file", "block", "number").alias("arrival"))


def read_metric_log(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the log files under ``path`` with ``line``, ``ts``, ``line_no`` and ``arrival``."""
    ship_package(spark)
    if streaming:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return with_log_columns(_with_arrival(reader.text(path)))
    return with_log_columns(_with_arrival(spark.read.text(path)))


def format_log_line(ts_ntz, text) -> F.Column:
    """``<UTC instant> <text>`` for a wall-clock (NTZ, read as UTC) time and a message."""
    return F.concat(F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z "), text)


def utc_instant(wall_clock) -> F.Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP instant, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall_clock))


def utc_wall_clock(instant) -> F.Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in UTC, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
