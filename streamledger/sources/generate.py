"""S1/S2 + L1: rows generated against a declared record schema.

Values follow the reference generator: a string field is ``A`` repeated ``string_bytes``
times (each string field, not the message), an int field is the sequence number from 1
(saturating at the 32-bit maximum), a boolean field is pseudo-random. Nullable fields are
never null. Unlike the reference (clock-seeded ``Random``), the boolean is a function of
(sequence, seed), so a replayed micro-batch yields identical rows.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.scalar import clamp_positive, random_boolean, saturating_int, sized_string, target_total
from ..schema import GENERATOR_TYPES, avro_type, schema_from_spec
from ..session import ship_package

SEQ = "seq"


def _schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else schema_from_spec(schema)


def record_columns(seq: Column, schema, string_bytes: int = 100, seed: int = 0) -> list[Column]:
    """One column per field, computed from a 1-based sequence column."""
    out = []
    for i, field in enumerate(_schema(schema).fields):
        atype = avro_type(field)
        if atype not in {a for a, _ in GENERATOR_TYPES.values()}:
            raise ValueError(f"no generator for fields of type {atype!r}")
        if atype == "string":
            value = sized_string(clamp_positive(string_bytes))
        elif atype == "int":
            value = saturating_int(seq)
        else:  # boolean: one independent stream per boolean field
            value = random_boolean(seq, seed + i)
        out.append(value.cast(field.dataType).alias(field.name))
    return out


def generate_from(seq_df: DataFrame, seq_col: str, schema, string_bytes: int = 100, seed: int = 0) -> DataFrame:
    """Rows for an existing 1-based sequence column (a projection: no shuffle)."""
    seq = F.col(seq_col).cast("long")
    return seq_df.select(seq.alias(SEQ), *record_columns(seq, schema, string_bytes, seed))


def generate_rows(
    spark: SparkSession, schema, n: int, string_bytes: int = 100, seed: int = 0, num_partitions: int | None = None
) -> DataFrame:
    """``n`` rows with sequence 1..n; ``spark.range`` splits them over the cluster."""
    seq = spark.range(1, int(n) + 1, numPartitions=num_partitions)
    return generate_from(seq, "id", schema, string_bytes, seed)


def bounded(df: DataFrame, target: int, seq_col: str = SEQ) -> DataFrame:
    """L1: never emit past the target (0 = unlimited). A filter on the sequence, not
    ``limit``: no shuffle and no dependence on row order."""
    return df if target <= 0 else df.where(F.col(seq_col) <= F.lit(int(target)))


class SequenceSource(DataSource):
    """A stream of the numbers 1 to ``total`` (column ``value``, from 0, as the rate source has
    it) that ends: offsets are numbers, so a replay gives the same rows, and after the last one
    there is nothing more. With ``rate`` and ``started`` (seconds since the epoch) as many are
    there as the rate has let out by now; without, all at once."""

    @classmethod
    def name(cls) -> str:
        return "streamledger_sequence"

    def schema(self) -> str:
        return "value long"

    def streamReader(self, schema: T.StructType) -> "SequenceReader":  # noqa: N802  (Spark's name)
        return SequenceReader(self.options)


class SequenceReader(DataSourceStreamReader):
    BATCH = 1 << 16

    def __init__(self, options: dict):
        self.total, self.slices = int(options["total"]), int(options.get("slices", 8))
        self.rate, self.started = int(options.get("rate", 0)), float(options.get("started", 0))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        out = self.total
        if self.rate:
            out = min(out, max(0, int((time.time() - self.started) * self.rate)))
        return {"next": out}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["next"], max(start["next"], end["next"])
        cuts = [lo + (hi - lo) * k // self.slices for k in range(self.slices + 1)]
        return [InputPartition((a, b)) for a, b in zip(cuts, cuts[1:]) if a < b]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        lo, hi = partition.value
        for a in range(lo, hi, self.BATCH):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, min(hi, a + self.BATCH), dtype=np.int64))], names=["value"])

    def commit(self, end: dict) -> None:
        pass


def bounded_stream(
    spark: SparkSession, schema, rows_per_second: int = 1, max_seconds: int = 5, string_bytes: int = 100, seed: int = 0,
    paced: bool = False, num_partitions: int = 8,
) -> DataFrame:
    """A generated stream of exactly rate x seconds rows that ends. Under ``availableNow``
    the query takes them and stops; with ``paced`` a continuous query gets them at the rate.
    Offsets are row numbers: a replayed micro-batch has the same rows."""
    rate = clamp_positive(rows_per_second)
    total = target_total(rate, max_seconds)
    if total <= 0:
        raise ValueError("a bounded stream needs seconds > 0")
    ship_package(spark)
    spark.dataSource.register(SequenceSource)
    reader = spark.readStream.format(SequenceSource.name()).option("total", total).option("slices", int(num_partitions))
    if paced:
        reader = reader.option("rate", rate).option("started", repr(time.time()))
    ticks = reader.load()
    return generate_from(ticks.withColumn("__seq", F.col("value") + 1), "__seq", schema, string_bytes, seed)


def generate_stream(
    spark: SparkSession,
    schema,
    rows_per_second: int = 1,
    max_seconds: int = 5,
    run_indefinitely: bool = False,
    string_bytes: int = 100,
    seed: int = 0,
    rows_per_batch: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A generated stream. ``rows_per_batch`` uses the deterministic
    ``rate-micro-batch`` source, otherwise ``rate`` paces by wall clock. Bounded streams
    stop emitting at rate x seconds (the query keeps running until stopped; ``bounded_stream``
    is one that ends)."""
    rate = clamp_positive(rows_per_second)
    if rows_per_batch:
        reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", int(rows_per_batch))
    else:
        reader = spark.readStream.format("rate").option("rowsPerSecond", rate)
    if num_partitions:
        reader = reader.option("numPartitions", int(num_partitions))
    ticks = reader.load()
    rows = generate_from(ticks.withColumn("__seq", F.col("value") + 1), "__seq", schema, string_bytes, seed)
    return bounded(rows, target_total(rate, max_seconds, run_indefinitely))
