"""S3: framed records with their coordinates, from Kafka or from a Parquet wire folder.

The wire schema is Spark's Kafka source schema, so code downstream does not care where
the records came from. The Kafka connector is not in this image; that branch is untested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WIRE_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)


def read_wire(
    spark: SparkSession,
    topics: list[str] | None = None,
    path: str | None = None,
    streaming: bool = True,
    bootstrap_servers: str | None = None,
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int = 5_000_000,
    options: dict | None = None,
) -> DataFrame:
    """Read wire records. ``path`` = Parquet folder with the wire schema; else Kafka, from the
    earliest offset unless ``options`` say otherwise. A streaming read takes at most
    ``max_files_per_trigger`` files or ``max_offsets_per_trigger`` records a batch."""
    options = dict(options or {})
    if path is not None:
        if streaming:
            reader = spark.readStream.schema(WIRE_DDL)
            if max_files_per_trigger:
                reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
            df = reader.options(**options).parquet(path)
        else:
            df = spark.read.schema(WIRE_DDL).options(**options).parquet(path)
        if topics:
            df = df.where(df.topic.isin(list(topics)))
        return df
    if not topics or not bootstrap_servers:
        raise ValueError("Kafka needs topics and bootstrap_servers (or give a wire path)")
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    reader = reader.option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
    if streaming:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    reader = reader.options(**options)
    return reader.load().selectExpr(
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType"
    )
