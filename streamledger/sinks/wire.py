"""K2: encode typed rows as Avro, add the five-byte frame, publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.avro import encode_record
from ..functions.frame import add_frame


def encode_wire(
    df: DataFrame, schema: T.StructType, schema_id, topic: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows -> ``(key, value[, topic], *keep)``: null key, framed Avro value. ``schema_id``
    is an int or a column; no partition is chosen (the producer's partitioner decides)."""
    value = add_frame(encode_record(schema), schema_id)
    cols = [F.lit(None).cast("binary").alias("key"), value.alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    return df.select(*cols, *keep)


def publish(wire: DataFrame, bootstrap_servers: str | None = None, path: str | None = None, mode: str = "append") -> None:
    """Write framed records to Kafka, or to a Parquet wire folder (tests, replays)."""
    if path is not None:
        wire.write.mode(mode).parquet(path)
        return
    if wire.isStreaming:
        raise ValueError("use writeStream.format('kafka') for a streaming publish")
    wire.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save()


def publish_stream(
    wire_stream: DataFrame,
    checkpoint: str,
    bootstrap_servers: str | None = None,
    path: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
):
    """Streaming publish (the generator side): Kafka, or an append-only Parquet wire
    folder that the file source can read as a topic."""
    writer = wire_stream.writeStream.option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
