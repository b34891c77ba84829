"""T4: sliding look-back over metric lines or events (e.g. last 12 s every 5 s)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.logs import utc_instant, utc_wall_clock


def sliding_metrics(
    df: DataFrame,
    ts: str = "ts",
    keys: Sequence[str] = (),
    window: str = "12 seconds",
    slide: str = "5 seconds",
    watermark: str | None = None,
    aggs: Sequence = (),
) -> DataFrame:
    """Counts (and extra ``aggs``) per sliding window and key; windows start at multiples
    of the slide since the epoch. A streaming input needs a TIMESTAMP column for the
    watermark: TIMESTAMP_NTZ is taken as UTC and the window bounds are given back so."""
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    src = df
    tcol = ts
    if df.isStreaming:
        if ntz:
            src = src.withColumn("__ts", utc_instant(F.col(ts)))
            tcol = "__ts"
        src = src.withWatermark(tcol, watermark or window)
    w = F.window(F.col(tcol), window, slide)
    out = src.groupBy(w.alias("__w"), *keys).agg(F.count(F.lit(1)).alias("n"), *aggs)
    start, end = F.col("__w.start"), F.col("__w.end")
    if ntz and df.isStreaming:
        start, end = utc_wall_clock(start), utc_wall_clock(end)
    return out.select(start.alias("window_start"), end.alias("window_end"), *[c for c in out.columns if c != "__w"])


def sliding_to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    keys: Sequence[str] = (),
    window: str = "12 seconds",
    slide: str = "5 seconds",
    watermark: str | None = None,
    available_now: bool = True,
    mode: str = "complete",
):
    """Run ``sliding_metrics`` on a stream into Parquet files under ``path``.

    ``append``: a window is written once, when the watermark has passed its end, and its state
    is dropped then; rows that come later for it are counted (see ``late_rows``), and no file
    is ever written again. ``complete``: state and result hold every window ever seen, and each
    micro-batch overwrites ``path``, which nobody should read meanwhile."""
    agg = sliding_metrics(stream, ts, keys, window, slide, watermark)
    writer = agg.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if mode == "append":
        writer = writer.format("parquet").option("path", path)
    else:

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        writer = writer.foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """What a query in append mode has dropped as later than the watermark, over the progress
    that Spark keeps. Spark counts after its partial aggregate: one for each window, key and
    task of a micro-batch that had such rows."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in _plain(p).get("stateOperators", []))


def _plain(progress) -> dict:
    return progress if isinstance(progress, dict) else json.loads(progress.json)
