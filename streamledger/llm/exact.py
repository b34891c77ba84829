"""Exact deduplication: a tree merge of sorted digest runs, in DataFrame operations only.

Each input partition is a run: its rows reduced to one entry per digest, holding the
identifier that stays and a count. Runs are merged ``fan_in`` at a time, level by level
(binomial rounds): the runs ``k * fan_in ... (k + 1) * fan_in - 1`` exchange their entries
by (merged run, digest) and an entry keeps the best identifier of its parts. A key of any
merge has at most ``fan_in`` entries, however many copies a text has, so no task grows with
a group of copies. The verdict then goes down the same tree, level by level, to the rows.

Entries are verified at every level: two entries only merge when SHA-256, byte length and an
independent 64-bit hash all agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, materialise

_KEY = ["__digest", "__bytes", "__check"]


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 8
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` ("min" or "max") names the identifier of a group that stays. NULL texts count
    as empty; empty texts are equal to each other. A NULL identifier is the smallest. Rows
    that repeat an identifier and a text: one of them is kept. Other columns are ignored.
    An empty table gives an empty result.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    best = F.min if keep == "min" else F.max
    text = F.col("__text")
    rows = materialise(
        doc_columns(docs, id_col, text_col).select(
            F.struct(F.col("__id").alias("id"), F.monotonically_increasing_id().alias("row")).alias("__who"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("__digest"),
            F.octet_length(text).alias("__bytes"),
            F.xxhash64(text).alias("__check"),
            F.spark_partition_id().alias("__run"),
        ),
        "digests",
    )
    runs = (rows.agg(F.max("__run")).first()[0] or 0) + 1
    entry = [best("__best").alias("__best"), F.sum("__n").alias("__n")]
    levels = [
        materialise(
            rows.groupBy("__run", *_KEY)
            .agg(best("__who").alias("__best"), F.count(F.lit(1)).alias("__n"))
            .sortWithinPartitions("__run", *_KEY),
            "runs",
        )
    ]
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = levels[-1].withColumn("__run", F.floor(F.col("__run") / fan_in).cast("int"))
        levels.append(
            materialise(merged.groupBy("__run", *_KEY).agg(*entry).sortWithinPartitions("__run", *_KEY), "runs")
        )
    verdict = levels[-1]
    for level in reversed(levels[:-1]):
        verdict = (
            level.select("__run", *_KEY)
            .withColumn("__up", F.floor(F.col("__run") / fan_in).cast("int"))
            .join(verdict.withColumnRenamed("__run", "__up"), ["__up", *_KEY])
            .drop("__up")
        )
    return rows.join(verdict, ["__run", *_KEY]).select(
        F.col("__who.id").alias(id_col),
        F.col("__best.id").alias("keep_id"),
        F.col("__n").alias("group_size"),
        (F.col("__who") == F.col("__best")).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )
