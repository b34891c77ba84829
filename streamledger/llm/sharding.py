"""Sharding by weighted rendezvous hashing, in DataFrame operations only.

Every (record key, shard) pair has a fixed hash; a record goes to the shard with the highest
score ``-weight / ln(u)``, u being that hash as a number in (0, 1). A shard's score never
depends on the other shards, so adding a shard moves only the records it wins, and changing
one weight moves records only to or from that shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Parts of a shard that are numbered independently; a part is one window group.
SLOT_PARTS = 1024


def rendezvous_shard(key: Column, weights: Sequence[float], salt: int = 0) -> Column:
    """Shard 0 ... len(weights) - 1 for a key column; shards of weight 0 get nothing.
    Ties of scores go to the lowest shard. A NULL key is a key like any other."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    scored = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            # 53 bits of the hash, in (0, 1): never 0 or 1, so the logarithm is finite
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(salt), F.lit(shard)), 11)
            u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
            scored.append(F.struct((F.lit(-float(weight)) / F.log(u)).alias("s"), F.lit(-shard).alias("i")))
    return (-(F.greatest(*scored) if len(scored) > 1 else scored[0])["i"]).cast("int")


def shard_documents(
    docs: DataFrame,
    n_shards: int = 24,
    weights: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    Law ``key``: the identifier and the shard weights alone decide. ``size``: UTF-8 bytes of
    the text (NULL: none) plus 8; ``text_crc32`` is that of an empty text when it is NULL.
    ``slot`` is gapless from 0 within a shard: each shard is cut into ``SLOT_PARTS`` hashed
    parts, a part starts where the parts before it end, and rows are numbered inside their
    part only, so no task holds a whole shard. Rows that repeat an identifier share the
    shard and get slots of their own. ``grown_shard``: the shard if one more of weight 1
    were added. An empty table gives an empty result; other columns are ignored.
    """
    weights = list(weights or [1.0] * n_shards)
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(
        docs.select(
            key.cast("long").alias("id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    ).select(
        "*",
        rendezvous_shard(F.col("id"), weights).alias("shard"),
        rendezvous_shard(F.col("id"), [*weights, 1.0]).alias("grown_shard"),
        F.pmod(F.xxhash64("row"), F.lit(SLOT_PARTS)).cast("int").alias("part"),
    )
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("id", "row")
    return (
        rows.withColumn("nth", F.row_number().over(inside))
        .join(starts, ["shard", "part"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
