"""Dense sequence numbers without a global sort or a per-key single task.

``dense_number`` numbers rows 1, 2, 3 ... in ``(keys..., order)`` order, either per key
or across all keys. Rows are bucketed by ``order // bucket_width``; one small table of
bucket counts (one row per non-empty (key, bucket)) gives each bucket its starting
number by prefix sums, and ``row_number`` runs inside a bucket only, so a hot key with a
third of all rows is spread over many tasks. The bucket table is joined back by
equi-join and AQE chooses broadcast or sort-merge from its measured size.

Used for Kafka-style offsets (W3 ``assign_lsn``) and for the per-partition offsets of
the events wire fixture. ``order`` must be integral and unique within a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 16


def _surrogate_keys(df: DataFrame, cols: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for possibly-NULL columns, in the same order with NULLs first:
    per column a flag (false for NULL) and the value with NULL replaced by a typed zero.
    Grouping, windows and equi-joins all use these plain columns, so rows with NULL keys
    are kept and one hash partitioning serves the window and the join."""
    out, names = {}, []
    for i, c in enumerate(cols):
        dtype = df.schema[c].dataType
        zero = F.lit("1970-01-01") if dtype.typeName() in ("date", "timestamp", "timestamp_ntz") else F.lit(
            "" if dtype.typeName() == "string" else 0
        )
        if dtype.typeName() == "binary":
            zero = F.lit(b"")
        if dtype.typeName() == "boolean":
            zero = F.lit(False)
        out[f"{prefix}n{i}"] = F.col(c).isNotNull()
        out[f"{prefix}v{i}"] = F.coalesce(F.col(c), zero.cast(dtype))
        names += [f"{prefix}n{i}", f"{prefix}v{i}"]
    return df.withColumns(out), names


def dense_number(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    per_key: bool = True,
    start: int = 1,
    base=None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> DataFrame:
    """Add ``out``: dense number in ``(keys, order)`` (NULLs first); ``base`` (column or
    int) is added. The data is shuffled once, by (key, bucket): the in-bucket window and
    the join with the bucket starts share that partitioning."""
    bkt = "__seq_bucket"
    tagged = df.withColumn(bkt, F.floor(F.col(order) / F.lit(bucket_width)).cast("long"))
    tagged, kcols = _surrogate_keys(tagged, [*keys, bkt], "__seq_k")
    key_cols, bkt_cols = kcols[:-2], kcols[-2:]
    counts = tagged.groupBy(*kcols).agg(F.count(F.lit(1)).alias("__seq_n"))
    # Prefix over a key's buckets: the bucket table has rows / bucket_width rows per key,
    # so it is itself prefixed by bucketed running sums (no window holds a whole key).
    # A NULL position's bucket sorts first: its flag is false, so it maps below all others.
    ord_col = F.when(F.col(bkt_cols[0]), F.col(bkt_cols[1])).otherwise(F.lit(-(2**63)))
    starts = running_totals(
        counts.withColumn("__seq_ord", ord_col), key_cols, "__seq_ord", sums={"__seq_cum": "__seq_n"},
        bucket_width=bucket_width,
    ).withColumn("__seq_before", F.col("__seq_cum") - F.col("__seq_n"))
    if not per_key:
        # One row per key: its starting number across keys, by a prefix sum in key order.
        totals = counts.groupBy(*key_cols).agg(F.sum("__seq_n").alias("__seq_key_n"))
        all_keys = Window.orderBy(*key_cols).rowsBetween(Window.unboundedPreceding, -1)
        key_starts = totals.select(
            *key_cols, F.coalesce(F.sum("__seq_key_n").over(all_keys), F.lit(0)).alias("__seq_key_before")
        )
        starts = starts.join(key_starts, key_cols).withColumn(
            "__seq_before", F.col("__seq_before") + F.col("__seq_key_before")
        )
    starts = starts.select(*kcols, "__seq_before")
    in_bucket = Window.partitionBy(*kcols).orderBy(order)
    ranked = tagged.withColumn("__seq_rn", F.row_number().over(in_bucket))
    numbered = ranked.join(starts, kcols).withColumn(
        out, (F.col("__seq_before") + F.col("__seq_rn") + F.lit(start - 1)).cast("long")
    )
    if base is not None:
        numbered = numbered.withColumn(out, F.col(out) + (F.lit(base) if isinstance(base, int) else base))
    return numbered.drop(bkt, "__seq_before", "__seq_rn", *kcols)


_ROW_BITS = 33  # monotonically_increasing_id: partition id above, row index in the low 33 bits


@dataclass
class InPlace:
    """Rows sorted inside their input partitions, with one summary row per (partition, key):
    what numbering without a shuffle needs. ``ranges`` has per key its rows ``n`` and its first
    and last position ``lo`` and ``hi``; ``disjoint`` says that a key's partitions hold ranges
    one after the other and no position is NULL. ``extra`` are the rows of the frame measured
    along with it. The summary is kept until ``close``, so check and numbering read it once."""

    keys: list[str]
    order: str
    local: DataFrame
    summary: DataFrame
    ranges: list[Row]
    disjoint: bool
    extra: list[Row]

    def number(self, out: str, base: int = 0, per_key: bool = False, start: int = 1) -> DataFrame:
        """A row's number is the count of rows before its partition's range (in all keys, or in
        its own with ``per_key``) plus its index in that range."""
        keys = self.keys
        earlier = Window.partitionBy(*keys).orderBy("__lo").rowsBetween(Window.unboundedPreceding, -1)
        starts = self.summary.select("__pid", *keys, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
        if not per_key:
            totals = self.summary.groupBy(*keys).agg(F.sum("__n").alias("__key_n"))
            before_key = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)  # one row per key
            key_starts = totals.select(*keys, F.coalesce(F.sum("__key_n").over(before_key), F.lit(0)).alias("__key_before"))
            starts = starts.join(key_starts, keys).withColumn("__before", F.col("__before") + F.col("__key_before"))
        starts = starts.select(F.col("__pid").alias("__s_pid"), *[F.col(c).alias(f"__s_{c}") for c in keys], "__first", "__before")
        cond = [_input_partition() == F.col("__s_pid")] + [F.col(c) == F.col(f"__s_{c}") for c in keys]
        numbered = self.local.join(starts, cond).select(
            *self.local.columns,
            (F.col("__before") + (F.col("__rid") - F.col("__first")) + F.lit(int(base) + start)).cast("long").alias(out),
        )
        return numbered.drop("__rid")

    def close(self) -> None:
        self.summary.unpersist()


def _input_partition():
    return F.shiftright(F.col("__rid"), _ROW_BITS)


def plan_in_place(df: DataFrame, keys: Sequence[str], order: str, extra: DataFrame | None = None) -> InPlace:
    """Measure ``df`` for numbering in place (see ``InPlace``), in one job. ``extra`` has the
    columns ``(*keys, n, lo, hi)``, by position, and is measured in the same job."""
    keys = list(keys)
    cols = [*keys, order]
    local = df.sortWithinPartitions(*cols).withColumn("__rid", F.monotonically_increasing_id())
    summary = local.groupBy(_input_partition().alias("__pid"), *keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__rid").alias("__first"),
        F.min(F.struct(*cols)).alias("__lo"),
        F.max(F.struct(*cols)).alias("__hi"),
    )
    summary = summary.persist()
    # Ranges of one key, in order: each must end before the next begins. A key has one range
    # per input partition that holds it, and every key one row in the table of key totals.
    follows = F.lag("__hi").over(Window.partitionBy(*keys).orderBy("__lo"))
    missing = [F.col(f"__{e}.`{c}`").isNull() for e in ("lo", "hi") for c in cols]  # NULLs have no place in the order
    bad = reduce(lambda x, y: x | y, [F.coalesce(F.col("__prev") >= F.col("__lo"), F.lit(False)), *missing])
    measured = summary.select("*", follows.alias("__prev")).groupBy(*keys).agg(
        F.sum("__n").alias("n"),
        F.min(f"__lo.{order}").alias("lo"),
        F.max(f"__hi.{order}").alias("hi"),
        F.max(bad.cast("int")).alias("bad"),
    )
    measured = measured.withColumn("of", F.lit(0))
    if extra is not None:
        more = extra.toDF(*keys, "n", "lo", "hi")
        measured = measured.unionByName(more.withColumns({"bad": F.lit(0), "of": F.lit(1)}))
    found = measured.collect()  # one row per key
    ranges = [r for r in found if r["of"] == 0]
    return InPlace(keys, order, local, summary, ranges, not any(r["bad"] for r in ranges), [r for r in found if r["of"] == 1])


def number_in_place(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    base: int = 0,
    per_key: bool = False,
    start: int = 1,
) -> DataFrame | None:
    """Dense numbers without a shuffle when input partitions hold disjoint key ranges.

    Kafka input partitions are offset ranges of one topic partition (and a
    ``repartitionByRange`` output is range-disjoint too), so after a local sort each
    partition's rows are consecutive in (keys, order). One summary row per (partition,
    key) (count, first and last position) is checked for overlap; if the partition ranges
    are disjoint, rows are numbered from it (rows of a group are consecutive in their
    partition, so a row's index is its id minus the group's first). Summaries stay a
    DataFrame; one row per key comes to the driver. If ranges overlap (or a position is NULL)
    ``None`` is returned: a shuffle is needed.

    The input is read twice (summary, then numbering) and must come back with the same
    partitions both times: a persisted or checkpointed frame, or a file or Kafka read.
    Not a fresh ``repartitionByRange``: its bounds are sampled again for each job.
    """
    plan = plan_in_place(df, keys, order)
    if not plan.disjoint:
        plan.close()
        return None
    return plan.number(out, base, per_key, start)


def assign_lsn(
    df: DataFrame,
    base=0,
    keys: Sequence[str] = ("topic", "partition"),
    order: str = "offset",
    out: str = "_lsn",
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    reproducible: bool = False,
    plan: InPlace | None = None,
) -> DataFrame:
    """LSNs base+1, base+2, ... in (topic, partition, offset) order, dense.

    With ``reproducible=True`` (the input reads back with the same partitions: persisted,
    checkpointed, a file or Kafka read) and input partitions that are disjoint ranges
    (Kafka batches), without a shuffle; otherwise by the bucketed prefix sums of
    ``dense_number`` (one shuffle of the batch). ``plan``: ``df`` is measured already."""
    if plan is not None and isinstance(base, int):
        if plan.disjoint:
            more = [c for c in df.columns if c not in plan.local.columns]
            return plan.number(out, base).withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in more})
    elif reproducible and isinstance(base, int):
        numbered = number_in_place(df, keys, order, out, base)
        if numbered is not None:
            return numbered
    return dense_number(df, keys, order, out, per_key=False, start=1, base=base, bucket_width=bucket_width)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: dict[str, str] | None = None,
    maxes: dict[str, str] | None = None,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
) -> DataFrame:
    """Running sums and maxima per key in ``order`` (inclusive of the current row), without
    one task per key: rows are bucketed by ``order // bucket_width``; per-bucket sums and
    maxima (a partial aggregate) are prefixed over the buckets of a key, and the window
    runs inside a bucket only. ``sums``/``maxes`` map output column -> input column;
    ``order`` must be integral and unique within a key."""
    sums, maxes = dict(sums or {}), dict(maxes or {})
    bkt = "__rt_bucket"
    tagged = df.withColumn(bkt, F.floor(F.col(order) / F.lit(bucket_width)).cast("long"))
    tagged, kcols = _surrogate_keys(tagged, [*keys, bkt], "__rt_k")
    key_cols, bkt_cols = kcols[:-2], kcols[-2:]
    per_bucket = tagged.groupBy(*kcols).agg(
        *[F.sum(src).alias(f"__s_{out}") for out, src in sums.items()],
        *[F.max(src).alias(f"__m_{out}") for out, src in maxes.items()],
    )
    before = Window.partitionBy(*key_cols).orderBy(*bkt_cols).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *kcols,
        *[F.coalesce(F.sum(f"__s_{out}").over(before), F.lit(0)).alias(f"__sb_{out}") for out in sums],
        *[F.max(f"__m_{out}").over(before).alias(f"__mb_{out}") for out in maxes],
    )
    inside = Window.partitionBy(*kcols).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = tagged.select(
        "*",
        *[F.sum(src).over(inside).alias(f"__si_{out}") for out, src in sums.items()],
        *[F.max(src).over(inside).alias(f"__mi_{out}") for out, src in maxes.items()],
    )
    joined = ranked.join(starts, kcols)
    outs = {out: F.col(f"__sb_{out}") + F.col(f"__si_{out}") for out in sums}
    outs.update({out: F.greatest(F.col(f"__mb_{out}"), F.col(f"__mi_{out}")) for out in maxes})
    helpers = [c for c in joined.columns if c.startswith("__") and c not in df.columns]
    return joined.withColumns(outs).drop(*helpers)


def upsert_index(
    index: DataFrame,
    keys: Sequence[str] = ("topic", "partition", "offset"),
    newest: Sequence[str] = ("batch_id", "lsn"),
) -> DataFrame:
    """The same (topic, partition, offset) written again keeps the latest entry: the one
    of the highest batch, and within a batch of the highest LSN.

    ``max_by`` over a struct is a partial aggregate, so duplicates are folded map-side
    before the shuffle instead of ranking whole groups.
    """
    keys = list(keys)
    others = [c for c in index.columns if c not in keys]
    order = [newest] if isinstance(newest, str) else [c for c in newest if c in index.columns]
    latest = F.max_by(F.struct(*others), F.struct(*order)).alias("__latest")
    return index.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in others])
