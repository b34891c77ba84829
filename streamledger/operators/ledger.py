"""Offset -> LSN bookkeeping as joins and aggregates.

``index`` has ``topic, partition, offset, lsn``; ``commits`` has one row per
``(topic, partition)`` with ``upto``, the last offset handed over for commit. Coverage is
inclusive (``offset <= upto``), as in the reference. The commit table is joined by
equi-join on the partition key with the range as a join condition; Spark chooses the join
from the measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import running_totals

PART_KEYS = ("topic", "partition")


def _commits(commits: DataFrame, keys: Sequence[str], upto: str) -> DataFrame:
    """The commit table under names of its own (it may be derived from the index itself).
    No hint: Spark broadcasts it below its size threshold, and AQE splits a hot partition of
    the shuffle join above it."""
    return commits.select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col(upto).alias("__c_upto"))


def _cond(keys: Sequence[str], offset: str):
    cond = [F.col(k) == F.col(f"__c_{k}") for k in keys]
    cond.append(F.col(offset) <= F.col("__c_upto"))
    return cond


def covered_by(
    index: DataFrame,
    commits: DataFrame,
    keys: Sequence[str] = PART_KEYS,
    offset: str = "offset",
    upto: str = "upto",
) -> DataFrame:
    """Index entries with ``offset <= upto`` of their partition; partitions without
    a commit are skipped."""
    c = _commits(commits, keys, upto)
    return index.join(c, _cond(keys, offset), "inner").select(*index.columns)


def flush_point_by_partition(
    index: DataFrame,
    commits: DataFrame,
    keys: Sequence[str] = PART_KEYS,
    offset: str = "offset",
    upto: str = "upto",
    lsn: str = "lsn",
) -> DataFrame:
    """A1 per partition: entries considered and their max LSN."""
    covered = covered_by(index, commits, keys, offset, upto)
    return covered.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entries_considered"), F.max(lsn).alias("max_lsn")
    )


def flush_point(
    index: DataFrame,
    commits: DataFrame,
    keys: Sequence[str] = PART_KEYS,
    offset: str = "offset",
    upto: str = "upto",
    lsn: str = "lsn",
) -> DataFrame:
    """A1 global: one row ``flush_lsn`` (NULL when nothing is covered: nothing to flush)."""
    per_part = flush_point_by_partition(index, commits, keys, offset, upto, lsn)
    return per_part.agg(
        F.max("max_lsn").alias("flush_lsn"),
        F.coalesce(F.sum("entries_considered"), F.lit(0)).cast("long").alias("entries_considered"),
    )


def prune_index(
    index: DataFrame,
    commits: DataFrame,
    flushed_lsn: int | None,
    keys: Sequence[str] = PART_KEYS,
    offset: str = "offset",
    upto: str = "upto",
    lsn: str = "lsn",
) -> tuple[DataFrame, DataFrame]:
    """(remaining entries, one-row ``pruned`` count). An entry goes when it is covered
    and its LSN is durable (``lsn <= flushed_lsn``); ``None`` prunes nothing."""
    if flushed_lsn is None:
        return index, index.sparkSession.range(1).select(F.lit(0).cast("long").alias("pruned"))
    c = _commits(commits, keys, upto)
    cond = _cond(keys, offset) + [F.col(lsn) <= F.lit(int(flushed_lsn))]
    remaining = index.join(c, cond, "left_anti")
    pruned = index.join(c, cond, "left_semi").agg(F.count(F.lit(1)).alias("pruned"))
    return remaining, pruned


def batch_stats(
    batches: DataFrame,
    task: str = "task_id",
    batch: str = "batch_id",
    rows: str = "rows",
    max_lsn: str = "max_lsn",
) -> DataFrame:
    """Per task and batch, the running total of rows and the running max LSN (it
    never falls: each batch is seeded with the previous maximum). One input row per
    batch; the running values come from bucketed prefix sums, so a task with a long
    history is not ranked in one task."""
    extra = [c for c in batches.columns if c not in (task, batch, rows, max_lsn)]
    running = running_totals(
        batches, [task], batch, sums={"total_completed": rows}, maxes={"last_lsn": max_lsn}
    )
    return running.select(
        task,
        batch,
        F.col(rows).cast("long").alias("rows"),
        F.col("total_completed").cast("long").alias("total_completed"),
        F.col("last_lsn"),
        *extra,
    )
