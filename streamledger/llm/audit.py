"""Interaction of five text filters, audited over all 120 orders by wide packed counters.

Every document becomes a mask of the filters it fails. A mask stands for one big integer
whose 64-bit fields hold the outcome of each of the 600 steps (120 orders of five filters):
kept after the step, removed by it, failing it although removed before, and the removed ones
that were good or toxic. Adding integers adds all fields at once; a field counts documents,
of which there are fewer than 2^63, so no field ever carries into the next.

Tasks add the integers of their documents per part, the sums are added in LANES lanes a part
and then per part, and only then unpacked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
#: Fields of a step, followed by one field per filter for documents that fail it alone.
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
FIELDS = STEPS * len(OUTCOMES) + len(FILTERS)
FIELD_BYTES = 8
#: Sums of one part are added in so many tasks before the last one.
LANES = 32
#: Parts whose sums a task holds at once; with more, it passes on what it has.
HELD_PARTS = 256

_COUNTS = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
RESULT_DDL = f"part string, filter_order string, step int, {_COUNTS}"


def failures(text: Column) -> Column:
    """Bits 0 to 3 for filters A to D, which look at one text: too few words, too few
    distinct words, too many capitals, a reserved sign."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    bits = [
        n < 200,
        F.lit(100).cast("long") * distinct < F.lit(50).cast("long") * n,
        F.lit(100).cast("long") * capitals > F.lit(3).cast("long") * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    out = F.lit(0)
    for i, bit in enumerate(bits):
        out = out + F.when(bit, 1 << i).otherwise(0)
    return out


def packed(mask: int, good: bool, toxic: bool) -> int:
    """The integer of a mask: its 600 step outcomes and its only failure, if there is one."""
    fields = np.zeros(FIELDS, "<u8")
    steps = fields[: STEPS * len(OUTCOMES)].reshape(len(ORDERS), len(FILTERS), len(OUTCOMES))
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            fails = bool(mask >> FILTERS.index(letter) & 1)
            removed = fails and not gone
            steps[o, s] = (not gone and not fails, removed, fails and gone, removed and good, removed and toxic)
            gone = gone or fails
    if mask.bit_count() == 1:
        fields[STEPS * len(OUTCOMES) + mask.bit_length() - 1] = 1
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(FIELDS * FIELD_BYTES, "little"), "<u8").astype(np.int64)


def _sums(rows: Iterator[tuple[str, int]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.string()), pa.array([t.to_bytes(FIELDS * FIELD_BYTES, "little") for _, t in rows], pa.binary())],
        names=["part", "packed"],
    )


def _add_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, mask, good, toxic) rows to sums of their integers per part."""
    known: dict[int, int] = {}
    held: dict[str, int] = {}
    for batch in batches:
        code = batch.column(1).to_numpy().astype(np.int64) * 4
        code += batch.column(2).to_numpy(zero_copy_only=False) * 2 + batch.column(3).to_numpy(zero_copy_only=False)
        parts = batch.column(0).dictionary_encode()
        pair, times = np.unique(parts.indices.to_numpy() * 128 + code, return_counts=True)
        for x, n in zip(pair.tolist(), times.tolist()):
            which, c = divmod(x, 128)
            if c not in known:
                known[c] = packed(c >> 2, bool(c & 2), bool(c & 1))
            part = parts.dictionary[which].as_py()
            held[part] = held.get(part, 0) + n * known[c]
            if len(held) > HELD_PARTS:
                yield _sums(held.items())
                held = {}
    yield _sums(held.items())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    """The sum of each part; the rows of a part follow one another."""
    part, total = None, 0
    for batch in batches:
        for p, x in zip(batch.column("part"), batch.column("packed")):
            if p.as_py() != part:
                if part is not None:
                    yield part, total
                part, total = p.as_py(), 0
            total += int.from_bytes(x.as_py(), "little")
    if part is not None:
        yield part, total


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for one in _runs(batches):
        yield _sums([one])


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows per part from the sum of its integers."""
    letters = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    for part, total in _runs(batches):
        fields = unpacked(total)
        steps = dict(zip(OUTCOMES, fields[: STEPS * len(OUTCOMES)].reshape(STEPS, len(OUTCOMES)).T))
        alone = fields[STEPS * len(OUTCOMES) :]
        credit = np.zeros(len(FILTERS), np.int64)
        np.add.at(credit, letters, steps["removed"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * STEPS),
                pa.array(np.repeat(ORDERS, len(FILTERS))),
                pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
                *(pa.array(np.ascontiguousarray(x)) for x in (steps["kept"], steps["removed"], steps["redundant"], alone[letters], steps["good_lost"], steps["toxic_lost"], credit[letters])),
            ],
            names=[x.split()[0] for x in RESULT_DDL.split(", ")],
        )


def masks(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(``part, mask, good, toxic``) per document. Filter E (bit 4) fails a text that a smaller
    identifier has too: every text's smallest identifier is found by an aggregate of digests
    and joined by (identifier, digest), so a text of very many copies is no hot key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("__id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("__text"),
        failures(text).alias("__abcd"),
    )
    first = slim.groupBy("__text").agg(F.min("__id").alias("__id")).where(F.col("__id").isNotNull())
    first = first.select("__id", "__text", F.lit(True).alias("__first"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("__good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"),
    )
    found = slim.join(first, ["__id", "__text"], "left").join(marks, "__id", "left")
    copy = F.col("__id").isNotNull() & F.col("__first").isNull()
    return found.select(
        "part",
        (F.col("__abcd") + F.when(copy, 16).otherwise(0)).cast("int").alias("mask"),
        F.coalesce("__good", F.lit(False)).alias("good"),
        F.coalesce("__toxic", F.lit(False)).alias("toxic"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """600 rows per value of ``part_col`` (NULL and the empty string are one part): ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``; the step's filter is letter ``step`` of ``filter_order``.

    A document fails A with under 200 words, B if less than half of its words are distinct, C
    with more than 3 capitals A-Z per 100 code points, D with any of ``#$%&*|``, E if a smaller
    identifier has the same text. NULL counts as empty, which fails A only, or A and E. Rows
    that repeat identifier and text are documents of their own, none a copy of the other. A
    NULL identifier fails no E, makes no other fail it and has no label. An identifier with
    several labels is good or toxic if one of them says so; NULL labels say nothing. Other
    columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    sums = masks(docs, labels, id_col, text_col, part_col).mapInArrow(_add_documents, "part string, packed binary")
    lanes = sums.withColumn("lane", F.spark_partition_id() % LANES).repartition("part", "lane").sortWithinPartitions("part")
    per_lane = lanes.select("part", "packed").mapInArrow(_add_sums, "part string, packed binary")
    return per_lane.repartition("part").sortWithinPartitions("part").mapInArrow(_outcomes, RESULT_DDL)
