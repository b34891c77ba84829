"""Codes of vectors: per part the nearest entry of a small codebook, found by a GNAT.

A geometric near-neighbour access tree is built over the entries of a part's codebook: a node
has split points, every other entry belongs to its nearest split point's child, and for each
pair (split point, child) the smallest and largest distance from that split point to the
child's entries is kept. A query measures its distance to the split points; a child none of
whose entries can be as near as the best entry so far, by the triangle inequality with any of
the ranges, is left out with all that is below it. Ranges and distances are compared as
floating point with a margin on the safe side and strictly, so an entry at the best distance
is never left out; the entries themselves are compared by integer squared distances, ties to
the lower index.

Vectors are assigned in tasks over Arrow batches, all queries of a batch going down the tree
together. A task passes on one sum per (part, entry); the sums are added in LANES lanes, so
the driver gets one row per entry, and the codebook (entries x dimension integers) goes with
the next round's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, and entries from which a node is split.
DEGREE, LEAF = 12, 24
#: Sums of one entry are added in so many tasks before the last one.
LANES = 32
#: Vectors that go down the tree together.
QUERIES = 4096
#: Distances below this are whole numbers in floating point; beyond it Python's integers serve.
EXACT = 2.0**52
#: Relative margin of comparisons between distances, far above the rounding of a square root.
MARGIN = 1e-9
#: Squared distances beyond it have no square root in floating point: nothing is left out then.
ROOTED = 2**1000
MAX_LONG = 2**63 - 1


@dataclass
class Node:
    """``splits``: entries measured first (for a leaf, all). ``low``, ``high``: distance ranges
    of (split point, child); an empty child has none."""

    splits: np.ndarray
    children: list["Node | None"]
    low: np.ndarray
    high: np.ndarray


def squared(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all queries to all entries, as whole numbers: floating point
    where all terms stay below 2^52, else Python integers."""
    if queries.dtype == object or entries.dtype == object:
        out = np.zeros((len(queries), len(entries)), object)
        for j, e in enumerate(entries):
            out[:, j] = ((queries - e) ** 2).sum(1) if len(queries) else 0
        return out
    return (queries**2).sum(1)[:, None] - 2 * (queries @ entries.T) + (entries**2).sum(1)


def whole(rows: np.ndarray, most: float = 0.0) -> np.ndarray:
    """Whole-valued floats as they are if squared distances between them and others of up to
    ``most`` are exact, else Python integers."""
    top = max(most, float(np.abs(rows).max(initial=0)))
    if rows.dtype != object and 2 * top < (EXACT / rows.shape[1]) ** 0.5:
        return rows
    return np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape)


def _roots(d2: np.ndarray) -> np.ndarray:
    if d2.dtype == object:
        return np.array([float(x) if x < ROOTED else np.inf for x in d2.ravel()], float).reshape(d2.shape) ** 0.5
    return np.sqrt(d2)


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """The tree over ``members`` (indexes into ``entries``); split points are chosen far from
    each other."""
    members = np.arange(len(entries)) if members is None else members
    none = np.zeros((0, 0))
    if len(members) <= LEAF:
        return Node(members, [], none, none)
    picked = [0]
    nearest = squared(entries[members[:1]], entries[members])[0]
    while len(picked) < DEGREE:
        far = int(np.argmax(nearest))
        if nearest[far] == 0:  # all others equal a split point
            return Node(members, [], none, none)
        picked.append(far)
        nearest = np.minimum(nearest, squared(entries[members[far : far + 1]], entries[members])[0])
    splits, rest = members[picked], np.delete(members, picked)
    d2 = squared(entries[splits], entries[rest])
    owner, roots = np.argmin(d2, 0), _roots(d2)
    low, high = np.full((DEGREE, DEGREE), np.inf), np.full((DEGREE, DEGREE), -np.inf)
    children: list[Node | None] = []
    for j in range(DEGREE):
        own = owner == j
        children.append(build(entries, rest[own]) if own.any() else None)
        if own.any():
            low[:, j], high[:, j] = roots[:, own].min(1), roots[:, own].max(1)
    return Node(splits, children, low, high)


class Search:
    """The nearest entry of each query: ``index``, and ``best``, its squared distance.
    ``measured`` counts the distances taken."""

    def __init__(self, entries: np.ndarray, tree: Node, queries: np.ndarray):
        self.entries, self.queries = entries, queries
        self.index = np.full(len(queries), len(entries))
        self.best = np.zeros(len(queries), object if entries.dtype == object or queries.dtype == object else float)
        self.measured = 0
        self._down(tree, np.arange(len(queries)))

    def _down(self, node: Node, at: np.ndarray) -> None:
        d2 = squared(self.queries[at], self.entries[node.splits])
        self.measured += d2.size
        least = d2.min(1)
        # of the entries at the least distance the one of the lowest index
        first = np.where(d2 == least[:, None], node.splits, len(self.entries)).min(1)
        old = self.index[at]
        new = (old == len(self.entries)) | (least < self.best[at]) | ((least == self.best[at]) & (first < old))
        self.best[at[new]], self.index[at[new]] = least[new], first[new]
        if not node.children:
            return
        roots = _roots(d2)
        for j in np.argsort(node.low.min(0), kind="stable").tolist():
            child = node.children[j]
            if child is None:
                continue
            reach = _roots(self.best[at])[:, None]
            with np.errstate(invalid="ignore"):  # distances without a root leave nothing out
                above = roots - reach - node.high[:, j] > MARGIN * (roots + reach + node.high[:, j])
                below = node.low[:, j] - roots - reach > MARGIN * (roots + reach + node.low[:, j])
            near = ~(above | below).any(1)
            if near.any():
                self._down(child, at[near])


def _vectors(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, dim)


def _assigned(batches: Iterator[pa.RecordBatch], column: int, books: list[np.ndarray]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[Search]]]:
    """Per block of a batch: its rows, their vectors, and the search of each part."""
    dim = sum(b.shape[1] for b in books)
    width = dim // len(books)
    trees: dict[tuple[int, bool], tuple[np.ndarray, Node]] = {}
    tops = [float(np.abs(b).max(initial=0)) for b in books]
    for whole_batch in batches:
        for lo in range(0, whole_batch.num_rows, QUERIES):
            batch = whole_batch.slice(lo, QUERIES)
            rows = _vectors(batch, column, dim)
            found = []
            for p, book in enumerate(books):
                part = whole(rows[:, p * width : (p + 1) * width], tops[p])
                key = (p, part.dtype == object)
                if key not in trees:
                    entries = np.array(book.tolist(), object).reshape(book.shape) if key[1] else book.astype(float)
                    trees[key] = entries, build(entries)
                found.append(Search(*trees[key], part))
            yield batch, rows, found


def _entry_sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per (part, entry) of a task: how many parts it got and the sum of each component."""
    width = books[0].shape[1]
    counts = np.zeros((len(books), len(books[0])), np.int64)
    totals = np.zeros((len(books), len(books[0]), width), object)
    for _batch, rows, found in _assigned(batches, 0, books):
        for p, search in enumerate(found):
            counts[p] += np.bincount(search.index, minlength=len(books[p]))
            part = search.queries
            if part.dtype == object:
                for i, e in enumerate(search.index.tolist()):
                    totals[p, e] += part[i]
            else:  # a block's sums are whole numbers below 2^53
                for k in range(width):
                    sums = np.bincount(search.index, weights=part[:, k], minlength=len(books[p]))
                    totals[p, :, k] += sums.astype(np.int64).astype(object)
    p, e = np.nonzero(counts)
    yield _sum_rows([(int(a), int(b), int(counts[a, b]), totals[a, b].tolist()) for a, b in zip(p, e)])


def _sum_rows(rows: list[tuple[int, int, int, list[int]]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64())
    cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    texts = pa.array([[str(int(x)) for x in r[3]] for r in rows], pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([*cols, texts], names=["part", "entry", "n", "sums"])


SUMS_DDL = "part int, entry int, n long, sums array<string>"


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a (part, entry) follow one another; sums are integers of any size, as text."""
    key, n, total = None, 0, []
    for batch in batches:
        for p, e, m, sums in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (p, e) != key:
                if key is not None:
                    yield _sum_rows([(*key, n, total)])
                key, n, total = (p, e), 0, [0] * len(sums)
            n += m
            total = [a + int(b) for a, b in zip(total, sums)]
    if key is not None:
        yield _sum_rows([(*key, n, total)])


def _added(sums: DataFrame) -> DataFrame:
    lanes = sums.withColumn("lane", F.spark_partition_id() % LANES)
    lanes = lanes.repartition("part", "entry", "lane").sortWithinPartitions("part", "entry")
    once = lanes.select("part", "entry", "n", "sums").mapInArrow(_add_sums, SUMS_DDL)
    return once.repartition("part", "entry").sortWithinPartitions("part", "entry").mapInArrow(_add_sums, SUMS_DDL)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int) -> tuple[DataFrame, int]:
    """(``__id, __label, __vec``) of the rows that can be coded, components scaled and floored
    to whole-valued doubles, and their dimension: the commonest length that ``parts`` divides
    (of equally common ones the largest; 0 without rows)."""
    scaled = F.transform(F.col(vec_col), lambda x: x.cast("double") * SCALE)
    rows = vectors.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).alias("__label"), scaled.alias("__vec"))
    finite = F.forall("__vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("__vec").isNotNull() & (F.size("__vec") > 0) & (F.size("__vec") % parts == 0) & finite)
    # doubles from 2^52 on are whole
    floors = F.transform("__vec", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    rows = materialise(rows.select("__id", "__label", floors.alias("__vec")), "vectors")
    lengths = rows.groupBy(F.size("__vec").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("k")).first()
    return (rows, 0) if top is None else (rows.where(F.size("__vec") == top["k"]), top["k"])


def train(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks (entries x components, Python integers) after ``rounds`` rounds over all
    rows, seeded by the parts of the smallest identifiers."""
    width = dim // parts
    seeds = rows.orderBy(F.asc_nulls_last("__id"), "__vec").limit(entries).select("__vec").collect()
    seed = np.array([[int(x) for x in r["__vec"]] for r in seeds], object).reshape(len(seeds), dim)
    books = [seed[:, p * width : (p + 1) * width] for p in range(parts)]
    for _ in range(rounds):
        held = books
        sums = rows.select("__vec").mapInArrow(lambda batches: _entry_sums(batches, held), SUMS_DDL)
        books = [b.copy() for b in books]
        for r in _added(sums).collect():  # one row per entry
            books[r["part"]][r["entry"]] = [int(x) // r["n"] for x in r["sums"]]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(``__id, __label, code, error``) of all rows; an error beyond a long is the largest long."""
    label = rows.schema["__label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _rows, found in _assigned(batches, 2, books):
            index = np.stack([s.index for s in found], 1)
            code = ["".join(f"{x:02x}" for x in r) for r in index.tolist()]
            error = [min(MAX_LONG, sum(int(x) for x in r)) for r in zip(*(s.best.tolist() for s in found))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["__id", "__label", "code", "error"]
            )

    return rows.mapInArrow(run, f"__id long, __label {label}, code string, error long")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per kept vector: ``id_col``, ``code``, ``error``, ``label_error``,
    ``codebooks_sha256`` (see ``train`` and ``encode``).

    Dropped are NULL vectors and those with a NULL or non-finite component (also if it is so
    after scaling), and vectors whose length is zero, no multiple of ``parts`` or not the
    commonest one. Rows that repeat an identifier are coded each; seeds of equal identifiers
    come by their vectors, those without an identifier last. With fewer rows than ``entries``
    every row is a seed. Components of any size are exact; sums of errors end at the largest
    long. NULL labels are one group. Other columns are ignored; an empty table gives an empty
    result.
    """
    prepare(vectors.sparkSession)
    rows, dim = whole_vectors(vectors, id_col, vec_col, label_col, parts)
    books = train(rows, dim, parts, entries, rounds) if dim else [np.zeros((1, 1), object)]
    coded = materialise(encode(rows, books), "codes")
    most = F.lit(MAX_LONG).cast("decimal(38,0)")
    per_label = coded.groupBy(F.col("__label").alias("__of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error")
    )
    return coded.join(per_label, F.col("__label").eqNullSafe(F.col("__of")), "left").select(
        F.col("__id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
