"""Near-duplicate groups by b-bit MinHash.

1. Every document becomes its set of word shingles, ``BANDS * ROWS`` minima over it, a key
   per band, and a signature of the minima's low ``BITS`` bits, packed into 64-bit words.
   Documents of equal sets form a class at once; only the smallest identifier goes on.
2. Documents that share a band key lie in one bucket. Buckets never emit all their pairs:
   every member is paired with one member of the bucket. Pairs whose estimate, corrected for
   chance collisions of b-bit values, is far below the threshold are left out; of the others
   each member's likeliest one is confirmed on the full sets.
3. Confirmed links join components. A bucket whose members are in one component is settled;
   the others get TURNS - 1 more rounds with other members to pair with.
4. What is still unsettled is compared in full: buckets that share members are chained to
   clusters, and each member outside its cluster's largest component is held against all
   members of other components, inside tasks, on full sets. So the groups are those of all
   links between members of a bucket, whatever its size.

Two documents at the threshold of 0.8 share no bucket with probability (1 - 0.8^5)^32, about
3 in a million; one more far above it practically always does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_column, discard, doc_columns, materialise, mix64, prefix_hash, prepare, span_hash, word_spans
from .graph import components

BANDS, ROWS, BITS = 32, 5, 2
MINIMA = BANDS * ROWS
_PER_LONG = 64 // BITS
SIGNATURE_LONGS = -(-MINIMA // _PER_LONG)
#: Rounds in which bucket members are paired with one of them, and shingles of the members of a
#: piece in which all that is then unsettled gets compared.
TURNS, PIECE = 3, 1 << 20
#: A pair is left unconfirmed if its estimate is this many standard deviations below the threshold.
SLACK = 5.0

_rng = np.random.default_rng(77)
_MUL = _rng.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, MINIMA, dtype=np.uint32)
_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """Per document the sorted distinct 64-bit hashes of its k-word shingles (lower-cased
    ASCII); a document of fewer words has the whole sequence as its only one."""
    start, end, words = word_spans(data, offs)
    h = span_hash(prefix_hash(data, lower=True), start, end)
    n = len(h)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if n >= k else 0):
        full += h[j : n - k + 1 + j] * _PLACE[j]
    full = mix64(full)
    out, at = [], 0
    for m in words.tolist():
        if m >= k:
            out.append(np.unique(full[at : at + m - k + 1]))
        elif m:
            out.append(mix64((h[at : at + m] * _PLACE[:m]).sum(keepdims=True) + np.uint64(m)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def _minima(s: np.ndarray) -> np.ndarray:
    x = s.astype(np.uint32)[:, None]
    best = (x[:1024] * _MUL + _ADD).min(0)
    for i in range(1024, len(x), 1024):
        np.minimum(best, (x[i : i + 1024] * _MUL + _ADD).min(0), out=best)
    return best


def _longs(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(``id, n, s1, s2, keys, signature``) per row of (``__id, __text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = np.arange(BANDS, dtype=np.uint64) * _PLACE[40]
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                sets = shingles(raw, at, k)
                mins = np.zeros((len(sets), MINIMA), np.uint64)
                ident = np.zeros((len(sets), 2), np.uint64)
                for i, s in enumerate(sets):
                    if len(s):
                        mins[i] = _minima(s)
                        ident[i] = mix64(s ^ _PLACE[41]).sum(), mix64(s ^ _PLACE[42]).sum()
                keys = mix64((mins.reshape(-1, BANDS, ROWS) * _PLACE[:ROWS]).sum(2) + lanes)
                low = np.zeros((len(sets), SIGNATURE_LONGS * _PER_LONG), np.uint64)
                low[:, :MINIMA] = mins & np.uint64(2**BITS - 1)
                shift = np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS)
                packed = (low.reshape(len(sets), SIGNATURE_LONGS, _PER_LONG) << shift).sum(2)
                sizes = pa.array(np.array([len(s) for s in sets], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), sizes, *(pa.array(np.ascontiguousarray(ident[:, j]).view(np.int64)) for j in (0, 1)), _longs(keys), _longs(packed)],
                    names=["id", "n", "s1", "s2", "keys", "signature"],
                )

    return docs.mapInArrow(run, "id long, n long, s1 long, s2 long, keys array<long>, signature array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(``id, shingles``): the full set of each row of (``__id, __text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                sets = shingles(raw, at, k)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "shingles"]
                )

    return docs.mapInArrow(run, "id long, shingles array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of equal b-bit values, corrected for
    the 2^-b of unequal minima whose low bits agree by chance."""
    ones = int("01" * _PER_LONG, 2)
    differing = F.lit(0)
    for i in range(SIGNATURE_LONGS):
        x = a[i].bitwiseXOR(b[i])
        some = x
        for j in range(1, BITS):
            some = some.bitwiseOR(F.shiftrightunsigned(x, j))
        differing = differing + F.bit_count(some.bitwiseAND(F.lit(ones)))
    equal = F.lit(1.0) - differing / F.lit(float(MINIMA))
    chance = 2.0**-BITS
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, piece, part, id, comp, shingles) come by piece, members (part 0) before
    compared members (part 1). Full sets are intersected over an index of the members'
    shingles; one link is passed on for every two components that get connected."""
    here: tuple[int, int] | None = None
    held: list[tuple[int, int, np.ndarray]] = []
    index: tuple[np.ndarray, ...] | None = None
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        cluster, piece, part, ids, comps = (batch.column(i).to_numpy() for i in range(5))
        ends = batch.column(5).offsets.to_numpy()
        flat = batch.column(5).flatten().to_numpy()
        out: list[tuple[int, int]] = []
        for i in range(batch.num_rows):
            if here != (cluster[i], piece[i]):
                here, held, index, parent = (cluster[i], piece[i]), [], None, {}
            own = flat[ends[i] : ends[i + 1]]
            if part[i] == 0:
                held.append((int(ids[i]), int(comps[i]), own))
                continue
            if not held:
                continue
            if index is None:
                sizes = np.array([len(x[2]) for x in held])
                keys = np.concatenate([x[2] for x in held])
                order = np.argsort(keys, kind="stable")
                keys, owner = keys[order], np.repeat(np.arange(len(held)), sizes)[order]
                index = keys, owner, sizes, np.array([x[1] for x in held])
            keys, owner, sizes, of = index
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            count = hi - lo
            spot = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            shared = np.bincount(owner[spot], minlength=len(held))
            fits = np.flatnonzero((shared * 100 >= (sizes + len(own) - shared) * percent) & (of != comps[i]))
            for j in fits.tolist():
                a, b = root(int(comps[i])), root(held[j][1])
                if a != b:
                    parent[a] = b
                    out.append((int(ids[i]), held[j][0]))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets;
    ``component_id`` is the smallest identifier reachable over links and ``kept`` says that
    it is the row's own. NULL, empty and wordless texts have no shingles and are linked with
    nothing. Equal sets are linked. Rows that repeat an identifier are one node (all of them
    carry its component). A NULL identifier is linked with nothing (component NULL, kept).
    Other columns are ignored; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    threshold = percent / 100
    spread = (threshold * (1 - threshold) / MINIMA) ** 0.5 / (1 - 2.0**-BITS)
    least_estimate = threshold - SLACK * spread
    texts = doc_columns(docs, id_col, text_col)
    rows = materialise(signatures(texts, words), "signatures")
    # Classes of equal sets: one representative each
    ident = ["n", "s1", "s2"]
    classes = materialise(
        rows.where("n > 0 AND id IS NOT NULL").groupBy(*ident).agg(F.min("id").alias("rep")), "classes"
    )
    reps = rows.where("n > 0").join(classes, ident).where("id = rep").select("id", "n", "keys", "signature")
    reps = materialise(reps.dropDuplicates(["id"]), "representatives")
    # Buckets of two or more
    keyed = reps.select("id", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("lead")).where("m > 1")
    buckets = materialise(keyed.join(sizes, "key").select("key", "id", "lead"), "buckets")
    members = buckets.select("id").distinct()
    sets = materialise(shingle_sets(texts.join(members, texts["__id"] == members["id"], "left_semi"), words).dropDuplicates(["id"]), "sets")
    prints = reps.select("id", "n", "signature")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and estimate leave possible, with the estimate."""
        one = prints.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
        two = prints.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
        return (
            pairs.join(one, "a")
            .join(two, "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .select("a", "b", estimate(F.col("sa"), F.col("sb")).alias("est"))
            .where(F.col("est") >= least_estimate)
        )

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        shared = F.size(F.array_intersect("sa", "sb")).cast("long")
        return (
            pairs.join(one, "a")
            .join(two, "b")
            .select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("t"))
            .where(F.col("i") * 100 >= (F.col("t") - F.col("i")) * percent)
            .select("a", "b")
        )

    def label(ids: DataFrame, col: str, comps: DataFrame, out: str) -> DataFrame:
        c = comps.select(F.col("id").alias(col), F.col("comp").alias(f"{out}__"))
        return ids.join(c, col, "left").withColumn(out, F.coalesce(f"{out}__", col)).drop(f"{out}__")

    def across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
        return label(label(pairs, "a", comps, "ca"), "b", comps, "cb").where("ca <> cb").select("a", "b")

    def grow(links: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
        links = materialise(links.union(new), "links")
        return links, materialise(components(links), "components")

    def exhaustive(open_rows: DataFrame, comps: DataFrame) -> DataFrame:
        """Links between all members of different components that unsettled buckets chain
        together. Of two components one is not the cluster's largest, so it is enough to
        compare the members outside the largest with all others. A cluster is cut into pieces
        whose members have about PIECE shingles; the compared members go to every piece."""
        ties = open_rows.groupBy("key").agg(F.min("id").alias("a"))
        chained = components(open_rows.join(ties, "key").select("a", F.col("id").alias("b")))
        chained = materialise(label(chained.withColumnRenamed("comp", "cluster"), "id", comps, "comp"), "clusters")
        weight = chained.join(prints.select("id", "n"), "id").groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("w"), F.sum("n").alias("n"))
        sizes = weight.groupBy("cluster").agg(
            F.max(F.struct("w", "comp"))["comp"].alias("largest"), F.ceil(F.sum("n") / PIECE).cast("int").alias("pieces"), F.count(F.lit(1)).alias("k")
        )
        members = chained.join(sizes.where("k > 1"), "cluster").join(sets, "id").select(
            "cluster", "pieces", "id", "comp", "shingles", (F.col("comp") != F.col("largest")).alias("lead")
        )
        placed = members.select(
            "*",
            F.explode(
                F.concat(
                    F.array(F.struct(F.pmod(F.xxhash64("id"), "pieces").cast("int").alias("piece"), F.lit(0).alias("part"))),
                    F.when(
                        F.col("lead"),
                        F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: F.struct(i.alias("piece"), F.lit(1).alias("part"))),
                    ).otherwise(F.array().cast("array<struct<piece:int,part:int>>")),
                )
            ).alias("at"),
        ).select("cluster", "at.piece", "at.part", "id", "comp", "shingles")
        ordered = placed.repartition("cluster", "piece").sortWithinPartitions("cluster", "piece", "part", "id")
        return ordered.mapInArrow(lambda batches: _compare(batches, percent), "a long, b long")

    # Every member with one member of each of its buckets, the likeliest pairs of each confirmed
    links, comps, open_rows = None, None, buckets
    for turn in range(TURNS):
        met = open_rows.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
        if comps is not None:
            met = across(met, comps)
        best = likely(met).groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a")).select("a", "b")
        pairs, old = materialise(best, "pairs"), (links, comps)
        new = confirmed(pairs)
        links = materialise(new if links is None else links.union(new), "links")
        comps = materialise(components(links), "components")
        discard(pairs, *old)
        labelled = label(open_rows.select("key", "id"), "id", comps, "comp")
        several = labelled.groupBy("key").agg(
            F.min("comp").alias("x"), F.max("comp").alias("y"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("lead")
        )
        before = open_rows
        open_rows = materialise(open_rows.select("key", "id").join(several.where("x <> y").select("key", "lead"), "key"), "open")
        discard(before)
    # What is left: all pairs across components, inside tasks
    if not open_rows.isEmpty():
        links, comps = grow(links, exhaustive(open_rows, comps))

    named = label(rows.join(classes, ident, "left"), "rep", comps, "c")
    return named.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("c", "id"), F.lit(True)).alias("kept"),
    )
