"""Similarity join on word shingles: size-banded tiles, hashed bitmaps, exact intersections.

1. Every document becomes its sorted set of shingle hashes and its tile keys. Equal sets are
   one class; its smallest identifier stands for it. Sets that meet others get a bitmap, of four
   to eight bits a shingle, in which every shingle sets one.
2. Of two linked sets each shares at least ``percent`` of its shingles with the other, so in any
   order of all shingles their first n - ceil(percent * n / 100) + 1 ones have one in common: no
   link is lost if sets meet by these. The order is from rare to frequent, as counted over all
   documents (hashed to COUNTERS counters, which may count rare shingles as frequent but only
   costs order, not links), so shingles that many documents share are rarely keys.
3. The sets that share a key are cut into tiles by size: a set lies in its own band
   [BAND^b, BAND^(b+1)) and, if its smaller partners can lie there, in the band below. Two sets
   have no more in common than either has from their first common key on, so a pair that meets
   late in either order is no link, or meets by an earlier key too; such pairs are left out. A
   tile needs a member that can be the smaller set of a link: its key comes early enough for
   an equally large partner, and the band is its own.
4. A tile's members are held against one of them, its lead. Of two bitmaps, every bit that only
   one has stands for a shingle that the other set lacks, so bit counts bound the overlap from
   above; pairs whose bound is too small are left out. The others are settled by intersecting
   the sorted arrays. A tile whose members are in one component is done.
5. After at most TURNS rounds with other leads, the members of unsettled tiles are compared in full.
   In tiles of up to SMALL members all pairs meet, as above: as many as the tiles have rows, at
   most SMALL / 2 times, whatever the corpus. Larger tiles are chained to clusters by their
   members, which meet by bitmaps, in pieces of bounded size and in the order of set sizes. The
   arrays of the pairs left are intersected; members with more than NAMED such partners meet
   the arrays of all members of their cluster instead. So the result is that of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_column, discard, doc_columns, materialise, mix64, prefix_hash, prepare, span_hash, word_spans
from .graph import components

#: Ratio of a band's ends.
BAND = 1.3
#: Bits of the smallest bitmap; a larger set has the power of two from four bits a shingle on.
BITMAP = 1024
#: Counters of shingles, and those that one row carries.
COUNTERS, ROW_COUNTERS = 1 << 20, 1 << 12
#: Rounds in which the members of a tile are held against one of them; with fewer unsettled
#: members than FEW, the rest are compared in full at once.
TURNS, FEW = 3, 1 << 17
#: Members of a tile that are paired with each other; more are compared in pieces of a cluster.
SMALL = 256
#: Bits of the filter that picks documents by identifier where they are read.
FILTER = 1 << 23
#: Sets whose copies a task knows again.
SEEN = 1 << 17
#: Shingles of the sets, and of the sets whose bitmaps, a task holds while others are compared
#: with them; members that meet one lead in a task; partners that a member is given by name.
PIECE_SHINGLES, PIECE_MARKED, PIECE_MEMBERS, NAMED = 1 << 20, 1 << 23, 4096, 32

_rng = np.random.default_rng(12012)
_WORD = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def all_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): 64-bit hashes of each document's k-word shingles (A-Z lower-cased), one
    document after the other, repeated ones too; with fewer words the whole sequence is the only
    shingle."""
    start, end, words = word_spans(data, offs)
    h = span_hash(prefix_hash(data, lower=True), start, end)
    n = len(h)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if n >= k else 0):
        full += h[j : n - k + 1 + j] * _WORD[j]
    full = mix64(full)
    counts = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    ends, first = np.cumsum(counts), np.cumsum(words) - words
    out = np.zeros(int(counts.sum()), np.uint64)
    long = np.flatnonzero(words >= k)
    m = counts[long]
    step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    out[np.repeat(ends[long] - m, m) + step] = full[np.repeat(first[long], m) + step]
    for i in np.flatnonzero((words > 0) & (words < k)).tolist():
        m = int(words[i])
        out[ends[i] - 1] = mix64((h[first[i] : first[i] + m] * _WORD[:m]).sum(keepdims=True) + np.uint64(m))[0]
    return out, ends


def shingle_hashes(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): each document's set, sorted (see ``all_shingles``)."""
    flat, ends = all_shingles(data, offs, k)
    sets = [np.unique(flat[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]
    return (np.concatenate(sets) if sets else flat), np.cumsum([len(x) for x in sets], dtype=np.int64)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes ^ _SALT[0]) >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def shingle_levels(docs: DataFrame, k: int) -> np.ndarray:
    """How frequent the shingles of each counter are over all rows of (``__id, __text``), in
    eighths of powers of two: COUNTERS bytes, whatever the corpus."""
    spark = docs.sparkSession
    rows = COUNTERS // ROW_COUNTERS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for _lo, _hi, raw, at in blocks(data, offs):
                seen += np.bincount(_counter(all_shingles(raw, at, k)[0]), minlength=COUNTERS)
        yield _lists_of(np.arange(rows), seen.reshape(rows, ROW_COUNTERS))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            counts = batch.column(1).flatten().to_numpy().reshape(-1, ROW_COUNTERS)
            for which, row in zip(batch.column(0).to_pylist(), counts):
                sums[which] = sums[which] + row if which in sums else row.copy()
        for which, row in sums.items():
            yield _lists_of(np.array([which]), row[None])

    counted = docs.mapInArrow(count, "row long, counts array<long>")
    # two steps, so that no task adds the counts of all tasks
    lanes = counted.withColumn("lane", F.spark_partition_id() % 16).repartition("row", "lane").select("row", "counts")
    added = lanes.mapInArrow(add, "row long, counts array<long>").repartition("row").mapInArrow(add, "row long, counts array<long>")
    total = np.zeros((rows, ROW_COUNTERS), np.int64)
    for r in added.repartition(1).toLocalIterator():
        total[r["row"]] += np.array(r["counts"])
    return np.minimum(255, np.log2(total.ravel() + 1) * 8).astype(np.uint8)


def _lists_of(numbers: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    lists = _lists(counts.ravel(), np.arange(1, len(counts) + 1) * counts.shape[1])
    return pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int64)), lists], names=["row", "counts"])


def tile_keys(hashes: np.ndarray, ends: np.ndarray, levels: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, ends): of each set the first shingles in the order from rare to frequent, so many
    that two linked sets have one of them in common; none for sets that can only link with an
    equal one."""
    sizes = np.diff(ends, prepend=0)
    take = np.where(sizes * 100 >= percent * (sizes + 1), sizes - -(-sizes * percent // 100) + 1, 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    # hashes are sorted within a set, so equal levels stay in the order of hashes
    order = np.argsort(of * 256 + levels[_counter(hashes)], kind="stable")
    place = np.arange(len(hashes)) - np.repeat(ends - sizes, sizes)
    return hashes[order[place < take[of]]], np.cumsum(take)


def bands(n: Column, percent: int) -> Column:
    """The size bands of a set of ``n`` shingles: its own and, if a partner of fewer shingles can
    lie in it, the one below (``n`` from 1)."""
    own = F.floor(F.log(BAND, n.cast("double")) + F.lit(1e-9))
    least = F.floor(F.log(BAND, F.ceil(n * percent / F.lit(100.0)).cast("double")) + F.lit(1e-9))
    return F.sequence(F.least(least, own).cast("int"), own.cast("int"))


def early(n: Column, at: Column, percent: int) -> Column:
    """Whether the first common key of a link can be key ``at`` (from 0) of its smaller set, of
    ``n`` shingles."""
    return at * (100 + percent) <= n * (100 - percent)


def can_link(n: Column, left: Column, m: Column, other_left: Column, percent: int) -> Column:
    """Whether sets of ``n`` and ``m`` shingles can be linked if they have none in common before
    the last ``left`` and ``other_left`` ones."""
    return F.least(left, other_left) * (100 + percent) >= (n + m) * percent


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The bitmap of a set, as words: each shingle sets the bit that its hash names. Halves of a
    bitmap laid over each other are the bitmap of half the size."""
    width = max(BITMAP, 1 << (4 * len(hashes) - 1).bit_length()) if len(hashes) else BITMAP
    marks = np.zeros(width, bool)
    marks[(mix64(hashes ^ _SALT[3]) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").view("<u8")


def folded(words: np.ndarray, longs: int) -> np.ndarray:
    """Bitmaps (rows of words) of ``longs`` words."""
    while words.shape[-1] > longs:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offs = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.ascontiguousarray(flat).view(np.int64)))


def sketches(docs: DataFrame, k: int, levels: np.ndarray, percent: int) -> DataFrame:
    """(``id, n, s1, s2, keys``) per row of (``__id, __text``); equal sets have equal
    (``n, s1, s2``)."""
    order = docs.sparkSession.sparkContext.broadcast(levels)  # COUNTERS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                hashes, ends = shingle_hashes(raw, at, k)
                sizes = np.diff(ends, prepend=0)
                ident = []
                for salt in (_SALT[4], _SALT[5]):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ salt))])
                    ident.append(np.ascontiguousarray(sums[ends] - sums[ends - sizes]).view(np.int64))
                keys, key_ends = tile_keys(hashes, ends, order.value, percent)
                # copies that a task has seen need no keys again
                again = np.zeros(len(sizes), bool)
                for i, x in enumerate(zip(ident[0].tolist(), ident[1].tolist())):
                    again[i] = x in seen
                    seen.add(x)
                if len(seen) > SEEN:
                    seen = set()
                width = np.diff(key_ends, prepend=0)
                keys = keys[~np.repeat(again, width)]
                key_ends = np.cumsum(np.where(again, 0, width))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(sizes), *map(pa.array, ident), _lists(keys, key_ends)
                    ],
                    names=["id", "n", "s1", "s2", "keys"],
                )

    return docs.mapInArrow(run, "id long, n long, s1 long, s2 long, keys array<long>")


def wanted(ids: DataFrame) -> np.ndarray:
    """A filter of FILTER bits that lets the rows of ``ids`` (one column, ``id``) pass, and few
    others as long as these are not very many: whatever their number, it has one size."""
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER))
    words = ids.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {FILTER}) % 64 as int))")).alias("b"))
    out = np.zeros(FILTER // 64, np.int64)
    for r in words.repartition(1).toLocalIterator():  # one job, not one a partition
        out[r["w"]] = r["b"]
    return out.view(np.uint64)


def sets_of(docs: DataFrame, k: int, ids: DataFrame, marks: bool) -> DataFrame:
    """Of the rows of (``__id, __text``) whose identifier is in ``ids`` (and of a few others, which
    a join drops): (``id, n, bits``) with ``marks``, else (``id, shingles``), the full sorted set.
    Texts aren't shuffled for it: rows are left out where they are read."""
    some = docs.sparkSession.sparkContext.broadcast(wanted(ids))  # FILTER bits
    placed = docs.select("__id", "__text", F.pmod(F.xxhash64("__id"), F.lit(FILTER)).alias("__place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            place = whole.column(2).to_numpy()
            use = (some.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
            batch = whole.filter(pa.array(use))
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                hashes, ends = shingle_hashes(raw, at, k)
                own = batch.column(0).slice(lo, hi - lo)
                if marks:
                    words = [bitmap(hashes[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]
                    lists = _lists(np.concatenate(words), np.cumsum([len(x) for x in words]))
                    yield pa.RecordBatch.from_arrays([own, pa.array(np.diff(ends, prepend=0)), lists], names=["id", "n", "bits"])
                else:
                    yield pa.RecordBatch.from_arrays([own, _lists(hashes, ends)], names=["id", "shingles"])

    return placed.mapInArrow(run, "id long, n long, bits array<long>" if marks else "id long, shingles array<long>")


def overlap_bound(na: Column, a: Column, nb: Column, b: Column) -> Column:
    """From two sizes and bitmaps, a number that the common shingles can't exceed. Of bitmaps of
    different sizes the larger one is folded (linked sets' differ by one step at most)."""
    longs = F.least(F.size(a), F.size(b))

    def fold(x: Column) -> Column:
        return F.when(F.size(x) == longs, x).otherwise(
            F.transform(F.sequence(F.lit(0), longs - 1), lambda i: F.get(x, i).bitwiseOR(F.get(x, i + longs)))
        )

    def only(x: Column, y: Column) -> Column:
        each = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(each, F.lit(0), lambda total, n: total + n)

    return F.least(na - only(fold(a), fold(b)), nb - only(fold(b), fold(a)))


def linked(shared, na, nb, percent: int):
    """Whether 100 * |intersection| >= percent * |union| (numbers, arrays or columns)."""
    return shared * 100 >= (na + nb - shared) * percent


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def _pieces(batches: Iterator[pa.RecordBatch], arrays: int) -> Iterator[tuple[bool, tuple, list[np.ndarray]]]:
    """Rows (tile, piece, part, id, comp, n, arrays...) as (first row of a piece, values,
    arrays)."""
    here = None
    for batch in batches:
        plain = [batch.column(i).to_pylist() for i in range(6)]
        lists = [(batch.column(6 + i).offsets.to_numpy(), batch.column(6 + i).values.to_numpy().view(np.uint64)) for i in range(arrays)]
        for i, row in enumerate(zip(*plain)):
            yield here != row[:2], row, [flat[ends[i] : ends[i + 1]] for ends, flat in lists]
            here = row[:2]


def _marked(batches: Iterator[pa.RecordBatch], percent: int, named: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, piece, part, id, comp, n, bits) come by piece, held members (part 0) before
    those compared with them (part 1). Passes on the pairs (a, b) of different components that
    sizes and bitmaps leave possible; of a compared member with more than ``named`` only itself
    (b is NULL)."""
    held: list[tuple[int, int, int, np.ndarray]] = []
    index: tuple | None = None
    out: list[tuple[int, int | None]] = []

    def flush() -> pa.RecordBatch:
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for new, (_tile, _piece, part, own, comp, n), (bits,) in _pieces(batches, 1):
        if new:
            held, index = [], None
        if part == 0:
            held.append((n, own, comp, bits.copy()))
            continue
        if not held:
            continue
        if index is None:  # by size; bitmaps of one width are rows of one array
            held.sort(key=lambda x: x[0])
            sizes, ids, comps = (np.array([x[k] for x in held]) for k in (0, 1, 2))
            width = np.array([len(x[3]) for x in held])
            index = sizes, ids, comps, [(w, np.flatnonzero(width == w), np.stack([x[3] for x in held if len(x[3]) == w])) for w in np.unique(width).tolist()]
        sizes, ids, comps, classes = index
        lo, hi = np.searchsorted(sizes, -(-n * percent // 100)), np.searchsorted(sizes, n * 100 // percent, "right")
        found = []
        for w, rows, words in classes:
            a, b = np.searchsorted(rows, lo), np.searchsorted(rows, hi)
            if a == b:
                continue
            longs = min(w, len(bits))
            mine, theirs, m = folded(bits, longs), folded(words[a:b], longs), sizes[rows[a:b]]
            bound = np.minimum(
                n - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64), m - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
            )
            found += rows[a:b][linked(bound, m, n, percent) & (comps[rows[a:b]] != comp)].tolist()
        out += [(own, None)] if len(found) > named else [(own, int(ids[j])) for j in found]
        if len(out) > 1 << 14:
            yield flush()
    yield flush()


def _tiles(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, piece, part, id, comp, n, shingles) come by piece, held members (part 0)
    before those compared with them (part 1). Sorted arrays are intersected; one link is passed
    on for every two components that get connected."""
    held: list[tuple[int, int, int, np.ndarray]] = []
    parent: dict[int, int] = {}
    out: list[tuple[int, int]] = []

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for new, (_tile, _piece, part, own, comp, n), (shingles,) in _pieces(batches, 1):
        if new:
            held, parent = [], {}
        if part == 0:
            held.append((n, own, comp, shingles.copy()))
            continue
        for m, other, of, theirs in held:
            if of != comp and min(n, m) * 100 >= max(n, m) * percent:
                a, b = root(comp), root(of)
                if a != b and linked(_common(shingles, theirs), n, m, percent):
                    parent[a] = b
                    out.append((own, other))
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _label(frame: DataFrame, col: str, comps: DataFrame | None, out: str) -> DataFrame:
    """``frame`` with the component of ``col`` (itself where it has none) as ``out``."""
    if comps is None:
        return frame.withColumn(out, F.col(col))
    c = comps.select(F.col("id").alias(col), F.col("comp").alias(f"{out}__"))
    return frame.join(c, col, "left").withColumn(out, F.coalesce(f"{out}__", col)).drop(f"{out}__")


def _clusters(open_rows: DataFrame, comps: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tile, id, comp, n, lead): the members of unsettled tiles, by the clusters that these
    chain together. Of two components one is not the cluster's largest, so it is enough to
    compare the members outside it (``lead``) with all members of other components."""
    ties = open_rows.groupBy("key").agg(F.min("id").alias("a"))
    chained = components(open_rows.join(ties, "key").select("a", F.col("id").alias("b")))
    chained = _label(chained.withColumnRenamed("comp", "tile"), "id", comps, "comp")
    chained = chained.join(sizes.groupBy("id").agg(F.sum("n").alias("n")), "id")
    weights = chained.groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("m"))
    several = weights.groupBy("tile").agg(F.max(F.struct("m", "comp"))["comp"].alias("largest"), F.count(F.lit(1)).alias("k"))
    return chained.join(several.where("k > 1"), "tile").select("tile", "id", "comp", "n", (F.col("comp") != F.col("largest")).alias("lead"))


def _placed(members: DataFrame, size: int) -> DataFrame:
    """(tile, piece, part, id, comp): members dealt to pieces of about ``size`` shingles, where
    they are held (part 0); ``lead`` members go to every piece of their tile (part 1)."""
    pieces = members.groupBy("tile").agg(F.ceil(F.sum("n") / size).cast("int").alias("pieces"), F.max("lead").alias("some"))
    held = F.array(F.struct(F.pmod(F.xxhash64("id"), "pieces").cast("int").alias("piece"), F.lit(0).alias("part")))
    sent = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: F.struct(i.alias("piece"), F.lit(1).alias("part")))
    at = F.explode(F.when(F.col("lead"), F.concat(held, sent)).otherwise(held)).alias("at")
    return members.join(pieces.where("some"), "tile").select("tile", at, "id", "comp").select("tile", "at.piece", "at.part", "id", "comp")


def similarity_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets
    (``percent`` from 50 on); ``component_id`` is the smallest identifier reachable over links.
    NULL, empty and wordless texts have no shingles and are linked with nothing. Equal sets are
    linked. Rows that repeat an identifier are one node with the links of all of them. A NULL
    identifier is linked with nothing (component NULL). Other columns are ignored; an empty
    table gives an empty result.
    """
    if not 50 <= percent <= 100:
        raise ValueError("bands are made for a similarity of 50 to 100 percent")
    prepare(docs.sparkSession)
    texts = doc_columns(docs, id_col, text_col)
    rows = materialise(sketches(texts, words, shingle_levels(texts, words), percent), "sketches")
    some = rows.where("n > 0 AND id IS NOT NULL")
    # Classes of equal sets: the smallest identifier stands for the class
    ident = ["n", "s1", "s2"]
    classes = materialise(some.groupBy(*ident).agg(F.min("id").alias("rep")), "classes")
    keyed = some.select("id", "n", F.posexplode("keys").alias("at", "key"))
    several = keyed.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.max(early(F.col("n"), F.col("at"), percent)).alias("some")).where("x <> y AND some").select("key")
    several = materialise(several, "shared-keys")  # of the two shuffles of all keys one is there at a time
    met = materialise(keyed.select("id", "at", "key").join(several.hint("merge"), "key"), "met")
    discard(several)
    named = some.select("id", *ident).join(met.select("id").distinct(), "id", "left_semi").join(classes, ident)
    named = named.select("id", "rep", "n", F.explode(bands(F.col("n"), percent)).alias("band"), F.element_at(bands(F.col("n"), percent), -1).alias("own")).distinct()
    tiles = met.join(named, "id").select(
        F.xxhash64("key", "band").alias("key"),
        F.col("rep").alias("id"),
        "n",
        (F.col("n") - F.col("at")).alias("left"),
        (early(F.col("n"), F.col("at"), percent) & (F.col("band") == F.col("own"))).alias("first"),
    )
    # rows of one identifier are one node
    twice = some.groupBy("id").agg(F.count_distinct(*ident).alias("k")).where("k > 1").select("id")
    links = materialise(some.join(twice, "id", "left_semi").join(classes, ident).select(F.col("id").alias("a"), F.col("rep").alias("b")), "links")
    comps = None if links.isEmpty() else materialise(components(links), "components")

    def opened(tiles: DataFrame, order: Column) -> DataFrame:
        """The rows of tiles of several components, with the tile's size and its lead."""
        labelled = _label(tiles.select("key", "id", "n", "left", "first"), "id", comps, "comp")
        state = labelled.groupBy("key").agg(
            F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("first").alias("some"), F.count(F.lit(1)).alias("size"), F.min_by(F.struct("id", "n", "left", "comp"), order).alias("lead")
        )
        return labelled.join(state.where("x <> y AND some").select("key", "size", "lead"), "key")

    open_rows = materialise(opened(tiles, F.col("id")), "open")
    discard(met)
    members = materialise(open_rows.select("id").distinct(), "members")
    prints = materialise(sets_of(texts, words, members, marks=True).join(members, "id", "left_semi"), "prints")

    def bounded(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and bitmaps leave possible, with the bound's similarity."""
        one = prints.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
        two = prints.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
        met = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        met = met.withColumn("most", overlap_bound(F.col("na"), F.col("xa"), F.col("nb"), F.col("xb")))
        met = met.where(linked(F.col("most"), F.col("na"), F.col("nb"), percent))
        return met.select("a", "b", (F.col("most") / (F.col("na") + F.col("nb") - F.col("most"))).alias("like"))

    def compared(placed: DataFrame, kernel, data: str) -> DataFrame:
        """What ``kernel`` passes on of (tile, piece, part, id, comp) rows with their ``data``."""
        if data == "bits":
            own = prints
        else:
            placed = materialise(placed, "placed")
            own = sets_of(texts, words, placed.select("id"), marks=False).withColumn("n", F.size("shingles").cast("long"))
        ready = placed.join(own, "id").select("tile", "piece", "part", "id", "comp", "n", data)
        ready = ready.repartition("tile", "piece").sortWithinPartitions("tile", "piece", "part", "id")
        return ready.mapInArrow(kernel, "a long, b long")

    def settled(pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b): each b meets its a, in lanes if an a has many."""
        lanes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIECE_MEMBERS).cast("int").alias("pieces"))
        leads = lanes.select(F.col("a").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("part"), F.col("a").alias("id"))
        others = pairs.join(lanes, "a").select(F.col("a").alias("tile"), F.pmod(F.xxhash64("b"), "pieces").cast("int").alias("piece"), F.lit(1).alias("part"), F.col("b").alias("id"))
        return compared(_label(leads.union(others), "id", comps, "comp"), lambda batches: _tiles(batches, percent), "shingles")

    for turn in range(TURNS):
        # every member with its tile's lead; of its leads the likeliest
        near = can_link(F.col("n"), F.col("left"), F.col("lead.n"), F.col("lead.left"), percent)
        met = open_rows.where("comp <> lead.comp").where(near).select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct()
        best = bounded(met).groupBy("b").agg(F.max_by("a", F.struct("like", -F.col("a"))).alias("a"))
        best = materialise(best.select("a", "b"), "pairs")
        old = links, comps, best
        links = materialise(links.union(settled(best)), "links")
        comps = materialise(components(links), "components")
        discard(*old)
        before = open_rows
        open_rows = materialise(opened(open_rows, F.xxhash64("id", F.lit(turn))), "open")
        discard(before)
        unsettled = open_rows.agg(F.count_distinct("id")).first()[0]
        if unsettled < FEW:
            break
    if unsettled:
        one, two = (open_rows.where(F.col("size") <= SMALL).select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "left", "first", "comp"))) for side in "ab")
        met = one.join(two, "key").where("id_a < id_b AND comp_a <> comp_b AND (first_a OR first_b)")
        met = met.where(can_link(F.col("n_a"), F.col("left_a"), F.col("n_b"), F.col("left_b"), percent))
        met = bounded(met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())
        pairs = materialise(met.select("a", "b"), "pairs")
        # members of many pairs, and all of large tiles, meet what these chain them to
        many = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > NAMED).select("id")
        a, b = (many.select(F.col("id").alias(x), F.lit(True).alias(f"many_{x}")) for x in "ab")
        pairs = pairs.join(a, "a", "left").join(b, "b", "left").select("a", "b", F.coalesce("many_a", "many_b", F.lit(False)).alias("many"))
        ties = pairs.where("many").select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("id"))
        pairs = pairs.where("NOT many").select("a", "b")
        chain = materialise(open_rows.where(F.col("size") > SMALL).select("key", "id").union(ties), "chain")
        if not chain.isEmpty():
            chained = materialise(_clusters(chain, comps, prints.select("id", "n")), "clusters")
            possible = materialise(compared(_placed(chained, PIECE_MARKED), lambda batches: _marked(batches, percent, NAMED), "bits"), "pairs")
            many = many.union(possible.where("b IS NULL").select(F.col("a").alias("id"))).distinct().withColumn("lead", F.lit(True))
            rest = chained.drop("lead").join(many, "id", "left").withColumn("lead", F.coalesce("lead", F.lit(False)))
            if not many.isEmpty():
                links = links.union(compared(_placed(rest, PIECE_SHINGLES), lambda batches: _tiles(batches, percent), "shingles"))
            pairs = pairs.union(possible.where("b IS NOT NULL")).distinct()
        links = links.union(settled(pairs))
        comps = materialise(components(materialise(links, "links")), "components")
    named = _label(rows.select("id", *ident).join(classes, ident, "left"), "rep", comps, "c")
    return named.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"),
    )
