"""Removal of repeated passages by longest-previous-factor tests in suffix order.

A byte is removed if some string of ``length`` bytes that covers it also starts earlier: the
longest previous factor of the string's start is at least ``length``. Suffixes are compared
where repeats can be, not all against all:

1. Anchors. Of the GRAM-byte strings inside a window of ``length`` bytes, those with the
   smallest hash are anchors. Equal windows have equal anchors at equal places, so a window
   that repeats has an anchor that repeats. One byte in 35 is an anchor.
2. Anchors are grouped by hash, first within a block, then by a shuffle. Occurrences that
   agree in all bytes around them have the same windows, so all but the smallest of them are
   settled at once, by hashes; what goes on are anchors whose surroundings differ. An anchor
   that is frequent in a block and differs everywhere is spread and needs no group here.
3. For each anchor left the bytes around it go to the anchor's group. There the suffixes
   right of the anchor, and the reversed prefixes left of it, are put in suffix order with
   the common lengths of neighbours. For each distance d from a window's start to the anchor,
   the windows that agree on d bytes to the left and length - d to the right are the runs of
   suffix order in which the common length stays at ``length``. A window has an earlier match
   exactly if its run holds a smaller position (the previous or next smaller position in
   suffix order lies in the run), that is, unless it is the run's smallest.
4. Groups of more than HOT rows are cut into chunks. A chunk settles its members among
   themselves; the first window of every run goes on by its hash, and the smallest position
   over all chunks stays.

All windows of an anchor overlap it, so what it removes is one interval. Intervals are merged
per document. Windows are judged on the input, and equality on the bytes, or on 128 bits of hashes (of the
anchor and all around it; in chunks of the anchor, the distance and the window).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, byte_column, doc_columns, give_back, materialise, mix64, prefix_hash, prepare, span_hash

GRAM = 32
HOT = 4096
#: Rows of whole groups that are put in suffix order at once.
_ROWS = 24_000
#: Texts that are cut at once.
_TEXTS = 1024
#: Bytes in which anchors are grouped before the shuffle.
_BLOCK = 1 << 21
_NULL_ID = -(2**63)
#: Differing surroundings of one anchor in a block from which on they are spread.
FEW = 32
_REP, _MARKER, _SETTLED, _CANDIDATE = range(4)


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over x[i : i + width] for every i that has that many (doubling)."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def find_anchors(data: np.ndarray, offs: np.ndarray, length: int, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in the block, hash of the gram there) of all anchors."""
    n, width = len(data), length - GRAM + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    h = span_hash(prefix, at, at + GRAM)
    least = _sliding(h, width, np.minimum)  # per window start
    inside = np.zeros(n + 1, np.int32)  # windows that lie in one document
    long_ = np.diff(offs) >= length
    np.add.at(inside, offs[:-1][long_], 1)
    np.add.at(inside, offs[1:][long_] - length + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0
    edge = np.zeros(width - 1, np.uint64)
    covering = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)  # per gram
    pos = np.flatnonzero((covering == h) & (h > 0))
    return pos, h[pos]


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """(``h, f, id, x``) by kind, which ``x`` packs with position and reach. A representative
    or marker has the anchor's hash ``h`` and that of its surroundings ``f``; a block sends one
    representative per (h, f). Settled rows have their interval in ``h`` and ``f``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            ids = batch.column(0).to_numpy()
            for lo, _, raw, at in blocks(data, offs, _BLOCK):
                prefix = prefix_hash(raw)
                pos, h = find_anchors(raw, at, length, prefix)
                if not len(pos):
                    continue
                doc = np.searchsorted(at, pos, "right") - 1
                left = np.minimum(pos - at[doc], length - GRAM)
                right = np.minimum(at[doc + 1] - pos, length)
                f = span_hash(prefix, pos - left, pos + right)
                f = mix64(f + (left << 16 | right).astype(np.uint64))
                own, pos = ids[lo + doc], pos - at[doc]
                order = np.lexsort((pos, own, f, h))
                h, f, own, pos, left, right = (v[order] for v in (h, f, own, pos, left, right))
                new_h = np.append(True, h[1:] != h[:-1])
                new = new_h | np.append(True, f[1:] != f[:-1])
                group = np.cumsum(new_h) - 1
                many = (np.bincount(group, new) > FEW)[group]
                kind = np.where(new, np.where(many, _CANDIDATE, _REP), _SETTLED)
                marker = np.flatnonzero(new_h & many)
                x = pos << 26 | left << 14 | right << 2
                settled = kind == _SETTLED
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.where(settled, pos - left, h.view(np.int64)), h.view(np.int64)[marker]])),
                        pa.array(np.concatenate([np.where(settled, pos + right, f.view(np.int64)), f.view(np.int64)[marker]])),
                        pa.array(np.concatenate([own, own[marker]])),
                        pa.array(np.concatenate([x | kind, x[marker] | _MARKER])),
                    ],
                    names=["h", "f", "id", "x"],
                )

    return texts.mapInArrow(run, "h long, f long, id long, x long")


def repeated(rows: DataFrame) -> DataFrame:
    """(``id, a, b, h, pos``): settled intervals (``a, b``), and anchors to compare (``h, pos``):
    those that have several surroundings."""
    names = ["id", "a", "b", "h", "pos"]

    def out(own: np.ndarray, first: np.ndarray, second: np.ndarray, settled: bool) -> pa.RecordBatch:
        none, pair = pa.nulls(len(own), pa.int64()), [pa.array(first), pa.array(second)]
        return pa.RecordBatch.from_arrays([pa.array(own), *(pair + [none] * 2 if settled else [none] * 2 + pair)], names=names)

    def judge(h: np.ndarray, f: np.ndarray, own: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        new_h = np.append(True, h[1:] != h[:-1])
        new = new_h | np.append(True, f[1:] != f[:-1])
        group = np.cumsum(new_h) - 1
        several = (np.bincount(group, new) + np.bincount(group, x & 3 == _MARKER) > 1)[group]
        later = ~new
        pos = x >> 26
        yield out(own[later], (pos - (x >> 14 & 4095))[later], (pos + (x >> 2 & 4095))[later], True)
        use = new & several
        yield out(own[use], h[use], pos[use], False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # representatives and markers come first, sorted; a hash may go on in the next batch
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)]
            kind = cols[3] & 3
            for k in (_SETTLED, _CANDIDATE):
                at = kind == k
                if at.any():
                    h, f, own, x = (c[at] for c in cols)
                    yield out(own, h, f, True) if k == _SETTLED else out(own, h, x >> 26, False)
            cols = [c[kind < _SETTLED] for c in cols]
            if held:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols, strict=True)]
            if len(cols[0]):
                other = np.flatnonzero(cols[0] != cols[0][-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield from judge(*(c[:cut] for c in cols))
                held = [c[cut:] for c in cols]
        if held and len(held[0]):
            yield from judge(*held)

    passed = F.col("x").bitwiseAND(F.lit(2)) > 0
    routed = rows.repartition(F.when(passed, F.xxhash64("id", "x")).otherwise(F.col("h")))
    return routed.sortWithinPartitions(passed, "h", "f", "id", "x").mapInArrow(run, "id long, a long, b long, h long, pos long")


def surroundings(docs: DataFrame, length: int) -> DataFrame:
    """(``g, h, hot, id, pos, left, right, bytes``) per repeated anchor of rows (``id, text,
    at`` array of (pos, chunks)): the group or chunk, and the bytes around the anchor, of which
    ``left`` before and ``right`` from it on are the document's."""
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = np.arange(-reach, length)
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            list_ends = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).flatten()
            place, chunks = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            ids = batch.column(0).to_numpy()
            per_doc = np.diff(list_ends)
            doc = np.repeat(np.arange(len(ids)), per_doc)
            for a in range(0, len(doc), _ROWS):
                d, p, c = doc[a : a + _ROWS], place[a : a + _ROWS], chunks[a : a + _ROWS]
                spot = offs[d] + p
                index = np.clip(spot[:, None] + around, 0, len(data) - 1)
                text = data[index]
                gram = np.ascontiguousarray(text[:, reach : reach + GRAM]).ravel()
                start = np.arange(len(d)) * GRAM
                h = span_hash_rows(gram, start)
                salt = mix64(mix64(ids[d].astype(np.uint64)) + p.astype(np.uint64)) % c.astype(np.uint64)
                group = mix64(h + salt * np.uint64(0x9E3779B97F4A7C15))
                size = len(around)
                ends = pa.py_buffer((np.arange(len(d) + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group.view(np.int64)),
                        pa.array(h.view(np.int64)),
                        pa.array(c > 1),
                        pa.array(ids[d]),
                        pa.array(p),
                        pa.array(np.minimum(p, reach).astype(np.int32)),
                        pa.array(np.minimum(offs[d + 1] - spot, length).astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(d), [None, ends, pa.py_buffer(np.ascontiguousarray(text))]),
                    ],
                    names=["g", "h", "hot", "id", "pos", "left", "right", "bytes"],
                )

    return docs.mapInArrow(run, "g long, h long, hot boolean, id long, pos long, left int, right int, bytes binary")


def span_hash_rows(grams: np.ndarray, start: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(grams), start, start + GRAM)


def _suffix_order(text: np.ndarray, valid: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows by (group, bytes, valid length), and per row in that order the
    length it has in common with the row before (-1 at a group's start)."""
    n, width = text.shape
    inside = np.arange(width) < valid[:, None]
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = np.where(inside, text, 0)
    keys = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((valid, *keys.T[::-1], group))
    t, v, g = padded[order, :width], valid[order], group[order]
    common = np.full(n, -1)
    differ = t[1:] != t[:-1]
    same = np.where(differ.any(1), differ.argmax(1), width)
    common[1:] = np.where(g[1:] == g[:-1], np.minimum(same, np.minimum(v[1:], v[:-1])), -1)
    return order, common


def earlier_matches(text: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(has, first): per row and distance d whether the window that starts d bytes before the
    anchor has an earlier match, and whether it is the smallest position of its run. Rows are
    in order of group and position."""
    n, reach = len(text), length - GRAM
    has, first = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool)
    forward, common_f = _suffix_order(text[:, reach:], right, group)
    backward, common_b = _suffix_order(text[:, :reach][:, ::-1], left, group)
    run_f, run_b = np.empty(n, np.int64), np.empty(n, np.int64)
    # rows equal to an earlier one in all that is around them match it at every distance
    run_f[forward] = np.cumsum(common_f < right[forward])
    run_b[backward] = np.cumsum(common_b < left[backward])
    full = np.stack([run_f, run_b, right, left], 1)
    order = np.lexsort((np.arange(n), *full.T))
    again = np.zeros(n, bool)
    again[order[1:]] = (full[order[1:]] == full[order[:-1]]).all(1)
    for d in range(reach + 1):
        fits = (left >= d) & (right >= length - d)
        has[again & fits, d] = True
        some = np.flatnonzero(fits & ~again)
        if not len(some):
            continue
        run_f[forward] = np.cumsum(common_f < length - d)
        run_b[backward] = np.cumsum(common_b < d)
        run = run_f[some] * (n + 1) + run_b[some]
        order = np.argsort(run, kind="stable")  # stable: positions stay ascending in a run
        smallest = np.append(True, run[order[1:]] != run[order[:-1]])
        first[some[order[smallest]], d] = True
        has[some[order[~smallest]], d] = True
    return has, first


def match_groups(rows: DataFrame, length: int) -> DataFrame:
    """(``id, a, b, w1, w2``): intervals [a, b) that an anchor removes, and for chunks of hot
    groups the starts ``a`` of windows that are first of their run, with the anchor's position
    in ``b`` and the window's hash."""
    reach = length - GRAM

    def judge(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        col = {c: batch[c].to_numpy() for c in ("g", "h", "hot", "id", "pos", "left", "right")}
        raw = batch["bytes"].combine_chunks()
        text = byte_rows(raw, n, reach + length)
        has, first = earlier_matches(text, col["left"], col["right"], col["g"], length)
        some = np.flatnonzero(has.any(1))
        low, high = has[some].argmax(1), reach - has[some][:, ::-1].argmax(1)
        a, b = col["pos"][some] - high, col["pos"][some] - low + length
        none = pa.nulls(len(some), pa.int64())
        names = ["id", "a", "b", "w1", "w2"]
        yield pa.RecordBatch.from_arrays([pa.array(col["id"][some]), pa.array(a), pa.array(b), none, none], names=names)
        hot = np.flatnonzero(col["hot"])
        for i in range(0, len(hot), 2048):
            part = hot[i : i + 2048]
            r, d = np.nonzero(first[part])
            own = part[r]
            start = r * (reach + length) + reach - d
            w1 = span_hash(prefix_hash(np.ascontiguousarray(text[part]).ravel()), start, start + length)
            w2 = mix64(col["h"][own].astype(np.uint64) + d.astype(np.uint64))
            pos = col["pos"][own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["id"][own]), pa.array(pos - d), pa.array(pos), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64))], names=names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _ROWS:
                table = pa.Table.from_batches(held)
                g = table["g"].to_numpy()
                cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if cut:
                    for i in _cuts(g[:cut]):
                        yield from judge(table.slice(i[0], i[1] - i[0]))
                held = table.slice(cut).to_batches()
                size -= cut
        if size:
            table = pa.Table.from_batches(held)
            for i in _cuts(table["g"].to_numpy()):
                yield from judge(table.slice(i[0], i[1] - i[0]))

    ordered = rows.repartition("g").sortWithinPartitions("g", "id", "pos")
    return ordered.mapInArrow(run, "id long, a long, b long, w1 long, w2 long")


def byte_rows(raw: pa.Array, n: int, width: int) -> np.ndarray:
    offs = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + n + 1]
    return np.frombuffer(raw.buffers()[2], np.uint8)[offs[0] : offs[-1]].reshape(n, width)


def _cuts(g: np.ndarray) -> list[tuple[int, int]]:
    """Pieces of whole groups of about _ROWS rows."""
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    out, lo = [], 0
    while lo < len(g):
        i = int(np.searchsorted(starts, lo + _ROWS))
        hi = len(g) if i >= len(starts) else max(int(starts[i]), lo + 1)
        out.append((lo, hi))
        lo = hi
    return out


def _apply(docs: DataFrame) -> DataFrame:
    """Merge each document's intervals (rows ``id, text, spans``; none, an empty list or NULL)
    and drop the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(lo, _TEXTS)
                data, offs = byte_column(batch.column(1))
                lists = batch.column(2).fill_null(pa.scalar([], batch.column(2).type))
                ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                flat = lists.flatten()
                a, b = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                out: list[tuple[int, int, int, str, bytes]] = []
                for i in range(batch.num_rows):
                    text = data[offs[i] : offs[i + 1]].tobytes()
                    x, y = a[ends[i] : ends[i + 1]], b[ends[i] : ends[i + 1]]
                    starts, stops = [], []
                    if len(x):
                        order = np.argsort(x, kind="stable")
                        x, y = x[order], np.maximum.accumulate(y[order])
                        new = np.append(True, x[1:] > y[:-1])
                        starts = x[new].tolist()
                        stops = y[np.append(np.flatnonzero(new)[1:] - 1, len(y) - 1)].tolist()
                    kept = b"".join(text[p:q] for p, q in zip([0, *stops], [*starts, len(text)], strict=True))
                    out.append((len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out, strict=True)) if out else [[], [], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
                )
            give_back()

    return docs.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes``.

    Texts are UTF-8 bytes; NULL counts as empty; texts shorter than ``length`` keep all.
    "Earlier" means a smaller identifier, or the same one and a smaller start, so identifiers
    should be unique: rows that share one stand at the same place, and neither is earlier. A
    NULL identifier comes before all others. ``kept_bytes`` may cut a character. Other columns
    are ignored; an empty table gives an empty result.
    """
    if not GRAM < length < 4096:
        raise ValueError(f"length must be over {GRAM} and below 4096")
    prepare(docs.sparkSession)
    texts = doc_columns(docs, id_col, text_col).select(F.coalesce("__id", F.lit(_NULL_ID)).alias("id"), F.col("__text").alias("text"))
    found = materialise(repeated(anchors(texts, length)), "anchors")
    hot = found.where("h IS NOT NULL").groupBy("h").count().where(F.col("count") > HOT)
    hot = hot.select("h", F.ceil(F.col("count") / HOT).alias("chunks"))
    compare = found.where("h IS NOT NULL").join(hot, "h", "left").select("id", "a", "b", "pos", "chunks")
    settled = found.where("h IS NULL").select("id", "a", "b", "pos", F.lit(None).cast("long").alias("chunks"))
    per_doc = (
        compare.union(settled)
        .groupBy("id")
        .agg(
            F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("chunks", F.lit(1)).cast("long").alias("chunks")))).alias("at"),
            F.collect_list(F.when(F.col("a").isNotNull(), F.struct("a", "b"))).alias("settled"),
        )
        .withColumn("at", F.sort_array("at"))
    )
    per_doc = materialise(per_doc, "places")
    # texts are joined here and at the end, and never written
    compared = texts.join(per_doc.where(F.size("at") > 0).select("id", "at"), "id").select("id", "text", "at")
    marks = materialise(match_groups(surroundings(compared, length), length), "marks")
    # a window has at most one row per chunk; those that aren't the smallest make one interval
    # per anchor
    least = F.min(F.struct("id", "a")).over(Window.partitionBy("w1", "w2"))
    later = marks.where("w1 IS NOT NULL").withColumn("least", least).where(F.struct("id", "a") != F.col("least"))
    later = later.groupBy("id", F.col("b").alias("pos")).agg(F.min("a").alias("a"), (F.max("a") + length).alias("b"))
    later = later.select("id", "a", "b")
    spans = marks.where("w1 IS NULL").select("id", "a", "b").union(later)
    settled = per_doc.select("id", F.explode("settled").alias("s")).select("id", "s.a", "s.b")
    spans = spans.union(settled).groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cut = _apply(texts.join(materialise(spans, "spans"), "id", "left").select("id", "text", "spans"))
    return cut.select(F.nullif("id", F.lit(_NULL_ID)).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes")
