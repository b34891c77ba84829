"""Benchmark decontamination by latent semantic retrieval.

1. TF-IDF (IDF squared) over hashed words; document frequencies are counted over all documents,
   without the words that stand in a copy of an item (a run of ``SEED`` words of it): however
   often an item leaked, its words weigh what they weigh in the rest of the text.
2. A randomised SVD (subspace iteration on A^T A) of the TF-IDF matrix of passages: every
   pass over the passages is a Spark job whose tasks return sums of fixed size (the last one
   only the products of the projected passages that Rayleigh-Ritz needs). It is fitted
   on the passages of the benchmark and of all documents, again without copies of items.
3. Every passage of every document is folded into the latent space (V / sigma) and compared by
   cosine with the benchmark's passages, a stated query set taken in blocks of
   ``BLOCK_ITEMS`` items; a block goes with the tasks. Beside the latent candidates, a place
   where runs of ``SEED`` words cover ``WEAK`` of an item in its order is a candidate: verbatim
   copies don't depend on weights.
4. Candidates are checked on their words: the longest common subsequence of the item and the
   neighbourhood of the passage, relative to the item. From ``STRONG`` on it is a leak; from
   ``WEAK`` on if the item's answer also stands there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_PUNCTUATION, blocks, byte_column, discard, doc_columns, give_back, materialise, mix64, prefix_hash, prepare, span_hash, tidy, word_spans

#: Hashed vocabulary, latent dimensions, extra dimensions while iterating, passes.
FEATURES, LATENT, EXTRA, PASSES = 1 << 14, 128, 16, 2
#: A passage is two neighbouring halves of this many words; passages overlap by a half.
HALF = 16
#: Tasks per core, at most, in a pass of the iteration; each returns FEATURES * (LATENT + EXTRA) numbers.
TASKS_PER_CORE = 2
#: Words that a pass of the iteration handles at once.
PASS_WORDS = 1 << 17
BLOCK_ITEMS = 2048
COSINE, STRONG, WEAK = 0.36, 0.7, 0.5
#: Words at an item's end that stand for its answer when the benchmark has no answer column.
ANSWER_WORDS = 5
#: Items of fewer words are found by their whole words in a row only; single words aren't
#: distinctive and are ignored.
LEAST_WORDS = 5
#: Words of a run that marks a copy, and the bits of the fixed-size filter of such runs.
SEED = LEAST_WORDS
FILTER_BITS = 26
#: Leading bits of a run's hash by which a block of items tells most runs that it doesn't hold.
SEEN_BITS = 20
_FEATURE_ROWS = 1024
#: Sums that are made at once: they and what is added stay in a core's cache.
_SUMS = 512


def _unspaced() -> np.ndarray:
    """Per first two bytes of a character: its length if its script is written without spaces
    (Thai, Lao, Myanmar, Khmer, kana, Han), else 0."""
    out = np.zeros(1 << 16, np.uint8)
    ranges = [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
    for first, last in ranges:
        for c in range(first, last + 1, 64):
            raw = chr(c).encode()
            out[raw[0] << 8 | raw[1]] = len(raw)
    return out


_UNSPACED = _unspaced()


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (texts come in lower case), and words per document. A
    character of a script without spaces is a word."""
    start, end, per_doc = word_spans(data, offs, IS_PUNCTUATION)
    high = np.flatnonzero(data[:-1] >= 0xE0)
    size = _UNSPACED[data[high].astype(np.int64) << 8 | data[high + 1]]
    lone, size = high[size > 0], size[size > 0]
    if len(lone):
        after = lone + size
        after = after[after < len(data)]
        cut = np.zeros(len(data), bool)
        cut[start] = cut[lone] = True
        cut[after[~IS_PUNCTUATION[data[after]]]] = True
        parts = np.flatnonzero(cut)
        end = np.minimum(np.append(parts[1:], len(data)), end[np.searchsorted(start, parts, "right") - 1])
        start, per_doc = parts, np.diff(np.searchsorted(parts, offs))
    return span_hash(prefix_hash(data), start, end), per_doc


def _features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _runs(words: np.ndarray, per_doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``n`` words inside a document."""
    ends = np.repeat(np.cumsum(per_doc), per_doc)
    at = np.flatnonzero(np.arange(len(words)) + n <= ends)
    h = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(h)]
    return mix64(h[at]), at


def _without_copies(words: np.ndarray, per_doc: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and words per document, without those in a run whose bit is set in ``marks``."""
    h, at = _runs(words, per_doc, SEED)
    bit = h >> np.uint64(64 - FILTER_BITS)
    at = at[marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0]
    if not len(at):
        return words, per_doc
    keep = np.ones(len(words), bool)
    for j in range(SEED):
        keep[at + j] = False
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    return words[keep], np.bincount(doc[keep], minlength=len(per_doc))


def item_runs(items: DataFrame) -> np.ndarray:
    """Packed filter of the runs of SEED words of all items; 2**FILTER_BITS bits at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(0))
            for _, _, raw, at in blocks(data, offs):
                h, _ = _runs(*_words(raw, at), SEED)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64))], names=["b"])

    bits = items.select("__text").mapInArrow(run, "b long").distinct().toPandas()["b"].to_numpy(np.int64)
    marks = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    np.bitwise_or.at(marks, bits >> 3, np.left_shift(1, bits & 7).astype(np.uint8))
    return marks


def _halves(per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word position where each half starts, and its document."""
    n = -(-per_doc // HALF)
    doc = np.repeat(np.arange(len(per_doc)), n)
    first_word = np.cumsum(per_doc) - per_doc
    first_half = np.cumsum(n) - n
    return first_word[doc] + (np.arange(len(doc)) - first_half[doc]) * HALF, doc


def _half_sums(feature: np.ndarray, start: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of the table's rows over each half; ``ends`` is the end of the half's document."""
    half = np.zeros((len(start), table.shape[1]), np.float32)
    whole = start + HALF <= ends
    full, rest = np.flatnonzero(whole), np.flatnonzero(~whole)
    buffer = np.empty((min(_SUMS, len(full)), table.shape[1]), np.float32)
    for lo in range(0, len(full), _SUMS):
        at = start[full[lo : lo + _SUMS]]
        sums, more = table.take(feature[at], axis=0), buffer[: len(at)]
        for j in range(1, HALF):  # the j-th word of every half
            sums += table.take(feature[at + j], axis=0, out=more, mode="clip")
        half[full[lo : lo + _SUMS]] = sums
    for j in range(HALF):
        rest = rest[start[rest] + j < ends[rest]]
        half[rest] += table[feature[start[rest] + j]]
    return half


def _add_rows(total: np.ndarray, feature: np.ndarray, half: np.ndarray, z: np.ndarray) -> None:
    """Adds to the feature's row of ``total`` the row of ``z`` of its half, for every word:
    frequent features by a product with their counts per half, others occurrence by occurrence."""
    often = np.flatnonzero(np.bincount(feature, minlength=FEATURES) >= max(24, len(z) // 40))
    rank = np.full(FEATURES, -1)
    rank[often] = np.arange(len(often))
    rank = rank[feature]
    hit = rank >= 0
    counts = np.zeros(len(often) * len(z), np.float32)
    np.add.at(counts, rank[hit] * len(z) + half[hit], np.float32(1))
    total[often] += counts.reshape(len(often), len(z)) @ z
    feature, half = feature[~hit], half[~hit]
    if not len(feature):
        return
    order = np.argsort(feature.astype(np.uint16), kind="stable")
    feature, half = feature[order], half[order]
    first = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
    size = np.diff(np.append(first, len(feature)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    buffer = np.empty((min(_SUMS, len(first)), z.shape[1]), np.float32)
    for lo in range(0, len(first), _SUMS):
        at, fewer = first[lo : lo + _SUMS], -size[lo : lo + _SUMS]
        sums = z.take(half[at], axis=0)
        for j in range(1, -int(fewer[0])):
            m = int(np.searchsorted(fewer, -j))  # so many features occur more than j times
            sums[:m] += z.take(half[at[:m] + j], axis=0, out=buffer[:m], mode="clip")
        total[feature[at]] += sums


def _used(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(halves that the next half follows, whether a passage starts at each half): the last half
    of a document is a passage only where the document has no other."""
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    use = np.ones(len(doc), bool)
    use[1:] = doc[1:] != doc[:-1]
    use[pair] = True
    return pair, use


def _passages(words: np.ndarray, per_doc: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum of the table's rows over each passage, its first word, its document)."""
    start, doc = _halves(per_doc)
    if not len(start):
        return np.zeros((0, table.shape[1]), np.float32), start, doc
    half = _half_sums(_features(words), start, np.cumsum(per_doc)[doc], table)
    pair, use = _used(doc)
    half[pair] += half[pair + 1]  # a numpy temporary holds the right side: old values are added
    return half[use], start[use], doc[use]


def featurise(texts: DataFrame, marks: np.ndarray | None) -> DataFrame:
    """(``f``, ``own``): the features of the words of every row of ``(__id, __text)``, as unsigned
    16-bit numbers. Documents come with ``marks`` (see ``item_runs``): they lose copies of items;
    without, the rows are the items (``own``)."""
    sent = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                words, per_doc = _words(raw, at)
                if sent.value is not None:
                    words, per_doc = _without_copies(words, per_doc, sent.value)
                ends = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int64) * 2
                f = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(_features(words).astype(np.uint16).tobytes())]
                )
                yield pa.RecordBatch.from_arrays([f.cast(pa.binary()), pa.array(np.full(hi - lo, sent.value is None))], names=["f", "own"])

    return texts.mapInArrow(run, "f binary, own boolean")


def _feature_blocks(column: pa.Array, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, words per document) of runs of whole documents of about ``limit`` words."""
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 2
    buf = column.buffers()[2]
    features = np.frombuffer(buf, np.uint16, len(buf) // 2) if buf is not None else np.zeros(0, np.uint16)
    features = features[offs[0] : offs[-1]]
    for _, _, own, at in blocks(features, offs - offs[0], limit):
        yield own, np.diff(at)


def _distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct cells, occurrences of each): a cell is row * FEATURES + feature. They are sorted
    in 32 bits where they fit."""
    narrow = not len(row) or int(row.max()) < (1 << 32) // FEATURES
    cells = row.astype(np.uint32 if narrow else np.int64) * FEATURES + feature
    cells.sort()
    first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
    return cells[first], np.diff(np.append(first, len(cells)))


def document_frequency(rows: DataFrame) -> np.ndarray:
    """In how many documents each feature occurs (all documents of ``featurise``); FEATURES
    numbers, of which each task sends the non-zero ones. The last entry is the number of
    documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for feature, per_doc in _feature_blocks(batch.column(0), 1 << 17):
                filled = per_doc[per_doc > 0]
                seen = _distinct(np.repeat(np.arange(len(filled)), filled), feature)[0]
                total[:FEATURES] += np.bincount(seen % FEATURES, minlength=FEATURES)
                total[FEATURES] += len(per_doc)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["f", "n"])

    counted = rows.where(~F.col("own")).select("f").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES + 1)
    out[counted["f"].to_numpy(np.int64)] = counted["n"]
    return out


def _squares(feature: np.ndarray, half: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared length of the passage that starts at each half."""
    earlier = np.insert(doc[1:] == doc[:-1], 0, False)[half]
    # passage i: halves i and i + 1 (or i alone at a document's end)
    row = np.concatenate([half, half[earlier] - 1])
    cells, tf = _distinct(row, np.concatenate([feature, feature[earlier]]))
    return np.bincount(cells // FEATURES, np.square(tf * weight[cells % FEATURES]), len(doc))


def _projected(batches: Iterator[pa.RecordBatch], weight: np.ndarray, weighted: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(feature, half of each word, halves that the next one follows, sum of the rows of
    ``weighted`` over the passage that starts at each half, 1 / its squared length or 0)."""
    for batch in batches:
        for feature, per_doc in _feature_blocks(batch.column(0), PASS_WORDS):
            if not len(feature):
                continue
            start, doc = _halves(per_doc)
            half = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(feature))))
            square = _squares(feature, half, doc, weight)
            pair, use = _used(doc)
            z = _half_sums(feature, start, np.cumsum(per_doc)[doc], weighted)
            z[pair] += z[pair + 1]
            yield feature, half, pair, z, np.divide(1, square, out=np.zeros(len(doc)), where=use & (square > 0))


def _task_sums(rows: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], np.ndarray], part_rows: int, kind: type) -> np.ndarray:
    """The sum over all tasks of the matrix ``of_task`` makes of a task's features, added in
    parts of ``part_rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = of_task(batches)
        parts = total.reshape(-1, part_rows, total.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts), dtype=np.int64)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "m"]
        )

    def add(table: pa.Table) -> pa.Table:
        m = sum(np.frombuffer(x.as_py(), kind).astype(np.float64) for x in table["m"])
        return pa.table({"part": table["part"].slice(0, 1), "m": pa.array([m.astype(kind).tobytes()], pa.binary())})

    dealt = rows.select("f").coalesce(max(1, TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism))
    with tidy(rows.sparkSession):
        parts = dealt.mapInArrow(run, "part long, m binary").groupBy("part").applyInArrow(add, "part long, m binary").collect()
    return np.concatenate([np.frombuffer(r["m"], kind).astype(np.float64).reshape(part_rows, -1) for r in sorted(parts)])


def _gram_times(rows: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A^T (A q) for the TF-IDF matrix A of the passages of ``rows`` (as ``featurise`` gives them;
    rows of A of unit length)."""
    sent = rows.sparkSession.sparkContext.broadcast((idf, idf[:, None] * q))

    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weight, weighted = sent.value
        total = np.zeros(weighted.shape, np.float32)
        for feature, half, pair, z, scale in _projected(batches, weight, weighted):
            z *= scale.astype(np.float32)[:, None]
            # a half's words are in the passage it starts and in the one before
            z[pair + 1] += z[pair]
            _add_rows(total, feature, half, z)
        total *= weight[:, None]
        return total

    out = _task_sums(rows, of_task, _FEATURE_ROWS, np.float32)
    sent.destroy()
    return out


def _gram_within(rows: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q^T (A^T A) q for the matrix A of ``_gram_times``: the products of the columns of A q."""
    sent = rows.sparkSession.sparkContext.broadcast((idf, idf[:, None] * q))

    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weight, weighted = sent.value
        total = np.zeros((weighted.shape[1],) * 2)
        for _, _, _, z, scale in _projected(batches, weight, weighted):
            z *= np.sqrt(scale).astype(np.float32)[:, None]
            total += z.T @ z
        return total

    out = _task_sums(rows, of_task, 1, np.float64)
    sent.destroy()
    return out


def latent_space(rows: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Word table of the fold-in: idf * V / sigma, FEATURES x LATENT."""
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((FEATURES, LATENT + EXTRA)))[0].astype(np.float32)
    for _ in range(PASSES - 1):
        q = np.linalg.qr(_gram_times(rows, idf, q))[0].astype(np.float32)
    # the last pass: Rayleigh-Ritz on the subspace needs no more than A^T A within it
    values, vectors = np.linalg.eigh(_gram_within(rows, idf, q))
    top = np.argsort(values)[::-1][:LATENT]
    v, sigma = q @ vectors[:, top], np.sqrt(np.maximum(values[top], 0))
    scale = np.divide(1, sigma, out=np.zeros(LATENT), where=sigma > 1e-6 * max(sigma.max(), 1e-30))
    return (idf[:, None] * v * scale).astype(np.float32)


@dataclass
class Items:
    """A block of the benchmark: its passages' latent directions, and what the word checks need."""

    ids: list[int]
    sizes: list[int]
    masks: list[dict[int, int]]  # per item: word -> bits of its positions
    answers: list[list[int]]
    owner: np.ndarray  # item of each passage
    vectors: np.ndarray
    seeds: tuple[np.ndarray, np.ndarray, np.ndarray]  # sorted run hashes, item and place of each
    short: dict[int, dict[int, list[int]]]  # number of words (under SEED) -> run hash -> identifiers
    seen: np.ndarray  # by the leading SEEN_BITS bits: whether a run hash starts so


def _directions(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _text_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return _words(np.frombuffer(b"".join(raw), np.uint8), offs)


def load_items(rows: list[tuple[int, str, str | None]], table: np.ndarray) -> Items:
    """A block from (identifier, text, answer or None); items of one word are left out."""
    words, per_item = _text_words([t for _, t, _ in rows])
    answer_words, per_answer = _text_words([a or "" for _, _, a in rows])
    ends, answer_ends = np.cumsum(per_item), np.cumsum(per_answer)
    ids, sizes, masks, answers, kept = [], [], [], [], []
    short: dict[int, dict[int, list[int]]] = {}
    for i, (item, _, answer) in enumerate(rows):
        own = words[ends[i] - per_item[i] : ends[i]].tolist()
        if len(own) < LEAST_WORDS:
            if len(own) > 1:
                h, _ = _runs(np.array(own, np.uint64), np.array([len(own)]), len(own))
                short.setdefault(len(own), {}).setdefault(int(h[0]), []).append(item)
            continue
        mask: dict[int, int] = {}
        for p, w in enumerate(own):
            mask[w] = mask.get(w, 0) | 1 << p
        ids.append(item)
        sizes.append(len(own))
        masks.append(mask)
        stated = answer_words[answer_ends[i] - per_answer[i] : answer_ends[i]].tolist()
        answers.append(stated if answer else own[-ANSWER_WORDS:])
        kept.append(own)
    flat = np.array([w for own in kept for w in own], np.uint64)
    per_kept = np.array([len(own) for own in kept], np.int64)
    x, _, owner = _passages(flat, per_kept, table)
    h, at = _runs(flat, per_kept, SEED)
    of = np.repeat(np.arange(len(kept)), per_kept)[at]
    order = np.argsort(h, kind="stable")
    place = at - (np.cumsum(per_kept) - per_kept)[of]
    seen = np.zeros(1 << SEEN_BITS, bool)
    seen[h >> np.uint64(64 - SEEN_BITS)] = True
    return Items(ids, sizes, masks, answers, owner, _directions(x), (h[order], of[order], place[order]), short, seen)


def common_subsequence(size: int, mask: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence of an item (positions as bits) and a list."""
    full = (1 << size) - 1
    open_ = full
    for w in words:
        m = mask.get(w)
        if m:
            hit = open_ & m
            open_ = ((open_ + hit) | (open_ - hit)) & full
    return size - open_.bit_count()


def _in_order(wanted: list[int], words: list[int]) -> bool:
    """Whether ``wanted`` stands in ``words`` as one run."""
    n = len(wanted)
    return bool(n) and any(words[i : i + n] == wanted for i in range(len(words) - n + 1))


def copied_places(words: np.ndarray, per_doc: np.ndarray, block: Items) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, end word) of the places where runs of SEED words of an item
    cover WEAK of it. An item's start is dealt to ranges of its own size, twice (the second time
    shifted by half a size), so a copy with insertions isn't cut by a range's border both times."""
    hashes, owner, place = block.seeds
    h, at = _runs(words, per_doc, SEED)
    likely = np.flatnonzero(block.seen[h >> np.uint64(64 - SEEN_BITS)])  # most runs are in no item
    h, at = h[likely], at[likely]
    lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
    hit = np.flatnonzero(hi > lo)
    if not len(hit):
        return
    many = (hi - lo)[hit]
    entry = np.repeat(lo[hit] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    at, item, q = np.repeat(at[hit], many), owner[entry], place[entry]
    doc = np.searchsorted(np.cumsum(per_doc), at, "right")
    sizes = np.array(block.sizes)
    first_word = np.cumsum(per_doc) - per_doc
    for shift in (0, 1):
        begin = at - q - first_word[doc] + shift * (sizes[item] // 2)
        rows = np.unique(np.stack([doc, item, begin // sizes[item], q], 1), axis=0)
        groups, n = np.unique(rows[:, :3], axis=0, return_counts=True)
        for d, k, b in groups[n + SEED - 1 >= WEAK * sizes[groups[:, 1]]].tolist():
            size = block.sizes[k]
            a = int(first_word[d]) + b * size - shift * (size // 2)
            yield d, k, max(int(first_word[d]), a - HALF), min(int(first_word[d] + per_doc[d]), a + 2 * size + HALF)


def search(texts: DataFrame, items: Items, table: np.ndarray) -> DataFrame:
    """(``id, item, lcs``) for the leaks found in rows of (``__id, __text``)."""
    sent = texts.sparkSession.sparkContext.broadcast((items, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, fold = sent.value
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs, 1 << 19):
                words, per_doc = _words(raw, at)
                x, start, doc = _passages(words, per_doc, fold)
                ends = np.cumsum(per_doc)
                best: dict[tuple[int, int], float] = {}

                def check(d: int, k: int, a: int, b: int) -> None:
                    if best.get((d, k), 0.0) >= 1.0:
                        return
                    near = words[a:b].tolist()
                    share = common_subsequence(block.sizes[k], block.masks[k], near) / block.sizes[k]
                    if share >= STRONG or (share >= WEAK and _in_order(block.answers[k], near)):
                        best[d, k] = max(best.get((d, k), 0.0), share)

                for d, k, a, b in copied_places(words, per_doc, block):
                    check(d, k, a, b)
                for i in range(0, len(x), 1024):
                    alike = _directions(x[i : i + 1024]) @ block.vectors.T >= COSINE
                    p, v = np.divmod(np.flatnonzero(alike), max(1, len(block.vectors)))
                    n = max(1, len(block.ids))
                    tried = np.unique((p + i) * n + block.owner[v])
                    for p, k in zip((tried // n).tolist(), (tried % n).tolist(), strict=True):
                        d, size = int(doc[p]), block.sizes[k]
                        check(d, k, max(int(ends[d] - per_doc[d]), int(start[p]) - size), min(int(ends[d]), int(start[p]) + 2 * HALF + size))
                found = [(d, block.ids[k], share) for (d, k), share in sorted(best.items())]
                for n, known in block.short.items():
                    h, at_word = _runs(words, per_doc, n)
                    hit = np.isin(h, np.fromiter(known, np.uint64, len(known)))
                    where = np.searchsorted(ends, at_word[hit], "right")
                    found += [(d, item, 1.0) for d, x in sorted(set(zip(where.tolist(), h[hit].tolist(), strict=True))) for item in known[x]]
                rows = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.take(pa.array([d for d, _, _ in found], pa.int64())),
                        pa.array([item for _, item, _ in found], pa.int64()),
                        pa.array([share for _, _, share in found], pa.float64()),
                    ],
                    names=["id", "item", "lcs"],
                )

    return texts.mapInArrow(run, "id long, item long, lcs double")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
) -> DataFrame:
    """(``id_col, item_id, lcs``): one row per document and benchmark item found in it.

    NULL and empty texts of documents and items, and items of one word, never match; items of
    fewer than LEAST_WORDS words match where they stand whole. Characters of scripts without
    spaces count as words; an empty benchmark or document table gives an empty result. Repeated rows
    are found like any row; a NULL document identifier is carried as NULL; items of NULL
    identifier are ignored. Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = doc_columns(docs, id_col, text_col).withColumn("__text", F.lower("__text"))
    answer = F.col(answer_col) if answer_col else F.lit(None)
    items = materialise(
        benchmark.select(
            F.col(item_id_col).cast("long").alias("__id"),
            F.lower(item_text_col).alias("__text"),
            F.lower(answer.cast("string")).alias("answer"),
        )
        .where("__id IS NOT NULL AND __text IS NOT NULL")
        .withColumn("block", F.lit(0)),
        "items",
    )
    n_items = items.count()
    none = spark.createDataFrame([], "id long, item long, lcs double")
    if not n_items:
        return none.select(F.col("id").alias(id_col), F.col("item").alias("item_id"), "lcs")
    marks = item_runs(items)
    rows = materialise(featurise(texts, marks).unionByName(featurise(items.select("__id", "__text"), None)), "passages")
    df = document_frequency(rows)
    # squared: rare words decide both in a passage and in the item it is compared with
    idf = np.square(np.log((1 + df[-1]) / (1 + df[:-1]))).astype(np.float32)
    table = latent_space(rows, idf)
    discard(rows)
    give_back()
    n_blocks = -(-n_items // BLOCK_ITEMS)
    blocked = items.withColumn("block", F.pmod(F.xxhash64("__id", "__text"), F.lit(n_blocks)))
    found = none
    for b in range(n_blocks):
        rows = [(r["__id"], r["__text"], r["answer"]) for r in blocked.where(F.col("block") == b).orderBy("__id").collect()]
        found = found.unionByName(search(texts, load_items(rows, table), table))
    return found.select(F.col("id").alias(id_col), F.col("item").alias("item_id"), "lcs")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_items``, ``item_id`` and ``lcs`` (the item found
    most fully, ties to the smallest identifier), ``contaminated``, ``kept``. The cases of
    ``find_leaks`` hold; rows that repeat an identifier share their verdict."""
    leaks = materialise(find_leaks(docs, benchmark, id_col, text_col), "leaks")
    per_doc = leaks.groupBy(id_col).agg(
        F.countDistinct("item_id").alias("n_items"), F.max(F.struct("lcs", (-F.col("item_id")).alias("i"))).alias("best")
    )
    joined = docs.select(id_col).join(per_doc, id_col, "left")
    return joined.select(
        id_col,
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        (-F.col("best.i")).alias("item_id"),
        F.col("best.lcs").alias("lcs"),
        F.col("best").isNotNull().alias("contaminated"),
        F.col("best").isNull().alias("kept"),
    )
