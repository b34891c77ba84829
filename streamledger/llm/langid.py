"""Language identification with spans.

Training counts character trigrams (hashed) and scripts per language over all training
documents; the model is a table of fixed height times the number of languages. A word's
script narrows its candidate languages to those that use the script; the candidates are
scored by trigram log-probabilities; and Viterbi with a penalty for switching labels the
words of a document, so that a passage in another language becomes a span of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, byte_column, mix64, prepare

#: Hash buckets for trigrams: the model's height, whatever the corpus.
BUCKETS = 1 << 16
#: A language uses a script if at least this share of its training letters are in it.
SCRIPT_SHARE = 0.001
#: Added to every trigram count.
SMOOTHING = 0.5
#: Log-probability that a switch of language between neighbouring words costs.
SWITCH = 12.0
UNKNOWN = "und"

# fixed values: code-point ranges of the scripts that are told apart (first, last, script)
SCRIPT_RANGES = (
    (0x0041, 0x024F, "Latin"), (0x0250, 0x02FF, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"), (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x06FF, "Arabic"), (0x0700, 0x074F, "Syriac"),
    (0x0750, 0x077F, "Arabic"), (0x08A0, 0x08FF, "Arabic"), (0x0900, 0x097F, "Devanagari"), (0x0980, 0x09FF, "Bengali"),
    (0x0A00, 0x0A7F, "Gurmukhi"), (0x0A80, 0x0AFF, "Gujarati"), (0x0B00, 0x0B7F, "Oriya"), (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"), (0x0C80, 0x0CFF, "Kannada"), (0x0D00, 0x0D7F, "Malayalam"), (0x0D80, 0x0DFF, "Sinhala"),
    (0x0E00, 0x0E7F, "Thai"), (0x0E80, 0x0EFF, "Lao"), (0x0F00, 0x0FFF, "Tibetan"), (0x1000, 0x109F, "Myanmar"),
    (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1200, 0x139F, "Ethiopic"), (0x1780, 0x17FF, "Khmer"),
    (0x1800, 0x18AF, "Mongolian"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"), (0x2C60, 0x2C7F, "Latin"),
    (0x2DE0, 0x2DFF, "Cyrillic"), (0x3040, 0x309F, "Hiragana"), (0x30A0, 0x30FF, "Katakana"), (0x3130, 0x318F, "Hangul"),
    (0x3400, 0x4DBF, "Han"), (0x4E00, 0x9FFF, "Han"), (0xA640, 0xA69F, "Cyrillic"), (0xA720, 0xA7FF, "Latin"),
    (0xAC00, 0xD7FF, "Hangul"), (0xF900, 0xFAFF, "Han"), (0xFB50, 0xFDFF, "Arabic"), (0xFE70, 0xFEFF, "Arabic"),
    (0xFF66, 0xFF9D, "Katakana"), (0x20000, 0x323AF, "Han"),
)
SCRIPTS = ("Other", *sorted({name for _, _, name in SCRIPT_RANGES}))

_points: tuple[np.ndarray, np.ndarray] | None = None


def _point_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: the script's number, or -1 if it isn't a letter; its lower case."""
    global _points
    if _points is None:
        script = np.zeros(0x110000, np.int8)
        for first, last, name in SCRIPT_RANGES:
            script[first : last + 1] = SCRIPTS.index(name)
        script[~np.array([chr(i).isalpha() for i in range(0x110000)])] = -1
        lower = np.arange(0x110000, dtype=np.uint32)
        for i in np.flatnonzero(script >= 0).tolist():
            x = chr(i).lower()
            if len(x) == 1:
                lower[i] = ord(x)
        _points = script, lower
    return _points


@dataclass
class Words:
    """Words (runs of letters) of a block: document, letters, script, and per letter a bucket."""

    doc: np.ndarray
    first: np.ndarray
    size: np.ndarray
    script: np.ndarray
    bucket: np.ndarray


def find_words(data: np.ndarray, offs: np.ndarray) -> Words:
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != len(lead):  # not UTF-8: read every document on its own
        texts = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offs, offs[1:])]  # noqa: B905
        offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return find_words(np.frombuffer(b"".join(texts), np.uint8), offs)
    script_of, lower = _point_tables()
    script = script_of[points]
    letter = script >= 0
    bounds = np.searchsorted(lead, offs)
    cut = np.zeros(len(points) + 1, bool)  # a document starts here
    cut[bounds] = True
    at = np.flatnonzero(letter)
    if not len(at):
        z = np.zeros(0, np.int64)
        return Words(z, z, z, z, z)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | cut[at[1:]]
    first = np.flatnonzero(new)
    low = lower[points[at]].astype(np.uint64)
    before, after = np.zeros_like(low), np.zeros_like(low)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[new] = 0
    after[np.append(first[1:], len(at)) - 1] = 0
    bucket = mix64((before << np.uint64(42)) | (low << np.uint64(21)) | after) >> np.uint64(48)
    return Words(
        doc=np.searchsorted(bounds, at[first], "right") - 1,
        first=first,
        size=np.diff(np.append(first, len(at))),
        script=script[at[first]].astype(np.int64),
        bucket=bucket.astype(np.int64),
    )


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # (BUCKETS, languages)
    uses: np.ndarray  # (scripts, languages): all True in a row that no language uses

    def word_scores(self, words: Words) -> np.ndarray:
        scores = np.add.reduceat(self.logp[words.bucket], words.first, axis=0)
        scores[~self.uses[words.script]] = -1e6
        return scores


def viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word. Documents are word ranges (starts, sizes); one step handles
    the t-th word of all documents that have one."""
    n, k = scores.shape
    labels = np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0] if len(sizes) else 0), "right")
    back = np.zeros((n, k), np.uint8 if k < 256 else np.int32)
    own = np.arange(k)
    best = np.zeros((len(sizes), k), np.float32)
    ends = np.zeros(len(sizes), np.int64)
    for t, m in enumerate(active.tolist()):
        at = starts[:m] + t
        prev = best[:m]
        if t:
            top = prev.argmax(1)
            jump = prev[np.arange(m), top][:, None] - np.float32(switch)
            stay = prev >= jump
            back[at] = np.where(stay, own, top[:, None])
            prev = np.maximum(prev, jump)
        now = scores[at] + prev
        best[:m] = now - now.max(1)[:, None]
    ends = best.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        labels[at] = ends[:m]
        ends[:m] = back[at, ends[:m]]
    return labels


def train(docs: DataFrame, lang: Column, text: Column, use: Column) -> Model:
    """Counts over every training document (``use`` true, ``lang`` not NULL). Each task sends
    one row per language and non-empty bucket; the summed table has at most languages times
    (buckets + scripts) rows, which is what the driver reads."""
    prepare(docs.sparkSession)
    height = BUCKETS + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                words = find_words(raw, at)
                if not len(words.doc):
                    continue
                known = sorted(set(names[lo:hi]))
                number = {x: i for i, x in enumerate(known)}
                of_doc = np.array([number[x] for x in names[lo:hi]], np.int64)
                of_word = of_doc[words.doc]
                cells = np.repeat(of_word, words.size) * height + words.bucket
                total = np.bincount(cells, minlength=len(known) * height)
                total += np.bincount(of_word * height + BUCKETS + words.script, words.size, len(known) * height).astype(np.int64)
                for x, row in zip(known, total.reshape(len(known), height), strict=True):
                    tables[x] = tables[x] + row if x in tables else row
        for x, row in tables.items():
            cells = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(cells), pa.string()), pa.array(cells), pa.array(row[cells])], names=["lang", "cell", "n"])

    chosen = docs.where(use & lang.isNotNull() & text.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    sums = chosen.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    rows = sums.toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.zeros((height, len(langs)))
    table[rows["cell"].to_numpy(np.int64), rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)] = rows["n"]
    grams, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    uses = scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(0))
    uses[~uses.any(1)] = True
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), uses)


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH, with_spans: bool = False
) -> DataFrame:
    """One row per document: ``id_col``, ``lang_pred`` (the language of most letters, ties to
    the first by name), ``score`` (its share of the letters), ``n_langs``, and with
    ``with_spans`` the labelled runs of words in order.

    NULL, empty and letterless texts, and an empty model, give ``und`` and score 0. Rows are
    independent; NULL identifiers and repeated rows stay; other columns are ignored. The
    model goes with the tasks: its size is languages times fixed height. No shuffle.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.langs)
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                n = hi - lo
                words = find_words(raw, at)
                pred, score, n_langs = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
                spans: list[list[dict]] = [[] for _ in range(n)]
                if len(words.doc) and k:
                    sizes = np.bincount(words.doc, minlength=n)
                    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                    labels = viterbi(model.word_scores(words), starts, sizes, switch)
                    share = np.bincount(words.doc * k + labels, words.size, n * k).reshape(n, k)
                    letters = share.sum(1)
                    top = share.argmax(1)
                    for i in np.flatnonzero(letters).tolist():
                        pred[i] = model.langs[top[i]]
                    score = np.divide(share.max(1), letters, out=score, where=letters > 0)
                    n_langs = (share > 0).sum(1)
                    if with_spans:
                        change = np.concatenate([[True], (np.diff(labels) != 0) | (np.diff(words.doc) != 0)])
                        first = np.flatnonzero(change)
                        for d, x, m in zip(words.doc[first].tolist(), labels[first].tolist(), np.diff(np.append(first, len(labels))).tolist(), strict=True):
                            spans[d].append({"lang": model.langs[x], "words": m})
                cols = [batch.column(0).slice(lo, n), pa.array(pred), pa.array(score), pa.array(n_langs.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(spans, _SPANS)] * with_spans, names=["__id", "lang_pred", "score", "n_langs"] + ["spans"] * with_spans
                )

    schema = "__id long, lang_pred string, score double, n_langs int" + ", spans array<struct<lang: string, words: int>>" * with_spans
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_col)
