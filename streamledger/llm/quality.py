"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is over bytes (so any script and any noise is in its alphabet), of order
``ORDER``, trained on all trusted documents, whole, outside the calibration fold. Counts,
continuation counts, context sums and interpolated probabilities are DataFrames keyed by n-gram
and joined by key, shard by shard. The finished table goes with the tasks in pieces of about
``PIECE`` n-grams, one pass over the documents each: the two bytes before a byte decide which
piece scores it, so every byte is scored in one piece. A table of one piece, as is usual, gives
every document, whole, its bits per byte without a shuffle; otherwise the pieces' sums are added
per row.

A document is rejected if its bits per byte lie above what trusted documents of its
language show: thresholds are quantiles per language, with slack for short texts, measured
on trusted documents that the model was not trained on. Where a language has few of them, its
limit comes from its spread and the tail of all languages, so that single odd trusted documents
don't set it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IntTable, blocks, byte_column, give_back, materialise, prepare

ORDER = 5
#: N-grams and contexts of the table that go with the tasks at once.
PIECE = 1 << 20
#: Identifiers of trusted documents that go with the tasks at once, a pass over the documents each;
#: where that takes more than PASSES passes, texts are shuffled to the identifiers instead.
TRUSTED, PASSES = 1 << 20, 8
#: One fold of the trusted documents in so many sets the thresholds.
FOLDS = 4
#: Quantile of trusted documents' excess that is the limit, and the one that tells the spread.
QUANTILE, BODY = 0.99, 0.9
#: Documents that all languages together count for beside a language's own median, spread and limit.
MEDIAN_PRIOR, SPREAD_PRIOR, TAIL_PRIOR = 2, 10, 1000
#: Bytes from which on a longer text has no smaller slack.
STEADY = 1024
_ALL = "*"
_PAD = 10  # a line feed stands before a document's first byte


def _codes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per byte the number made of it and the ORDER - 1 bytes before it (line feeds before a
    document's start)."""
    n_docs, ahead = len(offs) - 1, ORDER - 1
    padded = np.full(len(data) + n_docs * ahead, _PAD, np.int64)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n_docs + 1) * ahead, np.diff(offs))
    padded[at] = data
    code = padded.copy()
    for j in range(1, ORDER):
        code[j:] |= padded[:-j] << (8 * j)
    return code[at]


def count_grams(texts: DataFrame) -> DataFrame:
    """(``g``, ``n``): occurrences of every byte n-gram of order ORDER in a one-column frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(0))
            for _, _, raw, at in blocks(data, offs):
                g, n = np.unique(_codes(raw, at), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n.astype(np.int64))], names=["g", "n"])

    return texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def kneser_ney(top: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1 ... ORDER: (``g, p``) interpolated probabilities of the n-grams seen, and
    (``h, gamma``) the weight a context leaves to the next lower order."""
    counts = {ORDER: materialise(top, "grams")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct bytes before the suffix
        suffix = F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1))
        counts[k] = materialise(counts[k + 1].groupBy(suffix.alias("g")).agg(F.count(F.lit(1)).alias("n")), "grams")
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        c = counts[k]
        tally = c.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (max(1, x) for x in tally)
        y = n1 / (n1 + 2 * n2)
        d1, d2, d3 = (min(max(0.05, x), i - 0.05) for i, x in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context = F.shiftright("g", 8)
        h = c.groupBy(context.alias("h")).agg(F.sum("n").alias("total"), F.sum(discount).alias("freed"))
        h = h.select("h", "total", (F.col("freed") / F.col("total")).alias("gamma"))
        if k == 1:
            lower = F.lit(1 / 256)
            joined = c.withColumn("h", context).join(h, "h")
        else:
            lower = F.col("lower")
            below = out[-1][0].select(F.col("g").alias("suffix"), F.col("p").alias("lower"))
            joined = c.withColumn("h", context).withColumn("suffix", F.col("g").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
            joined = joined.join(h, "h").join(below, "suffix")
        p = (F.col("n") - discount) / F.col("total") + F.col("gamma") * lower
        out.append((materialise(joined.select("g", p.alias("p")), "probabilities"), h.select("h", "gamma")))
    return out


@dataclass
class Piece:
    """Sorted arrays per order; turned into lookup tables inside a worker."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    key: int

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """-log2 of the probability of the last byte of every n-gram."""
        p, gamma = _tables(self)
        out = np.empty(len(codes), np.float32)
        left, weight = np.arange(len(codes)), np.zeros(len(codes), np.float32)
        for k in range(ORDER, 0, -1):
            now = codes[left] & ((1 << 8 * k) - 1)
            got = p[k - 1].get(now)
            hit = got > 0
            out[left[hit]] = weight[hit] - np.log2(got[hit])
            left, weight, now = left[~hit], weight[~hit], now[~hit]
            if not len(left):
                return out
            weight = weight - np.log2(gamma[k - 1].get(now >> 8))
        out[left] = weight + 8
        return out


@dataclass
class Model:
    """Per order 1 ... ORDER what ``kneser_ney`` gives, and the number of pieces."""

    levels: list[tuple[DataFrame, DataFrame]]
    n_pieces: int

    def piece(self, i: int) -> Piece:
        """The n-grams and contexts of the bytes that piece ``i`` scores; those of too few bytes
        to hold the two before the last are in every piece."""

        rows = None
        for k, (p, h) in enumerate(self.levels, 1):
            for at, (df, key, value) in enumerate(((p, "g", "p"), (h, "h", "gamma"))):
                if k > 2 and self.n_pieces > 1:
                    before = F.shiftright("g", 8) if at == 0 else F.col("h")
                    df = df.where(_piece_of(before, self.n_pieces) == i)
                df = df.select(F.lit(2 * k + at).alias("part"), F.col(key).alias("key"), F.col(value).cast("float").alias("value"))
                rows = df if rows is None else rows.unionByName(df)
        t = rows.toArrow()
        part, keys, values = (t[c].to_numpy() for c in ("part", "key", "value"))

        def arrays(number: int) -> tuple[np.ndarray, np.ndarray]:
            own = np.flatnonzero(part == number)
            own = own[np.argsort(keys[own], kind="stable")]
            return keys[own], values[own]

        grams, contexts = ([arrays(2 * k + at) for k in range(1, ORDER + 1)] for at in (0, 1))
        return Piece(grams, contexts, hash(tuple(x[1].tobytes() for x in grams + contexts)))


def _piece_of(before: Column | np.ndarray, n: int) -> Column | np.ndarray:
    """The piece that scores a byte, by the bytes before it (the lowest two count)."""
    if isinstance(before, Column):
        return (before.bitwiseAND(F.lit(0xFFFF)) * F.lit(40503)).bitwiseAND(F.lit(0xFFFF)) % F.lit(n)
    return ((before & 0xFFFF) * 40503 & 0xFFFF) % n


_ready: dict[int, tuple[list[IntTable], list[IntTable]]] = {}


def _tables(model: Piece) -> tuple[list[IntTable], list[IntTable]]:
    if model.key not in _ready:
        _ready.clear()
        _ready[model.key] = [IntTable(*x, 0.0) for x in model.grams], [IntTable(*x, 1.0) for x in model.contexts]
    return _ready[model.key]


def fold_column(id_col: str) -> Column:
    """0: a trusted document calibrates the thresholds; 1 ... FOLDS - 1: it may train the model."""
    return F.pmod(F.xxhash64(F.lit("fold"), F.col(id_col)), F.lit(FOLDS))


def trusted_grams(texts: DataFrame, fit: DataFrame) -> DataFrame:
    """``count_grams`` of the rows of ``texts`` (``id, text``) whose identifier is in ``fit``
    (``id``, distinct). Identifiers come to the texts, which stay where they are read."""
    n = max(1, -(-fit.count() // TRUSTED))
    if n > PASSES:
        return count_grams(texts.join(fit, "id", "left_semi").select("text"))
    parts = None
    for i in range(n):
        piece = fit if n == 1 else fit.where(F.pmod(F.xxhash64(F.lit("piece"), "id"), F.lit(n)) == i)
        part = count_grams(texts.join(F.broadcast(piece), "id", "left_semi").select("text"))
        if n == 1:
            return part
        part = materialise(part, "grams")  # so that one piece is with the tasks at a time
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("g").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trained on all trusted documents outside the calibration fold, whole. ``trusted_ids`` has
    one column, ``id``. Without such documents every probability is 1/256."""
    prepare(docs.sparkSession)
    fit = materialise(trusted_ids.where(fold_column("id") > 0).distinct(), "trusted")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    levels = kneser_ney(trusted_grams(texts, fit))
    size = sum(p.count() for p, _ in levels)
    return Model(levels, max(1, -(-size // PIECE)))


def _bits(rows: DataFrame, sent: Broadcast[Piece], keep: list[str], i: int, n_pieces: int) -> DataFrame:
    """The columns ``keep`` with ``n_bytes`` and the sum ``bits`` of the bytes that piece ``i`` scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = byte_column(batch.column(len(keep)))
            for lo, hi, raw, at in blocks(data, offs):
                codes = _codes(raw, at)
                if n_pieces > 1:
                    here = np.flatnonzero(_piece_of(codes >> 8, n_pieces) == i)
                    own = np.zeros(len(codes))
                    own[here] = sent.value.bits(codes[here])
                else:
                    own = sent.value.bits(codes)
                bits = np.concatenate([[0.0], np.cumsum(own, dtype=np.float64)])
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(np.diff(at)), pa.array(bits[at[1:]] - bits[at[:-1]])], names=[*keep, "n_bytes", "bits"]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
    return rows.select(*keep, "__text").mapInArrow(run, ", ".join([*fields, "n_bytes long", "bits double"]))


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_bytes`` and ``bits`` (mean -log2 p per byte; perplexity is
    2 ** bits). NULL and empty texts: 0 bytes, bits NULL."""
    prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    if model.n_pieces == 1:
        summed = _bits(rows, sc.broadcast(model.piece(0)), keep, 0, 1)
    else:  # rows are told apart by their place in a written copy
        numbered = materialise(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
        parts = None
        for i in range(model.n_pieces):
            sent = sc.broadcast(model.piece(i))
            part = materialise(_bits(numbered, sent, ["__row"], i, model.n_pieces), "bits")
            sent.destroy()
            parts = part if parts is None else parts.unionByName(part)
            give_back()
        sums = parts.groupBy("__row").agg(F.max("n_bytes").alias("n_bytes"), F.sum("bits").alias("bits"))
        summed = numbered.select("__row", *keep).join(sums, "__row").drop("__row")
    mean = F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes"))
    return summed.select(*keep, "n_bytes", mean.alias("bits"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quality_col: str = "quality",
) -> DataFrame:
    """One row per document: ``id_col, lang, n_bytes, bits, perplexity, excess, threshold, kept``.

    ``excess`` is (bits - ``median``) * sqrt(bytes), by the median bits of trusted documents of
    the language: the mean over n bytes scatters like 1 / sqrt(n), so short documents get the
    slack they need. Bytes count up to STEADY: longer documents differ by what they are about,
    not by chance. ``threshold`` is the QUANTILE of the excess of trusted documents of the
    calibration fold, a mean of two estimates: the language's own quantile (weight: its n
    documents), and its distance from the middle to BODY, times what the QUANTILE is of that
    distance in all languages together (weight: TAIL_PRIOR). Median and distance lean on all
    languages by MEDIAN_PRIOR and SPREAD_PRIOR documents; unknown languages and NULL use all
    languages together. A document is rejected above its threshold.

    ``labels`` holds trusted documents (``quality_col`` = 1) by ``id_col``; other values, NULLs
    and repeated rows there are no evidence. NULL and empty texts have no perplexity and are
    kept, as is everything when nothing is trusted. Repeated rows and NULL identifiers are
    judged like any row. Other columns are ignored.
    """
    trusted = labels.where(F.col(quality_col) == 1).select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    model = train(rows, trusted, "id", "text")
    scored = materialise(score(rows.withColumn("text_hash", F.xxhash64("text")), model, ["id", "lang", "text_hash"]), "scores")
    fit = scored.where((fold_column("id") == 0) & F.col("bits").isNotNull()).join(trusted, "id", "left_semi")
    fit = materialise(fit.select("lang", "bits", "n_bytes"), "calibration")
    fit = fit.withColumn("lang", F.explode(F.array("lang", F.lit(_ALL)))).where("lang IS NOT NULL")
    own = fit.groupBy("lang").agg(F.percentile_approx("bits", 0.5, 10_000).alias("own"), F.count(F.lit(1)).alias("n"))
    own = materialise(own, "medians")

    def leaning(value: Column, pooled: float, prior: int) -> Column:
        return (F.col("n") * value + F.lit(float(prior * pooled))) / (F.col("n") + prior)

    # one row (or none) for all languages together
    all_own = own.where(F.col("lang") == _ALL).first()
    middle = own.select("lang", "n", leaning(F.col("own"), all_own["own"] if all_own else 0.0, MEDIAN_PRIOR).alias("median"))
    excess = (F.col("bits") - F.col("median")) * F.sqrt(F.least("n_bytes", F.lit(STEADY)))
    tails = fit.join(middle, "lang").groupBy("lang").agg(
        F.first("median").alias("median"), F.first("n").alias("n"), F.percentile_approx(excess, [0.5, BODY, QUANTILE], 10_000).alias("q")
    )
    tails = materialise(tails.select("lang", "median", "n", F.col("q")[2].alias("tail"), (F.col("q")[1] - F.col("q")[0]).alias("spread")), "tails")
    every = tails.where(F.col("lang") == _ALL).first()
    tail, spread = (every["tail"], every["spread"]) if every else (0.0, 0.0)
    steep = leaning(F.col("spread"), spread, SPREAD_PRIOR) * F.lit(tail / spread) if spread > 0 else F.lit(tail)
    threshold = (F.col("n") * F.col("tail") + TAIL_PRIOR * steep) / (F.col("n") + TAIL_PRIOR)
    limits = materialise(tails.select("lang", "median", threshold.alias("threshold")), "limits")
    pooled = limits.where(F.col("lang") == _ALL).select(F.col("median").alias("median_all"), F.col("threshold").alias("threshold_all"))
    of_lang = limits.where(F.col("lang") != _ALL)
    # one row (or none) for all languages together
    row = pooled.first()
    judged = scored.join(of_lang, "lang", "left")
    for c in ("median", "threshold"):
        judged = judged.withColumn(c, F.coalesce(c, F.lit(row[f"{c}_all"] if row else None).cast("double")))
    return judged.select(
        F.col("id").alias(id_col),
        F.col("lang"),
        "text_hash",
        "n_bytes",
        "bits",
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        excess.alias("excess"),
        "threshold",
        F.coalesce(excess <= F.col("threshold"), F.lit(True)).alias("kept"),
    )
