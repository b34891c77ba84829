"""Hierarchical Pitman-Yor language model.

A token's restaurant is its context: the class of the token before it (a hash of its last
letters; the start of a text is a class of its own), ``CONTEXTS`` in all. All context
restaurants share one parent, the restaurant of all tokens, whose base is uniform over the
known tokens and one for all others.

Counts of (token, context) pairs are aggregated into one row per token, spread by token hash,
so a token's customers in every restaurant and its tables in the parent are in one place. A
Gibbs sweep seats all customers anew, given the restaurants' table totals of the sweep before;
its only global state are those totals, a few hundred numbers that Spark sums. Uniform
variates are hashes of (pair, sweep, step): any lost task is repeated exactly. After
``BURN_IN`` sweeps, ``SAMPLES`` seatings are kept and their predictive probabilities averaged.

Documents are scored in one pass. The ``HEAD`` most frequent tokens go with the tasks as a
table of fixed size; other tokens are sent, summed per document, to the row of their token by
a shuffle join, so nothing that grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    IS_PUNCTUATION,
    IntTable,
    blocks,
    byte_column,
    materialise,
    mix64,
    prefix_hash,
    prepare,
    span_hash,
    word_spans,
)

CONTEXTS = 256
BURN_IN, SAMPLES = 2, 3
#: Most frequent tokens that go with the tasks; bounds that table to HEAD * CONTEXTS numbers.
HEAD = 1 << 16
#: Concentrations of the context restaurants and of their parent.
CONTEXT_CONCENTRATION = PARENT_CONCENTRATION = 1.0
#: Customers seated one by one; from there on, blocks of a sixteenth of those seated.
ONE_BY_ONE = 64
#: (token, context) pairs that a counting task holds before it passes them on.
HELD_PAIRS = 2_000_000
#: Tokens are hashes of so many bits, so that token and context fit a signed 64-bit number.
TOKEN_BITS = 55
_SHIFT = np.uint64(64 - TOKEN_BITS)
_END = mix64(np.array([12345], np.uint64))[0] >> _SHIFT


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, document) of every token: the lower-cased words and an end per
    document. Tokens are hashes."""
    start, end, per_doc = word_spans(data, offs)
    n_docs, n_words = len(per_doc), len(start)
    words = span_hash(prefix_hash(data, lower=True), start, end) >> _SHIFT
    doc = np.repeat(np.arange(n_docs), per_doc)
    place = np.arange(n_words) + doc
    out = np.full(n_words + n_docs, _END, np.uint64)
    out[place] = words
    # class of a word: its last two bytes, not counting one ASCII punctuation mark
    last = end - 1
    last = np.maximum(start, last - IS_PUNCTUATION[data[last]]) if n_words else last
    lower = data | ((data >= 65) & (data <= 90)).astype(np.uint8) << 5
    two = lower[last].astype(np.uint64) << np.uint64(8) | lower[np.maximum(start, last - 1)] if n_words else words
    kind = mix64(two + np.uint64(1)) % np.uint64(CONTEXTS - 1) + np.uint64(1)
    context = np.zeros(n_words + n_docs + 1, np.int64)
    context[place + 1] = kind  # the token after a word, which may be the document's end
    first = np.cumsum(per_doc) - per_doc + np.arange(n_docs)
    context[first] = 0
    return out.astype(np.int64), context[:-1], np.repeat(np.arange(n_docs), per_doc + 1)


def count_pairs(texts: DataFrame) -> DataFrame:
    """(``w, c, contexts, counts``) per token of a one-column frame: its occurrences, and
    those in each context it has. Tasks send one row per token they have seen."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        w = keys >> 8
        first = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
        ends = pa.array(np.append(first, len(w)).astype(np.int32))
        total = np.add.reduceat(n, first) if len(w) else n
        return pa.RecordBatch.from_arrays(
            [
                pa.array(w[first]),
                pa.array(total),
                pa.ListArray.from_arrays(ends, pa.array((keys & 255).astype(np.int16))),
                pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int64))),
            ],
            names=["w", "c", "contexts", "counts"],
        )

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(n, first) if len(keys) else n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            data, offs = byte_column(batch.column(0))
            for _, _, raw, at in blocks(data, offs):
                w, context, _ = tokens(raw, at)
                parts.append(np.unique(w << 8 | context, return_counts=True))
                if sum(len(k) for k, _ in parts) > 2 * HELD_PAIRS:
                    parts = [summed(parts)]
                    if len(parts[0][0]) > HELD_PAIRS:
                        yield rows(*parts.pop())
        if parts:
            yield rows(*summed(parts))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by token; the last token of a batch may go on in the next
        held: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            w = np.repeat(batch.column(0).to_numpy(), sizes)
            keys = w << 8 | batch.column(2).flatten().to_numpy().astype(np.int64)
            n = batch.column(3).flatten().to_numpy()
            keys, n = summed([*([held] if held else []), (keys, n)])
            cut = int(np.searchsorted(keys, keys[-1] >> 8 << 8)) if len(keys) else 0
            if cut:
                yield rows(keys[:cut], n[:cut])
            held = keys[cut:], n[cut:]
        if held and len(held[0]):
            yield rows(*held)

    schema = "w long, c long, contexts array<short>, counts array<long>"
    return texts.mapInArrow(count, schema).repartition("w").sortWithinPartitions("w").mapInArrow(merge, schema)


# ---------------------------------------------------------------- seating


def _uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    seed = np.uint64((sweep * 1_000_003 + step) * 0x9E3779B97F4A7C15 % 2**64)
    return (mix64(key ^ seed) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _binomial(n: np.ndarray, p: np.ndarray, draws: list[np.ndarray]) -> np.ndarray:
    """Binomial variates from uniform ones: by the inverse of the distribution where the mean
    of the rarer outcome is under 10, else normal around the mean."""
    u, v, w = draws
    rare = np.minimum(p, 1 - p)
    mean = n * rare
    spread = np.sqrt(np.maximum(mean * (1 - rare), 0))
    out = np.clip(np.floor(mean + spread * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v) + w), 0, n)
    at = np.flatnonzero(mean < 10)
    m, q, left = n[at], rare[at], u[at]
    k, mass = np.zeros(len(at)), np.exp(m * np.log1p(-q))
    while len(at):
        done = (left < mass) | (k >= m)
        out[at[done]] = k[done]
        at, m, q, left, k, mass = (x[~done] for x in (at, m, q, left, k, mass))
        left = left - mass
        mass = mass * (m - k) / (k + 1) * q / (1 - q)
        k = k + 1
        mass = np.where(mass < 1e-18, 1.0, mass)  # the far tail ends here
    return np.where(p > 0.5, n - out, out)


def seat(customers: np.ndarray, new: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables after seating each dish's customers in turn: with n customers at t tables, the
    next opens a table with weight ``new`` and joins one with weight n - discount * t."""
    tables = np.ones(len(customers))
    at = np.flatnonzero(customers > 1)
    for n in range(1, ONE_BY_ONE):
        at = at[customers[at] > n]
        if not len(at):
            return tables
        p = new[at] / (new[at] + n - discount * tables[at])
        tables[at] += _uniform(key[at], sweep, n) < p
    at = at[customers[at] > ONE_BY_ONE]
    n, step = np.full(len(at), float(ONE_BY_ONE)), ONE_BY_ONE
    while len(at):  # many customers: the number of new tables in a block at once
        block = np.minimum(np.floor(n / 16), customers[at] - n)
        p = new[at] / (new[at] + n - discount * tables[at])
        tables[at] += _binomial(block, p, [_uniform(key[at], sweep, step + i) for i in (1, 2, 3)])
        n += block
        step += 3
        left = n < customers[at]
        at, n = at[left], n[left]
    return tables


@dataclass
class Totals:
    """The global state after a sweep: tables per context, customers and tables of the parent."""

    context_tables: np.ndarray
    customers: float
    tables: float


@dataclass
class Setup:
    context_customers: np.ndarray
    n_tokens: int
    n_types: int
    discount: float  # of the context restaurants
    parent_discount: float

    @property
    def base(self) -> float:
        return 1.0 / (self.n_types + 1)

    def parent_new(self, t: Totals) -> float:
        return (PARENT_CONCENTRATION + self.parent_discount * t.tables) * self.base

    def left(self, t: Totals) -> np.ndarray:
        """The weight each context leaves to its parent."""
        return (CONTEXT_CONCENTRATION + self.discount * t.context_tables) / (CONTEXT_CONCENTRATION + self.context_customers)

    def parent_probability(self, customers: np.ndarray, tables: np.ndarray, t: Totals) -> np.ndarray:
        return (customers - self.parent_discount * tables + self.parent_new(t)) / (PARENT_CONCENTRATION + t.customers)


@dataclass
class Pairs:
    """Pairs of some tokens: the token's row, the context, the customers."""

    w: np.ndarray
    row: np.ndarray
    context: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Pairs:
        w = batch.column(0).to_numpy()
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        return cls(w, np.repeat(np.arange(len(w)), sizes), batch.column(2).flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy().astype(np.float64))

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, x, len(self.w))


def sweeps(pairs: Pairs, setup: Setup, history: list[Totals]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tables per pair, customers and tables in the parent) after sweep 0 (a table per dish)
    and after one sweep for every entry of ``history``."""
    tables, parent = np.ones(len(pairs.n)), np.ones(len(pairs.w))
    customers = pairs.sum(tables)
    yield tables, customers, parent
    key = mix64((pairs.w[pairs.row] << 8 | pairs.context).astype(np.uint64))
    own = mix64(pairs.w.astype(np.uint64) + np.uint64(0x51ED))
    for i, t in enumerate(history):
        p = setup.parent_probability(customers, parent, t)
        weight = (CONTEXT_CONCENTRATION + setup.discount * t.context_tables)[pairs.context] * p[pairs.row]
        tables = seat(pairs.n, weight, setup.discount, key, 2 * i)
        customers = pairs.sum(tables)
        parent = seat(customers, np.full(len(customers), setup.parent_new(t)), setup.parent_discount, own, 2 * i + 1)
        yield tables, customers, parent


def _sums(counts: DataFrame, setup: Setup | None, history: list[Totals], size: int) -> np.ndarray:
    """Sums over all tasks of a fixed number of figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            pairs = Pairs.of(batch)
            if setup is None:
                dishes = pairs.sum(np.ones(len(pairs.n)))
                figures = [np.bincount(pairs.context, pairs.n, CONTEXTS), np.bincount(pairs.context, minlength=CONTEXTS)]
                tail = [pairs.n.sum(), len(pairs.w), *((x == i).sum() for x in (pairs.n, dishes) for i in (1, 2))]
            else:
                *_, (tables, customers, parent) = sweeps(pairs, setup, history)
                figures, tail = [np.bincount(pairs.context, tables, CONTEXTS)], [customers.sum(), parent.sum()]
            total += np.concatenate([*figures, tail])
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["i", "x"])

    rows = counts.mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


@dataclass
class Model:
    setup: Setup
    samples: list[Totals]
    table: DataFrame  # w, c, parent (a probability per sample), contexts, logp

    @property
    def unknown(self) -> list[float]:
        """Parent probability of an unknown token, per sample."""
        zero = np.zeros(1)
        return [float(self.setup.parent_probability(zero, zero, t)[0]) for t in self.samples]

    @property
    def left(self) -> np.ndarray:
        """CONTEXTS x SAMPLES weights left to the parent."""
        return np.stack([self.setup.left(t) for t in self.samples], 1)


def train(texts: DataFrame) -> Model:
    """The model of a one-column frame of training texts (NULL as empty)."""
    prepare(texts.sparkSession)
    counts = materialise(count_pairs(texts), "pairs")
    first = _sums(counts, None, [], 2 * CONTEXTS + 6)
    n_tokens, n_types, p1, p2, w1, w2 = first[2 * CONTEXTS :]

    def discount(n1: float, n2: float) -> float:
        return float(np.clip(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.1, 0.95))

    setup = Setup(first[:CONTEXTS], int(n_tokens), int(n_types), discount(p1, p2), discount(w1, w2))
    dishes = first[CONTEXTS : 2 * CONTEXTS]
    history = [Totals(dishes, float(dishes.sum()), n_types)]
    for _ in range(BURN_IN + SAMPLES):
        x = _sums(counts, setup, history, CONTEXTS + 2)
        history.append(Totals(x[:CONTEXTS], x[-2], x[-1]))
    samples = history[-SAMPLES:]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = Pairs.of(batch)
            seatings = list(sweeps(pairs, setup, history[:-1]))[-SAMPLES:]
            parent = np.stack([setup.parent_probability(m, r, t) for (_, m, r), t in zip(seatings, samples, strict=True)], 1)
            mean = np.zeros(len(pairs.n))
            room = CONTEXT_CONCENTRATION + setup.context_customers[pairs.context]
            for i, ((tables, _, _), t) in enumerate(zip(seatings, samples, strict=True)):
                mean += (pairs.n - setup.discount * tables) / room + setup.left(t)[pairs.context] * parent[pairs.row, i]
            ends = pa.array((np.arange(len(pairs.w) + 1) * SAMPLES).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(ends, pa.array(parent.ravel())),
                    batch.column(2),
                    pa.ListArray.from_arrays(batch.column(2).offsets, pa.array(np.log10(mean / SAMPLES).astype(np.float32))),
                ],
                names=["w", "c", "parent", "contexts", "logp"],
            )

    schema = "w long, c long, parent array<double>, contexts array<short>, logp array<float>"
    return Model(setup, samples, materialise(counts.mapInArrow(predict, schema), "model"))


def _head(model: Model) -> dict[str, np.ndarray]:
    """The most frequent tokens as flat arrays: those from a count on that at most HEAD have.
    The count comes from a histogram of counts on a fine logarithmic scale, so that no task
    gathers candidates."""
    step = F.floor(F.log2("c") * 64).cast("int")
    cut, n = 1 << 30, 0
    for r in sorted(model.table.groupBy(step.alias("step")).count().collect(), reverse=True):
        if n + r["count"] > HEAD:
            break
        cut, n = r["step"], n + r["count"]
    t = model.table.where(step >= cut).toArrow().combine_chunks()
    lists = [t[c].combine_chunks() if isinstance(t[c], pa.ChunkedArray) else t[c] for c in ("parent", "contexts", "logp")]
    return {
        "w": t["w"].to_numpy(),
        "c": t["c"].to_numpy(),
        "parent": lists[0].flatten().to_numpy().reshape(-1, SAMPLES),
        "sizes": np.diff(lists[1].offsets.to_numpy()) if len(t) else np.zeros(0, np.int64),
        "contexts": lists[1].flatten().to_numpy().astype(np.int64),
        "logp": lists[2].flatten().to_numpy(),
    }


_ready: dict[int, tuple[IntTable, np.ndarray]] = {}


def _head_table(broadcast_id: int, head: dict[str, np.ndarray], left: np.ndarray) -> tuple[IntTable, np.ndarray]:
    """Rank of a frequent token, and log10 probabilities by rank and context."""
    if broadcast_id not in _ready:
        _ready.clear()
        n = len(head["w"])
        logp = np.log10(np.maximum(head["parent"] @ left.T / SAMPLES, 1e-300)).astype(np.float32)
        logp[np.repeat(np.arange(n), head["sizes"]), head["contexts"]] = head["logp"]
        _ready[broadcast_id] = IntTable(head["w"], np.arange(n, dtype=np.int32), -1), logp
    return _ready[broadcast_id]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """One row per document: ``id_col, held_out, n_tokens, n_known, train_tokens, base_score,
    score, perplexity``.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the model's. NULL and
    empty texts are one end token. Rows are told apart by position, so repeated rows and NULL
    identifiers stay; other columns are ignored. With nothing trained on, every token is
    unknown and has probability 1.
    """
    spark = docs.sparkSession
    prepare(spark)
    setup, left = model.setup, model.left
    head = _head(model)
    sent = spark.sparkContext.broadcast((head, left))
    key = sent._jbroadcast.id() if sent._jbroadcast is not None else id(sent)
    norm = float(setup.n_tokens + setup.n_types + 1)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).cast("long").alias("id"),
        (F.lit(None).cast("boolean") if held_out is None else held_out).alias("held_out"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, logp = _head_table(key, *sent.value)
        base = np.log10((head["c"] + 1) / norm)
        for batch in batches:
            row = batch.column(0).to_numpy()
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                n = hi - lo
                w, context, doc = tokens(raw, at)
                rank = ranks.get(w)
                known = rank >= 0
                r, d = rank[known], doc[known]
                sums = [np.bincount(d, x, n).astype(np.float64) for x in (logp[r, context[known]], base[r])]
                # the others: once per document, token and context
                w, context, doc = w[~known], context[~known], doc[~known]
                order = np.lexsort((w << 8 | context, doc))
                w, context, doc = w[order], context[order], doc[order]
                new = np.ones(len(w), bool)
                new[1:] = (np.diff(w) != 0) | (np.diff(context) != 0) | (np.diff(doc) != 0)
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(w)))
                m = len(first)
                own = row[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([own, own[doc[first]]])),
                        # a document's row has a token that no word has
                        pa.array(np.concatenate([-1 - own, w[first]])),
                        pa.array(np.concatenate([np.zeros(n, np.int64), times * CONTEXTS + context[first]])),
                        pa.concat_arrays([batch.column(2).slice(lo, n), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([batch.column(3).slice(lo, n), pa.nulls(m, pa.bool_())]),
                        *(
                            pa.concat_arrays([pa.array(x), pa.nulls(m, pa.array(x).type)])
                            for x in (np.bincount(d, minlength=n), sums[1], sums[0])
                        ),
                    ],
                    names=["row", "w", "x", "id", "held_out", "n_head", "base", "score"],
                )

    sent_rows = rows.mapInArrow(run, "row long, w long, x long, id long, held_out boolean, n_head long, base double, score double")
    times, context = F.floor(F.col("x") / CONTEXTS), (F.col("x") % CONTEXTS).cast("int")
    weights = F.array(*[F.lit(float(v)) for v in left.ravel()])
    unknown = F.array(*[F.lit(v) for v in model.unknown])
    parent = F.coalesce("parent", unknown)
    unseen = sum((F.element_at(weights, context * SAMPLES + (i + 1)) * parent[i] for i in range(SAMPLES)), F.lit(0.0))
    spot = F.coalesce(F.array_position("contexts", context.cast("short")), F.lit(0))
    one = F.when(spot > 0, F.get("logp", (spot - 1).cast("int")).cast("double")).otherwise(F.log10(unseen / SAMPLES))
    joined = sent_rows.join(model.table, "w", "left").select(
        "row",
        "id",
        "held_out",
        "n_head",
        F.when(F.col("x") > 0, times).otherwise(F.lit(0)).alias("n_tail"),
        F.when((F.col("x") > 0) & F.col("c").isNotNull(), times).otherwise(F.lit(0)).alias("n_tail_known"),
        F.when(F.col("x") > 0, times * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(norm))).otherwise(F.col("base")).alias("base"),
        F.when(F.col("x") > 0, times * one).otherwise(F.col("score")).alias("score"),
    )
    per_doc = joined.groupBy("row").agg(
        F.max("id").alias("id"),
        F.max("held_out").alias("held_out"),
        (F.sum("n_head") + F.sum("n_tail")).alias("n_tokens"),
        (F.sum("n_head") + F.sum("n_tail_known")).alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return per_doc.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(setup.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
