"""Shared pieces: reading the tables, written intermediate tables, and byte-level text kernels.

The kernels work on whole Arrow batches: the UTF-8 bytes of a batch of texts are one
``uint8`` array plus offsets, cut into blocks of whole documents so that temporaries stay
small whatever the batch size. Spark does the partitioning and shuffling; numpy only runs
inside a task on the rows Spark handed to it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _fs_and_path, scratch_path, ship_package

#: Bytes of text that a kernel handles at once (a longer document is a block of its own).
BLOCK_BYTES = 1 << 19


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``__id`` long, ``__text`` string, NULL text as empty): only what operators read, so
    further columns of the input can have any name."""
    return docs.select(
        F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    )


#: Spark deletes a query's shuffle files when the query ends, not when the driver collects garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files. For frames that are executed once: a second
    run of the same frame would shuffle again."""
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back: cuts
    the lineage, survives lost executors, and is removed when the application ends. What was
    shuffled for it is deleted as soon as it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    fs, hpath = _fs_and_path(spark, path)
    with tidy(spark):
        df.write.parquet(path)
    fs.deleteOnExit(hpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    _written.append(out)
    return out


#: Tables that ``materialise`` has written, in order.
_written: list[DataFrame] = []


def concluded(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` gives, written; the tables written for it are deleted."""
    before = len(_written)
    out = materialise(make(), name)
    discard(*_written[before:-1])
    del _written[before:]
    give_back()  # what the driver itself held for the tables
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete written tables (as ``materialise`` gives them) that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_scratch", None)
        if path is not None:
            fs, hpath = _fs_and_path(t.sparkSession, path)
            fs.delete(hpath, True)


# ---------------------------------------------------------------- byte kernels (task side)

_rng = np.random.default_rng(20240607)
_BYTE_WEIGHT = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 8 + 5
_BASE_INV = pow(_BASE, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII characters other than letters and digits
IS_PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER_WEIGHT = _BYTE_WEIGHT[LOWER]

_powers: dict[str, np.ndarray] = {}
#: Bytes whose terms of a prefix sum are made at once.
_CHUNK = 1 << 14


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n; kept and doubled as needed."""
    t = _powers.get(name)
    if t is None or len(t) < n:
        size = 1 << max(16, (n - 1).bit_length())
        t = np.ones(size, np.uint64)
        done, step = 1, base % 2**64
        while done < size:
            t[done : 2 * done] = t[:done] * np.uint64(step)
            step = step * step % 2**64
            done *= 2
        _powers[name] = t
    return t[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums of a polynomial over bytes: n + 1 values (see ``span_hash``)."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    terms = out[1:]
    weight, power = _LOWER_WEIGHT if lower else _BYTE_WEIGHT, _power_table("p", _BASE, len(data))
    for lo in range(0, len(data), _CHUNK):  # pieces that stay in a core's cache
        hi = min(len(data), lo + _CHUNK)
        np.multiply(weight.take(data[lo:hi]), power[lo:hi], out=terms[lo:hi])
        terms[lo : lo + 1] += out[lo : lo + 1]
        np.cumsum(terms[lo:hi], out=terms[lo:hi])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal bytes give equal hashes."""
    h = (prefix[end] - prefix[start]) * _power_table("i", _BASE_INV, len(prefix))[start]
    return mix64(h + (end - start).astype(np.uint64))


def byte_column(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; offsets has one entry more than rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library

    def _trim(_keep: int) -> int:
        return 0


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers for later stages, and what
    a stage's temporaries took would stay with them."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def blocks(data: np.ndarray, offs: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole documents of about ``limit`` bytes;
    after the last one, memory is given back."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi
    give_back()


def word_spans(
    data: np.ndarray, offs: np.ndarray, between: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per document): words are runs without the bytes marked in
    ``between`` (ASCII white space) and never cross a document's end."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs) - 1, np.int64)
    space = between[data]
    cut = np.ones(n + 1, bool)  # nothing continues over position i
    cut[1:n] = space[: n - 1]
    cut[offs] = True
    word = ~space
    start = np.flatnonzero(word & cut[:n])
    after = np.ones(n + 1, bool)
    after[1:n] = space[1:]
    after[offs] = True
    end = np.flatnonzero(word & after[1:]) + 1
    return start, end, np.diff(np.searchsorted(start, offs))


class IntTable:
    """A read-only map from non-negative integers to numbers with vectorised lookups (open
    addressing, at most a quarter full)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float):
        self.missing = missing
        bits = max(10, (4 * max(1, len(keys)) - 1).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, missing, values.dtype)
        slot = self._slot(keys)
        while len(keys):  # one key takes a free slot, the others move on
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            won = self.keys[slot] == keys
            self.values[slot[won]] = values[won]
            keys, values, slot = keys[~won], values[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = self.values[slot]
        wrong = seen != keys
        if wrong.any():
            out[wrong] = self.missing
            left = np.flatnonzero(wrong & (seen != -1))
            while len(left):
                slot[left] = (slot[left] + 1) & self.mask
                seen = self.keys[slot[left]]
                hit = seen == keys[left]
                out[left[hit]] = self.values[slot[left[hit]]]
                left = left[~hit & (seen != -1)]
        return out
