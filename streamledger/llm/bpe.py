"""Byte-level BPE encoding and decoding without a regex engine.

Pre-tokenisation is a small automaton over code-point classes. Every character is a function
from state to state; functions compose associatively, so a block of text is scanned in
parallel: chunks are composed for all start states at once, a prefix pass over the chunk
functions gives each chunk its start state, and a second pass gives the state before every
character. State, class and the next class then say whether a piece starts there.

Pieces (byte slices) go through a cache; the pieces it lacks are merged together, all at
once, by ranks. Token offsets are the running sums of token lengths, and decoding places each
token's bytes at its offset.

The split pattern is fixed (contractions 's 't 're 've 'm 'll 'd, letters, numbers and other
characters each with an optional space before, white space without its last character when
text follows); the vocabulary is a parameter: a file of base64 tokens and ranks.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import IntTable, blocks, byte_column, doc_columns, prepare

# Character classes. Letters that can be part of a contraction have classes of their own.
LETTER, STMD, R, V, EL, E, NUMBER, APOSTROPHE, OTHER, SPACE, WHITE, END = range(12)
N_CLASSES = 12
# Automaton states: what the last character was.
(AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, AFTER_WHITE, FRESH_APOSTROPHE, MAYBE_RE, MAYBE_VE, MAYBE_LL, CONTRACTED) = range(11)
N_STATES = 11
_LETTERS = (LETTER, STMD, R, V, EL, E)
_CHUNK = 64
#: Pieces kept in a worker's cache before it is emptied.
CACHE_PIECES = 300_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state by state and class, piece starts by state, class and next class)."""
    step = np.zeros((N_STATES, N_CLASSES), np.uint8)
    starts = np.zeros((N_STATES, N_CLASSES, N_CLASSES), bool)
    for s in range(N_STATES):
        for c in _LETTERS:
            step[s, c] = IN_LETTERS
            starts[s, c, :] = s not in (IN_LETTERS, MAYBE_RE, MAYBE_VE, MAYBE_LL, AFTER_SPACE)
        step[s, NUMBER] = IN_NUMBERS
        starts[s, NUMBER, :] = s not in (IN_NUMBERS, AFTER_SPACE)
        step[s, OTHER] = IN_OTHER
        step[s, APOSTROPHE] = IN_OTHER if s in (IN_OTHER, FRESH_APOSTROPHE, AFTER_SPACE) else FRESH_APOSTROPHE
        for c in (OTHER, APOSTROPHE):
            starts[s, c, :] = s not in (IN_OTHER, FRESH_APOSTROPHE, AFTER_SPACE)
        step[s, SPACE], step[s, WHITE], step[s, END] = AFTER_SPACE, AFTER_WHITE, AT_START
        for c in (SPACE, WHITE):
            if s in (AFTER_SPACE, AFTER_WHITE):
                starts[s, c, :] = True
                starts[s, c, [SPACE, WHITE, END]] = False
            else:
                starts[s, c, :] = True
    for c, then, second in ((STMD, CONTRACTED, None), (R, MAYBE_RE, E), (V, MAYBE_VE, E), (EL, MAYBE_LL, EL)):
        step[FRESH_APOSTROPHE, c] = then
        if second is None:
            starts[FRESH_APOSTROPHE, c, :] = False
        else:
            starts[FRESH_APOSTROPHE, c, second] = False
            step[then, second] = CONTRACTED
    return step.ravel(), starts.ravel()


# Letters and numbers that Unicode 16 has and Python's database may lack, as
# first and last code points.
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]

_STEP, _STARTS = _tables()
_classes: np.ndarray | None = None


def class_table() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        t = np.full(0x110000, OTHER, np.uint8)
        kinds = np.array([unicodedata.category(chr(i))[0] for i in range(0x110000)])
        t[kinds == "L"], t[kinds == "N"] = LETTER, NUMBER  # by the Unicode version of Python
        for kind, ranges in ((LETTER, LATER_LETTERS), (NUMBER, LATER_NUMBERS)):
            for first, last in ranges:
                t[first : last + 1] = kind
        # fixed values: the code points with the White_Space property
        t[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
        t[ord(" ")], t[ord("'")] = SPACE, APOSTROPHE
        t[[ord(x) for x in "stmd"]] = STMD
        t[ord("r")], t[ord("v")], t[ord("l")], t[ord("e")] = R, V, EL, E
        _classes = t
    return _classes


def states_before(cls: np.ndarray) -> np.ndarray:
    """The automaton's state before each position, by a scan over composed functions."""
    n = len(cls)
    n_chunks = -(-n // _CHUNK) or 1
    padded = np.full(n_chunks * _CHUNK, END, np.uint8)
    padded[:n] = cls
    columns = np.ascontiguousarray(padded.reshape(n_chunks, _CHUNK).T)
    fn = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (n_chunks, N_STATES)).copy()
    for col in columns:  # compose a chunk's characters, for every start state
        fn = _STEP.take(fn * np.uint8(N_CLASSES) + col[:, None])
    flat, state, first = fn.tobytes(), AT_START, bytearray(n_chunks)
    for i in range(n_chunks):  # prefix over the chunk functions
        first[i] = state
        state = flat[i * N_STATES + state]
    now = np.frombuffer(bytes(first), np.uint8)
    out = np.empty((_CHUNK, n_chunks), np.uint8)
    for j, col in enumerate(columns):
        out[j] = now
        now = _STEP.take(now * np.uint8(N_CLASSES) + col)
    return out.T.reshape(-1)[:n]


def piece_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions where pieces start, for documents laid end to end as UTF-8; a piece
    ends where the next starts (or at the end of the bytes)."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n, n_docs = len(points), len(offs) - 1
    lens = np.diff(np.searchsorted(at, offs))
    cls = np.full(n + n_docs + 1, END, np.uint8)  # an END after every document
    place = np.arange(n) + np.repeat(np.arange(n_docs), lens)
    cls[place] = class_table()[points]
    state = states_before(cls[:-1])
    key = (state.astype(np.int32) * N_CLASSES + cls[:-1]) * N_CLASSES + cls[1:]
    return at[_STARTS[key][place]]


class Vocabulary:
    """Ranks, the pair table for merging, the cache, and the bytes for decoding."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        size = max(self.ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.pairs = IntTable(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64), self.no_rank)
        self.cache: dict[bytes, bytes] = {}

    no_rank = 1 << 40

    def merge_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each piece. All pieces are merged side by
        side: in a round, each piece joins its leftmost pair of lowest rank."""
        out: list[bytes] = [b""] * len(pieces)
        long_ = [i for i, p in enumerate(pieces) if len(p) > 64]
        for i in long_:
            out[i] = self._merge_long(pieces[i])
        index = np.array([i for i, p in enumerate(pieces) if 0 < len(p) <= 64], np.int64)
        if not len(index):
            return out
        ids = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in index), np.uint8)]
        owner = np.repeat(index, [len(pieces[i]) for i in index])
        while len(ids):
            rank = np.full(len(ids), self.no_rank, np.int64)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.pairs.get(ids[same] << 20 | ids[same + 1])
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(ids)))
            done = low == self.no_rank
            if done.any():  # nothing more to merge: hand the ids over and go on with the rest
                flat = ids.astype("<u4")
                for i, lo, size in zip(owner[first[done]].tolist(), first[done].tolist(), sizes[done].tolist(), strict=True):
                    out[i] = flat[lo : lo + size].tobytes()
                keep = np.repeat(~done, sizes)
                ids, owner, rank, low, sizes = ids[keep], owner[keep], rank[keep], low[~done], sizes[~done]
                if not len(ids):
                    break
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hits = np.flatnonzero(rank == np.repeat(low, sizes))
            who = owner[hits]
            at = hits[np.concatenate([[True], who[1:] != who[:-1]])]  # the leftmost of each piece
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """One long piece: a heap of pairs over a linked list, n log n."""
        import heapq

        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        tokens, ranks = self.tokens, self.ranks
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                r = ranks.get(tokens[ids[i]] + tokens[ids[j]])
                if r is not None:
                    heap.append((r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = r, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0:
                    size = len(heap)
                    offer(k)
                    if len(heap) > size:
                        heapq.heappush(heap, heap.pop())
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], "<u4").tobytes()

    def encode(self, data: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """Token ids of each document."""
        starts = piece_starts(data, offs)
        raw = data.tobytes()
        cuts = [*starts.tolist(), len(raw)]
        pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        cache = self.cache
        found = list(map(cache.get, pieces))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            new = dict.fromkeys([pieces[i] for i in lacking])
            merged = dict(zip(new, self.merge_pieces(list(new)), strict=True))
            for i in lacking:
                found[i] = merged[pieces[i]]
            if len(cache) + len(merged) > CACHE_PIECES:
                cache.clear()
            cache.update(merged)
        by_doc = np.searchsorted(starts, offs).tolist()
        return [b"".join(found[a:b]) for a, b in zip(by_doc, by_doc[1:])]  # noqa: B905

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of every token, and the total length at the end."""
        out = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.lengths[ids], out=out[1:])
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes: byte k of a token goes to its offset + k."""
        if not len(ids):
            return np.zeros(0, np.uint8)
        source = np.repeat(self.starts[ids] - offsets[:-1], np.diff(offsets))
        source += np.arange(offsets[-1])
        return self.blob[source]


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(rank_file: bytes) -> Vocabulary:
    key = hash(rank_file)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(rank_file)
    return _loaded[key]


def _valid_utf8(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that aren't UTF-8 become U+FFFD, document by document."""
    texts = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offs, offs[1:])]  # noqa: B905
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def encode_documents(
    docs: DataFrame,
    rank_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_offsets: bool = False,
    decode: bool = False,
) -> DataFrame:
    """One row per document: ``id_col``, ``n_tokens``, ``ids`` (binary: little-endian unsigned
    32-bit), with ``token_offsets`` (binary, same layout: first byte of each token) and
    ``decoded`` (binary: the ids decoded again) when asked for.

    ``rank_file`` is read on the driver and sent with the tasks. NULL and empty texts have no
    tokens. Rows are independent, so repeated rows and NULL identifiers need no rule; other
    columns are ignored. No shuffle.
    """
    prepare(docs.sparkSession)
    with open(rank_file, "rb") as f:
        ranks = f.read()
    fields = ["__id long", "n_tokens long", "ids binary"]
    fields += ["token_offsets binary"] * with_offsets + ["decoded binary"] * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(ranks)
        for batch in batches:
            data, offs = byte_column(batch.column(1))
            for lo, hi, raw, at in blocks(data, offs):
                try:
                    encoded = vocab.encode(raw, at)
                except UnicodeDecodeError:
                    encoded = vocab.encode(*_valid_utf8(raw, at))
                sizes = np.array([len(x) for x in encoded], np.int64) // 4
                out = [batch.column(0).slice(lo, hi - lo), pa.array(sizes), pa.array(encoded, pa.binary())]
                if with_offsets or decode:
                    ids = np.frombuffer(b"".join(encoded), "<u4")
                    offsets = vocab.offsets(ids)
                    cut = np.concatenate([[0], np.cumsum(sizes)])
                    if with_offsets:
                        out.append(pa.array([(offsets[a:b] - offsets[a]).astype("<u4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()))  # noqa: B905
                    if decode:
                        text, ends = vocab.decode(ids, offsets).tobytes(), offsets[cut].tolist()
                        out.append(pa.array([text[a:b] for a, b in zip(ends, ends[1:])], pa.binary()))  # noqa: B905
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in fields])

    return doc_columns(docs, id_col, text_col).mapInArrow(run, ", ".join(fields)).withColumnRenamed("__id", id_col)
