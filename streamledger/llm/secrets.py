"""Secret scanning: fixed patterns plus zstandard novelty.

Beside the patterns, a string with a sensitive word near it, before or after, is a candidate. Its
novelty is what it adds to the compressed size of its surroundings: the compressor is primed with
a dictionary of identifiers, compresses the surrounding code once without and once with the
candidate, and the difference, per byte of the candidate, is the novelty. Names built from
ordinary identifiers add little; random keys don't compress. Other copies of the candidate are no
surroundings, so a key that is repeated stays novel and every copy near a sensitive word is
reported. The least novelty follows the candidate's alphabet and length.

The dictionary is learnt from all documents: the words and parts of names that occur most often,
a bounded number of them (``learn_identifiers``), after common ones of program code.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, prepare

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "novel")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the base patterns (letters of the keywords in either case, ASCII only)
_KEYWORDS = "|".join(["password", "passwd", "secret", "token", "api_?key"])
ASSIGN = re.compile("(" + _either_case(_KEYWORDS) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make a neighbourhood sensitive, and how near (characters) a candidate must be.
SENSITIVE = re.compile(
    "|".join(_either_case(w) for w in ("passw", "pwd", "secret", "token", "api_?key", "auth", "bearer", "credential", "private", "signature", "access_?key"))
)
_SENSITIVE_HINTS = ("passw", "pwd", "secret", "token", "apikey", "api_key", "auth", "bearer", "credential", "private", "signature", "accesskey", "access_key")
NEAR = 64
#: Candidates: passwords of URLs, runs of all that a quoted password may hold, runs of the
#: characters of keys.
USERINFO = re.compile(r"://[^/\s:@]{0,64}:(?P<key>[^\s\"'<>]{16,}?)@(?=[A-Za-z0-9.-]+(?:[:/\s\"']|$))")
MIXED = re.compile(r"(?<![^\s\"'`=:,(\[{<>])(?P<key>[!#-&*-.0-9:=?-Z\\^_a-z|~/]{16,})(?![^\s\"'`,;)\]}<>])")
CANDIDATE = re.compile(r"(?P<key>[A-Za-z0-9+/_=-]{16,})")
#: Mixed runs that are no passwords: addresses, and names with a value behind them.
PLAIN_RUN = re.compile(r"://|[\w.+-]+@[\w-]+\.|^[A-Za-z_.-]+[=:]")
#: Characters of surrounding code on either side that prime the compressor.
AROUND = 512
#: Least marginal compressed bytes per byte of a candidate that is reported; less for small
#: alphabets, by so much of the entropy of random characters and so many bytes a candidate.
NOVELTY, OF_ENTROPY, OVERHEAD = 0.72, 0.95, 8
#: Candidates of letters alone or of fewer than SHORT characters must look random as well (see
#: ``random_looking``; LEAST_ENTROPY: share of the entropy that their length allows) and need
#: LESS novelty: they are too short for compression to tell.
SHORT, LEAST_ENTROPY, LESS = 20, 0.78, 0.2
#: Words of the dictionary that are learnt, their least and most letters.
LEARNT, WORD_LETTERS = 4096, (4, 24)

#: Identifiers that prime the compressor (raw dictionary content).
IDENTIFIERS = " ".join(
    """access account address algorithm api application args array async attribute auth authentication authorization await
    base64 bearer boolean bucket buffer builder byte cache callback certificate class client cloud cluster code config
    configuration connection const container content context cookie credential credentials data database date debug default
    def delete description destination device dictionary document domain email enabled encode encoding encryption endpoint
    environment error event exception export expires extends false field file filter float format from function generate get
    group handler hash header headers host hostname http https id identifier implements import index info init input instance
    int integer interface json key label length level library list local log logger login long manager map message metadata
    method model module name namespace new node null number object option options output package page param parameter
    parameters parse password path pattern permission policy port private process profile project properties property
    protected provider proxy public query queue random read receive record refresh region registry remote repository request
    require resource response result return role root route scheme schema scope secret security select self send server
    service session set setting settings sha256 sign signature size source static status storage store stream string
    struct table target template test text this thread time timeout timestamp token transaction true type update upload
    uri url user username utf8 util valid validate value variable vector verify version void web worker write
    ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 the and for that with this from""".split()
)

_compressors: dict[str, zstandard.ZstdCompressor] = {}


def _size(data: bytes, words: str) -> int:
    if words not in _compressors:
        _compressors.clear()  # one dictionary at a time
        primed = zstandard.ZstdCompressionDict((words + " " + IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _compressors[words] = zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_dict_id=False)
    return len(_compressors[words].compress(data))


def novelty(text: str, start: int, end: int, words: str = "") -> float:
    """Marginal compressed bytes of text[start:end] per byte, given what surrounds it; copies of
    it don't count as surroundings."""
    value = text[start:end]
    # a copy may be cut by the end of the surroundings
    before = text[max(0, start - AROUND) : start].replace(value, "").encode("utf-8", "replace")
    after = text[end : end + AROUND].replace(value, "").encode("utf-8", "replace")
    for part in (value[k:] for k in range(1, len(value) - 7)):
        if before.startswith(part.encode()):
            before = before[len(part.encode()) :]
            break
    for part in (value[:k] for k in range(len(value) - 1, 7, -1)):
        if after.endswith(part.encode()):
            after = after[: -len(part.encode())]
            break
    raw = value.encode("utf-8", "replace")
    return (_size(after + before + raw, words) - _size(after + before, words)) / max(1, len(raw))


def random_looking(value: str) -> bool:
    """Whether a candidate of letters alone, or a short one, is as mixed as random characters
    are: of a text's letters few are used often, and small and capital ones come in runs."""
    counts = [value.count(c) for c in set(value)]
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    if entropy < LEAST_ENTROPY * math.log2(min(len(value), 64)):
        return False
    joined = [c for c in value if c not in "/_-+=."] or list(value)  # words may be joined by these
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in joined]
    if len(set(kinds)) > 1:  # names change from small to capital letters once a word
        return sum(a != b for a, b in zip(kinds, kinds[1:])) >= 0.25 * len(joined)
    # one case: letters of words alternate between vowels and consonants
    vowels = sum(c in "aeiouyAEIOUY" for c in joined) / len(joined)
    return kinds[0] == "d" or vowels < 0.36


def least_novelty(value: str) -> float:
    """What a random string of the alphabet and length of ``value`` surely reaches."""
    used = set(value)
    letters = {c for c in used if c.isalpha()}
    symbols = sum(not c.isalnum() for c in used)
    if letters <= set("abcdef") or letters <= set("ABCDEF"):
        size = 16
    else:
        size = 10 * any(c.isdigit() for c in used) + 26 * any(c.islower() for c in letters) + 26 * any(c.isupper() for c in letters)
    return min(NOVELTY, OF_ENTROPY * math.log2(max(2, size + symbols)) / 8 + OVERHEAD / max(1, len(value)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns: leftmost, non-overlapping within a kind; short matches dropped."""
    found = []
    lowered = text.lower()
    if any(h in lowered for h in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _near(words: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether a word lies within NEAR characters of [a, b), on either side or inside."""
    i = bisect_left(words, (a, a))
    return (i > 0 and a - words[i - 1][1] <= NEAR) or (i < len(words) and words[i][0] - b <= NEAR)


def novel_spans(text: str, known: list[tuple[str, int, int]], words: str = "") -> list[tuple[str, int, int, float]]:
    """Incompressible strings near a sensitive word that no base span overlaps."""
    lowered = text.lower()
    if not any(h in lowered for h in _SENSITIVE_HINTS):
        return []
    sensitive = [(m.start(), m.end()) for m in SENSITIVE.finditer(text)]
    out: list[tuple[str, int, int, float]] = []
    for pattern in (USERINFO, MIXED, CANDIDATE):
        taken = sorted([(a, b) for _, a, b in known] + [(a, b) for _, a, b, _ in out])
        k = 0
        for m in pattern.finditer(text) if sensitive else ():
            a, b = m.span("key")
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if (k < len(taken) and taken[k][0] < b) or not _near(sensitive, a, b):
                continue
            value = text[a:b]
            if pattern is MIXED and (CANDIDATE.fullmatch(value) or PLAIN_RUN.search(value)):
                continue
            plain = value.isalpha() or b - a < SHORT or not any(c.isdigit() for c in value)
            if plain and not random_looking(value):
                continue
            n = novelty(text, a, b, words)
            if n >= least_novelty(value) - (LESS if plain else 0.0):
                out.append(("novel", a, b, n))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])


def scan_text(text: str, words: str = "") -> list[dict]:
    """All spans by start, then kind; offsets are code points, the end exclusive."""
    base = base_spans(text)
    spans = [(k, a, b, None) for k, a, b in base] + novel_spans(text, base, words)
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [{"kind": k, "start": a, "end": b, "novelty": n} for k, a, b, n in spans]


def learn_identifiers(docs: DataFrame, text_col: str = "text") -> str:
    """The LEARNT most frequent words of letters over all documents, as dictionary content with
    the most frequent ones last (nearest for the compressor). Words are counted by a partial
    aggregate; names are cut where small letters meet capitals."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "([a-z])([A-Z])", "$1 $2")
    words = docs.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("w"))
    words = words.where(F.length("w").between(*WORD_LETTERS)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    top = words.where("n > 1").orderBy(F.desc("n"), "w").limit(LEARNT).collect()
    return " ".join(r["w"] for r in reversed(top))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``spans`` (array of kind, start, end, novelty).

    NULL and empty texts have no spans. Rows are independent but for the dictionary, which all
    rows teach; repeated rows and NULL identifiers need no rule; other columns are ignored.
    """
    prepare(docs.sparkSession)
    learnt = learn_identifiers(docs, text_col)  # at most LEARNT words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [scan_text(t.as_py(), learnt) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["__id", "spans"])

    schema = "__id long, spans array<struct<kind: string, start: int, end: int, novelty: double>>"
    return doc_columns(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("__id", id_col)
