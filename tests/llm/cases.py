"""Texts and tables for the tests, and the plain definitions they are compared with."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

SYLLABLES = {
    "en": "the ing er on and ed th in ou re tion es at or en st ly ha he wh sh ble an".split(),
    "de": "sch ung der ein ich keit ver ge ber zu heit lich st au ä ö ü pf tz chen".split(),
    "el": "και το ος ης αν που λο γος μα τα νε ρο φι κα λη".split(),
}

# Extra columns have names that operators also use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("kept", T.StringType()),
        T.StructField("n", T.DoubleType()),
        T.StructField("key", T.StringType()),
        T.StructField("__bytes", T.StringType()),
    ]
)


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def texts(seed: int = 1) -> list[str | None]:
    """Prose, exact and near copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    out: list[str | None] = [prose(rng, rng.randint(20, 120), rng.choice(["en", "de"])) for _ in range(40)]
    out += [None, "", " \t\n", "a", "one two", "one two three four", "ONE two three four", "é" * 500, "ab" * 400, "\x00x\x1f y", "日本 語 テキスト 'll"]
    out.append(" ".join(["word"] * 3000))  # long and repetitive
    out.append(prose(rng, 6000))  # very long
    base = prose(rng, 100).split()
    for i in range(25):  # near copies of one text
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(9)}"
        out.append(" ".join(copy))
    passage = prose(rng, 60)
    out += [f"{prose(rng, 12)} {passage} {prose(rng, 9)}" for _ in range(12)]
    out += [out[3]] * 7 + [out[5]] * 2  # exact copies
    return out


def docs(spark, rows=None, partitions: int = 3):
    """A table of (doc_id, text, lang) rows with the extra columns; default: ``texts()``."""
    if rows is None:
        rows = [(i, t, "en") for i, t in enumerate(texts())]
    full = [(*r, "x", 1, "yes", 0.5, "k", "b") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text)
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)] if w else [])


def near_groups(rows: list[tuple[int, str | None]], k: int, percent: int = 80) -> dict[int, int]:
    """Identifier -> smallest identifier reachable, by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for p, a in enumerate(ids):
        for b in ids[p + 1 :]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}
