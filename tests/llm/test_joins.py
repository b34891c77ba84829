"""Filter audit (op 11), similarity join (op 12), vector codes (op 13)."""

import hashlib
import math
import random
from itertools import permutations

import numpy as np
import pytest
from cases import docs, empty, near_groups, prose, shingles, texts
from pyspark.sql import functions as F
from pyspark.sql import types as T
from streamledger.llm import audit, codes, jaccard

# ---------------------------------------------------------------- op 11

LABELS = "doc_id long, quality int, toxic int, part string, mask string"


def _fails(i, text, ids_of):
    import re

    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    out = set()
    if len(w) < 200:
        out.add("A")
    if 100 * len(set(w)) < 50 * len(w):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
        out.add("C")
    if re.search(r"[#$%&*|]", t):
        out.add("D")
    if i is not None and any(j is not None and j < i for j in ids_of[t]):
        out.add("E")
    return out


def _audited(rows, labels):
    ids_of = {}
    for i, t, _ in rows:
        ids_of.setdefault(t or "", []).append(i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    found = [(lang or "", _fails(i, t, ids_of), i in good, i in toxic) for i, t, lang in rows]
    out = {}
    for part in {f[0] for f in found}:
        own = [f for f in found if f[0] == part]
        credit = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if x in f[1]]
                kept = [f for f in left if x not in f[1]]
                earlier = sum(x in f[1] for f in own) - len(gone)
                alone = sum(f[1] == {x} for f in own)
                out[part, order, step] = [len(kept), len(gone), earlier, alone, sum(f[2] for f in gone), sum(f[3] for f in gone)]
                credit[x] += len(gone)
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(credit[order[step - 1]])
    return out


def test_audit_against_applying_every_order(spark, monkeypatch):
    monkeypatch.setattr(audit, "HELD_PARTS", 2)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    some = [" ".join(rng.sample(words, 250)), " ".join(["same"] * 300), "LOUD " * 40, "a $ b", " ".join(["X", "#"] * 150), "é" * 900, "\x1c \x1d"]
    rows = [(i, rng.choice([*some, *texts()[:3], None, ""]), rng.choice(["en", "de", "", None, "el"])) for i in range(150)]
    rows += [(7, rows[7][1], "en"), (None, some[0], "en"), (None, None, None), (500, prose(rng, 30000), "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    table = spark.createDataFrame([(*x, "p", "m") for x in labels], LABELS)
    got = audit.audit(docs(spark, rows, 5), table).collect()
    want = _audited(rows, labels)
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got} == want
    assert len(got) == len(want) == 600 * len({x[2] or "" for x in rows})


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit(empty(spark), none).count() == 0
    got = audit.audit(docs(spark, [(1, None, None)]), none).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""}
    assert all(r["removed"] == (r["filter_order"][r["step"] - 1] == "A") for r in got)


def test_fields_of_an_integer_never_meet():
    masks = [audit.packed(m, True, True) for m in range(32)]
    total = sum((2**57) * x for x in masks)  # 2^62 documents
    want = sum(audit.unpacked(x) for x in masks) * 2**57
    assert (audit.unpacked(total) == want).all()
    kept, removed = (want[: audit.STEPS * 5].reshape(120, 5, 5)[:, :, k] for k in (0, 1))
    assert (kept[:, 4] + removed.sum(1) == 2**62).all()


# ---------------------------------------------------------------- op 12


def _groups(spark, rows, percent=85):
    got = jaccard.similarity_groups(docs(spark, [(i, t, None) for i, t in rows]), percent=percent).collect()
    assert len(got) == len(rows)
    return got


def _near_copies(rng, n, words=120, most=9):
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for p in rng.sample(range(words), rng.randrange(most)):
            copy[p] = f"x{rng.randrange(1000)}"
        if rng.random() < 0.3:
            copy += [f"y{rng.randrange(1000)}" for _ in range(rng.randrange(30))]
        out.append((1000 - i, " ".join(copy)))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_against_all_pairs(spark, percent):
    rows = list(enumerate(texts()))
    got, want = {r["doc_id"]: r for r in _groups(spark, rows, percent)}, near_groups(rows, 4, percent)
    for i, t in rows:
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (len(shingles(t, 4)), want[i])
    assert len(set(want.values())) < len(rows) - 10


@pytest.mark.parametrize("turns,piece,named", [(1, 300, 0), (1, 1000, 3), (2, 1 << 21, 32)])
def test_groups_of_many_loose_copies(spark, monkeypatch, turns, piece, named):
    monkeypatch.setattr(jaccard, "TURNS", turns)
    monkeypatch.setattr(jaccard, "FEW", 1)
    monkeypatch.setattr(jaccard, "PIECE_SHINGLES", piece)
    monkeypatch.setattr(jaccard, "PIECE_MARKED", 2 * piece)
    monkeypatch.setattr(jaccard, "NAMED", named)
    monkeypatch.setattr(jaccard, "PIECE_MEMBERS", 8)
    monkeypatch.setattr(jaccard, "SEEN", 2)
    rows = _near_copies(random.Random(11), 130)
    want = near_groups(rows, 4, 85)
    assert {r["doc_id"]: r["component_id"] for r in _groups(spark, rows)} == want
    assert 1 < len(set(want.values())) < 130


@pytest.mark.parametrize("piece,named", [(1000, 0), (1 << 21, 32)])
def test_groups_of_loose_copies_in_large_tiles(spark, monkeypatch, piece, named):
    for name, value in (("TURNS", 1), ("FEW", 1), ("SMALL", 6), ("PIECE_SHINGLES", piece), ("PIECE_MARKED", 2 * piece), ("NAMED", named)):
        monkeypatch.setattr(jaccard, name, value)
    rows = _near_copies(random.Random(12), 90)
    want = near_groups(rows, 4, 85)
    assert {r["doc_id"]: r["component_id"] for r in _groups(spark, rows)} == want
    assert 1 < len(set(want.values())) < 90


def test_a_chain_of_small_tiles_is_not_compared_with_itself(spark, monkeypatch):
    """Each document shares half its text with the next: as many pairs as documents, but one
    cluster, whose members once went to each of its pieces."""
    rng = random.Random(3)
    passages = [prose(rng, 60) for _ in range(61)]
    rows = [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(passages, passages[1:]))]
    placed, written = [], []
    place, write = jaccard._placed, jaccard.materialise
    monkeypatch.setattr(jaccard, "_placed", lambda members, size: placed.append(place(members, size)) or placed[-1])
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: written.append((name, write(df, name))) or written[-1][1])
    monkeypatch.setattr(jaccard, "discard", lambda *tables: None)
    monkeypatch.setattr(jaccard, "TURNS", 1)
    monkeypatch.setattr(jaccard, "PIECE_MARKED", 500)
    assert {r["doc_id"]: r["component_id"] for r in _groups(spark, rows)} == {i: i for i in range(60)}
    still = [t for name, t in written if name == "open"][-1].select("id").distinct().count()
    assert still > 40 and sum(p.count() for p in placed) <= 2 * still


@pytest.mark.parametrize("percent", [60, 85, 93])
def test_first_common_keys_of_links_are_early(spark, percent):
    """At the least overlap that a link allows, with all other shingles before the common ones."""
    rows = []
    for n in [*range(1, 80), 257, 1000, 4000]:
        for m in {n, n + 1, n + n // 20, n * 100 // percent}:
            shared = -(-percent * (n + m) // (100 + percent))
            if shared <= n and m >= n:
                rows.append((n, n - shared, m, m - shared))
    table = spark.createDataFrame(rows, "n long, at int, m long, other int")
    ok = jaccard.early(F.col("n"), F.col("at"), percent) & jaccard.can_link(F.col("n"), F.col("n") - F.col("at"), F.col("m"), F.col("m") - F.col("other"), percent)
    later = jaccard.can_link(F.col("n"), F.col("n") - F.col("at") - 1, F.col("m"), F.col("m") - F.col("other"), percent)
    assert len(rows) > 100 and table.where(~ok | later).count() == 0


def test_groups_of_odd_rows(spark):
    rng = random.Random(2)
    one, two = prose(rng, 60), prose(rng, 60)
    rows = [(None, one), (5, one), (6, one), (6, two), (9, two), (9, two), (3, None), (2, ""), (1, "only"), (0, "ONLY")]
    got = _groups(spark, rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, None), (5, 5), (6, 5), (9, 5), (3, 3), (2, 2), (1, 0), (0, 0)}
    assert jaccard.similarity_groups(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        jaccard.similarity_groups(empty(spark), percent=40)


@pytest.mark.parametrize("percent", [60, 80, 85, 93])
def test_linked_sets_share_a_key_and_a_band(spark, percent):
    """At the most differences that a link allows, for small and large sets and any order."""
    rng = np.random.default_rng(percent)
    sizes = set()
    for n in [*range(1, 60), 100, 257, 1000, 4000]:
        levels = rng.integers(0, 4, jaccard.COUNTERS).astype(np.uint8)
        for extra in {0, 1, n * (100 - percent) // percent}:  # one set may be larger
            m = n + extra
            shared = next((x for x in range(n, 0, -1) if 100 * (x - 1) < percent * (n + m - x + 1)), 0)
            if not shared or 100 * shared < percent * (n + m - shared) or n + m == 2 * shared:
                continue
            common = rng.integers(0, 2**64, shared, dtype=np.uint64)
            a = np.sort(np.concatenate([common, rng.integers(0, 2**64, n - shared, dtype=np.uint64)]))
            b = np.sort(np.concatenate([common, rng.integers(0, 2**64, m - shared, dtype=np.uint64)]))
            keys, ends = jaccard.tile_keys(np.concatenate([a, b]), np.array([n, n + m]), levels, percent)
            assert set(keys[: ends[0]].tolist()) & set(keys[ends[0] :].tolist()), (n, m, shared)
            sizes.add((n, m))
    table = spark.createDataFrame([(int(n), int(m)) for n, m in sizes], "n long, m long")
    met = F.arrays_overlap(jaccard.bands(F.col("n"), percent), jaccard.bands(F.col("m"), percent))
    assert len(sizes) > 50 and table.where(~met).count() == 0


def test_frequent_shingles_are_the_last_keys(spark):
    rng = random.Random(9)
    line = " ".join(f"common{i}" for i in range(30))
    table = docs(spark, [(i, f"{prose(rng, 100)} {line}", None) for i in range(300)])
    levels = jaccard.shingle_levels(table.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")), 4)
    raw = np.frombuffer(line.encode(), np.uint8)
    shared, _ = jaccard.shingle_hashes(raw, np.array([0, len(raw)]), 4)
    assert (levels[jaccard._counter(shared)] >= 8 * 8).all() and np.median(levels[levels > 0]) <= 8


def test_bitmaps_bound_the_overlap(spark):
    rng = np.random.default_rng(1)
    rows = []
    for n, m, shared in [(5, 6, 5), (300, 280, 250), (250, 270, 249), (3000, 2900, 100), (40, 40, 0)]:
        common = rng.integers(0, 2**64, shared, dtype=np.uint64)
        a = np.sort(np.concatenate([common, rng.integers(0, 2**64, n - shared, dtype=np.uint64)]))
        b = np.sort(np.concatenate([common, rng.integers(0, 2**64, m - shared, dtype=np.uint64)]))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        small = min(len(x), len(y))
        p, q = jaccard.folded(x, small), jaccard.folded(y, small)
        bound = min(n - int(np.bitwise_count(p & ~q).sum()), m - int(np.bitwise_count(q & ~p).sum()))
        assert bound >= shared == jaccard._common(a, b) and bound < shared + 0.3 * (n + m - 2 * shared) + 3
        rows.append((n, x.view(np.int64).tolist(), m, y.view(np.int64).tolist(), bound))
    assert len({len(r[1]) for r in rows}) > 1 and any(len(r[1]) != len(r[3]) for r in rows)
    table = spark.createDataFrame(rows, "na long, a array<long>, nb long, b array<long>, bound long")
    got = table.select("bound", jaccard.overlap_bound(F.col("na"), F.col("a"), F.col("nb"), F.col("b")).alias("most")).collect()
    assert all(r["bound"] == r["most"] for r in got)


# ---------------------------------------------------------------- op 13

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("__vec", T.StringType()),
    ]
)


def _coded(rows, parts=4, entries=256, rounds=4):
    """vec_id -> (code, error, label) and the digest, with Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0], kept[r][1]))[:entries]
    books = [[cut[r][p] for r in order] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(mine[j]) for col in zip(*mine[j])] if j in mine else e for j, e in enumerate(books[p])]
    out = []
    for (i, _, lab), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), lab))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


def _compressed(spark, rows, **more):
    table = spark.createDataFrame([(*r, "c", "v") for r in rows], VECTORS).repartition(3)
    return codes.compress(table, **more).collect()


def _check(spark, rows, **more):
    got = _compressed(spark, rows, **more)
    want, digest = _coded([r for r in rows if r[1] is None or len(r[1]) == len(rows[0][1])], **more)
    assert sorted([(r["vec_id"], r["code"], r["error"], None) for r in got], key=repr) == sorted(
        [(*w[:2], min(w[2], codes.MAX_LONG), None) for w in want], key=repr
    )
    assert {r["codebooks_sha256"] for r in got} == {digest}
    totals = {}
    for _, _, e, lab in want:
        totals[lab] = totals.get(lab, 0) + e
    assert sorted(r["label_error"] for r in got) == sorted(min(codes.MAX_LONG, totals[w[3]]) for w in want)


def test_codes_against_all_distances(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i) * 3 - 200, rng.normal(0, 0.2, 16).tolist(), int(i) % 5 if i % 7 else None) for i in range(400)]
    _check(spark, rows)
    _check(spark, rows, entries=9, rounds=2)


def test_codes_with_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    grid = [(i, (rng.integers(-2, 3, 8) / 1024).tolist(), i % 2) for i in range(120)]  # many equal distances
    grid += [(i, grid[3][1], None) for i in range(200, 230)] + [(7, grid[8][1], 1), (7, grid[9][1], 1)]
    odd = [(301, None, 1), (302, [], 1), (303, [1.0, None] + [0.0] * 6, 1), (304, [float("nan")] + [0.0] * 7, 1)]
    odd += [(305, [float("inf")] + [0.0] * 7, 1), (306, [1.0] * 7, 1), (307, [1.0] * 12, 2)]
    _check(spark, grid + odd, entries=40)


def test_codes_of_few_and_of_huge_vectors(spark):
    _check(spark, [(i, [0.1 * i, -0.1, -1e-20, 3.0], None) for i in range(5)])
    big = [(i, [(-1.0) ** i * 3e7 * i, 1.5 * i, 1e12 if i == 3 else 0.25, -1e6], 0) for i in range(30)]
    rows = [r for r in big if r[0] != 3] + [(40, [0.0, 0.0, 2e4, 0.0], 1)]
    _check(spark, rows, entries=6)
    got = _compressed(spark, [(1, [1e200, 0.0, 0.0, 0.0], 1), (2, [-1e200, 0.0, 0.0, 0.0], 1), (3, [5e199, 0.0, 0.0, 0.0], 1)], entries=2)
    assert {r["error"] for r in got} <= {0, codes.MAX_LONG} and {r["label_error"] for r in got} == {codes.MAX_LONG}


def test_codes_of_nothing(spark):
    assert codes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    assert _compressed(spark, [(1, None, 1), (2, [1.0, 2.0], 1)]) == []


def test_identifier_is_no_condition(spark):
    got = _compressed(spark, [(None, [0.5] * 4, 1), (None, [0.25] * 4, 1), (2, [0.75] * 4, 1)], entries=1, rounds=0)
    assert [r["error"] for r in sorted(got, key=lambda r: (r["vec_id"] is not None, r["error"]))] == [4 * 256**2, 4 * 512**2, 0]


@pytest.mark.parametrize("kind", [float, object])
def test_tree_leaves_out_subtrees_but_no_nearest_entry(kind):
    rng = np.random.default_rng(8)
    middles = rng.integers(-5000, 5000, (16, 8))
    entries = (middles[rng.integers(0, 16, 256)] + rng.integers(-40, 40, (256, 8))).astype(kind)
    entries[200:] = entries[100:156]  # equal entries
    queries = (middles[rng.integers(0, 16, 500)] + rng.integers(-60, 60, (500, 8))).astype(kind)
    search = codes.Search(entries, codes.build(entries), queries)
    d2 = ((queries[:, None].astype(int) - entries[None].astype(int)) ** 2).sum(2)
    assert (search.index == d2.argmin(1)).all() and (search.best.astype(int) == d2.min(1)).all()
    assert search.measured < 0.4 * d2.size
