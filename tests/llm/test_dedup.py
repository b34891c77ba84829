"""Exact copies (op 4), near copies (op 2), repeated passages (op 3)."""

import hashlib
import os
import random
import time

import numpy as np
import pytest
from cases import SF001, docs, empty, near_groups, prose, shingles, texts
from pyspark.sql import functions as F
from streamledger.llm import common, exact, graph, near, suffix


@pytest.mark.parametrize("keep,fan_in", [("min", 2), ("max", 8)])
def test_exact_against_grouping_by_text(spark, keep, fan_in):
    rows = [(i, t, "en") for i, t in enumerate(texts())] + [(None, "null id", None), (None, None, None)]
    got = exact.exact_dedup(docs(spark, rows, 7), keep=keep, fan_in=fan_in).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    best = min if keep == "min" else max
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for text, ids in groups.items():
        for i in ids:
            if i is None:
                continue
            r = by_id[i]
            # a NULL identifier is the smallest
            want = None if keep == "min" and None in ids else best(x for x in ids if x is not None)
            assert (r["keep_id"], r["group_size"], r["kept"]) == (want, len(ids), i == want)
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact_keeps_one_of_rows_that_repeat_everything(spark):
    got = exact.exact_dedup(docs(spark, [(5, "same", None)] * 9 + [(4, "same", None)], 4), keep="max").collect()
    assert sum(r["kept"] for r in got) == 1 and {r["keep_id"] for r in got} == {5} and {r["group_size"] for r in got} == {10}


def test_empty_tables(spark):
    assert exact.exact_dedup(empty(spark)).count() == 0
    assert near.near_duplicates(empty(spark)).count() == 0
    assert suffix.remove_repeats(empty(spark)).count() == 0


def test_components_on_a_chain_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 2), (2, 3), (3, 1), (9, 9)]
    random.Random(3).shuffle(edges)
    got = {r["id"]: r["comp"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {1: 1, 2: 1, 3: 1}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near(spark, rows, k):
    got = near.near_duplicates(docs(spark, [(i, t, None) for i, t in rows]), words=k).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: r for r in got}


@pytest.mark.parametrize("k", [4, 5])
def test_near_groups_against_all_pairs(spark, k):
    rows = list(enumerate(texts()))
    got, want = _near(spark, rows, k), near_groups(rows, k)
    for i, t in rows:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(shingles(t, k)), want[i], want[i] == i)
    assert len(set(want.values())) < len(rows) - 20


def test_near_groups_of_many_loose_copies(spark, monkeypatch):
    # a ring of edits: pairs link or don't by chance, most of the work is left to the last step
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        copy = list(base)
        for p in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5])):
            copy[p] = f"x{rng.randrange(1000)}"
        rows.append((1000 - i, " ".join(copy)))
    monkeypatch.setattr(near, "TURNS", 1)
    monkeypatch.setattr(near, "PIECE", 2000)  # shingles of 17 members
    got, want = _near(spark, rows, 4), near_groups(rows, 4)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert 1 < len(set(want.values())) < 120


def test_near_copies_at_scale_factor(spark):
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(table, words=4).collect()}
    assert got == near_groups(rows, 4)


def test_near_null_identifier(spark):
    t = prose(random.Random(2), 40)
    got = near.near_duplicates(docs(spark, [(None, t, None), (3, t, None), (4, t, None)])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [("3", 3, True), ("4", 3, False), ("None", None, True)]


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    b = np.concatenate([a[:2400], rng.integers(0, 2**63, 600, dtype=np.uint64)])
    ma, mb = near._minima(a), near._minima(b)
    equal = ((ma ^ mb) & 3 == 0).mean()
    chance = 2.0**-near.BITS
    assert abs((equal - chance) / (1 - chance) - 2400 / 3600) < 0.2
    assert abs((ma == mb).mean() - 2400 / 3600) < 0.15


# ---------------------------------------------------------------- passages


def passages(rows, length):
    """doc -> (n_bytes, n_removed, n_spans, sha256) by remembering every window."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,hot", [(100, suffix.HOT), (100, 3), (57, 2)])
def test_passages_against_all_windows(spark, monkeypatch, length, hot):
    monkeypatch.setattr(suffix, "HOT", hot)  # small: groups are cut into chunks
    monkeypatch.setattr(suffix, "FEW", 32 if hot > 100 else 2)  # small: anchors are spread
    rows = [(3 * i, t, None) for i, t in enumerate(texts())]
    rows.append((1000, " ".join(t for t in texts() if t)[:30000], None))  # repeats others inside one text
    got = suffix.remove_repeats(docs(spark, rows), length=length).collect()
    assert len(got) == len(rows)
    want = passages([r[:2] for r in rows], length)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert all(hashlib.sha256(r["kept_bytes"]).hexdigest() == r["kept_sha256"] for r in got)


def test_earlier_matches_against_pairs():
    rng = np.random.default_rng(4)
    length, n = 60, 80
    reach = length - suffix.GRAM
    text = rng.integers(97, 99, (n, reach + length)).astype(np.uint8)
    base = rng.integers(97, 123, reach + length).astype(np.uint8)
    for i in range(n):  # mostly shared, with a change on either side now and then
        keep_from, keep_to = rng.integers(0, reach), rng.integers(reach + suffix.GRAM, reach + length + 1)
        text[i, keep_from:keep_to] = base[keep_from:keep_to]
    group = np.sort(rng.integers(0, 6, n))
    left = np.where(rng.random(n) < 0.7, reach, rng.integers(0, reach, n))
    right = np.where(rng.random(n) < 0.7, length, rng.integers(suffix.GRAM, length, n))
    has, first = suffix.earlier_matches(text, left, right, group, length)
    for d in range(reach + 1):
        seen = set()
        for i in range(n):
            if left[i] < d or right[i] < length - d:
                assert not has[i, d] and not first[i, d]
                continue
            w = (group[i], text[i, reach - d : reach - d + length].tobytes())
            assert has[i, d] == (w in seen)
            assert not first[i, d] or w not in seen
            seen.add(w)


def test_passage_null_identifier_comes_first(spark):
    t = prose(random.Random(5), 80)
    got = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(docs(spark, [(None, t, None), (-5, t, None)])).collect()}
    assert got == {None: 0, -5: len(t.encode())}


def test_written_tables_leave_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for folder in manager.localDirsString() for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(key), shuffled()
    table = common.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-tidy")
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(key) == kept
    assert sorted(map(tuple, table.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
