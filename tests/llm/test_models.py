"""Decontamination (op 6), Pitman-Yor scoring (op 9), quality (op 10), and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import regex
from cases import SF001, SYLLABLES, docs, empty, near_groups, prose, texts, words
from pyspark.sql import functions as F
from streamledger.llm import common, decontaminate, pitman_yor, quality, queries

# ---------------------------------------------------------------- decontamination


def test_leaks_verbatim_paraphrased_and_none(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(16, 50), rng.choice(["en", "de"]))) for i in range(30)]
    rows, want = [], set()
    for i in range(60):
        rows.append((i, prose(rng, rng.randint(5, 300)), None))
    for i, (item, text) in enumerate(items[:24]):
        w = text.split()
        if i % 3 == 1:  # a paraphrase: some words changed
            for p in rng.sample(range(len(w)), len(w) // 6):
                w[p] = prose(rng, 1)
        if i % 3 == 2:  # other case and punctuation
            w = [x.upper() + "," for x in w]
        rows.append((100 + i, f"{prose(rng, rng.randint(0, 200))} {' '.join(w)} {prose(rng, rng.randint(0, 90))}", None))
        want.add((100 + i, item))
    rows += [(300, None, None), (301, "", None), (None, items[0][1], None), (302, items[1][1], None), (302, items[1][1], None), (303, prose(rng, 20_000), None)]
    bench = items + [(900, None), (901, ""), (902, "the"), (None, prose(rng, 30))]
    table = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("kept", F.lit(2))
    got = decontaminate.decontaminate(docs(spark, rows), table).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], r["item_id"]) for r in got if r["contaminated"]}
    assert found == want | {(302, items[1][0])}
    leaks = decontaminate.find_leaks(docs(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == found | {(None, items[0][0])}
    assert all(r["kept"] != r["contaminated"] for r in got)


@pytest.mark.parametrize("share", [3, 1])
def test_an_item_in_many_documents_is_found_in_each(spark, share):
    rng = random.Random(31)
    items = [(i, prose(rng, rng.randint(15, 59))) for i in range(40)] + [(40, prose(rng, 18)), (41, prose(rng, 38))]
    rows, want = [], set()
    for i in range(300):
        w = prose(rng, 120).split()
        if i % share == 0:
            k = 40 + (i // share) % 2
            w[60:60] = items[k][1].split()
            want.add((i, k))
        rows.append((i, " ".join(w), None))
    table = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(docs(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == want
    assert all(r["lcs"] == 1.0 for r in leaks)


def test_items_without_spaces_and_short_items(spark):
    items = [
        (1, "水の沸点は標高によってどのように変わりますか。理由も答えなさい"),
        (2, "光合作用在植物细胞的哪个部分进行?请说明原因"),
        (3, "น้ำเดือดที่อุณหภูมิเท่าไรเมื่ออยู่บนภูเขาสูง"),
        (4, "Define osmotic pressure!"),
        (5, "the"),
    ]
    rng = random.Random(32)
    rows = [(i, f"{prose(rng, 60)} {t} {prose(rng, 60)}", None) for i, t in items] + [(100 + i, prose(rng, 80), None) for i in range(40)]
    rows += [(10, "注意:" + items[1][1] + "谢谢大家今天的参与", None), (11, "define pressure, osmotic", None), (12, "光の中で植物は育ちます。山の水はきれいです", None)]
    table = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(docs(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(1, 1), (2, 2), (3, 3), (4, 4), (10, 2)}


def test_every_planted_item_is_found(spark):
    got = {r["doc_id"] for r in queries.op6_decontamination(spark, SF001).where("contaminated").collect()}

    def flat(t):
        return " " + " ".join(regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())) + " "

    items = [flat(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = {r["doc_id"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect() if any(x in flat(r["text"]) for x in items)}
    assert got == want and want


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark), none).where("kept").count() == len(texts())
    assert decontaminate.decontaminate(empty(spark), one).count() == 0


def test_the_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    rng = random.Random(51)
    n = 4300
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([0, 3, 20, 70]))), None) for i in range(n)]
    items = [(0, " ".join(f"q{i}" for i in range(40))), (1, "a b c d e f g")]
    rows.append((n, f"w1 w2 {items[0][1]} w3", None))  # the item's words don't count here
    fitted = []

    def space(table, idf):
        q = np.random.default_rng(2).standard_normal((decontaminate.FEATURES, 6)).astype(np.float32)
        fitted.append((table.count(), idf, q, decontaminate._gram_times(table, idf, q)))
        return np.zeros((decontaminate.FEATURES, decontaminate.LATENT), np.float32)

    monkeypatch.setattr(decontaminate, "latent_space", space)
    table = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(docs(spark, rows), table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaks} == {(n, 0)}
    ((count, idf, q, got),) = fitted
    assert count == len(rows) + len(items)

    def features(text):
        words, _ = decontaminate._text_words([text])
        return decontaminate._features(words).tolist()

    seen = Counter()
    want = np.zeros(q.shape)
    for text, own in [(t, False) for _, t, _ in rows[:-1]] + [("w1 w2 w3", False)] + [(t, True) for _, t in items]:
        f = features(text)
        seen.update(() if own else set(f))
        starts = range(0, max(1, len(f) - decontaminate.HALF), decontaminate.HALF) if f else ()
        for a in starts:
            tf = Counter(f[a : a + 2 * decontaminate.HALF])
            at = np.array(list(tf))
            x = np.array(list(tf.values())) * idf[at].astype(float)
            want[at] += x[:, None] * (x @ q[at])[None, :] / (x @ x)
    assert idf == pytest.approx(np.square(np.log((1 + len(rows)) / (1 + np.array([seen[f] for f in range(decontaminate.FEATURES)])))), rel=1e-5)
    assert got == pytest.approx(want, rel=1e-3, abs=1e-3 * np.abs(want).max())


def test_the_last_pass_of_the_svd_gives_products_only(spark, monkeypatch):
    rng = random.Random(12)
    common.prepare(spark)
    rows = [(i, prose(rng, rng.choice([0, 1, 7, 16, 17, 40, 300, 9000]))) for i in range(60)]
    table = common.materialise(decontaminate.featurise(spark.createDataFrame(rows, "__id long, __text string"), None), "passages")
    rand = np.random.default_rng(3)
    idf = rand.random(decontaminate.FEATURES).astype(np.float32) + 0.1
    q = np.linalg.qr(rand.standard_normal((decontaminate.FEATURES, 24)))[0].astype(np.float32)
    g = decontaminate._gram_times(table, idf, q)
    np.testing.assert_allclose(decontaminate._gram_within(table, idf, q), q.T @ g, rtol=1e-3, atol=1e-4 * np.abs(g).max())
    times = decontaminate._gram_times
    calls = []
    monkeypatch.setattr(decontaminate, "_gram_times", lambda *args: calls.append(1) or times(*args))
    assert decontaminate.latent_space(table, idf).shape == (decontaminate.FEATURES, decontaminate.LATENT)
    assert len(calls) == decontaminate.PASSES - 1


def test_common_subsequence_against_the_table():
    rng = random.Random(6)
    for _ in range(60):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        mask = {}
        for i, x in enumerate(a):
            mask[x] = mask.get(x, 0) | 1 << i
        assert decontaminate.common_subsequence(len(a), mask, b) == best[-1][-1]


# ---------------------------------------------------------------- Pitman-Yor


def test_scores_counts_and_base(spark):
    rows = [(i, t, None) for i, t in enumerate(texts())] + [(None, "null id", None)]
    table = docs(spark, rows)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    model = pitman_yor.train(table.where(~held).select(F.coalesce("text", F.lit("")).alias("text")))
    got = pitman_yor.score(table, model, held_out=held).collect()
    assert len(got) == len(rows)
    counts = Counter()
    for i, t, _ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    text_of = {i: t for i, t, _ in rows}
    for r in got:
        own = [*words(text_of[r["doc_id"]]), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] <= 0
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(own)))
    # the same again, and the same when few tokens go with the tasks
    again = {r["doc_id"]: r["score"] for r in pitman_yor.score(table, model).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], rel=1e-9) for r in got)


def test_frequent_tokens_are_only_a_shortcut(spark, monkeypatch):
    table = docs(spark)
    model = pitman_yor.train(table.select(F.coalesce("text", F.lit("")).alias("text")))
    full = {r["doc_id"]: r for r in pitman_yor.score(table, model).collect()}
    monkeypatch.setattr(pitman_yor, "HEAD", 3)
    for r in pitman_yor.score(table, model).collect():
        assert r["score"] == pytest.approx(full[r["doc_id"]]["score"], rel=1e-5)
        assert r["n_known"] == full[r["doc_id"]]["n_known"] == r["n_tokens"]


def test_probabilities_of_a_context_sum_to_one(spark):
    model = pitman_yor.train(docs(spark).select(F.coalesce("text", F.lit("")).alias("text")))
    rows, left = model.table.collect(), model.left
    assert len(rows) == model.setup.n_types and sum(r["c"] for r in rows) == model.setup.n_tokens
    for context in (0, int(np.argmax(model.setup.context_customers)), int(np.argmin(model.setup.context_customers))):
        total = np.mean(left[context] * np.array(model.unknown))
        for r in rows:
            seen = list(r["contexts"])
            if context in seen:
                total += 10 ** r["logp"][seen.index(context)]
            else:
                total += np.mean(left[context] * np.array(r["parent"]))
        assert total == pytest.approx(1, abs=1e-4)


def test_model_beats_its_base_on_held_out_documents(spark):
    got = queries.op9_pitman_yor(spark, SF001).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_scores_without_training(spark):
    none = pitman_yor.train(empty(spark).select("text"))
    assert pitman_yor.score(empty(spark), none).count() == 0
    for r in pitman_yor.score(docs(spark, [(1, "a b", None), (2, None, None)]), none).collect():
        assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and r["score"] == pytest.approx(0)


def test_seating_has_the_expected_number_of_tables():
    n = 40_000
    key = pitman_yor.mix64(np.arange(n, dtype=np.uint64))
    for customers, new, d in ((2, 0.5, 0.5), (30, 0.3, 0.7), (400, 0.2, 0.6)):
        t = pitman_yor.seat(np.full(n, float(customers)), np.full(n, new), d, key, 5)
        p = np.zeros(customers + 1)  # the exact distribution, customer by customer
        p[1] = 1.0
        for k in range(1, customers):
            q = new / (new + np.maximum(k - d * np.arange(customers + 1), 1e-9))
            p = p * (1 - q) + np.append(0, (p * q)[:-1])
        mean = (p * np.arange(customers + 1)).sum()
        assert t.min() >= 1 and t.max() <= customers and abs(t.mean() / mean - 1) < 0.05


def test_kernels_of_the_decontamination_against_plain_sums():
    rng = np.random.default_rng(8)
    row, feature = np.sort(rng.integers(0, 300, 5000)), rng.integers(0, 40, 5000).astype(np.uint16)
    far = (1 << 32) // decontaminate.FEATURES - 150  # rows on either side of what 32 bits hold
    for shift in (0, far - 150, far):
        cells, n = decontaminate._distinct(row + shift, feature)
        want = Counter(((row + shift) * decontaminate.FEATURES + feature).tolist())
        assert cells.tolist() == sorted(want) and n.tolist() == [want[c] for c in sorted(want)]
    assert [len(x) for x in decontaminate._distinct(row[:0], feature[:0])] == [0, 0]
    data = rng.integers(0, 256, 2 * common._CHUNK + 7).astype(np.uint8)
    for size in (0, 1, common._CHUNK, common._CHUNK + 1, len(data)):
        terms = common._BYTE_WEIGHT[data[:size]] * common._power_table("p", common._BASE, size)
        assert (common.prefix_hash(data[:size]) == np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])).all()


def test_runs_of_items_are_seen_among_other_words():
    """What tells that a run is in no item loses no copy."""
    rng = random.Random(61)
    items = [(i, prose(rng, 20), None) for i in range(6)]
    block = decontaminate.load_items(items, np.ones((decontaminate.FEATURES, 4), np.float32))
    assert 0 < block.seen.sum() <= len(block.seeds[0]) and block.seen[block.seeds[0] >> np.uint64(64 - decontaminate.SEEN_BITS)].all()
    texts = [f"{prose(rng, 200)} {text} {prose(rng, 100)}" for _, text, _ in items] + [prose(rng, 400)]
    words, per_doc = decontaminate._text_words(texts)
    places = {(d, k) for d, k, _, _ in decontaminate.copied_places(words, per_doc, block)}
    assert places == {(i, i) for i in range(6)}
    none = decontaminate.load_items([], np.ones((decontaminate.FEATURES, 4), np.float32))
    assert not list(decontaminate.copied_places(words, per_doc, none))


# ---------------------------------------------------------------- quality


def plain_kneser_ney(sample):
    """Probabilities by dictionaries, order by order."""
    order = quality.ORDER
    top = Counter()
    for t in sample:
        b = b"\n" * (order - 1) + t.encode()
        top.update(b[i : i + order] for i in range(len(b) - order + 1))
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    stats = {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (max(1, sum(v == i for v in c.values())) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [0] + [min(max(0.05, x), i - 0.05) for i, x in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
        total, freed = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            freed[g[:-1]] += d[min(v, 3)]
        stats[k] = d, total, freed

    def p(g):
        if not g:
            return 1 / 256
        d, total, freed = stats[len(g)]
        if g[:-1] not in total:
            return p(g[1:])
        c = counts[len(g)].get(g, 0)
        return ((c - d[min(c, 3)]) if c else 0) / total[g[:-1]] + freed[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def test_bits_against_plain_kneser_ney(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 30), "en") for i in range(25)]
    trusted = [r for r in rows if r[0] < 20]
    ids = spark.createDataFrame([(r[0],) for r in trusted], "id long")
    fold = {r["id"]: r["f"] for r in ids.select("id", quality.fold_column("id").alias("f")).collect()}
    model = quality.train(docs(spark, rows), ids)
    p = plain_kneser_ney([t for i, t, _ in trusted if fold[i] > 0])
    assert sum(p(b"the " + bytes([x])) for x in range(256)) == pytest.approx(1)
    rows += [(50, "ÑÑ%%% unlike", None), (51, None, None), (52, "", None), (53, "x", None)]
    for r in quality.score(docs(spark, rows), model, ["doc_id"]).collect():
        t = dict((i, t) for i, t, _ in rows)[r["doc_id"]] or ""
        b = b"\n" * 4 + t.encode()
        want = [-math.log2(p(b[i : i + 5])) for i in range(len(b) - 4)]
        assert r["n_bytes"] == len(want)
        assert r["bits"] == pytest.approx(sum(want) / len(want), rel=1e-4) if want else r["bits"] is None


@pytest.mark.parametrize("piece", [None, 14_000])
def test_the_model_is_trained_on_whole_trusted_documents(spark, monkeypatch, piece):
    rng = random.Random(52)
    rows = [(i, prose(rng, 30), "en") for i in range(8)]
    ids = spark.createDataFrame([(r[0],) for r in rows], "id long")
    fold = {r["id"]: r["f"] for r in ids.select("id", quality.fold_column("id").alias("f")).collect()}
    long = next(i for i in fold if fold[i] > 0)
    rows[long] = (long, " ".join(f"{prose(rng, 9)} {rng.randrange(10**6)}" for _ in range(900)), "en")
    assert len(rows[long][1]) > 40_000
    if piece:
        monkeypatch.setattr(quality, "PIECE", piece)
    table = docs(spark, [*rows, (None, "no identifier 77", None), (3, "twice", "en"), (3, None, "en")])
    model = quality.train(docs(spark, rows), ids)
    assert (model.n_pieces > 1) == bool(piece)
    p = plain_kneser_ney([t for i, t, _ in rows if fold[i] > 0])
    got = quality.score(table, model, ["doc_id", "text"]).collect()
    assert len(got) == table.count()
    for r in got:
        b = b"\n" * 4 + (r["text"] or "").encode()
        want = [-math.log2(p(b[i : i + 5])) for i in range(len(b) - 4)]
        assert r["n_bytes"] == len(want)
        assert r["bits"] == pytest.approx(sum(want) / len(want), rel=1e-4) if want else r["bits"] is None


def test_texts_stay_where_trusted_documents_are_counted(spark, monkeypatch):
    """The same counts from one pass, several, and the shuffle that stands in for too many; in
    passes, no text is shuffled, whatever Spark would broadcast by itself."""
    rng = random.Random(31)
    rows = [(i if i % 9 else None, prose(rng, 12), None) for i in range(60)] + [(5, "twice", None)]
    table = docs(spark, rows).select(F.col("doc_id").alias("id"), "text")
    fit = spark.createDataFrame([(i,) for i in range(0, 80, 5)], "id long")
    want = Counter()
    for i, text, _ in rows:
        if i is not None and i % 5 == 0:
            raw = b"\n" * (quality.ORDER - 1) + text.encode()
            want.update(int.from_bytes(raw[j : j + quality.ORDER], "big") for j in range(len(text.encode())))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for piece, passes in ((1 << 20, 8), (3, 8), (3, 2)):
            monkeypatch.setattr(quality, "TRUSTED", piece)
            monkeypatch.setattr(quality, "PASSES", passes)
            got = quality.trusted_grams(table, fit)
            assert {r["g"]: r["n"] for r in got.collect()} == want
            if piece > 3:
                assert "SortMergeJoin" not in got._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_quality_verdicts(spark):
    rng = random.Random(12)
    clean = [(i, prose(rng, rng.randint(10, 80), lang), lang) for i, lang in enumerate(["en", "de"] * 150)]
    junk = [(1000 + i, " ".join(w.upper() + rng.choice(["%%%", "!!", "&&&"]) for w in prose(rng, 40).split()), "en") for i in range(20)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, prose(rng, 30), None), (2003, prose(rng, 30), "xx"), (2004, prose(rng, 5000), "en"), (None, prose(rng, 30), "en")]
    labels = [(i, 1) for i in range(0, 300, 2)] + [(i, 1) for i in range(1, 300, 4)] + [(1000, 0), (1001, None), (None, 1), (2, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash")).withColumn("lang", F.lit("zz"))
    got = quality.classify(docs(spark, clean + junk + odd), table).collect()
    assert len(got) == len(clean + junk + odd)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert not kept & {i for i, _, _ in junk}
    assert len({i for i, _, _ in clean} - kept) <= 2
    assert {2000, 2001, 2002, 2003, 2004, None} <= kept
    nothing = quality.classify(docs(spark, junk), table.where("false"))
    assert nothing.where("kept").count() == len(junk)
    assert quality.classify(empty(spark), table).count() == 0


def test_one_odd_trusted_document_does_not_set_a_limit(spark):
    rng = random.Random(41)

    def odd():
        return "".join(rng.choice("0123456789+-/#=ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(102))

    n = 700
    clean = [(i, prose(rng, rng.randint(10, 80), lang), lang) for i, lang in enumerate(["en", "en", "de"] * (n // 3))]
    folds = spark.range(5000, 5100).select(F.col("id"), quality.fold_column("id").alias("f")).where("f = 0").orderBy("id").collect()
    strange = folds[0]["id"]  # a trusted document of the calibration fold
    junk = [(6000 + i, odd(), "de") for i in range(20)]
    labels = [(i, 1) for i, _, _ in clean] + [(strange, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.classify(docs(spark, clean + [(strange, odd(), "de")] + junk), table).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert not kept & {i for i, _, _ in junk}
    assert len({i for i, _, _ in clean} - kept) <= 0.02 * n


# ---------------------------------------------------------------- pipeline


def test_pipeline_stage_by_stage(spark):
    full = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "exact_stage", "near_stage", "decontamination_stage", "token_stage"]
    now = {r["doc_id"]: r["text"] for r in full.collect()}
    table = full
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = corpus_pipeline.materialise(stage(spark, table, SF001), "test-stage")
        assert table.schema == full.schema
        got = {r["doc_id"]: r["text"] for r in table.collect()}
        assert all(now[i] == t for i, t in got.items())
        gone = set(now) - set(got)
        if name == "quality_classifier":
            assert gone and not any(labels.get(i) == 1 for i in gone)
            bad = [i for i in now if labels.get(i) == 0]
            assert sum(i in gone for i in bad) >= 0.5 * len(bad)
        elif name == "exact_dedup":
            best = {}
            for i, t in now.items():
                best[t] = max(i, best.get(t, i))
            assert set(got) == set(best.values())
        elif name == "minhash_near_dedup":
            assert set(got) == {i for i, c in near_groups(list(now.items()), 5).items() if i == c}
        else:
            items = [" ".join(regex.findall(r"[\p{L}\p{N}]+", r["text"].lower())) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
            flat = {i: " ".join(regex.findall(r"[\p{L}\p{N}]+", t.lower())) for i, t in now.items()}
            assert gone == {i for i, t in flat.items() if any(x in t for x in items)}
        now = got
    last = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in now.items()}


def test_stages_on_odd_tables(spark):
    rows = [(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (2, None, None), (3, "", None), (None, "x y z", None), (4, "other words here", "en")]
    table = docs(spark, rows)
    out = corpus_pipeline.exact_stage(spark, table, SF001)
    assert out.columns == table.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [("1", "a b c d e f g"), ("3", ""), ("4", "other words here"), ("None", "x y z")]
    assert corpus_pipeline.near_stage(spark, out, SF001).count() == 4
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF001).count() == 0


def test_registered_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {next(n for n in names if n.startswith(f"op{i}_")) for i in range(1, 11)} <= names
    assert corpus_pipeline.ORACLE_SQL is None and "op4_exact_dedup" in entry.oracle_sql()
    assert SYLLABLES["el"]
