"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import audit, bpe, codes, decontaminate, exact, jaccard, langid, near, pitman_yor, quality, secrets, sharding, suffix
from .common import read_table
from .tokenizers import tokenizer_file


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the identifier as text leaves the remainder ``fold``; a NULL
    identifier counts as inside (it is never learnt from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs, F.col("lang"), F.col("text"), ~in_fold("doc_id", 5, 0))
    found = langid.identify(docs, model)
    return found.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "n_langs")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(read_table(spark, sf_dir, "documents"), length=100).drop("kept_bytes")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read_table(spark, sf_dir, "documents"), keep="max")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(of("novel")).cast("long").alias("n_novel"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_file(), decode=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), n_shards=24)


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 7, 2)
    model = pitman_yor.train(docs.where(~held_out).select(F.coalesce("text", F.lit("")).alias("text")))
    return pitman_yor.score(docs, model, held_out=held_out)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("text_hash")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read_table(spark, sf_dir, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_minhash": op2_minhash,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_sharding": op8_sharding,
    "op9_pitman_yor": op9_pitman_yor,
    "op10_quality": op10_quality,
    "op11_filter_audit": op11_filter_audit,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

_GROUPS_SQL = """
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    met AS (
        SELECT a.doc_id AS x, b.doc_id AS y, a.n AS na, b.n AS nb, count(*) AS c
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM met WHERE 100 * c >= {percent} * (na + nb - c)),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT doc_id AS node, doc_id AS origin FROM documents
              UNION SELECT w.y, r.origin FROM reach r JOIN ways w ON w.x = r.node WHERE w.y > r.origin)
    SELECT doc_id, CAST(any_value(len(s)) AS BIGINT) AS n_shingles, min(origin) AS component_id{more}
    FROM sets JOIN reach ON node = doc_id GROUP BY doc_id
"""


def _codes_sql(rounds: int = 4) -> str:
    """Every round assigns all parts and averages the entries; list_dot_product of whole
    numbers is exact."""
    sql = """
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, range(4) r(p)),
    book0 AS MATERIALIZED (
        SELECT p, entry, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < 256)"""
    for i in range(rounds + 1):
        sql += f""",
    near{i} AS MATERIALIZED (
        SELECT vec_id, p, min((d, entry)) AS best FROM (
            SELECT vec_id, p, entry, list_dot_product(a.x, a.x) - 2 * list_dot_product(a.x, b.x) + list_dot_product(b.x, b.x) AS d
            FROM parts a JOIN book{i} b USING (p)) GROUP BY vec_id, p)"""
        if i < rounds:
            sql += f""",
    mean{i} AS (
        SELECT p, entry, list(m ORDER BY k) AS x FROM (
            SELECT p, entry, k, floor(sum(y) / count(*)) AS m
            FROM (SELECT p, best[2] AS entry, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM near{i} JOIN parts USING (vec_id, p))
            GROUP BY p, entry, k) GROUP BY p, entry),
    book{i + 1} AS MATERIALIZED (
        SELECT p, entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m USING (p, entry))"""
    return sql + f""",
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
        FROM near{rounds} GROUP BY vec_id),
    digest AS (
        SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, entry)) AS h
        FROM book{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest
    """


LLM_ORACLES: dict[str, str] = {
    "op2_minhash": _GROUPS_SQL.format(percent=80, more=", doc_id = min(origin) AS kept"),
    "op12_jaccard_join": _GROUPS_SQL.format(percent=85, more=""),
    "op13_vector_codes": _codes_sql(),
    "op4_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_filter_audit": """
        WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([0, 1, 2, 3, 4]) AS bit),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT filter_order, CAST(s AS INTEGER) AS step, bit,
                   (SELECT coalesce(sum(1 << l.bit), 0) FROM letters l WHERE contains(filter_order[:s - 1], l.x)) AS before
            FROM orders, range(1, 6) r(s), letters WHERE letters.x = filter_order[s]),
        texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        marks AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        masks AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT
                   + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
            FROM texts LEFT JOIN marks USING (doc_id)),
        counted AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL),
        audited AS (
            SELECT part, filter_order, step, bit,
                   sum(n) FILTER (mask & (before | (1 << bit)) = 0) AS kept,
                   sum(n) FILTER (mask & before = 0 AND mask & (1 << bit) <> 0) AS removed,
                   sum(n) FILTER (mask & before <> 0 AND mask & (1 << bit) <> 0) AS redundant,
                   sum(n) FILTER (mask = 1 << bit) AS unique_fails,
                   sum(n) FILTER (mask & before = 0 AND mask & (1 << bit) <> 0 AND good) AS good_lost,
                   sum(n) FILTER (mask & before = 0 AND mask & (1 << bit) <> 0 AND toxic) AS toxic_lost
            FROM counted, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step,
               CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM audited
    """,
}
