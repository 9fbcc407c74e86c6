"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loticote.llm import (
    decontaminate,
    filter_audit,
    infill,
    kernel_quality,
    language,
    mixing,
    pieces,
    repeats,
    secrets,
    sharding,
    shingles,
    token_counts,
    topk,
)
from loticote.llm.common import prepare
from loticote.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return build(prepare(tune(spark)), sf)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op2_minimax_shards")
def op2_minimax_shards(spark: SparkSession, sf: str) -> DataFrame:
    df = sharding.minimax_shards(table(spark, sf, "documents"), 8)
    return df.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_overlap_token_counts")
def op7_overlap_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf, "documents"), path, limit=2048)


TOPK_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM usable q JOIN usable d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(q.v) = len(d.v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


@query("op6_voronoi_topk", TOPK_SQL)
def op6_voronoi_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.voronoi_topk(table(spark, sf, "embeddings"))


@query("op9_owned_secrets")
def op9_owned_secrets(spark: SparkSession, sf: str) -> DataFrame:
    df = secrets.scan(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    return df.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.listed(F.transform(base, place)), 256).alias("base_sha256"),
        secrets.listed(F.transform("spans", place)).alias("spans"),
        "n_live",
        "n_example",
    )


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_language_field")
def op3_language_field(spark: SparkSession, sf: str) -> DataFrame:
    return language.detect_language(table(spark, sf, "documents"))


@query("op1_qgram_leaks")
def op1_qgram_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SHINGLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
held AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
reached AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT sizes.doc_id, n AS n_shingles, least(sizes.doc_id, coalesce(least_y, sizes.doc_id)) AS component_id
FROM sizes LEFT JOIN (SELECT x, min(y) AS least_y FROM reached GROUP BY x) ON x = sizes.doc_id
"""


@query("op8_shingle_join", SHINGLE_SQL)
def op8_shingle_join(spark: SparkSession, sf: str) -> DataFrame:
    found = shingles.similar_documents(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op4_context_mixing")
def op4_context_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.score_texts(table(spark, sf, "documents"))


# Bytes are pairs of hexadecimal digits, so that a window is a substring.
REPEAT_SQL = """
WITH hexed AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
sized AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM hexed),
starts AS (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM sized WHERE n >= 200),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS d FROM starts),
again AS (SELECT doc_id, i FROM windows WHERE d IN (SELECT d FROM windows GROUP BY d HAVING count(*) > 1)),
fresh AS (
  SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 1 ELSE 0 END AS f FROM again),
grouped AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM fresh),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM grouped GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT gaps.doc_id, string_agg(CASE WHEN y IS NULL THEN substr(h, 2 * x + 1)
    ELSE substr(h, 2 * x + 1, 2 * (y - x)) END, '' ORDER BY x) AS k
  FROM gaps JOIN sized USING (doc_id) GROUP BY gaps.doc_id),
counted AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS r, count(*) AS s FROM spans GROUP BY doc_id)
SELECT sized.doc_id, n AS n_bytes, coalesce(r, 0) AS n_removed, coalesce(s, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM sized LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op10_prefix_free_repeats", REPEAT_SQL)
def op10_prefix_free_repeats(spark: SparkSession, sf: str) -> DataFrame:
    df = repeats.remove_repeats(table(spark, sf, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return df.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


INFILL_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h
  FROM cut),
placed AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s
  FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


@query("op11_swar_infill", INFILL_SQL)
def op11_swar_infill(spark: SparkSession, sf: str) -> DataFrame:
    df = infill.fill_in_middle(table(spark, sf, "documents"))
    return df.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


AUDIT_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts),
firsts AS (SELECT t, min(doc_id) AS least_id FROM texts GROUP BY t),
said AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
     coalesce(worded.doc_id > least_id, false)] AS f
  FROM worded JOIN firsts USING (t) LEFT JOIN said ON said.doc_id = worded.doc_id),
patterns AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY part, f),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)),
steps AS (
  SELECT o, s, list_transform(string_split(o, ''), lambda x: ascii(x) - 64) AS p
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) WHERE length(o) = 5),
found AS (
  SELECT part, o, s, n, good, toxic, f[p[s]] AS fails, list_bool_or(list_transform(p[1:s - 1], lambda i: f[i])) AS gone,
    len(list_filter(f, lambda b: b)) = 1 AS alone
  FROM patterns, steps),
counted AS (
  SELECT part, o, s, coalesce(sum(n) FILTER (NOT fails AND NOT coalesce(gone, false)), 0) AS kept,
    coalesce(sum(n) FILTER (fails AND NOT coalesce(gone, false)), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (fails AND alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT coalesce(gone, false)), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (fails AND NOT coalesce(gone, false)), 0) AS toxic_lost
  FROM found GROUP BY part, o, s)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, substr(o, s, 1)) AS BIGINT) AS shapley
FROM counted
"""


@query("op12_survival_audit", AUDIT_SQL)
def op12_survival_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op13_fourier_quality")
def op13_fourier_quality(spark: SparkSession, sf: str) -> DataFrame:
    return kernel_quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
