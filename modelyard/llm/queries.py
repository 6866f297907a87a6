"""Registered queries of this package: (spark, table folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from modelyard.llm import (
    byte_bpe,
    centroids,
    cover_tree,
    language,
    order_minhash,
    packing,
    periodic_runs,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from modelyard.llm.common import read_documents, text_fold

Query = Callable[[SparkSession, str], DataFrame]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = {"<|endoftext|>": 50256}  # the added token of byte_bpe_50k.json, whose vocabulary RANKS holds


def op1_token_counts(spark, base):
    return token_counts.count_tokens(read_documents(spark, base), PIECES)


def op2_cover_tree_topk(spark, base):
    return cover_tree.top_k(spark.read.parquet(f"{base}/embeddings.parquet"))


def op3_suffix_array_dedup(spark, base):
    return suffix_dedup.remove_repeats(read_documents(spark, base)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_toxicity(spark, base):
    docs = read_documents(spark, base)
    model = toxicity.train(docs, spark.read.parquet(f"{base}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (text_fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_order_minhash(spark, base):
    return order_minhash.with_edits(read_documents(spark, base))


def op6_simhash(spark, base):
    return simhash.near_duplicates(read_documents(spark, base))


def op7_packing(spark, base):
    return packing.pack(read_documents(spark, base), RANKS, public_tokenizers.PATTERN, SPECIAL)


def op8_secret_scan(spark, base):
    found = secrets.find(read_documents(spark, base))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op9_language(spark, base):
    docs = read_documents(spark, base)
    learned = language.profiles(docs.where(text_fold(F.col("doc_id"), 3) != 1))
    return language.identify(docs, learned).select(
        "doc_id", (text_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op10_byte_bpe(spark, base):
    return byte_bpe.round_trip(read_documents(spark, base), MULTI_RANKS, public_tokenizers.PATTERN)


def op11_periodic_runs(spark, base):
    return periodic_runs.digest(periodic_runs.find(periodic_runs.plant(read_documents(spark, base))))


def op12_quality(spark, base):
    docs = read_documents(spark, base)
    model = quality.train(docs, spark.read.parquet(f"{base}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id",
        (text_fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op13_centroids(spark, base):
    return centroids.clusters(spark.read.parquet(f"{base}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_cover_tree_topk,
        op3_suffix_array_dedup,
        op4_toxicity,
        op5_order_minhash,
        op6_simhash,
        op7_packing,
        op8_secret_scan,
        op9_language,
        op10_byte_bpe,
        op11_periodic_runs,
        op12_quality,
        op13_centroids,
    )
}

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 10
"""


def _scan_sql(kind: str, place: int, pattern: str, group: int, test: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT row, owner, '{kind}' AS kind, {place} AS place, start, start + length(m[i]) AS "end", v[i] AS value
  FROM (
    SELECT row, owner, m, v, i,
           list_sum(list_transform(b[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (
      SELECT row, owner, m, v, b, unnest(generate_series(1, len(m))) AS i
      FROM (
        SELECT row, owner, regexp_extract_all(text, '{quoted}', 0) AS m, regexp_extract_all(text, '{quoted}', {group}) AS v,
               string_split_regex(text, '{quoted}') AS b
        FROM d
      )
    )
  )
  WHERE {test}"""


def _secrets_sql() -> str:
    scans = [
        _scan_sql(kind, place, pattern, group, f"length(value) >= {least}")
        for place, (kind, pattern, group, least) in enumerate(secrets.KINDS)
    ]
    mixed = f"length(value) >= {secrets.MIXED_LEAST} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')"
    last = _scan_sql(secrets.OWNED, len(secrets.KINDS), secrets.MIXED, 0, mixed)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, chr(0)) AS owner, coalesce(text, '') AS text FROM documents
), base AS ({" UNION ALL ".join(scans)}
), mixed AS ({last}
), candidates AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM mixed g
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = g.row AND b.start < g."end" AND b."end" > g.start)
), owners AS (
  SELECT value, count(DISTINCT owner) AS owners FROM candidates GROUP BY value
), kept AS (
  SELECT c.*, kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT) AS label
  FROM candidates c JOIN owners USING (value)
  WHERE kind <> '{secrets.OWNED}' OR owners < 2
), per_row AS (
  SELECT row,
         count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(label, ',' ORDER BY start, place) FILTER (kind <> '{secrets.OWNED}') AS base,
         string_agg(label, ',' ORDER BY start, place) AS spans
  FROM kept GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_row USING (row)
"""


def _centroids_sql(k: int = 16, rounds: int = 3) -> str:
    """Every round as three CTEs: distances to all centroids, the nearest, and the means of its vectors."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT row, vec_id, v, c AS cluster, distance
  FROM (
    SELECT row, vec_id, v, c,
           list_sum(list_transform(list_zip(v, p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
    FROM vectors, centroids{r}
  )
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1
)""")
        if r < rounds:
            steps.append(f"""centroids{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.p, old.p) AS p
  FROM centroids{r} old
  LEFT JOIN (
    SELECT cluster AS c, list(mean ORDER BY d) AS p
    FROM (
      SELECT cluster, d, CAST(floor_div AS HUGEINT) AS mean
      FROM (
        SELECT cluster, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
        FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM near{r})
        GROUP BY cluster, d
      )
    )
    GROUP BY cluster
  ) m USING (c)
)""")
    body = ", ".join(steps)
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v AS p
  FROM vectors
  QUALIFY c < {k}
), {body}, hashes AS (
  SELECT c AS cluster, sha256(array_to_string(p, ',')) AS centroid_sha256 FROM centroids{rounds}
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{rounds} JOIN hashes USING (cluster)
"""


ORACLE: dict[str, str] = {
    "op2_cover_tree_topk": _TOP_K,
    "op8_secret_scan": _secrets_sql(),
    "op13_centroids": _centroids_sql(),
}
