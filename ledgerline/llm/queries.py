"""Registered queries of the operators, each over its whole table, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, chat_format, clustering, decontamination, hard_negatives, near_dedup, quality, repeats, secret_scan, token_files, topk, toxicity, url_filter
from ledgerline.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_scan(_table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "llm-token-files")
    token_files.write(_table(spark, sf_dir, "documents"), out, tokenizer_path())
    return token_files.digest(token_files.read(spark, out))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.perspectives(_table(spark, sf_dir, "conversations"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), shifted)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_suffix_dedup,
        op3_bpe_round_trip,
        op4_quality_rules,
        op5_decontamination,
        op6_toxicity,
        op7_token_files,
        op8_url_filter,
        op9_chat_format,
        op10_minhash_dedup,
        op11_hard_negatives,
        op12_exact_top_k,
        op13_centroid_clustering,
    )
}

_BLOCKED = " OR ".join(f"name LIKE '{host.replace('*', '%')}'" for host, _ in url_filter.BLOCK_GLOBS)

URL_FILTER_SQL = rf"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_extract(coalesce(rest, ''), '^[^?#]*'), '^[^/]*([\s\S]*)$', 1) AS path
  FROM u
), r AS (
  SELECT *, '.' || regexp_replace(regexp_replace(regexp_replace(host, '^[\s\S]*@', ''), ':[0-9]*$', ''), '\.$', '') AS name, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN {_BLOCKED} THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

def _escaped(c: str) -> str:
    return f"replace(replace({c}, '<\\', '<\\\\'), '<|', '<\\|')"


CHAT_FORMAT_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, {_escaped("coalesce(text, '')")} AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS position
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), j AS (
  SELECT t.*, s.speaker, role = speaker AS own,
    CASE WHEN role = speaker THEN '<|im_start|>assistant' || chr(10)
         WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
         ELSE '<|im_start|>user name=' || {_escaped("replace(role, chr(10), ' ')")} || chr(10) END AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, speaker
    ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM j
)
SELECT conv_id, speaker, CAST(position // 64 AS BIGINT) AS part, min(begun) AS start, count(*) AS n_turns,
  string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY position) AS rendered,
  coalesce(string_agg((begun + length(head)) || ':' || (begun + length(head) + length(text)), ',' ORDER BY position) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""

def _whole_vectors(scale: int, more: str = "", where: str = "true") -> str:
    """CTE body: the rows that take part, with whole components ``e`` and a row number ``n``."""
    return f"""SELECT vec_id, row_number() OVER () AS n{more},
    list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND {where}"""


_SCORE = "CAST(list_inner_product(q.e, c.e) AS BIGINT)"

TOP_K_SQL = f"""
WITH v AS ({_whole_vectors(1024)}),
s AS (SELECT q.vec_id AS query_id, q.n, c.vec_id, {_SCORE} AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.n <> c.n),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 10
"""

HARD_NEGATIVES_SQL = f"""
WITH v AS ({_whole_vectors(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l", "label IS NOT NULL")}),
s AS (SELECT q.vec_id AS anchor_id, q.n, c.vec_id, q.l = c.l AS same, {_SCORE} AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.n <> c.n),
p AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same),
w AS (SELECT p.anchor_id, p.n, p.place, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.n, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON p.n = s.n AND NOT s.same AND p.place <= 5
    AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5
"""


def _clustering_sql(rounds: int = 3) -> str:
    ctes = [
        f"v AS MATERIALIZED ({_whole_vectors(64, where='len(embedding) = 64')})",
        """c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS INTEGER) AS k, e
  FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT 16))""",
    ]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (SELECT n, any_value(vec_id) AS vec_id, any_value(v.e) AS e, min(struct_pack(d := d, k := k)) AS best
  FROM (SELECT v.n, v.vec_id, v.e, c.k,
      CAST(list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e) AS BIGINT) AS d
    FROM v, c{t} c) v GROUP BY n)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{t} c LEFT JOIN (
    SELECT k, list(mean ORDER BY i) AS e FROM (
      SELECT best.k AS k, i, floor(CAST(sum(CAST(e[i] AS DECIMAL(18,0))) AS DOUBLE) / count(*)) AS mean
      FROM a{t}, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY k) m ON m.k = c.k)""")
    last = f"a{rounds}"
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, best.k AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate(list_transform(c.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} c ON c.k = best.k"""


CLUSTERING_SQL = _clustering_sql()

#: contract columns that SQL expresses; the other queries are tested against brute force
ORACLES: dict[str, str] = {
    "op8_url_filter": URL_FILTER_SQL,
    "op9_chat_format": CHAT_FORMAT_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_exact_top_k": TOP_K_SQL,
    "op13_centroid_clustering": CLUSTERING_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
