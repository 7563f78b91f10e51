"""Registered queries of the operators, next to their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark.llm import centroids, chat_format, license_scan, mixing, near_dedup, packing, pii, prefix_trie, pu_quality, quality_llr, repeats, token_windows, topk_search
from candlespark.llm.common import table
from candlespark.session import configure

QUERIES = {}
SQL: dict[str, str] = {}


def query(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    QUERIES[build.__name__] = run
    return build


@query
def op10_llr_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality_llr.fit_weights(docs, table(spark, folder, "labels"))
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept score".split()
    return quality_llr.judge(docs, weights).select(*columns)


@query
def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_figures(table(spark, folder, "documents"))


@query
def op3_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.protect(table(spark, folder, "documents"), key="corpus").select("doc_id", "text", "n_entities")


@query
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT bigint(-7) conv_id, bigint(turn) turn, role, '</s>[INST] ok [/INST]' text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    return chat_format.digests(chat_format.format_chats(chat_format.text_parts(rows.unionByName(extra))))


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).select("doc_id", "canonical_sha256", "license_id", "notices")


def byte_bpe() -> tuple[str, str]:
    """The tokenizer's file and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), *byte_bpe())


@query
def op9_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


@query
def op7_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    return pu_quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_norm_bucket_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op2_norm_bucket_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query
def op1_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"), 400)


@query
def op11_integer_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


def _kmeans_sql(rounds: int) -> str:
    """The rounds written out one after the other."""
    steps = ["""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v QUALIFY c < 16)"""]  # fmt: skip
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS MATERIALIZED (
  SELECT vec_id, v.q, c, list_sum(list_transform(list_zip(v.q, c{i}.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM v, c{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.q, c{i}.q) AS q FROM c{i} LEFT JOIN (
    SELECT c, list(s ORDER BY i) AS q FROM (
      SELECT c, i, (sum(x) - (sum(x) % count(*) + count(*)) % count(*))::BIGINT // count(*) AS s
      FROM (SELECT c, unnest(q) AS x, unnest(range(64)) AS i FROM d{i}) GROUP BY c, i) GROUP BY c) m ON m.c = c{i}.c)""")
    return "WITH " + ",\n".join(steps[:-1]) + f"""
SELECT vec_id, d.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY d.c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM d{rounds} d JOIN c{rounds} ON d.c = c{rounds}.c"""


SQL["op11_integer_kmeans"] = _kmeans_sql(3)


@query
def op13_rabin_karp_windows(spark: SparkSession, folder: str) -> DataFrame:
    return token_windows.remove_repeats(table(spark, folder, "documents")).drop("spans")


_AHEAD = ", ".join(f"lead(w, {k}) OVER o" for k in range(20))

SQL["op13_rabin_karp_windows"] = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i, len(w) AS n FROM d),
k AS (
  SELECT doc_id, i, w, CASE WHEN i + 20 <= n THEN md5(concat_ws(' ', {_AHEAD})) END AS k FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT k, min((doc_id, i)) AS f FROM k WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
h AS (SELECT doc_id, i, w, coalesce((doc_id, i) > f, false) AS h FROM k LEFT JOIN f USING (k)),
g AS (SELECT doc_id, i, w, max(h) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM h),
r AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept, count(*) FILTER (gone) AS n_removed FROM g GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)"""


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


SQL["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS head
  FROM n),
r AS (
  SELECT h.conv_id, pos, role, text FROM h JOIN t ON t.conv_id = base AND pos < head
  UNION ALL
  SELECT h.conv_id, least(head, coalesce(n.own, 0)) + pos - head, role, text
  FROM h JOIN t USING (conv_id) LEFT JOIN n ON n.conv_id = base WHERE pos >= head),
p AS (
  SELECT conv_id, pos + 1 AS depth, length(text) AS len,
    string_agg(md5(length(role) || ':' || role || text), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS k
  FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM n),
m AS (SELECT *, lead(k) OVER w IS NULL AS last, lag(k) OVER w AS parent FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
v AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(len) AS len, max(parent) AS parent,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM m GROUP BY k, depth),
c AS (SELECT parent AS k, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY parent),
u AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN c USING (k)),
s AS (
  SELECT x.a AS k, sum((n_convs - 1) * len) AS saved, sum((n_children = 0)::INT) AS leaves
  FROM (SELECT DISTINCT a.k AS a, b.k AS b FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth) x JOIN u ON u.k = x.b GROUP BY x.a)
SELECT u.conv_id, u.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, u.n_convs, u.n_children::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, u.ends_sha256
FROM u JOIN s USING (k) LEFT JOIN v o ON o.k = u.parent AND o.depth = u.depth - 1"""
