"""The registered queries ``opN_<name>``: each applies its operator, with production
parameters, to its whole table and derives the columns of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontaminate, embedding_dedup, langid, ngram_join, packing, prefix_trie, repeats, secret_scan,
               token_counts, toxicity, url_rules, warc)
from .common import staged, table

FOLDS = 5


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "lexed")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, byte_fallback=token_counts.has_byte_pieces(path))


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    profiles = langid.fit_profiles(docs.where(~held))
    return langid.predict_language(docs, profiles).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(prefix_trie.turn_rows(table(spark, sf_dir, "conversations")), spark)
    nodes = prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, url_rules.HOST_RULES, url_rules.PATTERNS))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_warc_archive, op3_token_counts, op4_retrieval_packing, op5_language_id, op6_embedding_near_dedup,
    op7_toxicity, op8_benchmark_decontamination, op9_suffix_dedup, op10_ngram_jaccard_join, op11_tokenizer_alignment,
    op12_conversation_trie, op13_url_filter)}

#: DuckDB SQL where it can express the query
ORACLES = {
    "op2_warc_archive": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS digest FROM p),
w AS (SELECT page_id, n, digest, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM w
""",
    # crc32 bit by bit; a node's subtree is all nodes whose prefix starts with its own
    "op12_conversation_trie": """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
                  {'r': coalesce(role, ''), 'x': coalesce("text", '')} AS turn
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM t),
h AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 6 AS h
      FROM ids),
rebuilt AS (SELECT h.c, 0 AS part, t.pos, t.turn FROM h JOIN t ON t.c = h.c - h.c % 100 AND t.pos <= h.h
            UNION ALL SELECT h.c, 1, t.pos, t.turn FROM h JOIN t ON t.c = h.c AND t.pos > h.h),
seqs AS (SELECT ids.c, coalesce(s, []) AS s FROM ids LEFT JOIN (SELECT c, list(turn ORDER BY part, pos) AS s FROM rebuilt GROUP BY c) USING (c)),
prefixes AS (SELECT c, d, s[1:d] AS p, len(s) AS n FROM seqs, LATERAL (SELECT unnest(range(len(s) + 1)) AS d)),
nodes AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CASE WHEN n = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256,
                 (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(p[d].x) END AS own
          FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.p = nodes.p),
under AS (SELECT s.p, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own) AS saved
          FROM full_nodes b, LATERAL (SELECT unnest(list_transform(range(b.d + 1), lambda k: b.p[1:k])) AS p) s GROUP BY s.p)
SELECT a.conv_id, a.d::BIGINT AS depth, up.conv_id AS parent_conv_id, a.n_convs::BIGINT AS n_convs, a.n_children::BIGINT AS n_children,
       under.n_leaves::BIGINT AS n_leaves, under.saved::BIGINT AS saved_tokens, a.ends_sha256
FROM full_nodes a JOIN under ON under.p = a.p LEFT JOIN nodes up ON a.d > 0 AND up.p = a.p[1:a.d - 1]
""",
    # every rule is tried on every url
    "op13_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
a AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
b AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(raw) + 1) AS tail FROM a),
c AS (SELECT *, regexp_extract(tail, '^[^?#]*') AS path, '//' || host || tail AS whole FROM b)
SELECT page_id, host, path,
       CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN
                 CASE WHEN host = 'www.example.com' OR ends_with(host, '.www.example.com') THEN 'www.example.com/en/' ELSE 'example.com/en/' END
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' END AS "rule",
       CASE WHEN "rule" IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN "rule" IS NOT NULL THEN 'block'
            WHEN contains(whole, '/ads.txt') OR regexp_matches(whole, '^//([^/?#]*\.)?adult-education\.') THEN 'allow'
            WHEN regexp_matches(whole, '(^|[^A-Za-z0-9])(adult|porn|xxx|casino|bets|betting|pills|viagra|spam|phishing|malware|warez|ads|adserver|popup)([^A-Za-z0-9]|$)')
                 OR regexp_matches(whole, '^//([^/?#]*\.)?doubleclick\.net([^A-Za-z0-9]|$)') OR regexp_matches(whole, '^//([^/?#]*\.)?track\..*/pixel', 's')
                 OR regexp_matches(whole, '(^|[^A-Za-z0-9])affid=.*&', 's') OR ends_with(whole, '/wp-login.php') THEN 'block' ELSE 'allow' END AS verdict
FROM c
""",
}
