"""One thin query per operator, over its whole table, with its SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_analytics.llm import chat, divergence, licenses, ranked, sharding
from care_analytics.llm.common import prepare, release, tables, written

SHARD_BYTES = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.token_files import token_files_digest
    return token_files_digest(prepare(spark), tables(spark, sf_dir, "documents"), tokenizer_path())


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.suffix_dedup import remove_repeats
    docs = tables(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeats(docs, 400)
    # the text that is left, too: of the digests n_bytes is the input's length and shows no removal
    out = written(cut.select("doc_id", "removed.n_bytes", "removed.n_removed", "removed.n_spans", "removed.kept_sha256", "text"), "repeats")
    release(cut)
    return out


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.bpe import round_trip
    return round_trip(tables(prepare(spark), sf_dir, "documents"), tokenizer_path())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.quality import quality_scores
    return quality_scores(tables(prepare(spark), sf_dir, "documents"), tables(spark, sf_dir, "labels"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.minhash import near_duplicates
    return near_duplicates(tables(prepare(spark), sf_dir, "documents"), words=2).drop("text_hash")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.topk import top_k
    return top_k(tables(prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.chat import chat_digest
    planted = prepare(spark).sql("""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text
                                    FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    return chat_digest(tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted))


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.lattice import embedding_links
    return embedding_links(tables(prepare(spark), sf_dir, "embeddings"), threshold=0.93)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.packing import pack_digest
    return pack_digest(tables(prepare(spark), sf_dir, "documents"), tokenizer_path())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from care_analytics.llm.sharding import sharded
    return sharded(tables(prepare(spark), sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES).drop("text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(tables(prepare(spark), sf_dir, "documents"), tables(spark, sf_dir, "benchmark"), k=50)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(tables(prepare(spark), sf_dir, "documents"), least_docs=3, top=200)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(tables(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_minhash": op5_minhash,
    "op6_topk": op6_topk,
    "op7_chat": op7_chat,
    "op8_lattice": op8_lattice,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_ranked_search": op11_ranked_search,
    "op12_source_divergence": op12_source_divergence,
    "op13_license_scan": op13_license_scan,
}
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank,
       c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
QUALIFY rank <= 20
"""

LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links,
       coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id) AS component_id,
       coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e
"""

ORACLE_SQL: dict[str, str] = {
    "op6_topk": TOP_SQL,
    "op7_chat": chat.DIGEST_SQL,
    "op8_lattice": LINKS_SQL,
    "op10_sharding": sharding.shard_sql(SHARD_BYTES),
    "op11_ranked_search": ranked.RANKED_SQL,
    "op12_source_divergence": divergence.DIVERGENCE_SQL,
    "op13_license_scan": licenses.license_sql(),
}
