"""The registered queries of this package, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchlake.llm import (
    align, decontaminate, embed_dedup, html_text, lang_id, lm_score, pieces, pii, quality, simhash, suffix_dedup, topk_search, whitening,
)
from pitchlake.llm.common import prepare, remainder, table

MODEL = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    return fn


def _held(n: int, rest: int):
    return F.coalesce(remainder("doc_id", n) == rest, F.lit(False))


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = _held(4, 2)
    out = lang_id.predict(docs, lang_id.train(docs, ~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = _held(3, 1)
    out = quality.score(docs, quality.train(docs, labels, ~held))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def tokenizer(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer())


@query
def op5_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op10_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@query
def op4_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query
def op6_html_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query
def op8_lm_score(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"), _held(5, 1), tokenizer())


@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_token_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"), tokenizer(BYTES), tokenizer())


@query
def op13_topk_search(spark, sf_dir):
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk_search.EVERY == 0)


SQL["op13_topk_search"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x))
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s) WHERE place <= 5"""
