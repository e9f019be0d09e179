"""The registered queries of the corpus operators, over the whole given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from packetloom.llm import (
    bpe, covertree, dedup, lm, mixing, near, prefix_trie, quality_rules, secrets, sharding, subwords, toxicity, voronoi,
)
from packetloom.llm.common import documents, labels


def op1_quality(spark, sf_dir):
    """Every document with the probability that its quality label is 1."""
    docs = documents(spark, sf_dir)
    return subwords.verdicts(subwords.scored(docs, subwords.train(docs, labels(spark, sf_dir))))


def op2_jaccard_join(spark, sf_dir):
    """Every document with its class of near duplicates and its number of links."""
    return near.near_duplicates(documents(spark, sf_dir))


def op3_secret_scan(spark, sf_dir):
    """Every document with the secrets found in it."""
    return secrets.digests(secrets.secret_spans(documents(spark, sf_dir)))


def op4_mixing(spark, sf_dir):
    """Every document with the words the mix takes of it, in training order."""
    plan = mixing.schedule(documents(spark, sf_dir))
    ordered = plan.withColumn("first", F.try_element_at("positions", F.lit(1)))
    first = F.col("first").asc_nulls_last()
    ordered = ordered.repartitionByRange(first, F.col("doc_id")).sortWithinPartitions(first, F.col("doc_id"))
    return ordered.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_exact_dedup(spark, sf_dir):
    """Every document with the id of its kept copy."""
    return dedup.exact_dedup(documents(spark, sf_dir))


def op6_toxicity(spark, sf_dir):
    """Every document with the probability that its toxic label is 1."""
    docs = documents(spark, sf_dir)
    return toxicity.verdicts(toxicity.scored(docs, toxicity.train(docs, labels(spark, sf_dir))))


def op7_sharding(spark, sf_dir):
    """Every document with its shard and slot."""
    return sharding.shard_documents(documents(spark, sf_dir))


def op8_quality_rules(spark, sf_dir):
    """Every document with its counts, distances and verdict."""
    return quality_rules.judged(documents(spark, sf_dir))


def byte_bpe():
    """Rank file content and pre-token pattern of the public vocabulary."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def op9_byte_bpe(spark, sf_dir):
    """Every document encoded and decoded again, as digests."""
    vocabulary = byte_bpe()
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, sf_dir), *vocabulary), *vocabulary))


def op10_lm_score(spark, sf_dir):
    """Every document with its log probabilities under token counts and under the model."""
    return lm.scored(documents(spark, sf_dir))


def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_hard_negatives(spark, sf_dir):
    """Every anchor's positives, each with its hard negatives."""
    return covertree.hard_negatives(covertree.shifted_labels(embeddings(spark, sf_dir)))


def op12_prefix_trie(spark, sf_dir):
    """Every node of the trie of all conversations."""
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_top_k(spark, sf_dir):
    """Every query's nearest vectors by inner product."""
    return voronoi.top_k(embeddings(spark, sf_dir))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing": op4_mixing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lm_score": op10_lm_score,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_top_k": op13_top_k,
}
ORACLES = {
    "op4_mixing": mixing.ORACLE,
    "op5_exact_dedup": dedup.ORACLE,
    "op11_hard_negatives": covertree.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_top_k": voronoi.ORACLE,
}
