"""The corpus pipeline: documents through five corpus operators, stage by stage."""

from __future__ import annotations

from packetloom.llm import bpe, dedup, mixing, near, toxicity
from packetloom.llm.common import documents, labels, saved
from packetloom.llm.queries import byte_bpe


def not_toxic(spark, docs, sf_dir):
    """The documents that the toxicity lexicon, learned from ``labels``, does not flag.

    The lexicon is learned on the same texts that are judged, except the held-out fold.
    """
    return toxicity.clean(docs, toxicity.train(docs, labels(spark, sf_dir)))


def without_copies(spark, docs, sf_dir):
    """One document of each group of texts equal up to white space: the smallest id."""
    return dedup.distinct_documents(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each class of near duplicates: the smallest id."""
    return near.one_of_each(docs)


def mix(spark, docs, sf_dir):
    """The documents in training order, a row per copy that the mix takes."""
    return mixing.mixed(docs)


def encoded(spark, docs, sf_dir):
    """Token count and digests of every row of the mix."""
    vocabulary = byte_bpe()
    return bpe.digests(bpe.decode(bpe.encode(docs, *vocabulary), *vocabulary))


STAGES = [
    ("toxicity", not_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing", mix),
    ("byte-level BPE", encoded),
]

# A learned lexicon, Jaccard classes and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
