"""The Jaccard join against all pairs on small tables, its pruning, and odd rows."""

import random

import numpy as np
import pytest

from packetloom.llm import near, queries
from packetloom.llm.components import components


def shingle_set(text):
    words = (text or "").encode().split()
    if not words:
        return None
    size = min(5, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def all_pairs(rows, similar=0.8):
    """(class members, links) of every row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(rows))], links


def family(rnd, n, size):
    """Texts around one, some words of each changed."""
    words = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        mine = list(words)
        for _ in range(rnd.randrange(5)):
            mine[rnd.randrange(size)] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(mine))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_links int")
    got = sorted((str(r.doc_id), r.n_links, str(r.class_id)) for r in near.near_duplicates(docs).collect())
    roots, links = all_pairs(rows)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(roots[k], []).append(i)
    least = {g: min((i for i in m if i is not None), default=None) for g, m in ids.items()}
    assert got == sorted((str(i), links[k], str(least[roots[k]])) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [256, 7])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rnd = random.Random(3)
    texts = family(rnd, 60, 120) + family(rnd, 5, 300) + family(rnd, 8, 30)
    texts += [f"only {k} words here" for k in range(4)] + ["a b", "a b", "a  b"]
    texts += texts[:10]
    check(spark, [(k * 7 % 1009, t) for k, t in enumerate(texts)])


def test_odd_rows(spark):
    long = " ".join(f"v{k}" for k in range(40_000))
    check(spark, [(1, None), (2, ""), (3, " \n"), (None, "one two"), (None, "one two"), (4, "one two"), (5, long), (5, long), (6, long + " end"), (7, "z" * 3_000_000)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(empty).count() == 0 and near.one_of_each(empty).count() == 0


def test_one_of_each(spark):
    long = " ".join(f"v{k}" for k in range(100))
    rows = [(3, long, 1), (2, long + " end", 2), (2, long + " end", 3), (9, "", 4), (9, "", 5), (None, long, 6), (8, "else", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "8", "9", "9"]


def test_pruning_keeps_what_may_reach_the_threshold():
    least = near.least_matches()
    assert least[16] < 8 and 60 < least[128] < 85
    rng = np.random.default_rng(1)
    draws = rng.random((20_000, near.HASHES)) < near.SIMILAR
    for k in range(near.STEP, near.HASHES + 1, near.STEP):
        assert (draws[:, :k].sum(axis=1) >= least[k]).all()


def test_words_do_not_depend_on_parts(monkeypatch):
    data = np.frombuffer(("ab  cd\n" * 50 + "é" * 90 + " x").encode(), np.uint8)
    whole = near.word_hashes(data)
    assert len(whole) == 102 and len(set(whole.tolist())) == 4
    monkeypatch.setattr(near, "_PART", 64)
    parts = near.word_hashes(data)
    assert (whole[:100] == parts[:100]).all() and whole[-1] == parts[-1] and len(parts) == 102


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7), (100, 102)] + [(200, 200 + k) for k in range(30)]
    df = spark.createDataFrame(edges, "u long, v long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in (100, 101, 102)} | {200 + k: 200 for k in range(30)}
    assert components(df.limit(0)).count() == 0


def test_query(spark, docs_dir):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{docs_dir}/documents.parquet").collect()]
    roots, links = all_pairs(docs)
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op2_jaccard_join(spark, docs_dir).collect()}
    first = {}
    for k, (i, _) in enumerate(docs):
        first[roots[k]] = min(first.get(roots[k], i), i)
    assert got == {i: (first[roots[k]], links[k]) for k, (i, _) in enumerate(docs)}
