"""The pipeline against the same steps done by brute force, and its stages on odd rows."""

import hashlib
from collections import Counter

import corpus_pipeline as pipeline
from packetloom.llm import bpe, toxicity
from packetloom.llm.queries import byte_bpe

from test_dedup import norm
from test_mixing import shared
from test_near import all_pairs


def mixed(rows):
    """Copies of each row, by walking every source in the order of the ids' MD5."""
    rank = {s: (s is None, s or "") for s in {s for _, _, s in rows}}
    sources = sorted(rank, key=rank.get)
    size = {k: len((t or "").encode().split()) for k, (_, t, _) in enumerate(rows)}
    per_source = {s: [k for k, r in enumerate(rows) if r[2] == s] for s in sources}
    targets = dict(zip(sources, shared([sum(size[k] for k in per_source[s]) for s in sources])))
    out = Counter()
    for s in sources:
        total, at = sum(size[k] for k in per_source[s]), 0
        passes = int(targets[s] // total) if total else 0
        for k in sorted(per_source[s], key=lambda k: hashlib.md5(str(rows[k][0]).encode()).hexdigest()):
            extra = 2 * at + size[k] <= 2 * (targets[s] - passes * total)
            out[rows[k][0]] = min(3, passes + extra)
            at += size[k]
    return +out


def test_against_brute_force(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    rows = [(d.doc_id, d.text, d.source) for d in docs.collect()]
    lexicon, exceptions, a, b = toxicity.train(docs, spark.read.parquet(f"{docs_dir}/labels.parquet"))
    machine = toxicity.automaton(lexicon, exceptions)
    clean = []
    for r in rows:
        x = toxicity.density(*toxicity.matched(machine, r[1] or ""))
        if 1 / (1 + pow(2.718281828459045, -(a + b * float(x)))) < toxicity.FLAG_SCORE:
            clean.append(r)
    assert 0 < len(clean) < len(rows)
    first = {}
    for r in sorted(clean):
        first.setdefault(norm(r[1]), r)
    unique = list(first.values())
    roots, _ = all_pairs([(i, t) for i, t, _ in unique])
    best = {}
    for root, r in zip(roots, unique):
        best[root] = min(best.get(root, r), r)
    left = list(best.values())
    encoding, _ = bpe._codec(*byte_bpe())
    texts, copies, want = {i: t for i, t, _ in left}, mixed(left), Counter()
    for i, n in copies.items():
        ids = encoding.encode_ordinary(texts[i] or "")
        line = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[i, len(ids), line, hashlib.sha256((texts[i] or "").encode()).hexdigest()] += n
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pipeline.run(spark, docs_dir).collect())
    assert got == want


def test_stages_keep_the_columns_and_bear_odd_rows(spark, docs_dir):
    rows = [(1, None, "en", "a", 0, 5), (1, None, "en", "a", 0, 5), (None, "x y z", None, None, None, None), (2, "a b c d e f", "en", "b", 9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long")
    for table in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, table, docs_dir)
            assert out.columns == docs.columns
            assert (out.count() == 0) == (table.count() == 0)
        assert pipeline.STAGES[-1][1](spark, table, docs_dir).count() == table.count()
