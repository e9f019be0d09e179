"""The subword classifier: held-out accuracy, n-grams against a plain loop, odd rows."""

import numpy as np
import pyarrow as pa

from packetloom.llm import queries, subwords


def test_held_out_accuracy(spark, docs_dir):
    # the smallest table has too few labelled texts of the rarer kind to learn from
    docs_dir = docs_dir.replace("sf0.001", "sf0.01")
    scored = queries.op1_quality(spark, docs_dir)
    rows = scored.join(spark.read.parquet(f"{docs_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(rows) > 10
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_features_against_a_plain_loop():
    texts = ["ab  ab cd", "x", "\n", "na na na é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    lengths = [len(t.encode()) for t in texts]
    starts = np.concatenate([[0], np.cumsum(lengths[:-1])])
    per_text = [0] * len(texts)
    repeats = [0] * len(texts)
    for at, bucket in subwords.features(data, starts):
        owner = np.searchsorted(starts, at, side="right") - 1
        for o, b in zip(owner, bucket):
            per_text[o] += 1
            repeats[o] += b == subwords._REPEAT

    def expected(text):
        n, words = len(text.encode()), text.split()
        return sum(max(0, n - g + 1) for g in subwords.GRAMS) + len(words) + max(0, len(words) - 1)

    assert per_text == [expected(t) for t in texts]
    assert repeats == [1, 0, 0, 2]


def test_score_does_not_depend_on_the_batch():
    long = "word " * 500_000
    for texts in (["a b", "", long, "a b"], ["a b"]):
        column = pa.array(texts)
        seen = [rows.tolist() for _, _, rows in subwords.blocks(column)]
        flat = sorted({r for rows in seen for r in rows})
        assert flat == [k for k, t in enumerate(texts) if t]
        assert sum(len(d) for d, _, _ in subwords.blocks(column)) == sum(len(t) for t in texts)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", 9.0), (1, "good text here", 9.0), (2, None, 9.0), (3, "", 9.0), (None, "$$ $$ $$", 9.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0)], "doc_id long, quality int")
    rows = subwords.verdicts(subwords.scored(docs, subwords.train(docs, labels))).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    empty = subwords.train(docs, none)
    assert {r.score for r in subwords.scored(docs, empty).collect()} == {0.5}
    assert subwords.scored(docs.limit(0), empty).count() == 0
