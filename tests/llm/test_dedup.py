"""Content-sort dedup against SQL and a plain grouping, over ranges and batches."""

import hashlib
import re

import duckdb
import pytest

from packetloom.llm import dedup, queries


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = sorted(ids, key=lambda i: (i is None, i or 0))
        out += [(str(i), str(least), len(ids), k == 0, digest) for k, i in enumerate(first)]
    return sorted(out)


ROWS = [(i, f"copy   of\n{i % 3}") for i in range(400)]
ROWS += [(5, None), (6, ""), (7, " "), (8, "\t\n"), (None, "x"), (None, "x"), (9, "y"), (9, "y"), (None, "y")]
ROWS += [(1000 + k, "long " * 100_000 + str(k % 2)) for k in range(4)] + [(2000, "a b"), (2001, "a b")]


@pytest.mark.parametrize("parts", ["1", "7"])
@pytest.mark.parametrize("batch", ["10000", "3"])
def test_against_a_plain_grouping(spark, parts, batch):
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in ROWS], "doc_id long, text string, digest string, edge double")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, (parts, batch, "false")):
            spark.conf.set(k, v)
        got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in dedup.exact_dedup(docs).collect())
        kept = dedup.distinct_documents(docs)
        assert kept.columns == docs.columns
        ids = sorted(str(r.doc_id) for r in kept.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain(ROWS)
    assert ids == sorted(r[0] for r in plain(ROWS) if r[3])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.exact_dedup(docs).count() == 0 and dedup.distinct_documents(docs).count() == 0


def test_query_against_sql(spark, docs_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{docs_dir}/documents.parquet'")
    df = queries.op5_exact_dedup(spark, docs_dir)
    want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({dedup.ORACLE})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
