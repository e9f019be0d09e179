"""Differencing against its bounds, and the laws of shards and slots."""

import random
import zlib
from collections import Counter, defaultdict

from packetloom.llm import queries, sharding


def loads(parts, places):
    out = [0] * len(parts[0])
    for part, place in zip(parts, places):
        for load, shard in zip(part, place):
            out[shard] += load
    return out


def test_differencing_balances():
    rnd = random.Random(4)
    sizes = [rnd.randrange(1, 10_000) for _ in range(800)]
    parts = [[s] + [0] * 9 for s in sizes]
    places = sharding.difference(parts)
    assert all(sorted(p) == list(range(10)) for p in places)
    found = loads(parts, places)
    assert sum(found) == sum(sizes) and max(found) - min(found) < 50
    greedy = [0] * 10
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert max(found) - min(found) <= max(greedy) - min(greedy)


def test_two_way_by_hand():
    # 8 7 6 5 4 -> 8-7=1, 6-5=1, 4-1=3, 3-1=2
    parts = [[s, 0] for s in (8, 7, 6, 5, 4)]
    found = loads(parts, sharding.difference(parts))
    assert sorted(found) == [14, 16]


def check_laws(rows, docs):
    assert Counter(str(r.doc_id) for r in rows) == Counter(str(i) for i, _ in docs)
    by_shard, groups = defaultdict(list), defaultdict(set)
    sizes = Counter((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sizes == Counter((str(r.doc_id), r["size"], r.text_crc32) for r in rows)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        groups[r["size"], r.text_crc32].add(r.shard)
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in groups.values())


def test_query(spark, docs_dir):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{docs_dir}/documents.parquet").collect()]
    check_laws(queries.op7_sharding(spark, docs_dir).collect(), docs)


def test_many_cells_stay_even(spark, monkeypatch):
    rnd = random.Random(2)
    docs = [(k, "w" * rnd.randrange(1, 900) + str(k)) for k in range(3000)] + [(k, "same text") for k in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(sharding, "SHARDS", 4)
    rows = sharding.shard_documents(df, shards=4).collect()
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    assert max(loads.values()) - min(loads.values()) <= 0.001 * sum(loads.values())


def test_odd_rows(spark):
    docs = [(None, "a"), (None, "a"), (1, None), (2, ""), (3, "é" * 100_000), (1, "a"), (1, "b")]
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, shard string, size int")
    check_laws(sharding.shard_documents(df).collect(), docs)
    assert sharding.shard_documents(df.limit(0)).count() == 0
