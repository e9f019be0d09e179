import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import intervals

KEYS = ["k"]


def _df(spark, sets):
    rows = [(k, lo, hi) for k, some in sets.items() for lo, hi in some]
    return spark.createDataFrame(rows, "k string, lo long, hi long")


def _runs(numbers):
    out = []
    for n in sorted(numbers):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def _got(df):
    out = {}
    for r in df.orderBy("lo").collect():
        out.setdefault(r.k, []).append((r.lo, r.hi))
    return out


def _sets(seed, n=60):
    rng = random.Random(seed)
    return {k: {x for x in range(n) if rng.random() < 0.6} for k in ("a", "b", None)}


@pytest.mark.parametrize("width", [1 << 20, 7])
def test_of_positions(spark, width):
    sets = _sets(1)
    rows = [(k, x) for k, some in sets.items() for x in some for _ in range(1 + x % 2)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, pos long").repartition(4)
    assert _got(intervals.of_positions(df, KEYS, width=width)) == {k: _runs(v) for k, v in sets.items()}


def test_union_and_difference(spark):
    a, b = _sets(2), _sets(3)
    del b["b"]
    left, right = (_df(spark, {k: _runs(v) for k, v in s.items()}) for s in (a, b))
    assert _got(intervals.merged(left.unionByName(right), KEYS)) == {k: _runs(a[k] | b.get(k, set())) for k in a}
    assert _got(intervals.minus(left, right, KEYS)) == {k: _runs(a[k] - b.get(k, set())) for k in a}
    assert intervals.minus(left, left, KEYS).count() == 0
    sizes = {r.k: r.n for r in intervals.sizes(left, KEYS).collect()}
    assert sizes == {k: len(v) for k, v in a.items()}


def test_first_and_spread(spark, monkeypatch):
    monkeypatch.setattr(intervals, "SPREAD", 4)
    sets = _sets(4)
    df = _df(spark, {k: _runs(v) for k, v in sets.items()})
    for n in (1, 10, 1000):
        got = {}
        for r in intervals.spread(intervals.first_of(df, KEYS, n), KEYS).collect():
            got.setdefault(r.k, []).append(r.pos)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:n] for k, v in sets.items()}


def test_group_read_follows_the_history(spark):
    """Reading again and again gives every entry once, also those that come later."""
    rows = [("s", ms, seq, f"{ms}-{seq}") for ms in range(10) for seq in (0, 1)] + [("t", 5, 0, "5-0")]
    log = intervals.numbered(spark.createDataFrame(rows, "stream_key string, id_ms long, id_seq long, message_id string"), width=8)
    delivered = spark.createDataFrame([], "stream_key string, lo long, hi long")
    seen, lengths = [], log.groupBy("stream_key").agg(F.count("*").alias("length"))
    for _ in range(4):
        batch = intervals.group_read(log, lengths, delivered, 7)
        seen += [(r.stream_key, r.message_id) for r in batch.orderBy("stream_key", "pos").collect()]
        new = intervals.of_positions(batch, ["stream_key"])
        history = [tuple(r) for r in intervals.merged(delivered.unionByName(new), ["stream_key"]).collect()]
        delivered = spark.createDataFrame(history, "stream_key string, lo long, hi long")
    assert sorted(seen) == sorted((r[0], r[3]) for r in rows) and len(seen) == len(rows)
    # a history of any length is a row for each stream
    assert sorted(history) == [("s", 0, 19), ("t", 0, 0)]


def test_empty(spark):
    none = _df(spark, {})
    some = _df(spark, {"a": [(0, 3)]})
    assert intervals.merged(none, KEYS).count() == 0
    assert _got(intervals.minus(some, none, KEYS)) == {"a": [(0, 3)]}
    assert intervals.minus(none, some, KEYS).count() == 0


def test_sweep_is_dealt_by_key(spark):
    """Intervals are a few bytes each; their tasks are not merged into one."""
    ones = spark.range(400).select((F.col("id") % 50).alias("k"), F.col("id").alias("lo"), (F.col("id") + 100).alias("hi"))
    for found in (intervals.minus(ones, ones.where("lo % 3 = 0"), ["k"]), intervals.of_positions(ones.select("k", F.col("lo").alias("pos")), ["k"])):
        tasks = found.select("k", F.spark_partition_id().alias("task")).distinct()
        assert tasks.select("task").distinct().count() > 1
        assert tasks.groupBy("k").count().where("count > 1").count() == 0
