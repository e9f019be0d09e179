import random

import pytest

from packetloom.session import shared_folder
from packetloom.sources import folders, kvruns

SCHEMA = "redis_db int, redis_key string, redis_value string, arrival bigint, deleted boolean"


def _changes(batch, seed=0, keys=40, n=30):
    rng = random.Random(f"{seed}/{batch}")
    return [
        (rng.choice([0, 1]), f"k{rng.randrange(keys)}", rng.choice([None, "", f"v{batch}.{i}"]), batch * 100 + i, rng.random() < 0.2)
        for i in range(n)
    ]


def _model(batches):
    held = {}
    for row in sorted((r for b in batches for r in b), key=lambda r: r[3]):
        held[row[:2]] = row
    return {k: (r[2], r[3]) for k, r in held.items() if not r[4]}


def _table(spark, path):
    return {(r.redis_db, r.redis_key): (r.redis_value, r.arrival) for r in kvruns.read(spark, path).collect()}


@pytest.mark.parametrize("merge", [True, False])
def test_many_batches(spark, merge):
    path = shared_folder(spark, "runs")
    batches = [_changes(b) for b in range(9)]
    order = [0, 2, 1, 3, 4, 5, 6, 8, 7]  # changes may come in a later batch than later ones
    for n, b in enumerate(order):
        for _ in range(2 if n == 5 else 1):  # one batch runs twice
            kvruns.write(spark.createDataFrame(batches[b], SCHEMA), path, n, fanout=3, merge=merge)
    assert _table(spark, path) == _model(batches)
    names = [r.name for r in kvruns.live(spark, path)]
    assert names == (["run=0-8-2"] if merge else [f"run={n}-{n}-0" for n in range(9)])
    if merge:
        # a batch that is merged already leaves no second run
        kvruns.write(spark.createDataFrame(batches[0], SCHEMA), path, 4, fanout=3)
        assert [r.name for r in kvruns.live(spark, path)] == names
        assert kvruns.sweep(spark, path) == 12
        assert folders.children(spark, path) == names and _table(spark, path) == _model(batches)


def test_marks_go_when_settled(spark):
    path = shared_folder(spark, "runs")
    rows = [(0, "a", "x", 1, False), (0, "b", "y", 2, False)], [(0, "a", None, 3, True), (0, "c", None, 9, True)]
    for n, part in enumerate(rows):
        kvruns.write(spark.createDataFrame(part, SCHEMA), path, n, fanout=2, settled=5)
    [run] = kvruns.live(spark, path)
    kept = spark.read.parquet(f"{path}/{run.name}").collect()
    assert sorted((r.redis_key, r.deleted) for r in kept) == [("b", False), ("c", True)]
    assert _table(spark, path) == {(0, "b"): ("y", 2)}


def test_written_bytes_follow_the_changes(spark):
    path = shared_folder(spark, "runs")
    rng = random.Random(1)
    many = [(0, f"key-{i}", rng.randbytes(8).hex(), i, False) for i in range(20_000)]
    kvruns.write(spark.createDataFrame(many, SCHEMA), path, 0, merge=False)
    kvruns.write(spark.createDataFrame([(0, f"key-{i * 997}", "new", 30_000 + i, False) for i in range(20)], SCHEMA), path, 1, merge=False)
    sizes = [folders.size(spark, f"{path}/{r.name}") for r in kvruns.live(spark, path)]
    assert sizes[1] < sizes[0] / 20
    assert kvruns.read(spark, path).count() == 20_000
    found = kvruns.lookup(spark, path, "key-997")
    assert [r.redis_value for r in found.collect()] == ["new"]
    assert "EqualTo(redis_key,key-997)" in found._jdf.queryExecution().toString()


def test_failed_write_does_not_count(spark):
    path = shared_folder(spark, "runs")
    assert kvruns.read(spark, path) is None
    kvruns.write(spark.createDataFrame([(0, "a", "x", 1, False)], SCHEMA), path, 0)
    spark.createDataFrame([(0, "a", "broken", 2, False)], SCHEMA).write.parquet(f"{path}/run=1-1-0")
    folders.remove(spark, f"{path}/run=1-1-0/_SUCCESS")
    assert _table(spark, path) == {(0, "a"): ("x", 1)}
    kvruns.write(spark.createDataFrame([(0, "a", None, 3, None)], SCHEMA).drop("deleted"), path, 1)
    assert _table(spark, path) == {(0, "a"): (None, 3)}
