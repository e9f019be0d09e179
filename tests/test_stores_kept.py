"""Kept statistics, session files, fan-out, retention, metrics and payload records."""

import csv
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from packetloom import session
from packetloom.functions import records
from packetloom.operators import streamlog
from packetloom.session import shared_folder
from packetloom.sources import folders, keptstats, sessionfiles, stores
from packetloom.streaming import fanout, sinks

DAY = 86_400_000
LOG = "stream_key string, id_ms long, id_seq long"


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG).withColumn("log_date", stores.log_date())


@pytest.mark.parametrize("fanout_of", [2, 100])
def test_kept_stats_equal_a_recount(spark, fanout_of):
    rng = random.Random(fanout_of)
    store = keptstats.stream_store(spark, shared_folder(spark, "kept"), fanout_of)
    held, ms = [], 0
    for batch in range(7):
        new = []
        for _ in range(12):
            ms += rng.randrange(1, DAY // 10)
            new.append((rng.choice("ab"), ms, rng.randrange(3)))
        held += new
        gone = rng.sample(held, 8) if batch in (2, 3, 5) else []
        if batch == 5:
            gone = held[: len(held) - 3]  # whole dates go
        held = [r for r in held if r not in gone]
        for _ in range(2 if batch == 3 else 1):
            keptstats.add_entries(
                store, batch, _log(spark, new), _log(spark, gone) if gone else None, _log(spark, held) if gone else None
            )
    want = {tuple(r) for r in streamlog.stream_stats(spark.createDataFrame(held, LOG)).collect()}
    assert {tuple(r) for r in keptstats.stream_stats(store).collect()} == want
    assert len(store.live()) == (7 if fanout_of == 100 else 3)


def test_a_batch_reads_and_writes_its_own_dates(spark):
    store = keptstats.stream_store(spark, shared_folder(spark, "kept"))
    keptstats.add_entries(store, 0, _log(spark, [("a", k * DAY, 0) for k in range(50)]))
    keptstats.add_entries(store, 1, _log(spark, [("a", 49 * DAY + 5, 0)]))
    assert [store.rows([r]).count() for r in store.live()] == [50, 1]


def test_session_files(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("s/one.csv", 2, "b, c", None), ("s/one.csv", 1, 'a "q"', "x"), ("s/two.csv", 3, None, "y"), (None, 4, "lost", "z")]
    df = spark.createDataFrame(rows, "session_file string, n int, text string, other string").repartition(3)
    sessionfiles.write_session_files(df, path, ["n", "text", "missing"], "n")
    sessionfiles.write_session_files(df.where("n = 3"), path, ["n", "text", "missing"], "n")
    sessionfiles.write_session_files(df.where("n > 10"), path, ["n", "text", "missing"], "n")
    found = {p.relative_to(path).as_posix(): list(csv.reader(p.open(newline=""))) for p in (tmp_path / "out").rglob("*.csv")}
    head = ["n", "text", "missing"]
    assert found == {"s/one.csv": [head, ["1", 'a "q"', ""], ["2", "b, c", ""]], "s/two.csv": [head, ["3", "", ""], ["3", "", ""]]}
    assert (tmp_path / "out" / "s" / "one.csv").read_bytes().count(b"\r\n") == 3


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).select(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("session_file"), F.col("id").alias("n"))
    sessionfiles.write_session_files(df.where("id < 10"), path, ["n"], "n")
    before = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    broken = df.withColumn("n", F.when(F.col("n") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        sessionfiles.write_session_files(broken, path, ["n"], "n")
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == before


class _Sink:
    def __init__(self, *failing):
        self.failing, self.got, self.calls = set(failing), {}, 0

    def __call__(self, batch, batch_id):
        self.calls += 1
        if self.calls in self.failing:
            raise OSError("away")
        self.got[batch_id] = sorted(r.id for r in batch.collect())


def test_fan_out(spark):
    good, bad = _Sink(), _Sink(1, 2)
    folder = shared_folder(spark, "fan")
    fan = fanout.FanOut({"good": good, "bad": bad}, folder)
    for n in range(3):
        fan(spark.range(n, n + 2), n)
        if n == 0:
            assert fan.behind(spark) == {"good": [], "bad": [0]} and fan.held(spark) == [0]
    assert good.got == bad.got == {n: [n, n + 1] for n in range(3)}
    # a batch that comes again is known; a new process finds the ledger
    again = fanout.FanOut({"good": good, "bad": bad}, folder)
    again(spark.range(2, 4), 2)
    assert good.calls == 3 and again.held(spark) == [2]


def test_a_sink_that_stays_away_stops_the_query_in_the_end(spark):
    fan = fanout.FanOut({"bad": _Sink(*range(1, 20))}, shared_folder(spark, "fan"), most_behind=2)
    fan(spark.range(1), 0)
    fan(spark.range(1), 1)
    with pytest.raises(fanout.FallenBehind, match="bad lacks 3 batches from 0"):
        fan(spark.range(1), 2)


def test_the_outbox_stays_small(spark):
    folder = shared_folder(spark, "outbox")
    sink = sinks.outbox_sink(folder, lambda: (lambda row: row["key"] != "k1"), ttl_s=3600, sweep_every=2)
    counts = []
    for n in range(12):
        df = spark.createDataFrame([("t", f"k{n}", bytearray(b"v"), 100_000 + n * 3600)], "topic string, key string, value binary, stamp_s bigint")
        sink(df, n)
        counts.append(sum(len(folders.children(spark, f"{folder}/{part}")) for part in ("content", "markers", "attempts")))
    assert max(counts[9:]) == max(counts[6:9])
    at = 100_000 + 11 * 3600
    assert sinks.resync(spark, folder, "now", lambda: (lambda row: True), as_of=at).first().attempted == 0
    assert sinks.sweep_outbox(spark, folder, at + 100 * 3600) > 0
    assert sinks.resync(spark, folder, "late", lambda: (lambda row: True), as_of=at + 100 * 3600).first().attempted == 0


def test_a_sweep_spares_what_lives(spark):
    folder = shared_folder(spark, "outbox")
    columns = "topic string, key string, value binary, stamp_s bigint"
    sinks.outbox_sink(folder, lambda: (lambda row: False), ttl_s=None)(spark.createDataFrame([("t", "ever", bytearray(b"v"), 1000)], columns), 0)
    sinks.outbox_sink(folder, lambda: (lambda row: False), ttl_s=7200)(spark.createDataFrame([("t", "long", bytearray(b"v"), 1000)], columns), 1)
    assert sinks.sweep_outbox(spark, folder, 1000 + 7200, grace_s=0) == 0
    sinks.sweep_outbox(spark, folder, 1000 + 7200 + 3600, grace_s=0)
    assert [r.key for r in spark.read.parquet(f"{folder}/content").collect()] == ["ever"]


def test_remove_scratch(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    path = shared_folder(spark, "scratch")
    spark.range(1).write.parquet(path)
    shared_folder(spark, "never written")
    assert session.remove_scratch(spark) == 1
    assert folders.children(spark, path) == [] and session.remove_scratch(spark) == 0


@pytest.mark.parametrize(
    "payload, want",
    [
        (None, []), ("", [{"value": ""}]), ("plain", [{"value": "plain"}]), ("[1, {\"k\": 2}]", [{"value": 1}, {"k": 2}]),
        ('{"k": [1, 2], "s": ["a"]}', [{"k": 1, "s": "a"}, {"k": 2, "s": None}]), ('{"k": 1}', [{"k": 1}]), ("3.5", [{"value": 3.5}]),
        ("[]", []), ("{}", [{}]),
    ],
)
def test_parsed(payload, want):
    assert records.parsed(payload) == want


def test_payload_records(spark):
    records.register(spark)
    rows = [(1, '[{"k": 1, "s": "a"}, {"k": "x", "s": {"deep": [1]}}, {"k": 3000000000}, {"k": 2.0, "b": true}]'), (2, None), (3, "7")]
    spark.createDataFrame(rows, "id int, payload string").createOrReplaceTempView("payloads")
    got = spark.sql("SELECT id, r.* FROM payloads, LATERAL payload_records(payload, 'k INT, s STRING, b BOOLEAN, value DOUBLE') r")
    assert got.columns == ["id", "nth", "k", "s", "b", "value"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == [
        (1, 0, 1, "a", None, None), (1, 1, None, '{"deep": [1]}', None, None), (1, 2, None, None, None, None),
        (1, 3, 2, None, True, None), (3, 0, None, None, None, 7.0),
    ]
    with pytest.raises(Exception, match="constant text"):
        spark.sql("SELECT * FROM payloads, LATERAL payload_records(payload, payload) r").collect()


def test_dates_of_the_log(spark):
    assert _log(spark, [("a", DAY, 0)]).first().log_date == date(1970, 1, 2)


def test_buckets_join_without_a_shuffle(spark):
    rows = spark.range(5000).select((F.col("id") % 4).cast("int").alias("redis_db"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("redis_key"))
    keys = ["redis_db", "redis_key"]
    stores.write_bucketed(rows.withColumn("redis_value", F.col("redis_key")), "held_b", keys, 4, bloom=["redis_key"])
    stores.write_bucketed(rows.where("redis_db = 1").unionByName(rows.limit(1).withColumn("redis_key", F.lit("none"))), "asked_b", keys, 4)
    found = stores.lookup_bucketed(spark.table("asked_b"), "held_b", keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = {r.redis_key: r.redis_value for r in found.collect()}
    assert len(got) == 1251 and got["none"] is None and got["k1"] == "k1"


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select(F.lit(0).alias("redis_db"), F.md5(F.col("id").cast("string")).alias("redis_key"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scanned = {}
        for name, bloom in (("plain", []), ("bloomed", ["redis_key"])):
            # sorted by another column: statistics say nothing about the key
            stores.write_bucketed(rows, f"held_{name}", ["v"], 1, bloom=bloom, row_group_bytes=100_000)
            one = spark.table(f"held_{name}").where(F.col("redis_key") == F.md5(F.lit("77")))
            assert [r.v for r in one.collect()] == [77]
            leaf = one._jdf.queryExecution().executedPlan().collectLeaves().head()
            scanned[name] = leaf.metrics().apply("numOutputRows").value()
        assert scanned["plain"] == 40_000 and scanned["bloomed"] < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
