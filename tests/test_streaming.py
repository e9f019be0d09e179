import threading
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
from model import Assembler
from pyspark.sql import functions as F
from test_packets import SCHEMA, random_sessions, samples

from packetloom.operators import streamlog
from packetloom.operators.packets import TRIGGER_ORDER
from packetloom.session import ROCKSDB, keyed_state, shared_folder
from packetloom.streaming import runs, sinks, stateful

KEYS = ["device", "session"]


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(path)


def drain(stream, fn, checkpoint):
    runs.start(stream, fn, checkpoint).awaitTermination()


def in_parts(spark, parts, schema, over, checkpoint=None, limit=None):
    """Streams the parts one after the other, a restart between them, and gives the rows."""
    src, out, checkpoint = shared_folder(spark, "src"), shared_folder(spark, "out"), checkpoint or shared_folder(spark, "cp")
    queries = []
    for part in parts:
        put(spark, part, schema, src)
        query = runs.start(over(runs.read_stream(spark, src, spark.createDataFrame([], schema).schema, limit)), stateful.to_folder(out), checkpoint)
        query.awaitTermination()
        queries.append(query)
    return spark.read.parquet(out), queries


@pytest.mark.parametrize("mode", ["reference", "modular"])
def test_frames_over_batches(spark, mode):
    """Three batches with restarts give the frames of the procedure."""
    rows = random_sessions(21, hot=True)
    parts = [[(d, s, q, 0, t, samples(q)) for d, s, q, t in rows if low < q <= high] for low, high in [(-1, 30), (30, 60), (60, 10_000)]]
    out, _ = in_parts(spark, parts, SCHEMA, lambda stream: stateful.session_frames(stream, KEYS, "seq", mode=mode))
    machines = {}
    for d, s, q, t in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        machines.setdefault((d, s), Assembler(mode)).feed(q, t, samples(q))
    got = {}
    for r in out.orderBy("frame_id").collect():
        got.setdefault((r.device, r.session), []).append([list(x) for x in r.frame])
    assert got == {k: m.frames for k, m in machines.items() if m.frames}


def test_new_session_starts_fresh(spark):
    first = [("d", "s1", i, 0, t, samples(i)) for i, t in enumerate([0, 4, 8])]
    second = [("d", "s2", i, 0, t, samples(i)) for i, t in enumerate([12, 0, 4, 8, 12], 10)]
    out, _ = in_parts(spark, [first, second], SCHEMA, lambda stream: stateful.session_frames(stream, KEYS))
    # 12 rows of s1 release nothing; s2 drops its first packet and releases one frame of 16 rows
    assert [(r.session, r.frame_id) for r in out.collect()] == [("s2", 0)]


TIMED = "device string, session string, seq bigint, trig int, pressure array<int>, ts timestamp, event string"


def _timed(device, seq, trig, second, event=None, pressure=None):
    return (device, "s", seq, trig, pressure or samples(seq), datetime.fromtimestamp(1_700_000_000 + second, timezone.utc), event)


def _turn(k):
    return TRIGGER_ORDER[k % 15]


def test_control_rows_and_pauses(spark):
    """A stop drops waiting rows, a reset shuts the gate, a start forgets losses, a pause ends the session."""
    rows = [_timed("d", k, _turn(k), k) for k in range(6)] + [_timed("d", 6, None, 6, "stop")]
    rows += [_timed("d", 7, _turn(8), 7), _timed("d", 8, None, 8, "reset"), _timed("d", 9, _turn(3), 9)]
    rows += [_timed("d", 10, 0, 10), _timed("d", 11, None, 11, "start"), _timed("d", 12, _turn(5), 12)]
    rows += [_timed("d", 13, 0, 500), _timed("d", 14, _turn(1), 501, pressure=[1, None, 3]), _timed(None, 15, 0, 502)]

    def over(stream):
        return stateful.session_frames(stream, KEYS, "seq", ts="ts", event="event", idle_s=60)

    later = [_timed("later", 99, 0, 2000)]
    _, alone = in_parts(spark, [later], TIMED, over)
    for parts in ([rows], [rows[:3], rows[3:7], rows[7:14], rows[14:]]):
        parts = [*parts, later]
        out, queries = in_parts(spark, parts, TIMED, over)
        ends = [tuple(r) for r in out.where("kind = 'end'").orderBy("begun", "segment").select(
            "begun", "segment", "reason", "packets", "lost", "frames", "rows_left").collect()]
        assert ends == [
            (0, 0, "stop", 6, 0, 1, 9), (0, 1, "reset", 1, 2, 0, 12), (0, 2, "idle", 2, 0, 2, 6), (13, 0, "idle", 2, 0, 0, 8)
        ]
        assert out.where("kind = 'frame'").count() == 3
        # only the session that has not paused yet is kept
        left = [q.lastProgress["stateOperators"][0]["numRowsTotal"] for q in (queries[-1], alone[0])]
        assert left[0] == left[1]


def test_state_stays_flat(spark):
    """Sessions that end leave the state, over many micro-batches."""
    src, out = shared_folder(spark, "src"), shared_folder(spark, "out")
    for n in range(24):
        put(spark, [_timed(f"d{n}", k, _turn(k), n * 100 + k) for k in range(5)], TIMED, src)
    stream = runs.read_stream(spark, src, spark.read.parquet(src).schema, max_files=2)
    # files may come in any order of their times
    query = runs.start(
        stateful.session_frames(stream, KEYS, "seq", ts="ts", idle_s=20, delay="1 day"), stateful.to_folder(out), shared_folder(spark, "cp")
    )
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(kept) >= 24 and spark.read.parquet(out).where("kind = 'frame'").count() == 24
    again = runs.start(
        stateful.session_frames(stream, KEYS, "seq", ts="ts", idle_s=20), stateful.to_folder(shared_folder(spark, "out")), shared_folder(spark, "cp")
    )
    again.awaitTermination()
    flat = [p["stateOperators"][0]["numRowsTotal"] for p in again.recentProgress if p["stateOperators"]]
    assert max(flat) < max(kept) / 3


def test_count_batches_over_batches(spark):
    schema = "k string, n bigint, _more string, ts timestamp"
    parts = [[("a", i) for i in range(6)] + [("b", 0)], [("c", 1)], [("a", i) for i in range(6, 13)] + [("b", 2)]]
    parts = [[(*r, None, datetime.fromtimestamp(1_700_000_000 + n, timezone.utc)) for r in part] for n, part in enumerate(parts)]
    out, _ = in_parts(spark, parts, schema, lambda stream: stateful.batches(stream, ["k"], "n", size=4))
    got = {}
    for r in out.orderBy("n").collect():
        got.setdefault((r.k, r.batch_no), []).append(r.n)
        assert r.batch_pos == r.n % 4
    assert got == {("a", 0): [0, 1, 2, 3], ("a", 1): [4, 5, 6, 7], ("a", 2): [8, 9, 10, 11]}
    # what waits is released once the watermark has passed it
    parts.append([("z", 1, None, datetime.fromtimestamp(1_700_009_000, timezone.utc))])
    out, _ = in_parts(spark, parts, schema, lambda stream: stateful.batches(stream, ["k"], "n", size=4, ts="ts", idle_s=5))
    rest = {(r.k, r.n) for r in out.collect()}
    assert {("a", 12), ("b", 0), ("b", 2), ("c", 1)} <= rest and ("z", 1) not in rest


LOG = "stream_key string, message_id string, id_ms bigint, id_seq bigint, value string"


def test_replica_twice_and_restart(spark):
    src, target, checkpoint = (shared_folder(spark, n) for n in ("src", "target", "cp"))
    put(spark, [("s", "1-0", 1, 0, "a"), ("s", "2-0", 2, 0, "b")], LOG, src)
    sink = sinks.replica_sink(target, "copy:", arrival="id_seq")
    drain(runs.read_stream(spark, src, LOG), sink, checkpoint)
    put(spark, [("s", "2-0", 2, 0, "b"), ("s", "3-0", 3, 0, "c"), ("s", "3-0", 3, 0, "c")], LOG, src)
    drain(runs.read_stream(spark, src, LOG), sink, checkpoint)
    # a new checkpoint reads everything again and adds nothing
    drain(runs.read_stream(spark, src, LOG), sink, shared_folder(spark, "cp"))
    got = sorted((r.stream_key, r.message_id) for r in spark.read.parquet(target).collect())
    assert got == [("copy:s", "1-0"), ("copy:s", "2-0"), ("copy:s", "3-0")]


def test_tail_from_now(spark):
    src, out = shared_folder(spark, "src"), shared_folder(spark, "out")
    put(spark, [("s", "1-0", 1, 0, "old")], LOG, src)
    folder, checkpoint = shared_folder(spark, "at"), shared_folder(spark, "cp")
    for part in ([("s", "1-1", 1, 1, "new")], [("t", "1-0", 1, 0, "other")]):
        at = runs.start_positions(spark.read.schema(LOG).parquet(src), folder)
        put(spark, part, LOG, src)
        tail = streamlog.tail_from(runs.read_stream(spark, src, LOG), at)
        drain(tail, lambda df, i: df.write.mode("append").parquet(out), checkpoint)
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["new", "other"]


def test_failed_batch_is_not_acknowledged(spark):
    src, target, checkpoint = (shared_folder(spark, n) for n in ("src", "target", "cp"))
    put(spark, [("s", "1-0", 1, 0, "a")], LOG, src)

    def broken(batch, batch_id):
        raise OSError("sink away")

    query = runs.start(runs.read_stream(spark, src, LOG), broken, checkpoint)
    with pytest.raises(Exception, match="sink away"):
        query.awaitTermination()
    drain(runs.read_stream(spark, src, LOG), sinks.replica_sink(target, arrival="id_seq"), checkpoint)
    assert spark.read.parquet(target).count() == 1


def test_outbox_recovers_what_failed(spark):
    folder = shared_folder(spark, "outbox")
    df = spark.createDataFrame([("t", f"k{i}", bytearray(b"v"), 1000) for i in range(10)], "topic string, key string, value binary, stamp_s bigint")

    def flaky():
        return lambda row: row["key"] not in ("k3", "k4")

    sink = sinks.outbox_sink(folder, flaky)
    for _ in range(2):
        sink(df, 0)
    markers = spark.read.parquet(f"{folder}/markers")
    assert markers.count() == 8
    counts = sinks.resync(spark, folder, "one", lambda: (lambda row: True), as_of=1100).first()
    assert (counts.attempted, counts.synced) == (2, 2)
    left = sinks.resync(spark, folder, "two", lambda: (lambda row: True), as_of=1100).first()
    assert left.attempted == 0


def test_resync_sees_content_and_markers_that_live_longer_than_its_default(spark):
    folder = shared_folder(spark, "outbox")
    df = spark.createDataFrame([("t", f"k{i}", bytearray(b"v"), 1000) for i in range(10)], "topic string, key string, value binary, stamp_s bigint")
    sinks.outbox_sink(folder, lambda: (lambda row: row["key"] not in ("k3", "k4")), ttl_s=86_400)(df, 0)
    sinks.outbox_sink(folder, lambda: (lambda row: False), ttl_s=None)(df.limit(1).withColumn("key", F.lit("ever")), 1)
    as_of = 1000 + 20 * 3600
    counts = sinks.resync(spark, folder, "one", lambda: (lambda row: True), as_of=as_of, ttl_s=86_400).first()
    assert (counts.attempted, counts.synced) == (3, 3)
    assert sinks.resync(spark, folder, "two", lambda: (lambda row: True), as_of=as_of).first().attempted == 0
    late = sinks.resync(spark, folder, "three", lambda: (lambda row: True), as_of=1000 + 86_400).first()
    assert late.attempted == 1  # content that never ends, whose marker did


def test_resync_default_sends_long_lived_content(spark):
    folder = shared_folder(spark, "outbox")
    df = spark.createDataFrame([("t", k, bytearray(b"v"), 1000) for k in "kl"], "topic string, key string, value binary, stamp_s bigint")
    sinks.outbox_sink(folder, lambda: (lambda row: row["key"] == "l"), ttl_s=86_400)(df, 0)
    counts = sinks.resync(spark, folder, "one", lambda: (lambda row: True), as_of=1000 + 20 * 3600).first()
    assert (counts.attempted, counts.synced) == (1, 1)


def test_publish_sink(spark):
    folder = shared_folder(spark, "publish")
    raw = ['{"type": "alert"}', '{"type": "info"}', "no", '{"type": "alert", "x": 1}']
    df = spark.createDataFrame([("s", f"{i}-0", r, "t") for i, r in enumerate(raw)], "stream_key string, message_id string, raw string, stamp string")

    def writer():
        return lambda row: row["topic"] == "base/s" and '"x"' not in row["payload"]

    sinks.publish_sink(folder, writer, "base", "type", ["alert"])(df, 0)
    got = {r.message_id: r.outcome for r in spark.read.parquet(f"{folder}/outcomes").collect()}
    assert got == {"0-0": "published", "1-0": "filtered", "2-0": "invalid", "3-0": "failed"}


def test_fan_out_discovery_and_limits(spark):
    src, base = shared_folder(spark, "src"), shared_folder(spark, "fan")
    for key in ("s", "t"):
        put(spark, [(key, "1-0", 1, 0, "a")], LOG, f"{src}/part={key}")
    stream = runs.read_stream(spark, f"{src}/*", LOG, max_files=1)
    queries = runs.fan_out(
        stream,
        {"replica": sinks.replica_sink(f"{base}/replica", arrival="id_seq"), "discovery": sinks.discovery_sink(f"{base}/streams")},
        f"{base}/checkpoints",
    )
    for q in queries.values():
        q.awaitTermination()
    assert spark.read.parquet(f"{base}/replica").count() == 2
    seen = spark.read.parquet(f"{base}/streams")
    assert sorted(r.stream_key for r in seen.collect()) == ["s", "t"]
    assert len({r.batch_id for r in seen.collect()}) == 2  # one file per micro-batch


def test_dedupe_stream(spark):
    src, out = shared_folder(spark, "src"), shared_folder(spark, "out")
    rows = spark.sql(
        "SELECT * FROM VALUES ('s','1-0',TIMESTAMP'2024-01-01 00:00:00'), ('s','1-0',TIMESTAMP'2024-01-01 00:01:00'),"
        " ('s','2-0',TIMESTAMP'2024-01-01 00:00:30') AS t(stream_key, message_id, ts)"
    )
    rows.write.parquet(src)
    stream = runs.dedupe_stream(runs.read_stream(spark, src, rows.schema), "ts", "10 minutes")
    drain(stream, lambda df, i: df.write.mode("append").parquet(out), shared_folder(spark, "cp"))
    assert sorted(r.message_id for r in spark.read.parquet(out).collect()) == ["1-0", "2-0"]


def test_observed_counts(spark):
    from pyspark.sql import Observation

    from packetloom.operators.health import observed

    seen = Observation("sync")
    df = spark.range(10).select((F.col("id") > 2).alias("ok"))
    observed(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "errors": 3}


def test_keyed_streams_under_the_default_state_store(spark):
    """A session that sets no state store runs them, and keeps its own setting."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    src, checkpoint = shared_folder(spark, "src"), shared_folder(spark, "cp")
    frames_out, batches_out = shared_folder(spark, "out"), shared_folder(spark, "out")
    put(spark, [("d", "s", i, 0, t, samples(i)) for i, t in enumerate([0, 4, 8, 12])], SCHEMA, src)
    spark.conf.set(name, plain)
    try:
        stream = runs.read_stream(spark, src, spark.read.parquet(src).schema)
        runs.start(stateful.session_frames(stream, KEYS), stateful.to_folder(frames_out), f"{checkpoint}/f", keyed=True).awaitTermination()
        found = stateful.batches(stream.select("device", "seq"), ["device"], size=2)
        runs.start(found, stateful.to_folder(batches_out), f"{checkpoint}/b", keyed=True).awaitTermination()
        assert spark.conf.get(name) == plain
    finally:
        spark.conf.set(name, before)
    assert [r.frame_id for r in spark.read.parquet(frames_out).collect()] == [0]
    assert sorted((r.batch_no, r.seq) for r in spark.read.parquet(batches_out).collect()) == [(0, 0), (0, 1), (1, 2), (1, 3)]


def test_threads_that_start_keyed_streams_keep_their_store(spark):
    """A thread that is done does not take the store from another, nor leaves it behind."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    left, seen = threading.Event(), []

    def other():
        with keyed_state(spark):
            left.wait(20)
            seen.append(spark.conf.get(name))

    spark.conf.set(name, plain)
    try:
        with keyed_state(spark):
            thread = threading.Thread(target=other)
            thread.start()
            thread.join(1)
        left.set()
        thread.join()
        assert seen == [ROCKSDB] and spark.conf.get(name) == plain
    finally:
        spark.conf.set(name, before)


def _chunks(rows):
    """Chunk rows as a handler gets them: one table for each list of packets (at, trig, samples)."""
    for part in rows:
        at, trig, packets = zip(*part)
        columns = {
            "at": np.array(at, np.int64), "ms": np.zeros(len(at), np.int64), "trig": np.array(trig, np.int32),
            "event": np.full(len(at), -1, np.int8), "samples": np.array(packets, np.int32),
        }
        yield pd.DataFrame({name: [x.tobytes()] for name, x in columns.items()})


def test_a_long_session_comes_out_in_parts(monkeypatch):
    """A handler gives frames a few at a time, and its samples wait in a file; frames are the same."""
    class State:
        def __init__(self):
            self.value = None

        def get(self):
            return self.value or []

        def update(self, value):
            self.value = value

        put = update

        def clear(self):
            self.value = None

    monkeypatch.setattr(stateful, "TOGETHER", 16)
    monkeypatch.setattr(stateful, "SAMPLE_BYTES", 4096)
    turns = [(k, _turn(k), samples(k)) for k in range(300) if k % 7 != 3]
    parts = [turns[a::5] for a in range(5)]
    names = [f.split(" ")[0] for f in stateful._OUTPUT.split(", ")]
    handler = stateful.SessionFrames(["device"], "reference", None, names)
    handler.session, handler.waiting = State(), State()
    handler._load = lambda: (None, np.zeros((0, stateful.ROW_WIDTH), np.int32))
    tables = list(handler.handleInputRows(("d",), _chunks(parts), None))
    machine = Assembler("reference")
    for k, t, s in turns:
        machine.feed(k, t, s)
    got = [r for table in tables for r in table[table["kind"] == "frame"].itertuples()]
    assert [r.frame for r in got] == machine.frames and [r.frame_id for r in got] == list(range(len(got)))
    assert len(tables) > 5 and max(map(len, tables)) < 30


def test_keyed_queries_limit_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with keyed_state(spark):
        assert int(spark.conf.get(name).removesuffix("b")) <= 8 << 20
    assert spark.conf.get(name) == before
