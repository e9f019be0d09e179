import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import devices, discovery, frames, health, keyvalues, ordered, outbox, routing, streamlog

LOG = "stream_key string, message_id string, arrival bigint, value string"


def log(spark, rows):
    return streamlog.with_id_parts(spark.createDataFrame(rows, LOG))


def values(df, col="value"):
    return sorted(r[col] for r in df.collect())


@pytest.mark.parametrize("width", [1, 3, 100, 1 << 20])
@pytest.mark.parametrize("hot_only", [False, True])
def test_numbering_with_a_hot_key(spark, width, hot_only):
    rng = random.Random(width)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(5)}", n) for n in rng.sample(range(-300, 2000), 500)]
    df = spark.createDataFrame(rows, "k string, n bigint").repartition(5)
    if hot_only:
        df = ordered.with_hot_chunks(df, ["k"], "n", width)
        most = df.groupBy("k").agg(F.countDistinct("chunk").alias("c"))
        cut = {r.k for r in most.where("c > 1").collect()}
        assert cut <= {k for k in {k for k, _ in rows} if sum(k == x for x, _ in rows) > width}
    else:
        df = ordered.with_chunk(df, "n", width)
    got = {(r.k, r.n): (r.i, r.total) for r in ordered.running_number(df, ["k"], "n", "i", "total").collect()}
    for key in {k for k, _ in rows}:
        mine = sorted(n for k, n in rows if k == key)
        assert [got[(key, n)] for n in mine] == [(i, len(mine)) for i in range(len(mine))]
    start = spark.createDataFrame([("hot", 10)], "k string, n bigint")
    later = ordered.running_number(df, ["k"], "n", "i", "total", start=start)
    assert later.where("k = 'hot'").agg(F.min("i")).first()[0] == 10
    assert later.where("k = 'k1'").agg(F.min("i")).first()[0] == 0


@pytest.mark.parametrize("n", [1, 256, 257, 5000])
@pytest.mark.parametrize("newest", [False, True])
def test_first_n_is_one_call_for_any_n(spark, n, newest):
    rows = [(f"k{i % 3}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    got = sorted((r.k, r.n) for r in ordered.first_n(df, ["k"], "n", n, newest, width=40).collect())
    want = []
    for key in ("k0", "k1", "k2"):
        mine = sorted(x for k, x in rows if k == key)
        want += [(key, x) for x in (mine[-n:] if newest else mine[:n])]
    assert got == sorted(want)


@pytest.mark.parametrize("newest", [False, True])
def test_first_n_keeps_null_keys_and_orders(spark, newest):
    rows = [(k, x) for k in ("a", None) for x in (None, 1, 50, 99)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    for n in (1, 2, 4):
        got = {(r.k, r.n) for r in ordered.first_n(df, ["k"], "n", n, newest, width=40).collect()}
        order = [99, 50, 1, None] if newest else [None, 1, 50, 99]
        assert got == {(k, x) for k in ("a", None) for x in order[:n]}


def test_range_scan_bounds(spark):
    df = log(spark, [("s", f"{ms}-{q}", i, f"{ms}-{q}") for i, (ms, q) in enumerate([(99, 0), (100, 0), (200, 7), (201, 0)])])
    assert values(streamlog.range_scan(df, "s", 100, 200)) == ["100-0", "200-7"]
    assert values(streamlog.range_scan(df, "s", end_ms=100)) == ["100-0", "99-0"]
    assert values(streamlog.range_scan(df, "s", start_ms=201)) == ["201-0"]
    assert values(streamlog.range_scan(df, "other", 0, 500)) == []
    late = streamlog.DEFAULT_WINDOW_MS + 100
    assert values(streamlog.range_scan(df, now_ms=late)) == ["100-0", "200-7", "201-0"]


def test_log_records_and_stream_keys(spark):
    df = spark.createDataFrame(
        [("pressure_bed", "001", "sensorX", 1640995200000, "v", None, None), (None, None, None, 1, "w", "u", "n")],
        "device string, device_id string, char string, timestamp_ms bigint, value string, uid string, nn string",
    )
    rows = streamlog.log_records(df).collect()
    assert rows[0].key == "pressure_bed-001-sensorX-1640995200000"
    assert rows[0].stream_key == "stream:pressure_bed:001" and rows[0].uid == "unknown"
    assert rows[1].stream_key == "stream:undefined:0000" and rows[1].characteristic == "unknown"
    pairs = spark.createDataFrame([(["a", "b"], ["1", "2"])], "device array<string>, device_id array<string>")
    assert values(streamlog.stream_keys(pairs), "stream_key") == ["stream:a:1", "stream:b:2"]
    single = spark.createDataFrame([("a", "1")], "device string, device_id string")
    assert values(streamlog.stream_keys(single), "stream_key") == ["stream:a:1"]
    with pytest.raises(ValueError):
        streamlog.stream_keys(single.withColumn("device", F.array("device")))


def test_conflicts(spark):
    df = log(spark, [("s", "1640995200000-0", 1, "v1"), ("s", "1640995200000-0", 2, "v2"), ("s", "x", 3, "v3")])
    rows = streamlog.stream_table_rows(df.withColumn("ingest_second", F.lit(86400).cast("bigint")))
    assert values(streamlog.keep_first(rows)) == ["v1", "v3"]
    assert values(streamlog.keep_last(rows)) == ["v2", "v3"]
    dates = {r.value: str(r.streaming_date) for r in rows.collect()}
    assert dates == {"v1": "2022-01-01", "v2": "2022-01-01", "v3": "1970-01-02"}
    table = rows.where("value = 'v1'")
    assert values(streamlog.keep_first(rows.where("value <> 'v1'"), table=table)) == ["v3"]


def test_latest_id_is_numeric(spark):
    df = log(spark, [("s", "9-0", 1, "a"), ("s", "10-2", 2, "b"), ("s", "10-10", 3, "c")])
    assert streamlog.latest_id(df).first().message_id == "10-10"
    stats = streamlog.stream_stats(df).first()
    assert (stats.length, stats.first_id, stats.last_id) == (3, "9-0", "10-10")


def test_tail_and_group_read(spark):
    df = log(spark, [("s", "1-0", 1, "a"), ("s", "1-1", 2, "b"), ("t", "1-0", 3, "c")])
    at = streamlog.positions(df.where("value = 'a'"))
    assert values(streamlog.tail_from(df, at)) == ["b", "c"]
    seen = df.where("value = 'a'").withColumn("grp", F.lit("g"))
    assert values(streamlog.group_read(df, seen, "g", 1)) == ["b", "c"]
    assert values(streamlog.group_read(df, seen, "other", 1)) == ["a", "c"]


def test_large_batches_go_through_chunks(spark):
    rows = [("s", f"{i * 1_000_000}-{i % 3}", i, str(i)) for i in range(300)]
    df = log(spark, rows + [("t", "5-0", 999, "t")])
    got = {int(r.value) for r in streamlog.trim_newest(df, 290).where("stream_key = 's'").collect()}
    assert got == set(range(10, 300))
    assert streamlog.bounded_batch(df, 290).where("stream_key = 't'").count() == 1


def test_replication(spark):
    df = log(spark, [("s", "1-0", 1, "a"), ("s", "2-0", 2, "b"), ("s", None, 3, "c")])
    target = log(spark, [("p:s", "1-0", 1, "a"), ("p:s", "1-0", 9, "a")])
    assert values(streamlog.replicate(df.where("message_id IS NOT NULL"), target, "p:")) == ["b"]
    counts = streamlog.replication_counts(streamlog.replicate_outcomes(df, target, "p:")).first()
    assert (counts.synced, counts.failed, counts.skipped) == (1, 1, 1)


def test_sequences(spark):
    df = ordered.with_chunk(
        spark.createDataFrame([("device123", 1, 10), ("device123", 2, 10), ("device456", 3, 10)], "d string, n bigint, ms bigint"), "n"
    )
    assert values(streamlog.with_business_key(df, "d", "ms", "n"), "business_key") == [
        "device123:10:0001", "device123:10:0002", "device456:10:0001"
    ]


def kv(spark, rows):
    return spark.createDataFrame(rows, "redis_db int, redis_key string, key_type string, redis_value string, arrival bigint")


def test_key_values(spark):
    df = kv(spark, [(0, "a", "string", "1", 1), (0, "a", "string", None, 2), (1, "a", "string", "z", 1), (0, "h", "hash", "x", 1)])
    latest = {(r.redis_db, r.redis_key): r.redis_value for r in keyvalues.latest_per_key(df).collect()}
    assert latest == {(0, "a"): "", (1, "a"): "z", (0, "h"): "x"}
    assert keyvalues.latest_per_key(df, ("redis_key",)).count() == 2
    once = keyvalues.copy_once(df, df.where("redis_db = 1"))
    assert {(r.redis_db, r.redis_key, r.redis_value) for r in once.collect()} == {(0, "a", "1"), (0, "h", "x")}
    assert keyvalues.scan_keys(df, ["a", "a*"]).count() == 3
    assert keyvalues.point_lookup(df, "nope").count() == 0


def test_discovery_variants(spark):
    keys = spark.createDataFrame(
        [("device:1:stream", 0, "stream"), ("ecg-stream", 2, "stream"), ("ecg-stream", 0, "string")], "key string, db int, key_type string"
    )
    rr = discovery.match_streams(keys, ["device:*", "*-stream", "ecg*"], default_db=0)
    assert values(rr, "display_name") == ["db2:ecg-stream", "device:1:stream"]
    pg = discovery.match_streams(keys, ["*-stream", "ecg*"], per_pattern=True)
    assert values(pg, "display_name") == ["db2:ecg-stream"] * 2
    assert discovery.match_streams(keys, []).count() == 0
    assert discovery.match_streams(keys, None).count() == 2
    a, b = spark.createDataFrame([("x",), ("y",)], "stream_key string"), spark.createDataFrame([("y",), ("z",)], "stream_key string")
    assert {tuple(r) for r in discovery.stream_diff(a, b).collect()} == {("x", "new"), ("y", "kept"), ("z", "stopped")}


def test_outbox(spark):
    keys = ["k1", "k2", "kafka_sync:k1", "__x", "_:y", "stream:y", "unsynced_keys_set"]
    content = spark.createDataFrame([(k, 100, None) for k in keys], "key string, written_at bigint, ttl_s bigint")
    markers = spark.createDataFrame([("k1", 100, 50), ("k1", 100, 50)], "key string, marked_at bigint, ttl_s bigint")
    assert values(outbox.unsynced(content, markers, 120), "key") == ["k2"]
    # once the marker has expired the key counts as unsynced again
    assert values(outbox.unsynced(content, markers, 200), "key") == ["k1", "k2"]
    assert {(r.key, r.is_synced) for r in outbox.synced_flag(content, markers, 120).collect()} == {("k1", True), ("k2", False)}


def test_position_index(spark):
    sent = spark.createDataFrame(
        [("test-topic", 0, 123, "d", "device123:2024-03-22T19:30:00.123Z:0042"), ("test-topic", 0, 124, None, "ignored")],
        "topic string, partition int, offset bigint, device_id string, key string",
    )
    rows = outbox.position_index(sent).orderBy("offset").collect()
    assert rows[0].index_key == "kafka_index:test-topic:0:123" and rows[0].content_key == rows[0].key
    assert rows[1].index_key is None and rows[1].content_key == "test-topic:0:124"


def test_health_cases(spark):
    stats = spark.createDataFrame([(s, 5, "1-0", "2-0") for s in "abcde"] + [("f", 0, None, None)], "stream_key string, length bigint, first_id string, last_id string")
    groups = spark.createDataFrame(
        [("a", 1, 0), ("b", 0, 0), ("c", 1, 101), ("d", 0, 101), ("e", 1, 100)], "stream_key string, consumers bigint, pending bigint"
    ).withColumn("grp", F.lit("g"))
    wanted = spark.createDataFrame([(s,) for s in "abcdefg"], "stream_key string")
    got = {r.stream_key: r.status for r in health.stream_health(wanted, stats, groups).collect()}
    assert got == {"a": "HEALTHY", "b": "WARNING", "c": "DEGRADED", "d": "WARNING", "e": "HEALTHY", "f": "WARNING", "g": "NOT_FOUND"}
    issues = {}
    for r in health.stream_issues(wanted, stats, groups).collect():
        issues.setdefault(r.stream_key, []).append(r.issue)
    assert sorted(issues) == ["b", "c", "d", "f", "g"] and len(issues["d"]) == 2
    valid = {r.stream_key: (r.is_valid, r.reason, r.group_count) for r in health.validate_streams(wanted, stats, groups).collect()}
    assert valid["a"] == (True, "Stream is valid", 1)
    assert valid["f"] == (True, "Stream exists but is empty", None)
    assert valid["g"] == (False, "Stream does not exist", None)


def test_pending_and_acks(spark):
    d = spark.createDataFrame([("s", "g", "1-0"), ("s", "g", "2-0"), ("s", "h", "1-0")], "stream_key string, grp string, message_id string")
    acks = spark.createDataFrame([("s", "g", "1-0"), ("s", "g", "1-0")], "stream_key string, grp string, message_id string")
    assert {(r.grp, r.message_id) for r in health.pending(d, acks).collect()} == {("g", "2-0"), ("h", "1-0")}
    assert [tuple(r) for r in health.ack_counts(d, acks).collect()] == [("s", "g", 1)]


def test_publish_outcomes(spark):
    raw = [("1-0", '{"type": "alert"}'), ("2-0", '{"type": "info"}'), ("3-0", "[1]"), ("4-0", '{"type": "alert"}'), ("5-0", "{}"), ("6-0", None)]
    parsed = routing.parse_messages(spark.createDataFrame([("s", *r) for r in raw], "stream_key string, message_id string, raw string"))
    planned = routing.plan_outcomes(parsed, "type", ["alert", "warning"])
    sent = spark.createDataFrame([("s", "1-0", True), ("s", "4-0", False)], "stream_key string, message_id string, success boolean")
    got = {r.message_id: (r.outcome, r.ack) for r in routing.settle_outcomes(planned, sent).collect()}
    assert got == {
        "1-0": ("published", True), "2-0": ("filtered", True), "3-0": ("invalid", True),
        "4-0": ("failed", False), "5-0": ("filtered", True), "6-0": ("invalid", True),
    }


def test_advertisements(spark):
    ads = spark.createDataFrame(
        [(1, "AA:BB:CC:DD:EE:FF", ["1234"]), (2, "B", ["9"]), (3, "C", ["ABcd", "77"]), (4, "D", None)],
        "n int, address string, uuids array<string>",
    )
    known = [("insole", "77"), ("pressure_bed", "abCD")]
    hit = devices.advertised(ads, known, target="1234").collect()
    assert [(r.address, r.modality) for r in hit] == [("AA:BB:CC:DD:EE:FF", "unknown_device_type")]
    found = devices.advertised(ads, known).withColumn("scan", F.lit(1))
    row = devices.scan_result(found, ["scan"], "n").first()
    assert (row.devices, row.address, row.modality) == (1, "C", "insole")
    assert devices.scan_result(found, ["scan"], "n", device="skiin").first().modality == "skiin"


def test_dispatch(spark):
    df = spark.createDataFrame([(1, "pressure_bed"), (2, "toaster"), (3, None)], "n int, modality string")

    def rule(name):
        return lambda x: x.withColumn("by", F.lit(name))

    out = devices.dispatch(df, {"pressure_bed": rule("frames")}, rule("base"))
    assert {(r.n, r.by) for r in out.collect()} == {(1, "frames"), (2, "base"), (3, "base")}
    assert devices.undispatched(df, ["pressure_bed"]).count() == 2


@pytest.mark.parametrize(
    "raw, want",
    [
        ("010100000000C03FAA", ("CONFIG_SENSOR", 0, 0, 1.5)),
        ("0101000000AA", ("CONFIG_SENSOR", 0, 0, 0.0)),
        ("01010200", ("CONFIG_SENSOR", 2, 0, None)),
        ("010107", (None, None, None, None)),
        ("FFFF0500AABBCCDDEE", (None, 5, None, None)),
        ("010200010000C03FAA", ("READ_SENSOR_CFG", 0, None, None)),
        ("020000000000C03FAA", ("START", 0, None, None)),
        ("010100000000C03F01AA", ("CONFIG_SENSOR", 0, 0, None)),
    ],
)
def test_responses(spark, raw, want):
    ops = [("CONFIG_SENSOR", "0101"), ("READ_SENSOR_CFG", "0102"), ("START", "0200")]
    df = spark.createDataFrame([(bytearray.fromhex(raw),)], "response binary")
    r = devices.response_decode(df, ops).first()
    assert (r.opcode, r.status, r.system, r.value) == want


def test_count_batches(spark):
    rows = [("a", i) for i in range(10)] + [("b", i) for i in range(3)]
    df = ordered.with_chunk(spark.createDataFrame(rows, "k string, n bigint"), "n", 2)
    full = frames.count_batches(df, ["k"], "n", 4)
    assert {(r.k, r.batch_no) for r in full.collect()} == {("a", 0), ("a", 1)} and full.count() == 8
    assert frames.count_batches(df, ["k"], "n", 4, force_save=True).count() == 13


def test_registry(spark):
    df = spark.createDataFrame([("insole",), ("toaster",)], "device string")
    got = {r.device: r.device_db for r in devices.with_registry(df).collect()}
    assert got == {"insole": 3, "toaster": None}
    assert devices.unregistered(df).count() == 1


def test_group_without_consumers_is_reported(spark):
    columns = "stream_key string, grp string, consumer string, id_ms bigint, id_seq bigint, acked boolean"
    d = spark.createDataFrame([("s", "a", "c", 9, 0, True), ("s", "a", "c", 10, 0, False)], columns)
    groups = spark.createDataFrame([("s", "a"), ("s", "b")], "stream_key string, grp string")
    consumers = spark.createDataFrame([("s", "a", "c")], "stream_key string, grp string, consumer string")
    found = health.group_stats(d, groups, consumers)
    assert sorted(map(tuple, found.collect())) == [("s", "a", 1, 1, "10-0"), ("s", "b", 0, 0, None)]
    assert health.group_stats(d.limit(0), groups, consumers.limit(0)).count() == 2
    stats = streamlog.with_empty(
        streamlog.stream_stats(d), spark.createDataFrame([("s",), ("t",)], "stream_key string")
    )
    assert {(r.stream_key, r.length, r.first_id, r.last_id) for r in stats.collect()} == {("s", 2, "9-0", "10-0"), ("t", 0, None, None)}
    status = health.stream_health(stats.select("stream_key"), stats, found).collect()
    assert {(r.stream_key, r.status) for r in status} == {("s", "WARNING"), ("t", "WARNING")}
