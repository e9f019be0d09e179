import random

import pytest
from model import Assembler
from pyspark.sql import functions as F

from packetloom.operators import frames, packets
from packetloom.operators.ordered import with_chunk

SCHEMA = "device string, session string, seq bigint, read int, trig int, pressure array<int>"
KEYS = ["device", "session"]


def samples(seq):
    return [(seq * 31 + j * 17) % 1000 - 100 for j in range(96)]


def make(spark, rows, width=1 << 20):
    data = [(d, s, q, 0, t, samples(q)) for d, s, q, t in rows]
    return with_chunk(spark.createDataFrame(data, SCHEMA).repartition(3), "seq", width)


def session(triggers, device="d", name="s"):
    return [(device, name, i, t) for i, t in enumerate(triggers)]


def tracked(spark, triggers, mode="reference", width=1 << 20):
    t = packets.track(make(spark, session(triggers), width), KEYS, "seq", mode)
    return t.orderBy("seq").collect()


CYCLE = packets.TRIGGER_ORDER[:15]


def test_gate_drops_until_first_zero(spark):
    assert [r.trig for r in tracked(spark, [4, 8, 0, 4])] == [0, 4]


def test_clean_run(spark):
    df = make(spark, session([0, 4, 8, 12, 1]))
    t = packets.track(df, KEYS, "seq")
    assert [r.lost for r in t.collect()] == [0] * 5
    assert t.agg(F.max("row_end")).first()[0] == 20
    assert frames.assemble(t, KEYS).count() == 1


def test_exact_multiple_keeps_last_frame_back(spark):
    t = packets.track(make(spark, session(CYCLE)), KEYS, "seq")
    assert t.agg(F.max("row_end")).first()[0] == 60
    assert frames.assemble(t, KEYS).count() == 3


@pytest.mark.parametrize(
    "triggers, mode, lost",
    [
        ([0, 8], "reference", 1),
        (CYCLE + [0], "reference", 0),
        (CYCLE[:14] + [0], "reference", 12),
        (CYCLE[:14] + [0], "modular", 1),
        ([0, 0], "reference", -1),
        ([0, 0], "modular", 0),
        ([0, 99, 4], "reference", 0),
        ([0, 8], "off", 0),
    ],
)
def test_loss_cases(spark, triggers, mode, lost):
    for width in (1, 2, 1 << 20):
        rows = tracked(spark, triggers, mode, width)
        assert rows[-1].lost == lost
        assert rows[-1].loss_total == lost
        assert rows[-1].row_end == 4 * len(rows) + 4 * max(lost, 0)


def test_gap_rows_come_before_the_packet(spark):
    t = packets.track(make(spark, session([0, 8])), KEYS, "seq")
    rows = frames_rows = packets.frame_rows(t).orderBy("row_idx").collect()
    assert [r.is_gap for r in frames_rows] == [False] * 4 + [True] * 4 + [False] * 4
    assert rows[4].row == [-1000] * 24
    assert packets.gap_rows(t).count() == 4


def test_unknown_triggers_go_to_a_side_frame(spark):
    df = make(spark, session([0, 99, 4]) + [(None, "s", 7, 0)])
    got = {r.seq: r.reason for r in packets.reject_unknown(df).collect()}
    assert got == {1: "unknown trigger line", 7: "missing session key or order"}


def test_deinterleave_order(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(95)), lambda i: i).alias("pressure"))
    first = df.select(packets.deinterleaved()[0].alias("r")).first().r
    assert first == [0, 4, 8, 12, 16, 20, 1, 5, 9, 13, 17, 21, 2, 6, 10, 14, 18, 22, 3, 7, 11, 15, 19, 23]


def random_sessions(seed, hot=False):
    rng = random.Random(seed)
    rows = []
    for device in range(4):
        # one device holds most of the packets
        n = 400 if hot and device == 0 else rng.randint(0, 60)
        place, kept, seq = rng.randrange(15), [], 0
        for _ in range(n):
            step = rng.choices([1, 0, 2, 5, 9], [80, 4, 8, 4, 4])[0]
            place = (place + step) % 15
            trig = CYCLE[place] if rng.random() > 0.05 else rng.choice([15, 99, 3, 0])
            seq += rng.choice([1, 1, 1, 3])
            kept.append((f"d{device}", f"s{device % 2}", seq, trig))
        rows += kept
    return rows


def brute(rows, mode):
    machines = {}
    for device, name, seq, trig in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        machines.setdefault((device, name), Assembler(mode)).feed(seq, trig, samples(seq))
    return machines


@pytest.mark.parametrize("mode", ["reference", "modular"])
@pytest.mark.parametrize("seed, width", [(1, 1 << 20), (2, 7), (3, 1), (4, 25)])
def test_matches_the_procedure(spark, mode, seed, width):
    rows = random_sessions(seed, hot=True)
    machines = brute(rows, mode)
    t = packets.track(make(spark, rows, width), KEYS, "seq", mode).persist()
    got = {}
    for r in t.orderBy("seq").collect():
        got.setdefault((r.device, r.session), []).append((r.seq, r.lost, r.loss_total, r.packet_no))
    want = {
        k: [(s, lost, total, n) for n, (s, lost, total, _) in enumerate(m.seen)]
        for k, m in machines.items() if m.seen
    }
    assert got == want

    made = {}
    for r in frames.assemble(t, KEYS).orderBy("frame_id").collect():
        made.setdefault((r.device, r.session), []).append([list(x) for x in r.frame])
    assert made == {k: m.frames for k, m in machines.items() if m.frames}

    shown = frames.frame_per_packet(t, KEYS).collect()
    by_packet = {(r.device, r.session, r.seq): [list(x) for x in r.frame] for r in shown}
    assert by_packet == {(*k, s): f for k, m in machines.items() for s, _, _, f in m.seen}
    t.unpersist()


def test_new_frames_only_when_the_shown_frame_changes(spark):
    rows = random_sessions(5)
    t = packets.track(make(spark, rows, 9), KEYS, "seq")
    got = {(r.device, r.session, r.seq) for r in frames.new_frames(t, KEYS).collect()}
    want = set()
    for key, m in brute(rows, "reference").items():
        last = []
        for seq, _, _, shown in m.seen:
            if shown is not last and shown:
                want.add((*key, seq))
            last = shown
    assert got == want


def test_channel_series(spark):
    rows = random_sessions(6)
    t = packets.track(make(spark, rows, 5), KEYS, "seq", "off")
    got = {}
    for r in frames.channel_samples(frames.channel_series(t, KEYS), KEYS).orderBy("channel", "t_idx").collect():
        got.setdefault((r.device, r.session, r.channel), []).append(r.v)
    want = {}
    for key, m in brute(rows, "off").items():
        for seq, *_ in m.seen:
            for channel in range(4):
                want.setdefault((*key, channel), []).extend(samples(seq)[channel::4])
    assert got == want


def test_end_state_continues_in_a_second_batch(spark):
    rows = random_sessions(7, hot=True)
    whole = packets.track(make(spark, rows, 11), KEYS, "seq")
    first = make(spark, [r for r in rows if r[2] <= 40], 11)
    second = make(spark, [r for r in rows if r[2] > 40], 11)
    state = packets.end_state(packets.chunk_carry(first, KEYS, "seq"), KEYS)
    rest = packets.track(second, KEYS, "seq", start=state)
    cols = ["device", "session", "seq", "packet_no", "lost", "loss_total", "row_start", "row_end"]
    want = {tuple(r) for r in whole.where("seq > 40").select(*cols).collect()}
    assert {tuple(r) for r in rest.select(*cols).collect()} == want


def test_no_window_over_a_whole_session(spark):
    """Wide rows are only ever windowed inside (keys, chunk)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = packets.track(make(spark, session(CYCLE)), KEYS, "seq")
        plan = t._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in plan.splitlines():
        if "Window [" in line and "pressure" in line:
            assert "chunk" in line
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
