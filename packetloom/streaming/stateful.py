"""Frames, session ends and count batches over a stream, in Spark's keyed state.

Packets travel to their session in chunk rows: each input partition sorts the packets
that it has and packs up to ``CHUNK_PACKETS`` of a session into one row, so a hot device
sends a few wide rows. The handler of a session holds one row of counters and fewer than a
frame's rows that wait. It orders the packets of a micro-batch by ``order``; one that comes
after later packets were processed counts as lost. Of a session's packets a task holds some
20 bytes each; their samples go to a file of the task beyond ``SAMPLE_BYTES``, and frames are
given ``TOGETHER`` packets at a time. Limit the intake (``runs``) where that is too much.

A session ends when a packet comes more than ``idle_s`` after the one before, or when the
watermark has passed that time without one; then its state is removed. Control rows end
parts of it, see ``EVENTS``. Needs a state store with several column families (RocksDB).
"""

from __future__ import annotations

import sys
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from packetloom.operators.frames import BATCH_SAMPLES, FRAME_ROWS
from packetloom.operators.packets import COLUMNS_PER_PACKET, CYCLE, LOST_VALUE, MODES, ROW_WIDTH, SAMPLES, TRIGGER_ORDER

# Workers get the handlers below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_PACKETS = 512
# Packets that a handler turns into frames at once; bytes of samples that it holds in memory.
TOGETHER, SAMPLE_BYTES = 2048, 16 << 20
# What a control row does: ``stop`` drops the rows that wait, ``reset`` also shuts the start
# gate, ``start`` forgets the last trigger line and the losses.
EVENTS = ("stop", "reset", "start")
# A sample that is null, or missing in a short packet.
_NO_SAMPLE = np.iinfo(np.int32).min
_PLACE = np.full(256, -1, np.int64)
_PLACE[TRIGGER_ORDER] = np.arange(len(TRIGGER_ORDER))
# sample of a de-interleaved row: a quarter of the packet, read column by column
_TURNED = (np.arange(ROW_WIDTH) % 6) * COLUMNS_PER_PACKET + np.arange(ROW_WIDTH) // 6
_PACKED = "first_ms timestamp, n int, at binary, ms binary, trig binary, event binary, samples binary"


def _samples(column):
    """An Arrow list column as rows of ``SAMPLES`` numbers."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy()
    flat = column.flatten().cast(pa.int32()).fill_null(_NO_SAMPLE).to_numpy()
    if (sizes == SAMPLES).all():
        return flat.reshape(-1, SAMPLES)
    out = np.full((len(sizes), SAMPLES), _NO_SAMPLE, np.int32)
    starts = np.cumsum(sizes) - sizes
    for k, (begin, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
        out[k, : min(size, SAMPLES)] = flat[begin : begin + min(size, SAMPLES)]
    return out


def _pack(keys):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in [*keys, "at"]]).combine_chunks()
            codes = np.stack([table[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in keys])
            edges = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
            edges = [0, *edges.tolist(), table.num_rows]
            cuts = [(a, min(a + CHUNK_PACKETS, end)) for begin, end in zip(edges, edges[1:]) for a in range(begin, end, CHUNK_PACKETS)]
            at, ms = table["at"].to_numpy(), table["ms"].to_numpy()
            trig = table["trig"].fill_null(-1).to_numpy().astype(np.int32)
            event = pc.index_in(table["event"], pa.array(EVENTS)).fill_null(-1).to_numpy().astype(np.int8)
            samples = _samples(table["pressure"].combine_chunks())
            columns = {c: table[c].take(pa.array([a for a, _ in cuts], pa.int64())).combine_chunks() for c in keys}
            columns["first_ms"] = pa.array([int(ms[a:b].max()) * 1000 for a, b in cuts], pa.timestamp("us", "UTC"))
            columns["n"] = pa.array([b - a for a, b in cuts], pa.int32())
            for name, values in (("at", at), ("ms", ms), ("trig", trig), ("event", event), ("samples", samples)):
                columns[name] = pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


class _Intake:
    """The packets of chunk rows, in order. Samples of more than ``SAMPLE_BYTES`` lie in a file
    of the task, which has no name and goes with it."""

    KINDS = {"at": np.int64, "ms": np.int64, "trig": np.int32, "event": np.int8}

    def __init__(self, tables):
        parts, held, size, file = {name: [] for name in self.KINDS}, [], 0, None
        for table in tables:
            for name, kind in self.KINDS.items():
                parts[name] += [np.frombuffer(x, kind) for x in table[name]]
            held += table["samples"].tolist()
            size += sum(map(len, table["samples"]))
            if size > SAMPLE_BYTES:
                file = file or tempfile.TemporaryFile()
                file.writelines(held)
                held, size = [], SAMPLE_BYTES
        if file:
            file.writelines(held)
            file.flush()
        flat = np.memmap(file, np.int32, "r") if file else np.frombuffer(b"".join(held), np.int32)
        self._samples = flat.reshape(-1, SAMPLES)
        found = {name: np.concatenate(x) for name, x in parts.items()}
        self._order = np.argsort(found["at"], kind="stable")
        self.at, self.ms, self.trig, self.event = (found[name][self._order] for name in self.KINDS)

    def samples(self, begin, end):
        return np.asarray(self._samples[self._order[begin:end]])


def steps_lost(pos, prev, mode):
    """Packets lost before each of some scan places; ``prev`` is the place before them or None."""
    before = np.concatenate([[pos[0] if prev is None else prev], pos[:-1]])
    if mode == "modular":
        lost = np.where(pos == before, 0, (pos - before - 1) % CYCLE)
    else:
        lost = np.where((before < CYCLE) & (pos == (before + 1) % CYCLE), 0, np.abs(pos - before) - 1)
    if prev is None:
        lost[0] = 0
    return lost


def packet_rows(samples, lost):
    """The rows that packets add: those of lost packets, then the four of each packet."""
    gap = COLUMNS_PER_PACKET * np.maximum(lost, 0)
    ends = np.cumsum(gap + COLUMNS_PER_PACKET)
    rows = np.full((int(ends[-1]), ROW_WIDTH), LOST_VALUE, np.int32)
    real = samples.reshape(-1, COLUMNS_PER_PACKET, ROW_WIDTH)[:, :, _TURNED]
    rows[(ends[:, None] - COLUMNS_PER_PACKET + np.arange(COLUMNS_PER_PACKET)).ravel()] = real.reshape(-1, ROW_WIDTH)
    return rows


def _put(state, rows):
    """Replaces a list state, which takes no empty list."""
    state.put(rows) if rows else state.clear()


def _lists(frame):
    if not (frame == _NO_SAMPLE).any():
        return frame.tolist()
    return [[None if x == _NO_SAMPLE else x for x in row] for row in frame.tolist()]


class SessionFrames(StatefulProcessor):
    """Counters of a session, and the rows of the frame that is not released yet."""

    COUNTERS = ("begun", "segment", "opened", "prev", "packets", "lost", "frames", "last_ms")

    def __init__(self, keys, mode, idle_ms, output):
        self.keys, self.mode, self.idle_ms, self.output = keys, mode, idle_ms, output

    def init(self, handle):
        self.handle = handle
        self.session = handle.getValueState(
            "session", "begun long, segment long, opened boolean, prev long, packets long, lost long, frames long, last_ms long"
        )
        self.waiting = handle.getListState("waiting", "row array<int>")

    def _load(self):
        held = self.session.get()
        if held is None:
            return None, np.zeros((0, ROW_WIDTH), np.int32)
        rows = [list(r[0]) for r in self.waiting.get()]
        rows = [[_NO_SAMPLE if x is None else x for x in row] for row in rows]
        return dict(zip(self.COUNTERS, held)), np.array(rows, np.int32).reshape(-1, ROW_WIDTH)

    def _fresh(self, begun):
        return dict(begun=begun, segment=0, opened=False, prev=None, packets=0, lost=0, frames=0, last_ms=None)

    def _end(self, state, waiting, reason):
        return {
            "kind": "end", "begun": state["begun"], "segment": state["segment"], "frame_id": None, "frame": None,
            "reason": reason, "packets": state["packets"], "lost": state["lost"], "frames": state["frames"], "rows_left": len(waiting),
        }

    def _advance(self, state, waiting, trig, samples, out):
        """Packets without a control row or a pause between them."""
        pos = np.where((trig >= 0) & (trig < 256), _PLACE[np.clip(trig, 0, 255)], -1)
        known = pos >= 0
        if not state["opened"]:
            zero = np.flatnonzero(trig == 0)
            known &= np.arange(len(trig)) >= (zero[0] if len(zero) else len(trig))
            state["opened"] = bool(len(zero))
        pos, samples = pos[known], samples[known]
        if not len(pos):
            return waiting
        lost = steps_lost(pos, state["prev"], self.mode)
        rows = np.concatenate([waiting, packet_rows(samples, lost)])
        state["prev"] = int(pos[-1])
        state["packets"] += len(pos)
        state["lost"] += int(lost.sum())
        done = max(0, (len(rows) - 1) // FRAME_ROWS)
        for k in range(done):
            frame = _lists(rows[k * FRAME_ROWS : (k + 1) * FRAME_ROWS])
            out.append({
                "kind": "frame", "begun": state["begun"], "segment": state["segment"], "frame_id": state["frames"] + k,
                "frame": frame, "reason": None, "packets": None, "lost": None, "frames": None, "rows_left": None,
            })
        state["frames"] += done
        return rows[done * FRAME_ROWS :]

    def _control(self, state, waiting, event, out):
        name = EVENTS[event]
        if name == "start":
            state["prev"], state["lost"] = None, 0
            return waiting
        out.append(self._end(state, waiting, name))
        state["segment"] += 1
        state["packets"] = state["frames"] = 0
        if name == "reset":
            state["opened"] = False
        return waiting[:0]

    def handleInputRows(self, key, rows, timerValues):
        intake = _Intake(rows)
        at, ms, event = intake.at, intake.ms, intake.event
        state, waiting = self._load()
        held, out = state and state["last_ms"], []
        pause = np.zeros(len(at), bool)
        if self.idle_ms is not None:
            before = np.concatenate([[ms[0] if held is None else held], ms[:-1]])
            pause = ms - np.maximum.accumulate(before) > self.idle_ms
        cuts = np.flatnonzero(pause | (event >= 0)).tolist()
        begin = 0
        for cut in [*cuts, len(at)]:
            if state is None:
                state = self._fresh(int(at[begin]) if begin < len(at) else int(at[-1]))
            for a in range(begin, cut, TOGETHER):
                b = min(a + TOGETHER, cut)
                waiting = self._advance(state, waiting, intake.trig[a:b], intake.samples(a, b), out)
                if len(out) >= TOGETHER // COLUMNS_PER_PACKET:
                    yield self._table(key, out)
                    out = []
            if cut == len(at):
                break
            if pause[cut]:
                if cut or held is not None:
                    out.append(self._end(state, waiting, "idle"))
                state, waiting = self._fresh(int(at[cut])), waiting[:0]
            begin = cut
            if event[cut] >= 0:
                waiting = self._control(state, waiting, int(event[cut]), out)
                begin = cut + 1
        state["last_ms"] = int(max(ms.max(), held or 0)) if not pause.any() else int(ms[np.flatnonzero(pause)[-1] :].max())
        self.session.update(tuple(state[c] for c in self.COUNTERS))
        _put(self.waiting, [(row,) for row in _lists(waiting)])
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(state["last_ms"] + self.idle_ms)
        yield self._table(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state, waiting = self._load()
        self.session.clear()
        self.waiting.clear()
        yield self._table(key, [self._end(state, waiting, "idle")] if state else [])

    def _table(self, key, out):
        table = pd.DataFrame(out, columns=self.output)
        for name in self.output:
            if name not in ("kind", "frame", "reason"):
                table[name] = table[name].astype("Int64")
        for k, name in reversed(list(enumerate(self.keys))):
            table.insert(0, name, pd.Series([key[k]] * len(table), dtype=object if isinstance(key[k], str) else None))
        return table

    def close(self):
        pass


_OUTPUT = "kind string, begun long, segment long, frame_id long, frame array<array<int>>, reason string, packets long, lost long, frames long, rows_left long"


def session_frames(stream, keys=("device", "session"), order="seq", ts=None, event=None, mode="reference",
                   idle_s=None, delay="0 seconds"):
    """Released frames and session ends of a stream of packets, as a stream.

    Input: the keys, ``order`` (a whole number), ``trig``, ``pressure``, with ``idle_s`` the
    time ``ts``, and a column ``event`` where there are control rows. Output: the keys,
    ``begun`` (the order of the session's first row), ``segment`` (control rows before), and

    * ``kind`` frame: ``frame_id`` within the segment, ``frame`` of 15 x 24;
    * ``kind`` end: ``reason`` (stop, reset, idle), ``packets``, ``lost``, ``frames`` of the
      segment, and ``rows_left``, rows that no frame took.

    Packets without a key or order are left out, as are unknown trigger lines;
    ``packets.reject_unknown`` lists both and takes a stream too. ``delay`` is how late a
    packet may come before the watermark drops it.
    """
    if mode not in MODES[:2]:
        raise ValueError(f"unknown loss mode {mode}")
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    known = stream.dropna(subset=[*keys, order])
    if ts is not None:
        known = known.where(F.col(ts).isNotNull())
    rows = known.select(
        *keys, F.col(order).cast("long").alias("at"),
        (F.unix_millis(F.col(ts).cast("timestamp")) if ts else F.lit(0).cast("long")).alias("ms"),
        F.col("trig").cast("int").alias("trig"), (F.col(event) if event else F.lit(None)).cast("string").alias("event"),
        F.col("pressure").cast("array<int>").alias("pressure"),
    )
    chunks = rows.mapInArrow(_pack(keys), ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", " + _PACKED)
    if idle_s is not None:
        chunks = chunks.withWatermark("first_ms", delay)
    names = [f.split(" ")[0] for f in _OUTPUT.split(", ")]
    return chunks.groupBy(*keys).transformWithStateInPandas(
        SessionFrames(keys, mode, None if idle_s is None else int(idle_s * 1000), names),
        ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", " + _OUTPUT, "Append", "None" if idle_s is None else "EventTime",
    )


class CountBatches(StatefulProcessor):
    """How many batches a key has had, and the samples that wait for the next."""

    def __init__(self, keys, order, size, idle_ms, every, columns, kinds):
        self.keys, self.order, self.size, self.idle_ms = keys, order, size, idle_ms
        self.every, self.columns, self.kinds = every, columns, kinds

    def init(self, handle):
        self.handle = handle
        self.number = handle.getValueState("number", "number long")
        self.waiting = handle.getListState("waiting", ", ".join(f"`{c}` {k}" for c, k in zip(self.columns, self.kinds)))

    def _held(self):
        number = self.number.get()
        rows = pd.DataFrame(list(self.waiting.get()), columns=self.columns)
        return number[0] if number else 0, rows

    def handleInputRows(self, key, rows, timerValues):
        number, held = self._held()
        # by place: a name that begins with a line does not come through
        new = pd.concat(list(rows)).set_axis(self.every, axis=1)[self.columns].sort_values(self.order, kind="stable")
        every = pd.concat([held, new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        full = len(every) // self.size
        out = self._numbered(key, every.iloc[: full * self.size], number)
        left = every.iloc[full * self.size :]
        self.number.update((number + full,))
        _put(self.waiting, [tuple(_plain(x) for x in row) for row in left.itertuples(index=False, name=None)])
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if len(left):
                self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), int(new["_ms"].max())) + self.idle_ms)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        number, held = self._held()
        if len(held):
            self.number.update((number + 1,))
        self.waiting.clear()
        yield self._numbered(key, held, number)

    def _numbered(self, key, rows, number):
        out = rows.drop(columns="_ms").copy()
        place = np.arange(len(out))
        out["batch_no"], out["batch_pos"] = place // self.size + number, (place % self.size).astype(np.int32)
        for k, name in reversed(list(enumerate(self.keys))):
            out.insert(0, name, pd.Series([key[k]] * len(out), index=out.index, dtype=object if isinstance(key[k], str) else None))
        return out

    def close(self):
        pass


def _plain(value):
    value = value.item() if isinstance(value, np.generic) else value
    return None if isinstance(value, float) and value != value else value


def batches(stream, keys=("device",), order="seq", size=BATCH_SAMPLES, ts=None, idle_s=None, delay="0 seconds"):
    """Every ``size`` consecutive samples per key of a stream, as a stream: adds
    ``batch_no`` and ``batch_pos``.

    Fewer than ``size`` wait; with ``idle_s`` they are released as a batch of their own once
    the watermark on ``ts`` has passed the newest of them by that much.
    """
    keys = list(keys)
    rows = stream.dropna(subset=[*keys, order])
    columns = [f for f in rows.schema if f.name not in keys]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys + [f.name for f in columns]) + ", batch_no long, batch_pos int"
    if idle_s is not None:
        rows = rows.withWatermark(ts, delay)
    rows = rows.withColumn("_ms", F.unix_millis(F.col(ts).cast("timestamp")) if ts else F.lit(0).cast("long"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        CountBatches(
            keys, order, size, None if idle_s is None else int(idle_s * 1000), rows.columns,
            [f.name for f in columns] + ["_ms"], [f.dataType.simpleString() for f in columns] + ["long"],
        ),
        schema, "Append", "None" if idle_s is None else "EventTime",
    )


def to_folder(out):
    """A micro-batch function that writes every batch to a folder of its own."""

    def run(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return run
