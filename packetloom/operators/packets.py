"""Pressure packets: decoding, start gate, de-interleave, loss and gap rows.

A packet row has the session keys, a unique whole-number arrival column, its
``chunk`` (see ``ordered``), ``trig`` and ``pressure`` (96 samples).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.binary import byte_at, int16_list, uint16_at
from packetloom.operators.ordered import CHUNK

# Scan order of the trigger lines, frame shape, marker of a lost row.
TRIGGER_ORDER = [0, 4, 8, 12, 1, 5, 9, 13, 2, 6, 10, 14, 3, 7, 11, 15]
CYCLE = 15
COLUMNS_PER_PACKET = 4
ROW_WIDTH = 24
SAMPLES = COLUMNS_PER_PACKET * ROW_WIDTH
LOST_VALUE = -1000
PRESSURE_CHAR = "9880"

MODES = ("reference", "modular", "off")


def decode_headers(raw: DataFrame, col: str = "header", char: str | None = PRESSURE_CHAR) -> DataFrame:
    """Six header bytes to (part, char_id, length); keeps one characteristic."""
    out = raw.withColumns(
        {
            "part": F.format_string("%03x", uint16_at(col, 0)),
            "char_id": F.format_string("%04x", uint16_at(col, 2)),
            "length": uint16_at(col, 4),
        }
    )
    return out if char is None else out.where(F.col("char_id") == char)


def decode_packets(raw: DataFrame, col: str = "packet") -> DataFrame:
    """Read line, trigger line and 96 signed samples of a raw packet."""
    return raw.withColumns(
        {
            "read_line": byte_at(col, 0),
            "trig": byte_at(col, 1),
            "pressure": int16_list(col, 2, SAMPLES),
        }
    )


def trigger_pos(trig):
    """0-based place in the scan order; null for an unknown trigger line."""
    order = ", ".join(map(str, TRIGGER_ORDER))
    place = f"CAST(array_position(array({order}), CAST(`{trig}` AS INT)) AS INT)"
    return F.expr(f"CASE WHEN {place} > 0 THEN {place} - 1 END")


def reject_unknown(packets: DataFrame, keys=("device", "session"), order: str = "seq") -> DataFrame:
    """Packets ``track`` cannot place, with a reason: a missing session key or
    arrival number, or a trigger line that is not in the scan order."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in (*keys, order)])
    reason = F.when(missing, "missing session key or order").when(
        trigger_pos("trig").isNull(), "unknown trigger line"
    )
    return packets.withColumn("reason", reason).where("reason IS NOT NULL")


def _lost(pos, prev, mode):
    """Packets lost between two scan places."""
    if mode == "off":
        return F.lit(0)
    if mode == "modular":
        return F.when(pos == prev, 0).otherwise(F.pmod(pos - prev - 1, F.lit(CYCLE)))
    expected = (prev < CYCLE) & (pos == (prev + 1) % CYCLE)
    return F.when(expected, 0).otherwise(F.abs(pos - prev) - 1)


def _gap(lost):
    return COLUMNS_PER_PACKET * F.greatest(lost, F.lit(0))


def _known(packets, mode):
    pos = F.lit(0) if mode == "off" else trigger_pos("trig")
    out = packets.withColumn("pos", pos)
    return out if mode == "off" else out.where(F.col("pos").isNotNull())


def _inside(packets, keys, order, mode):
    """Steps within a chunk: previous place, loss, running loss and gap rows.

    Counts from the chunk's start and ignores the start gate; ``chunk_carry`` holds
    what has to be added or taken off per chunk.
    """
    along = Window.partitionBy(*keys, CHUNK).orderBy(order)
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    step = F.coalesce(_lost(F.col("pos"), F.col("prev"), mode), F.lit(0))
    return (
        _known(packets, mode)
        .withColumns({"prev": F.lag("pos").over(along), "i": F.row_number().over(along)})
        .withColumn("step", step)
        .withColumns(
            {"run_lost": F.sum("step").over(so_far), "run_gap": F.sum(_gap(F.col("step"))).over(so_far)}
        )
    )


def _chunk_summary(packets, keys, order, mode):
    """One row per (keys, chunk): totals, and the same totals before the chunk's
    first trigger 0, so the start gate needs no pass of its own."""
    rows = _inside(packets.select(*keys, CHUNK, order, "trig"), keys, order, mode)
    # values at the first trigger 0; the running values never depend on later rows
    zero = F.when(F.col("trig") == 0, F.col("i"))
    return rows.groupBy(*keys, CHUNK).agg(
        F.min(F.when(F.col("trig") == 0, F.col(order))).alias("zero"),
        F.max(F.when(F.col("i") == 1, F.col("pos"))).alias("first_pos"),
        F.max_by("pos", "i").alias("last_pos"),
        F.max("i").cast("bigint").alias("n"),
        F.max_by("run_lost", "i").alias("lost"),
        F.max_by("run_gap", "i").alias("gap"),
        (F.min(zero) - 1).cast("bigint").alias("n_shut"),
        F.min_by("run_lost", zero).alias("lost_shut"),
        F.min_by("run_gap", zero).alias("gap_shut"),
    )


def chunk_carry(packets: DataFrame, keys, order: str, mode: str = "reference",
                start: DataFrame | None = None) -> DataFrame:
    """What each chunk inherits from the chunks before it, and session totals.

    ``start`` holds the state of sessions that began in an earlier batch (the
    result of ``end_state``); it counts as the chunk before the first one.
    """
    session = Window.partitionBy(*keys)
    past = session.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    chunks = _chunk_summary(packets, keys, order, mode)
    totals = {"s_lost": "loss_total", "s_rows": "rows_total", "s_packets": "packets_total"}
    if start is None:
        chunks = chunks.withColumns(
            {
                "s_open": F.lit(False), "s_pos": F.lit(None).cast("int"),
                **{name: F.lit(0).cast("bigint") for name in totals},
            }
        )
    else:
        known = start.select(
            *keys, F.lit(True).alias("s_open"), F.col("last_pos").alias("s_pos"),
            *[F.col(state).alias(name) for name, state in totals.items()],
        )
        chunks = chunks.join(known, keys, "left").fillna(
            {"s_open": False, **{name: 0 for name in totals}}
        )
    chunks = chunks.withColumns(
        {
            "gate": F.min("zero").over(session),
            "opened": F.col("s_open") | F.min("zero").over(past).isNotNull(),
            "before": F.coalesce(F.last("last_pos", ignorenulls=True).over(past), F.col("s_pos")),
        }
    )
    opened = F.col("opened")
    edge = F.coalesce(_lost(F.col("first_pos"), F.col("before"), mode), F.lit(0))
    chunks = chunks.withColumn("edge", F.when(opened, edge).otherwise(0))

    def counted(whole, shut, extra):
        """Total of the chunk's part behind the gate; 0 while the session is shut."""
        return F.when(opened, F.col(whole) + extra).otherwise(
            F.coalesce(F.col(whole) - F.col(shut), F.lit(0))
        )

    chunks = chunks.withColumns(
        {
            "c_packets": counted("n", "n_shut", F.lit(0)),
            "c_lost": counted("lost", "lost_shut", F.col("edge")),
            "c_gap": counted("gap", "gap_shut", _gap(F.col("edge"))),
        }
    ).withColumn("c_rows", COLUMNS_PER_PACKET * F.col("c_packets") + F.col("c_gap"))

    def base(what, first, extra, shut):
        """What to add to the running value within the chunk."""
        earlier = F.col(first) + F.coalesce(F.sum(what).over(past), F.lit(0))
        return earlier + F.when(opened, extra).otherwise(-F.coalesce(shut, F.lit(0)))

    n_shut, gap_shut = F.col("n_shut"), F.col("gap_shut")
    return chunks.select(
        *keys,
        CHUNK,
        F.when(~F.col("s_open"), F.col("gate")).alias("gate"),
        (F.col("s_open") | F.col("gate").isNotNull()).alias("ever_open"),
        "edge",
        "last_pos",
        base("c_lost", "s_lost", F.col("edge"), F.col("lost_shut")).alias("add_lost"),
        base("c_rows", "s_rows", _gap(F.col("edge")), COLUMNS_PER_PACKET * n_shut + gap_shut).alias("add_rows"),
        base("c_packets", "s_packets", F.lit(0), n_shut).alias("add_packets"),
        *[
            (F.col(name) + F.sum(c).over(session)).alias(state)
            for c, (name, state) in zip(("c_lost", "c_rows", "c_packets"), totals.items())
        ],
    )


def track(packets: DataFrame, keys=("device", "session"), order: str = "seq",
          mode: str = "reference", start: DataFrame | None = None,
          carry: DataFrame | None = None) -> DataFrame:
    """Start gate, packet loss and row positions of every packet.

    Packets before a session's first trigger 0 and packets with an unknown
    trigger are left out. Adds

    ``packet_no``  0-based number after the gate
    ``lost``       packets lost just before this one
    ``loss_total`` running loss of the session
    ``row_start``  frame rows written before this packet and its gap
    ``row_end``    frame rows written once it is in
    ``rows_total`` frame rows of the whole session so far

    ``mode`` is ``reference`` (distance in the scan order), ``modular``
    (true distance over a cycle) or ``off`` (no loss, any trigger).

    Packets are shuffled and sorted once, by (keys, chunk, order). ``carry`` is
    the ``chunk_carry`` of the same packets, for a caller that has it already.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    keys = list(keys)
    if carry is None:
        carry = chunk_carry(packets, keys, order, mode, start)
    carry = carry.drop("last_pos", "loss_total", "packets_total")
    gate = F.col("gate")
    lost = (
        F.when(F.col(order) == gate, 0).when(F.col("i") == 1, F.col("edge")).otherwise(F.col("step"))
    )
    row_end = F.col("add_rows") + COLUMNS_PER_PACKET * F.col("i") + F.col("run_gap")
    return (
        _inside(packets, keys, order, mode)
        # merge: the rows are already shuffled and sorted by (keys, chunk); the size
        # estimate of array columns is too low to let the planner broadcast packets
        .join(carry.hint("merge"), [*keys, CHUNK], "left")
        .where(F.col("ever_open") & (gate.isNull() | (F.col(order) >= gate)))
        .select(
            *packets.columns,
            (F.col("add_packets") + F.col("i") - 1).alias("packet_no"),
            lost.alias("lost"),
            (F.col("add_lost") + F.col("run_lost")).alias("loss_total"),
            (row_end - COLUMNS_PER_PACKET - _gap(lost)).alias("row_start"),
            row_end.alias("row_end"),
            "rows_total",
        )
    )


def end_state(carry: DataFrame, keys=("device", "session")) -> DataFrame:
    """State of every opened session after its last packet, from ``chunk_carry``:
    one row per session with ``last_pos, loss_total, rows_total, packets_total``."""
    return carry.where("ever_open").groupBy(*keys).agg(
        F.max_by("last_pos", CHUNK).cast("int").alias("last_pos"),
        F.max("loss_total").alias("loss_total"),
        F.max("rows_total").alias("rows_total"),
        F.max("packets_total").alias("packets_total"),
    )


def start_gate(packets: DataFrame, keys=("device", "session"), order: str = "seq") -> DataFrame:
    """Packets from each session's first trigger 0 on.

    The gate is one minimum per (session, chunk), so a long session is never
    gathered into one task.
    """
    keys = list(keys)
    return track(packets, keys, order, mode="off").select(*packets.columns)


def deinterleaved(samples="pressure"):
    """Four rows of 24: within a row, every fourth sample follows the one before.

    The places are a literal array; 96 spelled-out elements would make one
    generated method too long for the JVM to compile.
    """

    def row(c):
        places = [c * ROW_WIDTH + (i % 6) * COLUMNS_PER_PACKET + i // 6 for i in range(ROW_WIDTH)]
        return f"transform(array({', '.join(map(str, places))}), p -> get(`{samples}`, p))"

    return F.expr(f"array({', '.join(row(c) for c in range(COLUMNS_PER_PACKET))})")


def packet_rows(packets: DataFrame, keep=("device", "session", "seq")) -> DataFrame:
    """One row per scan column: ``c`` and its 24 de-interleaved samples."""
    return packets.select(*keep, F.posexplode(deinterleaved()).alias("c", "row"))


def lost_row():
    return F.array_repeat(F.lit(LOST_VALUE), ROW_WIDTH)


def frame_rows(tracked: DataFrame, keep=("device", "session", "seq")) -> DataFrame:
    """Gap rows and real rows with their place ``row_idx`` in the session."""
    rows = F.concat(
        F.transform(
            F.array_repeat(F.lit(True), (F.col("row_end") - F.col("row_start") - 4).cast("int")),
            lambda g: F.struct(g.alias("is_gap"), lost_row().alias("row")),
        ),
        F.transform(
            deinterleaved(), lambda r: F.struct(F.lit(False).alias("is_gap"), r.alias("row"))
        ),
    )
    out = tracked.select(*keep, "row_start", F.posexplode(rows).alias("p", "cell"))
    return out.select(
        *keep, (F.col("row_start") + F.col("p")).alias("row_idx"), "cell.is_gap", "cell.row"
    )


def gap_rows(tracked: DataFrame, keep=("device", "session", "seq")) -> DataFrame:
    """Only the rows that stand in for lost packets."""
    return frame_rows(tracked.where("lost > 0"), keep).where("is_gap").drop("is_gap")
