"""Frames of 15 rows, the frame each packet shows, channel series, count batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.payloads import join_samples
from packetloom.operators.ordered import running_number, whole_steps
from packetloom.operators.packets import (
    COLUMNS_PER_PACKET,
    ROW_WIDTH,
    deinterleaved,
    lost_row,
)

FRAME_ROWS = 15
# Samples per released batch and per file dump.
BATCH_SAMPLES = 375
DUMP_SAMPLES = 64


def _placed_rows(tracked, keep):
    """Each packet with its gap and real rows and the frames they touch, one
    record per frame plus, when ``keep`` holds, one record for the packet itself."""
    n_gap = (F.col("row_end") - F.col("row_start") - COLUMNS_PER_PACKET).cast("int")
    first = whole_steps(F.col("row_start"), FRAME_ROWS)
    last = whole_steps(F.col("row_end") - 1, FRAME_ROWS)
    others = [c for c in tracked.columns if c != "pressure"]
    return tracked.select(
        *others,
        last.alias("last_frame"),
        F.concat(F.array_repeat(lost_row(), n_gap), deinterleaved()).alias("all_rows"),
        F.explode(F.sequence(first, F.when(keep, last + 1).otherwise(last))).alias("frame_id"),
    )


def _piece():
    """First row and rows of the part of a packet that lies in ``frame_id``."""
    begin = F.greatest(F.col("frame_id") * FRAME_ROWS, F.col("row_start"))
    skip = (begin - F.col("row_start")).cast("int")
    room = ((F.col("frame_id") + 1) * FRAME_ROWS - begin).cast("int")
    return begin.alias("first_row"), F.slice("all_rows", skip + 1, room).alias("rows")


def frame_pieces(tracked: DataFrame, keys=("device", "session")) -> DataFrame:
    """Each packet's rows cut at frame edges: (keys, frame_id, first_row, rows).

    A packet touches one or two frames, more only when it closes a gap, so far
    fewer records are shuffled than with one record per row.
    """
    cut = _placed_rows(tracked, F.lit(False))
    return cut.select(*keys, "frame_id", "rows_total", *_piece())


def released(frame_id="frame_id", rows_total="rows_total"):
    """A frame is released once a row after its fifteenth has arrived."""
    return F.col(frame_id) < whole_steps(F.col(rows_total) - 1, FRAME_ROWS)


def _whole(pieces):
    """One frame from its collected pieces."""
    return F.flatten(F.sort_array(pieces)["rows"])


def join_pieces(pieces: DataFrame, keys=("device", "session")) -> DataFrame:
    """Pieces to frames; a group never exceeds the 15 rows of one frame."""
    parts = F.collect_list(F.struct("first_row", "rows"))
    return pieces.groupBy(*keys, "frame_id").agg(_whole(parts).alias("frame"))


def assemble(tracked: DataFrame, keys=("device", "session")) -> DataFrame:
    """All released frames: (keys, frame_id, frame 15 x 24)."""
    pieces = frame_pieces(tracked, keys).where(released())
    return join_pieces(pieces, keys)


def shown_frame(rows):
    """Number of the newest frame after ``rows`` rows; -1 before the first."""
    return F.greatest(whole_steps(F.col(rows) - 1, FRAME_ROWS) - 1, F.lit(-1).cast("bigint"))


def _shown_with(tracked, keys, keep):
    keys = list(keys)
    others = [c for c in tracked.columns if c not in ("pressure", *keys)]
    cut = _placed_rows(tracked, keep)
    is_packet = F.col("frame_id") > F.col("last_frame")
    records = cut.where(is_packet | released()).select(
        *keys,
        F.when(is_packet, shown_frame("row_end")).otherwise(F.col("frame_id")).alias("frame_id"),
        F.when(~is_packet, F.struct(*_piece())).alias("piece"),
        F.when(is_packet, F.struct(*others)).alias("packet"),
    )
    frames = records.groupBy(*keys, "frame_id").agg(
        _whole(F.collect_list("piece")).alias("frame"), F.collect_list("packet").alias("packets")
    )
    return frames.select(*keys, "frame_id", "frame", F.explode("packets").alias("p")).select(
        *keys, *[f"p.{c}" for c in others], "frame_id", "frame"
    )


def frame_per_packet(tracked: DataFrame, keys=("device", "session")) -> DataFrame:
    """Every packet with the newest frame it could see; an empty frame before the first.

    Row counts give the frame's number directly, so the packets travel to their
    frame in the same shuffle as the frame's pieces: no join and no second pass
    over the packets. At most four packets show the same frame.
    """
    return _shown_with(tracked, keys, F.lit(True))


def new_frames(tracked: DataFrame, keys=("device", "session")) -> DataFrame:
    """Only the packets that release a frame they are the first to show."""
    return _shown_with(tracked, keys, shown_frame("row_end") > shown_frame("row_start"))


def frame_text(frame="frame"):
    """All samples of a frame in row order as ``"a, b, c"``."""
    return join_samples(F.flatten(F.col(frame)))


def channel_series(tracked: DataFrame, keys=("device", "session")) -> DataFrame:
    """Four series per session: channel = sample position modulo 4.

    A packet adds exactly 24 samples to each channel, so the place in the
    series follows from the packet number and no sample is sorted. One row per
    packet and channel: ``t_idx`` of the first of its ``samples``;
    ``channel_samples`` makes a row of each.
    """
    every = ", ".join(
        f"transform(array({', '.join(str(c + 4 * i) for i in range(ROW_WIDTH))}), p -> get(pressure, p))"
        for c in range(COLUMNS_PER_PACKET)
    )
    return tracked.select(*keys, "packet_no", F.posexplode(F.expr(f"array({every})")).alias("channel", "samples")).select(
        *keys, "channel", (F.col("packet_no") * ROW_WIDTH).alias("t_idx"), "samples"
    )


def channel_samples(series: DataFrame, keys=("device", "session")) -> DataFrame:
    """One row per sample of ``channel_series``: ``t_idx`` and ``v``."""
    return series.select(*keys, "channel", "t_idx", F.posexplode("samples").alias("i", "v")).select(
        *keys, "channel", (F.col("t_idx") + F.col("i")).alias("t_idx"), "v"
    )


def count_batches(samples: DataFrame, keys, order: str, size: int = BATCH_SAMPLES,
                  force_save: bool = False) -> DataFrame:
    """Batches of ``size`` consecutive samples per key: adds ``batch_no``, ``batch_pos``.

    Only full batches are released; ``force_save`` releases the rest as well.
    ``samples`` needs a ``chunk`` column over ``order``.
    """
    out = running_number(samples, keys, order, "_i", total="_n").withColumns(
        {
            "batch_no": whole_steps(F.col("_i"), size),
            "batch_pos": (F.col("_i") % size).cast("int"),
        }
    )
    if not force_save:
        out = out.where(F.col("batch_no") < whole_steps(F.col("_n"), size))
    return out.drop("_i", "_n")


def sample_records(samples: DataFrame, payload: str, arrival: str = "timestamp_python") -> DataFrame:
    """Arrival time, board time, packet counter and one payload column."""
    return samples.select(F.col(arrival).alias("timestamp_python"), "ts_board", "packet_counter", payload)
