"""Little-endian bytes to numbers."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

# Workers get these functions with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def byte_at(raw, pos):
    """Unsigned byte at a 0-based position (int or column); null past the end."""
    start = pos + 1 if isinstance(pos, int) else (pos + 1).cast("int")
    start = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.hex(F.substring(_c(raw), start, F.lit(1))), 16, 10).cast("int")


def uint16_at(raw, pos):
    return byte_at(raw, pos) + byte_at(raw, pos + 1) * 256


def int16_list(raw, first, count):
    """Up to ``count`` signed 16-bit little-endian numbers from byte ``first`` on.

    A shorter payload gives a shorter list; a trailing odd byte is not a number.
    Works on the bytes of a whole Arrow batch at once: the same job in nested
    ``transform`` calls builds text for every number.
    """

    @F.arrow_udf("array<int>")
    def unpack(payloads: pa.Array) -> pa.Array:
        payloads = payloads.cast(pa.large_binary())
        _, offset_bytes, data_bytes = payloads.buffers()
        ends = np.frombuffer(offset_bytes, np.int64)[payloads.offset:][: len(payloads) + 1]
        data = np.frombuffer(data_bytes or b"", np.uint8)
        n = np.clip((np.diff(ends) - first) // 2, 0, count)
        stops = np.concatenate(([0], np.cumsum(n)))
        # byte place of every number: row start + 2 * place within the row
        at = np.repeat(ends[:-1] + first - 2 * stops[:-1], n) + 2 * np.arange(stops[-1])
        numbers = (data[at] | (data[at + 1].astype(np.uint16) << 8)).astype(np.uint16)
        values = numbers.view(np.int16).astype(np.int32)
        mask = pa.array(~np.asarray(payloads.is_valid()))
        return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values), mask=mask)

    return unpack(_c(raw))


def float32_at(raw, pos):
    """IEEE single precision value of four little-endian bytes, as a double."""
    b = [byte_at(raw, pos + k) for k in range(4)]
    fraction = (F.pmod(b[2], F.lit(128)) * 65536 + b[1] * 256 + b[0]).cast("double")
    exponent = F.pmod(b[3], F.lit(128)) * 2 + F.floor(b[2] / 128)
    sign = F.when(b[3] >= 128, -1.0).otherwise(1.0)
    span = F.lit(8388608.0)
    return (
        F.when((exponent == 255) & (fraction > 0), F.lit(float("nan")))
        .when(exponent == 255, sign * F.lit(float("inf")))
        .when(exponent == 0, sign * fraction / span * F.pow(F.lit(2.0), F.lit(-126.0)))
        .otherwise(sign * (1 + fraction / span) * F.pow(F.lit(2.0), (exponent - 127).cast("double")))
    )


def firmware_version(raw):
    """``b0.b1.b2`` of a module info payload."""
    return F.concat_ws(".", *[byte_at(raw, k).cast("string") for k in range(3)])


def battery_level(raw):
    """``b7%`` of a module info payload."""
    return F.concat(byte_at(raw, 7).cast("string"), F.lit("%"))
