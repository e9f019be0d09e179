"""Message payloads: decoding, envelopes, filters, sizes and text forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

# Fixed values that results must share: size limit in bytes, status texts.
MAX_MESSAGE_BYTES = 20_971_520
STATUS_TEXT = {
    0: " command was successful",
    1: " command failed, reason: invalid opcode",
    2: " command failed, reason: invalid arguments",
    3: " command failed, reason: invalid command",
    4: " command failed, reason: invalid argument",
    5: " command failed, reason: command error",
    6: " command failed, reason: invalid state",
}
STATUS_OTHER = "Invalid Status"
# Keys that belong to the store itself, by prefix.
INTERNAL_PREFIXES = ("kafka_sync:", "__", "_:", "stream:", "unsynced_keys_set")
# Default sampling rate by firmware version, and of all others.
RATE_BY_FIRMWARE = {"0.0.0": 100, "0.1.0": 100, "0.2.0": 100, "0.2.100": 100, "0.2.1": 1802, "0.3.0": 6250}
RATE_OTHER = 9091


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def decode_text(raw):
    """Text of a binary column, null where the bytes are not UTF-8."""
    return F.when(F.is_valid_utf8(_c(raw)), F.decode(_c(raw), "UTF-8"))


def decode_fields(data):
    """``map<binary,binary>`` to ``map<string,binary>`` with readable names.

    A name that is not UTF-8 becomes ``field_<hex>``; values stay as they are. Where
    two fields get the same name, the later one stays.
    """

    def add(found, entry):
        k = entry["key"]
        name = F.coalesce(decode_text(k), F.concat(F.lit("field_"), F.lower(F.hex(k))))
        return F.map_concat(F.map_filter(found, lambda n, _: n != name), F.create_map(name, entry["value"]))

    none = F.expr("CAST(map() AS MAP<STRING, BINARY>)")
    return F.when(_c(data).isNotNull(), F.aggregate(F.map_entries(_c(data)), none, add))


def undecodable_fields(data):
    """Names of the fields whose value is not UTF-8 (after ``decode_fields``)."""
    return F.map_keys(F.map_filter(_c(data), lambda _, v: ~F.is_valid_utf8(v)))


def decode_values(data):
    """``map<string,binary>`` to ``map<string,string>``; invalid values become null."""
    return F.transform_values(_c(data), lambda _, v: decode_text(v))


def keyed_envelope(data, stream, message_id, stamp_ms):
    """Fields plus ``_stream``, ``_id`` and ``_timestamp``; the metadata wins.

    Fields and names are texts, the time stamp is a number.
    """
    meta = F.create_map(
        F.lit("_stream"), _c(stream).cast("variant"),
        F.lit("_id"), _c(message_id).cast("variant"),
        F.lit("_timestamp"), _c(stamp_ms).cast("bigint").cast("variant"),
    )
    own = F.map_filter(_c(data), lambda k, _: ~k.isin("_stream", "_id", "_timestamp"))
    return F.to_json(F.map_concat(F.transform_values(own, lambda _, v: v.cast("variant")), meta))


def publish_envelope(stream, message_id, data, stamp):
    """``{stream, id, data, timestamp}`` as JSON."""
    return F.to_json(
        F.struct(
            _c(stream).alias("stream"),
            _c(message_id).alias("id"),
            _c(data).alias("data"),
            _c(stamp).alias("timestamp"),
        )
    )


def field_passes(data, field=None, values=()):
    """Whitelist filter on one field of a map column.

    No field lets everything pass, no values lets nothing pass, and a missing
    field fails.
    """
    if not field:
        return F.lit(True)
    if not values:
        return F.lit(False)
    return F.coalesce(F.element_at(_c(data), field).isin(*values), F.lit(False))


def internal_key(key):
    """True for keys of the store itself; takes a string column."""
    return reduce(lambda a, b: a | b, [_c(key).startswith(p) for p in INTERNAL_PREFIXES])


def as_text(value):
    """Value as text with null as the empty string."""
    return F.coalesce(_c(value).cast("string"), F.lit(""))


def is_live(written_at, ttl_seconds, as_of):
    """Written less than ``ttl`` seconds before ``as_of``; a null ttl never ends.

    All three are columns; the two times are epoch seconds.
    """
    ttl = _c(ttl_seconds)
    return ttl.isNull() | (_c(written_at) + ttl > _c(as_of))


def size_verdict(content, limit=MAX_MESSAGE_BYTES):
    """``empty``, ``too_large`` or ``ok`` from the length in bytes."""
    n = F.octet_length(_c(content))
    return F.when(n.isNull() | (n == 0), "empty").when(n > limit, "too_large").otherwise("ok")


def join_samples(samples):
    """Numbers as ``"1, 2, 3"``."""
    return F.array_join(_c(samples).cast("array<string>"), ", ")


def split_samples(text):
    """The inverse of ``join_samples``."""
    return F.split(_c(text), ", ").cast("array<int>")


def status_text(code):
    """Text of a command status; a null code counts as 0."""
    out = F.lit(STATUS_OTHER)
    c = F.coalesce(_c(code), F.lit(0))
    for value in reversed(STATUS_TEXT):
        out = F.when(c == value, F.lit(STATUS_TEXT[value])).otherwise(out)
    return out


def sampling_rate(firmware):
    """Default sampling rate of a firmware version."""
    out = F.lit(RATE_OTHER)
    for version, rate in RATE_BY_FIRMWARE.items():
        out = F.when(_c(firmware) == version, rate).otherwise(out)
    return out
