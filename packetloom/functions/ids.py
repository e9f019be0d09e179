"""Entry ids (``ms-seq``), event time and the keys derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

_SEQ_SPAN = "CAST(10000000000000000000 AS DECIMAL(20,0))"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _name(col):
    """SQL text for a column name that may need quoting."""
    return ".".join(f"`{part}`" for part in col.split("."))


def epoch_ms(ts):
    """Milliseconds since 1970 of a zone-less timestamp column, truncated."""
    return F.expr(f"timestampdiff(MILLISECOND, {_EPOCH}, {_name(ts)})")


def id_ms(message_id):
    """Millisecond part of an entry id; null when it is not a number."""
    return F.expr(f"try_cast(split_part({_name(message_id)}, '-', 1) AS BIGINT)")


def id_seq(message_id):
    """Sequence part of an entry id; null when it is not a number."""
    return F.expr(f"try_cast(split_part({_name(message_id)}, '-', 2) AS BIGINT)")


def make_id(ms, seq):
    return F.concat(F.col(ms).cast("string"), F.lit("-"), F.col(seq).cast("string"))


def id_rank(ms="id_ms", seq="id_seq"):
    """One decimal that orders ids by (ms, seq).

    ``max`` over a decimal keeps a fixed-width buffer and so plans as a hash
    aggregate; ``max`` over a struct would sort every map task's input.
    """
    return F.expr(
        f"CAST(CAST({_name(ms)} AS DECIMAL(18,0)) * {_SEQ_SPAN} + {_name(seq)} AS DECIMAL(38,0))"
    )


def rank_to_id(rank):
    """The entry id text behind an ``id_rank`` value."""
    return F.expr(
        f"concat(CAST({_name(rank)} DIV {_SEQ_SPAN} AS STRING), '-',"
        f" CAST(CAST({_name(rank)} % {_SEQ_SPAN} AS DECIMAL(20,0)) AS STRING))"
    )


def event_second(message_id, ingest_second):
    """Whole seconds from the entry id, else the ingestion second."""
    ms = f"try_cast(split_part({_name(message_id)}, '-', 1) AS BIGINT)"
    return F.expr(
        f"coalesce(CASE WHEN contains({_name(message_id)}, '-')"
        f" THEN CAST(floor({ms} / 1000) AS BIGINT) END, {_name(ingest_second)})"
    )


def second_to_local(second, zone="UTC"):
    """Zone-less timestamp of an epoch second in ``zone``; ignores the session zone."""
    ts = f"timestampadd(SECOND, {_name(second)}, {_EPOCH})"
    return F.expr(ts if zone == "UTC" else f"convert_timezone('UTC', '{zone}', {ts})")


def stream_key(device, device_id):
    """``stream:{device}:{device_id}``."""
    return F.concat(F.lit("stream:"), F.col(device), F.lit(":"), F.col(device_id))


def entry_key(device, device_id, char, ms):
    """``{device}-{id}-{char}-{ms}``."""
    return F.concat_ws("-", F.col(device), F.col(device_id), F.col(char), F.col(ms).cast("string"))


def message_key(stream, message_id):
    """``{stream}:{id}``."""
    return F.concat(F.col(stream), F.lit(":"), F.col(message_id))


def business_key(device, ms, seq):
    """``device:ms:NNNN``; numbers wider than four digits are kept whole."""
    return F.format_string("%s:%d:%04d", F.col(device), F.col(ms), F.col(seq))


def business_key_iso(device, ts, seq):
    """``device:<ISO time>:NNNN``; the fraction is left out when it is zero.

    The ISO time holds colons, so ``parse_business_key`` gives null for it.
    """
    t = F.col(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    full = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    iso = F.when(full.endswith(".000000"), whole).otherwise(full)
    return F.format_string("%s:%s:%04d", F.col(device), iso, F.col(seq))


def parse_business_key(key):
    """Struct (device_id, timestamp, sequence), or null when the key is not one."""
    k = _name(key)
    device, ms, seq = (f"split_part({k}, ':', {n})" for n in (1, 2, 3))
    return F.expr(
        f"CASE WHEN size(split({k}, ':', -1)) = 3 AND {device} <> '' AND {seq} <> ''"
        f" AND {ms} RLIKE '^[+-]?[0-9]+$' AND try_cast({ms} AS BIGINT) IS NOT NULL"
        f" THEN named_struct('device_id', {device}, 'timestamp', try_cast({ms} AS BIGINT),"
        f" 'sequence', {seq}) END"
    )


def parse_display_name(name, default_db=0):
    """Struct (db, key) from ``db{n}:{key}``; otherwise (default_db, name).

    The key is one line; a line break at the very end is not part of it.
    """
    n = _name(name)
    db, key = (f"regexp_extract({n}, '^db([0-9]+):([^\\\\n]+)\\\\n?$', {g})" for g in (1, 2))
    return F.expr(
        f"CASE WHEN try_cast({db} AS INT) IS NOT NULL"
        f" THEN named_struct('db', try_cast({db} AS INT), 'key', {key})"
        f" ELSE named_struct('db', {int(default_db)}, 'key', {n}) END"
    )


def display_name(db, key, default_db=None):
    """``db{n}:{key}``; with a default db, its keys stay without prefix."""
    full = F.concat(F.lit("db"), F.col(db).cast("string"), F.lit(":"), F.col(key))
    if default_db is None:
        return full
    return F.when(F.col(db) != default_db, full).otherwise(F.col(key))


def prefixed(key, prefix=""):
    """Key with a target prefix; an empty prefix leaves it unchanged."""
    return F.concat(F.lit(prefix), F.col(key)) if prefix else F.col(key)


def topic_name(stream, base):
    """``base/`` and the stream name with ``:`` turned into ``/``."""
    return F.concat(F.lit(f"{base}/"), F.regexp_replace(F.col(stream), ":", "/"))
