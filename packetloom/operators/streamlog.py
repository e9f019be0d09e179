"""Reads, deduplication, statistics and replication of append-only stream logs.

A log row has ``stream_key``, ``message_id``, its numeric parts ``id_ms`` and
``id_seq``, ``arrival`` (unique, rising) and payload columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.functions.ids import (
    business_key,
    event_second,
    entry_key,
    id_ms,
    id_rank,
    id_seq,
    prefixed,
    rank_to_id,
    second_to_local,
    stream_key,
)
from packetloom.operators.ordered import first_n, running_number

# Default read window and poll size.
DEFAULT_WINDOW_MS = 8_640_000
POLL_COUNT = 100
MINUTE_MS = 60_000
# What stands in for missing parts of a record.
NO_DEVICE, NO_DEVICE_ID, UNKNOWN = "undefined", "0000", "unknown"
ID = ["id_ms", "id_seq"]


def with_id_parts(log: DataFrame, message_id: str = "message_id") -> DataFrame:
    """Add numeric ``id_ms`` and ``id_seq``; store them so that filters push down."""
    return log.withColumns({"id_ms": id_ms(message_id), "id_seq": id_seq(message_id)})


def range_scan(log: DataFrame, key: str | None = None, start_ms: int | None = None,
               end_ms: int | None = None, char: str | None = None,
               now_ms: int | None = None) -> DataFrame:
    """Entries with ``start_ms <= id_ms <= end_ms`` of one stream (or of all).

    Both bounds have their own default: the end is ``now_ms`` (no bound when it
    is not given), the start lies ``DEFAULT_WINDOW_MS`` before the end. The
    conditions are plain comparisons and reach the parquet scan.
    """
    end_ms = now_ms if end_ms is None else end_ms
    if start_ms is None and end_ms is not None:
        start_ms = end_ms - DEFAULT_WINDOW_MS
    out = log if key is None else log.where(F.col("stream_key") == key)
    if start_ms is not None:
        out = out.where(F.col("id_ms") >= start_ms)
    if end_ms is not None:
        out = out.where(F.col("id_ms") <= end_ms)
    return char_filter(out, char)


def char_filter(log: DataFrame, char: str | None = None) -> DataFrame:
    """One characteristic, or every row when none is given."""
    return log if char is None else log.where(F.col("characteristic") == char)


def positions(log: DataFrame) -> DataFrame:
    """Newest position of every stream: (stream_key, at)."""
    return log.groupBy("stream_key").agg(F.max(id_rank()).alias("at"))


def tail_from(log: DataFrame, at: DataFrame, char: str | None = None) -> DataFrame:
    """Entries strictly after each stream's position; new streams from their start.

    ``log`` may be a stream; ``streaming.runs.start_positions`` gives its ``at``.
    """
    rows = char_filter(log, char).join(at, "stream_key", "left")
    return rows.where(F.col("at").isNull() | (id_rank() > F.col("at"))).drop("at")


def stream_keys(pairs: DataFrame, device: str = "device", device_id: str = "device_id") -> DataFrame:
    """``stream:{device}:{id}`` per pair; two lists are zipped like for like.

    A list of one length with a list of another keeps the shorter length; a
    list with a single value is an error.
    """
    kinds = dict(pairs.dtypes)
    lists = [kinds[c].startswith("array") for c in (device, device_id)]
    if lists[0] != lists[1]:
        raise ValueError("device and device_id must both be lists or both be single values")
    if lists[0]:
        n = F.least(F.size(device), F.size(device_id))
        zipped = F.slice(F.arrays_zip(F.col(device).alias("d"), F.col(device_id).alias("i")), F.lit(1), n)
        pairs = pairs.select(F.explode(zipped).alias("p")).select(
            F.col("p.d").alias(device), F.col("p.i").alias(device_id)
        )
    return pairs.withColumn("stream_key", stream_key(device, device_id))


def log_records(values: DataFrame, device="device", device_id="device_id", char="char",
                ms="timestamp_ms") -> DataFrame:
    """The six log fields of a value plus its stream key; missing parts get defaults."""
    full = values.withColumns(
        {
            device: F.coalesce(F.col(device), F.lit(NO_DEVICE)),
            device_id: F.coalesce(F.col(device_id), F.lit(NO_DEVICE_ID)),
            char: F.coalesce(F.col(char), F.lit(UNKNOWN)),
            "uid": F.coalesce(F.col("uid"), F.lit(UNKNOWN)),
            "nn": F.coalesce(F.col("nn"), F.lit(UNKNOWN)),
        }
    )
    return full.select(
        stream_key(device, device_id).alias("stream_key"),
        F.col(char).alias("characteristic"),
        F.col(ms).cast("string").alias("timestamp"),
        F.col("value").cast("string").alias("value"),
        entry_key(device, device_id, char, ms).alias("key"),
        "uid",
        "nn",
    )


def bounded_batch(log: DataFrame, count: int = POLL_COUNT) -> DataFrame:
    """The first ``count`` entries of every stream in id order."""
    return first_n(log, ["stream_key"], ID, count, width=MINUTE_MS)


def trim_newest(log: DataFrame, count: int) -> DataFrame:
    """The newest ``count`` entries of every stream."""
    return first_n(log, ["stream_key"], ID, count, newest=True, width=MINUTE_MS)


def group_read(log: DataFrame, deliveries: DataFrame, group: str, count: int = POLL_COUNT) -> DataFrame:
    """Entries never delivered to the group, at most ``count`` per stream."""
    seen = deliveries.where(F.col("grp") == group).select("stream_key", "message_id").distinct()
    return bounded_batch(log.join(seen, ["stream_key", "message_id"], "left_anti"), count)


def group_read_position(log: DataFrame, last: DataFrame, group: str, count: int = POLL_COUNT) -> DataFrame:
    """Entries after the group's last delivered id, at most ``count`` per stream.

    ``last`` has one row per (stream_key, grp) with ``last_delivered_id``, as
    ``health.group_stats`` gives; a stream without one is read from its start. No
    delivery history is read or joined.
    """
    at = with_id_parts(last.where(F.col("grp") == group), "last_delivered_id").select(
        "stream_key", id_rank().alias("at")
    )
    return bounded_batch(tail_from(log, at), count)


def latest_id(log: DataFrame) -> DataFrame:
    """Newest message id per stream, by number and not by text."""
    return positions(log).select("stream_key", rank_to_id("at").alias("message_id"))


def without_init_rows(log: DataFrame, data: str = "data") -> DataFrame:
    """Drop the ``{init: init}`` rows that only create a stream."""
    d = F.col(data)
    init = (F.size(d) == 1) & (F.element_at(d, "init") == "init")
    return log.where(~F.coalesce(init, F.lit(False)))


def stream_table_rows(log: DataFrame, ingest_second: str = "ingest_second", zone: str = "UTC") -> DataFrame:
    """Add ``unix_timestamp`` (zone-less, whole seconds) and ``streaming_date``."""
    out = log.withColumn("event_second", event_second("message_id", ingest_second))
    out = out.withColumn("unix_timestamp", second_to_local("event_second", zone))
    return out.withColumn("streaming_date", F.col("unix_timestamp").cast("date"))


CONFLICT_KEY = ["stream_key", "message_id", "streaming_date"]


def _one_per_key(rows, keys, order):
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_first(rows: DataFrame, keys=tuple(CONFLICT_KEY), table: DataFrame | None = None,
               arrival: str = "arrival") -> DataFrame:
    """First arrival per key; rows whose key the table already holds are left out.

    The rank limit is applied in each map task first, so a key with very many
    copies sends one row per task.
    """
    first = _one_per_key(rows, keys, F.col(arrival))
    if table is None:
        return first
    return first.join(table.select(*keys).distinct(), list(keys), "left_anti")


def keep_last(rows: DataFrame, keys=tuple(CONFLICT_KEY), arrival: str = "arrival") -> DataFrame:
    """Last arrival per key."""
    return _one_per_key(rows, keys, F.col(arrival).desc())


def replicate(source: DataFrame, target: DataFrame, prefix: str = "") -> DataFrame:
    """Source entries missing in the target, under the target key and the same id.

    Entries without an id cannot be found again and are left out;
    ``replicate_outcomes`` lists them as failed.
    """
    rows = source.where(F.col("message_id").isNotNull()).withColumn("stream_key", prefixed("stream_key", prefix))
    held = target.select("stream_key", "message_id").distinct()
    return rows.join(held, ["stream_key", "message_id"], "left_anti")


def replicate_outcomes(source: DataFrame, target: DataFrame, prefix: str = "") -> DataFrame:
    """Every source entry tagged ``synced`` (new), ``skipped`` (held) or ``failed`` (no id)."""
    rows = source.withColumn("stream_key", prefixed("stream_key", prefix))
    held = target.select("stream_key", "message_id").distinct().withColumn("held", F.lit(True))
    # rows without an id match nothing and would all meet in one task of the join
    whole = rows.where(F.col("message_id").isNotNull()).join(
        held, ["stream_key", "message_id"], "left"
    )
    tagged = whole.withColumn("outcome", F.when(F.col("held"), "skipped").otherwise("synced"))
    lost = rows.where(F.col("message_id").isNull()).withColumn("outcome", F.lit("failed"))
    return tagged.drop("held").unionByName(lost)


def replication_counts(outcomes: DataFrame, by=("stream_key",)) -> DataFrame:
    return outcomes.groupBy(*by).agg(
        *[
            F.count_if(F.col("outcome") == name).alias(name)
            for name in ("synced", "failed", "skipped")
        ]
    )


def sequence_numbers(rows: DataFrame, device: str, order: str) -> DataFrame:
    """1-based number per device in arrival order; needs a ``chunk`` column."""
    return running_number(rows, [device], order, "sequence").withColumn(
        "sequence", F.col("sequence") + 1
    )


def with_business_key(rows: DataFrame, device: str, ms: str, order: str) -> DataFrame:
    """Sequence number and ``device:ms:NNNN`` key; unique even within one millisecond."""
    return sequence_numbers(rows, device, order).withColumn(
        "business_key", business_key(device, ms, "sequence")
    )


def stream_stats(log: DataFrame) -> DataFrame:
    """Length, first id and last id of every stream, in one hash aggregation."""
    return (
        log.groupBy("stream_key")
        .agg(
            F.count(F.lit(1)).alias("length"),
            F.min(id_rank()).alias("lo"),
            F.max(id_rank()).alias("hi"),
        )
        .select(
            "stream_key", "length",
            rank_to_id("lo").alias("first_id"), rank_to_id("hi").alias("last_id"),
        )
    )


def with_empty(stats: DataFrame, existing: DataFrame) -> DataFrame:
    """Statistics of every existing stream; one without entries has length 0."""
    return existing.select("stream_key").distinct().join(stats, "stream_key", "left").fillna(0, ["length"])


def remaining(log: DataFrame, processed: DataFrame) -> DataFrame:
    """Entries not yet processed: what stays once processed entries are deleted."""
    done = processed.select("stream_key", "message_id").distinct()
    return log.join(done, ["stream_key", "message_id"], "left_anti")
