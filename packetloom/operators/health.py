"""Stream and consumer-group statistics, health status and reports.

``deliveries``: stream_key, grp, consumer, id_ms, id_seq, message_id.
``acks``: stream_key, grp, message_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.ids import id_rank, rank_to_id

# More pending entries than this degrade a stream; texts of the reports.
PENDING_LIMIT = 100
ABSENT = "Stream does not exist"
EMPTY = "Stream is empty"
NO_CONSUMERS = "Consumer group '%s' has no consumers"
HIGH_PENDING = "Consumer group '%s' has high pending count: %d"
VALID_EMPTY = "Stream exists but is empty"
VALID = "Stream is valid"
GROUP = ["stream_key", "grp"]


def pending(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Delivered entries without an acknowledgement."""
    return deliveries.join(
        acks.select(*GROUP, "message_id").distinct(), [*GROUP, "message_id"], "left_anti"
    )


def ack_counts(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Acknowledged entries per group; an entry acknowledged twice counts once."""
    done = deliveries.select(*GROUP, "message_id").join(
        acks.select(*GROUP, "message_id").distinct(), [*GROUP, "message_id"], "left_semi"
    )
    return done.distinct().groupBy(*GROUP).agg(F.count(F.lit(1)).alias("acked"))


def consumer_stats(deliveries: DataFrame) -> DataFrame:
    """One row per consumer: entries delivered, entries pending (column ``acked``)."""
    return deliveries.groupBy(*GROUP, "consumer").agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(~F.col("acked")).alias("pending"),
        F.max(id_rank()).alias("hi"),
    )


def group_stats(deliveries: DataFrame, groups: DataFrame | None = None,
                consumers: DataFrame | None = None) -> DataFrame:
    """Pending, consumer count and last delivered id per group.

    ``groups`` (stream_key, grp) are the registered groups: each gets a row, also
    one that nothing was delivered to, and no other group does. ``consumers``
    (stream_key, grp, consumer) are the registered consumers, which are then
    counted. Without them, groups and consumers are those seen in deliveries.
    Built on ``consumer_stats``: one shuffle brings at most one row per consumer
    and map task, and the distinct count needs no pass of its own.
    """
    seen = _seen_groups(deliveries)
    if groups is not None:
        seen = groups.select(*GROUP).distinct().join(seen, GROUP, "left")
    if consumers is not None:
        listed = consumers.select(*GROUP, "consumer").distinct().groupBy(*GROUP)
        listed = listed.agg(F.count(F.lit(1)).alias("listed"))
        seen = seen.join(listed, GROUP, "left").withColumn("consumers", F.col("listed"))
    return seen.fillna(0, ["pending", "consumers"]).select(
        *GROUP, "pending", "consumers", "last_delivered_id"
    )


def _seen_groups(deliveries):
    return (
        consumer_stats(deliveries)
        .groupBy(*GROUP)
        .agg(
            F.sum("pending").alias("pending"),
            F.count(F.lit(1)).alias("consumers"),
            F.max("hi").alias("hi"),
        )
        .withColumn("last_delivered_id", rank_to_id("hi"))
        .drop("hi")
    )


def group_issues(groups: DataFrame) -> DataFrame:
    """One row per problem of a group: (stream_key, grp, issue)."""
    problems = F.array_compact(
        F.array(
            F.when(F.col("consumers") == 0, F.format_string(NO_CONSUMERS, "grp")),
            F.when(
                F.col("pending") > PENDING_LIMIT, F.format_string(HIGH_PENDING, "grp", "pending")
            ),
        )
    )
    return groups.select(*GROUP, F.explode(problems).alias("issue"))


def stream_health(configured: DataFrame, stats: DataFrame, groups: DataFrame) -> DataFrame:
    """Status per configured stream with its issue count.

    ``stats`` has one row per existing stream (length 0 when empty), ``groups``
    one row per group. Issue texts are in ``stream_issues``, one row each, so
    that a stream with very many groups needs no long list.
    """
    per_stream = groups.groupBy("stream_key").agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("consumers") == 0).alias("idle_groups"),
        F.count_if(F.col("pending") > PENDING_LIMIT).alias("late_groups"),
    )
    joined = (
        configured.select("stream_key").distinct()
        .join(stats.select("stream_key", "length"), "stream_key", "left")
        .join(per_stream, "stream_key", "left")
        .fillna(0, ["groups", "idle_groups", "late_groups"])
    )
    missing = F.col("length").isNull()
    empty = F.col("length") == 0
    issues = F.col("idle_groups") + F.col("late_groups") + F.when(empty, 1).otherwise(0)
    status = (
        F.when(missing, "NOT_FOUND")
        .when(issues == 0, "HEALTHY")
        .when(F.col("idle_groups") > 0, "WARNING")
        .when(F.col("late_groups") > 0, "DEGRADED")
        .otherwise("WARNING")
    )
    return joined.select(
        "stream_key", "length", "groups", status.alias("status"),
        F.when(missing, F.lit(1)).otherwise(issues).alias("issues"),
    )


def stream_issues(configured: DataFrame, stats: DataFrame, groups: DataFrame) -> DataFrame:
    """Every issue of the configured streams: (stream_key, grp, issue)."""
    known = configured.select("stream_key").distinct().join(
        stats.select("stream_key", "length"), "stream_key", "left"
    )
    own = known.select(
        "stream_key", F.lit(None).cast("string").alias("grp"),
        F.when(F.col("length").isNull(), ABSENT)
        .when(F.col("length") == 0, EMPTY).alias("issue"),
    ).where("issue IS NOT NULL")
    found = known.where("length IS NOT NULL").select("stream_key")
    return own.unionByName(group_issues(groups).join(found, "stream_key", "left_semi"))


def health_report(health: DataFrame, groups: DataFrame) -> DataFrame:
    """The printed summary as rows: one line per stream and one per group."""
    stream_line = health.select(
        "stream_key", F.lit(0).alias("line"),
        F.format_string(
            "Stream: %s | Status: %s | Length: %d | Consumer Groups: %d",
            "stream_key", "status", F.coalesce("length", F.lit(0)), "groups",
        ).alias("text"),
    )
    group_line = groups.join(health.select("stream_key"), "stream_key", "left_semi").select(
        "stream_key", F.lit(1).alias("line"),
        F.format_string(
            "  Group: %s | Consumers: %d | Pending: %d", "grp", "consumers", "pending"
        ).alias("text"),
    )
    return stream_line.unionByName(group_line)


def validate_streams(requested: DataFrame, stats: DataFrame, groups: DataFrame) -> DataFrame:
    """Validity, reason, length, ids and group count of each requested stream.

    The group details are the rows of ``group_stats``.
    """
    counts = groups.groupBy("stream_key").agg(F.count(F.lit(1)).alias("group_count"))
    joined = (
        requested.select("stream_key").distinct()
        .join(stats, "stream_key", "left")
        .join(counts, "stream_key", "left")
    )
    missing, empty = F.col("length").isNull(), F.col("length") == 0
    filled = ~(missing | empty)
    return joined.select(
        "stream_key",
        (~missing).alias("is_valid"),
        F.when(missing, ABSENT).when(empty, VALID_EMPTY).otherwise(VALID).alias("reason"),
        "length",
        F.when(filled, F.col("first_id")).alias("first_id"),
        F.when(filled, F.col("last_id")).alias("last_id"),
        F.when(filled, F.coalesce("group_count", F.lit(0))).alias("group_count"),
    )


def run_metrics(entries: DataFrame, key_values: DataFrame) -> DataFrame:
    """Counts of one run: messages, errors (column ``ok``), streams, newest id, key-values."""
    from_log = entries.agg(
        F.count_if("ok").alias("messages_synced"),
        F.count_if(~F.col("ok")).alias("errors"),
        F.max("id_ms").alias("last_sync_ms"),
    )
    # approximate counts would differ between runs, so streams are counted from groups
    streams = entries.groupBy("stream_key").agg(F.lit(1).alias("one")).agg(
        F.count("one").alias("discovered_streams")
    )
    pairs = key_values.agg(F.count(F.lit(1)).alias("key_values_synced"))

    def long(df):
        return df.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in df.columns])
            ).alias("m")
        ).select("m.metric", "m.value")

    return long(from_log).unionByName(long(streams)).unionByName(long(pairs))


def observed(df: DataFrame, observation, ok: str = "ok") -> DataFrame:
    """The same rows with counters that fill while they are written: no extra pass."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col(ok)).alias("errors"),
    )
