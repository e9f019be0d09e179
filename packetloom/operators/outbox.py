"""Cache-then-send bookkeeping: which content still has no live sync marker.

``content``: key, written_at (epoch seconds), ttl_s, value columns.
``markers``: key, marked_at (epoch seconds), ttl_s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.payloads import decode_text, internal_key, is_live

# Fixed value: default life of content and markers in seconds.
DEFAULT_TTL_S = 3600


def live(rows: DataFrame, written_at: str, as_of) -> DataFrame:
    """Rows that have not expired at ``as_of`` (epoch seconds, value or column)."""
    when = as_of if hasattr(as_of, "isNull") else F.lit(as_of)
    return rows.where(is_live(written_at, "ttl_s", when))


def text_keys(rows: DataFrame, raw: str = "key") -> DataFrame:
    """Binary keys as text; keys that are not UTF-8 are left out."""
    return rows.withColumn(raw, decode_text(raw)).where(F.col(raw).isNotNull())


def user_content(content: DataFrame) -> DataFrame:
    """Content without the store's own keys."""
    return content.where(~internal_key("key"))


def unsynced(content: DataFrame, markers: DataFrame, as_of) -> DataFrame:
    """Live content without a live marker.

    Markers are reduced to one row per key before the join, so a key that was
    marked very often costs one row.
    """
    marked = live(markers, "marked_at", as_of).select("key").distinct()
    return user_content(live(content, "written_at", as_of)).join(marked, "key", "left_anti")


def synced_flag(content: DataFrame, markers: DataFrame, as_of) -> DataFrame:
    """Live content with ``is_synced``."""
    marked = live(markers, "marked_at", as_of).select("key").distinct().withColumn("m", F.lit(True))
    out = user_content(live(content, "written_at", as_of)).join(marked, "key", "left")
    return out.withColumn("is_synced", F.coalesce("m", F.lit(False))).drop("m")


def position_index(sent: DataFrame) -> DataFrame:
    """``kafka_index:{topic}:{partition}:{offset}`` → key, for messages with a device id.

    Without a device id the position text itself is the content key.
    """
    place = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return sent.withColumns(
        {
            "index_key": F.when(
                F.col("device_id").isNotNull(), F.concat(F.lit("kafka_index:"), place)
            ),
            "content_key": F.when(F.col("device_id").isNotNull(), F.col("key")).otherwise(place),
        }
    )


def position_lookup(requests: DataFrame, index: DataFrame, content: DataFrame) -> DataFrame:
    """(topic, partition, offset) → key → cached value; null where one is missing.

    ``index`` holds one row per position and ``content`` one per key.
    """
    at = ["topic", "partition", "offset"]
    found = requests.join(index.select(*at, F.col("content_key").alias("key")), at, "left")
    return found.join(content.select("key", "value"), "key", "left")


def cached_or_own(messages: DataFrame, cache: DataFrame) -> DataFrame:
    """The cached value of each message's key, else the message's own value.

    ``cache`` holds one row per key.
    """
    c = cache.select("key", F.col("value").alias("cached"), F.lit(True).alias("found"))
    out = messages.join(c, "key", "left")
    return out.withColumns(
        {"value": F.coalesce("cached", "value"), "hit": F.coalesce("found", F.lit(False))}
    ).drop("cached", "found")


def sync_counts(attempted: DataFrame) -> DataFrame:
    """Rows attempted and acknowledged (column ``acked``)."""
    return attempted.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if("acked").alias("synced")
    )


def new_markers(attempted: DataFrame, marked_at, ttl_s=DEFAULT_TTL_S) -> DataFrame:
    """Markers for the acknowledged rows."""
    return attempted.where("acked").select(
        "key", F.lit(marked_at).cast("bigint").alias("marked_at"),
        F.lit(ttl_s).cast("bigint").alias("ttl_s"),
    )
