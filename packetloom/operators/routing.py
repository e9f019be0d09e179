"""Messages to topics: normalising, validating, filtering, routing, outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.ids import message_key, topic_name
from packetloom.functions.patterns import route
from packetloom.functions.payloads import (
    MAX_MESSAGE_BYTES,
    decode_fields,
    decode_values,
    field_passes,
    keyed_envelope,
    publish_envelope,
    size_verdict,
    undecodable_fields,
)


def list_records(df: DataFrame, items: str, keep=()) -> DataFrame:
    """One text record per list item."""
    return df.select(*keep, F.explode(items).alias("_v")).select(
        *keep, F.col("_v").cast("string").alias("value")
    )


def table_records(df: DataFrame, columns, keep=()) -> DataFrame:
    """One JSON record per row."""
    return df.select(*keep, F.to_json(F.struct(*columns)).alias("value"))


def scalar_records(df: DataFrame, column: str, keep=()) -> DataFrame:
    """One text record per value."""
    return df.select(*keep, F.col(column).cast("string").alias("value"))


def parse_messages(raw: DataFrame, col: str = "raw") -> DataFrame:
    """JSON text to a field map; ``valid`` is false where it is not an object."""
    is_object = F.coalesce(
        (F.try_variant_get(F.try_parse_json(F.col(col)), "$", "map<string,variant>")).isNotNull(),
        F.lit(False),
    )
    return raw.withColumn("valid", is_object).withColumn(
        "data", F.when(F.col("valid"), F.from_json(col, "map<string,string>"))
    )


def invalid_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("valid")).withColumn("reason", F.lit("not an object"))


def size_gate(messages: DataFrame, content: str, limit: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Every message with ``verdict`` ok, empty or too_large."""
    return messages.withColumn("verdict", size_verdict(content, limit))


def keyed_messages(entries: DataFrame, mapping, default_topic: str, stamp_ms: str) -> DataFrame:
    """(topic, key, value) of decoded entries with a ``map<string,string>`` column ``data``."""
    return entries.select(
        route("stream_key", mapping, default_topic).alias("topic"),
        message_key("stream_key", "message_id").alias("key"),
        keyed_envelope("data", "stream_key", "message_id", stamp_ms).alias("value"),
    )


def decode_entries(raw: DataFrame, data: str = "data") -> DataFrame:
    """Decode ``map<binary,binary>`` entries; ``bad_fields`` names undecodable values."""
    named = raw.withColumn(data, decode_fields(data))
    return named.withColumn("bad_fields", undecodable_fields(data)).withColumn(
        "raw_data", F.col(data)
    ).withColumn(data, decode_values(data))


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Fields that cannot be put into JSON: one row each, value as base64."""
    bad = decoded.where(F.size("bad_fields") > 0)
    return bad.select(
        "stream_key", "message_id", F.explode("bad_fields").alias("field"), "raw_data"
    ).select(
        "stream_key", "message_id", "field",
        F.lit("value is not UTF-8").alias("reason"),
        F.base64(F.element_at("raw_data", F.col("field"))).alias("value_base64"),
    )


def deliverable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.size("bad_fields") == 0).drop("bad_fields", "raw_data")


def publish_messages(parsed: DataFrame, base: str, stamp: str, qos: int = 0, retain: bool = False) -> DataFrame:
    """(stream_key, message_id, topic, payload, qos, retain) of valid messages."""
    return parsed.where("valid").select(
        "stream_key", "message_id",
        topic_name("stream_key", base).alias("topic"),
        publish_envelope("stream_key", "message_id", "data", stamp).alias("payload"),
        F.lit(qos).alias("qos"), F.lit(retain).alias("retain"),
    )


def plan_outcomes(parsed: DataFrame, field=None, values=()) -> DataFrame:
    """``outcome`` before sending: invalid, filtered or publish."""
    return parsed.withColumn(
        "outcome",
        F.when(~F.col("valid"), "invalid")
        .when(~field_passes("data", field, values), "filtered")
        .otherwise("publish"),
    )


def settle_outcomes(planned: DataFrame, sent: DataFrame) -> DataFrame:
    """Join what the writer reported (stream_key, message_id, success).

    ``ack`` holds for everything but failed publishes. Reports are reduced to
    one per message first.
    """
    one = sent.groupBy("stream_key", "message_id").agg(F.bool_or("success").alias("success"))
    outcome = F.when(F.col("outcome") != "publish", F.col("outcome")).otherwise(
        F.when(F.col("success"), "published").otherwise("failed")
    )
    joined = planned.join(one, ["stream_key", "message_id"], "left")
    return joined.withColumn("outcome", outcome).drop("success").withColumn(
        "ack", F.col("outcome") != "failed"
    )


def outcome_counts(settled: DataFrame, by=()) -> DataFrame:
    return settled.groupBy(*by, "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("ack").alias("acked")
    )
