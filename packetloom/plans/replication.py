"""Queries over stream logs, key-values and the outbox."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import ids
from packetloom.operators import health, intervals, keyvalues, outbox, streamlog
from packetloom.operators.ordered import first_n, with_chunk, with_hot_chunks
from packetloom.plans import views
from packetloom.plans.registry import query
from packetloom.plans.views import table, with_sql
from packetloom.session import shared_folder
from packetloom.sources import keptstats, stores

LOG = with_sql("stream_log")
REPLAY = with_sql("stream_log", "replayed_log")
# Fixed instants inside the events' month (UTC milliseconds).
FROM_MS, TO_MS, NOW_MS = 1_704_153_600_000, 1_704_931_200_000, 1_704_500_000_000
ENTRY = ["stream_key", "message_id", "value_cents"]


@query(LOG + f""" SELECT stream_key, message_id, characteristic, value_cents FROM stream_log
WHERE id_ms BETWEEN {FROM_MS} AND {TO_MS}""")
def range_scan(spark, sf_dir):
    out = streamlog.range_scan(views.stream_log(spark, sf_dir), start_ms=FROM_MS, end_ms=TO_MS)
    return out.select("stream_key", "message_id", "characteristic", "value_cents")


@query(LOG + f""" SELECT stream_key, message_id, value_cents FROM stream_log
WHERE id_ms BETWEEN {NOW_MS - 8_640_000} AND {NOW_MS}""")
def range_scan_default(spark, sf_dir):
    return streamlog.range_scan(views.stream_log(spark, sf_dir), now_ms=NOW_MS).select(*ENTRY)


@query(LOG + " SELECT stream_key, message_id, value_cents FROM stream_log WHERE characteristic = 'click'")
def char_filter(spark, sf_dir):
    return streamlog.char_filter(views.stream_log(spark, sf_dir), "click").select(*ENTRY)


@query(LOG + f""", newest AS (SELECT stream_key, max(id_seq) AS seq FROM stream_log
  WHERE id_ms <= {NOW_MS} GROUP BY ALL)
SELECT l.stream_key, message_id, value_cents FROM stream_log l LEFT JOIN newest USING (stream_key)
WHERE newest.seq IS NULL OR l.id_seq > newest.seq""")
def tail_from(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    at = streamlog.positions(log.where(F.col("id_ms") <= NOW_MS))
    return streamlog.tail_from(log, at).select(*ENTRY)


@query("""SELECT DISTINCT 'stream:' || event_type || ':' || u AS stream_key
FROM (SELECT event_type, unnest([user_id, user_id + 1000]) AS u FROM events)""")
def stream_keys(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(
        F.array("event_type", "event_type").alias("device"),
        F.array(F.col("user_id").cast("string"), (F.col("user_id") + 1000).cast("string")).alias(
            "device_id"
        ),
    )
    return streamlog.stream_keys(pairs).select("stream_key").distinct()


@query("""SELECT 'stream:' || device || ':' || id AS stream_key, char AS characteristic,
  ms || '' AS timestamp, value, device || '-' || id || '-' || char || '-' || ms AS key, uid, nn
FROM (SELECT CASE WHEN user_id % 5 = 0 THEN 'undefined' ELSE 'insole' END AS device,
             CASE WHEN user_id % 7 = 0 THEN '0000' ELSE user_id || '' END AS id,
             CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE event_type END AS char,
             CAST(round(value * 100) AS BIGINT) || '' AS value, epoch_us(ts) // 1000 AS ms,
             CASE WHEN user_id % 2 = 0 THEN 'unknown' ELSE 'u' || user_id END AS uid,
             CASE WHEN user_id % 3 = 0 THEN 'unknown' ELSE 'n' || user_id END AS nn FROM events)""")
def log_records(spark, sf_dir):
    u = F.col("user_id")
    text = u.cast("string")
    values = table(spark, sf_dir, "events").select(
        F.when(u % 5 != 0, "insole").alias("device"),
        F.when(u % 7 != 0, text).alias("device_id"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("char"),
        views.cents("value").alias("value"), views.epoch_ms("ts").alias("timestamp_ms"),
        F.when(u % 2 != 0, F.concat(F.lit("u"), text)).alias("uid"),
        F.when(u % 3 != 0, F.concat(F.lit("n"), text)).alias("nn"),
    )
    return streamlog.log_records(values)


@query(LOG + """ SELECT stream_key, message_id, value_cents FROM (SELECT *,
  row_number() OVER (PARTITION BY stream_key ORDER BY id_ms, id_seq) AS rn FROM stream_log)
WHERE rn <= 10""")
def bounded_batch(spark, sf_dir):
    return streamlog.bounded_batch(views.stream_log(spark, sf_dir), 10).select(*ENTRY)


@query(LOG + """ SELECT stream_key, message_id, value_cents FROM (SELECT *,
  row_number() OVER (PARTITION BY stream_key ORDER BY id_ms DESC, id_seq DESC) AS rn FROM stream_log)
WHERE rn <= 5""")
def trim_newest(spark, sf_dir):
    return streamlog.trim_newest(views.stream_log(spark, sf_dir), 5).select(*ENTRY)


@query("""SELECT event_type, event_id FROM (SELECT event_type, event_id,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
WHERE rn <= 1500""")
def trim_newest_many(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", "event_id")
    return first_n(e, ["event_type"], "event_id", 1500, newest=True, width=4096)


@query(LOG + """, seen AS (SELECT stream_key, message_id FROM stream_log WHERE arrival % 3 = 0)
SELECT stream_key, message_id, value_cents FROM (SELECT l.*,
  row_number() OVER (PARTITION BY l.stream_key ORDER BY id_ms, id_seq) AS rn
  FROM stream_log l ANTI JOIN seen s USING (stream_key, message_id)) WHERE rn <= 10""")
def group_read_batch(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    delivered = log.where("arrival % 3 = 0").withColumn("grp", F.lit("sync"))
    return streamlog.group_read(log, delivered, "sync", 10).select(*ENTRY)


@query(LOG + """, last AS (SELECT stream_key, max(CAST(id_ms AS HUGEINT) * 1000000000000 + id_seq) AS reached
  FROM stream_log WHERE arrival % 3 = 0 AND user_id % 4 > 0 GROUP BY ALL)
SELECT stream_key, message_id, value_cents FROM (SELECT l.*, row_number() OVER (PARTITION BY l.stream_key ORDER BY id_ms, id_seq) AS rn
  FROM stream_log l LEFT JOIN last USING (stream_key) WHERE reached IS NULL OR CAST(id_ms AS HUGEINT) * 1000000000000 + id_seq > reached)
WHERE rn <= 300""")
def group_read_position(spark, sf_dir):
    """Streams of every fourth user were never read by the group."""
    log = views.stream_log(spark, sf_dir)
    delivered = log.where("arrival % 3 = 0 AND user_id % 4 > 0").select(
        "stream_key", F.lit("sync").alias("grp"), F.lit("c").alias("consumer"), "id_ms", "id_seq", F.lit(True).alias("acked")
    )
    other = delivered.withColumn("grp", F.lit("other")).withColumn("id_ms", F.col("id_ms") * 2)
    last = health.group_stats(delivered.unionByName(other))
    return streamlog.group_read_position(log, last, "sync", 300).select(*ENTRY)


@query(LOG + """ SELECT stream_key, arg_max(message_id, CAST(id_ms AS HUGEINT) * 1000000000000 + id_seq) AS message_id
FROM stream_log GROUP BY ALL""")
def latest_id(spark, sf_dir):
    return streamlog.latest_id(views.stream_log(spark, sf_dir))


@query("""SELECT event_id, n AS sequence, event_type || ':' || ms || ':' || printf('%04d', n) AS business_key
FROM (SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms,
             row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)""")
def seq_per_device(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", views.epoch_ms("ts").alias("ms"))
    out = streamlog.with_business_key(
        with_hot_chunks(e, ["event_type"], "event_id"), "event_type", "ms", "event_id"
    )
    return out.select("event_id", "sequence", "business_key")


@query("""SELECT conv_id, turn, n AS sequence, 'conv' || conv_id || ':' || turn || ':' || printf('%04d', n) AS business_key
FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)""")
def seq_per_conversation(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    c = c.withColumn("device", F.concat(F.lit("conv"), F.col("conv_id").cast("string")))
    out = streamlog.with_business_key(with_chunk(c, "turn"), "device", "turn", "turn")
    return out.select("conv_id", "turn", "sequence", "business_key")


@query("""SELECT event_id, event_type || '-' || user_id || '-press-' || epoch_us(ts) // 1000 AS entry_key,
  'stream:' || event_type || ':' || user_id AS stream_key,
  'stream:' || event_type || ':' || user_id || ':' || epoch_us(ts) // 1000 || '-' || event_id AS message_key,
  event_type || ':' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
    || ':' || printf('%04d', event_id) AS iso_key FROM events""")
def key_build(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("user_id").cast("string").alias("user"), "ts",
        views.epoch_ms("ts").alias("ms"), F.lit("press").alias("char"),
    )
    e = e.withColumn("stream_key", ids.stream_key("event_type", "user"))
    e = e.withColumn("event_text", F.col("event_id").cast("string"))
    e = e.withColumn("message_id", ids.make_id("ms", "event_id"))
    return e.select(
        "event_id", ids.entry_key("event_type", "user", "char", "ms").alias("entry_key"),
        "stream_key", ids.message_key("stream_key", "message_id").alias("message_key"),
        ids.business_key_iso("event_type", "ts", "event_id").alias("iso_key"),
    )


@query("""SELECT event_id,
  CASE WHEN event_id % 5 IN (0, 4) THEN event_type END AS device_id,
  CASE WHEN event_id % 5 = 0 THEN event_id WHEN event_id % 5 = 4 THEN -event_id END AS timestamp,
  CASE WHEN event_id % 5 IN (0, 4) THEN printf('%04d', user_id) END AS sequence FROM events""")
def key_parse(spark, sf_dir):
    k = F.col("event_id")
    seq = F.format_string("%04d", "user_id")
    text = (
        F.when(k % 5 == 0, F.concat_ws(":", "event_type", k.cast("string"), seq))
        .when(k % 5 == 1, F.concat_ws(":", "event_type", F.lit("abc"), seq))
        .when(k % 5 == 2, F.concat_ws(":", F.lit(""), k.cast("string"), seq))
        .when(k % 5 == 3, F.concat_ws(":", "event_type", k.cast("string")))
        .otherwise(F.concat_ws(":", "event_type", F.concat(F.lit("-"), k.cast("string")), seq))
    )
    keyed = table(spark, sf_dir, "events").select("event_id", text.alias("k"))
    return keyed.select("event_id", ids.parse_business_key("k").alias("p")).select(
        "event_id", "p.device_id", "p.timestamp", "p.sequence"
    )


@query("""SELECT event_id, s AS event_second, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS unix_timestamp,
  strftime(make_timestamp(s * 1000000), '%Y-%m-%d') AS streaming_date
FROM (SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 1700000000 + event_id ELSE epoch_us(ts) // 1000000 END AS s FROM events)""")
def event_time(spark, sf_dir):
    k = F.col("event_id")
    ms = views.epoch_ms("ts").cast("string")
    message = F.when(k % 4 == 1, F.concat(ms, k.cast("string"))).otherwise(
        F.concat_ws("-", ms, k.cast("string"))
    )
    rows = table(spark, sf_dir, "events").select(
        "event_id", message.alias("message_id"), (1_700_000_000 + k).alias("ingest_second")
    )
    out = streamlog.stream_table_rows(rows)
    return out.select(
        "event_id", "event_second",
        F.date_format("unix_timestamp", "yyyy-MM-dd HH:mm:ss").alias("unix_timestamp"),
        F.col("streaming_date").cast("string").alias("streaming_date"),
    )


def _table_rows(log):
    rows = log.withColumn("ingest_second", F.lit(0).cast("bigint"))
    return streamlog.stream_table_rows(rows)


CONFLICT = """ SELECT stream_key, message_id, strftime(make_timestamp(id_ms * 1000), '%Y-%m-%d') AS streaming_date,
  {pick}(value_cents, arrival) AS value_cents FROM replayed_log GROUP BY ALL"""
CONFLICT_COLUMNS = ["stream_key", "message_id", "streaming_date", "value_cents"]


def _dated(rows):
    return rows.withColumn("streaming_date", F.col("streaming_date").cast("string")).select(
        *CONFLICT_COLUMNS
    )


@query(REPLAY + CONFLICT.format(pick="arg_min"))
def dedupe_first(spark, sf_dir):
    return _dated(streamlog.keep_first(_table_rows(views.replayed_log(spark, sf_dir))))


@query(REPLAY + CONFLICT.format(pick="arg_max"))
def dedupe_last(spark, sf_dir):
    return _dated(streamlog.keep_last(_table_rows(views.replayed_log(spark, sf_dir))))


def _target(log):
    return log.where("arrival % 4 = 0").withColumn(
        "stream_key", ids.prefixed("stream_key", "copy:")
    )


@query(LOG + """ SELECT 'copy:' || stream_key AS stream_key, message_id, value_cents
FROM stream_log WHERE arrival % 4 <> 0""")
def replicate_missing(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    return streamlog.replicate(log, _target(log), "copy:").select(*ENTRY)


@query(LOG + """ SELECT 'copy:' || stream_key AS stream_key, count(*) FILTER (arrival % 4 <> 0 AND arrival % 7 <> 0) AS synced,
  count(*) FILTER (arrival % 7 = 0) AS failed, count(*) FILTER (arrival % 4 = 0 AND arrival % 7 <> 0) AS skipped
FROM stream_log GROUP BY ALL""")
def replicate_counts(spark, sf_dir):
    """Every seventh entry has lost its id."""
    log = views.stream_log(spark, sf_dir)
    held = _target(log)
    log = log.withColumn("message_id", F.when(F.col("arrival") % 7 != 0, F.col("message_id")))
    return streamlog.replication_counts(streamlog.replicate_outcomes(log, held, "copy:"))


@query(LOG + """ SELECT stream_key, message_id, value_cents FROM stream_log WHERE user_id % 5 <> 2""")
def remaining_entries(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    return streamlog.remaining(log, log.where("user_id % 5 = 2")).select(*ENTRY)


@query("""SELECT event_id, event_type FROM events WHERE event_id % 9 <> 0""")
def init_rows_dropped(spark, sf_dir):
    init = F.create_map(F.lit("init"), F.lit("init"))
    own = F.create_map(F.lit("type"), F.col("event_type"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 9 == 0, init).otherwise(own).alias("data")
    )
    return streamlog.without_init_rows(rows).select(
        "event_id", F.element_at("data", "type").alias("event_type")
    )


# --- key-values ---


def kv(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_custkey") % 16).cast("int").alias("redis_db"),
        F.concat(F.lit("cust:"), F.col("o_custkey").cast("string")).alias("redis_key"),
        F.when(F.col("o_orderkey") % 11 == 0, "hash").otherwise("string").alias("key_type"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("redis_value"),
        F.col("o_orderkey").alias("arrival"),
    )


KV = """WITH kv AS (SELECT CAST(o_custkey % 16 AS INT) AS redis_db, 'cust:' || o_custkey AS redis_key,
  CASE WHEN o_orderkey % 11 = 0 THEN 'hash' ELSE 'string' END AS key_type,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS redis_value, o_orderkey AS arrival FROM orders)"""
PAIR = ["redis_db", "redis_key", "redis_value"]


@query(KV + """ SELECT redis_db, redis_key, coalesce(redis_value, '') AS redis_value FROM kv
QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1""")
def kv_latest(spark, sf_dir):
    return keyvalues.latest_per_key(kv(spark, sf_dir)).select(*PAIR)


@query(KV + """ SELECT redis_db, redis_key, coalesce(redis_value, '') AS redis_value FROM kv
WHERE (redis_db, redis_key) NOT IN (SELECT (redis_db, redis_key) FROM kv WHERE arrival % 97 = 0)
QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival) = 1""")
def kv_once(spark, sf_dir):
    pairs = kv(spark, sf_dir)
    done = pairs.where("arrival % 97 = 0")
    return keyvalues.copy_once(pairs, done).select(*PAIR)


@query(KV + """ SELECT redis_db, redis_key, coalesce(redis_value, '') AS redis_value FROM kv
QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1""")
def kv_upsert(spark, sf_dir):
    pairs = kv(spark, sf_dir)
    old, new = pairs.where("arrival % 2 = 0"), pairs.where("arrival % 2 = 1")
    return keyvalues.upsert(keyvalues.latest_per_key(old), new).select(*PAIR)


@query(KV + """, latest AS (SELECT * FROM kv
  QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1)
SELECT c.c_custkey AS request, coalesce(l.redis_value, '') AS redis_value, l.redis_key IS NOT NULL AS found
FROM customer c LEFT JOIN latest l ON l.redis_key = 'cust:' || c.c_custkey AND l.redis_db = c.c_custkey % 16""")
def kv_lookup(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request"),
        (F.col("c_custkey") % 16).cast("int").alias("redis_db"),
        F.concat(F.lit("cust:"), F.col("c_custkey").cast("string")).alias("redis_key"),
    )
    # the stored values carry no nulls, so a null marks an absent key
    found = keyvalues.lookup(requests, keyvalues.latest_per_key(kv(spark, sf_dir)))
    return found.select(
        "request", F.coalesce("redis_value", F.lit("")).alias("redis_value"),
        F.col("redis_value").isNotNull().alias("found"),
    )


@query(KV + " SELECT arrival, redis_value FROM kv WHERE redis_key = 'cust:7' AND redis_db = 7")
def kv_point_lookup(spark, sf_dir):
    return keyvalues.point_lookup(kv(spark, sf_dir), "cust:7", 7).select("arrival", "redis_value")


@query(KV + """ SELECT arrival, redis_db, redis_key, redis_value FROM kv WHERE key_type = 'string'
AND regexp_full_match(redis_key, 'cust:(1.*|[2-4].|.[^0-3].)') AND redis_db IN (1, 2, 3, 5, 8, 13)""")
def kv_glob_scan(spark, sf_dir):
    out = keyvalues.scan_keys(
        kv(spark, sf_dir), ["cust:1*", "cust:[2-4]?", "cust:?[!0-3]?"], [1, 2, 3, 5, 8, 13]
    )
    return out.select("arrival", *PAIR)


@query(KV + r""" SELECT arrival, redis_db, redis_key, redis_value FROM kv WHERE key_type = 'string'
AND regexp_full_match(redis_key, 'cust:([^1-5].*|[2-4]7|1.5)')""")
def kv_server_scan(spark, sf_dir):
    """The same scan in the store's own dialect: negated by ^, ranges either way, escapes."""
    out = keyvalues.scan_keys(kv(spark, sf_dir), ["cust:[^1-5]*", r"cust\:[4-2]7", "cust:1?[5]"], dialect="server")
    return out.select("arrival", *PAIR)


# --- outbox ---

AS_OF = 946_684_800  # 2000-01-01 UTC
DAY = 86_400


def _seconds(col):
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def content(spark, sf_dir):
    k = F.col("o_orderkey")
    prefix = (
        F.when(k % 13 == 0, "__").when(k % 13 == 1, "stream:").when(k % 13 == 2, "kafka_sync:")
        .when(k % 13 == 3, "_:").otherwise("order:")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(prefix, k.cast("string")).alias("key"),
        _seconds("o_orderdate").alias("written_at"),
        F.when(k % 17 != 0, (k % 2000) * DAY).alias("ttl_s"),
        F.col("o_orderpriority").alias("value"), "o_orderstatus", k.alias("n"),
    )


def markers(spark, sf_dir):
    done = content(spark, sf_dir).where("o_orderstatus = 'F'")
    one = done.select("key", (F.col("written_at") + 3600).alias("marked_at"), F.lit(3000 * DAY).alias("ttl_s"))
    return one.unionByName(one.withColumn("ttl_s", F.lit(10).cast("int")))


BOX = f"""WITH content AS (SELECT CASE o_orderkey % 13 WHEN 0 THEN '__' WHEN 1 THEN 'stream:'
    WHEN 2 THEN 'kafka_sync:' WHEN 3 THEN '_:' ELSE 'order:' END || o_orderkey AS key,
  epoch_us(o_orderdate) // 1000000 AS written_at,
  CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey % 2000) * {DAY} END AS ttl_s,
  o_orderpriority AS value, o_orderstatus, o_orderkey AS n FROM orders),
live AS (SELECT * FROM content WHERE ttl_s IS NULL OR written_at + ttl_s > {AS_OF}),
own AS (SELECT * FROM live WHERE n % 13 > 3),
marked AS (SELECT DISTINCT key FROM content WHERE o_orderstatus = 'F'
           AND (written_at + 3600 + {3000 * DAY} > {AS_OF} OR written_at + 3610 > {AS_OF}))"""


@query(BOX + " SELECT key, value FROM own WHERE key NOT IN (SELECT key FROM marked)")
def unsynced(spark, sf_dir):
    out = outbox.unsynced(content(spark, sf_dir), markers(spark, sf_dir), AS_OF)
    return out.select("key", "value")


@query(BOX + " SELECT key, key IN (SELECT key FROM marked) AS is_synced FROM own")
def synced_flag(spark, sf_dir):
    out = outbox.synced_flag(content(spark, sf_dir), markers(spark, sf_dir), AS_OF)
    return out.select("key", "is_synced")


@query(BOX + " SELECT key, written_at, ttl_s FROM live")
def ttl_live(spark, sf_dir):
    return outbox.live(content(spark, sf_dir), "written_at", AS_OF).select("key", "written_at", "ttl_s")


@query("""SELECT o_orderkey, 'order:' || o_orderkey AS key FROM orders WHERE o_orderkey % 6 > 0""")
def text_keys(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = F.concat(F.lit("order:"), k.cast("string")).cast("binary")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 6 == 0, F.concat(F.unhex(F.lit("FF")), raw)).otherwise(raw).alias("key")
    )
    return outbox.text_keys(rows)


def _sent(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t"), (k % 3).cast("string")).alias("topic"),
        (k % 5).cast("int").alias("partition"), k.alias("offset"),
        F.when(k % 4 != 0, F.col("o_custkey")).alias("device_id"),
        F.concat(F.lit("order:"), k.cast("string")).alias("key"),
        F.col("o_orderpriority").alias("value"),
    )


@query("""SELECT 't' || (o_orderkey % 3) AS topic, CAST(o_orderkey % 5 AS INT) AS partition, o_orderkey AS "offset",
  CASE WHEN o_orderkey % 4 <> 0 THEN 'kafka_index:t' || (o_orderkey % 3) || ':' || (o_orderkey % 5) || ':' || o_orderkey END AS index_key,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'order:' || o_orderkey
       ELSE 't' || (o_orderkey % 3) || ':' || (o_orderkey % 5) || ':' || o_orderkey END AS content_key FROM orders""")
def position_index(spark, sf_dir):
    return outbox.position_index(_sent(spark, sf_dir)).select(
        "topic", "partition", "offset", "index_key", "content_key"
    )


@query("""WITH asked AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT l_orderkey AS "offset", CASE WHEN o_orderkey % 4 <> 0 THEN 'order:' || o_orderkey
       ELSE 't' || (o_orderkey % 3) || ':' || (o_orderkey % 5) || ':' || o_orderkey END AS key,
  CASE WHEN o_orderkey % 8 <> 1 THEN o_orderpriority END AS value
FROM asked LEFT JOIN orders ON o_orderkey = l_orderkey AND l_orderkey % 10 < 9""")
def position_lookup(spark, sf_dir):
    k = F.col("l_orderkey")
    asked = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().select(
        F.concat(F.lit("t"), (k % 3).cast("string")).alias("topic"),
        # a request for a partition that was never written finds nothing
        F.when(k % 10 < 9, k % 5).otherwise(99).cast("int").alias("partition"), k.alias("offset"),
    )
    index = outbox.position_index(_sent(spark, sf_dir))
    cache = index.where("offset % 8 <> 1").select(F.col("content_key").alias("key"), "value")
    return outbox.position_lookup(asked, index, cache).select("offset", "key", "value")


@query("""SELECT l_orderkey, l_linenumber, n, CASE WHEN o_orderkey IS NOT NULL THEN o_orderpriority ELSE l_returnflag END AS value,
  o_orderkey IS NOT NULL AS hit
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 3 = 0""")
def cache_fallback(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n")
    )
    messages = lines.select(
        "l_orderkey", "l_linenumber", "n", F.col("l_orderkey").alias("key"),
        F.col("l_returnflag").alias("value"),
    )
    cache = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("value")
    )
    return outbox.cached_or_own(messages, cache).drop("key")


@query(BOX + """ SELECT count(*) AS attempted, count(*) FILTER (n % 5 > 0) AS synced
FROM own WHERE key NOT IN (SELECT key FROM marked)""")
def sync_counts(spark, sf_dir):
    todo = outbox.unsynced(content(spark, sf_dir), markers(spark, sf_dir), AS_OF)
    return outbox.sync_counts(todo.withColumn("acked", F.col("n") % 5 > 0))


@query(BOX + f""" SELECT key, CAST({AS_OF} AS BIGINT) AS marked_at, CAST(3600 AS BIGINT) AS ttl_s
FROM own WHERE key NOT IN (SELECT key FROM marked) AND n % 5 > 0""")
def new_markers(spark, sf_dir):
    todo = outbox.unsynced(content(spark, sf_dir), markers(spark, sf_dir), AS_OF)
    return outbox.new_markers(todo.withColumn("acked", F.col("n") % 5 > 0), AS_OF)


# --- sets of entries, statistics that are kept ---

_WAS_DELIVERED = "arrival DIV 50 % 3 <> 1"


def _interval_inputs(spark, sf_dir):
    """The numbered log, and what two batches of deliveries and acknowledgements came to."""
    log = intervals.numbered(views.stream_log(spark, sf_dir))
    keys = ["stream_key"]
    sent = log.where(_WAS_DELIVERED)
    halves = [intervals.of_positions(sent.where(half), keys) for half in ("arrival % 2 = 0", "arrival % 2 = 1")]
    delivered = intervals.merged(halves[0].unionByName(halves[1]), keys)
    return log, delivered, intervals.of_positions(sent.where("arrival % 7 < 5"), keys)


@query(LOG + """ SELECT stream_key, message_id FROM stream_log WHERE arrival // 50 % 3 = 1
QUALIFY row_number() OVER (PARTITION BY stream_key ORDER BY id_ms, id_seq) <= 20""")
def delivered_intervals(spark, sf_dir):
    """The next 20 entries of every stream that no interval of the history covers."""
    log, delivered, _ = _interval_inputs(spark, sf_dir)
    lengths = log.groupBy("stream_key").agg(F.count(F.lit(1)).alias("length"))
    return intervals.group_read(log, lengths, delivered, 20).select("stream_key", "message_id")


@query(LOG + """ SELECT stream_key, message_id FROM stream_log WHERE arrival // 50 % 3 <> 1 AND arrival % 7 >= 5""")
def pending_intervals(spark, sf_dir):
    """Delivered entries without an acknowledgement, from the difference of two sets."""
    log, delivered, acked = _interval_inputs(spark, sf_dir)
    open_ones = intervals.spread(intervals.pending(delivered, acked, ["stream_key"]), ["stream_key"])
    return log.join(open_ones, ["stream_key", "pos"]).select("stream_key", "message_id")


@query(LOG + """, q AS (SELECT *, arrival * 4 // (SELECT max(arrival) + 1 FROM stream_log) AS quarter FROM stream_log)
SELECT stream_key, count(*) AS length, min_by(message_id, arrival) AS first_id, max_by(message_id, arrival) AS last_id
FROM q WHERE NOT (quarter = 0 OR (quarter = 1 AND arrival % 3 = 0)) GROUP BY stream_key""")
def kept_stats(spark, sf_dir):
    """Statistics kept over four batches; the third also trims, and runs twice."""
    log = views.stream_log(spark, sf_dir)
    size = log.agg(F.max("arrival") + 1).first()[0]
    log = log.withColumn("quarter", views.whole_steps(F.col("arrival") * 4, size)).withColumn("log_date", stores.log_date())
    gone = F.expr("quarter = 0 OR (quarter = 1 AND arrival % 3 = 0)")
    store = keptstats.stream_store(spark, shared_folder(spark, "kept-stats"), fanout=3)
    for batch in (0, 1, 2, 2, 3):
        trim = dict(trimmed=log.where(gone), log=log.where(~gone & (F.col("quarter") <= 2))) if batch == 2 else {}
        keptstats.add_entries(store, batch, log.where(F.col("quarter") == batch), **trim)
    return keptstats.stream_stats(store)
