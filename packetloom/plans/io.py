"""Queries that write the tables out, or stream them, and read the result back."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

from packetloom.functions.ids import business_key, message_key
from packetloom.functions.patterns import route
from packetloom.operators import frames, keyvalues, streamlog
from packetloom.plans import replication, sensor, views
from packetloom.plans.registry import query
from packetloom.plans.replication import CONFLICT, CONFLICT_COLUMNS, ENTRY, FROM_MS, KV, LOG, REPLAY, TO_MS
from packetloom.plans.reports import KEPT, messages
from packetloom.plans.views import table, with_sql
from packetloom.session import shared_folder
from packetloom.sources import exports, folders, kvruns, logstream, sessionfiles, smallfiles, stores, topics
from packetloom.streaming import fanout, metrics, runs, sinks, stateful

# Workers get the writers below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _conflict_table(spark, sf_dir, overwrite):
    path = shared_folder(spark, "stream-table")
    log = views.replayed_log(spark, sf_dir).withColumn("ingest_second", F.lit(0).cast("bigint"))
    rows = streamlog.stream_table_rows(log).select(*CONFLICT_COLUMNS, "arrival")
    stores.write_stream_table(rows.where("arrival < 1000000000"), path, overwrite)
    stores.write_stream_table(rows.where("arrival >= 1000000000"), path, overwrite)
    out = spark.read.parquet(path)
    return out.withColumn("streaming_date", F.col("streaming_date").cast("string")).select(*CONFLICT_COLUMNS)


@query(REPLAY + CONFLICT.format(pick="arg_min"))
def stream_table_first(spark, sf_dir):
    return _conflict_table(spark, sf_dir, overwrite=False)


@query(REPLAY + CONFLICT.format(pick="arg_max"))
def stream_table_last(spark, sf_dir):
    return _conflict_table(spark, sf_dir, overwrite=True)


@query(REPLAY + CONFLICT.format(pick="arg_min"))
def catalog_tables(spark, sf_dir):
    """The stream table by its catalog name: provisioned, written, refreshed, read."""
    folder = shared_folder(spark, "catalog")
    stream, _ = stores.provision(spark, f"telemetry_{folder[-12:]}", folder=folder)
    log = views.replayed_log(spark, sf_dir).withColumn("ingest_second", F.lit(0).cast("bigint"))
    fields = F.create_map(F.lit("v"), F.col("value_cents").cast("string"))
    rows = stores.table_rows(streamlog.stream_table_rows(log.withColumn("data", fields)))
    for _ in range(2):
        stores.write_stream_table(rows, f"{folder}/stream_messages")
    stores.refresh(spark, stream)
    return spark.table(stream).select(
        "stream_key", "message_id", F.col("streaming_date").cast("string").alias("streaming_date"),
        F.get_json_object("data", "$.v").cast("bigint").alias("value_cents"),
    )


@query(KV + """ SELECT redis_db, redis_key, coalesce(redis_value, '') AS redis_value FROM kv
QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1""")
def kv_table(spark, sf_dir):
    path = shared_folder(spark, "kv-table")
    pairs = replication.kv(spark, sf_dir).drop("key_type")
    half = F.expr("arrival % 2 = 0")
    stores.write_kv_table(pairs.where(half), path, buckets=4)
    stores.write_kv_table(pairs.where(~half), path, buckets=4)
    return spark.read.parquet(path).select("redis_db", "redis_key", "redis_value")


@query(KV + """, latest AS (SELECT * FROM kv QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1)
SELECT CAST(c_custkey % 16 AS INT) AS redis_db, 'cust:' || c_custkey AS redis_key, CASE WHEN l.redis_key IS NOT NULL THEN coalesce(l.redis_value, '') END AS redis_value
FROM customer c LEFT JOIN latest l ON l.redis_key = 'cust:' || c_custkey AND l.redis_db = c_custkey % 16""")
def bucketed_lookup(spark, sf_dir):
    """Customers looked up in the latest values; both tables lie in the same buckets."""
    tag = uuid.uuid4().hex
    held, asked = f"packetloom_held_{tag}", f"packetloom_asked_{tag}"
    pairs = keyvalues.latest_per_key(replication.kv(spark, sf_dir)).select("redis_db", "redis_key", "redis_value")
    stores.write_bucketed(pairs, held, keyvalues.KEY, 8, bloom=["redis_key"])
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 16).cast("int").alias("redis_db"), F.concat(F.lit("cust:"), F.col("c_custkey").cast("string")).alias("redis_key")
    )
    stores.write_bucketed(customers, asked, keyvalues.KEY, 8)
    return stores.lookup_bucketed(spark.table(asked), held, keyvalues.KEY)


def _kv_changes(spark, sf_dir):
    """Changes of keys, some of them deletions."""
    pairs = replication.kv(spark, sf_dir).drop("key_type")
    return pairs.withColumn("deleted", F.col("arrival") % 17 == 3)


@query(KV + """ SELECT redis_db, redis_key, redis_value FROM (
  SELECT * FROM kv QUALIFY row_number() OVER (PARTITION BY redis_db, redis_key ORDER BY arrival DESC) = 1)
WHERE arrival % 17 <> 3""")
def kv_runs(spark, sf_dir):
    """Six batches of changes as runs, four of them merged."""
    path = shared_folder(spark, "kv-runs")
    changes = _kv_changes(spark, sf_dir)
    for batch in range(6):
        kvruns.write(changes.where(F.col("arrival") % 6 == batch), path, batch)
    return kvruns.read(spark, path).select("redis_db", "redis_key", "redis_value")


@query(LOG + f""" SELECT stream_key, message_id, value_cents FROM stream_log
WHERE id_ms BETWEEN {FROM_MS} AND {TO_MS} AND characteristic = 'click'""")
def stored_log_scan(spark, sf_dir):
    path = shared_folder(spark, "log")
    stores.append_log(views.stream_log(spark, sf_dir), path)
    return stores.read_log(spark, path, FROM_MS, TO_MS, char="click").select(*ENTRY)


@query("""SELECT event_type || '-' || user_id || '-press-' || ms AS redis_key,
  arg_max(event_id, event_id) || '' AS redis_value
FROM (SELECT event_type, user_id, event_id, epoch_us(ts) // 60000000 * 60000 AS ms FROM events) GROUP BY event_type, user_id, ms""")
def keyed_write(spark, sf_dir):
    values = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("device"), F.col("user_id").cast("string").alias("device_id"),
        F.lit("press").alias("char"), F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) * 60000").alias("timestamp_ms"),
        F.lit(2).alias("redis_db"), F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("arrival"),
    )
    return keyvalues.latest_per_key(stores.keyed_rows(values)).select("redis_key", "redis_value")


@query(with_sql("all_packets", "gated") + """ SELECT device || '' AS device, event_id || '' AS timestamp_python, (event_id * 3) || '' AS timestamp, seq || '' AS counter, (event_id % 15) || '' AS read,
  trig || '' AS trigger, array_to_string([(event_id * 31 + j * 17) % 1000 - 100 for j in range(96)], ', ') AS pressure_data FROM gated""")
def pressure_csv(spark, sf_dir):
    path = shared_folder(spark, "pressure-csv")
    rows = sensor.tracked(spark, sf_dir, "off").select(
        F.col("device").cast("string"), F.col("event_id").alias("timestamp_python"),
        (F.col("event_id") * 3).alias("timestamp"), F.col("seq").alias("counter"), (F.col("event_id") % 15).alias("read"),
        F.col("trig").alias("trigger"), "pressure",
    ).withColumn("bucket", F.col("device").cast("int") % 16)
    exports.write_session_csv(exports.pressure_csv_rows(rows), path, ["device", *exports.PRESSURE_HEADER], ["bucket"])
    back = exports.read_session_csv(spark, path, ["device", *exports.PRESSURE_HEADER], ["bucket"])
    return back.select("device", "timestamp_python", "timestamp", "counter", "read", "trigger", "pressure_data")


@query("""SELECT (epoch_us(ts) // 1000) || '' AS timestamp_python, event_id || '' AS packet_counter,
  event_type || ', ' || user_id AS imu_data, 'user' || (user_id % 8) AS session_address FROM events""")
def imu_csv(spark, sf_dir):
    path = shared_folder(spark, "imu-csv")
    e = table(spark, sf_dir, "events").select(
        views.epoch_ms("ts").alias("timestamp_python"), F.col("event_id").alias("packet_counter"),
        F.concat_ws(", ", "event_type", F.col("user_id").cast("string")).alias("imu_data"),
        F.lit("not in the header").alias("extra"),
        F.concat(F.lit("us:er"), (F.col("user_id") % 8).cast("string")).alias("address"),
        F.lit(1_704_067_200_000).alias("start_ms"),
    )
    named = exports.session_columns(e, "IMU", "address", "start_ms")
    exports.write_session_csv(named, path, exports.IMU_HEADER)
    # ts_board is not in the rows: the file has the column, empty
    back = exports.read_session_csv(spark, path, exports.IMU_HEADER).where("ts_board IS NULL")
    return back.select("timestamp_python", "packet_counter", "imu_data", "session_address")


@query("""WITH lines AS (
  SELECT event_id, user_id % 8 AS k, (epoch_us(ts) // 1000) || ',,' || event_id || ',"' || event_type || ', ' || user_id || '"' AS line FROM events),
files AS (SELECT k, string_agg(line, chr(13) || chr(10) ORDER BY event_id) AS body, count(*) + 1 AS n FROM lines GROUP BY k)
SELECT 'sessions/user' || k || '/2024-01-01_00-00-0' || k || '/IMU_user' || k || '_' || (1704067200000 + k * 1000) || '.csv' AS session_file,
       md5('timestamp_python,ts_board,packet_counter,imu_data' || chr(13) || chr(10) || body || chr(13) || chr(10)) AS digest, n
FROM files""")
def session_files(spark, sf_dir):
    """One file per session, written in two goes under one header."""
    path = shared_folder(spark, "session-files")
    k = F.col("user_id") % 8
    e = table(spark, sf_dir, "events").select(
        "event_id", views.epoch_ms("ts").alias("timestamp_python"), F.col("event_id").alias("packet_counter"),
        F.concat_ws(", ", "event_type", F.col("user_id").cast("string")).alias("imu_data"),
        F.concat(F.lit("us:er"), k.cast("string")).alias("address"), (k * 1000 + 1_704_067_200_000).alias("start_ms"),
    )
    named = exports.session_columns(e, "IMU", "address", "start_ms")
    middle = e.agg(F.max("event_id")).first()[0] // 2
    for half in (F.col("event_id") <= middle, F.col("event_id") > middle):
        sessionfiles.write_session_files(named.where(half), path, exports.IMU_HEADER, "event_id")
    back = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
    text = F.col("content").cast("string")
    return back.select(
        F.regexp_extract("path", "(sessions/.*)$", 1).alias("session_file"), F.md5("content").alias("digest"),
        F.char_length(F.regexp_replace(text, "[^\n]", "")).cast("bigint").alias("n"),
    )


@query("""SELECT user_id, 'sessions/AA' || user_id || '/' || strftime(ts, '%Y-%m-%d_%H-%M-%S') || '/SFLP_AA' || user_id || '_'
  || (epoch_us(ts) // 1000) || '.csv' AS session_file FROM events""")
def session_path(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "user_id", F.concat(F.lit("A:A"), F.col("user_id").cast("string")).alias("address"),
        views.epoch_ms("ts").alias("ms"),
    )
    return exports.session_columns(e, "SFLP", "address", "ms").select("user_id", "session_file")


@query("SELECT doc_id, md5(text) AS digest, lang FROM documents")
def json_export(spark, sf_dir):
    path = shared_folder(spark, "json")
    exports.write_compressed_json(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    back = spark.read.schema("doc_id bigint, text string, lang string").json(path)
    return back.select("doc_id", F.md5("text").alias("digest"), "lang")


# Bytes of the table for each task that reads its documents back from files.
_FILES_TASK = 16 << 20


def _document_files(spark, sf_dir):
    """Every document as a file of its own, with a line end behind the text; where they
    are, and in how many tasks to read them."""
    path = shared_folder(spark, "document-files")
    d = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL AND text IS NOT NULL")
    tasks = max(spark.sparkContext.defaultParallelism, folders.size(spark, f"{sf_dir}/documents.parquet") // _FILES_TASK)
    return smallfiles.write_small_files(d, path, "doc_id", "text"), tasks


@query("""SELECT octet_length(encode(text)) + 1 AS length, md5(text || chr(10)) AS digest, 'bed:file:7' AS key FROM documents
WHERE octet_length(encode(text)) < 4000""")
def binary_files(spark, sf_dir):
    """Documents as files, read back as messages up to a size."""
    path, tasks = _document_files(spark, sf_dir)
    out = topics.file_messages(spark, path, "files", 7, device="bed", limit=4000, tasks=tasks)
    name = F.split("key", ":")[1]
    key = F.when(name.rlike("^part-.*[.]txt$"), F.replace("key", name, F.lit("file")))
    return out.select(
        F.octet_length("value").alias("length"), F.md5("value").alias("digest"), key.alias("key")
    )


@query("""SELECT octet_length(encode(text)) + 1 AS length, md5(text || chr(10)) AS digest FROM documents
WHERE octet_length(encode(text)) < 20971520""")
def binary_files_whole(spark, sf_dir):
    """Documents as files, read back as messages up to the operator's own size limit."""
    path, tasks = _document_files(spark, sf_dir)
    out = topics.file_messages(spark, path, "files", 7, tasks=tasks)
    return out.select(F.octet_length("value").alias("length"), F.md5("value").alias("digest"))


@query("""SELECT CASE WHEN octet_length(encode(text)) < 4000 THEN 'ok' ELSE 'too_large' END AS verdict,
  CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length FROM documents""")
def file_verdicts(spark, sf_dir):
    path, tasks = _document_files(spark, sf_dir)
    return topics.read_files(spark, path, limit=4000, tasks=tasks).select("verdict", "length")


@query(LOG + """ SELECT CASE WHEN characteristic = 'click' THEN 'clicks' ELSE 'rest' END AS topic,
  stream_key || ':' || message_id AS key, value_cents || '' AS value FROM stream_log""")
def topic_messages(spark, sf_dir):
    log = views.stream_log(spark, sf_dir).select(
        route("stream_key", [("stream:click:*", "clicks")], "rest").alias("topic"),
        message_key("stream_key", "message_id").alias("key"), F.col("value_cents").cast("string").alias("value"),
    )
    out = topics.topic_frame(log)
    return out.select("topic", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


# --- streams: the table arrives in two parts, the query restarts in between ---


def _two_parts(spark, df, order):
    """Write ``df`` in two slices by ``order``; yields the folder after each."""
    path = shared_folder(spark, "source")
    middle = df.agg(F.max(order)).first()[0] // 2
    for part in (F.col(order) <= middle, F.col(order) > middle):
        df.where(part).write.mode("append").parquet(path)
        yield path


def _run(spark, df, order, sink, over=None):
    """Streams both parts through ``over``, which keeps state, into ``sink``, with a restart in between."""
    checkpoint = shared_folder(spark, "checkpoint")
    for path in _two_parts(spark, df, order):
        stream = runs.read_stream(spark, path, df.schema)
        runs.start(over(stream) if over else stream, sink, checkpoint, keyed=over is not None).awaitTermination()


def _replicated(spark, sf_dir):
    """Every entry arrives, every third again with another value, every eleventh without
    its id; the source is replicated twice over. Gives the folder."""
    path = shared_folder(spark, "replica")
    log = views.stream_log(spark, sf_dir)
    log = log.withColumn("message_id", F.when(F.col("arrival") % 11 != 0, F.col("message_id")))
    again = log.where("arrival % 3 = 0").withColumns(
        {"value_cents": F.col("value_cents") + 7, "arrival": F.col("arrival") * 2 + 1}
    )
    rows = log.withColumn("arrival", F.col("arrival") * 2).unionByName(again)
    for _ in range(2):
        _run(spark, rows, "arrival", sinks.replica_sink(path, "copy:"))
    return path


@query(LOG + " SELECT 'copy:' || stream_key AS stream_key, message_id, value_cents FROM stream_log WHERE arrival % 11 <> 0")
def stream_replica(spark, sf_dir):
    """The replica holds each entry once, the copy that came first."""
    return stores.read_log(spark, _replicated(spark, sf_dir)).select(*ENTRY)


@query(LOG + """ SELECT stream_key, value_cents, 'no message id' AS reason FROM stream_log WHERE arrival % 11 = 0
UNION ALL SELECT stream_key, value_cents + 7, 'no message id' FROM stream_log WHERE arrival % 33 = 0""")
def stream_rejects(spark, sf_dir):
    """Entries without an id, kept apart."""
    path = _replicated(spark, sf_dir)
    return spark.read.parquet(f"{path}-rejects").select("stream_key", "value_cents", "reason")


def _odd_ones_fail():
    """Takes up to a hundred messages at once; fails on odd numbers."""
    return lambda rows: [ValueError("odd") if r["n"] % 2 else True for r in rows]


@query("""SELECT CASE WHEN event_id % 13 > 0 THEN 9007199254740993 + event_id END AS message_id,
  event_id % 2 = 0 AS success, CASE WHEN event_id % 2 = 1 THEN 'odd' END AS error FROM events""")
def delivered_ids(spark, sf_dir):
    """Large and missing ids come back from the writer as they went in."""
    k = F.col("event_id")
    big = F.when(k % 13 > 0, k + F.lit(9_007_199_254_740_993))
    rows = table(spark, sf_dir, "events").select(big.alias("message_id"), k.alias("n"))
    return topics.deliver(rows, _odd_ones_fail, ids=["message_id"], in_flight=100)


@query(LOG + """ SELECT stream_key, message_id, value_cents FROM stream_log
WHERE arrival > (SELECT max(arrival) // 2 FROM stream_log)""")
def stream_tail(spark, sf_dir):
    """Positions are taken when the first half is there; the tail is the other half."""
    folder, out = shared_folder(spark, "positions"), shared_folder(spark, "tail")
    parts = _two_parts(spark, views.stream_log(spark, sf_dir), "arrival")
    path = next(parts)
    at = runs.start_positions(spark.read.parquet(path), folder)
    next(parts)
    log = runs.read_stream(spark, path, spark.read.parquet(path).schema)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    runs.start(streamlog.tail_from(log, at), keep, shared_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(*ENTRY)


@query(REPLAY + CONFLICT.format(pick="arg_max"))
def stream_table_stream(spark, sf_dir):
    path = shared_folder(spark, "stream-table")
    log = views.replayed_log(spark, sf_dir).select("stream_key", "message_id", "value_cents", "arrival")
    _run(spark, log.withColumn("ingest_second", F.lit(0).cast("bigint")), "arrival", sinks.table_sink(path, overwrite=True))
    out = spark.read.parquet(path)
    return out.withColumn("streaming_date", F.col("streaming_date").cast("string")).select(*CONFLICT_COLUMNS)


@query(with_sql(*sensor.TRACKED) + " SELECT device, CAST(frame_id AS BIGINT) AS frame_id, gap_rows, samples FROM frames")
def stream_frames(spark, sf_dir):
    """Frames over two micro-batches: the same frames as ``frames_assembled``."""
    out = shared_folder(spark, "frames")
    packets = views.packets(spark, sf_dir).select("device", "event_id", "seq", "trig", "pressure")
    _run(spark, packets, "event_id", stateful.to_folder(out), lambda stream: stateful.session_frames(stream, ["device"]))
    gaps = F.size(F.filter("frame", lambda row: row[0] == -1000)).cast("bigint")
    return spark.read.parquet(out).select(
        "device", "frame_id", gaps.alias("gap_rows"), frames.frame_text().alias("samples")
    )


@query(sensor.BATCH_SQL.format(device="event_type", size=375, keep="batch_no < total_n // 375"))
def stream_batches(spark, sf_dir):
    out = shared_folder(spark, "batches")
    samples = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("device"), "event_id", views.cents("value").alias("v")
    )
    _run(spark, samples, "event_id", stateful.to_folder(out), lambda stream: stateful.batches(stream, ["device"], "event_id"))
    return sensor._batch_summary(spark.read.parquet(out))


# A packet a second of 50 devices, each with pauses of 1000 seconds; three kinds of control rows.
IDLE_S = 300
_CONTROL = "CASE WHEN event_id % 101 = 50 THEN 'stop' WHEN event_id % 103 = 51 THEN 'reset' WHEN event_id % 107 = 52 THEN 'start' END"
SESSIONS = f"""WITH rows_in AS (
  SELECT event_id, event_id % 50 AS device, {views.TURN}[1 + (event_id // 50 + event_id % 50) % 15] AS trig, {_CONTROL} AS event
  FROM events WHERE event_id % 7 <> 3 AND event_id // 1000 % 5 <> event_id % 5),
lives AS (
  SELECT *, sum(CASE WHEN event_id - prev_id > {IDLE_S} THEN 1 ELSE 0 END) OVER (PARTITION BY device ORDER BY event_id) AS life
  FROM (SELECT *, lag(event_id) OVER (PARTITION BY device ORDER BY event_id) AS prev_id FROM rows_in)),
parts AS (
  SELECT *, min(event_id) OVER (PARTITION BY device, life) AS begun,
         count(*) FILTER (event IN ('stop', 'reset')) OVER w AS segment, count(*) FILTER (event = 'reset') OVER w AS gate,
         count(*) FILTER (event = 'start') OVER w AS run
  FROM lives WINDOW w AS (PARTITION BY device, life ORDER BY event_id)),
gated AS (
  SELECT * FROM (
    SELECT *, max(CASE WHEN trig = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY device, life, gate ORDER BY event_id) AS opened
    FROM parts WHERE event IS NULL) WHERE opened = 1),
placed AS (SELECT *, list_position({views.TRIGGER_ORDER}, trig) - 1 AS pos FROM gated),
steps AS (SELECT *, lag(pos) OVER (PARTITION BY device, life, run ORDER BY event_id) AS prev FROM placed),
losses AS (
  SELECT *, CASE WHEN prev IS NULL OR (prev < 15 AND pos = (prev + 1) % 15) THEN 0 ELSE abs(pos - prev) - 1 END AS lost FROM steps),
tracked AS (
  SELECT *, sum(4 + 4 * greatest(lost, 0)) OVER (PARTITION BY device, life, segment ORDER BY event_id) AS row_end,
         sum(4 + 4 * greatest(lost, 0)) OVER (PARTITION BY device, life, segment) AS rows_total FROM losses)"""


def _session_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_id % 7 <> 3 AND event_id DIV 1000 % 5 <> event_id % 5").select(
        (F.col("event_id") % views.DEVICES).alias("device"), "event_id", F.timestamp_seconds("event_id").alias("ts"),
        F.expr(_CONTROL).alias("event"),
        views._in_turn(views.whole_steps(F.col("event_id"), views.DEVICES) + F.col("event_id") % views.DEVICES).alias("trig"),
        views.event_samples().alias("pressure"),
    )


def _sessions(spark, sf_dir):
    out = shared_folder(spark, "sessions")
    rows = _session_rows(spark, sf_dir)

    def over(stream):
        return stateful.session_frames(stream, ["device"], "event_id", ts="ts", event="event", idle_s=IDLE_S)

    _run(spark, rows, "event_id", stateful.to_folder(out), over)
    return spark.read.parquet(out)


@query(SESSIONS + """,
rows_ AS (
  SELECT device, begun, segment, rows_total, row_end - 4 + c AS row_idx, FALSE AS is_gap,
         [(event_id * 31 + (c * 24 + (i % 6) * 4 + i // 6) * 17) % 1000 - 100 for i in range(24)] AS cells
  FROM tracked, (SELECT unnest(range(4)) AS c)
  UNION ALL
  SELECT device, begun, segment, rows_total,
         unnest(range(CAST(row_end - 4 - 4 * greatest(lost, 0) AS BIGINT), CAST(row_end - 4 AS BIGINT))),
         TRUE, [-1000 for i in range(24)] FROM tracked WHERE lost > 0)
SELECT device, begun, segment, CAST(row_idx // 15 AS BIGINT) AS frame_id, count(*) FILTER (is_gap) AS gap_rows,
       string_agg(array_to_string(cells, ', '), ', ' ORDER BY row_idx) AS samples
FROM rows_ WHERE row_idx // 15 < (rows_total - 1) // 15 GROUP BY ALL""")
def stream_sessions(spark, sf_dir):
    """Frames of sessions with stops, resets, starts and pauses, over two micro-batches."""
    gaps = F.size(F.filter("frame", lambda row: row[0] == -1000)).cast("bigint")
    return _sessions(spark, sf_dir).where("kind = 'frame'").select(
        "device", "begun", "segment", "frame_id", gaps.alias("gap_rows"), frames.frame_text().alias("samples")
    )


@query(SESSIONS + f""",
ends AS (
  SELECT device, life, begun, event_id AS ended, segment - 1 AS segment, run, event AS reason FROM parts WHERE event IN ('stop', 'reset')
  UNION ALL
  SELECT device, life, begun, max(event_id) + 1, max(segment), max(run), 'idle' FROM parts GROUP BY device, life, begun
  HAVING max(event_id) + {IDLE_S} <= (SELECT max(event_id) FROM rows_in)),
sums AS (SELECT device, life, segment, count(*) AS packets, max(rows_total) AS rows_total FROM tracked GROUP BY ALL),
lost_by AS (
  SELECT e.device, e.life, e.ended, sum(t.lost) AS lost FROM ends e JOIN tracked t
  ON t.device = e.device AND t.life = e.life AND t.run = e.run AND t.event_id < e.ended GROUP BY ALL)
SELECT device, begun, segment, reason, coalesce(packets, 0) AS packets, CAST(coalesce(lost, 0) AS BIGINT) AS lost,
       CAST(coalesce((rows_total - 1) // 15, 0) AS BIGINT) AS frames,
       CAST(coalesce(rows_total - 15 * ((rows_total - 1) // 15), 0) AS BIGINT) AS rows_left
FROM ends LEFT JOIN sums USING (device, life, segment) LEFT JOIN lost_by USING (device, life, ended)""")
def session_ends(spark, sf_dir):
    """Why and with what sessions ended; the last pause is found by a timer."""
    return _sessions(spark, sf_dir).where("kind = 'end'").select(
        "device", "begun", "segment", "reason", "packets", "lost", "frames", "rows_left"
    )


def _flaky_writer():
    """Accepts a message unless its key ends in 7."""
    return lambda row: not str(row.get("key", row.get("message_id"))).endswith("7")


def _steady_writer():
    return lambda row: True


@query("""SELECT 'first' AS step, count(*) AS attempted, count(*) FILTER (event_id % 10 <> 7) AS synced FROM events
UNION ALL SELECT 'again', count(*) FILTER (event_id % 10 = 7), count(*) FILTER (event_id % 10 = 7) FROM events""")
def stream_outbox(spark, sf_dir):
    folder = shared_folder(spark, "outbox")
    e = table(spark, sf_dir, "events").select(
        F.lit("t").alias("topic"), F.concat(F.lit("order:"), F.col("event_id").cast("string")).alias("key"),
        F.col("event_type").cast("binary").alias("value"), F.lit(1_000).cast("bigint").alias("stamp_s"), "event_id",
    )
    _run(spark, e, "event_id", sinks.outbox_sink(folder, _flaky_writer))
    first = spark.read.parquet(f"{folder}/attempts").agg(
        F.lit("first").alias("step"), F.count(F.lit(1)).alias("attempted"), F.count_if("success").alias("synced")
    )
    first.write.parquet(f"{folder}/report/step=1")
    again = sinks.resync(spark, folder, "first", _steady_writer, as_of=1_500)
    again.select(F.lit("again").alias("step"), "attempted", "synced").write.parquet(f"{folder}/report/step=2")
    return spark.read.parquet(f"{folder}/report/step=1", f"{folder}/report/step=2")


@query(f"""SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN 'invalid'
              WHEN json_extract_string(props, '$.k') NOT IN ('7', '11', '13', '42', '77') THEN 'filtered'
              WHEN event_id % 10 = 7 THEN 'failed' ELSE 'published' END AS outcome FROM events) GROUP BY ALL""")
def stream_publish(spark, sf_dir):
    folder = shared_folder(spark, "publish")
    rows = messages(spark, sf_dir).withColumn("stamp", F.lit("t"))
    _run(spark, rows, "arrival", sinks.publish_sink(folder, _flaky_writer, "base", "k", KEPT))
    return spark.read.parquet(f"{folder}/outcomes").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _picky_writer():
    """Refuses messages whose id ends in 17."""
    return lambda row: not row["message_id"].endswith("17")


@query("""SELECT (epoch_us(ts) // 1000) || '-' || event_id AS message_id, event_id % 100 <> 17 AS published FROM events
WHERE event_id % 23 > 0 AND event_id % 29 > 0 AND json_extract_string(props, '$.k') IN ('7', '11', '13', '42', '77') AND event_id % 10 = 7""")
def publish_backlog(spark, sf_dir):
    """What the first attempt failed to publish, and whether the second one did."""
    folder = shared_folder(spark, "publish")
    rows = messages(spark, sf_dir).withColumn("stamp", F.lit("t"))
    _run(spark, rows, "arrival", sinks.publish_sink(folder, _flaky_writer, "base", "k", KEPT))
    waiting = sinks.backlog(spark, folder)
    waiting.select("message_id").write.parquet(f"{folder}/first")
    for _ in range(2):
        sinks.republish(spark, folder, "again", _picky_writer)
    left = sinks.backlog(spark, folder).select("message_id", F.lit(False).alias("published"))
    return spark.read.parquet(f"{folder}/first").join(left, "message_id", "left").fillna(True, ["published"])


def _mark_processed(value: bytes) -> bytes:
    if value.startswith(b"err"):
        raise ValueError("cannot process")
    return b"PROCESSED:" + value


@query("""SELECT event_type || ':' || (epoch_us(ts) // 1000) || ':' || printf('%04d', event_id) AS key,
  CASE WHEN event_type = 'error' THEN 'cannot process' ELSE 'PROCESSED:' || event_type END AS value FROM events""")
def stream_transform(spark, sf_dir):
    folder = shared_folder(spark, "transform")
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", views.epoch_ms("ts").alias("ms"), F.col("event_type").cast("binary").alias("value")
    )
    rows = e.withColumn("new_key", business_key("event_type", "ms", "event_id")).withColumn("key", F.col("new_key"))
    _run(spark, rows, "event_id", sinks.transform_sink(folder, _mark_processed, "output-topic"))
    done = spark.read.parquet(folder)
    text = F.coalesce("error", F.decode("value", "UTF-8"))
    return done.select("key", text.alias("value"))


@query(LOG + """ SELECT stream_key, CASE WHEN min(arrival) <= (SELECT max(arrival) // 2 FROM stream_log) THEN 0 ELSE 1 END AS batch_id
FROM stream_log GROUP BY stream_key""")
def stream_discovery(spark, sf_dir):
    folder = shared_folder(spark, "discovery")
    log = views.stream_log(spark, sf_dir).select("stream_key", "arrival")
    _run(spark, log, "arrival", sinks.discovery_sink(folder))
    return spark.read.parquet(folder).select("stream_key", F.col("batch_id").cast("bigint"))


@query(LOG + " SELECT stream_key, message_id, value_cents, TRUE AS within FROM stream_log")
def stream_admitted(spark, sf_dir):
    """The log by row-limited micro-batches, restarted after each; every entry once."""
    folder = shared_folder(spark, "admitted")
    log = views.stream_log(spark, sf_dir).select(*ENTRY, "arrival")
    limit = log.count() // 3 + 7
    for part in _two_parts(spark, log, "arrival"):
        for _ in range(2):
            stream = logstream.read_admitted(spark, part, log.schema, f"{folder}/progress", limit)
            runs.start(stream, stateful.to_folder(f"{folder}/out"), f"{folder}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    most = F.max("n").alias("most")
    within = out.groupBy("batch_id").agg(F.count("*").alias("n")).agg(most).first()["most"] <= limit
    return out.select(*ENTRY, F.lit(within).alias("within"))


def _flaky_sink(out, failures):
    """Fails the first ``failures`` times it is called."""
    left = [failures]

    def run(batch, batch_id):
        if left[0]:
            left[0] -= 1
            raise OSError("sink away")
        batch.select("stream_key", "message_id").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return run


@query(LOG + """ SELECT s.sink, stream_key, message_id FROM stream_log, (SELECT unnest(['replica', 'flaky', 'steady']) AS sink) s""")
def fan_out(spark, sf_dir):
    """Three sinks of one read; one of them fails twice and catches up alone."""
    folder = shared_folder(spark, "fan-out")
    all_sinks = {
        "replica": sinks.replica_sink(f"{folder}/replica"), "flaky": _flaky_sink(f"{folder}/flaky", 2),
        "steady": _flaky_sink(f"{folder}/steady", 0),
    }
    fan = fanout.FanOut(all_sinks, f"{folder}/log")
    _run(spark, views.stream_log(spark, sf_dir), "arrival", fan)
    fan.catch_up(spark)
    read = [
        spark.read.parquet(f"{folder}/{name}").select(F.lit(name).alias("sink"), "stream_key", "message_id") for name in all_sinks
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query("""SELECT m.metric, CAST(m.value AS DOUBLE) AS value FROM (
  SELECT count(*) AS rows_, count(*) FILTER (event_id % 13 <> 5) AS ok, count(*) FILTER (event_id % 13 = 5) AS bad,
         max(epoch_us(ts) // 1000) AS newest FROM events),
  LATERAL (SELECT unnest([{'metric': 'rows', 'value': rows_}, {'metric': 'messages_synced', 'value': ok},
                          {'metric': 'errors', 'value': bad}, {'metric': 'last_sync_ms', 'value': newest}]) AS m)""")
def stream_metrics(spark, sf_dir):
    """Counters observed while a stream is written, over a restart."""
    folder, out = shared_folder(spark, "metrics"), shared_folder(spark, "out")
    rows = views.stream_log(spark, sf_dir).withColumn("ok", F.col("arrival") % 13 != 5)
    listener = metrics.MetricsTable(spark, folder)
    spark.streams.addListener(listener)
    try:
        _run(spark, rows, "arrival", stateful.to_folder(out), metrics.observed)
        metrics.settle(spark)
    finally:
        spark.streams.removeListener(listener)
    found = metrics.totals(spark, folder).where("metric IN ('rows', 'messages_synced', 'errors', 'last_sync_ms')")
    return found.select("metric", "value")
