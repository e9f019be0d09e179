"""Queries for discovery, routing, payloads, health and devices."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import ids, records
from packetloom.functions.payloads import sampling_rate, status_text
from packetloom.operators import devices, discovery, health, routes, routing, streamlog
from packetloom.plans import views
from packetloom.plans.registry import query
from packetloom.plans.views import table, with_sql
from packetloom.session import shared_folder
from packetloom.sources import exports, keptstats

LOG = with_sql("stream_log")

# --- discovery ---


def keyspace(spark, sf_dir):
    k = F.col("p_partkey")
    name = (
        F.when(k % 4 == 0, F.concat(F.lit("device:"), k.cast("string"), F.lit(":stream")))
        .when(k % 4 == 1, F.concat(F.lit("biosignal-"), F.col("p_size").cast("string")))
        .when(k % 4 == 2, F.concat("p_brand", F.lit("-stream")))
        .otherwise(F.concat(F.lit("other:"), k.cast("string")))
    )
    return table(spark, sf_dir, "part").select(
        name.alias("key"), (F.col("p_size") % 16).cast("int").alias("db"),
        F.when(k % 5 == 0, "string").otherwise("stream").alias("key_type"), k.alias("n"),
    )


KEYSPACE = """WITH keyspace AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'device:' || p_partkey || ':stream'
    WHEN 1 THEN 'biosignal-' || p_size WHEN 2 THEN p_brand || '-stream' ELSE 'other:' || p_partkey END AS key,
  CAST(p_size % 16 AS INT) AS db, CASE WHEN p_partkey % 5 = 0 THEN 'string' ELSE 'stream' END AS key_type,
  p_partkey AS n FROM part),
streams AS (SELECT * FROM keyspace WHERE key_type = 'stream')"""
NAMED = ["display_name", "db", "key"]


@query(KEYSPACE + """ SELECT DISTINCT CASE WHEN db = 0 THEN key ELSE 'db' || db || ':' || key END AS display_name, db, key
FROM streams WHERE regexp_full_match(key, 'device:.*:stream|biosignal-[1-3].')""")
def discover_rr(spark, sf_dir):
    out = discovery.match_streams(
        keyspace(spark, sf_dir), ["device:*:stream", "biosignal-[1-3]?"], default_db=0
    )
    return out.select(*NAMED)


@query(KEYSPACE + """, hits AS (SELECT *, '*-stream' AS pattern FROM streams WHERE regexp_full_match(key, '.*-stream')
  UNION ALL SELECT *, 'Brand*' FROM streams WHERE starts_with(key, 'Brand'))
SELECT 'db' || db || ':' || key AS display_name, db, key, pattern FROM hits""")
def discover_pg(spark, sf_dir):
    out = discovery.match_streams(keyspace(spark, sf_dir), ["*-stream", "Brand*"], per_pattern=True, dialect="server")
    return out.select(*NAMED, "pattern")


@query(KEYSPACE + " SELECT DISTINCT key FROM streams WHERE db = 3 AND ends_with(key, '-stream')")
def discover_kf(spark, sf_dir):
    return discovery.match_streams(keyspace(spark, sf_dir), ["*-stream"], dbs=[3], dialect="server").select("key")


@query(KEYSPACE + """, lengths AS (SELECT db, key, count(*) AS length FROM keyspace WHERE n % 3 > 0 GROUP BY ALL)
SELECT DISTINCT s.db, s.key, coalesce(length, 0) AS length FROM streams s LEFT JOIN lengths l ON l.db = s.db AND l.key = s.key""")
def discover_mq(spark, sf_dir):
    keys = keyspace(spark, sf_dir)
    stats = keys.where("n % 3 > 0").groupBy("db", "key").agg(F.count(F.lit(1)).alias("length"))
    found = discovery.match_streams(keys, patterns=None)
    return discovery.with_length(found, stats).select("db", "key", "length")


@query(LOG + f""", cur AS (SELECT DISTINCT stream_key FROM stream_log WHERE id_ms >= 1704300000000),
old AS (SELECT DISTINCT stream_key FROM stream_log WHERE id_ms < 1705000000000)
SELECT stream_key, CASE WHEN old.stream_key IS NULL THEN 'new' WHEN cur.stream_key IS NULL THEN 'stopped' ELSE 'kept' END AS status
FROM cur FULL JOIN old USING (stream_key)""")
def stream_diff(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    return discovery.stream_diff(
        log.where("id_ms >= 1704300000000"), log.where("id_ms < 1705000000000")
    )


@query(KEYSPACE + """ SELECT DISTINCT 'file' AS dialect, key FROM streams
  WHERE regexp_full_match(key, 'biosignal-[^1-3].*') OR regexp_full_match(key, 'Brand#[\\^1].*')
UNION ALL SELECT DISTINCT 'server', key FROM streams
  WHERE regexp_full_match(key, 'biosignal-[2-4].*') OR regexp_full_match(key, 'Brand#[^1].*') OR key = 'other:7'""")
def glob_dialects(spark, sf_dir):
    """The same signs read by file globs and by the server's."""
    keys = keyspace(spark, sf_dir)
    file = discovery.match_streams(keys, ["biosignal-[!1-3]*", "Brand#[^1]*", "[z-a]*", "other\\:7"])
    server = discovery.match_streams(keys, ["biosignal-[4-2]*", "Brand#[^1]*", "other\\:7"], dialect="server")
    return file.select(F.lit("file").alias("dialect"), "key").distinct().unionByName(
        server.select(F.lit("server").alias("dialect"), "key").distinct()
    )


@query(KEYSPACE + " SELECT n, CASE WHEN n % 2 = 0 THEN db ELSE 9 END AS db, key FROM keyspace")
def display_parse(spark, sf_dir):
    keys = keyspace(spark, sf_dir)
    shown = F.when(F.col("n") % 2 == 0, ids.display_name("db", "key")).otherwise(F.col("key"))
    out = keys.select("n", shown.alias("shown")).select("n", ids.parse_display_name("shown", 9).alias("p"))
    return out.select("n", "p.db", "p.key")


# --- routing and payloads ---

ROUTES = [("device:*:stream", "device-data-topic"), ("*-stream", "default-stream-topic"),
          ("other:7", "exact-topic"), ("biosignal-1*", "bio-topic")]


@query(KEYSPACE + """ SELECT n, CASE WHEN key = 'other:7' THEN 'exact-topic'
  WHEN regexp_full_match(key, 'device:.*:stream') THEN 'device-data-topic'
  WHEN ends_with(key, '-stream') THEN 'default-stream-topic'
  WHEN starts_with(key, 'biosignal-1') THEN 'bio-topic' ELSE 'default-sync-topic' END AS topic FROM keyspace""")
def route_topic(spark, sf_dir):
    topic = routing.route("key", ROUTES, "default-sync-topic")
    return keyspace(spark, sf_dir).select("n", topic.alias("topic"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]*\.com/fr/') THEN 'fr'
  WHEN regexp_full_match(url, 'http.*\?page=[0-4].*') THEN 'paged' ELSE 'rest' END AS topic FROM pages""")
def route_pages(spark, sf_dir):
    c = F.col("url")
    fr = c.rlike(r"^https?://[^/]*\.com/fr/")
    paged = routing.route(c, [("http*[?]page=[0-4]*", "paged")], "rest")
    return table(spark, sf_dir, "pages").select("page_id", F.when(fr, "fr").otherwise(paged).alias("topic"))


PATTERNS_PER_PAGE = 400
_PATTERN = """CASE WHEN k = 8 THEN url
  WHEN k >= 8 THEN substr(url, 1, CAST(9 + k % 30 AS INT)) || '~' || k || CASE WHEN k % 2 = 0 THEN '*' ELSE '*' || substr(url, 12, 4) || '*' END
  WHEN k % 4 = 0 THEN substr(url, 1, CAST(20 + k AS INT)) || '*'
  WHEN k % 4 = 1 THEN '*' || substr(url, CAST(length(url) - 5 - k AS INT), CAST(6 + k AS INT))
  WHEN k % 4 = 2 THEN '*' || substr(url, CAST(10 + k AS INT), 9) || '*'
  ELSE substr(url, 1, 8) || '*' || substr(url, 15, CAST(k AS INT)) || '*' || substr(url, length(url), 1) END"""
_PLACE = "(page_id * 7919 + k * 104729) % 1000003 * 10000000 + page_id * 400 + k"


@query(f"""WITH mapping AS (
  SELECT {_PATTERN} AS pattern, {_PLACE} AS place FROM pages, (SELECT unnest(range({PATTERNS_PER_PAGE})) AS k)
  WHERE page_id % 5 <> 4 AND url IS NOT NULL),
exact AS (SELECT pattern AS url, min(place) AS place FROM mapping GROUP BY ALL),
starred AS (SELECT p.url, min(m.place) AS place FROM pages p JOIN mapping m ON m.pattern LIKE '%*%' AND p.url GLOB m.pattern GROUP BY ALL)
SELECT page_id, coalesce('t' || coalesce(e.place, s.place) % 97, 'rest') AS topic
FROM pages LEFT JOIN exact e USING (url) LEFT JOIN starred s USING (url)""")
def route_table(spark, sf_dir):
    """Pages routed by a mapping of 400 patterns for each page, most of which match nothing."""
    pages = table(spark, sf_dir, "pages")
    spread = pages.where("page_id % 5 <> 4 AND url IS NOT NULL").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(PATTERNS_PER_PAGE - 1))))
    mapping = spread.select(F.expr(_PATTERN).alias("pattern"), F.expr(_PLACE).alias("place"))
    mapping = mapping.withColumn("topic", F.concat(F.lit("t"), (F.col("place") % 97).cast("string")))
    return routes.route_table(pages.select("page_id", "url"), mapping, "rest", "url").select("page_id", "topic")


def messages(spark, sf_dir):
    """Log entries with their JSON text, straight from the table (no join)."""
    k = F.col("event_id")
    raw = F.when(k % 23 == 0, "[1, 2]").when(k % 29 == 0, "not json").otherwise(F.col("props"))
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("stream:"), "event_type", F.lit(":"), F.col("user_id").cast("string")).alias("stream_key"),
        F.concat_ws("-", views.epoch_ms("ts").cast("string"), k.cast("string")).alias("message_id"),
        k.alias("arrival"), raw.alias("raw"),
    )


MESSAGES = """WITH messages AS (SELECT 'stream:' || event_type || ':' || user_id AS stream_key,
  (epoch_us(ts) // 1000) || '-' || event_id AS message_id, event_id AS arrival,
  event_id % 23 > 0 AND event_id % 29 > 0 AS valid, json_extract_string(props, '$.k') AS k FROM events)"""
KEPT = ("7", "11", "13", "42", "77")


@query(MESSAGES + " SELECT message_id, valid, CASE WHEN valid THEN k END AS k FROM messages")
def message_validation(spark, sf_dir):
    parsed = routing.parse_messages(messages(spark, sf_dir))
    return parsed.select("message_id", "valid", F.element_at("data", "k").alias("k"))


@query(MESSAGES + " SELECT message_id, 'not an object' AS reason FROM messages WHERE NOT valid")
def invalid_messages(spark, sf_dir):
    parsed = routing.parse_messages(messages(spark, sf_dir))
    return routing.invalid_messages(parsed).select("message_id", "reason")


@query(MESSAGES + f" SELECT message_id, k FROM messages WHERE valid AND k IN {KEPT}")
def field_filter(spark, sf_dir):
    parsed = routing.parse_messages(messages(spark, sf_dir))
    kept = parsed.where("valid").where(routing.field_passes("data", "k", KEPT))
    return kept.select("message_id", F.element_at("data", "k").alias("k"))


@query(MESSAGES + f""" SELECT stream_key, outcome, count(*) AS n, count(*) FILTER (outcome <> 'failed') AS acked
FROM (SELECT stream_key, CASE WHEN NOT valid THEN 'invalid' WHEN k NOT IN {KEPT} THEN 'filtered'
        WHEN arrival % 5 = 0 THEN 'failed' ELSE 'published' END AS outcome FROM messages) GROUP BY ALL""")
def publish_outcome(spark, sf_dir):
    parsed = routing.parse_messages(messages(spark, sf_dir))
    planned = routing.plan_outcomes(parsed, "k", KEPT)
    sent = planned.where("outcome = 'publish'").select(
        "stream_key", "message_id", (F.col("arrival") % 5 > 0).alias("success")
    )
    return routing.outcome_counts(routing.settle_outcomes(planned, sent), ["stream_key"])


@query(MESSAGES + """ SELECT message_id, 'base/' || replace(stream_key, ':', '/') AS topic, stream_key AS stream,
  k, 0 AS qos, FALSE AS retain FROM messages WHERE valid""")
def publish_messages(spark, sf_dir):
    parsed = routing.parse_messages(messages(spark, sf_dir)).withColumn("stamp", F.lit("t"))
    out = routing.publish_messages(parsed, "base", "stamp")
    schema = "stream string, id string, data map<string,string>, timestamp string"
    return out.withColumn("p", F.from_json("payload", schema)).select(
        F.col("p.id").alias("message_id"), "topic", "p.stream",
        F.element_at("p.data", "k").alias("k"), "qos", "retain",
    )


@query(LOG + """ SELECT stream_key || ':' || message_id AS key, CASE WHEN characteristic = 'click' THEN 'clicks' ELSE 'rest' END AS topic,
  '{"char":"' || characteristic || '","v":"' || value_cents || '","_stream":"' || stream_key || '","_id":"' || message_id
  || '","_timestamp":' || (id_ms + 5) || '}' AS value FROM stream_log""")
def keyed_envelopes(spark, sf_dir):
    log = views.stream_log(spark, sf_dir)
    data = F.create_map(
        F.lit("char"), F.col("characteristic"), F.lit("v"), F.col("value_cents").cast("string"),
        F.lit("_id"), F.lit("overwritten"),
    )
    entries = log.withColumn("data", data).withColumn("stamp", F.col("id_ms") + 5)
    return routing.keyed_messages(entries, [("stream:click:*", "clicks")], "rest", "stamp")


def binary_entries(spark, sf_dir):
    """Entries with binary fields; some names and some values are not UTF-8."""
    k = F.col("event_id")
    bad = F.unhex(F.lit("FFFE"))
    name = F.when(k % 7 == 0, bad).otherwise(F.lit("type").cast("binary"))
    value = F.when(k % 11 == 0, F.concat(bad, F.col("event_type").cast("binary"))).otherwise(
        F.col("event_type").cast("binary")
    )
    return table(spark, sf_dir, "events").select(
        k.alias("n"), F.lit("s").alias("stream_key"), k.cast("string").alias("message_id"),
        F.create_map(name, value).alias("data"),
    )


@query("""SELECT event_id AS n, CASE WHEN event_id % 7 = 0 THEN 'field_fffe' ELSE 'type' END AS field, event_type AS value
FROM events WHERE event_id % 11 > 0""")
def byte_decode(spark, sf_dir):
    good = routing.deliverable(routing.decode_entries(binary_entries(spark, sf_dir)))
    return good.select("n", F.explode("data").alias("field", "value"))


@query("""SELECT event_id AS n, 'field_fffe' AS field, CASE WHEN event_id % 2 = 0 THEN 'by name' ELSE 'by bytes' END AS value FROM events
UNION ALL SELECT event_id, 'other', event_type FROM events""")
def field_clash(spark, sf_dir):
    """A field whose bytes are no text, and one that has the name it gets: the later stays."""
    k = F.col("event_id")
    raw, name = F.unhex(F.lit("FFFE")), F.lit("field_fffe").cast("binary")
    first, second = F.when(k % 2 == 0, raw).otherwise(name), F.when(k % 2 == 0, name).otherwise(raw)
    value = F.when(k % 2 == 0, "by name").otherwise("by bytes").cast("binary")
    data = F.create_map(
        first, F.lit("lost").cast("binary"), F.lit("other").cast("binary"), F.col("event_type").cast("binary"), second, value
    )
    rows = table(spark, sf_dir, "events").select(k.alias("n"), data.alias("data"))
    return routing.deliverable(routing.decode_entries(rows)).select("n", F.explode("data").alias("field", "value"))


@query("""SELECT event_id || '' AS message_id, CASE WHEN event_id % 7 = 0 THEN 'field_fffe' ELSE 'type' END AS field,
  'value is not UTF-8' AS reason, base64('\\xFF\\xFE'::BLOB || encode(event_type)) AS value_base64 FROM events WHERE event_id % 11 = 0""")
def dead_letters(spark, sf_dir):
    out = routing.dead_letters(routing.decode_entries(binary_entries(spark, sf_dir)))
    return out.drop("stream_key")


@query("""SELECT 'list' AS shape, user_id, unnest([event_id || '', event_type]) AS value FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'scalar', user_id, '' || event_id FROM events WHERE event_id % 3 = 1
UNION ALL SELECT 'table', user_id, event_id || '|' || event_type FROM events WHERE event_id % 3 = 2""")
def payload_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn(
        "items", F.array(F.col("event_id").cast("string"), "event_type")
    )
    lists = routing.list_records(e.where("event_id % 3 = 0"), "items", ["user_id"])
    scalars = routing.scalar_records(e.where("event_id % 3 = 1"), "event_id", ["user_id"])
    tables = routing.table_records(e.where("event_id % 3 = 2"), ["event_id", "event_type"], ["user_id"])
    row = F.from_json("value", "event_id bigint, event_type string")
    tables = tables.withColumn("r", row).select(
        "user_id", F.concat_ws("|", F.col("r.event_id").cast("string"), "r.event_type").alias("value")
    )
    return devices.merge_devices(
        lists.withColumn("shape", F.lit("list")), scalars.withColumn("shape", F.lit("scalar")),
        tables.withColumn("shape", F.lit("table")),
    )


@query("""SELECT doc_id, octet_length(encode(text)) AS bytes, CASE WHEN octet_length(encode(text)) = 0 THEN 'empty'
  WHEN octet_length(encode(text)) > 4000 THEN 'too_large' ELSE 'ok' END AS verdict FROM documents""")
def size_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return routing.size_gate(d, "text", 4000).select(
        "doc_id", F.octet_length("text").alias("bytes"), "verdict"
    )


@query("""SELECT page_id, md5(html) AS digest, length(html) AS n FROM pages""")
def json_body(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", exports.json_body("html").alias("body"))
    back = p.select("page_id", F.from_json("body", "data string").alias("b"))
    return back.select("page_id", F.md5("b.data").alias("digest"), F.length("b.data").alias("n"))


@query("""SELECT conv_id, '{"data":[' || string_agg('"' || role || '"', ',' ORDER BY turn) || ']}' AS body
FROM conversations GROUP BY conv_id""")
def json_list_body(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    roles = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return c.groupBy("conv_id").agg(roles.alias("roles")).select("conv_id", exports.json_body("roles").alias("body"))


@query("""SELECT event_id, CAST(0 AS INT) AS nth, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def payload_records_scalar(spark, sf_dir):
    """Each event's JSON text as a typed record."""
    records.register(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("packetloom_events")
    return spark.sql(f"SELECT event_id, r.nth, r.k FROM packetloom_events, LATERAL {records.NAME}(props, 'k INT') r")


@query("""SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS nth, turn, role,
  md5(text) AS digest FROM conversations""")
def payload_records_list(spark, sf_dir):
    """Conversations as one JSON list each, and back to typed rows."""
    records.register(spark)
    c = table(spark, sf_dir, "conversations")
    steps = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    c.groupBy("conv_id").agg(F.to_json(steps).alias("payload")).createOrReplaceTempView("packetloom_payloads")
    found = spark.sql(
        f"SELECT conv_id, r.* FROM packetloom_payloads, LATERAL {records.NAME}(payload, 'turn BIGINT, role STRING, text STRING') r"
    )
    return found.select("conv_id", "nth", "turn", "role", F.md5("text").alias("digest"))


# --- groups and health ---


def deliveries(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s:"), F.col("l_suppkey").cast("string")).alias("stream_key"),
        F.col("l_returnflag").alias("grp"), F.col("l_linenumber").alias("consumer"),
        F.col("l_orderkey").alias("id_ms"), F.col("l_linenumber").cast("bigint").alias("id_seq"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("message_id"),
        (F.col("l_linestatus") == "F").alias("acked"), F.col("l_quantity").alias("quantity"),
    )


DELIVERED = """WITH deliveries AS (SELECT 's:' || l_suppkey AS stream_key, l_returnflag AS grp,
  l_linenumber AS consumer, l_orderkey || '-' || l_linenumber AS message_id,
  l_orderkey * 100 + l_linenumber AS rank, l_linestatus = 'F' AS acked FROM lineitem),
groups AS (SELECT stream_key, grp, count(*) FILTER (NOT acked) AS pending, count(DISTINCT consumer) AS consumers,
  arg_max(message_id, rank) AS last_delivered_id FROM deliveries GROUP BY ALL)"""


@query(DELIVERED + """ SELECT DISTINCT stream_key, grp, message_id FROM deliveries d WHERE NOT EXISTS (
  SELECT 1 FROM deliveries a WHERE a.acked AND a.stream_key = d.stream_key AND a.grp = d.grp AND a.message_id = d.message_id)""")
def pending(spark, sf_dir):
    d = deliveries(spark, sf_dir)
    out = health.pending(d, d.where("acked"))
    return out.select("stream_key", "grp", "message_id").distinct()


@query(DELIVERED + " SELECT stream_key, grp, count(DISTINCT message_id) AS acked FROM deliveries WHERE acked GROUP BY ALL")
def ack_counts(spark, sf_dir):
    d = deliveries(spark, sf_dir)
    return health.ack_counts(d, d.where("acked"))


@query(DELIVERED + """ SELECT stream_key, grp, consumer, count(*) AS delivered,
  count(*) FILTER (NOT acked) AS pending FROM deliveries GROUP BY ALL""")
def consumer_stats(spark, sf_dir):
    return health.consumer_stats(deliveries(spark, sf_dir)).drop("hi")


@query(DELIVERED + " SELECT stream_key, grp, pending, consumers, last_delivered_id FROM groups")
def group_stats(spark, sf_dir):
    return health.group_stats(deliveries(spark, sf_dir))


@query(LOG + """ SELECT stream_key, count(*) AS length, min_by(message_id, id_seq) AS first_id,
  max_by(message_id, id_seq) AS last_id FROM stream_log GROUP BY ALL""")
def stream_stats(spark, sf_dir):
    return streamlog.stream_stats(views.stream_log(spark, sf_dir))


@query(DELIVERED + " SELECT stream_key, grp, pending, consumers, last_delivered_id FROM groups")
def kept_groups(spark, sf_dir):
    """Group statistics kept over three batches; acknowledgements come a batch later."""
    d = deliveries(spark, sf_dir)
    store = keptstats.group_store(spark, shared_folder(spark, "kept-groups"), fanout=2)
    for batch in range(4):
        acked = d.where((F.col("id_ms") % 3 == batch - 1) & F.col("acked")) if batch else None
        keptstats.add_deliveries(store, batch, d.where(F.col("id_ms") % 3 == batch), acked)
    return keptstats.group_stats(store)


def _health_inputs(spark, sf_dir):
    """Suppliers as streams (every ninth absent, every seventh trimmed to nothing).

    Each existing stream has four registered groups, of which 'X' was never
    delivered anything; the registered consumers are those with certain lines.
    """
    k = F.col("s_suppkey")
    name = F.concat(F.lit("s:"), k.cast("string")).alias("stream_key")
    s = table(spark, sf_dir, "supplier")
    existing = s.where(k % 9 > 0).select(name)
    d = deliveries(spark, sf_dir)
    entries = d.where(F.substring("stream_key", 3, 20).cast("bigint") % 7 > 0)
    stats = streamlog.with_empty(streamlog.stream_stats(entries), existing)
    names = F.array(*[F.lit(g) for g in "ANRX"])
    groups = existing.select("stream_key", F.explode(names).alias("grp"))
    consumers = d.where("quantity = 50 AND consumer <= 3")
    return s.select(name), stats, health.group_stats(d, groups, consumers)


HEALTH = DELIVERED + """, listed AS (SELECT 's:' || l_suppkey AS stream_key, l_returnflag AS grp, count(DISTINCT l_linenumber) AS n
  FROM lineitem WHERE l_quantity = 50 AND l_linenumber <= 3 GROUP BY ALL),
registered AS (SELECT 's:' || s_suppkey AS stream_key, unnest(['A', 'N', 'R', 'X']) AS grp FROM supplier WHERE s_suppkey % 9 > 0),
shown AS (SELECT r.stream_key, r.grp, coalesce(g.pending, 0) AS pending, coalesce(l.n, 0) AS consumers
  FROM registered r LEFT JOIN groups g ON g.stream_key = r.stream_key AND g.grp = r.grp
  LEFT JOIN listed l ON l.stream_key = r.stream_key AND l.grp = r.grp),
sizes AS (SELECT stream_key, count(*) AS n, arg_min(message_id, rank) AS first_id, arg_max(message_id, rank) AS last_id
  FROM deliveries WHERE CAST(substr(stream_key, 3) AS BIGINT) % 7 > 0 GROUP BY ALL),
stats AS (SELECT 's:' || s_suppkey AS stream_key, coalesce(n, 0) AS length, first_id, last_id
  FROM supplier LEFT JOIN sizes ON stream_key = 's:' || s_suppkey WHERE s_suppkey % 9 > 0),
flags AS (SELECT stream_key, count(*) AS groups, count(*) FILTER (consumers = 0) AS idle, count(*) FILTER (pending > 100) AS late
  FROM shown GROUP BY ALL),
health AS (SELECT c.stream_key, length, coalesce(groups, 0) AS groups,
  CASE WHEN length IS NULL THEN 'NOT_FOUND' WHEN length > 0 AND coalesce(idle, 0) + coalesce(late, 0) = 0 THEN 'HEALTHY'
       WHEN coalesce(idle, 0) > 0 THEN 'WARNING' WHEN coalesce(late, 0) > 0 THEN 'DEGRADED' ELSE 'WARNING' END AS status,
  CASE WHEN length IS NULL THEN 1 ELSE coalesce(idle, 0) + coalesce(late, 0) + CAST(length = 0 AS INT) END AS issues
  FROM (SELECT 's:' || s_suppkey AS stream_key FROM supplier) c
  LEFT JOIN stats ON stats.stream_key = c.stream_key LEFT JOIN flags ON flags.stream_key = c.stream_key)"""


@query(HEALTH + " SELECT * FROM health")
def stream_health(spark, sf_dir):
    return health.stream_health(*_health_inputs(spark, sf_dir))


@query(HEALTH + """ SELECT stream_key, NULL AS grp, 'Stream does not exist' AS issue FROM health WHERE length IS NULL
UNION ALL SELECT stream_key, NULL, 'Stream is empty' FROM health WHERE length = 0
UNION ALL SELECT stream_key, grp, 'Consumer group ''' || grp || ''' has no consumers' FROM shown
  WHERE consumers = 0 AND stream_key IN (SELECT stream_key FROM stats)
UNION ALL SELECT stream_key, grp, 'Consumer group ''' || grp || ''' has high pending count: ' || pending FROM shown
  WHERE pending > 100 AND stream_key IN (SELECT stream_key FROM stats)""")
def stream_issues(spark, sf_dir):
    return health.stream_issues(*_health_inputs(spark, sf_dir))


@query(HEALTH + """ SELECT stream_key, 0 AS line, 'Stream: ' || stream_key || ' | Status: ' || status || ' | Length: '
  || coalesce(length, 0) || ' | Consumer Groups: ' || groups AS text FROM health
UNION ALL SELECT stream_key, 1, '  Group: ' || grp || ' | Consumers: ' || consumers || ' | Pending: ' || pending FROM shown
  WHERE stream_key IN (SELECT stream_key FROM health)""")
def health_report(spark, sf_dir):
    configured, stats, groups = _health_inputs(spark, sf_dir)
    return health.health_report(health.stream_health(configured, stats, groups), groups)


@query(HEALTH + """ SELECT c.stream_key, s.length IS NOT NULL AS is_valid,
  CASE WHEN s.length IS NULL THEN 'Stream does not exist' WHEN s.length = 0 THEN 'Stream exists but is empty'
       ELSE 'Stream is valid' END AS reason, s.length,
  CASE WHEN s.length > 0 THEN first_id END AS first_id, CASE WHEN s.length > 0 THEN last_id END AS last_id,
  CASE WHEN s.length > 0 THEN c.groups END AS group_count
FROM health c LEFT JOIN stats s ON s.stream_key = c.stream_key""")
def validate_streams(spark, sf_dir):
    return health.validate_streams(*_health_inputs(spark, sf_dir))


@query(LOG + """ SELECT 'messages_synced' AS metric, count(*) FILTER (arrival % 50 > 0) AS value FROM stream_log
UNION ALL SELECT 'errors', count(*) FILTER (arrival % 50 = 0) FROM stream_log
UNION ALL SELECT 'last_sync_ms', max(id_ms) FROM stream_log
UNION ALL SELECT 'discovered_streams', count(DISTINCT stream_key) FROM stream_log
UNION ALL SELECT 'key_values_synced', count(*) FROM orders""")
def run_metrics(spark, sf_dir):
    log = views.stream_log(spark, sf_dir).withColumn("ok", F.col("arrival") % 50 > 0)
    return health.run_metrics(log, table(spark, sf_dir, "orders").select("o_orderkey"))


# --- devices ---


def _typed_customers(spark, sf_dir):
    kinds = F.array(*[F.lit(n) for n in ("skiin", "pressure_bed", "insole", "undefined", "toaster")])
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.get(kinds, (F.col("c_custkey") % 5).cast("int")).alias("device"), "c_mktsegment", "c_nationkey"
    )


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 15 END AS device_db,
  CASE c_custkey % 5 WHEN 0 THEN 'ecg,acc,gyro,cbt,activity' WHEN 1 THEN 'press' WHEN 2 THEN 'press,imu,imu_sflp'
       WHEN 3 THEN 'unknown' END AS chars FROM customer""")
def registry_join(spark, sf_dir):
    out = devices.with_registry(_typed_customers(spark, sf_dir))
    return out.select("c_custkey", "device_db", F.array_join("device_chars", ",").alias("chars"))


@query("SELECT c_custkey, 'unknown device' AS reason FROM customer WHERE c_custkey % 5 = 4")
def unregistered(spark, sf_dir):
    return devices.unregistered(_typed_customers(spark, sf_dir)).select("c_custkey", "reason")


@query("""SELECT event_id, CASE WHEN c_custkey IS NOT NULL AND user_id % 4 <> 1 THEN c_name ELSE 'unknown' END AS uid,
  CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE 'unknown' END AS nn
FROM events LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 3 <> 0""")
def session_enrich(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("device_id"),
        F.when(F.col("c_custkey") % 4 != 1, F.col("c_name")).alias("uid"), F.col("c_mktsegment").alias("nn"),
    )
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("device_id"))
    return devices.with_session(e, c).drop("device_id")


@query("""SELECT 'events' AS device, event_id AS n, user_id AS who FROM events
UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders""")
def device_union(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.lit("events").alias("device"), F.col("event_id").alias("n"), F.col("user_id").alias("who")
    )
    o = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("device"), F.col("o_custkey").alias("who"), F.col("o_orderkey").alias("n")
    )
    return devices.merge_devices(e, o)


SERVICES = [("skiin", "A-FURNITURE"), ("pressure_bed", "B-BUILDING"), ("insole", "A-MACHINERY")]


def _ads(spark, sf_dir):
    """Customers as advertisements: two service ids each, in mixed case."""
    c = table(spark, sf_dir, "customer")
    own = F.concat(F.when(F.col("c_custkey") % 2 == 0, "a-").otherwise("b-"), F.lower("c_mktsegment"))
    return c.select(
        F.col("c_nationkey").cast("bigint").alias("scan"), "c_custkey",
        F.col("c_name").alias("address"), F.array(own, F.lit("0000-x")).alias("uuids"),
    )


MODALITY = """CASE WHEN c_custkey % 2 = 0 AND c_mktsegment = 'FURNITURE' THEN 'skiin'
  WHEN c_custkey % 2 = 1 AND c_mktsegment = 'BUILDING' THEN 'pressure_bed'
  WHEN c_custkey % 2 = 0 AND c_mktsegment = 'MACHINERY' THEN 'insole' ELSE 'unknown_device_type' END"""


@query(f"""SELECT c_custkey, {MODALITY} AS modality FROM customer WHERE {MODALITY} <> 'unknown_device_type'""")
def advertised(spark, sf_dir):
    return devices.advertised(_ads(spark, sf_dir), SERVICES).select("c_custkey", "modality")


@query(f"""SELECT CAST(c_nationkey AS BIGINT) AS scan, count(*) AS devices, arg_min(c_name, c_custkey) AS address,
  arg_min({MODALITY}, c_custkey) AS modality FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment = 'AUTOMOBILE' GROUP BY ALL
UNION ALL SELECT -1 - CAST(c_nationkey AS BIGINT), count(*), arg_min(c_name, c_custkey), arg_min({MODALITY}, c_custkey)
FROM customer WHERE {MODALITY} <> 'unknown_device_type' GROUP BY ALL""")
def modality(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    one = devices.advertised(ads, SERVICES, target="a-Automobile")
    any_known = devices.advertised(ads, SERVICES).withColumn("scan", -1 - F.col("scan"))
    return devices.scan_result(one, ["scan"], "c_custkey").unionByName(
        devices.scan_result(any_known, ["scan"], "c_custkey")
    )


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN 'frames' WHEN 2 THEN 'samples' ELSE 'generic' END AS handled_by FROM customer""")
def modality_dispatch(spark, sf_dir):
    def rule(name):
        return lambda df: df.withColumn("handled_by", F.lit(name))

    rows = _typed_customers(spark, sf_dir).withColumnRenamed("device", "modality")
    out = devices.dispatch(rows, {"pressure_bed": rule("frames"), "insole": rule("samples")}, rule("generic"))
    return out.select("c_custkey", "handled_by")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN ' command was successful' ELSE
  CASE o_orderkey % 10 WHEN 0 THEN ' command was successful' WHEN 1 THEN ' command failed, reason: invalid opcode'
  WHEN 2 THEN ' command failed, reason: invalid arguments' WHEN 3 THEN ' command failed, reason: invalid command'
  WHEN 4 THEN ' command failed, reason: invalid argument' WHEN 5 THEN ' command failed, reason: command error'
  WHEN 6 THEN ' command failed, reason: invalid state' ELSE 'Invalid Status' END END AS message FROM orders""")
def command_status(spark, sf_dir):
    k = F.col("o_orderkey") % 10
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", status_text(F.when(k != 9, k)).alias("message")
    )


@query("""SELECT p_partkey, CASE v WHEN '0.0.0' THEN 100 WHEN '0.1.0' THEN 100 WHEN '0.2.0' THEN 100 WHEN '0.2.100' THEN 100
  WHEN '0.2.1' THEN 1802 WHEN '0.3.0' THEN 6250 ELSE 9091 END AS rate
FROM (SELECT p_partkey, ['0.0.0','0.1.0','0.2.0','0.2.100','0.2.1','0.3.0','1.0.0'][1 + p_partkey % 7] AS v FROM part)""")
def firmware_rate(spark, sf_dir):
    names = ["0.0.0", "0.1.0", "0.2.0", "0.2.100", "0.2.1", "0.3.0", "1.0.0"]
    v = F.get(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % 7).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", sampling_rate(v).alias("rate"))
