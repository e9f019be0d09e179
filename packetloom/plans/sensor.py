"""Queries over sensor packets and frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions.binary import float32_at
from packetloom.functions.filters import filter_frame, reshape_frame
from packetloom.functions.payloads import join_samples, split_samples
from packetloom.operators import devices, frames, packets
from packetloom.operators.ordered import with_hot_chunks
from packetloom.plans import views
from packetloom.plans.registry import query
from packetloom.plans.views import table, with_sql

KEYS = ["device"]
TRACKED = ("packets", "gated", "losses")


def tracked(spark, sf_dir, mode="reference"):
    """Packets with their losses; all packets where losses are not looked for."""
    return packets.track(views.packets(spark, sf_dir, lossy=mode != "off"), KEYS, "event_id", mode)


@query(with_sql("all_packets", "gated") + " SELECT device, seq, trig FROM gated")
def start_gate(spark, sf_dir):
    gated = packets.start_gate(views.packets(spark, sf_dir, lossy=False), KEYS, "event_id")
    return gated.select("device", "seq", "trig")


@query(
    with_sql("all_packets", "gated")
    + """ SELECT device, seq, c, array_to_string(
         [(event_id * 31 + (c * 24 + (i % 6) * 4 + i // 6) * 17) % 1000 - 100 for i in range(24)], ', ') AS samples
  FROM gated, (SELECT unnest(range(4)) AS c)"""
)
def rows_deinterleaved(spark, sf_dir):
    gated = packets.start_gate(views.packets(spark, sf_dir, lossy=False), KEYS, "event_id")
    rows = packets.packet_rows(gated, ["device", "seq"])
    return rows.select("device", "seq", F.col("c").cast("bigint"), join_samples("row").alias("samples"))


@query(with_sql(*TRACKED) + " SELECT device, seq, trig, CAST(lost AS BIGINT) AS lost FROM tracked")
def packet_loss(spark, sf_dir):
    return tracked(spark, sf_dir).select("device", "seq", "trig", F.col("lost").cast("bigint"))


@query(
    with_sql(*TRACKED)
    + """ SELECT device, seq, trig, CAST(CASE WHEN prev IS NULL OR pos = prev THEN 0
            ELSE (pos - prev - 1 + 30) % 15 END AS BIGINT) AS lost FROM tracked"""
)
def packet_loss_modular(spark, sf_dir):
    return tracked(spark, sf_dir, "modular").select(
        "device", "seq", "trig", F.col("lost").cast("bigint")
    )


@query(with_sql(*TRACKED) + " SELECT device, seq, CAST(loss_total AS BIGINT) AS loss_total FROM tracked")
def loss_total(spark, sf_dir):
    return tracked(spark, sf_dir).select("device", "seq", F.col("loss_total").cast("bigint"))


@query(
    with_sql(*TRACKED)
    + """ SELECT device, CAST(row_idx AS BIGINT) AS row_idx,
            array_to_string(cells, ', ') AS samples FROM rows_ WHERE is_gap"""
)
def gap_rows(spark, sf_dir):
    rows = packets.gap_rows(tracked(spark, sf_dir), KEYS)
    return rows.select("device", "row_idx", join_samples("row").alias("samples"))


@query(
    with_sql(*TRACKED)
    + " SELECT device, CAST(frame_id AS BIGINT) AS frame_id, gap_rows, samples FROM frames"
)
def frames_assembled(spark, sf_dir):
    out = frames.assemble(tracked(spark, sf_dir), KEYS)
    gaps = F.size(F.filter("frame", lambda row: row[0] == packets.LOST_VALUE)).cast("bigint")
    return out.select("device", "frame_id", gaps.alias("gap_rows"), frames.frame_text().alias("samples"))


FRAME_SUMS = """,
sums AS (
  SELECT device, row_idx // 15 AS frame_id, CAST(sum(list_sum(cells)) AS BIGINT) AS frame_sum
  FROM rows_ WHERE row_idx // 15 < (rows_total - 1) // 15 GROUP BY ALL)"""


def _frame_sum():
    return F.aggregate(F.flatten("frame"), F.lit(0).cast("bigint"), lambda a, v: a + v)


def _with_sum(shown):
    return shown.select(
        "device", "seq", "frame_id",
        F.when(F.col("frame_id") >= 0, _frame_sum()).alias("frame_sum"),
    )


@query(
    with_sql(*TRACKED) + FRAME_SUMS
    + """ SELECT t.device, t.seq, t.frame_id, s.frame_sum
  FROM (SELECT device, seq, greatest(CAST((row_end - 1) // 15 AS BIGINT) - 1, -1) AS frame_id FROM tracked) t
  LEFT JOIN sums s ON s.device = t.device AND s.frame_id = t.frame_id"""
)
def frame_per_packet(spark, sf_dir):
    return _with_sum(frames.frame_per_packet(tracked(spark, sf_dir), KEYS))


@query(
    with_sql(*TRACKED) + FRAME_SUMS
    + """ SELECT t.device, t.seq, t.frame_id, s.frame_sum
  FROM (SELECT *, lag(frame_id) OVER (PARTITION BY device ORDER BY event_id) AS before
        FROM (SELECT device, seq, event_id,
                     greatest(CAST((row_end - 1) // 15 AS BIGINT) - 1, -1) AS frame_id FROM tracked)) t
  JOIN sums s ON s.device = t.device AND s.frame_id = t.frame_id
  WHERE t.frame_id > coalesce(t.before, -1)"""
)
def new_frames(spark, sf_dir):
    return _with_sum(frames.new_frames(tracked(spark, sf_dir), KEYS))


@query(
    with_sql("all_packets", "gated")
    + """, numbered AS (
  SELECT device, event_id, row_number() OVER (PARTITION BY device ORDER BY event_id) - 1 AS n FROM gated),
series AS (
  SELECT device, j % 4 AS channel,
         row_number() OVER (PARTITION BY device, j % 4 ORDER BY n, j) - 1 AS t_idx,
         (event_id * 31 + j * 17) % 1000 - 100 AS v
  FROM numbered, (SELECT unnest(range(96)) AS j))
SELECT device, channel, count(*) AS n, CAST(max(t_idx) AS BIGINT) AS last_t,
       CAST(sum(v) AS BIGINT) AS total, CAST(sum(v * (t_idx % 1009)) AS BIGINT) AS weighted
FROM series GROUP BY ALL"""
)
def channel_series(spark, sf_dir):
    s = frames.channel_series(tracked(spark, sf_dir, "off"), KEYS)
    zero = F.lit(0).cast("bigint")
    at = F.transform("samples", lambda v, i: v * ((F.col("t_idx") + i) % 1009))
    return s.groupBy("device", F.col("channel").cast("bigint").alias("channel")).agg(
        F.sum(F.size("samples")).alias("n"),
        F.max(F.col("t_idx") + F.size("samples") - 1).alias("last_t"),
        F.sum(F.aggregate("samples", zero, lambda a, v: a + v)).alias("total"),
        F.sum(F.aggregate(at, zero, lambda a, v: a + v)).alias("weighted"),
    )


@query(
    with_sql("odd_packets", "gated", "losses")
    + """ SELECT device, CAST(frame_id AS BIGINT) AS frame_id, gap_rows, samples FROM frames"""
)
def frames_per_session(spark, sf_dir):
    """Frames where sessions end and triggers repeat, are unknown or out of the cycle."""
    keys = ["device", "session"]
    out = frames.assemble(packets.track(views.odd_packets(spark, sf_dir), keys, "event_id"), keys)
    gaps = F.size(F.filter("frame", lambda row: row[0] == packets.LOST_VALUE)).cast("bigint")
    name = F.concat_ws("/", F.col("device").cast("string"), F.col("session").cast("string"))
    return out.select(name.alias("device"), "frame_id", gaps.alias("gap_rows"), frames.frame_text().alias("samples"))


@query(
    with_sql(*TRACKED)
    + """ SELECT 'frames' AS handled_by, device, count(*) AS n FROM frames WHERE device % 3 = 0 GROUP BY ALL
UNION ALL SELECT 'batches', device, count(*) // 64 FROM packets WHERE device % 3 = 1 GROUP BY ALL HAVING count(*) >= 64
UNION ALL SELECT 'generic', device, count(*) FROM packets WHERE device % 3 = 2 GROUP BY ALL"""
)
def dispatch_by_modality(spark, sf_dir):
    """Beds get frames, insoles batches of samples, all others are counted."""

    def beds(rows):
        made = frames.assemble(packets.track(rows, KEYS, "event_id"), KEYS)
        return made.groupBy("device").agg(F.count(F.lit(1)).alias("n")).withColumn("handled_by", F.lit("frames"))

    def insoles(rows):
        made = frames.count_batches(rows, KEYS, "event_id", 64)
        return made.groupBy("device").agg((F.max("batch_no") + 1).alias("n")).withColumn("handled_by", F.lit("batches"))

    def others(rows):
        return rows.groupBy("device").agg(F.count(F.lit(1)).alias("n")).withColumn("handled_by", F.lit("generic"))

    kinds = F.array(*[F.lit(n) for n in ("pressure_bed", "insole", "toaster")])
    rows = views.packets(spark, sf_dir).withColumn("modality", F.get(kinds, (F.col("device") % 3).cast("int")))
    out = devices.dispatch(rows, {"pressure_bed": beds, "insole": insoles}, others)
    return out.select("handled_by", "device", "n")


@query("""SELECT event_id, CASE WHEN event_id % 97 = 8 THEN 'missing session key or order' ELSE 'unknown trigger line' END AS reason
FROM events WHERE event_id % 11 <> 4 AND (event_id % 97 = 8 OR event_id % 41 = 7)""")
def packet_rejects(spark, sf_dir):
    out = packets.reject_unknown(views.odd_packets(spark, sf_dir), ["device", "session"], "event_id")
    return out.select("event_id", "reason")


def _samples(spark, sf_dir, device):
    e = table(spark, sf_dir, "events").select(
        F.col(device).alias("device"), "event_id", views.cents("value").alias("v")
    )
    return with_hot_chunks(e, ["device"], "event_id")


def _batch_summary(batches):
    return batches.groupBy("device", "batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"), F.sum("v").alias("total"),
    )


BATCH_SQL = """
SELECT device, batch_no, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id,
       CAST(sum(v) AS BIGINT) AS total
FROM (SELECT {device} AS device, event_id, CAST(round(value * 100) AS BIGINT) AS v,
             (row_number() OVER (PARTITION BY {device} ORDER BY event_id) - 1) // {size} AS batch_no,
             count(*) OVER (PARTITION BY {device}) AS total_n FROM events)
WHERE {keep} GROUP BY ALL"""


@query(BATCH_SQL.format(device="event_type", size=375, keep="batch_no < total_n // 375"))
def count_batches(spark, sf_dir):
    s = _samples(spark, sf_dir, "event_type")
    return _batch_summary(frames.count_batches(s, KEYS, "event_id"))


@query(BATCH_SQL.format(device="user_id", size=64, keep="true"))
def dump_batches(spark, sf_dir):
    s = _samples(spark, sf_dir, "user_id")
    return _batch_summary(
        frames.count_batches(s, KEYS, "event_id", frames.DUMP_SAMPLES, force_save=True)
    )


@query(
    """SELECT epoch_us(ts) // 1000 || '' AS timestamp_python, event_id * 10 AS ts_board,
       event_id AS packet_counter, user_id || ', ' || CAST(round(value * 100) AS BIGINT) AS imu_data
FROM events"""
)
def sample_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        views.epoch_ms("ts").cast("string").alias("arrived"),
        (F.col("event_id") * 10).alias("ts_board"), F.col("event_id").alias("packet_counter"),
        F.array(F.col("user_id"), views.cents("value")).alias("imu_data"),
    )
    return frames.sample_records(e, "imu_data", "arrived").withColumn(
        "imu_data", join_samples("imu_data")
    )


@query(
    """SELECT event_id, CAST(list_sum([(event_id * 31 + j * 17) % 1000 - 100 for j in range(96)]) AS BIGINT) AS total, 96 AS n FROM events"""
)
def samples_text_roundtrip(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id",
        split_samples(
            join_samples(
                F.transform(
                    F.sequence(F.lit(0), F.lit(95)),
                    lambda j: (F.col("event_id") * 31 + j * 17) % 1000 - 100,
                )
            )
        ).alias("s"),
    )
    total = F.aggregate("s", F.lit(0).cast("bigint"), lambda a, v: a + v)
    return e.select("event_id", total.alias("total"), F.size("s").alias("n"))


def _le16_hex(v):
    low = F.lpad(F.hex(F.pmod(v, F.lit(65536))), 4, "0")
    return F.concat(F.substring(low, 3, 2), F.substring(low, 1, 2))


@query(
    """WITH bytes AS (SELECT event_id, user_id,
  sha256('0:' || event_id) || sha256('1:' || event_id) || sha256('2:' || event_id)
  || sha256('3:' || event_id) || sha256('4:' || event_id) || sha256('5:' || event_id) AS h FROM events),
numbers AS (SELECT event_id, user_id, [CAST('0x' || substr(h, 4 * j + 3, 2) || substr(h, 4 * j + 1, 2) AS INT)
  for j in range(96)] AS u FROM bytes)
SELECT event_id, user_id % 24 AS read_line, event_id % 16 AS trig,
       array_to_string([CASE WHEN v >= 32768 THEN v - 65536 ELSE v END for v in u], ', ') AS samples FROM numbers"""
)
def packet_decode(spark, sf_dir):
    """Raw packets of two header bytes and 192 hashed bytes."""
    body = [F.sha2(F.concat(F.lit(f"{k}:"), F.col("event_id").cast("string")), 256) for k in range(6)]
    head = [F.lpad(F.hex(F.col(c) % n), 2, "0") for c, n in (("user_id", 24), ("event_id", 16))]
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.unhex(F.concat(*head, *body)).alias("packet")
    )
    return packets.decode_packets(raw).select(
        "event_id", F.col("read_line").cast("bigint"), F.col("trig").cast("bigint"),
        join_samples("pressure").alias("samples"),
    )


@query(
    """SELECT event_id, lower(printf('%03x', user_id)) AS part, '9880' AS char_id, 194 AS length
FROM events WHERE event_type <> 'error'"""
)
def header_decode(spark, sf_dir):
    char = F.when(F.col("event_type") == "error", "A098").otherwise("8098")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.unhex(F.concat(_le16_hex(F.col("user_id")), char, F.lit("C200"))).alias("header"),
    )
    return packets.decode_headers(raw).select("event_id", "part", "char_id", "length")


BITS = "((event_id * 40503 * 65537) % 4294967296)"


@query(
    f"""SELECT event_id, CASE WHEN e = 255 THEN NULL
  WHEN e = 0 THEN s * (f / 8388608.0::DOUBLE) * pow(2.0::DOUBLE, -126)
  ELSE s * (1 + f / 8388608.0::DOUBLE) * pow(2.0::DOUBLE, e - 127) END AS value
FROM (SELECT event_id, CASE WHEN bits >= 2147483648 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS s,
             (bits // 8388608) % 256 AS e, CAST(bits % 8388608 AS DOUBLE) AS f
      FROM (SELECT event_id, {BITS} AS bits FROM events))"""
)
def float_bits(spark, sf_dir):
    text = F.lpad(F.hex(F.expr(BITS)), 8, "0")
    swapped = F.concat(*[F.substring(text, k, 2) for k in (7, 5, 3, 1)])
    raw = table(spark, sf_dir, "events").select("event_id", F.unhex(swapped).alias("raw"))
    v = float32_at("raw", 0)
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    return raw.select("event_id", F.when(finite, v).alias("value"))


@query(
    """SELECT p_partkey, (p_partkey % 3) || '.' || (p_size % 4) || '.' || (p_partkey % 200) AS firmware,
       (p_partkey % 101) || '%' AS battery FROM part"""
)
def module_info(spark, sf_dir):
    def byte(c):
        return F.lpad(F.hex(c.cast("bigint")), 2, "0")

    k, size = F.col("p_partkey"), F.col("p_size")
    info = F.unhex(
        F.concat(byte(k % 3), byte(size % 4), byte(k % 200), F.lit("00000000"), byte(k % 101))
    )
    return devices.module_info(
        table(spark, sf_dir, "part").select("p_partkey", info.alias("info"))
    ).select("p_partkey", "firmware", "battery")


OPCODES = [("CONFIG_SENSOR", "0101"), ("READ_SENSOR_CFG", "0102"), ("START", "0200")]


@query(
    """SELECT o_orderkey, CASE WHEN n < 4 THEN NULL WHEN k = 0 THEN 'CONFIG_SENSOR'
         WHEN k = 1 THEN 'READ_SENSOR_CFG' WHEN k = 2 THEN 'START' END AS opcode,
       CASE WHEN n >= 4 THEN status END AS status,
       CASE WHEN n >= 4 AND k IN (0, 1) AND sys = 0 THEN 0 END AS system,
       CASE WHEN n >= 4 AND k IN (0, 1) AND sys = 0 THEN 1.5::DOUBLE + o_orderkey % 2 END AS value,
       coalesce(CASE WHEN n >= 4 THEN CASE k WHEN 0 THEN 'CONFIG_SENSOR' WHEN 1 THEN 'READ_SENSOR_CFG'
                  WHEN 2 THEN 'START' END END, 'None')
       || CASE coalesce(CASE WHEN n >= 4 THEN status END, 0)
            WHEN 0 THEN ' command was successful'
            WHEN 1 THEN ' command failed, reason: invalid opcode'
            WHEN 2 THEN ' command failed, reason: invalid arguments'
            WHEN 3 THEN ' command failed, reason: invalid command'
            WHEN 4 THEN ' command failed, reason: invalid argument'
            WHEN 5 THEN ' command failed, reason: command error'
            WHEN 6 THEN ' command failed, reason: invalid state' ELSE 'Invalid Status' END AS message
FROM (SELECT o_orderkey, o_orderkey % 4 AS k, CAST(o_orderkey % 9 AS INT) AS status,
             o_custkey % 2 AS sys, CASE WHEN o_orderkey % 10 = 0 THEN 3 ELSE 9 END AS n FROM orders)"""
)
def response_decode(spark, sf_dir):
    key = F.col("o_orderkey")
    code = F.get(F.array(*[F.lit(c) for c in ("0101", "0102", "0200", "0F0F")]), (key % 4).cast("int"))
    # 1.5 and 2.5 as little-endian single precision
    number = F.when(key % 2 == 0, "0000C03F").otherwise("00002040")
    text = F.concat(
        code, F.lpad(F.hex(key % 9), 2, "0"), F.lpad(F.hex(F.col("o_custkey") % 2), 2, "0"),
        number, F.lit("AA"),
    )
    short = F.when(key % 10 == 0, F.substring(text, 1, 6)).otherwise(text)
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.unhex(short).alias("response"))
    return devices.response_decode(raw, OPCODES).select(
        "o_orderkey", "opcode", "status", "system", "value", "message"
    )


def _embedding_frames(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", reshape_frame("embedding", 8, 8).alias("frame")
    )


def _long(df):
    rows = df.select("vec_id", F.posexplode("frame").alias("r", "row"))
    cells = rows.select("vec_id", "r", F.posexplode("row").alias("c", "v"))
    return cells.select(
        "vec_id", F.col("r").cast("bigint"), F.col("c").cast("bigint"), F.round("v", 6).alias("v")
    )


FRAME_SQL = """cells AS (
  SELECT vec_id, i // 8 AS r, i % 8 AS c, CAST(embedding[i + 1] AS DOUBLE) AS v
  FROM embeddings, (SELECT unnest(range(64)) AS i)),
median3 AS (
  SELECT a.vec_id, a.r, a.c, quantile_disc(b.v, 0.5) AS v
  FROM cells a, (SELECT unnest(range(3)) - 1 AS dr) x, (SELECT unnest(range(3)) - 1 AS dc) y
  JOIN cells b ON b.vec_id = a.vec_id
   AND b.r = greatest(0, least(7, a.r + x.dr)) AND b.c = greatest(0, least(7, a.c + y.dc))
  GROUP BY ALL),
kernel AS (
  SELECT d, exp(-d * d / 2.0) / sum(exp(-d * d / 2.0)) OVER () AS w
  FROM (SELECT unnest(range(9)) - 4 AS d)),
down AS (
  SELECT a.vec_id, a.r, a.c, sum(k.w * b.v) AS v
  FROM median3 a, kernel k JOIN median3 b ON b.vec_id = a.vec_id AND b.c = a.c
   AND b.r = CASE WHEN (a.r + k.d + 16) % 16 < 8 THEN (a.r + k.d + 16) % 16
                  ELSE 15 - (a.r + k.d + 16) % 16 END GROUP BY ALL),
gauss AS (
  SELECT a.vec_id, a.r, a.c, sum(k.w * b.v) AS v
  FROM down a, kernel k JOIN down b ON b.vec_id = a.vec_id AND b.r = a.r
   AND b.c = CASE WHEN (a.c + k.d + 16) % 16 < 8 THEN (a.c + k.d + 16) % 16
                  ELSE 15 - (a.c + k.d + 16) % 16 END GROUP BY ALL),
limits AS (SELECT vec_id, quantile_cont(v, {p}) AS lim FROM gauss GROUP BY ALL)"""


def _frame_sql(body, p=0.05):
    return "WITH " + FRAME_SQL.format(p=p) + body


@query(_frame_sql(" SELECT vec_id, r, c, round(v, 6) + 0.0 AS v FROM median3"))
def median_frame(spark, sf_dir):
    f = filter_frame("frame", gaussian=False)
    return _long(_embedding_frames(spark, sf_dir).select("vec_id", f.alias("frame")))


@query(_frame_sql(" SELECT vec_id, r, c, round(v, 6) + 0.0 AS v FROM gauss"))
def gaussian_frame(spark, sf_dir):
    return _long(_embedding_frames(spark, sf_dir).select("vec_id", filter_frame("frame").alias("frame")))


FLOOR_SQL = """ SELECT g.vec_id, r, c, round(CASE WHEN v < lim - 1e-12 THEN 0 ELSE v END, 6) + 0.0 AS v
FROM gauss g JOIN limits l ON l.vec_id = g.vec_id"""


@query(_frame_sql(FLOOR_SQL, 0.25))
def percentile_floor(spark, sf_dir):
    f = filter_frame("frame", median=False, gaussian=False, percentile=True, percent=25.0)
    return _long(_embedding_frames(spark, sf_dir).select("vec_id", f.alias("frame")))


@query(_frame_sql(FLOOR_SQL, 0.05))
def frame_filters(spark, sf_dir):
    f = filter_frame("frame", percentile=True)
    return _long(_embedding_frames(spark, sf_dir).select("vec_id", f.alias("frame")))
