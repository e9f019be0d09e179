"""The given tables seen as logs, packets, key-values and the like.

Every view is narrow (no shuffle). The same definitions as SQL text are in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions.ids import epoch_ms, make_id
from packetloom.operators.ordered import whole_steps, with_chunk
from packetloom.operators.packets import TRIGGER_ORDER


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(col):
    return F.round(F.col(col) * 100).cast("bigint")


def stream_log(spark, sf_dir):
    """Events as entries of ``stream:{type}:{user}``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") % 16).cast("int").alias("db_num"),
        F.concat(F.lit("stream:"), "event_type", F.lit(":"), F.col("user_id").cast("string")).alias(
            "stream_key"
        ),
        epoch_ms("ts").alias("id_ms"),
        F.col("event_id").alias("id_seq"),
        F.col("event_type").alias("characteristic"),
        cents("value").alias("value_cents"),
        "user_id",
        F.col("event_id").alias("arrival"),
    ).withColumn("message_id", make_id("id_ms", "id_seq"))


def replayed_log(spark, sf_dir):
    """The log plus later copies of every tenth entry with another value."""
    log = stream_log(spark, sf_dir)
    again = log.where("arrival % 10 = 0").withColumns(
        {"value_cents": F.col("value_cents") + 1, "arrival": F.col("arrival") + 1_000_000_000}
    )
    return log.unionByName(again)


DEVICES = 50


def event_samples():
    """The 96 samples of an event's packet."""
    steps = F.expr(f"array({', '.join(str(j * 17) for j in range(96))})")
    return F.transform(steps, lambda step: ((F.col("event_id") * 31 + step) % 1000 - 100).cast("int"))


def _as_packets(e, trig, width):
    """Events as packets: a counter per device, no window needed to number them."""
    return with_chunk(e.withColumns({"trig": trig, "pressure": event_samples()}), "seq", width)


def _in_turn(step):
    order = F.expr(f"array({', '.join(map(str, TRIGGER_ORDER[:15]))})")
    return F.get(order, (step % 15).cast("int"))


def _dealt(spark, sf_dir):
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (k % DEVICES).alias("device"), k, whole_steps(k, DEVICES).alias("seq")
    )


def packets(spark, sf_dir, width=1 << 20, lossy=True):
    """Events as pressure packets of 50 devices; with ``lossy`` one in seven is lost."""
    e = _dealt(spark, sf_dir)
    if lossy:
        e = e.where("event_id % 7 <> 3")
    return _as_packets(e, _in_turn(F.col("seq") + F.col("device")), width)


def odd_packets(spark, sf_dir, width=1 << 20):
    """Packets in sessions of 50 per device, with repeated and unknown triggers, the
    sixteenth one, losses and missing devices."""
    k = F.col("event_id")
    turn = F.col("seq") + F.col("device")
    trig = (
        F.when(k % 41 == 7, 99).when(k % 31 == 5, 15).when(k % 37 == 6, _in_turn(turn + 14)).otherwise(_in_turn(turn))
    )
    e = _dealt(spark, sf_dir).where("event_id % 11 <> 4").withColumn("session", whole_steps(F.col("seq"), 50))
    out = _as_packets(e, trig, width)
    return out.withColumn("device", F.when(k % 97 != 8, F.col("device")))


TURN = str(TRIGGER_ORDER[:15])
SQL = {
    "stream_log": """stream_log AS (
  SELECT CAST(user_id % 16 AS INT) AS db_num,
         'stream:' || event_type || ':' || user_id AS stream_key,
         epoch_us(ts) // 1000 AS id_ms, event_id AS id_seq, event_type AS characteristic,
         CAST(round(value * 100) AS BIGINT) AS value_cents, user_id, event_id AS arrival,
         (epoch_us(ts) // 1000) || '-' || event_id AS message_id
  FROM events)""",
    "replayed_log": """replayed_log AS (
  SELECT * FROM stream_log
  UNION ALL
  SELECT db_num, stream_key, id_ms, id_seq, characteristic, value_cents + 1, user_id,
         arrival + 1000000000, message_id
  FROM stream_log WHERE arrival % 10 = 0)""",
    "packets": f"""packets AS (
  SELECT event_id % 50 AS device, event_id, event_id // 50 AS seq,
         {TURN}[1 + (event_id // 50 + event_id % 50) % 15] AS trig
  FROM events WHERE event_id % 7 <> 3)""",
    "all_packets": f"""packets AS (
  SELECT event_id % 50 AS device, event_id, event_id // 50 AS seq,
         {TURN}[1 + (event_id // 50 + event_id % 50) % 15] AS trig FROM events)""",
    # device and session in one text
    "odd_packets": f"""packets AS (
  SELECT (event_id % 50) || '/' || (event_id // 2500) AS device, event_id, event_id // 50 AS seq,
         CASE WHEN event_id % 31 = 5 THEN 15
              ELSE {TURN}[1 + (event_id // 50 + event_id % 50 + CASE WHEN event_id % 37 = 6 THEN 14 ELSE 0 END) % 15] END AS trig
  FROM events WHERE event_id % 11 <> 4 AND event_id % 41 <> 7 AND event_id % 97 <> 8)""",
    "gated": """gated AS (
  SELECT * FROM (
    SELECT *, max(CASE WHEN trig = 0 THEN 1 ELSE 0 END)
                OVER (PARTITION BY device ORDER BY event_id) AS opened FROM packets)
  WHERE opened = 1)""",
    "losses": f"""placed AS (
  SELECT *, list_position({TRIGGER_ORDER}, trig) - 1 AS pos FROM gated),
steps AS (
  SELECT *, lag(pos) OVER (PARTITION BY device ORDER BY event_id) AS prev,
         row_number() OVER (PARTITION BY device ORDER BY event_id) - 1 AS packet_no
  FROM placed),
losses AS (
  SELECT *, CASE WHEN prev IS NULL OR (prev < 15 AND pos = (prev + 1) % 15) THEN 0
                 ELSE abs(pos - prev) - 1 END AS lost FROM steps),
tracked AS (
  SELECT *, sum(lost) OVER w AS loss_total, sum(4 + 4 * greatest(lost, 0)) OVER w AS row_end,
         sum(4 + 4 * greatest(lost, 0)) OVER (PARTITION BY device) AS rows_total
  FROM losses WINDOW w AS (PARTITION BY device ORDER BY event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rows_ AS (
  SELECT device, event_id, row_end, rows_total, row_end - 4 + c AS row_idx, FALSE AS is_gap,
         [(event_id * 31 + (c * 24 + (i % 6) * 4 + i // 6) * 17) % 1000 - 100
          for i in range(24)] AS cells
  FROM tracked, (SELECT unnest(range(4)) AS c)
  UNION ALL
  SELECT device, event_id, row_end, rows_total,
         unnest(range(CAST(row_end - 4 - 4 * greatest(lost, 0) AS BIGINT), CAST(row_end - 4 AS BIGINT))),
         TRUE, [-1000 for i in range(24)] FROM tracked WHERE lost > 0),
frames AS (
  SELECT device, row_idx // 15 AS frame_id, count(*) FILTER (is_gap) AS gap_rows,
         string_agg(array_to_string(cells, ', '), ', ' ORDER BY row_idx) AS samples
  FROM rows_ WHERE row_idx // 15 < (rows_total - 1) // 15 GROUP BY ALL)""",
}


def with_sql(*names):
    return "WITH " + ",\n".join(SQL[n] for n in names)
