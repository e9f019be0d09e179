"""Partitioned tables: the stream log, the stream table, the key-value table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.ids import entry_key, id_ms, id_seq
from packetloom.operators.keyvalues import KEY, latest_per_key
from packetloom.operators.streamlog import CONFLICT_KEY, char_filter, keep_first, keep_last

STREAM_TABLE_SCHEMA = (
    "stream_key STRING, message_id STRING, data STRING, unix_timestamp TIMESTAMP_NTZ, arrival BIGINT"
)
KEY_VALUE_SCHEMA = "redis_key STRING, redis_value STRING, arrival BIGINT"


def provision(spark, database: str, stream_table: str = "stream_messages",
              kv_table: str = "key_values", folder: str | None = None):
    """Create both tables when absent and check that they can be read.

    With ``folder`` the tables lie in ``{folder}/{table}``, the paths to give to
    the writers here; ``refresh`` then shows new partitions to the catalog.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    wanted = (
        (stream_table, STREAM_TABLE_SCHEMA, "streaming_date DATE"),
        (kv_table, KEY_VALUE_SCHEMA, "redis_db INT, key_bucket INT"),
    )
    for name, schema, part in wanted:
        place = f" LOCATION '{folder}/{name}'" if folder else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}, {part}) USING parquet"
            f" PARTITIONED BY ({', '.join(p.split()[0] for p in part.split(', '))}){place}"
        )
        spark.table(f"{database}.{name}").limit(0).count()
    return [f"{database}.{name}" for name, *_ in wanted]


def refresh(spark, table: str) -> None:
    """Make partitions written by path known to the catalog."""
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def table_rows(rows: DataFrame) -> DataFrame:
    """The stream table's columns, with the field map as JSON text."""
    return rows.select(
        "stream_key", "message_id", F.to_json("data").alias("data"),
        "unix_timestamp", "arrival", "streaming_date",
    )


def exists(spark, path: str) -> bool:
    """The folder holds a table; what a failed job left behind does not count."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """Bring rows of one partition value together; Spark splits the large ones."""
    return rows.hint("rebalance", *[F.col(c) for c in by])


def log_date(ms="id_ms"):
    return F.expr(f"CAST(timestampadd(MILLISECOND, `{ms}`, TIMESTAMP_NTZ'1970-01-01 00:00:00') AS DATE)")


def append_log(rows: DataFrame, path: str) -> None:
    """Append log entries, partitioned by the date of their id."""
    _spread(rows.withColumn("log_date", log_date()), "log_date").write.mode("append").partitionBy(
        "log_date"
    ).parquet(path)


def read_log(spark, path: str, start_ms: int | None = None, end_ms: int | None = None,
             key: str | None = None, char: str | None = None) -> DataFrame:
    """Range scan of a stored log; the bounds also prune date partitions."""
    out = spark.read.parquet(path)
    for bound, keep in ((start_ms, "__ge__"), (end_ms, "__le__")):
        if bound is not None:
            day = F.date_add(F.lit("1970-01-01").cast("date"), bound // 86_400_000)
            out = out.where(getattr(F.col("log_date"), keep)(day))
            out = out.where(getattr(F.col("id_ms"), keep)(bound))
    if key is not None:
        out = out.where(F.col("stream_key") == key)
    return char_filter(out, char)


def keyed_rows(values: DataFrame, device="device", device_id="device_id", char="char", ms="timestamp_ms") -> DataFrame:
    """Key-value rows under ``device-id-char-ms``; the same key in one millisecond overwrites."""
    return values.select(
        entry_key(device, device_id, char, ms).alias("redis_key"),
        F.col("redis_db"), F.col("value").alias("redis_value"), F.col("arrival"),
    )


def on_dates(held: DataFrame, rows: DataFrame, date: str) -> DataFrame:
    """The rows of a table partitioned by ``date`` on the dates that ``rows`` has.

    A join with the distinct dates, so that one stray date reads one more partition
    and not all between.
    """
    return held.join(rows.select(date).distinct(), date, "left_semi")


def write_stream_table(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Add rows (with ``streaming_date`` and ``arrival``) under the conflict rule.

    ``overwrite=False`` keeps the entry that was first. ``overwrite=True`` keeps
    the last one and rewrites only the dates of the batch; the old files stay
    readable until the write commits. Only the dates of the batch are read.
    """
    spark = rows.sparkSession
    held = on_dates(spark.read.parquet(path), rows, "streaming_date") if exists(spark, path) else None
    if not overwrite:
        fresh = keep_first(rows, CONFLICT_KEY, held)
        _spread(fresh, "streaming_date").write.mode("append").partitionBy("streaming_date").parquet(path)
        return
    if held is not None:
        rows = rows.unionByName(held.select(*rows.columns))
    _spread(keep_last(rows, CONFLICT_KEY), "streaming_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("streaming_date").parquet(path)


KV_BUCKETS = 256


def write_kv_table(changes: DataFrame, path: str, buckets: int = KV_BUCKETS) -> None:
    """Upsert key-values: last arrival per (db, key).

    The table is partitioned by database and by a hash of the key; only buckets with a
    changed key are read and written. Choose ``buckets`` once per table, so that a
    batch of the usual size touches a small part of them.
    """
    spark = changes.sparkSession
    parts = ["redis_db", "key_bucket"]
    now = changes.withColumn("key_bucket", F.pmod(F.xxhash64("redis_key"), F.lit(buckets)).cast("int"))
    if exists(spark, path):
        touched = now.select(*parts).distinct()
        held = spark.read.parquet(path).join(touched, parts, "left_semi")
        now = held.select(*now.columns).unionByName(now)
    _spread(latest_per_key(now, KEY), *parts).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*parts).parquet(path)


def read_with_ids(spark, path: str) -> DataFrame:
    """A table of (stream_key, message_id, …) with numeric id parts."""
    return spark.read.parquet(path).withColumns(
        {"id_ms": id_ms("message_id"), "id_seq": id_seq("message_id")}
    )


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, bloom=(), row_group_bytes: int | None = None) -> None:
    """Writes a catalog table in hash buckets of ``keys``, sorted by them inside.

    Tables with the same keys and number of buckets join and aggregate by these keys without
    a shuffle. For columns in ``bloom`` every row group carries a Bloom filter, so a point
    lookup skips the groups that cannot hold its value. One task writes one bucket, so there
    is one file for each; choose ``buckets`` once and so that one fits a task.
    """
    keys = list(keys)
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").mode("overwrite")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", 1000)
    writer.saveAsTable(table)


def lookup_bucketed(requests: DataFrame, table: str, keys, value: str = "redis_value") -> DataFrame:
    """Every request with the value of its key, null where the key is absent.

    ``requests`` from a table with the same buckets meet it without a shuffle; the hint keeps
    the planner from sending a small side around instead.
    """
    held = requests.sparkSession.table(table).select(*keys, value)
    return requests.hint("merge").join(held, list(keys), "left")
