"""Key-value snapshots: scan, lookup, latest per key, copy once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.patterns import glob_any
from packetloom.functions.payloads import as_text
from packetloom.operators.streamlog import keep_first, keep_last

KEY = ("redis_db", "redis_key")


def scan_keys(kv: DataFrame, patterns=("*",), dbs=None, dialect: str = "file") -> DataFrame:
    """String-typed pairs whose key matches any pattern; each pair once.

    ``dialect`` is that of ``patterns.glob_regex``: ``server`` as the store's own scan matches.
    """
    out = kv.where((F.col("key_type") == "string") & glob_any("redis_key", patterns, dialect))
    return out if dbs is None else out.where(F.col("redis_db").isin(*dbs))


def point_lookup(kv: DataFrame, key: str, db: int | None = None) -> DataFrame:
    """The rows of one key; an absent key gives no row. The filter pushes down."""
    out = kv.where(F.col("redis_key") == key)
    return out if db is None else out.where(F.col("redis_db") == db)


def lookup(requests: DataFrame, kv: DataFrame, on=KEY) -> DataFrame:
    """Bulk lookup: every request, with a null value where the key is absent.

    ``kv`` holds one row per key (``latest_per_key``).
    """
    return requests.join(kv.select(*on, "redis_value"), list(on), "left")


def latest_per_key(kv: DataFrame, key=KEY, arrival: str = "arrival") -> DataFrame:
    """Last value per key, null as the empty string.

    ``key=("redis_key",)`` ignores the database, as a table unique on the key does.
    """
    return keep_last(kv, key, arrival).withColumn("redis_value", as_text("redis_value"))


def copy_once(kv: DataFrame, processed: DataFrame | None = None, arrival: str = "arrival") -> DataFrame:
    """First value of every key not copied before; later changes are not seen."""
    return keep_first(kv, KEY, processed, arrival).withColumn(
        "redis_value", as_text("redis_value")
    )


def upsert(table: DataFrame, changes: DataFrame, key=KEY, arrival: str = "arrival") -> DataFrame:
    """The table after the changes: last arrival per key wins."""
    return latest_per_key(table.unionByName(changes), key, arrival)
