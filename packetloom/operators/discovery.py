"""Which streams exist, match, are new or have stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.ids import display_name
from packetloom.functions.patterns import glob_any, glob_match


def match_streams(keys: DataFrame, patterns=("*",), dbs=None, default_db=None,
                  per_pattern: bool = False, dialect: str = "file") -> DataFrame:
    """Stream-typed keys that match: (display_name, db, key).

    ``default_db`` leaves the prefix off for that db and lists a display name
    once; ``per_pattern`` lists a key once for each pattern it matches.
    ``patterns=None`` takes every stream. ``dialect`` is that of ``glob_regex``: the
    stores themselves match in the ``server`` dialect.
    """
    out = keys.where(F.col("key_type") == "stream")
    if dbs is not None:
        out = out.where(F.col("db").isin(*dbs))
    named = ["db", "key", display_name("db", "key", default_db).alias("display_name")]
    if per_pattern:
        hits = F.array_compact(
            F.array(*[F.when(glob_match("key", p, dialect), F.lit(p)) for p in patterns])
        )
        return out.select(*named, F.explode(hits).alias("pattern"))
    if patterns is not None:
        out = out.where(glob_any("key", patterns, dialect))
    return out.select(*named).distinct()


def with_length(matched: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the stream length; a stream without entries has length 0."""
    return matched.join(stats.select("db", "key", "length"), ["db", "key"], "left").withColumn(
        "length", F.coalesce("length", F.lit(0))
    )


def stream_diff(current: DataFrame, last: DataFrame, key: str = "stream_key") -> DataFrame:
    """Every stream of either list with status ``new``, ``stopped`` or ``kept``."""
    tagged = current.select(key, F.lit(1).alias("now"), F.lit(0).alias("then")).unionByName(
        last.select(key, F.lit(0).alias("now"), F.lit(1).alias("then"))
    )
    seen = tagged.groupBy(key).agg(F.max("now").alias("now"), F.max("then").alias("then"))
    status = (
        F.when(F.col("then") == 0, "new").when(F.col("now") == 0, "stopped").otherwise("kept")
    )
    return seen.select(key, status.alias("status"))
