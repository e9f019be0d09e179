"""Sets of entries as intervals of their positions, a few rows for each stream.

An append-only stream numbers its entries 0, 1, 2, ... (``numbered``). What a group was
delivered, or has acknowledged, is a set of such numbers and mostly runs of them, so a
history of any length is kept as intervals ``lo``..``hi`` (both in it). Sets of neighbouring
batches merge, and differences are worked out on the intervals alone; the log is met only
for the entries that come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.ordered import CHUNK_ROWS, running_number, whole_steps, with_hot_chunks

# Positions that one row is spread into at a time.
SPREAD = 1 << 14


def numbered(log: DataFrame, keys=("stream_key",), order=("id_ms", "id_seq"), width: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``pos``, the 0-based position of each entry in its stream.

    Numbers stay as entries are appended; a trimmed stream keeps those of what is left
    when ``pos`` is stored with the log.
    """
    chunked = with_hot_chunks(log, keys, order[0], width)
    return running_number(chunked, keys, list(order), "pos").drop("chunk")


def _by_key(intervals: DataFrame, keys) -> DataFrame:
    """Dealt by key to as many tasks as a shuffle has.

    Intervals shuffle to a few bytes a row, so the planner would merge millions of them into
    one task, where every sort and sum of the sweep holds them at once.
    """
    n = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return intervals.repartition(n, *keys)


def of_positions(rows: DataFrame, keys, pos: str = "pos", width: int = CHUNK_ROWS) -> DataFrame:
    """The positions of some rows as intervals (keys, lo, hi); repeated ones count once.

    Runs are found inside stretches of ``width`` positions, so no task holds a key, and are
    then joined over the stretches' edges.
    """
    keys = list(keys)
    cut = rows.where(F.col(pos).isNotNull()).select(*keys, F.col(pos).cast("long").alias("_p")).withColumn("_c", whole_steps(F.col("_p"), width))
    one = cut.distinct()
    run = F.col("_p") - F.row_number().over(Window.partitionBy(*keys, "_c").orderBy("_p"))
    runs = one.withColumn("_r", run).groupBy(*keys, "_c", "_r").agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"))
    return merged(_by_key(runs.drop("_c", "_r"), keys), keys)


def merged(intervals: DataFrame, keys) -> DataFrame:
    """Intervals that overlap or touch as one; the union of several sets."""
    keys = list(keys)
    along = Window.partitionBy(*keys).orderBy("lo", "hi")
    reached = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("lo") > reached + 1), 1).otherwise(0)
    marked = intervals.select(*keys, "lo", "hi", opens.alias("_o"))
    grouped = marked.withColumn("_g", F.sum("_o").over(along))
    return grouped.groupBy(*keys, "_g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_g")


def minus(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """What of ``left`` is in no interval of ``right``: a sweep over the ends of both.

    Null keys are keys like others.
    """
    keys = list(keys)

    def ends(some, side):
        # one row for each end, from one pass over the intervals
        at = F.explode(F.array(
            F.struct(F.col("lo").alias("at"), F.lit(1 * (side == 0)).alias("a"), F.lit(1 * (side == 1)).alias("b")),
            F.struct((F.col("hi") + 1).alias("at"), F.lit(-1 * (side == 0)).alias("a"), F.lit(-1 * (side == 1)).alias("b")),
        ))
        return some.select(*keys, at.alias("_e")).select(*keys, "_e.at", "_e.a", "_e.b")

    points = _by_key(ends(left, 0).unionByName(ends(right, 1)), keys).groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    along = Window.partitionBy(*keys).orderBy("at")
    swept = points.select(
        *keys, F.col("at").alias("lo"), (F.lead("at").over(along) - 1).alias("hi"),
        F.sum("a").over(along).alias("_a"), F.sum("b").over(along).alias("_b"),
    )
    # neighbouring pieces of a difference are joined again
    return merged(swept.where("_a > 0 AND _b = 0 AND hi >= lo").drop("_a", "_b"), keys)


def sizes(intervals: DataFrame, keys) -> DataFrame:
    """How many entries each key's set has, without going back to them."""
    return intervals.groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("n"))


def first_of(intervals: DataFrame, keys, count: int) -> DataFrame:
    """The intervals cut to the first ``count`` entries of every key."""
    along = Window.partitionBy(*keys).orderBy("lo")
    before = F.sum(F.col("hi") - F.col("lo") + 1).over(along) - (F.col("hi") - F.col("lo") + 1)
    room = intervals.withColumn("_left", F.lit(count).cast("long") - before)
    return room.where("_left > 0").withColumn("hi", F.least("hi", F.col("lo") + F.col("_left") - 1)).drop("_left")


def spread(intervals: DataFrame, keys, pos: str = "pos") -> DataFrame:
    """One row for each position, spread in bounded pieces."""
    pieces = intervals.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), whole_steps(F.col("hi") - F.col("lo"), SPREAD))).alias("_k"))
    begin = F.col("lo") + F.col("_k") * SPREAD
    bounds = pieces.select(*keys, begin.alias("_b"), F.least("hi", begin + (SPREAD - 1)).alias("_e"))
    return bounds.select(*keys, F.explode(F.sequence("_b", "_e")).alias(pos))


def undelivered(lengths: DataFrame, delivered: DataFrame, keys=("stream_key",)) -> DataFrame:
    """The intervals of every stream (keys, ``length``) that no delivery covers."""
    everything = lengths.where("length > 0").select(*keys, F.lit(0).cast("long").alias("lo"), (F.col("length") - 1).cast("long").alias("hi"))
    return minus(everything, delivered.select(*keys, "lo", "hi"), keys)


def group_read(log: DataFrame, lengths: DataFrame, delivered: DataFrame, count: int, keys=("stream_key",)) -> DataFrame:
    """The first ``count`` entries of every stream that were not delivered.

    ``log`` is numbered; only the positions that come out are looked up in it, and the
    history is read as intervals and no further.
    """
    wanted = spread(first_of(undelivered(lengths, delivered, keys), keys, count), keys)
    return log.join(wanted, [*keys, "pos"])


def pending(delivered: DataFrame, acked: DataFrame, keys=("stream_key", "grp")) -> DataFrame:
    """The intervals that were delivered and not acknowledged."""
    return minus(delivered, acked, keys)
