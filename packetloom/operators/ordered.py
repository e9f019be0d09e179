"""Numbering inside ordered groups without putting a whole group into one task.

A window over ``partitionBy(key)`` sorts each key in one task, and the adaptive
planner cannot split it. Here every group is cut into *chunks*: ranges of the
order column with a bounded number of rows. Windows run inside
(key, chunk); one summary row per (key, chunk) carries what the chunks before
it add up to. The wide rows are shuffled once, by (key, chunk).

Keys, order column and chunk must not be null; ``first_n`` takes null keys and orders.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "chunk"
CHUNK_ROWS = 1 << 20


def whole_steps(value, width):
    """Whole-number division, exact for every BIGINT."""
    return F.call_function("div", value.cast("bigint"), F.lit(width).cast("bigint"))


def with_chunk(df: DataFrame, order: str, width: int = CHUNK_ROWS) -> DataFrame:
    """Add the ``chunk`` column: ``order`` in steps of ``width``.

    With a unique whole-number order no chunk of a key exceeds ``width`` rows.
    For an order that counts within each key (a packet counter); where it counts
    over all keys, ``with_hot_chunks`` makes far fewer chunks.
    """
    return df.withColumn(CHUNK, whole_steps(F.col(order), int(width)))


def with_hot_chunks(df: DataFrame, keys, order: str, width: int = CHUNK_ROWS) -> DataFrame:
    """Add the ``chunk`` column, cutting only keys with more than ``width`` rows.

    A key of ordinary size is one chunk, so the per-chunk totals stay as few as
    the keys. A layout choice: it costs one count of the input, combined in the map
    tasks, and the results are the same as with ``with_chunk``. Of n rows at most
    n / width keys are hot, so the planner sees a small side and may broadcast it.
    """
    hot = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > width)
        .select(*keys, F.lit(True).alias("_hot"))
    )
    steps = F.when(F.col("_hot"), whole_steps(F.col(order), int(width))).otherwise(F.lit(0))
    return df.join(hot, list(keys), "left").select(
        *[F.col(c) for c in df.columns], steps.cast("bigint").alias(CHUNK)
    )


def running_number(df: DataFrame, keys, order, name: str, total: str | None = None,
                   start: DataFrame | None = None) -> DataFrame:
    """0-based position of each row in its key's order, and the key's row count.

    ``df`` needs a ``chunk`` column that never falls as ``order`` rises.
    ``start`` (keys, n) holds how many rows each key had before.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    before = (
        df.groupBy(*keys, CHUNK)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            CHUNK,
            F.coalesce(
                F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
        )
    )
    if start is not None:
        earlier = F.coalesce("n", F.lit(0))
        before = before.join(start.select(*keys, "n"), keys, "left").withColumns(
            {"_before": F.col("_before") + earlier, "_total": F.col("_total") + earlier}
        ).drop("n")
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    out = (
        df.withColumn("_inside", F.row_number().over(inside) - 1)
        # merge: the rows are already shuffled and sorted by (keys, chunk) here
        .join(before.hint("merge"), [*keys, CHUNK], "left")
        .withColumn(name, F.col("_before") + F.col("_inside"))
    )
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_inside", "_before", "_total").select(
        *df.columns, name, *([total] if total else [])
    )


def first_n(df: DataFrame, keys, order, n: int, newest: bool = False, width: int = CHUNK_ROWS) -> DataFrame:
    """The first (or newest) ``n`` rows of every key, for any ``n``.

    ``order`` starts with a whole-number column. Ranges of it, ``width`` wide, are
    counted per key with map-side sums; only the ranges that the first ``n`` rows
    reach into are kept, and ranks are taken inside a range. So a task holds one
    range of a key, never the key. Choose ``width`` for ranges of bounded size.

    A null key is a key like others. A row whose first order column is null comes before
    all others of its key, so it is among the first and the last of the newest; such rows
    of a key are one range. Nulls in later order columns come before other values too.
    """
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    step = F.col(order[0])
    df = df.withColumn("_step", whole_steps(step, int(width)))
    along = Window.partitionBy(*keys).orderBy(F.col("_step").desc() if newest else F.col("_step"))
    needed = (
        df.groupBy(*keys, "_step").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(along) - F.col("_n"))
        .where(F.col("_before") < n).drop("_n")
    )
    inside = Window.partitionBy(*keys, "_step").orderBy(*[F.col(c).desc() if newest else F.col(c) for c in order])
    at = [*keys, "_step"]
    needed = needed.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(at)], "_before")
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(at)])
    ranked = df.join(needed, same).withColumn("_rn", F.row_number().over(inside))
    return ranked.where(F.col("_before") + F.col("_rn") <= n).select(*[c for c in df.columns if c != "_step"])
