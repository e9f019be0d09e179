"""Exact top-k search by inner product as a Voronoi kNN join.

Candidates go to the nearest of a bounded number of pivots, on the sphere of
:mod:`packetloom.llm.vectors`, and lie in rings of their distance to it: blocks of bounded
size, whatever a pivot's share of the rows. Queries go to pivots too. The sample gives
each query a score that its k-th neighbour reaches at least, so a largest distance; with the
triangle inequality and the plane between two pivots it says which rings of which cells
can hold neighbours. Only those meet the query's block, and are solved there, a few pairs of
a block and a ring at a time. A task keeps the best k + 1 rows of a query over the rings that
it meets, up to a bound on all that it keeps; they are ranked once more over all tasks.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from packetloom.llm.common import saved, small_batches
from packetloom.llm.vectors import (
    HELD, LONG, Best, Space, by_block, coordinates, cut, ids_of, lengths, packed, scores, space_of, stacked, unlike, unpacked, whole,
)

TOP, SCALE, EVERY = 20, 64, 20
# Candidates in a ring, queries in a block.
RING, TOGETHER = 2048, 256
# Of a length: what rounding may take from a distance.
SLACK = 1e-6


def _apart(space, cosine):
    """Distance on the sphere from a cosine."""
    return space.longest * np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _placed(shared):
    """Candidates with their cell and distance to its pivot."""

    def run(batches):
        space = Space(*shared.value)
        for batch in batches:
            x = coordinates(batch.column("vec"), space.scale)
            cell, cosine = space.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cell, pa.int32()), pa.array(_apart(space, cosine)), pa.array([packed(line) for line in x], pa.binary())],
                names=["id", "cell", "far", "v"],
            )

    return run


def _rings(batches):
    """Sorted candidates as one row for each ring."""
    for cell, table in cut(batches, "cell", RING):
        far = table["far"].to_numpy()
        ids, known = ids_of(table["id"])
        row = [[cell], [far.min()], [far.max()], [len(ids)], [ids.tobytes()], [known.tobytes()], [packed(stacked(table["v"].to_pylist()))]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(row, [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])],
            names=["cell", "first", "last", "n", "ids", "known", "v"],
        )


def _query_cells(shared):
    """Queries with the cell of the nearest pivot; a query has no further coordinate."""

    def run(batches):
        space = Space(*shared.value)
        for batch in batches:
            x = coordinates(batch.column("vec"), space.scale)
            away = _to_pivots(space, x)
            cell = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cell, pa.int32()), pa.array(away.min(axis=1)), pa.array([packed(line) for line in x], pa.binary())],
                names=["id", "cell", "far", "v"],
            )

    return run


def _to_pivots(space, x):
    width = min(x.shape[1], space.centres.shape[1])
    dots = x[:, :width] @ space.centres[:, :width].T
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + space.longest**2 - 2 * dots, 0))


def least_scores(space, x, most):
    """The ``most``-th largest score of each row among the sample; without so many, the least long."""
    found = scores(x, space.sample)
    if found.shape[1] < most:
        return np.full(len(x), LONG[0])
    return np.partition(found, found.shape[1] - most, axis=1)[:, found.shape[1] - most]


def reach(space, x, cell, floor):
    """Per cell the distances (from, to) from its pivot at which rows of ``x`` (all of
    ``cell``) can have a candidate that scores ``floor``; from > to where there is none."""
    long = lengths(x)
    slack = SLACK * (long.max(initial=0) + space.longest + 1)
    # the least long also stands for all scores below it
    floor = np.where(floor == LONG[0], -np.inf, floor.astype(float))
    within = np.sqrt(np.maximum(long**2 + space.longest**2 - 2 * floor, 0)) + slack
    away = _to_pivots(space, x)
    first, last = away - within[:, None], away + within[:, None]
    raised = space.raised(space.centres)
    centres = np.column_stack([space.centres, raised])
    between = np.sqrt(np.maximum(((centres - centres[cell]) ** 2).sum(axis=1), 0))
    own = away[:, [cell]]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (away**2 - own**2) / (2 * between)
    beyond = (between > 0) & (plane > within[:, None] + slack)
    first[beyond] = np.inf
    last[beyond] = -np.inf
    return first.min(axis=0), last.max(axis=0)


def _query_blocks(shared, most):
    """Sorted queries as one row for each block, with the rings that it needs."""

    def run(batches):
        space, part, nth = Space(*shared.value), TaskContext.get().partitionId(), itertools.count()
        need_type = pa.list_(pa.struct([("cell", pa.int32()), ("first", pa.float64()), ("last", pa.float64())]))
        for cell, table in cut(batches, "cell", TOGETHER):
            x = stacked(table["v"].to_pylist())
            floor = least_scores(space, x, most)
            first, last = reach(space, x, cell, floor)
            need = [{"cell": k, "first": a, "last": b} for k, (a, b) in enumerate(zip(first.tolist(), last.tolist())) if a <= b]
            ids, _ = ids_of(table["id"])
            row = [[part << 32 | next(nth)], [len(ids)], [ids.tobytes()], [packed(x)], [floor.tobytes()], [need]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), need_type])],
                names=["block", "queries", "query_ids", "q", "floor", "need"],
            )

    return run


class _Neighbours(Best):
    """The best candidates of each query of a block, over the rings that a task has met."""

    def __init__(self, row, most):
        super().__init__(np.frombuffer(row["floor"], np.int64), most)
        self.block, self.query_ids = row["block"], np.frombuffer(row["query_ids"], np.int64)

    def add(self, row):
        q, x = unpacked(row["q"], row["queries"]), unpacked(row["v"], row["n"])
        ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        found = scores(q, x)
        nth, at = np.nonzero(found >= self.floor[:, None])
        keep = ~self.late(nth, ids[at], known[at], found[nth, at])
        nth, at = nth[keep], at[keep]
        if not len(nth):
            return
        own = known[at] & (ids[at] == self.query_ids[nth])
        own[own] = ~unlike(x[at[own]], q[nth[own]])
        self.put(nth, ids[at], known[at], found[nth, at], own)

    def batch(self):
        nth, ids, known, score, own = self.rows
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(nth), self.block)), pa.array(nth), pa.array(self.query_ids[nth]),
                pa.array(ids, mask=~known), pa.array(score), pa.array(own.astype(np.int32)),
            ],
            names=["block", "nth", "query_id", "vec_id", "score", "own"],
        )


def _solved(most):
    """(block of queries, ring) -> each query's best candidates in the rings of a task."""

    def run(batches):
        pairs = (row for batch in batches for row in batch.to_pylist())
        yield from by_block(pairs, "block", lambda row: _Neighbours(row, most), HELD)

    return run


def ranked(found, keys, most):
    """The ``most`` best rows for each of ``keys``, its own row not counted, as ``rank``.

    One row that equals the query is dropped, so rows repeated in full stay candidates.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("own").desc())
    top = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most + 1)
    seen = top.withColumn("seen", F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    others = seen.filter(~((F.col("own") == 1) & (F.col("seen") == 1)))
    rank = (F.col("place") - F.when(F.col("seen") > 0, 1).otherwise(0)).cast("int")
    return others.withColumn("rank", rank).filter(F.col("rank") <= most).drop("place", "seen", "own")


def top_k(df, k=TOP, scale=SCALE, every=EVERY, id_col="vec_id", vec_col="embedding"):
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the
    query's own; components count as floor(scale * x). Vectors that are null or hold a null
    or non-finite component take no part. A shorter vector is filled up with 0. Scores
    beyond a long count as the nearest long. A null id is no query; as a candidate it comes
    last among ties. Rows repeated in full are rows like others: each is a query, and a
    candidate of its copies. A table without vectors gives no rows.
    """
    spark = df.sparkSession
    # a block with a ring is a wide row
    small_batches(spark)
    rows = whole(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")), "vec")
    shared = spark.sparkContext.broadcast(tuple(space_of(rows, scale)))
    by = ["cell", "far", "id"]
    kind = "id long, cell int, far double, v binary"
    rings = rows.mapInArrow(_placed(shared), kind).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _rings, "cell int, first double, last double, n int, ids binary, known binary, v binary"
    )
    queries = rows.filter(F.col("id") % every == 0).mapInArrow(_query_cells(shared), kind)
    blocks = saved(
        queries.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
            _query_blocks(shared, k + 1),
            "block long, queries int, query_ids binary, q binary, floor binary, need array<struct<cell:int,first:double,last:double>>",
        ),
        "query-blocks",
    )
    needed = blocks.withColumn("need", F.explode("need"))
    meets = (needed["need.cell"] == rings["cell"]) & (needed["need.first"] <= rings["last"]) & (rings["first"] <= needed["need.last"])
    pairs = needed.join(rings, meets).select("block", "queries", "query_ids", "q", "floor", "n", "ids", "known", "v")
    found = pairs.mapInArrow(_solved(k + 1), "block long, nth int, query_id long, vec_id long, score long, own int")
    return ranked(found, ["block", "nth"], k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
