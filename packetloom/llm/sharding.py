"""Sharding of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays in one shard. Differencing keeps
partial partitions (one load for each shard) in a heap and repeatedly merges the two
with the largest spread, the heaviest load of one onto the lightest of the other.
It runs in two levels over hashed cells: each cell (100 groups per shard, or
sqrt(groups) if that is more) is differenced in a task of its own, and the cells' partial
partitions (one row of ``shards`` loads each, sqrt(groups) rows at most) in a last one.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.llm.common import saved, text_of

SHARDS = 40
ROW_BYTES = 16
# Numbering of a shard's rows is cut into this many pieces.
PIECES = 256


def difference(parts):
    """Karmarkar-Karp over ``parts``, each a list of k loads, one entry per shard.

    Returns for each part the shard of each of its entries.
    """
    k = len(parts[0])
    # A load carries a tree: a leaf is (part, entry), an inner node a pair of trees.
    heap = []
    for i, loads in enumerate(parts):
        bins = sorted(((load, ("leaf", i, j)) for j, load in enumerate(loads)), key=lambda b: (b[0], b[1][2]))
        heap.append((bins[0][0] - bins[-1][0], i, bins))
    heapq.heapify(heap)
    made = len(parts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        bins = sorted(
            ((x[0] + y[0], ("node", x[1], y[1])) for x, y in zip(a, reversed(b))), key=lambda z: z[0]
        )
        heapq.heappush(heap, (bins[0][0] - bins[-1][0], made, bins))
        made += 1
    out = [[0] * k for _ in parts]
    for shard, (_, tree) in enumerate(heap[0][2]):
        stack = [tree]
        while stack:
            kind, x, y = stack.pop()
            if kind == "leaf":
                out[x][y] = shard
            else:
                stack += (x, y)
    return out


def _cell_shards(shards):
    def run(table):
        order = sorted(
            zip(table["group_bytes"].to_pylist(), table["group"].to_pylist()), key=lambda x: (-x[0], x[1])
        )
        cell = table["cell"][0].as_py()
        places = difference([[size] + [0] * (shards - 1) for size, _ in order])
        return pa.table(
            {
                "cell": pa.array([cell] * len(order), pa.int64()),
                "group": pa.array([g for _, g in order], pa.binary()),
                "place": pa.array([p[0] for p in places], pa.int32()),
                "group_bytes": pa.array([size for size, _ in order], pa.int64()),
            }
        )

    return run


def _final_shards(shards):
    def run(table):
        rows = sorted(zip(table["cell"].to_pylist(), table["loads"].to_pylist()))
        dense = []
        for _, loads in rows:
            line = [0] * shards
            for entry in loads:
                line[entry["place"]] = entry["bytes"]
            dense.append(line)
        places = difference(dense)
        return pa.table(
            {
                "cell": pa.array([c for c, _ in rows for _ in range(shards)], pa.int64()),
                "place": pa.array(list(range(shards)) * len(rows), pa.int32()),
                "shard": pa.array([s for p in places for s in p], pa.int32()),
            }
        )

    return run


def group_shards(groups, shards=SHARDS):
    """(group, group_bytes) with unique groups -> (group, shard)."""
    count = groups.count()
    cells = max(1, min(math.isqrt(count), count // (100 * shards)))
    placed = saved(
        groups.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(cells)))
        .groupBy("cell")
        .applyInArrow(_cell_shards(shards), "cell long, group binary, place int, group_bytes long"),
        "shard-cells",
    )
    loads = (
        placed.groupBy("cell", "place").agg(F.sum("group_bytes").alias("bytes"))
        .groupBy("cell").agg(F.collect_list(F.struct("place", "bytes")).alias("loads"))
    )
    final = loads.withColumn("level", F.lit(0)).groupBy("level").applyInArrow(_final_shards(shards), "cell long, place int, shard int")
    return placed.join(final, ["cell", "place"]).select("group", "shard")


def shard_documents(docs, shards=SHARDS, id_col="doc_id", text_col="text"):
    """One row per document with its shard, near equal in bytes.

    Columns: id, ``size`` (UTF-8 bytes plus 16), ``text_crc32`` (unsigned), ``law``
    ('bytes'), ``shard`` from 0, ``slot`` (0, 1, ... in each shard) and ``grown_shard``
    (null under this law). Equal texts share a shard, so one group larger than a
    shard's part makes that shard larger. A null text is an empty one (size 16, crc 0);
    null ids and repeated rows are rows like others; an empty table gives no rows.
    """
    text = text_of(text_col).cast("binary")
    rows = saved(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("group_bytes"))
    piece = F.pmod(F.xxhash64("id", "text_crc32"), F.lit(PIECES)).cast("int")
    numbered = saved(
        rows.join(group_shards(groups, shards), "group")
        .withColumn("piece", piece)
        .withColumn(
            "nth",
            F.row_number().over(W.partitionBy("shard", "piece").orderBy("id", "text_crc32", "size")),
        )
        .drop("group"),
        "shard-numbered",
    )
    # shards x PIECES rows
    starts = (
        numbered.groupBy("shard", "piece").agg(F.count("*").alias("n"))
        .select("shard", "piece", (F.sum("n").over(W.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("before"))
    )
    return numbered.join(F.broadcast(starts), ["shard", "piece"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
