"""Exact dedup by content sort.

Texts are put in order by (first characters, SHA-256, id). Sampled splitters cut
that order into ranges, each range is sorted with spilling to disk, and one pass
compares every text in full with its neighbour. The id is the last part of the
key, so a large group of copies runs over as many ranges as its size needs; the
two outer runs of each range (two short rows) are then stitched together. The
splitters hold at most ``HEAD`` characters and a digest, however long texts are.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from packetloom.llm.common import SPACES, saved, small_batches, text_of

HEAD = 32
_RUNS = (
    "id {id}, digest binary, local_keep {id}, local_size long, head boolean, edge boolean, part int"
)


def normalised(name):
    """The text with every stretch of white space as one space; null as ''."""
    return F.regexp_replace(text_of(name), SPACES, " ")


def _sorted(docs, id_col, payload, norm):
    """``docs`` as (id, digest, payload) in content order, cut into ranges."""
    small_batches(docs.sparkSession)
    keyed = docs.select(
        F.col(id_col).alias("id"),
        payload.alias("payload"),
        F.substring(norm, 1, HEAD).alias("start"),
        F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
    )
    order = [F.col("start"), F.col("digest"), F.col("id").asc_nulls_last()]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def _new_runs(norm, last):
    """For each text, whether it differs from the one before it."""
    first = pa.array([last is None or norm[0].as_py() != last])
    return pa.chunked_array([first, pc.not_equal(norm[1:], norm[:-1])]).combine_chunks()


def _label_runs(batches):
    """(id, digest, norm) in order -> one row for each, with its run's head id and size.

    Only the short columns of the last, still open run wait for the next batch.
    """
    part = TaskContext.get().partitionId()
    last, waiting, emitted = None, None, False

    def closed(ids, digests, fresh, at_end):
        starts = pc.indices_nonzero(fresh).to_pylist()
        sizes = [b - a for a, b in zip(starts, [*starts[1:], len(ids)])]
        run = pa.array([k for k, n in enumerate(sizes) for _ in range(n)], pa.int64())
        edge = [False] * len(starts)
        if starts and not emitted:
            edge[0] = True
        if starts and at_end:
            edge[-1] = True
        return pa.RecordBatch.from_arrays(
            [
                ids, digests, ids.take(pa.array(starts, pa.int64())).take(run),
                pa.array(sizes, pa.int64()).take(run), fresh,
                pa.array(edge, pa.bool_()).take(run), pa.array([part] * len(ids), pa.int32()),
            ],
            names=["id", "digest", "local_keep", "local_size", "head", "edge", "part"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, digests, norm = (batch.column(c) for c in ("id", "digest", "norm"))
        fresh = _new_runs(norm, last)
        last = norm[len(norm) - 1].as_py()
        if waiting is not None:
            old = waiting
            ids = pa.concat_arrays([old[0], ids])
            digests = pa.concat_arrays([old[1], digests])
            fresh = pa.concat_arrays([old[2], fresh])
        cut = pc.indices_nonzero(fresh)[-1].as_py()
        if cut:
            yield closed(ids[:cut], digests[:cut], fresh[:cut], False)
            emitted = True
        waiting = ids[cut:], digests[cut:], fresh[cut:]
    if waiting is not None:
        yield closed(*waiting, True)


def _stitched(edges):
    """Runs that go on in another range: digest -> smallest id, size, first range.

    ``edges`` holds at most two rows for each range, so the result may be broadcast.
    """
    least = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("part")))
    return F.broadcast(
        edges.groupBy("digest")
        .agg(least.alias("least"), F.sum("local_size").alias("size"), F.count("*").alias("pieces"))
        .filter("pieces > 1")
        .select("digest", F.col("least.id").alias("all_keep"), "size", F.col("least.part").alias("first"))
    )


def exact_dedup(docs, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after ``normalised``; null counts as
    empty, so null, '' are one group, and ' ' is another. Of equal texts the row with
    the smallest id stays; a null id comes after all others (``keep_id`` is null when
    all are). Of repeated rows with the same id and text exactly one is kept. An
    empty table gives no rows; other columns are neither read nor returned.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    order = _sorted(docs, id_col, normalised(text_col), normalised(text_col))
    runs = saved(
        order.select("id", "digest", F.col("payload").alias("norm")).mapInArrow(
            _label_runs, _RUNS.format(id=kind)
        ),
        "dedup-runs",
    )
    joined = runs.join(
        _stitched(runs.filter("edge and head")).withColumn("edge", F.lit(True)), ["digest", "edge"], "left"
    )
    over = F.col("size").isNotNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(over, F.col("all_keep")).otherwise(F.col("local_keep")).alias("keep_id"),
        F.when(over, F.col("size")).otherwise(F.col("local_size")).alias("group_size"),
        (F.col("head") & (~over | (F.col("first") == F.col("part")))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(docs, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    The rows travel whole through the one sort; only the first row of each run goes on,
    and of runs that cross ranges the one in the first range.
    """
    order = _sorted(docs, id_col, F.struct(*docs.columns), normalised(text_col))
    order = order.select("*", F.regexp_replace(F.coalesce(F.col(f"payload.{text_col}"), F.lit("")), SPACES, " ").alias("norm"))
    schema = order.select(
        "payload", "digest", "id", F.lit(0).alias("part"), F.lit(True).alias("leads"), F.lit(True).alias("trails")
    ).schema

    def heads(batches):
        part, last, held, first = TaskContext.get().partitionId(), None, None, True
        names = ["payload", "digest", "id", "part", "leads", "trails"]

        def out(batch, leads, trails):
            n = batch.num_rows
            flags = [pa.array([part] * n, pa.int32())]
            flags += [pa.array(x, pa.bool_()) for x in (leads, trails)]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *flags], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            norm = batch.column("norm")
            fresh = _new_runs(norm, last)
            last = norm[len(norm) - 1].as_py()
            kept = batch.filter(fresh)
            if not kept.num_rows:
                continue
            if held is not None:
                yield out(held, [first], [False])
                first = False
            if kept.num_rows > 1:
                n = kept.num_rows - 1
                yield out(kept.slice(0, n), [first] + [False] * (n - 1), [False] * n)
                first = False
            held = kept.slice(kept.num_rows - 1)
        if held is not None:
            yield out(held, [first], [True])

    kept = saved(order.mapInArrow(heads, schema), "dedup-rows")
    edges = kept.filter("leads or trails").select("digest", "id", "part", F.lit(1).alias("local_size"))
    joined = kept.join(
        _stitched(edges).select("digest", F.col("first")), "digest", "left"
    ).filter("first is null or first = part or not (leads or trails)")
    return joined.select(*(F.col("payload").getField(c).alias(c) for c in docs.columns))


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""
