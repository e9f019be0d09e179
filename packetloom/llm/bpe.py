"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of at most ``CHUNK`` characters is encoded in one go. A longer one is cut into
chunks that overlap; chunks are split into pre-tokens in parallel, each from its own
first character, so the first boundaries of a chunk may be wrong. Splitting looks only
forward, therefore two scans that share one boundary agree from there on: the chunks
are stitched at the first boundary that both find in their overlap, and the pieces
between stitches are encoded independently. Texts with an overlap without a common
boundary (one pre-token longer than ``OVERLAP``) are encoded whole instead.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import functions as F

from packetloom.llm.common import lean, saved, small_batches, text_of

CHUNK = 32768
OVERLAP = 1024
# Rows that a worker holds encoded or decoded at a time.
SLICE = 512


@functools.lru_cache(2)
def _codec(ranks, pattern):
    """The encoding of a rank file's content, and the bytes of every id."""
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    by_id = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        by_id[rank] = token
    return encoding, pa.array(by_id, pa.binary())


def _id_lists(encoding, texts):
    parts = [encoding.encode_to_numpy(t, disallowed_special=()) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([*parts, np.empty(0, np.uint32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sliced(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


def _encoder(ranks, pattern):
    """Arrow batches (name, text) -> (name, ids)."""

    def run(batches):
        encoding, _ = _codec(ranks.value, pattern)
        for batch in _sliced(batches):
            ids = _id_lists(encoding, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[batch.schema.names[0], "ids"])

    return run


def _cut(chunk, overlap):
    """(key, text) -> (key, i, last, chunk), one long text at a time."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                n = -(-len(text) // chunk)
                for i in range(n):
                    piece = text[i * chunk : (i + 1) * chunk + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key], pa.binary()), pa.array([i], pa.int32()),
                            pa.array([i == n - 1]), pa.array([piece]),
                        ],
                        names=["key", "i", "last", "chunk"],
                    )

    return run


def pre_token_starts(pattern, text):
    """Starts of pre-tokens that do not follow white space. Cutting there changes
    nothing: white space looks at the character behind it, other pre-tokens do not."""
    return [
        m.start() for m in pattern.finditer(text) if m.start() == 0 or not text[m.start() - 1].isspace()
    ]


def _scan(pattern, chunk, overlap):
    """Adds the boundaries in the part shared with the chunk before and the one after."""

    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for text in batch.column("chunk").to_pylist():
                starts = pre_token_starts(compiled, text)
                heads.append([s for s in starts if s < overlap])
                tails.append([s - chunk for s in starts if s >= chunk])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)],
                names=[*batch.schema.names, "heads", "tails"],
            )

    return run


def _encode_long(texts, encoder, pattern, chunk, overlap):
    """(key, text), rows with one key alike -> (key, ids), one row per key."""
    cut = texts.mapInArrow(lean(_cut(chunk, overlap)), "key binary, i int, last boolean, chunk string")
    scanned = saved(
        cut.dropDuplicates(["key", "i"]).mapInArrow(
            _scan(pattern, chunk, overlap),
            "key binary, i int, last boolean, chunk string, heads array<int>, tails array<int>",
        ),
        "bpe-chunks",
    )
    # What follows has a few numbers per chunk; the chunks themselves are joined once.
    before = scanned.filter("not last").select("key", (F.col("i") + 1).alias("i"), "tails")
    stitches = scanned.select("key", "i", "heads").join(before, ["key", "i"]).select(
        "key", "i", F.array_min(F.array_intersect("heads", "tails")).alias("start")
    )
    broken = stitches.groupBy("key").agg(F.bool_or(F.col("start").isNull()).alias("broken"))
    ends = stitches.select("key", (F.col("i") - 1).alias("i"), (F.col("start") + chunk).alias("end"))
    # chunk 0 has an end only, the last one a start only
    plan = saved(stitches.join(ends, ["key", "i"], "full").join(broken, "key"), "bpe-plan")
    start, end = F.coalesce("start", F.lit(0)), F.coalesce("end", F.length("chunk"))
    planned = scanned.select("key", "i", "chunk").join(plan, ["key", "i"])
    pieces = planned.filter("not broken").select(
        F.struct("key", "i").alias("at"), F.col("chunk").substr(start + 1, end - start).alias("text")
    )
    whole = (
        planned.filter("broken")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("i", F.substring("chunk", 1, chunk).alias("part")))).alias("parts"))
        .select(F.struct("key", F.lit(0).alias("i")).alias("at"), F.array_join("parts.part", "").alias("text"))
    )
    encoded = pieces.union(whole).mapInArrow(lean(encoder), "at struct<key:binary,i:int>, ids array<int>")
    return encoded.groupBy(F.col("at.key").alias("key")).agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("at.i", "ids"))).getField("ids")).alias("ids")
    )


def encode(docs, ranks, pattern, id_col="doc_id", text_col="text", chunk=CHUNK, overlap=OVERLAP):
    """One row per row of ``docs``: its id and ``ids``, the token ids of its whole text.

    ``ranks`` is the content of a rank file, ``pattern`` splits texts before the merges;
    the ids are those of the tiktoken library without special tokens. A null text is an
    empty one and has no ids; null ids and repeated rows are rows like others; an empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    encoder = _encoder(spark.sparkContext.broadcast(ranks), pattern)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = f"id {kind}, ids array<int>"
    short = rows.filter(F.length("text") <= chunk).mapInArrow(lean(encoder), schema)
    long = rows.filter(F.length("text") > chunk).select(
        "id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")
    )
    by_key = _encode_long(long.select("key", "text"), encoder, pattern, chunk, overlap)
    return short.union(long.select("id", "key").join(by_key, "key").select("id", "ids")).withColumnRenamed("id", id_col)


def decode(encoded, ranks, pattern):
    """``encoded`` with ``raw``: the bytes that its ``ids`` stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        _, by_id = _codec(shared.value, pattern)
        for batch in _sliced(batches):
            lists = batch.column(batch.schema.names.index("ids"))
            joined = by_id.take(lists.flatten())
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
            at = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1, joined.offset * 4) if len(joined) else np.zeros(1, np.int32)
            offsets = pa.py_buffer(at[ends].astype(np.int32).tobytes())
            data = joined.buffers()[2] if len(joined) else pa.py_buffer(b"")
            raw = pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, data])
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=[*batch.schema.names, "raw"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(lean(run), f"{schema}, raw binary")


def digests(decoded, id_col="doc_id"):
    """Token count and digests of ids and decoded bytes, one row per document."""
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(text.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )
