"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two texts are linked when their Jaccard similarity
is at least ``SIMILAR``. Texts with equal sets are one node, so copies never meet each
other. Nodes that share a band of MinHash values are candidates (a pair at the threshold
is missed with probability below 1e-7). Within a bucket the MinHash values of a pair are
compared sixteen at a time, and the pair is dropped as soon as the posterior probability
of reaching the threshold falls below ``TOLERANCE``; the rest is verified on the whole
sets. A pair is looked at in the first band it shares only. A bucket gives link counts
and one edge per linked node, to the first of its group, never its pairs; a bucket of more than ``BLOCK``
nodes or ``BLOCK_BYTES`` of shingles is compared block by block in tasks of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from packetloom.llm.common import byte_views, lean, saved, small_batches, text_of
from packetloom.llm.components import components

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-9
# Nodes, and bytes of their shingles, in a block on average.
BLOCK, BLOCK_BYTES = 256, 4 << 20
_PART = 1 << 20

_rng = np.random.default_rng(20)
_A = _rng.integers(1 << 32, size=HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(1 << 32, size=HASHES, dtype=np.uint32)
_M = np.uint64(0xD6E8FEB86659FD93)
_UP = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_PART, _M)]), dtype=np.uint64)


def least_matches(similar=SIMILAR, tolerance=TOLERANCE):
    """For 0..HASHES compared values, the fewest matches worth going on with.

    With a uniform prior, the posterior of a similarity of at least ``similar`` after m
    matches in n values is the probability of at most m successes in n + 1 draws.
    """
    out = []
    for n in range(HASHES + 1):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * similar**m * (1 - similar) ** (n + 1 - m)
        out.append(m)
    return out


def _mixed(h):
    h = (h ^ (h >> np.uint64(32))) * _M
    return h ^ (h >> np.uint64(29))


def word_hashes(data):
    """A 64-bit hash of every word of a text (bytes), in order."""
    out, begin = [], 0
    while begin < len(data):
        size = _PART
        part = data[begin : begin + size]
        space = (part == 32) | ((part >= 9) & (part <= 13))
        if begin + len(part) < len(data):
            ends = np.flatnonzero(space)
            if not len(ends):
                # one word that fills the part: a hash of all its bytes
                stop = begin + len(part)
                while stop < len(data) and not (data[stop] == 32 or 9 <= data[stop] <= 13):
                    stop += 1
                out.append(np.array([xxhash.xxh3_64_intdigest(data[begin:stop].tobytes())], np.uint64))
                begin = stop
                continue
            part, space = part[: ends[-1] + 1], space[: ends[-1] + 1]
        begin += len(part)
        word = ~space
        first = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
        last = np.flatnonzero(word & np.concatenate([space[1:], [True]])) + 1
        # Horner's rule by running sums of b * M^(n - i), taken back by the tail's power
        powered = (part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powered, dtype=np.uint64)])
        out.append(_mixed((total[last] - total[first]) * _DOWN[first]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


_DOWN = np.cumprod(
    np.concatenate([np.ones(1, np.uint64), np.full(_PART, pow(int(_M), -1, 1 << 64), np.uint64)]), dtype=np.uint64
)


def shingles(data):
    """The sorted distinct shingle hashes of a text (bytes): its windows of five words,
    or all its words when it has fewer; none when it has no word."""
    words = word_hashes(data)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        h = _mixed(h * np.uint64(31) + words[k : len(words) - size + 1 + k])
    return np.unique(h)


def signature(found):
    """MinHash values of a set of shingles."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(low), 2048):
        np.minimum(out, (low[k : k + 2048, None] * _A + _B).min(axis=0), out=out)
    return out


def buckets(values):
    """A bucket per band: the band number in front, a hash of the band's values behind."""
    bands = values.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        h = _mixed(h * np.uint64(31) + bands[:, k] + np.uint64(1))
    return ((np.arange(BANDS, dtype=np.uint64) << np.uint64(58)) | (h >> np.uint64(6))).astype(np.int64)


def _sketch(batches):
    """(id, hash, text) -> (id, hash, node, buckets, bytes of shingles); no node for texts without words."""
    for batch in batches:
        nodes, found, sizes = [], [], []
        for data in byte_views(batch.column("text")):
            s = shingles(data)
            sizes.append(s.nbytes)
            nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            found.append(buckets(signature(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("hash"), pa.array(nodes, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
            names=["id", "hash", "node", "buckets", "size"],
        )


def _sets(batches):
    """(text) -> (node, values, shingles)."""
    for batch in batches:
        rows = [(xxhash.xxh3_128_digest(s.tobytes()), signature(s).tobytes(), s.tobytes())
                for s in map(shingles, byte_views(batch.column("text"))) if len(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.binary()) for k in range(3)], names=["node", "values", "shingles"]
        )


def _compare(similar):
    least = least_matches(similar)

    def run(table):
        order = table.sort_by("node")
        n = order.num_rows
        nodes, copies = order["node"].to_pylist(), np.array(order["copies"].to_pylist())
        block, whole = np.array(order["block"].to_pylist()), order["low"][0].as_py() == order["high"][0].as_py()
        band = order["bucket"][0].as_py() >> 58
        values = np.frombuffer(b"".join(order["values"].to_pylist()), np.uint32).reshape(n, HASHES)
        sets = [np.frombuffer(s, np.uint64) for s in order["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        local = np.split(flat, np.cumsum(sizes)[:-1])
        mark = np.zeros(int(flat.max()) + 1, np.int32)
        links, parent = np.zeros(n, np.int64), list(range(n))

        def root(k):
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for a in range(n - 1):
            rest = np.arange(a + 1, n)
            if not whole:
                rest = rest[block[rest] != block[a]]
            if band:
                same = values[rest, : band * ROWS] == values[a, : band * ROWS]
                rest = rest[~same.reshape(len(rest), band, ROWS).all(axis=2).any(axis=1)]
            matches = np.zeros(len(rest), np.int64)
            for k in range(0, HASHES, STEP):
                matches += (values[rest, k : k + STEP] == values[a, k : k + STEP]).sum(axis=1)
                going = matches >= least[k + STEP]
                rest, matches = rest[going], matches[going]
            if not len(rest):
                continue
            mark[local[a]] = 1
            starts = np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
            shared = np.add.reduceat(mark[np.concatenate([local[b] for b in rest])], starts)
            mark[local[a]] = 0
            linked = rest[shared >= similar * (sizes[a] + sizes[rest] - shared) - 1e-9]
            links[a] += copies[linked].sum()
            links[linked] += copies[a]
            for b in linked.tolist():
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        # a star for each group of linked nodes, around its first node
        edges = [(root(k), k) for k in range(n) if root(k) != k]
        counted = np.flatnonzero(links)
        return pa.table(
            {
                "u": pa.array([nodes[k] for k in counted] + [nodes[a] for a, _ in edges], pa.binary()),
                "v": pa.array([None] * len(counted) + [nodes[b] for _, b in edges], pa.binary()),
                "links": pa.array(links[counted].tolist() + [0] * len(edges), pa.int64()),
            }
        )

    return run


def _members(nodes):
    """(bucket, low, high, block, node, copies): who meets whom.

    Buckets with the same nodes are met once, in their first band. Large ones are cut into
    blocks, and a row goes to every pair of blocks that its own is part of.
    """
    listed = nodes.select("node", "size", F.explode("buckets").alias("bucket"))
    met = (
        listed.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.sum("size").alias("size"))
        .filter("n > 1").groupBy("n", "mark").agg(F.min("bucket").alias("bucket"), F.max("size").alias("size"))
    )
    cut = F.least(F.col("n"), F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / BLOCK_BYTES))).cast("int")
    rows = listed.join(met.select("bucket", cut.alias("cut")), "bucket").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("cut")).cast("int")
    )
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    return rows.select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node"
    )


def _joined(docs, similar, id_col, text_col):
    """The rows of ``docs`` as (id, hash, node), and what is known of the nodes."""
    small_batches(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    sketched = saved(rows.mapInArrow(lean(_sketch), f"id {kind}, hash long, node binary, buckets array<long>, size long"), "near-rows")
    nodes = saved(
        sketched.filter("node is not null").groupBy("node")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("buckets").alias("buckets"), F.first("size").alias("size")),
        "near-nodes",
    )
    members = saved(_members(nodes), "near-members")
    active = members.select("node").distinct().join(nodes.select("node", "first_id", "copies"), "node")
    wanted = active.select(F.col("first_id").alias("id")).distinct()
    texts = rows.alias("r").join(wanted.alias("w"), F.col("r.id").eqNullSafe(F.col("w.id")), "left_semi").select("text")
    sets = texts.mapInArrow(lean(_sets), "node binary, values binary, shingles binary").dropDuplicates(["node"])
    compared = saved(
        members.join(sets.join(active.select("node", "copies"), "node"), "node")
        .groupBy("bucket", "low", "high").applyInArrow(lean(_compare(similar)), "u binary, v binary, links long"),
        "near-links",
    )
    roots = components(compared.filter("v is not null").select("u", "v"))
    links = compared.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    linked = nodes.drop("buckets", "size").join(roots, "node", "left").join(links, "node", "left")
    return sketched.select("id", "hash", "node"), linked.filter("root is not null or copies > 1")


def near_duplicates(docs, similar=SIMILAR, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: id, ``class_id``, ``n_copies``, ``n_links``.

    ``class_id`` is the smallest id of the row's class: rows connected by links or equal
    shingle sets (null when all its ids are null). ``n_copies`` counts the rows with an
    equal set, the row itself included; ``n_links`` all other rows with a similarity of at
    least ``similar``, copies included. A text of fewer than five words has one shingle; a
    text without words (null, empty) links to nothing and is a class of its own. Repeated
    rows are copies of each other; an empty table gives no rows.
    """
    rows, linked = _joined(docs, similar, id_col, text_col)
    group = F.coalesce("root", "node")
    classes = linked.groupBy(group.alias("group")).agg(F.min("first_id").alias("class_id"))
    known = linked.withColumn("group", group).join(classes, "group").select("node", "copies", "links", "class_id")
    links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    return rows.join(known, "node", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(links, F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs, similar=SIMILAR, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` with one row of each class of near duplicates: the one with
    the smallest id (then text hash). Texts without words all stay."""
    rows, linked = _joined(docs, similar, id_col, text_col)
    in_class = rows.join(linked.select("node", F.coalesce("root", "node").alias("group")), "node").select("id", "hash", "group")
    keyed = saved(in_class.groupBy("group", "id", "hash").agg(F.count("*").alias("n")), "near-classes")
    place = F.struct(F.col("id").isNull(), "id", "hash")
    best = keyed.groupBy("group").agg(F.min(place).alias("best"))
    judged = keyed.join(best, "group").select("id", "hash", "n", (place == F.col("best")).alias("stays"))
    gone = judged.filter("not stays or n > 1").select("id", "hash")
    repeated = judged.filter("stays and n > 1").select("id", "hash")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("hash"))

    def against(keys, how):
        same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.hash") == F.col("b.hash"))
        return whole.alias("a").join(keys.alias("b"), same, how)

    kept = against(gone, "left_anti").union(against(repeated, "left_semi").dropDuplicates(["id", "hash"]))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
