"""A prefix trie over conversations: ternary search trees per range shard, then merged.

Every turn (role, text) gets a number from a dictionary table, so a conversation is a
sequence of numbers. Sequences are range-sorted, copies by their id, into shards of bounded
size, and each shard inserts its distinct sequences, the median first, into a ternary search
tree: every tree node is a trie node, and siblings hang in a balanced binary tree. One
iterative traversal orders the nodes, and going back through it sums up members, leaves and
savings.

Nodes on the way to a shard's first and last sequence may go on in the shards beside it.
They leave a shard as two paths with what is summed up so far, one row for each shard, and
meet in rounds: ``TOGETHER`` neighbours merge in one task, what lies on the outer paths goes
on to the next round, the rest is finished.
"""

from __future__ import annotations

import hashlib
import math
import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from packetloom.llm.common import saved

# Turns and conversations in a shard, shards (or merged shards) that meet in a task.
SHARD, TOGETHER = 200_000, 64
FOLDS, STEP = 6, 100

_STATS = ["members", "first", "children", "leaves", "saved"]
_PATHS = "unit long, " + ", ".join(f"{side}_{name} array<long>" for side in ("low", "high") for name in ["turns", "chars", *_STATS])
_NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, parent_key binary"
)
_PART = f"node struct<{_NODE.replace(' ', ':').replace(',:', ',')}>, paths struct<{_PATHS.replace(' ', ':').replace(',:', ',')}>, key binary, first long, ends string"


class Nodes:
    """Trie nodes in lists; what is summed up below each so far."""

    def __init__(self):
        self.parent, self.depth, self.chars = [], [], []
        self.members, self.first, self.children, self.leaves, self.saved = [], [], [], [], []

    def add(self, parent, depth, chars):
        self.parent.append(parent)
        self.depth.append(depth)
        self.chars.append(chars)
        for name in _STATS:
            getattr(self, name).append(None if name == "first" else 0)
        return len(self.parent) - 1

    def join(self, node, members, first):
        self.members[node] += members
        if first is not None and (self.first[node] is None or first < self.first[node]):
            self.first[node] = first

    def finish(self, order, is_open):
        """Sums up from the last node of a preorder to the first; open nodes, on outer
        paths, stay as they are and count nowhere yet."""
        for node in reversed(order):
            if is_open(node):
                continue
            if not self.children[node]:
                self.leaves[node] = 1
            up = self.parent[node]
            if up is not None:
                self.saved[node] += (self.members[node] - 1) * self.chars[node]
                self.children[up] += 1
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]


class SearchTree(Nodes):
    """A ternary search tree; node 0 is the root of the trie, without a turn."""

    def __init__(self):
        super().__init__()
        self.turn, self.less, self.more, self.below, self.ends = [], [], [], [], []
        self._new(None, 0, 0, None)

    def _new(self, parent, depth, chars, turn):
        self.turn.append(turn)
        for links in (self.less, self.more, self.below):
            links.append(-1)
        self.ends.append(None)
        return self.add(parent, depth, chars)

    def path(self, turns, chars=None):
        """The nodes of a sequence from the root; with ``chars`` missing ones are made."""
        found, at = [0], 0
        for depth, turn in enumerate(turns):
            links, link, node = self.below, at, self.below[at]
            while node >= 0 and self.turn[node] != turn:
                links = self.less if turn < self.turn[node] else self.more
                link, node = node, links[node]
            if node < 0:
                node = self._new(at, depth + 1, chars[depth], turn)
                links[link] = node
            found.append(node)
            at = node
        return found

    def insert_all(self, sequences):
        """Inserts sorted distinct (turns, chars, ids), the median of every range first."""
        waiting = [(0, len(sequences))]
        while waiting:
            a, b = waiting.pop()
            if a < b:
                mid = (a + b) // 2
                turns, chars, ids = sequences[mid]
                path = self.path(turns, chars)
                self.ends[path[-1]] = ids
                waiting += [(a, mid), (mid + 1, b)]

    def preorder(self):
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            siblings = [self.below[node]]
            while siblings:
                child = siblings.pop()
                if child >= 0:
                    waiting.append(child)
                    siblings += [self.less[child], self.more[child]]
        return order

    def count(self, order):
        for node in reversed(order):
            if self.ends[node] is not None:
                self.join(node, len(self.ends[node]), self.ends[node][0])
            if self.parent[node] is not None:
                self.join(self.parent[node], self.members[node], self.first[node])


def path_keys(turns):
    """A digest for every prefix of a sequence, the empty one first."""
    state = hashlib.sha256()
    out = [state.digest()]
    for turn in turns:
        state.update(int(turn).to_bytes(8, "big", signed=True))
        out.append(state.copy().digest())
    return out


def _hex(ids):
    return hashlib.sha256(",".join(map(str, ids or ())).encode()).hexdigest()


def _sides(nodes, low, high, low_path, high_path):
    """The two outer paths as columns; what both share stands on the first only."""
    out = {}
    for side, (turns, chars), path, shared in (("low", low, low_path, 0), ("high", high, high_path, len(os.path.commonprefix([low_path, high_path])))):
        out |= {f"{side}_turns": list(turns), f"{side}_chars": list(chars)}
        for name in _STATS:
            values = getattr(nodes, name)
            blank = None if name == "first" else 0
            out[f"{side}_{name}"] = [blank if k < shared else values[node] for k, node in enumerate(path)]
    return out


def _row(nodes, node, parent, ends, key, parent_key):
    return {
        "conv_id": nodes.first[node], "depth": nodes.depth[node], "parent_conv_id": parent,
        "n_convs": nodes.members[node], "n_children": nodes.children[node], "n_leaves": nodes.leaves[node],
        "saved_tokens": nodes.saved[node], "ends_sha256": ends, "key": key, "parent_key": parent_key,
    }


def _arrow(schema):
    def kind(text):
        if text.startswith("array"):
            return pa.list_(pa.int64())
        return {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[text]

    return pa.struct([tuple([name, kind(of)]) for name, of in (field.split(" ") for field in schema.split(", "))])


_PARTS = pa.schema([("node", _arrow(_NODE)), ("paths", _arrow(_PATHS)), ("key", pa.binary()), ("first", pa.int64()), ("ends", pa.string())])


def _parts(rows):
    for k in range(0, len(rows), 4096):
        yield pa.RecordBatch.from_pylist(rows[k : k + 4096], schema=_PARTS)


def _shard(batches):
    """Sorted (turns, chars, conv_id) -> finished nodes, ends on open paths, the paths."""
    sequences = []
    for batch in batches:
        for turns, chars, conv in zip(*(batch.column(c).to_pylist() for c in ("turns", "chars", "conv_id"))):
            if sequences and sequences[-1][0] == turns:
                sequences[-1][2].append(conv)
            else:
                sequences.append((turns, chars, [conv]))
    if not sequences:
        return
    tree = SearchTree()
    tree.insert_all(sequences)
    order = tree.preorder()
    tree.count(order)
    low, high = sequences[0], sequences[-1]
    low_path, high_path = tree.path(low[0]), tree.path(high[0])
    keys = dict(zip(low_path, path_keys(low[0]))) | dict(zip(high_path, path_keys(high[0])))
    tree.finish(order, keys.__contains__)
    out = []
    for node in order:
        up = tree.parent[node]
        if node not in keys:
            parent = (None, keys[up]) if up in keys else (tree.first[up], None)
            out.append({"node": _row(tree, node, parent[0], _hex(tree.ends[node]), None, parent[1])})
        elif tree.ends[node]:
            ids = tree.ends[node]
            out.append({"key": keys[node], "first": ids[0], "ends": ",".join(map(str, ids))})
        if len(out) >= 4096:
            yield from _parts(out)
            out = []
    sides = _sides(tree, low[:2], high[:2], low_path, high_path)
    yield from _parts([*out, {"paths": {"unit": TaskContext.get().partitionId()} | sides}])


def merged(rows, last):
    """(finished nodes, outer paths or None) of neighbouring shards' paths, in order.

    With ``last`` nothing is left on the outer paths.
    """
    nodes, keys, turns, path = Nodes(), [], [], []
    low = high = None
    for row in rows:
        for side in ("low", "high"):
            new, chars = row[f"{side}_turns"], row[f"{side}_chars"]
            if not path:
                path, keys = [nodes.add(None, 0, 0)], [path_keys([])[0]]
            shared = len(os.path.commonprefix([turns, new]))
            path, made = path[: shared + 1], None
            for depth in range(shared, len(new)):
                made = made or path_keys(new)
                path.append(nodes.add(path[-1], depth + 1, chars[depth]))
                keys.append(made[depth + 1])
            turns = new
            for k, node in enumerate(path):
                nodes.join(node, row[f"{side}_members"][k], row[f"{side}_first"][k])
                for name in ("children", "leaves", "saved"):
                    getattr(nodes, name)[node] += row[f"{side}_{name}"][k]
            low = low or (new, chars, list(path))
            high = (new, chars, list(path))
    still = set() if last else {*low[2], *high[2]}
    nodes.finish(range(len(keys)), still.__contains__)
    done = [
        _row(nodes, k, None, None, keys[k], None if nodes.parent[k] is None else keys[nodes.parent[k]])
        for k in range(len(keys)) if k not in still
    ]
    return done, None if last else _sides(nodes, low[:2], high[:2], low[2], high[2])


def _merge(last):
    def run(table):
        rows = sorted(table.column("paths").to_pylist(), key=lambda r: r["unit"])
        done, paths = merged(rows, last)
        out = [{"node": row} for row in done]
        if paths:
            out.append({"paths": {"unit": rows[0]["unit"] // TOGETHER} | paths})
        return pa.Table.from_batches(_parts(out), _PARTS)

    return run


def _hashed(batches):
    """Sorted (key, first, ends) -> the digest of each key's ends, joined by commas."""
    key, state = None, None
    for batch in batches:
        done = []
        for of, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if of == key:
                state.update(b",")
            else:
                if state:
                    done.append((key, state.hexdigest()))
                key, state = of, hashlib.sha256()
            state.update(ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate([pa.binary(), pa.string()])], names=["key", "sha"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "sha"])


def sequences(df, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """(conv_id, turns, chars): every conversation's turns in order, as dictionary numbers,
    with the code points of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )
    dictionary = saved(rows.select("digest").distinct().withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")
    step = F.struct("turn", F.xxhash64("digest").alias("tie"), "id", "chars")
    told = rows.join(dictionary, "digest").groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return told.select("conv_id", F.col("steps.id").alias("turns"), F.col("steps.chars").alias("chars"))


def with_shared_starts(rows, step=STEP, folds=FOLDS):
    """Every conversation with its first h turns taken from the one that begins its ``step``.

    h is the crc32 of the id as text, modulo ``folds``.
    """
    head = rows.filter(F.col("conv_id") % step == 0).select(
        F.col("conv_id").alias("base"), *(F.slice(c, 1, folds - 1).alias(f"base_{c}") for c in ("turns", "chars"))
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds).cast("int")
    joined = rows.withColumns({"base": F.col("conv_id") - F.col("conv_id") % step, "h": h}).join(head, "base", "left")
    none = F.array().cast("array<long>")

    def whole(c):
        own = F.slice(c, F.col("h") + 1, F.greatest(F.size(c) - F.col("h"), F.lit(0)))
        return F.concat(F.slice(F.coalesce(f"base_{c}", none), F.lit(1), F.col("h")), own).alias(c)

    return joined.select("conv_id", whole("turns"), whole("chars"))


def trie(rows, shard=SHARD):
    """One row per trie node of the sequences (conv_id, turns, chars).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Ids are
    taken as unique. Without conversations there are no nodes. A sequence is one value of a
    row, with its copies sorted by id: a shard holds about ``shard`` turns and conversations,
    a copied sequence runs over as many shards as it fills.
    """
    rows = saved(rows, "sequences")
    size = rows.agg(F.coalesce(F.sum(F.size("turns") + 1), F.lit(0))).first()[0]
    by = ["turns", "conv_id"]
    shards = max(1, math.ceil(size / shard))
    parts = saved(rows.repartitionByRange(shards, *by).sortWithinPartitions(*by).mapInArrow(_shard, _PART), "trie-shards")
    paths, rounds, finished = parts.filter("paths is not null"), [], None
    units = (paths.agg(F.max("paths.unit")).first()[0] or 0) + 1
    while units:
        last = units <= TOGETHER
        units = 0 if last else -(-units // TOGETHER)
        grouped = paths.withColumn("group", F.floor(F.col("paths.unit") / TOGETHER)).select("group", "paths").groupBy("group")
        rounds.append(saved(grouped.applyInArrow(_merge(last), _PART), "trie-merged"))
        paths = rounds[-1].filter("paths is not null")
    for part in rounds:
        done = part.filter("node is not null").select("node.*")
        finished = done if finished is None else finished.unionByName(done)
    ends = parts.filter("ends is not null").select("key", "first", "ends")
    digests = ends.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, sha string")
    empty = F.lit(hashlib.sha256().hexdigest())
    finished = finished.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("sha", empty)).drop("sha")
    inner = parts.filter("node is not null").select("node.*")
    names = [f.split(" ")[0] for f in _NODE.split(", ")[:-2]]
    known = finished.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    below = inner.filter("parent_key is not null").select(*names, "parent_key").unionByName(finished.select(*names, "parent_key"))
    placed = below.join(known, "parent_key", "left").withColumn("parent_conv_id", F.col("parent")).select(*names)
    return inner.filter("parent_key is null").select(*names).unionByName(placed)


def conversation_trie(df, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """The trie of the conversations with shared starts; see ``trie`` and ``with_shared_starts``.

    Turns are ordered by ``turn``, null first; rows of equal turn by a hash of role and text,
    so repeated rows are turns of their own. Null role and text count as empty, rows without a
    conversation id take no part. Turns meet by the SHA-256 of role and text.
    """
    return trie(with_shared_starts(sequences(df, conv_col, turn_col, role_col, text_col)))


ORACLE = """
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT *, xor(list_reduce(
              list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
              lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
            ), 4294967295) % 6 AS h FROM t),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS seq
  FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (
  SELECT conv_id, depth, seq[1:depth] AS path, len(seq) = depth AS ends
  FROM (SELECT *, unnest(range(len(seq) + 1)) AS depth FROM r)),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY path, depth),
c AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].x) END AS own
  FROM n LEFT JOIN c USING (path, depth)),
u AS (
  SELECT path[1:d] AS path, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM w) GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, u.n_leaves, u.saved_tokens, w.ends_sha256
FROM w JOIN u USING (path, depth)
LEFT JOIN n p ON p.depth = w.depth - 1 AND p.path = w.path[1:w.depth - 1]
"""
