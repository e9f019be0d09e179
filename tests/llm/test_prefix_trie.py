"""op12 against a trie built node by node."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from packetloom.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, node int, turns string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, None) for r in rows], SCHEMA).repartition(3)


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(rows):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in _rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return {
        (
            min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(children[path]), leaves[path],
            saved[path], hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        )
        for path, m in members.items()
    }


def _random(seed, n=150):
    """Few texts, so that conversations share starts; a third of them are one conversation."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = ["same", "a", "b"] if c % 3 == 0 else [rng.choice(["a", "b", "çé", "same"]) for _ in range(rng.randint(0, 7))]
        rows += [(c * 7, k, rng.choice(["user"] * 5 + [None]) if c % 3 else "user", t) for k, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("shard", [10**6, 60, 6])
def test_trie(spark, monkeypatch, shard):
    """One shard, some, and more than meet in one round."""
    monkeypatch.setattr(prefix_trie, "TOGETHER", 4)
    rows = _random(shard)
    starts = prefix_trie.with_shared_starts(prefix_trie.sequences(_table(spark, rows)))
    got = prefix_trie.trie(starts, shard).select(*COLUMNS).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == _brute(rows)


ODD = [
    (100, None, "user", "z"), (100, 0, None, None), (100, 0, None, None), (100, 2, "", ""), (101, 5, "user", None),
    (None, 1, "user", "lost"), (None, None, None, None), (-3, 1, "a", "x" * 100_000), (-100, 1, "a", "first"), (205, 1, "u", "one"),
    (0, 1, "a", "b:c"), (1, 1, "a:b", "c"), (2**40, None, "r", "t"),
]


def test_odd_rows(spark):
    """Nulls, turnless conversations, repeated rows, negative and large ids, a long text."""
    got = prefix_trie.conversation_trie(_table(spark, ODD)).select(*COLUMNS).collect()
    assert set(map(tuple, got)) == _brute(ODD)


def test_only_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "cut off")]
    got = prefix_trie.conversation_trie(_table(spark, rows)).collect()
    assert [tuple(r) for r in got] == list(_brute(rows)) and len(got) == 1


def test_empty(spark):
    assert prefix_trie.conversation_trie(_table(spark, [])).collect() == []


def test_long_conversation(spark):
    rows = [(0, k, "user", str(k % 7)) for k in range(3000)] + [(300, k, "user", str(k % 7)) for k in range(2000)]
    got = prefix_trie.conversation_trie(_table(spark, rows)).select(*COLUMNS).collect()
    assert set(map(tuple, got)) == _brute(rows)


def test_median_insertion_is_balanced():
    tree = prefix_trie.SearchTree()
    tree.insert_all([([k], [1], [k]) for k in range(1023)])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.less[node]), height(tree.more[node]))

    assert height(tree.below[0]) == 10
