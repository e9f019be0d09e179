"""Language-model scores by online logistic context mixing.

A text is lower-cased (A-Z) and coded as bits: every byte, and an end mark, by the corpus'
Huffman code after the byte before it. Several predictors, each with its own hashed context (the last 2, 3
and 5 bytes, the word so far), give the log odds of the next bit from counts over the
training texts. A gate (depth in the code, whether the longest context was ever seen)
picks the weights that mix them; the weights are learned online on training texts that
are not in the counts, and go on adapting from block to block inside every text that is
scored. The bits add up to the log probability of the text.

What is counted over a corpus are (context, symbol) pairs with 64-bit keys, so their
number follows the corpus; they are kept in ranges of the key. A range's pairs give the
log odds of its contexts (``Known``). Texts are scored in groups, each with the log odds
along its own pairs (``Along``). The arrays of ``SLOTS`` counts are the form of the model
for a few texts in memory.
"""

from __future__ import annotations

import functools
import heapq
import itertools

import numpy as np

END = 256
SYMBOLS = 257
ORDERS = (2, 3, 5)
# Slots of each predictor, as powers of two: one per order, then the word so far.
SLOT_BITS = (16, 18, 19, 19)
INPUTS = len(SLOT_BITS)
SLOTS = sum(1 << b for b in SLOT_BITS)
DEPTHS = 8
GATES = DEPTHS * 2
BLOCK = 256
LANES = 64
# Long texts go by in stretches; a stretch sees this many symbols before it.
STRETCH, BEFORE = 65536, 4096
# Symbols that are counted at a time.
COUNTED = 1 << 18
# Pairs whose bits are held at a time.
TOGETHER = 1 << 16
PRIOR = 0.4
# Log odds are kept as small whole numbers, so that the tables stay near the processor.
STEPS = 14
START_WEIGHT = 0.3
RATE, OWN_RATE = 0.02, 0.01
LIMIT = 11.5

_BASE = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])]).astype(np.int64)
_ODD = np.uint32(0x9E3779B1)
_SALT = np.uint32(0x85EBCA6B)
_WORD, _OTHER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_MOST = 1 << 20
# Symbols whose keys are hashed at a time, so that they stay near the processor.
TILE = 1 << 14
# The bits of the last 0, 1, ... symbols of a context.
_FIELDS = np.array([(1 << 9 * k) - 1 for k in range(max(ORDERS) + 1)], np.uint64)
# Odds lie in rows of so many bits, the last row of a pair filled up with 0.
ROW = 4
# Rows of a pair whose bits have gates of their own, and one for all others.
_NTH = DEPTHS // ROW + 1
# The gate of (row, bit, whether the longest context was seen).
_GATES = np.minimum(np.arange(_NTH * ROW), DEPTHS - 1).reshape(_NTH, ROW, 1) * 2 + np.arange(2)
# The log of 2 as arrays of bits have it.
_LOG_2 = float(np.log(np.full(64, 2, np.float32))[0])


class _Powers:
    """Powers of a number modulo 2^64, made where they are used: only the number goes out
    with a task, which would else carry megabytes of them."""

    def __init__(self, base):
        self.base, self.made = base, np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, (self.base,)

    def first(self, n):
        if n > len(self.made):
            more = np.full(max(n, 2 * len(self.made)), self.base, np.uint64)
            more[0] = 1
            self.made = np.cumprod(more, dtype=np.uint64)
        return self.made[:n]


_UP, _DOWN = _Powers(int(_WORD)), _Powers(pow(int(_WORD), -1, 1 << 64))


class Code:
    """A Huffman code of the symbols for every symbol before them.

    ``counts`` holds how often each pair (symbol before * SYMBOLS + symbol) occurs; the
    counts of single symbols fill in where pairs are rare, so every symbol has a code
    everywhere. Per pair there are the bits and the salts of the nodes they leave.
    """

    def __init__(self, counts):
        pairs = np.asarray(counts, float).reshape(SYMBOLS, SYMBOLS)
        single = pairs.sum(axis=0) + 1
        weight = pairs + single / single.sum() + 1e-4
        trees = [_tree(w.tolist()) for w in weight]
        self.width = max(len(path) for tree in trees for path in tree)
        self.length = np.array([[len(path) for path in tree] for tree in trees], np.int32).ravel()
        node = np.zeros((SYMBOLS, SYMBOLS, self.width), np.uint32)
        inner = np.zeros((SYMBOLS, SYMBOLS, self.width), np.uint8)
        sign = np.zeros((SYMBOLS, SYMBOLS, self.width), np.float32)
        for before, tree in enumerate(trees):
            for s, path in enumerate(tree):
                n = len(path)
                node[before, s, :n] = [2 * (before * SYMBOLS + k) + 1 for k, _ in path]
                inner[before, s, :n] = [k for k, _ in path]
                sign[before, s, :n] = [bit for _, bit in path]
        self.node, self.inner, self.sign = (node * _SALT).ravel(), inner.ravel(), sign.ravel()
        self.most = -(-self.width // ROW)
        self.rows = -(-self.length // ROW)
        signs = np.zeros((SYMBOLS**2, self.most * ROW), np.int8)
        signs[:, : self.width] = sign.reshape(SYMBOLS**2, self.width)
        self.signs = signs.ravel().view(f"u{ROW}")

    def steps(self, pairs):
        """(pair of each bit, place of the bit in the code's arrays) of a run of pairs."""
        length = self.length.take(pairs)
        ends = np.cumsum(length, dtype=np.int64)
        of = np.repeat(np.arange(len(pairs)), length)
        depth = np.arange(len(of)) - (ends - length).take(of)
        return of, (pairs * self.width).take(of) + depth

    def bits(self, pairs, salted=True):
        """(symbol of each bit, salt of its node, -1 or 1, depth) of a run of pairs; the salts
        are None if they are not asked for."""
        length = self.length.take(pairs)
        ends = np.cumsum(length)
        of = np.repeat(np.arange(len(pairs)), length)
        depth = np.arange(int(ends[-1]), dtype=np.int32) - (ends - length).astype(np.int32).take(of)
        at = (pairs * self.width).take(of) + depth
        return of, self.node.take(at) if salted else None, self.sign.take(at), depth


def _tree(weights):
    """Per symbol the (inner node, -1 or 1) steps of a Huffman code."""
    heap = [(w, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, made = {}, SYMBOLS
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]], parent[b[1]] = (made, -1), (made, 1)
        heapq.heappush(heap, (a[0] + b[0], made))
        made += 1
    steps = {made - 1: []}
    for inner in range(made - 2, -1, -1):
        above, bit = parent[inner]
        steps[inner] = [*steps[above], (above - SYMBOLS, bit)]
    return [steps[k] for k in range(SYMBOLS)]


def pairs_of(symbols, place):
    """Symbol before * SYMBOLS + symbol, for texts that stand one after the other."""
    before = np.full(len(symbols), END, np.int64)
    before[1:] = symbols[:-1]
    before[place == 0] = END
    return before * SYMBOLS + symbols


def symbols_of(data):
    """The bytes of a text, A-Z lower-cased, and the end mark."""
    out = np.empty(len(data) + 1, np.int16)
    out[:-1] = data
    upper = (out[:-1] >= 65) & (out[:-1] <= 90)
    out[:-1][upper] += 32
    out[-1] = END
    return out


def contexts(symbols, place):
    """A 32-bit key per predictor for every symbol of texts that stand one after the
    other; ``place`` is a symbol's position in its text."""
    n = len(symbols)
    back = []
    for k in range(1, max(ORDERS) + 1):
        s = np.zeros(n, np.uint32)
        s[k:] = symbols[: n - k]
        s[place < k] = 0
        back.append(s + np.uint32(1))
    out = []
    for order in ORDERS:
        h = np.full(n, order, np.uint32)
        for s in back[:order]:
            h = (h + s) * _ODD
            h ^= h >> np.uint32(15)
        out.append(h * _ODD)
    word = _words(symbols)
    out.append(((word ^ (word >> np.uint64(31))) >> np.uint64(8)).astype(np.uint32) * _ODD)
    return out


def _words(symbols):
    """A 64-bit number of the word before every symbol, as far as it stands there."""
    n = len(symbols)
    plain = symbols.astype(np.uint64) + np.uint64(1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(plain * _UP.first(n), dtype=np.uint64)])
    space = (symbols == 32) | ((symbols >= 9) & (symbols <= 13)) | (symbols == END)
    index = np.arange(n, dtype=np.int64)
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], space[:-1]]), index, 0))
    return (total[:-1] - total[begin]) * _DOWN.first(n)[begin]


def pair_keys(symbols, place):
    """Per predictor a 64-bit key of (context, symbol): 46 bits of a hash of the context,
    the symbol before, the symbol. The symbol before is part of every context, so contexts
    are told apart by 55 bits; a context's keys stand together when sorted."""
    n = len(symbols)
    plain = symbols.astype(np.uint64)
    low = np.full(n, END, np.uint64)
    low[1:] = plain[:-1]
    one = np.zeros(n, np.uint64)
    np.add(plain[:-1], np.uint64(1), out=one[1:])
    low[place == 0] = END
    low <<= np.uint64(9)
    low |= plain
    # the last 5 symbols, 9 bits each, the last one lowest; shorter contexts are their low bits
    two = one.copy()
    two[1:] |= one[:-1] << np.uint64(9)
    packed = two.copy()
    packed[2:] |= two[:-2] << np.uint64(18)
    packed[4:] |= one[:-4] << np.uint64(36)
    head = np.flatnonzero(place < max(ORDERS))
    packed[head] &= _FIELDS[place[head]]
    words = _words(symbols)
    out, spare = [np.empty(n, np.uint64) for _ in range(INPUTS)], np.empty(min(n, TILE), np.uint64)
    for begin in range(0, n, TILE):
        tile = slice(begin, begin + TILE)
        for k, x in enumerate(whole[tile] for whole in out):
            y = spare[: len(x)]
            if k < len(ORDERS):
                np.bitwise_and(packed[tile], _FIELDS[ORDERS[k]], out=x)
            else:
                x[:] = words[tile]
            x += np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x ^= np.right_shift(x, np.uint64(32), out=y)
            x *= np.uint64(0xFF51AFD7ED558CCD)
            x ^= np.right_shift(x, np.uint64(29), out=y)
            x *= np.uint64(0xC4CEB9FE1A85EC53)
            x ^= np.right_shift(x, np.uint64(32), out=y)
            x &= ~np.uint64(0x3FFFF)
            x |= low[tile]
    return out


def summed(keys, counts):
    """Sorted keys without repeats, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def distinct(keys):
    """Sorted keys without repeats, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


class Pairs:
    """Sums the pair keys of texts, some at a time."""

    def __init__(self, most):
        self.most, self.waiting, self.parts = most, 0, []

    def add(self, keys, counts):
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.most:
            self.total()

    def total(self):
        keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in self.parts)])
        counts = np.concatenate([np.zeros(0, np.int64), *(n for _, n in self.parts)])
        keys, counts = summed(keys, counts)
        self.parts, self.waiting = [(keys, counts)], 0
        return keys, counts

    def add_texts(self, texts, times=1):
        for keys in _keys_in(texts):
            found, counts = distinct(keys)
            self.add(found, counts * times)


def _keys_in(texts):
    """The pair keys of texts, some ``COUNTED`` symbols of one predictor at a time."""
    for group in _groups(texts):
        stream = np.concatenate([part for part, _ in group])
        sizes = [len(part) for part, _ in group]
        place = places(np.array(sizes))
        keys = pair_keys(stream, place)
        if any(skip for _, skip in group):
            new = place >= np.repeat([skip for _, skip in group], sizes)
            keys = [key[new] for key in keys]
        yield from keys


def keys_of(texts):
    """The distinct pair keys of texts, sorted."""
    parts, waiting = [], 0
    for keys in _keys_in(texts):
        parts.append(distinct(keys)[0])
        waiting += len(parts[-1])
        if waiting > COUNTED * 8:
            parts, waiting = [distinct(np.concatenate(parts))[0]], 0
    return distinct(np.concatenate([np.zeros(0, np.uint64), *parts]))[0]


def contexts_of(texts):
    """The distinct contexts of texts, sorted: pair keys without the symbol."""
    return distinct(keys_of(texts) >> np.uint64(9))[0]


class Known:
    """Log odds of the nodes that the pairs of some contexts have passed.

    ``keys`` and ``counts`` are all pairs of the corpus in those contexts, sorted.
    """

    def __init__(self, code, keys, counts):
        self.code = code
        context = keys >> np.uint64(9)
        begins = np.concatenate([[True], context[1:] != context[:-1]]) if len(keys) else np.zeros(0, bool)
        self.contexts, rank = context[begins], np.cumsum(begins) - 1
        nodes, odds = [np.zeros(0, np.int64)], [np.zeros(0, np.int8)]
        # some contexts at a time, so that the bits of all pairs are never held at once
        starts = np.flatnonzero(begins)
        cuts = [*starts[np.searchsorted(starts, np.arange(0, len(keys), TOGETHER), 'right') - 1].tolist(), len(keys)] if len(keys) else []
        for a, b in itertools.pairwise(dict.fromkeys(cuts)):
            of, at = code.steps(pairs_at(keys[a:b]))
            node, order = np.unique(rank[a:b][of] << 8 | code.inner[at], return_inverse=True)
            n, one = counts[a:b].astype(np.float64)[of], code.sign[at] > 0
            ones = np.bincount(order, weights=n * one, minlength=len(node))
            every = np.bincount(order, weights=n, minlength=len(node))
            nodes.append(node)
            odds.append(log_odds(np.stack([every - ones, ones], axis=1).ravel()))
        self.nodes, self.odds = np.concatenate(nodes), np.concatenate(odds)

    def along(self, keys):
        """(odds, length): the odds along the code of every pair, one after the other, and how
        many they are for each."""
        pairs = pairs_at(keys)
        length = self.code.length.take(pairs).astype(np.int64)
        odds = np.zeros(int(length.sum()), np.int8)
        if len(self.contexts):
            context = keys >> np.uint64(9)
            rank = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            seen = np.flatnonzero(self.contexts[rank] == context)
            of, at = self.code.steps(pairs[seen])
            node = rank[seen][of] << 8 | self.code.inner[at]
            where = np.minimum(np.searchsorted(self.nodes, node), len(self.nodes) - 1)
            begin = (np.cumsum(length) - length)[seen]
            want = begin[of] + places(length[seen])
            odds[want] = np.where(self.nodes[where] == node, self.odds[where], 0)
        return odds, length

    def places(self, keys):
        """(odds, start): a pair's odds along its code begin at ``start`` of ``odds``."""
        found, back = np.unique(keys, return_inverse=True)
        odds, length = self.along(found)
        return odds, (np.cumsum(length) - length)[back]


class Along:
    """Log odds along the code of a group's own pairs, found by a hash of the pair's key.

    ``keys`` are sorted and distinct; ``odds`` are as ``Known.along`` gives them. The first 8
    stand beside the key as one number, so a pair is one place in memory; the others, of
    the few pairs with longer codes, lie in rows of ``ROW``.
    """

    def __init__(self, code, keys, odds):
        self.code = code
        length = code.length.take(pairs_at(keys))
        ends = np.cumsum(length, dtype=np.int64)
        short = np.minimum(length, 8)
        at = np.repeat(np.arange(0, 8 * len(keys), 8), short) + places(short)
        from_ = np.repeat(ends - length, short) + places(short)
        first = np.zeros(8 * len(keys), np.int8)
        first[at] = odds[from_]
        first = first.view(np.uint64)
        # the rows beyond the first 8 odds; a pair that has none finds odds of 0 behind all others
        far = np.flatnonzero(length > 8)
        self.far, rest = keys[far], length[far] - 8
        many = -(-rest // ROW)
        self.far_rows = np.append(np.cumsum(many) - many, many.sum())
        beyond = np.zeros((int(many.sum()) + code.most) * ROW, np.int8)
        beyond[np.repeat(self.far_rows[:-1] * ROW, rest) + places(rest)] = odds[np.repeat(ends[far] - rest, rest) + places(rest)]
        self.beyond = beyond.view(f"u{ROW}")
        # keys that find their place taken go to a second table, the few that do so again to a list
        self.tables = []
        for factor in (_WORD, _OTHER):
            bits = len(keys).bit_length() + 1
            shift = np.uint64(64 - bits)
            bucket = (keys * factor >> shift).astype(np.int64)
            # written here, so that it may lie in large pages
            table = np.empty((1 << bits, 2), np.uint64)
            table.fill(0)
            table[bucket, 0] = keys
            has = table[bucket, 0] == keys
            table[bucket[has], 1] = first[has]
            self.tables.append((factor, shift, table.view(np.complex128).ravel()))
            keys, first = keys[~has], first[~has]
        self.rest, self.rest_first = np.append(keys, np.uint64(2**64 - 1)), np.append(first, np.uint64(0))

    def first(self, keys):
        """The first 8 odds of every pair, as one number."""
        out = left = None
        for factor, shift, table in self.tables:
            bucket = keys * factor
            bucket >>= shift
            found = table.take(bucket.view(np.int64), mode="clip").view(np.uint64).reshape(-1, 2)
            other = np.flatnonzero(found[:, 0] != keys)
            if out is None:
                out = found[:, 1].copy()
            else:
                out[left] = found[:, 1]
            left, keys = other if left is None else left[other], keys[other]
            if not len(left):
                return out
        at = np.searchsorted(self.rest, keys)
        out[left] = np.where(self.rest[at] == keys, self.rest_first[at], np.uint64(0))
        return out

    def further(self, keys, many):
        """``many`` rows of odds of every pair behind its first 8, one pair after the other."""
        at = np.searchsorted(self.far, keys)
        known = np.append(self.far, ~np.uint64(0))[at] == keys
        return self.beyond[np.repeat(np.where(known, self.far_rows[at], self.far_rows[-1]), many) + places(many)]

    def rows(self, keys, pairs):
        """(rows, pairs with more than 8 odds): two rows for every pair, then their others."""
        far = np.flatnonzero(self.code.rows.take(pairs) > 2)
        return np.concatenate([self.first(keys).view(f"u{ROW}"), self.further(keys[far], self.code.rows.take(pairs[far]) - 2)]), far

    def places(self, keys):
        """(odds, start): a pair's odds along its code begin at ``start`` of ``odds``."""
        pairs, width = pairs_at(keys), max(2, self.code.most) * ROW
        rows, far = self.rows(keys, pairs)
        odds = np.zeros((len(keys) + 1, width), np.int8)
        odds[:-1, :8] = rows[: 2 * len(keys)].view(np.int8).reshape(-1, 8)
        many = self.code.rows.take(pairs[far]) - 2
        at = np.repeat(far * width + 8, many * ROW) + places(many * ROW)
        odds.ravel()[at] = rows[2 * len(keys) :].view(np.int8)
        some = odds.any(axis=1)
        return odds[np.append(np.flatnonzero(some), len(keys))].ravel(), np.where(some, np.cumsum(some) - 1, some.sum())[:-1] * width


def pairs_at(keys):
    """Symbol before * SYMBOLS + symbol of pair keys."""
    return ((keys >> np.uint64(9) & np.uint64(511)) * np.uint64(SYMBOLS) + (keys & np.uint64(511))).astype(np.int64)


def slots(key, of, salt, bits):
    return ((key.take(of) + salt) >> np.uint32(32 - bits)).astype(np.int64)


def stretches(symbols):
    """(symbols with some before, how many of those) for each stretch of a text."""
    for begin in range(0, len(symbols), STRETCH):
        first = max(0, begin - BEFORE)
        yield symbols[first : begin + STRETCH], begin - first


def pair_counts(texts):
    """How often each pair of symbols occurs in the texts."""
    runs = [symbols_of(t) for t in texts]
    if not runs:
        return np.zeros(SYMBOLS**2, np.int64)
    place = places(np.array([len(r) for r in runs]))
    return np.bincount(pairs_of(np.concatenate(runs), place), minlength=SYMBOLS**2)


def places(lengths):
    """Positions 0, 1, ... in each of several runs."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _add(table, code, group):
    stream = np.concatenate([part for part, _ in group])
    place = places(np.array([len(part) for part, _ in group]))
    new = np.flatnonzero(place >= np.repeat([skip for _, skip in group], [len(part) for part, _ in group]))
    of, salt, sign, _ = code.bits(pairs_of(stream, place)[new])
    one = sign > 0
    for k, key in enumerate(contexts(stream, place)):
        at = (slots(key[new], of, salt, SLOT_BITS[k]) << 1) + one
        table[2 * _BASE[k] : 2 * _BASE[k + 1]] += np.bincount(at, minlength=2 << SLOT_BITS[k])


def add_counts(table, code, texts):
    """Adds the bits of texts (arrays of bytes) to the counts, a flat (slots, 2) table."""
    for group in _groups(texts):
        _add(table, code, group)


def _groups(texts):
    """The stretches of texts, some ``COUNTED`` symbols at a time."""
    group, size = [], 0
    for text in texts:
        for part, skip in stretches(symbols_of(text)):
            if size + len(part) > COUNTED:
                yield group
                group, size = [], 0
            group.append((part, skip))
            size += len(part)
    if group:
        yield group


def log_odds(table):
    """Log odds of a 1 for each slot in steps of 1 / STEPS, 0 where nothing was counted."""
    pair = table.reshape(-1, 2).astype(np.float32)
    odds = np.log((pair[:, 1] + PRIOR) / (pair[:, 0] + PRIOR))
    return np.clip(np.rint(odds * STEPS), -127, 127).astype(np.int8)


class Mixer:
    """Mixes the predictors. ``weights`` (gates x inputs) may learn over texts; each text
    has small corrections of its own that start at 0."""

    def __init__(self, code, odds, weights=None):
        self.code = code
        self.known = odds if isinstance(odds, Along) else None
        self.odds = None if self.known else [odds[_BASE[k] : _BASE[k + 1]] for k in range(INPUTS)]
        self.weights = np.full((GATES, INPUTS), START_WEIGHT, np.float32) if weights is None else weights.astype(np.float32)
        self.squared = np.full((GATES, INPUTS), 1e-4, np.float64)

    def score(self, texts, learn=False):
        """Natural log probability of every text (arrays of bytes)."""
        out = np.zeros(len(texts))
        group, size = [], 0
        for k in sorted(range(len(texts)), key=lambda k: len(texts[k])):
            held = min(len(texts[k]) + 1, STRETCH + BEFORE)
            if group and (len(group) == LANES or size + held > _MOST):
                out[group] = self._lanes([texts[j] for j in group], learn)
                group, size = [], 0
            group.append(k)
            size += held
        if group:
            out[group] = self._lanes([texts[j] for j in group], learn)
        return out

    def _lanes(self, texts, learn):
        """Texts side by side, block after block."""
        runs = [list(stretches(symbols_of(t))) for t in texts]
        own = np.zeros((len(runs), INPUTS), np.float32)
        total = np.zeros(len(runs))
        for nth in range(max(map(len, runs))):
            live = np.array([k for k, r in enumerate(runs) if len(r) > nth])
            parts = [runs[k][nth][0] for k in live]
            skip = np.array([runs[k][nth][1] for k in live])
            lengths = np.array([len(p) for p in parts])
            stream = np.concatenate(parts)
            place = places(lengths)
            pairs = pairs_of(stream, place)
            starts = np.cumsum(lengths) - lengths + skip
            if self.known:
                wide, far = zip(*(self.known.rows(key, pairs) for key in pair_keys(stream, place)))
                more = self.code.rows.take(pairs[far[0]]) - 2
                mixed = functools.partial(self._rows, wide, pairs, far[0], np.cumsum(more) - more)
            else:
                keys = contexts(stream, place)
                mixed = lambda pick, *more: self._block(pairs[pick], [key[pick] for key in keys], *more)
            for block in range(0, int((lengths - skip).max()), BLOCK):
                here = np.flatnonzero(lengths - skip > block)
                n = np.minimum((lengths - skip)[here] - block, BLOCK)
                pick = np.repeat(starts[here] + block, n) + places(n)
                total[live[here]] += mixed(pick, n, own, live[here], learn)
        return total

    def _block(self, pairs, keys, sizes, own, lanes, learn):
        of, salt, sign, depth = self.code.bits(pairs)
        per_symbol = np.concatenate([[0], np.cumsum(self.code.length[pairs])])
        edges = per_symbol[np.concatenate([[0], np.cumsum(sizes)])]
        bits = np.diff(edges)
        inputs = [
            self.odds[k].take(slots(keys[k], of, salt, SLOT_BITS[k]), mode="clip").astype(np.float32) / np.float32(STEPS)
            for k in range(INPUTS)
        ]
        gate = np.minimum(depth, DEPTHS - 1) * 2 + (inputs[-2] != 0)
        weights = np.ascontiguousarray(self.weights.T)
        z = np.zeros(len(of), np.float32)
        for k in range(INPUTS):
            z += (weights[k].take(gate, mode="clip") + np.repeat(own[lanes, k], bits)) * inputs[k]
        z *= sign
        np.clip(z, -LIMIT, LIMIT, out=z)
        e = np.exp(-z)
        e1 = e + np.float32(1)
        gain = e / e1 * sign
        result = -np.add.reduceat(np.log(e1), edges[:-1], dtype=np.float64)
        for k in range(INPUTS):
            pull = gain * inputs[k]
            own[lanes, k] += OWN_RATE * np.add.reduceat(pull, edges[:-1]) / np.sqrt(bits)
            if learn:
                g = np.bincount(gate, weights=pull, minlength=GATES)
                self.squared[:, k] += g * g
                self.weights[:, k] += (RATE * g / np.sqrt(self.squared[:, k])).astype(np.float32)
        return result

    def _rows(self, wide, pairs, far, further, pick, sizes, own, lanes, learn):
        """As ``_block``, for the symbols ``pick`` of a stream whose odds are in rows: two for
        every symbol, then, from ``further`` on, the others of the symbols ``far``. Bits beyond
        a code's end have a sign and odds of 0."""
        pair = pairs.take(pick)
        many = self.code.rows.take(pair)
        ends = np.cumsum(many, dtype=np.int64)
        symbols = np.concatenate([[0], np.cumsum(sizes)])
        bits = np.add.reduceat(self.code.length.take(pair), symbols[:-1])
        edges = np.concatenate([[0], ends])[symbols]
        rows = np.diff(edges)
        begin = edges[:-1] * ROW
        of = np.repeat(np.arange(len(pick)), many)
        nth = np.arange(len(of)) - (ends - many).take(of)
        at = pick.take(of) * 2 + nth
        beyond = np.flatnonzero(nth > 1)
        if len(beyond):
            at[beyond] = 2 * len(pairs) + further[np.searchsorted(far, pick[of[beyond]])] + nth[beyond] - 2
        odds = [w.take(at, mode="clip").view(np.int8) for w in wide]
        inputs = [x.astype(np.float32) for x in odds]
        for x in inputs:
            x /= np.float32(STEPS)
        sign = self.code.signs.take((pair * self.code.most).take(of) + nth, mode="clip").view(np.int8).astype(np.float32)
        # all bits set where the longest context was seen
        seen = (odds[-2] != 0).view(np.int8).astype(np.int32)
        np.negative(seen, out=seen)
        # the weights of each (predictor, lane, nth row, bit) where it was not seen, and what changes where it was
        nth = np.minimum(nth, _NTH - 1)
        apart = np.ascontiguousarray(self.weights.T)[:, None, _GATES] + own[lanes].T[:, :, None, None, None]
        plain, change = np.ascontiguousarray(apart[..., 0]).view(np.int32), np.ascontiguousarray(apart[..., 1]).view(np.int32)
        change ^= plain
        at = np.repeat(np.arange(len(lanes)) * _NTH, rows) + nth
        z = None
        for k in range(INPUTS):
            part, other = (t[k].view(np.complex128).ravel().take(at, mode="clip").view(np.int32) for t in (change, plain))
            part &= seen
            part ^= other
            part = part.view(np.float32)
            part *= inputs[k]
            z = part if z is None else np.add(z, part, out=z)
        z *= sign
        np.clip(z, -LIMIT, LIMIT, out=z)
        e = np.exp(np.negative(z, out=z), out=z)
        e1 = e + np.float32(1)
        gain = np.divide(e, e1, out=e)
        gain *= sign
        # a bit beyond the end adds the log of 2
        result = _LOG_2 * (rows * ROW - bits) - np.add.reduceat(np.log(e1, out=e1), begin, dtype=np.float64)
        gate = _GATES[nth, :, 0].ravel() - seen if learn else None
        for k in range(INPUTS):
            pull = np.multiply(gain, inputs[k], out=inputs[k])
            own[lanes, k] += OWN_RATE * np.add.reduceat(pull, begin) / np.sqrt(bits)
            if learn:
                g = np.bincount(gate, weights=pull, minlength=GATES)
                self.squared[:, k] += g * g
                self.weights[:, k] += (RATE * g / np.sqrt(self.squared[:, k])).astype(np.float32)
        return result
