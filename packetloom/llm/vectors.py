"""Vectors of whole numbers, in packed rows and bounded blocks, for searches by inner product.

A search works over a ``Space``: a bounded sample of the rows (centres of the cells, and
first lower bounds of what a query can reach) and the length of the longest vector. With
one more coordinate, sqrt(longest^2 - |x|^2), all candidates lie on a sphere, so that large
inner products are small distances.
"""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

# Rows of the sample, and cells: bounds of what every task is handed.
SAMPLE, MOST_CELLS = 1024, 1024
# Components beyond this count as this, so that squares stay finite.
MOST = 1e150
LONG = (-(1 << 63), (1 << 63) - 1)
# Bytes of best rows that a task holds at once.
HELD = 64 << 20


def whole(df, vec_col):
    """The rows whose vector is there and has finite components only."""
    return df.filter(F.forall(F.col(vec_col).cast("array<double>"), lambda x: x.isNotNull() & (F.abs(x) < math.inf)))


def coordinates(column, scale):
    """floor(scale * x) of an Arrow list column as rows; short vectors are filled up with 0."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(values * scale), -MOST, MOST)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def packed(rows):
    """Rows of whole numbers as bytes, in two bytes each where they fit."""
    kind = "h" if np.abs(rows).max(initial=0) < 1 << 15 else "d"
    return kind.encode() + rows.astype(kind).tobytes()


def unpacked(data, n):
    flat = np.frombuffer(data, data[:1].decode(), offset=1)
    return flat.reshape(n, len(flat) // max(n, 1)).astype(np.float64)


def stacked(rows):
    """Packed single rows as one matrix."""
    parts = [unpacked(data, 1)[0] for data in rows]
    out = np.zeros((len(parts), max(map(len, parts), default=0)))
    for line, part in zip(out, parts):
        line[: len(part)] = part
    return out


def _whole_numbers(rows):
    return np.array([[int(x) for x in line] for line in rows], object).reshape(rows.shape)


def scores(a, b):
    """Inner products of the rows of ``a`` and ``b``, exact; beyond the range of a long they
    count as the nearest long. Missing components are 0."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    found = _whole_numbers(a) @ _whole_numbers(b).T
    return np.array([[min(max(x, LONG[0]), LONG[1]) for x in line] for line in found], np.int64).reshape(found.shape)


def lengths(rows):
    return np.sqrt((rows * rows).sum(axis=1))


def best(score, ids, known, most):
    """Places of the ``most`` largest scores, ties by smaller id, null ids last."""
    if len(score) > 4 * most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        at = np.flatnonzero(score >= least)
        return at[np.lexsort((ids[at], ~known[at], ~score[at]))[:most]]
    return np.lexsort((ids, ~known, ~score))[:most]


def unlike(a, b):
    """Whether rows of ``a`` and ``b`` differ in more than zeros at the end."""
    width = min(a.shape[1], b.shape[1])
    return (a[:, :width] != b[:, :width]).any(axis=1) | a[:, width:].any(axis=1) | b[:, width:].any(axis=1)


class Best:
    """The ``most`` best rows at each of some places, from any number of parts, in the order of
    ``best`` and own rows first. What they score raises a place's floor, so that further parts
    add only what is better."""

    def __init__(self, floor, most):
        self.floor, self.most, self.counted = np.array(floor, np.int64), most, 0
        # place, id, known, score, own
        self.rows = [np.zeros(0, kind) for kind in (np.int32, np.int64, bool, np.int64, bool)]
        # where a place has all its rows, the last id
        self.full, self.last = np.zeros(len(self.floor), bool), np.zeros(len(self.floor), np.int64)

    def late(self, place, ids, known, score):
        """Which rows equal the last in score and come behind it by their id."""
        return self.full[place] & (score == self.floor[place]) & (~known | (ids > self.last[place]))

    def put(self, *rows):
        place, ids, known, score, own = (np.concatenate(c).astype(c[0].dtype) for c in zip(self.rows, rows))
        order = np.lexsort((~own, ids, ~known, ~score, place))
        by = place[order]
        nth = np.arange(len(by)) - np.searchsorted(by, by)
        self.rows = [c[order[nth < self.most]] for c in (place, ids, known, score, own)]
        end = order[nth == self.most - 1]
        self.floor[place[end]], self.last[place[end]] = score[end], np.where(known[end], ids[end], LONG[1])
        self.full[place[end]] = True

    def size(self):
        return sum(c.nbytes for c in (*self.rows, self.floor, self.full, self.last))


def by_block(rows, key, make, most):
    """Batches of what the blocks of some rows find. A block adds row by row; those that were
    met last, up to ``most`` bytes of them, are held, the others give what they have."""
    held, size = OrderedDict(), 0
    for row in rows:
        one = held.pop(row[key], None) or make(row)
        held[row[key]] = one
        size -= one.counted
        one.add(row)
        one.counted = one.size()
        size += one.counted
        while size > most and len(held) > 1:
            _, gone = held.popitem(last=False)
            size -= gone.counted
            yield gone.batch()
    for one in held.values():
        yield one.batch()


class Space(NamedTuple):
    scale: float
    longest: float
    sample: np.ndarray
    labels: np.ndarray | None
    centres: np.ndarray

    def raised(self, rows):
        """The further coordinate that puts rows on the sphere."""
        return np.sqrt(np.maximum(self.longest**2 - (rows * rows).sum(axis=1), 0))

    def nearest(self, rows):
        """(cell, cosine with its centre) of candidates on the sphere."""
        width = min(rows.shape[1], self.centres.shape[1])
        dots = rows[:, :width] @ self.centres[:, :width].T + np.outer(self.raised(rows), self.raised(self.centres))
        cell = dots.argmax(axis=1) if len(self.centres) else np.zeros(len(rows), np.int64)
        top = dots[np.arange(len(rows)), cell]
        return cell, np.clip(top / max(self.longest, 1e-300) ** 2, -1, 1)


def space_of(rows, scale, label=False, per_cell=None):
    """The ``Space`` of rows (vec, and label). The driver gets ``SAMPLE`` rows at most, the
    same on every run: the first in the order of a hash. Cells: one for ``per_cell`` rows, or
    as many as make cells and their rows grow alike."""
    x = F.transform(F.col("vec").cast("array<double>"), lambda v: F.greatest(F.least(F.floor(v * scale).cast("double"), F.lit(MOST)), F.lit(-MOST)))
    n, square = rows.agg(F.count("*"), F.max(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))).first()
    picked = rows.orderBy(F.xxhash64("vec", "id"), "id").limit(SAMPLE).toArrow()
    lists = picked["vec"].combine_chunks()
    sample = coordinates(lists, scale) if n else np.zeros((0, 0))
    labels = picked["label"].to_numpy() if label else None
    cells = min(MOST_CELLS, -(-n // per_cell) if per_cell else max(16, round(math.sqrt(n) / 4)))
    centres = sample[np.sort(np.unique(sample, axis=0, return_index=True)[1])][:cells] if n else sample
    return Space(scale, math.sqrt(square or 0.0) * (1 + 1e-9), sample, labels, centres)


def cut(batches, column, most):
    """(value, table) for runs of equal values in sorted batches, ``most`` rows at most."""
    value, held, size = None, [], 0
    for batch in batches:
        of = batch.column(column).to_numpy()
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else []
        for a, b in itertools.pairwise(edges):
            if held and of[a] != value:
                yield value, pa.Table.from_batches(held)
                held, size = [], 0
            value = int(of[a])
            while a < b:
                n = min(b - a, most - size)
                held.append(batch.slice(a, n))
                a, size = a + n, size + n
                if size == most:
                    yield value, pa.Table.from_batches(held)
                    held, size = [], 0
    if held:
        yield value, pa.Table.from_batches(held)


def ids_of(column):
    """(ids, whether known) of a long column that may hold nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.fill_null(0).to_numpy().astype(np.int64), ~column.is_null().to_numpy(zero_copy_only=False)
