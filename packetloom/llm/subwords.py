"""Quality classifier on supervised subword embeddings.

Words, pairs of neighbouring words and byte n-grams are hashed into buckets, each with
a learned vector; a document is the mean of its vectors, a softmax layer turns it into
class probabilities, and stochastic gradient descent in numpy fits both on a bounded
sample of labelled texts. A pair of equal words has a bucket of its own, so repetition
is seen for words that no training text holds. Both layers are linear in the mean, so
for scoring every bucket is reduced to its class scores and a text costs one table
lookup per n-gram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.llm.common import id_fold, label_shares, labelled_sample, lean, same_columns, small_batches, text_of

BITS = 16
DIM = 8
GRAMS = (3, 4)
EPOCHS = 12
RATE = 0.4
PER_CLASS = 2000
# Texts are hashed in blocks of this many bytes; n-grams do not cross blocks of a text.
BLOCK = 1 << 20
FOLDS, HELD = 4, 2
KEEP_SCORE = 0.7
_REPEAT = 0
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h):
    return ((h * _ODD) >> np.uint64(64 - BITS)).astype(np.int32)


def _powers(n):
    up = np.empty(n + 1, np.uint64)
    up[0] = 1
    up[1:] = np.uint64(0x100000001B3)
    return np.cumprod(up, dtype=np.uint64)


_UP = _powers(BLOCK)
_INVERSE = np.full(BLOCK + 1, pow(0x100000001B3, -1, 1 << 64), np.uint64)
_INVERSE[0] = 1
_DOWN = np.cumprod(_INVERSE, dtype=np.uint64)


def features(data, starts):
    """N-gram buckets of texts that stand one after the other in ``data`` (bytes).

    ``starts`` holds the first byte of each. Yields pairs (position, bucket), where the
    position tells the text.
    """
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    folded = np.where(space, np.uint8(32), data)
    first = np.zeros(n, bool)
    first[starts] = True
    text = np.cumsum(first)
    for size in GRAMS:
        if n < size:
            continue
        m = n - size + 1
        h = np.full(m, size, np.uint64)
        for k in range(size):
            h = (h << np.uint64(8)) | folded[k : k + m]
        whole = np.flatnonzero(text[:m] == text[size - 1 :])
        yield whole, _bucket(h[whole])
    begin = np.flatnonzero(~space & (first | np.concatenate([[True], space[:-1]])))
    if not len(begin):
        return
    stop = np.flatnonzero(~space & np.concatenate([space[1:] | first[1:], [True]])) + 1
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n], dtype=np.uint64)])
    words = (running[stop] - running[begin]) * _DOWN[begin]
    yield begin, _bucket(words)
    pair = np.flatnonzero(text[begin[1:]] == text[begin[:-1]])
    a, b = words[:-1][pair], words[1:][pair]
    yield begin[pair], np.where(a == b, np.int32(_REPEAT), _bucket(a * np.uint64(31) + b + np.uint64(7)))


def blocks(column):
    """The non-empty texts of an Arrow string column, in blocks of whole texts.

    Yields (bytes, start of each text in the block, row of each text). A text of more
    than ``BLOCK`` bytes comes in several blocks.
    """
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    rows, starts, base = [], [], None
    for row in range(len(column)):
        for begin in range(int(at[row]), int(at[row + 1]), BLOCK):
            end = min(begin + BLOCK, int(at[row + 1]))
            if rows and end - base > BLOCK:
                yield data[base:begin], np.array(starts), np.array(rows)
                rows, starts, base = [], [], None
            base = begin if base is None else base
            rows.append(row)
            starts.append(begin - base)
    if rows:
        yield data[base : int(at[-1])], np.array(starts), np.array(rows)


def _counted(batches):
    """(id, text, label) -> (id, label, buckets, counts)."""
    for batch in batches:
        total = [{} for _ in range(batch.num_rows)]
        for data, starts, rows in blocks(batch.column("text")):
            for at, bucket in features(data, starts):
                owner = np.searchsorted(starts, at, side="right") - 1
                keys, n = np.unique(owner.astype(np.int64) << BITS | bucket, return_counts=True)
                for k, c in zip(keys.tolist(), n.tolist()):
                    mine = total[rows[k >> BITS]]
                    mine[k & (1 << BITS) - 1] = mine.get(k & (1 << BITS) - 1, 0) + c
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("label"),
                pa.array([sorted(t) for t in total], pa.list_(pa.int32())),
                pa.array([[t[k] for k in sorted(t)] for t in total], pa.list_(pa.int32())),
            ],
            names=["id", "label", "buckets", "counts"],
        )


def fit(examples, classes=2, dim=DIM, epochs=EPOCHS, rate=RATE, seed=7):
    """Class scores of every bucket, from (label, buckets, shares) examples by SGD."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, classes), np.float32), np.zeros(classes, np.float32)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            label, buckets, shares = examples[k]
            mean = shares @ vectors[buckets]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            step = rate * (1 - done / steps)
            back = layer @ p
            layer -= step * np.outer(mean, p)
            bias -= step * p
            vectors[buckets] -= step * np.outer(shares * len(buckets) ** 0.5, back)
            done += 1
    return vectors @ layer, bias


def _trained(table):
    order = np.argsort(table["id"].to_numpy(zero_copy_only=False), kind="stable")
    examples = []
    for k in order.tolist():
        buckets = np.array(table["buckets"][k].as_py(), np.int64)
        counts = np.array(table["counts"][k].as_py(), np.float32)
        if len(buckets):
            examples.append((table["label"][k].as_py(), buckets, counts / counts.sum()))
    scores, bias = fit(examples)
    margin = (scores[:, 1] - scores[:, 0]).astype(np.float64)
    return pa.table({"margin": pa.array([margin.tobytes()], pa.binary()), "bias": [float(bias[1] - bias[0])]})


def train(docs, labels, column="quality", folds=FOLDS, held=HELD, per_class=PER_CLASS, id_col="doc_id", text_col="text"):
    """A model (margin per bucket, bias) from at most ``per_class`` texts of each label.

    The sample holds both labels alike; the bias is moved to their true shares. Without
    examples every margin is 0 and the bias 0.
    """
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, column, folds, held, per_class, id_col, text_col)
    kind = sample.schema["id"].dataType.simpleString()
    counted = sample.mapInArrow(lean(_counted), f"id {kind}, label int, buckets array<int>, counts array<int>")
    found = counted.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(lean(_trained), "margin binary, bias double").first()
    if found is None:
        return np.zeros(1 << BITS), 0.0
    no, yes = label_shares(labels, column, folds, held, id_col)
    taken = min(no, per_class), min(yes, per_class)
    shift = np.log((yes + 1) / (no + 1) * (taken[0] + 1) / (taken[1] + 1))
    return np.frombuffer(found.margin), found.bias + float(shift)


def scored(docs, model, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: id and ``score``, the probability of label 1.

    Whole texts are read. A text without n-grams (null, empty, shorter than the shortest
    n-gram and without a word) scores by the bias alone. Null ids and repeated rows are
    rows like others; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    margin, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(margin)

    def run(batches):
        table = shared.value
        for batch in batches:
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for data, starts, rows in blocks(batch.column("text")):
                for at, bucket in features(data, starts):
                    # running sums at the borders of texts
                    cut = np.searchsorted(at, np.append(starts, len(data)))
                    sums = np.concatenate([[0.0], np.cumsum(table[bucket])])
                    np.add.at(total, rows, sums[cut[1:]] - sums[cut[:-1]])
                    np.add.at(count, rows, np.diff(cut))
            z = total / np.maximum(count, 1) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], names=["id", "score"])

    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(lean(run), same_columns(docs, id_col, score="double")).withColumnRenamed("id", id_col)


def verdicts(scores, folds=FOLDS, held=HELD, id_col="doc_id"):
    """Adds ``held_out`` and ``predicted``."""
    return scores.select(
        id_col,
        (id_fold(id_col, folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )
