"""Language-model scores of documents: token counts and the context-mixing model.

The base score asks for the corpus count of every token. The most frequent words go to
the tasks as a dictionary of at most ``DICTIONARY`` words; the others are joined by word,
which no longer has heavy keys. The model of :mod:`packetloom.llm.mixing_lm` is counted
on most training documents, its weights are learned on the rest of them, whose counts are
then added, and it scores every document in the pass that also counts the document's tokens.

Documents go by in groups of about ``GROUP`` bytes, those that weights are learned on in
groups of their own. A group's pairs and their counts go to ranges of the key, as many as the
training bytes ask for; they are at once what is counted and what is asked for. A range adds
them up, works out the log odds of its contexts, and answers every group with those along the
group's pairs, a byte for each bit of their code. The answers are a written table.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from packetloom.llm import common
from packetloom.llm import mixing_lm as model
from packetloom.llm.common import byte_views, id_fold, saved, text_of

FOLDS, HELD, FOR_WEIGHTS = 7, 2, 3
DICTIONARY = 200_000
SLICE = 512
# Bytes of packed rows in an Arrow batch.
TOGETHER = 4 << 20
# Training bytes for each range of the pair table.
RANGE_BYTES = 1 << 22
# Pairs that a task sums before it hands them on.
MOST_PAIRS = 1 << 21
# Bytes of texts, and so much for each text, that are scored together.
GROUP, EACH = 1 << 24, 16
# Pairs that a range looks up at a time.
ASKED = 1 << 18
# Distinct words that a task counts before it hands them on.
MOST_WORDS = 1_000_000

# Blocks of symbols come and go: their memory is kept from one to the next.
lean = functools.partial(common.lean, keep=64 << 20)


def _sliced(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


def words_of(data):
    """The lower-cased (A-Z) words of a text given as bytes."""
    return bytes(data).lower().split()


def _corpus_counts(batches):
    """(text) -> (pair, word, n): tokens (the end mark as the empty word), pairs of symbols."""
    pairs, words = np.zeros(model.SYMBOLS**2, np.int64), Counter()

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([-1] * len(words), pa.int32()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
            names=["pair", "word", "n"],
        )

    for batch in _sliced(batches):
        texts = byte_views(batch.column("text"))
        for data in texts:
            words.update(words_of(data))
            words[b""] += 1
        pairs += model.pair_counts(texts)
        if len(words) > MOST_WORDS:
            yield out()
            words.clear()
    yield out()
    found = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32()), pa.array([b""] * len(found), pa.binary()), pa.array(pairs[found], pa.int64())],
        names=["pair", "word", "n"],
    )


def token_counts(texts):
    """(pair, word, n) over all texts; words have pair -1."""
    counted = texts.mapInArrow(lean(_corpus_counts), "pair int, word binary, n long")
    return saved(counted.groupBy("pair", "word").agg(F.sum("n").alias("n")), "lm-counts")


def dictionary(words):
    """log10(n + 1) of the most frequent words, at most ``DICTIONARY`` of them.

    Counts fall into steps of a sixteenth of a doubling; the steps that fit are taken
    whole, from the top. So the driver gets some hundred sums and then the words.
    """
    words = words.withColumn("step", F.floor(F.log2("n") * 16).cast("int"))
    room, least = DICTIONARY, None
    for step, size in sorted(map(tuple, words.groupBy("step").count().collect()), reverse=True):
        room -= size
        if room < 0:
            break
        least = step
    if least is None:
        return {}
    table = words.filter(F.col("step") >= least).select("word", "n").toArrow()
    logs = np.log10(table["n"].to_numpy() + 1.0)
    return dict(zip(table["word"].to_pylist(), logs.tolist()))


@functools.lru_cache(2)
def _code(counts):
    return model.Code(np.frombuffer(counts, np.int64))


def _packed(values):
    """Numbers as compressed bytes, all first bytes before all second ones and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _unpacked(data, n, kind=np.int64):
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _packed_keys(keys):
    return _packed(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _unpacked_keys(data, n):
    return np.cumsum(_unpacked(data, n, np.uint64), dtype=np.uint64)


def _cuts(keys, bits, key_bits):
    """(range, begin, end) of the ranges that sorted keys of ``key_bits`` bits reach."""
    of = (keys >> np.uint64(key_bits - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
    return [(int(of[a]), a, b) for a, b in itertools.pairwise([*first, len(of)])]


def _batch(names, kinds, rows):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


_PAIRS = "range int, n int, keys binary, counts binary"


def _batches(names, kinds, rows):
    """Rows as batches of some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > TOGETHER:
            yield _batch(names, kinds, held)
            held, size = [], 0
    if held:
        yield _batch(names, kinds, held)


def _pair_rows(keys, counts, bits):
    rows = ((k, b - a, _packed_keys(keys[a:b]), _packed(counts[a:b])) for k, a, b in _cuts(keys, bits, 64))
    yield from _batches(["range", "n", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()], rows)


def _pair_counts(bits):
    """(text) -> the sums of a partition's pairs, per range of the key."""

    def run(batches):
        pairs = model.Pairs(MOST_PAIRS)
        for batch in _sliced(batches):
            pairs.add_texts(byte_views(batch.column("text")))
            if pairs.waiting > MOST_PAIRS // 2 and len(pairs.total()[0]) > MOST_PAIRS // 2:
                yield from _pair_rows(*pairs.total(), bits)
                pairs = model.Pairs(MOST_PAIRS)
        yield from _pair_rows(*pairs.total(), bits)

    return run


def _pairs_in(table):
    """(keys, counts) of every row of a table of pairs."""
    columns = [table.column(c).to_pylist() for c in ("n", "keys", "counts")]
    return [(_unpacked_keys(keys, n), _unpacked(counts, n)) for n, keys, counts in zip(*columns)]


def _merged(table):
    """Adds up the rows of a range."""
    keys, counts = map(np.concatenate, zip(*_pairs_in(table)))
    keys, counts = model.summed(keys, counts)
    keys, counts = keys[counts > 0], counts[counts > 0]
    row = (table.column("range")[0].as_py(), len(keys), _packed_keys(keys), _packed(counts))
    return pa.Table.from_batches(
        [_batch(["range", "n", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()], [row])]
    )


def range_bits(texts):
    """Ranges of the pair table as a power of two, from the bytes of the training texts."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    return max(4, math.ceil(math.log2(max(1, size / RANGE_BYTES))))


def pair_table(texts, bits):
    """All (context, symbol) pairs of ``texts`` with their counts, one row per range."""
    partial = texts.mapInArrow(lean(_pair_counts(bits)), _PAIRS)
    return saved(partial.groupBy("range").applyInArrow(lean(_merged), _PAIRS), "lm-pairs")


def _grouped(learn):
    """(id, text, counted) -> (grp, docs): rows in groups of about ``GROUP`` bytes. Groups
    that weights are learned on have odd numbers."""

    def run(batches):
        part, nth, held, size = TaskContext.get().partitionId(), itertools.count(), [], 0

        def out():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
                for one in held:
                    file.write_batch(one)
            row = ((part << 20 | next(nth)) << 1 | learn, sink.getvalue().to_pybytes())
            return _batch(["grp", "docs"], [pa.int64(), pa.binary()], [row])

        for batch in batches:
            sizes = np.array([len(t) for t in byte_views(batch.column("text"))], np.int64) + EACH
            begin = 0
            for k, n in enumerate(sizes.tolist()):
                if size and size + n > GROUP:
                    if k > begin:
                        held.append(batch.slice(begin, k - begin))
                    yield out()
                    begin, held, size = k, [], 0
                size += n
            if len(sizes) > begin:
                held.append(batch.slice(begin))
        if held:
            yield out()

    return run


def grouped(rows, learn):
    """Rows (id, text, counted) as a written table of groups, the same whenever it is read."""
    return saved(rows.select("id", "text", "counted").mapInArrow(lean(_grouped(int(learn))), "grp long, docs binary"), "lm-groups")


def _texts(docs):
    """The record batches of a group, cut small."""
    return _sliced(pa.ipc.open_stream(docs))


def _by_use(docs):
    """The texts of a group that are counted, and those that are not."""
    counted, others = [], []
    for part in _texts(docs):
        for text, use in zip(byte_views(part.column("text")), part.column("counted").to_pylist()):
            (counted if use else others).append(text)
    return counted, others


def _keys(docs):
    """The distinct pairs of a group's texts, sorted."""
    return model.distinct(np.concatenate([model.keys_of(texts) for texts in _by_use(docs)]))[0]


def _counted(docs):
    """The same, and how often the counted texts have them."""
    pairs = model.Pairs(MOST_PAIRS)
    for times, texts in zip((1, 0), _by_use(docs)):
        pairs.add_texts(texts, times)
    return pairs.total()


def _requests(bits):
    names, kinds = ["range", "grp", "n", "keys", "counts"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches):
        for batch in batches:
            for grp, docs in zip(batch.column("grp").to_pylist(), batch.column("docs")):
                keys, counts = _counted(docs.as_buffer())
                rows = ((k, grp, b - a, _packed_keys(keys[a:b]), _packed(counts[a:b])) for k, a, b in _cuts(keys, bits, 64))
                yield from _batches(names, kinds, rows)

    return run


def _asked(table):
    """(groups, their sorted pairs) of a range's requests, about ``ASKED`` pairs at a time."""
    groups, wanted, size = [], [], 0
    for grp, n, data in zip(table.column("grp").to_pylist(), table.column("n").to_pylist(), table.column("keys")):
        groups.append(grp)
        wanted.append(_unpacked_keys(data.as_buffer(), n))
        size += n
        if size > ASKED:
            yield groups, wanted
            groups, wanted, size = [], [], 0
    if groups:
        yield groups, wanted


def _answers(counts):
    """The log odds of a range along the pairs that groups ask for, a row per group that any
    of them are not 0 for."""
    names, kinds = ["range", "grp", "n", "odds"], [pa.int32(), pa.int64(), pa.int32(), pa.binary()]

    def run(asked, table):
        rows = []
        if asked.num_rows and table.num_rows:
            nth, known = table.column("range")[0].as_py(), model.Known(_code(counts), *_pairs_in(table)[0])
            for groups, wanted in _asked(asked):
                odds, length = known.along(np.concatenate(wanted))
                ends = np.cumsum(length)[np.cumsum([len(keys) for keys in wanted]) - 1]
                for grp, a, b in zip(groups, [0, *ends[:-1].tolist()], ends.tolist()):
                    if odds[a:b].any():
                        rows.append((nth, grp, b - a, _packed(odds[a:b])))
        if not rows:
            return pa.schema(list(zip(names, kinds))).empty_table()
        return pa.Table.from_batches([_batch(names, kinds, rows)])

    return run


def _along(code, keys, bits, answers):
    """The log odds along a group's pairs from the answers of the ranges."""
    ends = np.cumsum(code.length.take(model.pairs_at(keys)), dtype=np.int64)
    odds = np.zeros(int(ends[-1]) if len(ends) else 0, np.int8)
    begin = {k: int(ends[a - 1]) if a else 0 for k, a, _ in _cuts(keys, bits, 64)}
    for k, n, data in zip(answers.column("range").to_pylist(), answers.column("n").to_pylist(), answers.column("odds")):
        odds[begin[k] : begin[k] + n] = _unpacked(data.as_buffer(), n, np.int8)
    return model.Along(code, keys, odds)


_ODDS = "learn boolean, range int, grp long, n int, odds binary"


def _range(counts):
    """A range's answers: to the groups that weights are learned on by the pairs of the
    other groups (``learn``), and to every group by all pairs."""

    def run(table):
        odd = pc.equal(pc.bit_wise_and(table.column("grp"), 1), 1)
        out = []
        for learn, asked, used in ((True, table.filter(odd), table.filter(pc.invert(odd))), (False, table, table)):
            found = _answers(counts)(asked, _merged(used) if used.num_rows else used)
            out.append(found.add_column(0, "learn", pa.array([learn] * found.num_rows, pa.bool_())))
        return pa.concat_tables(out)

    return run


def odds_table(groups, bits, counts):
    """The log odds along every group's pairs, a row per group and range, written."""
    asked = groups.mapInArrow(lean(_requests(bits)), "range int, grp long, n int, keys binary, counts binary")
    return saved(asked.groupBy("range").applyInArrow(lean(_range(counts)), _ODDS), "lm-odds")


def with_known(groups, odds, bits, counts, run, schema):
    """``run(group's number and record batches, the log odds along its pairs)`` for every group."""

    def each(docs, answers):
        grp, data = docs.column("grp")[0].as_py(), docs.column("docs")[0].as_buffer()
        return pa.Table.from_batches(run(grp, _texts(data), _along(_code(counts), _keys(data), bits, answers)))

    return groups.groupBy("grp").cogroup(odds.drop("learn").groupBy("grp")).applyInArrow(lean(each), schema)


def _learned(counts):
    def run(grp, batches, along):
        mixer, bits = model.Mixer(_code(counts), along), 0
        for batch in batches:
            texts = byte_views(batch.column("text"))
            mixer.score(texts, learn=True)
            bits += sum(map(len, texts)) + len(texts)
        flat = mixer.weights.ravel().astype(float)
        return [
            pa.RecordBatch.from_arrays(
                [pa.array(range(len(flat)), pa.int32()), pa.array(flat * bits), pa.array([float(bits)] * len(flat))],
                names=["place", "weighted", "bits"],
            )
        ]

    return run


def dealt(rows, bits):
    """Rows dealt and ordered by a hash of id and text, so that the groups, and with them the
    weights learned in them, do not depend on how the input is split."""
    rows = rows.withColumn("hash", F.xxhash64("id", "text")).repartition(1 << max(0, bits - 4), "hash")
    return rows.sortWithinPartitions("hash", "id", "text")


def mixing_weights(groups, odds, bits, counts):
    """Weights learned in every group, averaged by the bytes seen."""
    learned = with_known(groups, odds, bits, counts, _learned(counts), "place int, weighted double, bits double")
    rows = learned.groupBy("place").agg((F.sum("weighted") / F.sum("bits")).alias("weight")).collect()
    out = np.full(model.GATES * model.INPUTS, model.START_WEIGHT)
    for r in rows:
        out[r.place] = r.weight
    return out.reshape(model.GATES, model.INPUTS)


def _scores(counts, shared):
    def run(grp, batches, along):
        weights, known = shared.value
        mixer, row = model.Mixer(_code(counts), along, weights), itertools.count()
        for batch in batches:
            texts = byte_views(batch.column("text"))
            score = mixer.score(texts) / math.log(10)
            tokens, in_corpus, base, rare = [], [], [], []
            for data in texts:
                found = Counter(words_of(data))
                found[b""] = 1
                logs, n, other = 0.0, 0, []
                for word, times in found.items():
                    value = known.get(word)
                    if value is None:
                        other.append((word, times))
                    else:
                        logs += times * value
                        n += times
                tokens.append(sum(found.values()))
                in_corpus.append(n)
                base.append(logs)
                rare.append(other)
            kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([grp << 20 | next(row) for _ in texts], pa.int64()), batch.column("id"),
                    pa.array(tokens, pa.int64()), pa.array(in_corpus, pa.int64()), pa.array(base), pa.array(score),
                    pa.array([[{"word": w, "n": n} for w, n in other] for other in rare], kind),
                ],
                names=["row", "id", "n_tokens", "n_known", "logs", "score", "rare"],
            )

    return run


def scored(docs, id_col="doc_id", text_col="text", folds=FOLDS, held=HELD, for_weights=FOR_WEIGHTS):
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    Documents whose id fold is ``held`` are not learned from. ``base_score`` is the sum of
    log10((c + 1) / (N + V + 1)) over tokens; ``score`` the model's log10 probability of
    the text with its end mark. A null text is an empty one: one token, the end. Null ids
    count as '' for the folds; repeated rows are rows like others, learned from each time;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    fold = id_fold(id_col, folds)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), fold.alias("fold"))
    training = rows.filter(F.col("fold") != held)
    tokens = token_counts(training.select("text"))
    pairs = np.zeros(model.SYMBOLS**2, np.int64)
    for r in tokens.filter("pair >= 0").collect():
        pairs[r.pair] = r.n
    counts = pairs.tobytes()
    words = tokens.filter("pair < 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = dictionary(words)
    bits = range_bits(training)
    rows = rows.withColumn("counted", F.col("fold") != held)
    # fold and weights' fold may be the same: such documents are not learned from
    learn = (F.col("fold") == for_weights) & F.col("counted")
    last = grouped(dealt(rows.filter(learn), bits), learn=True)
    groups = grouped(rows.filter(~learn), learn=False).unionByName(last)
    odds = odds_table(groups, bits, counts)
    weights = mixing_weights(last, odds.filter("learn"), bits, counts)
    kind = docs.schema[id_col].dataType.simpleString()
    passed = saved(
        with_known(
            groups, odds.filter("not learn"), bits, counts, _scores(counts, spark.sparkContext.broadcast((weights, known))),
            f"row long, id {kind}, n_tokens long, n_known long, logs double, score double, rare array<struct<word:binary,n:long>>",
        ),
        "lm-scores",
    )
    rare = passed.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    more = (
        rare.join(words.select("word", "n"), "word").groupBy("row")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    )
    joined = passed.drop("rare").join(more, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id_col),
        (id_fold("id", folds) == held).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
        "score",
    )
