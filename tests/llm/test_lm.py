"""Language-model scores: base against a plain count, the model's laws, odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from packetloom.llm import lm, queries
from packetloom.llm import mixing_lm as model


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def plain_base(rows):
    """(n_tokens, n_known, N, base score) per row."""
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    counts = Counter(w for (i, _), words in zip(rows, tokens) if fold(i) != 2 for w in words)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w))
        for w in tokens
    ]


def check(rows, found):
    key = {}
    for r in found:
        key.setdefault(r.doc_id, []).append(r)
    for (i, _), (n, known, total, base) in zip(rows, plain_base(rows)):
        r = next(x for x in key[i] if (x.n_tokens, x.n_known) == (n, known) and abs(x.base_score - base) < 1e-6 * max(1, abs(base)))
        assert r.train_tokens == total and r.held_out == (fold(i) == 2) and r.score <= 0
    assert len(found) == len(rows)


@pytest.mark.parametrize("dictionary", [200_000, 5])
def test_query_base_and_bits(spark, docs_dir, monkeypatch, dictionary):
    monkeypatch.setattr(lm, "DICTIONARY", dictionary)
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{docs_dir}/documents.parquet").collect()]
    found = queries.op10_lm_score(spark, docs_dir).collect()
    check(rows, found)
    size = {i: len((t or "").encode()) for i, t in rows}
    held = [r for r in found if r.held_out]
    bits = -sum(r.score for r in held) / math.log10(2) / sum(size[r.doc_id] for r in held)
    assert bits < 4.0  # far below 8, and below the order-0 code of about 4.4


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "Ab ab\tAB"), (3, "x" * 300_000), (4, "é 日本 \x00"), (5, "ab " * 50_000)]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, fold int, n string")
    check(rows, lm.scored(docs).collect())
    assert lm.scored(docs.limit(0)).count() == 0


def trained(texts):
    code = model.Code(model.pair_counts(texts))
    table = np.zeros(2 * model.SLOTS, np.int64)
    model.add_counts(table, code, texts)
    return code, model.log_odds(table)


def as_bytes(text):
    return np.frombuffer(text.encode(), np.uint8)


def test_code_is_complete():
    code = model.Code(model.pair_counts([as_bytes("some text, é")]))
    kraft = (2.0 ** -code.length.reshape(model.SYMBOLS, -1)).sum(axis=1)
    assert np.allclose(kraft, 1)


def test_probabilities_of_the_next_symbol_add_up():
    texts = [as_bytes("the cat sat on the mat " * 20), as_bytes("a dog sat on a log " * 20)]
    code, odds = trained(texts)
    mixer = model.Mixer(code, odds)
    start = model.symbols_of(as_bytes("the ca"))[:-1]
    every = np.stack([np.append(start, s) for s in range(model.SYMBOLS)]).ravel().astype(np.int16)
    place = model.places(np.full(model.SYMBOLS, 7))
    keys, pairs = model.contexts(every, place), model.pairs_of(every, place)
    last = np.arange(model.SYMBOLS) * 7 + 6
    own = np.zeros((model.SYMBOLS, model.INPUTS), np.float32)
    logs = mixer._block(pairs[last], [k[last] for k in keys], np.ones(model.SYMBOLS, int), own, np.arange(model.SYMBOLS), False)
    assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_scores_do_not_depend_on_the_company():
    rnd = random.Random(5)
    texts = [as_bytes(" ".join(rnd.choice(["one", "two", "three"]) for _ in range(rnd.randrange(1, 400)))) for _ in range(70)]
    texts += [as_bytes(""), as_bytes("seven " * 30_000)]
    code, odds = trained(texts[:40])
    mixer = model.Mixer(code, odds)
    together = mixer.score(texts)
    assert np.allclose(together, [mixer.score([t])[0] for t in texts], rtol=1e-9)
    assert together[0] < 0


def test_adapting_and_training_help():
    texts = [as_bytes("the cat sat on the mat " * 30)] * 4
    code, odds = trained(texts)
    blank = model.Mixer(code, np.zeros(model.SLOTS, np.int8)).score(texts[:1])[0]
    assert model.Mixer(code, odds).score(texts[:1])[0] > 0.2 * blank


def test_counts_of_stretches(monkeypatch):
    text = as_bytes("some words and more " * 500)
    code = model.Code(model.pair_counts([text]))
    whole, parts = np.zeros(2 * model.SLOTS, np.int64), np.zeros(2 * model.SLOTS, np.int64)
    model.add_counts(whole, code, [text])
    monkeypatch.setattr(model, "STRETCH", 1000)
    monkeypatch.setattr(model, "BEFORE", 64)
    model.add_counts(parts, code, [text])
    assert (whole == parts).all()


def test_pairs_are_counted_exactly_however_many(spark, monkeypatch):
    monkeypatch.setattr(lm, "MOST_PAIRS", 5000)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randrange(3000))) for _ in range(40)] + ["", "\x00"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    table = lm.pair_table(rows, 5).toArrow()
    assert table.num_rows == 32 and len(set(table["range"].to_pylist())) == 32
    keys, counts = map(np.concatenate, zip(*lm._pairs_in(table)))
    want = Counter()
    for t in texts:
        s = [*t.encode(), model.END]
        start = 0
        for i, c in enumerate(s):
            before = s[i - 1] if i else model.END
            want.update([(n, tuple(s[max(0, i - n) : i]) if i < n else tuple(s[i - n : i]), c) for n in model.ORDERS])
            want[("word", before, tuple(s[start:i]), c)] += 1
            start = i + 1 if c == 32 else start
    assert len(set(keys.tolist())) == len(keys) == len(want)
    assert sorted(counts.tolist()) == sorted(want.values())


def test_no_two_contexts_share_a_count():
    rnd = random.Random(4)
    many = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200_000)) for _ in range(3)]
    pairs = model.Pairs(1 << 20)
    pairs.add_texts([as_bytes(t) for t in many])
    keys, counts = pairs.total()
    code = model.Code(model.pair_counts([as_bytes(t) for t in many]))
    # a context that the texts do not have gives no odds, however full the table is
    contexts = model.contexts_of([as_bytes("QQ##QQ##QQ")])
    assert not np.isin(contexts, model.Known(code, keys, counts).contexts).all()
    odds, _ = model.Known(code, keys, counts).places(model.pair_keys(model.symbols_of(as_bytes("##@@##@@")), np.arange(9))[2][5:])
    assert not odds.any()


def test_all_training_folds_are_counted_and_splits_do_not_matter(spark):
    rnd = random.Random(6)
    of = {f: [i for i in range(400) if fold(i) == f] for f in range(7)}
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9)))
    passage = {f: " ".join(word() for _ in range(300)) for f in (0, 3)}
    rows = [(i, " ".join(word() for _ in range(60))) for f in range(7) for i in of[f][2:20]]
    rows += [(of[f][0], passage[f]) for f in passage] + [(of[2][k], passage[f]) for k, f in enumerate(passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = ({r.doc_id: r.score for r in lm.scored(docs.repartition(n)).collect()} for n in (1, 5))
    assert all(abs(one[i] - many[i]) < 1e-6 * abs(one[i]) for i in one)
    per_byte = [one[of[2][k]] / len(passage[f]) for k, f in enumerate(passage)]
    assert per_byte[1] > 1.25 * per_byte[0]  # logs are below 0


def test_tasks_carry_no_tables():
    """What goes out with every task stays small, also once the tables were used here."""
    symbols = np.frombuffer(b" ab ab", np.uint8).astype(np.int16)
    words = model._words(symbols)
    assert words[2] == words[5] != 0 and words[3] != words[2]
    model.contexts_of([np.frombuffer(b"ab c" * 100_000, np.uint8)])
    for run in (lm._corpus_counts, lm._pair_counts(4), lm._merged, lm._requests(4), lm._answers):
        assert len(cloudpickle.dumps(run)) < 200_000


def test_a_range_answers_along_the_pairs_asked_for():
    """However many pairs a context has, a group gets the log odds of those that it asked for."""
    rnd = random.Random(8)
    texts = [as_bytes("".join("ab" + rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000)))]
    counts = model.pair_counts(texts)
    code = model.Code(counts)
    pairs = model.Pairs(1 << 20)
    pairs.add_texts(texts)
    keys, n = pairs.total()
    wanted = model.keys_of([as_bytes("abq")]), model.keys_of([as_bytes("QQ##"), as_bytes("abab")])
    table = lm.pa.table({"range": [0], "n": [len(keys)], "keys": [lm._packed_keys(keys)], "counts": [lm._packed(n)]})
    asked = lm.pa.table({"grp": [5, 9], "n": [*map(len, wanted)], "keys": [*map(lm._packed_keys, wanted)]})
    answers = lm._answers(counts.tobytes())(asked, table)
    assert sorted(answers["grp"].to_pylist()) == [5, 9]
    known = model.Known(code, keys, n)
    for grp, own in zip((5, 9), wanted):
        [row] = [r for r in answers.to_pylist() if r["grp"] == grp]
        assert row["n"] == code.length[model.pairs_at(own)].sum()
        along = lm._along(code, own, 0, answers.filter(lm.pa.array([g == grp for g in answers["grp"].to_pylist()])))
        some = rnd.choices(own.tolist(), k=50)
        for found, start, of, first in [(*along.places(np.array(some, np.uint64)), *known.places(np.array(some, np.uint64)))]:
            for k, a, b in zip(some, start, first):
                m = int(code.length[model.pairs_at(np.array([k], np.uint64))][0])
                assert (found[a : a + m] == of[b : b + m]).all()
        # a pair that the group did not ask for has no odds
        odds, [at] = along.places(np.array([12345 << 18 | 97 << 9 | 98], np.uint64))
        assert not odds[at : at + code.width].any()
    assert model.Along(code, own[:0], np.zeros(0, np.int8)).places(own)[1].tolist() == [0] * len(own)


def plain_score(code, along, weights, text):
    """The log probability of a text of less than a stretch, a bit after the other."""
    symbols = model.symbols_of(text)
    place = np.arange(len(symbols))
    pairs = model.pairs_of(symbols, place)
    odds = []
    for keys in model.pair_keys(symbols, place):
        flat, start = along.places(keys)
        odds.append([flat[a : a + code.length[p]] for a, p in zip(start, pairs)])
    own, total = np.zeros(model.INPUTS), 0.0
    for begin in range(0, len(symbols), model.BLOCK):
        pull, bits = np.zeros(model.INPUTS), 0
        for i in range(begin, min(begin + model.BLOCK, len(symbols))):
            for depth in range(code.length[pairs[i]]):
                x = np.array([o[i][depth] / model.STEPS for o in odds])
                sign = code.sign[pairs[i] * code.width + depth]
                gate = min(depth, model.DEPTHS - 1) * 2 + (x[-2] != 0)
                e = math.exp(-np.clip(sign * ((weights[gate] + own) * x).sum(), -model.LIMIT, model.LIMIT))
                total -= math.log1p(e)
                pull += e / (1 + e) * sign * x
                bits += 1
        own += model.OWN_RATE * pull / math.sqrt(bits)
    return total


def test_odds_in_rows_mix_as_bit_after_bit():
    """Also codes of more than 8 and of more than 12 bits, pairs that were not asked for, long texts."""
    rnd = random.Random(9)
    common = lambda n: "".join(rnd.choice("aaaaaaaabbbbccd ") for _ in range(n))
    rare = [f"{common(40)}{chr(33 + k)}{chr(90 - k % 20)}" for k in range(60)]
    texts = [as_bytes(t) for t in [common(20_000), *rare, "".join(rare), "", "Q"]]
    counts = model.pair_counts(texts[:40])
    code = model.Code(counts)
    assert code.width > 12
    pairs = model.Pairs(1 << 20)
    pairs.add_texts(texts[:40])
    known, keys = model.Known(code, *pairs.total()), model.keys_of(texts[30:])
    along = model.Along(code, keys, known.along(keys)[0])
    every = [k for t in texts for k in model.pair_keys(model.symbols_of(t), np.arange(len(t) + 1))]
    assert max(code.length[model.pairs_at(np.concatenate(every))]) > 8
    weights = np.random.default_rng(1).normal(0.3, 0.1, (model.GATES, model.INPUTS))
    some = texts[25:]
    found = model.Mixer(code, along, weights).score(some)
    assert np.allclose(found, [plain_score(code, along, weights, t) for t in some], rtol=1e-5)


def test_pairs_of_a_group_are_counted_and_asked_for_at_once(spark, monkeypatch):
    """A range answers by the pairs of the other groups where weights are learned, else by all;
    texts that are not counted ask only."""
    texts = {0: [("abab abab", True), ("zq zq", False)], 1: [("abzq", True)]}
    counts = model.pair_counts([as_bytes(t) for some in texts.values() for t, _ in some])
    docs = lambda rows: next(iter(spark.createDataFrame([(0, *r) for r in rows], "id int, text string, counted boolean").coalesce(1).mapInArrow(lm._grouped(0), "grp long, docs binary").collect())).docs
    groups = lm.pa.table({"grp": [*texts], "docs": lm.pa.array([bytes(docs(rows)) for rows in texts.values()], lm.pa.binary())})
    asked = lm.pa.Table.from_batches(lm._requests(0)(groups.to_batches()))
    answers = lm._range(counts.tobytes())(asked).to_pylist()
    code = model.Code(counts)
    for learn, grp, used in ((True, 1, ["abab abab"]), (False, 0, ["abab abab", "abzq"]), (False, 1, ["abab abab", "abzq"])):
        pairs = model.Pairs(1 << 20)
        pairs.add_texts([as_bytes(t) for t in used])
        own = model.keys_of([as_bytes(t) for t, _ in texts[grp]])
        want, _ = model.Known(code, *pairs.total()).along(own)
        [row] = [r for r in answers if (r["learn"], r["grp"]) == (learn, grp)]
        assert (lm._unpacked(row["odds"], row["n"], np.int8) == want).all()
    assert len(answers) == 3
