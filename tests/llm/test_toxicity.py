"""The toxicity lexicon: folding, matching against a plain search, learned forms, odd rows."""

import pytest

from packetloom.llm import queries, toxicity


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("You ID10T!", "idiot"), ("m0r0n", "moron"), ("іdіоt", "idiot"), ("ｓｃｕｍ", "scum"),
        ("tra​sh", "trash"), ("5tupid$$$", "stupid"), ("idiot.", "idiot"),
    ],
)
def test_folding(text, word):
    assert f" {word} " in toxicity.fold(text)


def test_numbers_and_empty_texts_stay():
    assert toxicity.fold("3. 100 $5 a") == " a "
    assert toxicity.fold("") == "  "


def test_one_read_as_l():
    machine = toxicity.automaton({"clown ": 2.0})
    assert toxicity.matched(machine, "c1own clown")[0] == 4.0


def test_matches_against_a_plain_search():
    lexicon = {"idiot ": 2.0, "lowei": 3.0}
    machine = toxicity.automaton(lexicon, ("idiot proof",))
    text = "Idiot idiot proof, loweiä slowei idiots idiot"
    words = toxicity.fold(text).split()
    plain = sum(3.0 for w in words if w.startswith("lowei"))
    plain += sum(2.0 for k, w in enumerate(words) if w == "idiot" and words[k + 1 : k + 2] != ["proof"])
    assert toxicity.matched(machine, text) == (plain, len(words))


def test_stems_and_words_are_learned(spark):
    ends = ["an", "bei", "cor", "dun", "ell"]
    rows = [(k, f"der mann und die lowei{ends[k % 5]} im haus grobian {k}") for k in range(40)]
    rows += [(100 + k, f"der mann und die frau im haus lowen {k}") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels)[0]
    assert "lowei" in lexicon and "grobian " in lexicon and "und " not in lexicon
    scored = {r.doc_id: r for r in toxicity.verdicts(toxicity.scored(docs, toxicity.train(docs, labels))).collect()}
    assert all(scored[i].predicted == (i < 100) for i, _ in rows)
    assert sorted(r.doc_id for r in toxicity.clean(docs, toxicity.train(docs, labels)).collect()) == list(range(100, 180))


def test_held_out_rows(spark, docs_dir):
    scored = queries.op6_toxicity(spark, docs_dir)
    rows = scored.join(spark.read.parquet(f"{docs_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.85 * len(rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, "", "x"), (None, "idiot moron", "x"), (None, "idiot moron", "x"), (2, "fine " * 99999, "x")],
        "doc_id long, text string, weight string",
    )
    labels = spark.createDataFrame([(None, None), (1, 0)], "doc_id long, toxic int")
    rows = toxicity.verdicts(toxicity.scored(docs, toxicity.train(docs, labels))).collect()
    assert sorted(r.predicted for r in rows) == [0, 0, 0, 1, 1]
    none = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.scored(docs.limit(0), none).count() == 0
    assert toxicity.clean(docs, none).columns == docs.columns
