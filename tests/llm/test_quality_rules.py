"""Quality rules: counts and distances against plain Python, verdicts against labels, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np

from packetloom.llm import quality_rules as rules
from packetloom.llm import queries


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_counts_against_a_plain_loop(spark, docs_dir):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{docs_dir}/documents.parquet").collect()}
    rows = queries.op8_quality_rules(spark, docs_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert counts(r) == plain_counts(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "a", "a a a", "a a a a", "a b c a b c", "a b\n\na b\n \na b", "日本 # 日本", "x " * 30_000]
    texts += ["a b c " * 3, "# " * 200]
    docs = spark.createDataFrame(
        [(None if k == 3 else k // 2, t, None, 1) for k, t in enumerate(texts)],
        "doc_id long, text string, lang string, n_words int",
    )
    rows = rules.judged(docs).collect()
    assert Counter(map(counts, rows)) == Counter(map(plain_counts, texts))
    assert all(r.class_distance is None and r.word_distance is None for r in rows)
    assert rules.judged(docs.limit(0)).count() == 0


def test_distance_against_numpy(spark):
    mine, reference = [3, 0, 7, 5], [10, 4, 0, 6]
    p, q = np.array(mine) / 15, np.array(reference) / 20
    m = (p + q) / 2

    def kl(a):
        return sum(x * math.log2(x / y) for x, y in zip(a, m) if x)

    df = spark.createDataFrame([(mine,), ([0, 0, 0, 0],)], "bins array<long>")
    from pyspark.sql import functions as F

    size = F.aggregate("bins", F.lit(0).cast("long"), lambda a, b: a + b)
    shares = [F.try_divide(F.col("bins")[k].cast("double"), size) for k in range(4)]
    got = [r[0] for r in df.select(rules.distance(shares, reference)).collect()]
    assert abs(got[0] - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12
    assert got[1] is None


def test_clean_documents_stay_and_junk_goes(spark, docs_dir):
    labels = spark.read.parquet(f"{docs_dir}/labels.parquet")
    rows = queries.op8_quality_rules(spark, docs_dir).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.5


def test_no_python_in_the_plan(spark, docs_dir):
    plan = queries.op8_quality_rules(spark, docs_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


ITALIAN = "il la di che e un per non una sono con le del in ma alla nel si come al casa tempo giorno mare".split()
ENGLISH = "the of and to in is that for it with as was on be by are this at or from house time day sea".split()


def _prose(words, k, n=150):
    return " ".join(random.Random(k).choices(words, k=n))


def test_references_come_from_the_table(spark):
    """Any language with enough documents has its own common words; texts without words have no distance."""
    rows = [(k, _prose(ITALIAN, k), "it") for k in range(30)] + [(100 + k, _prose(ENGLISH, k), "en") for k in range(30)]
    rows += [(200, "", "it"), (201, None, "en"), (202, " \n", "it"), (203, _prose(ENGLISH, 3), None), (204, None, None)]
    rows += [(300, " ".join(f"q{j}z" for j in range(90)), "en"), (301, " ".join(f"q{j}z" for j in range(90)), "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = rules.common_words(docs)
    assert set(words) == {"it", "en"} and all(len(v) == rules.WORDS_EACH for v in words.values())
    assert set(words["it"]) <= set(ITALIAN)
    got = {r.doc_id: r for r in rules.judged(docs).collect()}
    assert len(got) == len(rows)
    prose = [*range(30), *range(100, 130), 203]
    assert max(got[k].word_distance for k in prose) < got[300].word_distance / 2
    assert all(got[k].class_distance is None and not got[k].kept for k in (200, 201, 204))
    assert got[202].class_distance is not None and got[202].word_distance is None
    assert got[300].word_distance > rules.MOST_WORD_DISTANCE and not got[300].kept
    # no reference for its language: only the counts judge
    assert got[301].word_distance is None and got[301].kept


def test_no_language_column(spark):
    rows = [(k, _prose(ITALIAN, k)) for k in range(30)] + [(99, "")]
    got = rules.judged(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 31 and all(r.word_distance < rules.MOST_WORD_DISTANCE for r in got if r.doc_id != 99)


def test_words_are_cut_without_a_pattern(spark):
    """Words as the pattern finds them, and no plan that tries a pattern at every character."""
    texts = ["", " ", "a", "\ta\n\nb\x0bc\x0cd\re  ", "\x1ca\x1f b\xa0c d e \x85", "x, .; y.z? ,.,", None, "$1 \\ .|("]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = docs.select("text", rules.words_in(rules.F.col("text")).alias("words")).collect()
    assert [r.words for r in found] == [None if t is None else re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    measured = rules.measured(docs.selectExpr("1L AS doc_id", "text"), ["a"])
    assert "regexp_extract_all" not in measured._jdf.queryExecution().toString()


def test_common_words_without_their_marks(spark):
    rnd = random.Random(2)
    words = ["Alpha,", "beta", "beta.", "GAMMA?!", "a.b", "...", "Σίσυφος", "ß;", ",x"]
    texts = [rnd.choice([" ", "\n", "\t "]).join(rnd.choice(words) for _ in range(rnd.randrange(40, 90))) for _ in range(120)]
    want = Counter()
    docs = 0
    for t in texts:
        bare = re.findall(r"[^\x20\x09-\x0D]*[^\x20\x09-\x0D.,;:!?]", t.lower())
        if len(bare) >= rules.LEAST_WORDS:
            want.update(set(bare))
            docs += 1
    assert 20 <= docs < 120
    rows = spark.createDataFrame([("de", t) for t in texts] + [(None, t) for t in texts], "lang string, text string")
    assert rules.common_words(rows) == {"de": sorted(want, key=lambda w: (-want[w], w))}
