"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words are
compared with those of each language by the Jensen-Shannon distance. The languages and
their references come from the table: the words that stand in the most documents of a
language, and the histograms summed over all of them. The nearest language counts, whatever
the document's own. A histogram of few words strays by chance, so that much is taken off its
distance, and very short ones are not judged at all; nor are documents of a language that the
table has too little of. A few counts (words, symbols, repeated lines, repeated word windows)
come before that.

Every count is worked out inside the row: windows of three words are hashed, sorted and
compared with their neighbours. What is shuffled are the words of each language, counted in
the map tasks first, and a few sums per language.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.llm.common import SPACES, WORD, saved, text_of

# Common words that are taken of a language, and languages, those with the most documents.
WORDS_EACH, MOST_LANGUAGES = 20, 32
# Documents of ``LEAST_WORDS`` words or more that make a reference.
LEAST_DOCS = 20
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"
FEWEST_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
# Below these sizes a histogram says little and is not judged.
LEAST_CHARS, LEAST_WORDS = 200, 60
MOST_CLASS_DISTANCE = 0.3
MOST_WORD_DISTANCE = 0.2
# The distance by chance is taken off this many times.
CHANCE = 1.5


def _let(value, body):
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _only(text, inside):
    """How many characters of a class (as in brackets of a pattern) a text holds."""
    return F.char_length(F.regexp_replace(text, f"[^{inside}]+", "")).cast("long")


def words_in(text):
    """The words of a text, cut at one character: a pattern would be tried at every one."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def repeated_words(words):
    """Words that lie in a window of three words found at least twice in the list."""

    def covered(starts):
        step = F.transform(
            starts, lambda at, k: F.coalesce(F.least(F.lit(WINDOW), F.get(starts, k + 1) - at), F.lit(WINDOW))
        )
        return F.aggregate(step, F.lit(0), lambda a, b: a + b).cast("long")

    def twice(windows):
        placed = F.sort_array(F.transform(windows, lambda w, k: F.struct(w.alias("h"), k.alias("at"))))
        same = _let(placed, lambda found: F.filter(
            found,
            lambda w, k: F.coalesce(F.get(found, k - 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get(found, k + 1)["h"] == w["h"], F.lit(False)),
        ))
        return _let(F.sort_array(F.transform(same, lambda w: w["at"])), covered)

    def any_twice(windows):
        # most texts repeat no window: no need to know where
        none = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(none, F.lit(0).cast("long")).otherwise(twice(windows))

    def windows(hashes):
        at = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        found = F.transform(at, lambda k: F.xxhash64(*(F.get(hashes, k + j) for j in range(WINDOW))))
        return _let(found, any_twice)

    counted = _let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(counted)


def _bare(words):
    """Words in lower case without the marks behind them."""
    return F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(MARKS)))


def _known_words(words, vocabulary):
    """The words of ``vocabulary`` in a list, marks behind them aside, as one line."""
    if not vocabulary:
        return F.lit("")
    known = F.filter(_bare(words), lambda w: w.isin(vocabulary))
    return F.concat(F.lit(" "), F.array_join(known, "  "), F.lit(" "))


def _word_counts(vocabulary):
    """How often each word of ``vocabulary`` stands in the column ``line``: w0, w1, ..."""
    line = F.col("line")
    return [
        ((F.octet_length(line) - F.octet_length(F.replace(line, F.lit(f" {w} "), F.lit("")))) / (len(w.encode()) + 2)).cast("long").alias(f"w{k}")
        for k, w in enumerate(vocabulary)
    ]


def common_words(docs, text_col="text", lang_col="lang"):
    """{language: its ``WORDS_EACH`` words found in the most documents, ties by code point}.

    Of the ``MOST_LANGUAGES`` languages with the most documents of ``LEAST_WORDS`` words or
    more, those with at least ``LEAST_DOCS``; without a language column all documents are of
    one. So the driver gets a bounded number of rows.
    """
    words = F.transform(words_in(F.lower(text_of(text_col))), lambda w: F.rtrim(w, F.lit(MARKS)))
    # an empty word stands for the document itself, and is what a word of marks leaves
    seen = _let(words, lambda found: F.when(
        F.size(F.array_remove(found, "")) >= LEAST_WORDS, F.array_union(F.array(F.lit("")), found)
    ))
    rows = docs.filter(_language(docs, lang_col).isNotNull())
    # the planner adds filters on what a plain explode reads, which cut every text once more
    rows = rows.select(_language(docs, lang_col).alias("lang"), F.explode_outer(seen).alias("word"))
    counts = rows.filter(F.col("word").isNotNull()).groupBy("lang", "word").agg(F.count("*").alias("n"))
    # the empty word is in every document, so it is always first
    order = W.partitionBy("lang").orderBy(F.col("n").desc(), F.col("word"))
    best = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= WORDS_EACH + 1)
    best = saved(best, "common-words")
    sizes = best.filter("word = ''").filter(F.col("n") >= LEAST_DOCS).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES)
    found = {r.lang: [] for r in sizes.select("lang").collect()}
    for r in best.filter(F.col("lang").isin(list(found)) & (F.col("word") != "")).orderBy("lang", "place").collect():
        found[r.lang].append(r.word)
    return found


def _language(docs, lang_col):
    return F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit("")


def measured(docs, vocabulary, id_col="doc_id", text_col="text", lang_col="lang"):
    """The counts of every document that rules and references are made of."""
    rows = docs.select(
        F.col(id_col).alias("id"), _language(docs, lang_col).alias("lang"), text_of(text_col).alias("text")
    ).withColumn("words", words_in(F.col("text")))
    # the whole text is gone through once for letters; what is left is small
    rows = rows.withColumn("rest", F.regexp_replace("text", "[a-z]+", ""))
    rows = rows.withColumn("solid", F.regexp_replace("rest", SPACES, ""))
    text, words = F.col("text"), F.col("words")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    rows = rows.withColumn("line", _known_words(F.col("words"), vocabulary))
    counted = rows.select(
        "id", "lang",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(text).cast("long").alias("n_chars"),
        (F.char_length(text) - F.char_length("rest") + F.char_length("solid")).cast("long").alias("word_chars"),
        _only(F.col("solid"), SYMBOLS).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        (F.char_length(text) - F.char_length("rest")).cast("long").alias("lower"),
        _only(F.col("solid"), "A-Z").alias("upper"), _only(F.col("solid"), "0-9").alias("digits"),
        _only(F.col("solid"), MARKS).alias("marks"),
        *_word_counts(vocabulary),
    )
    others = F.col("word_chars") - F.col("lower") - F.col("upper") - F.col("digits") - F.col("marks") - F.col("n_symbols")
    classes = ["lower", "upper", "digits", "marks", "n_symbols", others, F.col("n_chars") - F.col("word_chars")]
    kept = [c for c in counted.columns if c not in ("lower", "upper", "digits", "marks")]
    return counted.select(*kept, *((F.col(c) if isinstance(c, str) else c).alias(f"c{k}") for k, c in enumerate(classes)))


CLASSES = 7


def references(counts, languages, vocabulary):
    """Summed histograms per language: {lang: (classes, words, common counts)}.

    One row per language reaches the driver.
    """
    sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(CLASSES)]
    sums += [F.sum(f"w{k}").alias(f"w{k}") for k in range(len(vocabulary))]
    known = counts.filter(F.col("lang").isin(list(languages)) & (F.col("n_words") >= LEAST_WORDS))
    rows = known.groupBy("lang").agg(F.sum("n_words").alias("n"), *sums).collect()
    return {
        r.lang: ([r[f"c{k}"] for k in range(CLASSES)], r.n, [r[f"w{k}"] for k in range(len(vocabulary))])
        for r in rows
    }


def distance(shares, reference):
    """Jensen-Shannon distance (0..1) of a histogram, columns that add up to 1, and a fixed
    one; null if the shares are."""
    total = float(sum(reference))
    out = F.lit(0.0)
    for p, fixed in zip(shares, reference):
        q = fixed / total
        if not q:
            # what only one side has counts in full
            out = out + p
            continue
        more = F.when(p > 0, p * F.log2(p / ((p + q) / 2))).when(p.isNotNull(), F.lit(0.0))
        out = out + more + q * F.log2(q / ((p + q) / 2))
    return F.sqrt(F.greatest(out / 2, F.lit(0.0) * out))


def without_chance(found, bins, size):
    """A distance less what ``size`` draws over ``bins`` classes differ by on average."""
    by_chance = F.lit(CHANCE * bins / (8 * math.log(2))) / F.greatest(size, F.lit(1))
    return F.when(found.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), found * found - by_chance)))


def _nearest(found):
    return F.array_min(F.array(*found)) if found else F.lit(None).cast("double")


def judged(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """One row per row of ``docs`` with its counts, distances and verdict.

    Columns: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``class_distance``, ``word_distance``, ``kept``.
    A null text has no words and fails. Where the table has too few documents of a document's
    language for a reference (see ``common_words``), its distances are null and only the counts
    judge; a null language is judged by the nearest. Texts without words have no distances.
    Null ids and repeated rows are rows like others; an empty table gives no rows.
    """
    languages = common_words(docs, text_col, lang_col)
    vocabulary = sorted({w for words in languages.values() for w in words})
    counts = saved(measured(docs, vocabulary, id_col, text_col, lang_col), "rule-counts")
    known = references(counts, languages, vocabulary)
    # step by step, in projections of their own: no value is worked out twice
    own = {lang: [vocabulary.index(w) for w in languages[lang]] for lang in sorted(known)}
    rows = counts.select(
        "*", *(F.try_divide(F.col(f"c{k}").cast("double"), F.col("n_chars")).alias(f"cs{k}") for k in range(CLASSES)),
        *(F.try_divide(F.col(f"w{k}").cast("double"), F.col("n_words")).alias(f"ws{k}") for k in range(len(vocabulary))),
    )
    rows = rows.select(
        "*", *(F.greatest(F.lit(0.0), 1 - reduce(lambda a, b: a + b, [F.col(f"ws{k}") for k in at])).alias(f"rest{n}") for n, at in enumerate(own.values())),
    )
    far = []
    for n, (lang, at) in enumerate(own.items()):
        by_class, total, by_word = known[lang]
        bins = [by_word[k] for k in at]
        far.append(distance([F.col(f"cs{k}") for k in range(CLASSES)], by_class).alias(f"class{n}"))
        far.append(distance([*(F.col(f"ws{k}") for k in at), F.col(f"rest{n}")], [*bins, total - sum(bins)]).alias(f"word{n}"))
    rows = rows.select("id", "lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *far)
    judgeable = F.col("lang").isNull() | F.col("lang").isin(list(known))
    near = (
        _nearest([F.col(f"class{n}") for n in range(len(own))]),
        _nearest([without_chance(F.col(f"word{n}"), len(at) + 1, F.col("n_words")) for n, at in enumerate(own.values())]),
    )
    class_distance, word_distance = (F.when(judgeable, found) for found in near)
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    rated = rows.select(
        "*", failed.alias("base_failed"), class_distance.alias("class_distance"), word_distance.alias("word_distance")
    )
    odd_classes = (F.col("n_chars") >= LEAST_CHARS) & (F.col("class_distance") > MOST_CLASS_DISTANCE)
    odd_words = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORD_DISTANCE)
    odd = F.coalesce(odd_classes, F.lit(False)) | F.coalesce(odd_words, F.lit(False))
    return rated.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "class_distance", "word_distance", (~F.col("base_failed") & ~odd).alias("kept"),
    )
