"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits inside words to
Latin letters, drops invisible characters and turns everything between words into one
space. The lexicon holds whole words (' word ') and word beginnings (' stem'). It starts
from a short general list and is weighted and extended from labelled texts: a form
enters when it is much more frequent in toxic texts than in others (log-likelihood
ratio), at the length at which it is most specific without losing texts. Matches inside
an exception phrase do not count. A text scores by the weight of its matches, divided by
a root of its length, through a logistic curve fitted to the same labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from packetloom.llm.common import id_fold, labelled_sample, lean, same_columns, small_batches, text_of

FOLDS, HELD = 3, 1
PER_CLASS = 3000
FLAG_SCORE = 0.7
# A form enters the lexicon from this log-likelihood ratio and log odds on.
LEAST_RATIO, LEAST_WEIGHT = 25.0, math.log(8)
SEED_WEIGHT = 3.0
MOST_FORMS = 20_000
STEMS = range(3, 11)
LENGTH_POWER = 0.5

SEED_WORDS = (
    "asshole", "bastard", "bitch", "clown", "cretin", "disgusting", "dumbass", "idiot", "imbecile",
    "loser", "moron", "pathetic", "scum", "scumbag", "stupid", "trash", "vermin", "worthless",
)
EXCEPTIONS = ("clown fish", "pathetic fallacy", "trash bin", "trash can", "vermin control")

# Letters of other scripts and the Latin letters they look like.
LOOK_ALIKES = str.maketrans(
    "аеорсухіјѕԁһԛԝвнкмтгпαονρτυικεηωβ",
    "aeopcyxijsdhqwbhkmtrnaovptuikenwb",
)
# Characters that stand in for letters inside a word.
STAND_INS = str.maketrans("0134578@$", "oieastbas")

_OTHER_SCRIPT = re.compile("[Ͱ-ԯ]")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_STANDING_IN = re.compile(r"[0134578@$]")
_STAND_IN = re.compile(r"(?<=[^\W\d_])[0134578@]+|[0134578@$]+(?=[^\W\d_])")
_WORDS = re.compile(r"[^\W\d_]+")


def fold(text):
    """The words of a text, folded, with one space around each."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = _HIDDEN.sub("", text)
    text = text.lower()
    if not text.isascii() and _OTHER_SCRIPT.search(text):
        text = text.translate(LOOK_ALIKES)
    if _STANDING_IN.search(text):
        text = _STAND_IN.sub(lambda m: m[0].translate(STAND_INS), text)
    return f" {' '.join(_WORDS.findall(text))} "


def forms(folded):
    """The distinct words ('word ') and stems ('wor') of a folded text."""
    found = set()
    for word in set(folded.split()):
        found.add(word + " ")
        found.update(word[:k] for k in STEMS if k <= len(word))
    return found


def _count_forms(batches):
    """(text, label) -> (form, toxic, other): in how many texts a form occurs."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            counts[label].update(forms(fold(text)))
    names = list(counts[0] | counts[1])
    for k in range(0, len(names), 50_000):
        part = names[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([counts[1][f] for f in part], pa.int64()), pa.array([counts[0][f] for f in part], pa.int64())],
            names=["form", "toxic", "other"],
        )


def _entropy_terms(*cells):
    out = F.lit(0.0)
    for c in cells:
        out = out + F.when(c > 0, c * F.log(c)).otherwise(F.lit(0.0))
    return out


def choose(candidates, seeds=SEED_WORDS, least=LEAST_WEIGHT):
    """(form, toxic, weight, ratio, other) rows -> lexicon form -> weight.

    Of related forms (one begins the other) the one with the highest ratio enters; a stem
    gives way to a longer form that covers its texts.
    """
    by_form = {c[0]: c for c in candidates}
    longer = Counter()
    for form, toxic, *_ in candidates:
        for k in range(1, len(form)):
            longer[form[:k]] = max(longer[form[:k]], toxic)
    out, begun = {}, set()
    for form, toxic, weight, ratio, _ in sorted(candidates, key=lambda c: (-c[3], c[0])):
        if ratio < LEAST_RATIO or weight < least or longer[form] >= 0.98 * toxic:
            continue
        if form in begun or any(form[:k] in out for k in range(1, len(form))):
            continue
        out[form] = weight
        begun.update(form[:k] for k in range(1, len(form)))
    for word in seeds:
        form = word + " "
        if any(form[:k] in out for k in range(1, len(form) + 1)):
            continue
        seen = by_form.get(form)
        weight = seen[2] if seen and seen[1] + seen[4] >= 5 else SEED_WEIGHT
        if weight > 0:
            out[form] = weight
    return out


def automaton(lexicon, exceptions=EXCEPTIONS):
    """Aho-Corasick over ' word ', ' stem' and ' exception phrase '."""
    found = ahocorasick.Automaton()
    for form, weight in lexicon.items():
        found.add_word(" " + form, (len(form) + 1, weight))
        if form.endswith(" ") and "l" in form:
            # a 1 was read as i
            found.add_word(" " + form.replace("l", "i"), (len(form) + 1, weight))
    for phrase in exceptions:
        found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
    found.make_automaton()
    return found


def matched(machine, text):
    """Weight of the matches in a text, and its number of words."""
    folded = fold(text)
    hits, spared = [], []
    for end, (size, weight) in machine.iter(folded):
        (hits if weight else spared).append((end - size + 1, end, weight))
    total = sum(
        weight for begin, end, weight in hits if not any(a <= begin and end <= b for a, b, _ in spared)
    )
    return total, folded.count(" ") - 1


def density(weight, words):
    return np.log1p(np.asarray(weight, float) / (1 + np.asarray(words, float) / 100) ** LENGTH_POWER)


def _matches(machine):
    def run(batches):
        found = machine.value
        for batch in batches:
            pairs = [matched(found, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p[0] for p in pairs], pa.float64()),
                    pa.array([p[1] for p in pairs], pa.int64()),
                ],
                names=[batch.schema.names[0], "weight", "words"],
            )

    return run


def curve(x, y, ridge=0.05, steps=100):
    """Intercept and slope of a logistic regression with a light ridge on the slope; a
    fixed curve where only one label was seen."""
    if len(set(y)) < 2:
        return -3.0, 3.0
    a = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(2), np.diag([1e-6, ridge])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
    return float(w[0]), float(max(w[1], 0.0))


def train(docs, labels, column="toxic", folds=FOLDS, held=HELD, per_class=PER_CLASS, id_col="doc_id", text_col="text", exceptions=EXCEPTIONS):
    """A model (lexicon, exceptions, intercept, slope) from at most ``per_class`` texts of
    each label; without texts of both labels the general list and a fixed curve remain."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, column, folds, held, per_class, id_col, text_col)
    counted = (
        sample.select("text", "label").mapInArrow(lean(_count_forms), "form string, toxic long, other long")
        .groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    n = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    yes, no = float(n.get(1, 0)), float(n.get(0, 0))
    a, b = F.col("toxic").cast("double"), F.col("other").cast("double")
    rest_a, rest_b = F.lit(yes) - a, F.lit(no) - b
    whole = F.lit(yes + no)
    ratio = 2 * (
        _entropy_terms(a, b, rest_a, rest_b, whole)
        - _entropy_terms(a + b, rest_a + rest_b, F.lit(yes), F.lit(no))
    )
    weight = F.log((a + 0.5) / (yes + 1)) - F.log((b + 0.5) / (no + 1))
    rated = counted.select("form", "toxic", weight.alias("weight"), ratio.alias("ratio"), "other")
    seeds = [w + " " for w in SEED_WORDS]
    picked = rated.filter(
        F.col("form").isin(seeds) | (F.col("ratio") >= LEAST_RATIO) & (F.col("weight") >= LEAST_WEIGHT)
    ).orderBy(F.col("form").isin(seeds).desc(), F.col("ratio").desc(), "form").limit(MOST_FORMS)
    lexicon = choose([tuple(r) for r in picked.collect()])
    shared = docs.sparkSession.sparkContext.broadcast(automaton(lexicon, exceptions))
    seen = sample.select("label", "text").mapInArrow(lean(_matches(shared)), "label int, weight double, words long").collect()
    x = density([r.weight for r in seen], [r.words for r in seen])
    return lexicon, exceptions, *curve(x, np.array([r.label for r in seen], float))


def scored(docs, model, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: id and ``score``, the probability of toxicity.

    Whole texts are read. A null or empty text has no match. Null ids and repeated rows
    are rows like others; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    lexicon, exceptions, intercept, slope = model
    shared = docs.sparkSession.sparkContext.broadcast(automaton(lexicon, exceptions))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = texts.mapInArrow(lean(_matches(shared)), same_columns(docs, id_col, weight="double", words="long"))
    x = F.log1p(F.col("weight") / F.pow(1 + F.col("words") / 100, F.lit(LENGTH_POWER)))
    return found.select(
        F.col("id").alias(id_col), (1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * x)))).alias("score")
    )


def verdicts(scores, folds=FOLDS, held=HELD, id_col="doc_id"):
    """Adds ``held_out`` and ``predicted``."""
    return scores.select(
        id_col,
        (id_fold(id_col, folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= FLAG_SCORE).cast("int").alias("predicted"),
    )


def clean(docs, model, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` whose text is not flagged, with all their columns."""
    small_batches(docs.sparkSession)
    lexicon, exceptions, intercept, slope = model
    shared = docs.sparkSession.sparkContext.broadcast(automaton(lexicon, exceptions))
    at = docs.columns.index(text_col)
    limit = math.log(FLAG_SCORE / (1 - FLAG_SCORE))

    def run(batches):
        for batch in batches:
            pairs = [matched(shared.value, t or "") for t in batch.column(at).to_pylist()]
            x = density([p[0] for p in pairs], [p[1] for p in pairs])
            yield batch.filter(pa.array(intercept + slope * x < limit))

    return docs.mapInArrow(lean(run), docs.schema)
