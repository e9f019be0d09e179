"""Secret scans over a trigram index, in DataFrame functions only.

From every rule's pattern a Boolean trigram query is derived: an OR of sets of trigrams,
one set for each literal that a match must hold. A pass over the documents makes
postings (trigram, document) for the trigrams that the rules ask for; intersecting them
gives the candidates of each rule, and only those are searched with the pattern. Rules
without a mandatory trigram are searched in every text, in the same pass that finds the
trigrams. The index is on lower-cased text, so it serves patterns in either case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import functions as F

from packetloom.llm.common import saved, text_of

_parser, _constants = re._parser, re._constants
# More literals than this make a query too wide to help; the run is given up.
MOST_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """Matches are leftmost and do not overlap; those whose ``group`` has fewer than
    ``least`` characters are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def _literals(items):
    """Runs of literals that a match must hold: a list of sets of strings."""
    runs, now = [], {""}

    def times(now, more):
        out = {a + b for a in now for b in more}
        return out if len(out) <= MOST_LITERALS else None

    for op, value in items:
        more = None
        if op is _constants.LITERAL:
            more = {chr(value).lower()}
        elif op is _constants.IN and all(o is _constants.LITERAL for o, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif op is _constants.SUBPATTERN:
            inner = _literals(value[3])
            more = inner[0] if len(inner) == 1 else None
            if more is None:
                runs += inner
        elif op is _constants.BRANCH:
            branches = [_literals(b) for b in value[1]]
            if all(len(b) == 1 for b in branches):
                more = set().union(*(b[0] for b in branches))
        elif op is _constants.MAX_REPEAT:
            low, high, inner = value[0], value[1], _literals(value[2])
            if len(inner) == 1 and (low, high) == (0, 1):
                more = inner[0] | {""}
            elif len(inner) == 1 and low and (repeated := times(now, inner[0])):
                # at least one; what follows it is open
                runs.append(repeated)
        joined = times(now, more) if more is not None else None
        if joined is None:
            runs.append(now)
            now = more or {""}
        else:
            now = joined
    return [*runs, now] if runs else [now]


def trigram_query(pattern):
    """The trigrams a match must hold: a list of sets, of which one must be there whole.

    Empty when the pattern has no mandatory trigram.
    """
    best = []
    for run in _literals(_parser.parse(pattern)):
        if min(map(len, run)) < 3:
            continue
        sets = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in run}
        sets = [s for s in sets if not any(t < s for t in sets)]
        if not best or min(map(len, sets)) > min(map(len, best)):
            best = sets
    return sorted(best, key=sorted)


MATCHES_TOGETHER = 256


def find(text, rule, order):
    """A rule's matches in a text column: array of (begin, order, end), in code points.

    The text is split at the matches; lengths of the parts between and of the matches
    give the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    parts = F.zip_with(
        F.slice(between, 1, F.size(whole)),
        F.zip_with(whole, tested, lambda w, t: F.struct(F.char_length(w).alias("size"), F.char_length(t).alias("tested"))),
        lambda b, m: F.struct(F.char_length(b).alias("gap"), m["size"].alias("size"), m["tested"].alias("tested")),
    )
    none = F.array().cast("array<struct<begin:int,order:int,end:int>>")

    def step(acc, p):
        begin = acc["at"] + p["gap"]
        end = begin + p["size"]
        span = F.struct(begin.alias("begin"), F.lit(order).alias("order"), end.alias("end"))
        kept = F.when(p["tested"] >= rule.least, F.array_append(acc["found"], span)).otherwise(acc["found"])
        return F.struct(end.alias("at"), kept.alias("found"))

    def spans(blocks):
        # where each block begins, then inside the blocks: appending copies a block, not all matches
        length = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, p: n + p["gap"] + p["size"]))
        starts = F.aggregate(length, F.array(F.lit(0)), lambda at, n: F.array_append(at, F.element_at(at, -1) + n))
        return F.transform(F.array(starts), lambda at: F.flatten(F.transform(
            blocks,
            lambda b, k: F.aggregate(
                b, F.struct(F.get(at, k).alias("at"), none.alias("found")), step, lambda acc: acc["found"]
            ),
        )))[0]

    def blocks_of(every):
        last = F.floor((F.size(every) - 1) / MATCHES_TOGETHER).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(every, k * MATCHES_TOGETHER + 1, F.lit(MATCHES_TOGETHER)))

    found = F.transform(F.transform(F.array(parts), blocks_of), spans)[0]
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


def trigrams_in(text, trigrams):
    """Those of the trigrams that stand in a lower-cased text, which is made once."""

    def held(low):
        return F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams)))

    return F.transform(F.array(F.lower(text)), held)[0]


def postings(scanned):
    """(trigram, id, hash) rows of the trigrams found, in ranges of the trigram; hash and
    id in the range key split frequent trigrams and groups of copies."""
    listed = scanned.select(F.explode("trigrams").alias("trigram"), "id", "hash")
    order = ["trigram", "hash", "id"]
    return saved(listed.repartitionByRange(*order).sortWithinPartitions(*order), "trigram-postings")


def candidates(index, queries):
    """(id, hash, kinds) of the texts that hold what the ``kind -> query`` ask for.

    Postings meet the few query trigrams and are put together per text and set as bits.
    """
    spark = index.sparkSession
    lines = [
        (kind, nth, trigram, 1 << bit, (1 << len(one)) - 1)
        for kind, query in queries.items()
        for nth, one in enumerate(query)
        for bit, trigram in enumerate(sorted(one))
    ]
    wanted = spark.createDataFrame(lines, "kind string, nth int, trigram string, bit long, full long")
    met = (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("id", "hash", "kind", "nth", "full").agg(F.bit_or("bit").alias("bits"))
        .filter("bits = full")
    )
    return met.groupBy("id", "hash").agg(F.collect_set("kind").alias("kinds"))


def secret_spans(docs, rules=RULES, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: id and ``found``, an array of (begin, order, end),
    sorted by begin, then by the order of the rules; ends are exclusive, code points.

    A null text is an empty one. Rows are told apart by id and a 64-bit hash of the text,
    so null ids, repeated ids and repeated rows each get the spans of their own text; an
    empty table gives no rows.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    numbered = list(enumerate(rules))
    none = F.array().cast("array<struct<begin:int,order:int,end:int>>")
    open_rules = [find(F.col("text"), r, k) for k, r in numbered if not queries[r.kind]]
    asked = {kind: q for kind, q in queries.items() if q}
    trigrams = sorted({t for q in asked.values() for one in q for t in one})
    held = trigrams_in(F.col("text"), trigrams) if trigrams else F.array().cast("array<string>")
    scanned = saved(
        rows.select("id", "hash", held.alias("trigrams"), F.concat(none, *open_rules).alias("scanned")), "secret-scans"
    )
    picked = candidates(postings(scanned), asked)
    same = F.col("c.id").eqNullSafe(F.col("r.id")) & (F.col("c.hash") == F.col("r.hash"))
    searched = [
        F.when(F.array_contains("kinds", r.kind), find(F.col("text"), r, k)).otherwise(none)
        for k, r in numbered
        if queries[r.kind]
    ]
    verified = (
        rows.alias("r").join(picked.alias("c"), same).select("r.id", "r.hash", F.concat(none, *searched).alias("verified"))
        .filter(F.size("verified") > 0)
        .groupBy("id", "hash").agg(F.first("verified").alias("verified"))
    )
    same = F.col("v.id").eqNullSafe(F.col("s.id")) & (F.col("v.hash") == F.col("s.hash"))
    return scanned.alias("s").join(verified.alias("v"), same, "left").select(
        F.col("s.id").alias(id_col),
        F.array_sort(F.concat("scanned", F.coalesce("verified", none))).alias("found"),
    )


def digests(found, rules=RULES, id_col="doc_id"):
    """Counts and digests of the spans: base rules by count and hash, all as text."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    base = [k for k, r in enumerate(rules) if r.base]

    def line(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["begin"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(k):
        return F.size(F.filter("found", lambda s: s["order"] == k)).cast("long")

    of_base = F.filter("found", lambda s: s["order"].isin(base))
    return found.select(
        id_col,
        *(count(k).alias(f"n_{rules[k].kind}") for k in base),
        F.sha2(line(of_base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )
