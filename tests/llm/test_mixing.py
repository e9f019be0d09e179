"""The mix against SQL, its targets by repeated sharing, schedules, and odd rows."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from packetloom.llm import mixing, queries


def shared(sizes):
    """Targets by giving out and taking back what exceeds three times the size."""
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        share = left / sum(weights[k] for k in open_)
        over = {k for k in open_ if share * weights[k] > 3 * sizes[k]}
        if not over:
            for k in open_:
                target[k] = share * weights[k]
            break
        for k in over:
            target[k] = 3.0 * sizes[k]
            left -= target[k]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 2, 3, 500, 7, 0], [5], [0, 0], [1, 1, 1000, 1, 1, 1]])
def test_targets(spark, sizes):
    rows = [(f"+s{k:02}", f"s{k:02}", n) for k, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "src string, source string, source_size long")
    got = {r.src[1:]: r.target for r in mixing.source_targets(df).collect()}
    for (_, name, _), want in zip(rows, shared(sizes)):
        assert math.isclose(got[name], want, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("knots", mixing.SCHEDULES)
def test_demand_is_inverted(spark, knots):
    def demand(t):
        total = 0.0
        for (a, u), (b, v) in zip(knots, knots[1:]):
            end = min(t, b)
            if end > a:
                at = u + (v - u) * (end - a) / (b - a)
                total += (end - a) * (u + at) / 2
        return total

    parts = [k / 20 for k in range(21)]
    df = spark.createDataFrame([(p,) for p in parts], "p double")
    times = [r[0] for r in df.select(mixing.demand_time(F.col("p"), knots)).collect()]
    assert times == sorted(times)
    for p, t in zip(parts, times):
        assert math.isclose(demand(t), p * demand(1.0), abs_tol=1e-9)


def test_query_against_sql(spark, docs_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{docs_dir}/documents.parquet'")
    df = queries.op4_mixing(spark, docs_dir)
    want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({mixing.ORACLE})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_taken_words_are_near_the_target_and_in_order(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    plan = mixing.schedule(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target, most = Counter(), {}, Counter()
    for r in plan:
        taken[r.source] += r.taken
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r["size"])
        assert r.taken <= 3 * r["size"] and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    copies = Counter(r.doc_id for r in mix.collect())
    assert copies == Counter({r.doc_id: r.copies for r in plan if r.copies})


def test_early_sources_come_early(spark):
    docs = spark.createDataFrame([(k, "w " * 10, f"s{k % 3}") for k in range(900)], "doc_id long, text string, source string")
    plan = mixing.schedule(docs, weights=(1, 1, 1)).join(docs.select("doc_id", "source"), "doc_id").collect()
    mean = defaultdict(list)
    for r in plan:
        mean[r.source] += r.positions
    means = {s: sum(p) / len(p) for s, p in mean.items()}
    assert means["s0"] < means["s1"] - 0.05 < means["s2"] - 0.1


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (None, "x " * 200_000, "b"), (4, "w", "")]
    docs = spark.createDataFrame([(*r, 7, 1.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    found = mixing.schedule(docs).collect()
    assert len(found) == 6 and all(r.taken <= 3 * r["size"] for r in found)
    assert sorted(r["size"] for r in found) == [0, 0, 1, 2, 2, 200_000]
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.schedule(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_as_many_sources_as_documents(spark):
    """Sources are numbered and levelled in ranges; the same as over all of them at once."""
    rows = [(k, "w " * (k % 17 + 1), None if k == 5 else f"s{(k * 7919) % 1000:04d}") for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = {r.doc_id: r for r in mixing.schedule(docs).collect()}
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(order)}
    total, level, capped = sum(sizes.values()), None, set()
    while True:
        rest = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in rest)
        over = {s for s in rest if 3 * sizes[s] < level * weight[s]}
        if not over:
            break
        capped |= over
    for k, _, source in rows:
        assert abs(got[k].target - min(3 * sizes[source], level * weight[source])) < 1e-6
        assert got[k].source_size == sizes[source]
