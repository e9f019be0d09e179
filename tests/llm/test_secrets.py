"""Secret scans against plain pattern search; derived trigram queries; odd rows."""

import hashlib
import re

import pytest

from packetloom.llm import queries, secrets


def plain(text):
    """Base and further spans by a plain search."""
    out = []
    for order, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), order, m.end()))
    return sorted(out)


def lines(spans):
    return ",".join(f"{secrets.RULES[o].kind}:{a}:{b}" for a, o, b in spans)


def test_queries_derived_from_patterns():
    found = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert found["hex"] == []
    assert found["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in found["assign"] and len(found["assign"]) == 6
    assert all("-----" not in t and len(t) == 3 for one in found["pem"] for t in one)
    assert secrets.trigram_query("ab?c") == [] and secrets.trigram_query("a.c") == []
    assert secrets.trigram_query("(abc)+d") == [frozenset({"abc"})]
    assert secrets.trigram_query("x(abc|d)y*") == []


@pytest.mark.parametrize("rule", secrets.RULES)
def test_matches_hold_a_query_set(rule):
    samples = [
        'Password" : \'abcdefgh1', "API_KEY=aaaaaaaaaa", "apikey = 12345678", "passwd:abcdefgh", "AKIA" + "Z" * 16,
        "ghp_" + "a" * 40, "xoxb-1234567890ab", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----",
    ]
    query = secrets.trigram_query(rule.pattern)
    for s in samples:
        if query and re.search(rule.pattern, s):
            low = s.lower()
            assert any(all(t in low for t in one) for one in query)


def test_odd_texts(spark):
    texts = [
        None, "", "日本 token: 'abcd12345' 😀 secret=short", "token=token:longvalue123", "AKIAAKIAAKIAAKIA AKIA0",
        "deadbeef" * 4, "deadbeef" * 4 + "0g" + "a1" * 20, "secret = \"" + "ab" * 30 + '"', "x" * 200_000 + " password=hunter2222 ",
        "ghp_" + "b" * 40 + " xoxp-1234567890 -----BEGIN PRIVATE KEY-----", "pass wor ord ssw asswo", "token=abcdefgh " * 300,
    ]
    rows = [(None if k % 5 == 4 else k % 7, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[2:4], "doc_id long, text string, found string")
    got = sorted((str(r.doc_id), r.spans, r.n_assign, r.base_sha256) for r in secrets.digests(secrets.secret_spans(docs)).collect())

    def expected(row):
        spans = plain(row[1])
        base = [s for s in spans if secrets.RULES[s[1]].base]
        return str(row[0]), lines(spans), sum(s[1] == 0 for s in spans), hashlib.sha256(lines(base).encode()).hexdigest()

    assert got == sorted(map(expected, rows + rows[2:4]))
    assert secrets.digests(secrets.secret_spans(docs.limit(0))).count() == 0


def test_query_against_a_plain_search(spark, docs_dir):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{docs_dir}/documents.parquet").collect()}
    rows = queries.op3_secret_scan(spark, docs_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = plain(docs[r.doc_id])
        assert r.spans == lines(spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_no_python_in_the_plan(spark, docs_dir):
    plan = queries.op3_secret_scan(spark, docs_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_matches_in_one_text(spark):
    """Time grows with the matches and not with their square; spans over many blocks are right."""
    n = 40_000
    text = " ".join(f"token=abcdefgh{k}" for k in range(n))
    docs = spark.createDataFrame([(1, text), (2, "token=abcdefgh")], "doc_id long, text string")
    found = {r.doc_id: r.found for r in secrets.secret_spans(docs).collect()}
    assert [tuple(s) for s in found[1]] == plain(text) and len(found[1]) == n
    assert [tuple(s) for s in found[2]] == [(0, 0, 14)]
