"""Source divergence against a plain count, and its SQL."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from ratelens.llm import divergence
from ratelens.llm.divergence import source_divergence
from tests.compare import difference, duck

SMALL = "/root/testdata/sf0.001"


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in rows]
    holds = defaultdict(Counter)
    for lang, _, terms in docs:
        holds[lang].update(set(terms))
    out = set()
    for lang in {lang for lang, _, _ in docs}:
        kept = {term for term, n in holds[lang].items() if n >= min_docs}
        counts = {source: Counter() for own, source, _ in docs if own == lang}
        for own, source, terms in docs:
            if own == lang:
                counts[source].update(term for term in terms if term in kept)

        def p(count):
            under = sum(count.values()) + 5 * len(kept)
            return {term: 1 + 10**9 * (count[term] + 5) // under for term in kept}

        q = p(sum(counts.values(), Counter()))
        own = {source: p(count) for source, count in counts.items()}
        for source in counts:
            pairs = [(sum(abs(own[source][t] - own[o][t]) for t in kept), o) for o in counts if o != source]
            terms = [(own[source][t] - q[t], t) for t in kept if counts[source][t] and own[source][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.add((lang, source, part, item, value, rank))
    return out


ODD = [
    ("A-b a,B\tword WORD word's", "x", "s0"),
    ("A-b  a;B word word é É", "x", "s1"),
    ("", "x", "s2"),
    (None, None, None),
    ("word", None, "s0"),
    ("a b a,b" + " w" * 5000 + ",x" * 3000, "x", "s1"),
    ("A-b a,B\tword WORD word's", "x", "s0"),
    ("12 34", "alone", "only"),
]


@pytest.mark.parametrize("min_docs", [1, 2, 99])
def test_equals_brute_force(spark, min_docs, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_DOCS", 2)  # terms and documents are counted across blocks
    monkeypatch.setattr(divergence, "TASKS", 2)
    rows = ODD * 3 + [(f"w{n % 7} w{n % 3} common", "y", f"s{n % 5}") for n in range(40)]
    docs = spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], "text string, lang string, source string, number long")
    got = {tuple(row) for row in source_divergence(docs, min_docs, 3).collect()}
    assert got == brute(rows, min_docs, 3)


def test_more_sources_than_a_block_of_them(spark, monkeypatch):
    monkeypatch.setattr(divergence, "GROUPS", 4)
    monkeypatch.setattr(divergence, "CELLS", 20)
    rows = [(f"w{n % 5} w{n % 11} " * (n % 4), "y", f"s{n % 13}") for n in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(row) for row in source_divergence(docs, 5, 2).collect()} == brute(rows, 5, 2)


def test_empty_and_clashing(spark):
    assert source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    docs = spark.createDataFrame([("a b", "x", "s", "1", "2"), ("a", "x", "t", "1", "2")], "text string, lang string, source string, term string, block string")
    assert source_divergence(docs, 1).filter("part = 'pair'").count() == 2


def test_equals_sql(spark):
    sql = entry.oracle_sql()["op11_source_divergence"]
    assert difference(entry.queries()["op11_source_divergence"](spark, SMALL), duck(SMALL), sql) is None
