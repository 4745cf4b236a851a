"""Conversation trie against a plain one, and list ranking in rounds."""

import hashlib
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from ratelens.llm import prefix_trie as module
from ratelens.llm.prefix_trie import list_ranks, prefix_trie
from tests.compare import difference, duck

SMALL = "/root/testdata/sf0.001"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = (*own.get(conv - conv % 5, [])[:h], *turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
            if depth:
                children[turns[: depth - 1]].add(turns[:depth])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[child] for child in children[node]) or 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[child] for child in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if len(rebuilt[conv]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(df):
    return sorted((tuple(row) for row in prefix_trie(df).select(NAMES).collect()), key=repr)


@pytest.mark.parametrize("chunk", [65_536, 4])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk)
    monkeypatch.setattr(module, "LAST_ARCS", 40)
    monkeypatch.setattr(module, "IDS_AT_ONCE", 7)
    rows = [(conv, turn, "user", f"é{turn}") for conv in range(60) for turn in range(conv % 4)]  # shared beginnings
    rows += [(100, turn, "user", f"long {turn}") for turn in range(300)]  # deep
    rows += [(101, None, None, None), (101, None, "user", ""), (101, 3, "user", "x"), (101, 3, "user", "x")]
    rows += [(None, 1, "user", "x"), (204, 0, "user", "first"), (999, 0, "a", "b"), (998, 0, "ab", "")]
    rows += [(conv, 0, "user", "same") for conv in range(1000, 1300, 5)]  # many end at one node
    df = spark.createDataFrame([(*row, "x") for row in rows], "conv_id long, turn long, role string, text string, depth string")
    assert trie(df) == brute(rows)


def test_turnless_conversations(spark):
    """A conversation whose turns are all replaced by none is a member of the root only."""
    conv = next(n for n in range(1, 100) if n % 5 and zlib.crc32(str(n).encode()) % 9 > 1)
    rows = [(conv, 0, "user", "x")]
    assert trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")) == brute(rows)


def test_empty(spark):
    assert trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == []


@pytest.mark.parametrize("last", [1, 10, 10_000])
def test_list_ranks(spark, monkeypatch, last):
    monkeypatch.setattr(module, "LAST_ARCS", last)
    arcs = [(n * 7919 % 301, n % 2) for n in range(301)]
    links = [(arc, following) for arc, following in zip(arcs, [*arcs[1:], None], strict=True)]
    kind = "struct<conv:long,code:long>"
    ranks = list_ranks(spark.createDataFrame(links, f"arc {kind}, next {kind}")).collect()
    assert {tuple(row["arc"]): row["rank"] for row in ranks} == {arc: n for n, arc in enumerate(arcs)}


def test_equals_sql(spark):
    sql = entry.oracle_sql()["op13_prefix_trie"]
    assert difference(entry.queries()["op13_prefix_trie"](spark, SMALL), duck(SMALL), sql) is None
