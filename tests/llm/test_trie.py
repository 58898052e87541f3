"""Prefix tries against nested dictionaries."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from reachgrid.llm import trie

TURNS = "conv_id long, turn long, role string, text string, ids string, shard int, parent string"


def brute_trie(convs: dict) -> list[tuple]:
    """Rows of the trie of ``{conv_id: [(role, text), ...]}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in convs.items():
        ends[tuple(turns)].append(conv)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        inner = {p[:-1] for p in members if p}
        out.append((
            min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own),
            sum(len(p) == len(prefix) + 1 for p in below),
            sum(p not in inner for p in below),
            sum((len(members[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below),
            hashlib.sha256(",".join(map(str, sorted(ends[prefix]))).encode()).hexdigest(),
        ))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def frame(spark, convs: dict):
    rows = [
        (c, i, role, text, "x", 1, None)
        for c, turns in convs.items()
        for i, (role, text) in enumerate(turns)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, TURNS).repartition(3)


def some_convs(seed: int, n: int, longest: int) -> dict:
    rng = random.Random(seed)
    heads = [[("user", "hot"), ("assistant", "Größe 😀")], [("user", "hot")], [("system", "s")]]
    found = {}
    for c in range(n):
        turns = list(rng.choice(heads))
        for _ in range(rng.randint(0, longest)):
            turns.append((rng.choice(["user", "a"]), rng.choice(["", "x", "yy", "漢字"])))
        found[c * 7 - 50] = turns if c % 3 else heads[0]
    return found


@pytest.mark.parametrize("shard,block,columns", [(10_000, 128, 32), (60, 128, 2), (40, 3, 3)])
def test_trie_equals_nested_prefixes(spark, monkeypatch, shard, block, columns):
    monkeypatch.setattr(trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "COLUMNS", columns)
    convs = some_convs(shard, 90, 7)
    convs[5_000] = [("user", "hot")] + [("u", "x")] * 70
    convs[5_001] = [("user", "hot")] + [("u", "x")] * 64
    got = trie.prefix_trie(frame(spark, convs)).collect()
    assert ordered(got) == ordered(brute_trie(convs))


def test_numpy_nodes_of_one_shard():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 6, 300)
    ids = rng.integers(0, 2, sizes.sum())
    conv = rng.permutation(300)
    nodes, last, _ = trie._sorted_nodes(conv, sizes, ids, np.ones(len(ids), np.int64))
    starts = np.cumsum(sizes) - sizes
    prefixes = {tuple(ids[s : s + d]) for s, n in zip(starts, sizes) for d in range(n + 1)}
    assert len(nodes["n"]) == len(prefixes)
    assert (nodes["depth"][last] == sizes).all()
    order = sorted(range(300), key=lambda i: (tuple(ids[starts[i] : starts[i] + sizes[i]]), conv[i]))
    assert trie.sorted_ends(conv, sizes, ids) == (order[0], order[-1])


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, 1, "user", "b", None, None, None), (1, None, None, "first", None, None, None),
        (1, 1, "user", "b", None, None, None), (1, 2, "assistant", None, None, None, None),
        (2, 0, "", "first", None, None, None), (2, 3, "user", "b", None, None, None),
        (None, 0, "user", "gone", None, None, None),
    ]
    got = trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()
    expected = {
        1: [("", "first"), ("user", "b"), ("user", "b"), ("assistant", "")],
        2: [("", "first"), ("user", "b")],
    }
    assert ordered(got) == ordered(brute_trie(expected))


def test_no_conversations_and_no_turns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(empty).count() == 0
    bare = spark.createDataFrame(
        [(4, None), (9, [])], "conv_id long, turns array<struct<id:binary,chars:int>>"
    )
    assert ordered(trie.trie(bare).collect()) == ordered(brute_trie({4: [], 9: []}))


def test_shared_start(spark):
    convs = some_convs(8, 60, 6)
    convs = {c: t for c, t in convs.items() if c >= 0}
    turns = trie.turns_of(frame(spark, convs), "conv_id", "turn", "role", "text")
    from pyspark.sql import functions as F

    start = F.col("conv_id") - F.col("conv_id") % 100
    got = trie.trie(trie.with_shared_start(turns, start, F.lit(2))).collect()
    rebuilt = {c: convs.get(c - c % 100, [])[:2] + t[2:] for c, t in convs.items()}
    assert ordered(got) == ordered(brute_trie(rebuilt))
