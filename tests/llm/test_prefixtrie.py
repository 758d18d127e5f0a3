from __future__ import annotations

import random

import numpy as np
import pytest
from brute import trie

from orderloom.llm import prefixtrie as T
from orderloom.llm.parentheses import Parentheses
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(QUERIES["op13_prefix_trie"](spark, SF)) == trie([tuple(r) for r in rows])


def odd_turns():
    rng = random.Random(3)
    turns = []
    for c in [*range(-6, 20), None]:
        for t in range(rng.choice([1, 2, 5, 9, 14])):
            turns.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", None, ""])))
    for c in range(30, 60):
        turns += [(c, t, "u", "same") for t in range(rng.choice([4, 12]))]
    turns += turns[:5]
    rng.shuffle(turns)
    return turns


@pytest.mark.parametrize(("shard_rows", "segment"), [(5, 3), (10**6, 2), (7, 65_536)])
@pytest.mark.parametrize("rebuild", [True, False])
def test_odd_turns_in_small_shards_and_segments(spark, shard_rows, segment, rebuild):
    turns = odd_turns()
    table = spark.createDataFrame([(*t, 0, "clash") for t in turns], f"{SCHEMA}, depth int, conv string").repartition(5)
    rows = T.rebuilt(table) if rebuild else T.prefixes(table)
    assert got(T.statistics(rows, shard_rows, segment)) == trie(turns, rebuild)


def test_hot_conversation_and_hot_first_turn(spark):
    long = [(5, t, "u", f"turn {t % 7}") for t in range(90)]
    equal = [(7, 1, "u", "again")] * 70
    short = [(c, t, "u", "hello" if t == 0 else f"{c % 40} {t}") for c in range(100, 900) for t in range(3)]
    turns = long + equal + short
    table = spark.createDataFrame(turns, SCHEMA).repartition(7)
    assert got(T.statistics(T.prefixes(table), segment=32)) == trie(turns, False)


def test_no_rows(spark):
    assert got(T.statistics(T.rebuilt(spark.createDataFrame([], SCHEMA)))) == []


def test_id_lists_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "IDS", 3)
    turns = [(c, 0, "u", "all the same") for c in range(40)]
    table = spark.createDataFrame(turns, SCHEMA).repartition(3)
    assert got(T.statistics(T.prefixes(table))) == trie(turns, False)


def random_tree(n, climb, rng):
    bits, depth = [], 0
    for _ in range(n):
        while depth and rng.random() > climb:
            bits.append(0)
            depth -= 1
        bits.append(1)
        depth += 1
    return bits + [0] * depth


@pytest.mark.parametrize("climb", [0.5, 0.6, 0.9, 1.0])
@pytest.mark.parametrize("n", [0, 1, 2, 100, 6000])
def test_parentheses(n, climb):
    bits = random_tree(n, climb, random.Random(n))
    tree, opened, close = Parentheses(np.array(bits, bool)), [], {}
    for i, b in enumerate(bits):
        if b:
            opened.append(i)
        else:
            close[opened.pop()] = i
    nodes = tree.nodes()
    found = tree.findclose(nodes)
    assert found.tolist() == [close[i] for i in nodes.tolist()]
    pairs = "".join(map(str, bits))
    some = np.arange(0, n, max(1, n // 50))
    assert tree.leaf_pairs(nodes[some], found[some]).tolist() == [
        pairs.count("10", a, b + 1) for a, b in zip(nodes[some].tolist(), found[some].tolist())
    ]
    assert tree.preorder(nodes).tolist() == list(range(n))
    walk = np.cumsum(2 * np.array(bits, int) - 1) if n else np.zeros(1)
    if n:
        assert tree.low[1] <= walk.min() and tree.high[1] == walk.max()
