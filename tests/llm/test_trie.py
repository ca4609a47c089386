"""The prefix trie against a version that holds all prefixes in a dict."""

import collections
import hashlib
import zlib

import pytest

from larkspur.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, k1 long"


def brute(rows, family, shared):
    turns = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(x)] for c, x in turns.items()}
    members, last = collections.defaultdict(list), collections.defaultdict(list)
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + x[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        last[tuple(path)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, kept = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            kept[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], kept[p],
                   hashlib.sha256(",".join(map(str, sorted(last[p]))).encode()).hexdigest()) for p, m in members.items())


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def talk(c, texts, first=0):
    return [(c, first + k, "user" if k % 2 == 0 else "assistant", t, "clash", 1) for k, t in enumerate(texts)]


ODD = [
    *talk(0, ["a", "b", "c", "d", "e", "f", "g"]), *talk(1, ["a", "b"]), *talk(2, ["a", "b"]), *talk(5, ["x"]),
    *talk(7, ["a"] * 30), *talk(8, ["a"] * 31), *talk(9, ["z" * 200_000, "é" * 3]), *talk(205, ["only"]), *talk(206, []),
    *talk(11, ["same", "same"]), *talk(11, ["same", "same"]), *talk(-3, ["a", "b"]), *talk(-103, ["n"]), *talk(-100, ["a", "q"]),
    (12, None, "user", "first", None, None), (12, 0, "user", "second", None, None), (12, None, None, None, None, None),
    (13, 1, "user", "tie b", None, None), (13, 1, "user", "tie a", None, None), (13, 1, "a", "tie c", None, None),
    (None, 0, "user", "nobody", None, None), (14, 0, "us", "er", None, None), (15, 0, "user", "", None, None),
    *[r for c in range(300, 340) for r in talk(c, ["hot"] * 9)],
]


@pytest.mark.parametrize("height", [2, 3, 8])
def test_trie_equals_brute_force(spark, height):
    out = trie.trie(spark.createDataFrame(ODD, SCHEMA), height=height)
    assert result(out) == brute(ODD, trie.FAMILY, trie.SHARED)


def test_trie_without_shared_beginnings_and_deep(spark):
    rows = talk(1, [f"t{k % 3}" for k in range(150)]) + talk(2, [f"t{k % 3}" for k in range(149)] + ["end"])
    out = trie.trie(spark.createDataFrame(rows, SCHEMA), shared=1, height=4)
    assert result(out) == brute(rows, trie.FAMILY, 1)


def test_trie_of_nothing(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_node_is_repeated_within_its_band_only(spark):
    """A single line of 200 turns: nothing is repeated more than HEIGHT times on any of three levels."""
    steps, top = trie.paths(spark.createDataFrame(talk(1, ["x"] * 200), SCHEMA), shared=1)
    nodes = steps.selectExpr("k1", "k2", "c", "i", "1L as n")
    sums = {r.i: r.n for r in trie.subtree_sums(steps, nodes, ["n"], top).collect()}
    assert sums == {i: 201 - i for i in range(201)}
