from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cafetal.llm import simhash
from cafetal.llm.simhash import Tries, components, fingerprint, join_tries, near_dedup
from tests.llm.helpers import docs

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UP, LOW)))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def corpus(n=250, seed=5):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Überall", "\x85odd\xa0word", "ÉTÉ"]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 5, 60, 400]))]
        rows.append((1000 - i, " ".join(words)))
        for k in range(r.choice([0, 0, 1, 4])):
            other = list(words)
            other[r.randrange(len(other))] = "CHANGED"
            rows.append((2000 + 10 * i + k, "\n".join(other).upper() if k % 2 else " ".join(other)))
    rows += [(9000 + i, rows[3][1]) for i in range(60)]
    return rows + [(7, None), (8, ""), (9, " \t\r\n"), (None, "w1 w2 w3 w4"), (None, None), (7, None),
                   (10, "long " * 50_000)]


def test_matches_brute_force(spark):
    rows = corpus()
    assert [fingerprint(t, 3) for _, t in rows] == [brute_fp(t) for _, t in rows]
    got = [tuple(r) for r in near_dedup(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert len({r[2] for r in got}) < len({r[1] for r in got})  # some links are between different fingerprints


def test_edges(spark):
    assert near_dedup(docs(spark, [(1, "x")]).filter("false")).count() == 0
    d = docs(spark, [(4, None), (3, "  "), (None, "")]).selectExpr("*", "1 as node", "2 as root", "3 as __fp")
    assert sorted(map(str, near_dedup(d).select("doc_id", "component_id").collect())) == sorted(
        ["Row(doc_id=4, component_id=3)", "Row(doc_id=3, component_id=3)", "Row(doc_id=None, component_id=3)"])
    only_null = near_dedup(docs(spark, [(None, "a b c d")])).collect()
    assert [(r.doc_id, r.component_id) for r in only_null] == [(None, None)]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1) | st.integers(0, 200), max_size=60),
       st.sets(st.integers(0, 200) | st.integers(2**64 - 99, 2**64 - 1), max_size=60), st.integers(0, 4))
def test_join_tries(x, y, bits):
    a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
    old, simhash._BRUTE = simhash._BRUTE, 2
    try:
        both = sorted((int(a[i]), int(b[j])) for p, q in join_tries(a, b, bits) for i, j in zip(p, q, strict=True))
        own = sorted((int(a[i]), int(a[j])) for p, q in join_tries(a, None, bits) for i, j in zip(p, q, strict=True))
    finally:
        simhash._BRUTE = old
    assert both == sorted((i, j) for i in x for j in y if (i ^ j).bit_count() <= bits)
    assert own == sorted((i, j) for i in x for j in x if i < j and (i ^ j).bit_count() <= bits)


def test_join_tries_large():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**64, 3000, dtype=np.uint64))
    a = np.unique(np.concatenate([a, a[:200] ^ np.uint64(1 << 63), a[:100] ^ np.uint64(5), a[:50] ^ np.uint64(7)]))
    want = sum(int((np.bitwise_count(a[i + 1:] ^ a[i]) <= 2).sum()) for i in range(len(a)))
    assert sum(len(i) for i, _ in join_tries(a, None, 2)) == want > 300


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_tries_meet_all_near_pairs(bits):
    r = np.random.default_rng(4)
    tries = Tries(bits)
    a = np.unique(np.append(r.integers(0, 2**64, 400, dtype=np.uint64), np.uint64(0)))
    near = a.copy()
    for _ in range(bits):
        near ^= np.uint64(1) << r.integers(0, 64, len(a), dtype=np.uint64)
    every = np.unique(np.concatenate([a, near]))
    want = {(int(every[i]), int(y)) for i in range(len(every)) for y in every[i + 1:][np.bitwise_count(every[i + 1:] ^ every[i]) <= bits]}
    for deep in (False, True):
        got = set()
        for t in ([tries.number(i) for i in range(tries.blocks)] if not deep else
                  [tries.number(i, j) for i in range(tries.blocks) for j in range(tries.blocks)]):
            x = np.sort(tries.turned(every, t))
            assert set(tries.restored(x, t).tolist()) == set(every.tolist())
            for i, j in join_tries(x, None, bits, tries.depth(t)):
                u, v = tries.restored(x[i], t), tries.restored(x[j], t)
                got |= {(min(p, q), max(p, q)) for p, q in zip(u.tolist(), v.tolist(), strict=True)}
        assert got == want


@pytest.mark.parametrize("bits", [0, 2, 3])
def test_nodes_on_spark_are_those_of_the_join(spark, bits):
    """A fingerprint is copied bits + 1 times, and a node is the top of the fingerprint as the join turns it."""
    r = np.random.default_rng(5)
    fps = np.unique(np.append(r.integers(0, 2**64, 200, dtype=np.uint64), np.array([0, 2**64 - 1, 1 << 63], np.uint64)))
    tries = Tries(bits)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    some = range(tries.blocks)
    keys = [(i, None) for i in some] + [(i, j) for i in some for j in some]
    got = df.select(F.inline(F.array(*(simhash._keyed(F.col("fp"), tries, i, j) for i, j in keys)))).collect()
    assert len(got) == len(fps) * len(keys)
    for row in got:
        turned = tries.turned(np.array([row.fp], np.int64).view(np.uint64), row.trie)
        assert row.node == (turned >> np.uint64(64 - tries.depth(row.trie))).view(np.int64)[0]


@pytest.mark.parametrize("most", [4, 1000])
def test_link_and_components_over_many_nodes(spark, most):
    r = np.random.default_rng(2)
    a = np.unique(r.integers(0, 2**64, 120, dtype=np.uint64) >> np.uint64(0))
    chain = [int(a[0])]
    for b in (0, 9, 63, 62, 31, 5, 44):
        chain.append(chain[-1] ^ (1 << b) ^ (1 << (b + 1) % 64))
    values = sorted({int(x) for x in a} | set(chain))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "__fp long")
    got = components(simhash.link(df, 2, most)).collect()
    assert {x.node % 2**64 for x in got} | {x.root % 2**64 for x in got} == set(chain) and len({x.root for x in got}) == 1
