from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cafetal.llm import sharding
from tests.llm.helpers import docs


def check(spark, rows, shards=16, tolerance=0.001, **kw):
    d = docs(spark, rows)
    got = sharding.digest(sharding.shard(d, shards, tolerance=tolerance, **kw)).collect()
    assert len(got) == len(rows)
    sizes = [len((t or "").encode()) + 1 for _, t in rows]
    text = defaultdict(list)
    for i, t in rows:
        text[i].append(t or "")
    by = defaultdict(list)
    for r in got:
        assert (r.size, r.text_crc32) in [(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in text[r.doc_id]]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    if rows:
        alike = Counter()  # rows equal in id and text stay together
        for (i, t), n in zip(rows, sizes, strict=True):
            alike[i, t or ""] += n
        share, biggest = sum(sizes) / shards, max(alike.values())
        for s in range(shards):
            assert abs(sum(r.size for r in by[s]) - share) <= 2 * (tolerance * share + biggest)
    # hash order: each shard holds one range of (hash, id), as a plain sort gives it
    order = d.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "doc_id").collect()
    at = {(r.doc_id, r.text_crc32): r.shard for r in got}
    crc = {r.doc_id: r.text_crc32 for r in got}
    keys = sorted((r.h, -1 if r.doc_id is None else r.doc_id) for r in order)
    if len(text) == len(rows):
        seq = [at[(None if i == -1 else i, crc[None if i == -1 else i])] for _, i in keys]
        assert seq == sorted(seq)
    return got


def test_near_equal_bytes_with_hot_text(spark):
    rows = [(i, "the hot text " * 9 if i % 3 == 0 else f"text {i} " * (1 + i % 50)) for i in range(2000)]
    check(spark, rows)


def test_edges(spark):
    check(spark, [])
    check(spark, [(1, None)])
    check(spark, [(1, ""), (2, None), (None, "null id"), (7, "x" * 100_000)])
    check(spark, [(3, "same")] * 40 + [(None, None)] * 3)


def test_several_ranges_a_shard(spark):
    check(spark, [(i, f"t{i}" * (i % 7)) for i in range(3000)], shards=4, rows_per_range=100)


def test_clashing_columns(spark):
    d = docs(spark, [(i, f"row {i}") for i in range(50)]).selectExpr("*", "'a' as size", "7 as slot", "1 as h", "5 as __h", "'b' as __o")
    out = sharding.shard(d, 4)
    assert set(out.columns) == {*d.columns, "text_crc32", "law", "shard", "grown_shard"}
    assert out.agg(F.sum("h"), F.sum("__h")).first()[:] == (50, 250)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 5)), max_size=40),
       st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 5)), min_size=1, max_size=10))
def test_place(rows, probes):
    import numpy as np

    probes.sort()
    got = sharding.place(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), probes)
    assert got.tolist() == [sum(p <= r for p in probes) for r in rows]
