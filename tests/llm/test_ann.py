from __future__ import annotations

import math

import numpy as np
import pytest

from cafetal.llm import ann, registry
from cafetal.llm.ann import fit, neighbour_graph, partition_graph, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, ids=None):
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], 0)
            for i, v in zip(range(len(vectors)) if ids is None else ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute(rows, k=20):
    """Exact answers from (id, vector) rows."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()
            and any(v)]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            out[q] = sorted([(-float(x @ v), i) for i, v in good if i != q])[:k]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hit = sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def clustered(n, seed=1, centres=40, d=24):
    r = np.random.default_rng(seed)
    c = r.standard_normal((centres, d)) * 2
    return (c[r.integers(0, centres, n)] + r.standard_normal((n, d)) * 0.5).astype(np.float32)


@pytest.mark.parametrize("kind", ["clustered", "sphere"])
def test_recall(spark, kind):
    v = clustered(4000)
    if kind == "sphere":
        v = np.random.default_rng(3).standard_normal((4000, 32)).astype(np.float32)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    got = answers(search(frame(spark, v), sample=1500, per_part=200))
    want = brute(list(enumerate(v.tolist())))
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    for q, g in got.items():
        assert g == sorted(g) and all(math.isclose(-s, float(v[q].astype(float) @ v[i].astype(float)), rel_tol=1e-12)
                                      for s, i in g)


def test_few_vectors_hot_vector_and_bad_ones(spark):
    v = clustered(60).tolist()
    d = len(v[0])
    rows = list(enumerate(v)) + [(1000 + i, v[7]) for i in range(300)] + [(20 * i + 5000, v[0]) for i in range(30)]
    bad = [(20_000, None), (20_020, []), (20_040, [0.0] * d), (20_060, [math.nan] * d), (20_080, [math.inf] + [0.0] * (d - 1)),
           (20_100, [None] * d), (20_120, [1.0] * (d + 1))]
    every = rows + bad + rows[:5]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in every] + [(None, v[0], "a", 1)],
                               "vec_id long, embedding array<double>, q string, part int")
    got = answers(search(df, per_part=16, queries_per_chunk=10))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]], q


def test_small_tables(spark):
    assert search(frame(spark, [])).count() == 0
    assert search(frame(spark, [None, [0.0, 0.0]])).count() == 0
    assert search(frame(spark, [[1.0, 2.0]])).count() == 0  # nobody but itself
    got = answers(search(frame(spark, [[1.0, 2.0], [3.0, 1.0], [3.0, 1.0]])))
    assert got == {0: [(-5.0, 1), (-5.0, 2)]}


def test_given_queries(spark):
    v = clustered(300)
    got = answers(search(frame(spark, v), frame(spark, v[:3], [0, 999, 2]), k=3))
    assert set(got) == {0, 999, 2} and got[999][0][1] == 1 and 0 not in {i for _, i in got[0]}


def test_partitions_are_balanced_and_cut_few_edges():
    v = clustered(2000).astype(float)
    near = neighbour_graph(v, 10)
    label = partition_graph(near, v, 16, 20, 0.05, 1)
    size = np.bincount(label, minlength=16)
    assert size.max() <= math.ceil(2000 / 16 * 1.05) + 1 and size.min() >= 1
    same = (label[near] == label[:, None]).mean()
    assert same > 0.5 > 3 / 16
    assert 0 < fit(v, 2000, 125, 512, 10, 0.95).mass <= 1


def test_neighbour_graph():
    x = np.random.default_rng(0).standard_normal((50, 5))
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    assert [set(r) for r in neighbour_graph(x, 4)] == [set(r) for r in np.argsort(-s, axis=1)[:, :4]]


def test_query(spark):
    from tests.conftest import SF_MID

    got = answers(registry.op1_learned_partitions(spark, SF_MID))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    assert recall(got, brute(rows)) >= 0.9 and ann._BLOCK


def test_production_parameters_prune_clustered_vectors(spark):
    """Default parameters: several partitions from a few hundred rows on, and few of them read where vectors have structure."""
    v = clustered(6000, centres=120, d=32)
    x = v.astype(float)
    x /= np.sqrt((x * x).sum(axis=1)).max()
    router = fit(x[:4096], len(x), 2048, 512, 20, 0.97)
    part = router.probabilities(x).argmax(axis=1)
    size = np.bincount(part, minlength=router.w2.shape[1])
    row, to = router.route(x[::20])
    read = np.zeros(len(x[::20]))
    np.add.at(read, row, size[to])
    assert (read / len(x)).mean() < 1 / 3 and len(size) >= 32
    assert fit(x[:300], 300, 2048, 512, 20, 0.97).w2.shape[1] > 1
    got, want = answers(search(frame(spark, v))), brute(list(enumerate(v.tolist())))
    assert recall(got, want) >= 0.9
