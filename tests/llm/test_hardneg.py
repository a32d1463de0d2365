from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from cafetal.llm import hardneg as hn
from tests.conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    order = lambda c: (-c[0], c[1] is None, c[1])
    for a, q, label in kept:
        if a is None or a % 100:
            continue
        all_scored = [(sum(x * y for x, y in zip(q, p, strict=True)), i, lb) for i, p, lb in kept if len(p) == len(q) and i != a]
        for ps, pid, _ in sorted((c for c in all_scored if c[2] == label), key=order)[:5]:
            inside = [c for c in all_scored if c[2] != label and 80 * ps <= 100 * c[0] <= 100 * ps]
            out += [(a, pid, k + 1, nid, ps, ns) for k, (ns, nid, _) in enumerate(sorted(inside, key=order)[:5])]
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as q", "2 as rid", "'x' as cell").repartition(4)
    return sorted((tuple(r) for r in hn.hard_negatives(df).select(*COLUMNS).collect()), key=str)


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(hn, "CELL_ROWS", 60)
    monkeypatch.setattr(hn, "PIECE_ROWS", 25)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "SAMPLE", 150)


def clustered(n, rng, dim=12, clusters=6):
    centres = rng.standard_normal((clusters, dim))
    return [(i, (centres[i % clusters] + 0.2 * rng.standard_normal(dim)).astype("float32").tolist(), int(rng.integers(0, 4)))
            for i in range(n)]


def test_clusters_in_many_cells_and_pieces(spark, small_pieces):
    rng = np.random.default_rng(3)
    rows = clustered(900, rng)
    # copies of one vector, a third of all rows, and vectors of opposite direction
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(450)]
    rows += [(2000 + i, [-x for x in rows[i][1]], 1) for i in range(40)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 50


def test_odd_rows(spark, small_pieces):
    rng = np.random.default_rng(4)
    rows = clustered(400, rng, dim=5)
    rows += [(100, rows[7][1], 1), (100, rows[7][1], 1), (200, [0.0] * 5, 2), (300, [1.0, 2.0], 1), (301, [1.0, 1.5], 1),
             (302, [0.9, 2.1], 2), (400, [], 1), (401, [], 1), (402, [], 3), (500, None, 1), (600, [1.0, None, 1.0, 1.0, 1.0], 1),
             (700, [float("nan")] * 5, 1), (800, [float("inf")] * 5, 1), (900, rows[3][1], None), (None, rows[0][1], 1),
             (None, rows[0][1], 2), (1000, [3e9] * 5, 1), (1001, [3e9] * 5, 1), (1002, [2.9e9] * 5, 2), (1003, [3e9] * 5, 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(100, [1.0], 1)]) == [] and run(spark, []) == []


def test_given_table_against_sql(spark):
    """The production parameters, against brute force in SQL."""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_MID}/embeddings.parquet'")
    want = sorted(tuple(r) for r in con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({hn.ORACLE})").fetchall())
    got = hn.hard_negatives(spark.read.parquet(f"{SF_MID}/embeddings.parquet")).select(*COLUMNS).collect()
    assert sorted(tuple(r) for r in got) == want and want


def test_bounds_hold_every_score():
    rng = np.random.default_rng(0)
    q = rng.integers(-40, 40, (300, 6))
    q[::50] = 0
    q[1::50] = q[1] * 3
    norm, unit = hn.units(q)
    t = hn.angles(unit, unit[[1, 2, 7, 9]])
    s = hn.scores(q, q)
    for i in range(len(q)):
        low, high = hn.bounds(np.abs(t - t[i]).max(axis=1), np.minimum(np.pi, (t + t[i]).min(axis=1)), norm[i] * norm, norm[i] * norm)
        assert ((low <= s[i]) & (s[i] <= high)).all()


def test_angles_leave_few_rows_of_clusters_to_be_scored(spark, monkeypatch):
    """Of tight clusters an anchor scores its own one, not all rows."""
    seen = []
    real = hn.scores
    rng = np.random.default_rng(1)
    rows = clustered(4000, rng, dim=16, clusters=40)
    monkeypatch.setattr(hn, "CELL_ROWS", 100)
    df = hn.quantised(spark.createDataFrame(rows, SCHEMA)).selectExpr("*", "vec_id as id", "false as noid")
    model = hn.fit(df)
    q = np.array([r.q for r in df.orderBy("vec_id").collect()], np.int64)
    norm, unit = hn.units(q)
    near, t = model.near(), hn.angles(unit, model.refs)
    for i in range(0, 4000, 100):
        s = real(q[i:i + 1], q)[0]
        low = np.partition(s, -60)[-60]
        top = hn.bounds(np.abs(t - t[i]).max(axis=1), np.full(len(q), np.pi), norm[i] * norm, norm[i] * norm)[1]
        seen.append((top >= low).mean())
    assert len(near) == hn.REFERENCES and np.mean(seen) < 0.2
