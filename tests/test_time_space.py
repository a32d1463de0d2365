"""Nearest cells, runs of days, joins over time, rolling sums and incremental gold on small cases."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cafetal.operators import intervals, rolling, spatial, spells
from cafetal.operators.asof import asof_join
from cafetal.operators.silver import to_silver
from cafetal.plans import catalog, incremental
from cafetal.plans.explain import plan_text
from cafetal.sources import io
from tests.conftest import SF_SMALL, rows

DAY0 = dt.date(1999, 12, 20)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def silver_like(spark, points):
    """{(lat, lon): {day number: rain}} as rows."""
    data = [(la, lo, day(d), r) for (la, lo), days in points.items() for d, r in days.items()]
    return spark.createDataFrame(data, "lat double, lon double, fecha date, rain_mm double")


def test_nearest_cell_brute(spark):
    rng = random.Random(1)
    fine = [(round(rng.uniform(-1, 1), 6), round(rng.uniform(-1, 1), 6)) for _ in range(200)] + [(0.0, 0.0), (None, 1.0), (0.0, 0.0)]
    coarse = [(round(rng.uniform(-1, 1), 2), round(rng.uniform(-1, 1), 2), float(i)) for i in range(60)] + [
        (0.1, 0.0, 7.0), (-0.1, 0.0, 8.0), (0.0, 0.1, 9.0), (None, 0.0, 1.0)]
    f = spark.createDataFrame(fine, "lat double, lon double")
    c = spark.createDataFrame(coarse, "lat double, lon double, v double")
    got = spatial.nearest_cell(f, c, 0.1)
    micro = lambda x: round(x * 1e6)
    want = []
    for la, lo in fine:
        best = None
        for cla, clo, v in coarse:
            if None in (la, cla):
                continue
            d2 = (micro(la) - micro(cla)) ** 2 + (micro(lo) - micro(clo)) ** 2
            if d2 <= 100_000 ** 2:
                best = min(best or (d2, cla, clo, v), (d2, cla, clo, v))
        want.append((la, lo, *(best[1:] if best else (None,) * 3), round(best[0] ** 0.5 / 1e6, 6) if best else None))
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert (0.0, 0.0, -0.1, 0.0, 8.0, 0.1) in want                       # a tie and the limit itself
    assert spatial.nearest_cell(f.filter("false"), c).count() == 0


def test_nearest_cell_has_no_nested_loop(spark):
    plan = plan_text(catalog.q_nearest_cell(spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def brute_runs(days):
    out, days = [], sorted(set(days))
    for d in days:
        if out and out[-1][1] == d - 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(day(a), day(z), z - a + 1) for a, z in out]


def test_spells_over_block_ends(spark):
    rng = random.Random(3)
    points = {(float(i), 1.0): {d: rng.choice([0.0, 0.5, 5.0, None]) for d in range(-300, 300) if rng.random() < 0.9} for i in range(6)}
    points[9.0, 9.0] = {d: 0.0 for d in range(-200, 200)}                   # one run over many blocks
    points[8.0, 8.0] = {0: 0.0, 1: 9.0, 2: 0.0}
    df = silver_like(spark, points)
    df = df.unionByName(df.filter("lat = 9")).unionByName(df.limit(1).withColumn("fecha", F.lit(None).cast("date")))
    want = [(la, lo, *r) for (la, lo), days in points.items() for r in brute_runs([d for d, x in days.items() if x is not None and x < 1])]
    assert rows(spells.dry_spells(df, 1.0)) == rows(spark.createDataFrame(want, "a double, b double, i date, f date, d long"))
    assert rows(spells.dry_spells(df, 1.0, 3)) == rows(spark.createDataFrame([w for w in want if w[4] >= 3], "a double, b double, i date, f date, d long"))


def test_coverage_gaps_edges(spark):
    points = {(1.0, 1.0): {d: 1.0 for d in range(10)}, (2.0, 2.0): {3: 1.0, 5: 1.0, 6: 1.0}, (3.0, 3.0): {-50: 1.0, 80: 1.0},
              (4.0, 4.0): {-5: 1.0, 0: 1.0, 9: 1.0, 12: 1.0}}
    got = rows(spells.coverage_gaps(silver_like(spark, points), str(day(0)), str(day(9))))
    want = [(2.0, 2.0, day(0), day(2), 3), (2.0, 2.0, day(4), day(4), 1), (2.0, 2.0, day(7), day(9), 3),
            (3.0, 3.0, day(0), day(9), 10), (4.0, 4.0, day(1), day(8), 8)]
    assert got == sorted(want, key=str)


def test_a_hot_point_sends_masks_not_days(spark):
    """Days are aggregated before the shuffle: one row per task and block, however many rows a point has."""
    df = silver_like(spark, {(1.0, 1.0): {d: 0.0 for d in range(64)}})
    df = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).repartition(4)
    plan = plan_text(spells.dry_spells(df, 1.0))
    assert "partial_bit_or" in plan
    assert rows(spells.dry_spells(df, 1.0)) == [(1.0, 1.0, day(0), day(63), 64)]


def test_asof_join_brute(spark):
    rng = random.Random(4)
    left = [(i, rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(50)])) for i in range(800)]
    right = [(k, t, float(k * 100 + t)) for k in (1, 2) for t in rng.sample(range(60), 12)] + [(1, 5, 0.5), (1, 5, 999.0), (None, 1, 1.0), (2, None, 2.0)]
    l = spark.createDataFrame(left, "id int, k int, t int")
    r = spark.createDataFrame(right, "k int, u int, v double")
    want = []
    for i, k, t in left:
        seen = [(u, v) for kk, u, v in right if None not in (k, t, u) and kk == k and u <= t]
        want.append((i, k, t, *(max(seen) if seen else (None, None))))
    got = asof_join(l.repartition(7), r, ["k"], "t", "u", ["v"])
    assert got.columns == ["id", "k", "t", "u", "v"]
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert asof_join(l, r.filter("false"), ["k"], "t", "u", ["v"]).filter("u IS NOT NULL").count() == 0
    assert asof_join(l.filter("false"), r, ["k"], "t", "u", ["v"]).count() == 0


def test_asof_windows_run_inside_ranges(spark):
    """No window over a whole key: they are partitioned by the range of the sort, or hold a row per range."""
    l = spark.createDataFrame([(1, 1, 1)], "id int, k int, t int")
    plan = plan_text(asof_join(l, l.selectExpr("k", "t as u", "id as v"), ["k"], "t", "u", ["v"]))
    assert "hashpartitioning(_pid" in plan.replace(" ", "").replace("#", "") or "_pid" in plan


@pytest.mark.parametrize("hot", [3, 1000])
def test_overlap_join_brute(spark, hot):
    rng = random.Random(5)

    def spans(n):
        out = []
        for i in range(n):
            a = rng.randrange(120)
            out.append((i, rng.choice([1, 1, 1, 2, None]), day(a), day(a + rng.choice([0, 1, 3, 40, 90, -1]))))
        return out

    one, two = spans(150), spans(120)
    one[3], two[4] = (3, 1, None, day(3)), (4, 1, day(3), None)
    schema = "id int, k int, a date, z date"
    got = intervals.overlap_join(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), ["k"], ("a", "z"), ("a", "z"),
                                 hot=hot).select("l.id", F.col("r.id").alias("o"))
    ok = lambda s: None not in s and s[2] <= s[3]
    want = sorted((p[0], q[0]) for p in one for q in two if ok(p) and ok(q) and p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3])
    assert sorted((r.id, r.o) for r in got.collect()) == want
    plan = plan_text(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rolling_rain_over_blocks(spark):
    rng = random.Random(6)
    days = {d: round(rng.uniform(0, 9), 4) for d in range(-100, 200) if rng.random() < 0.6}
    got = {r.fecha: r for r in rolling.rolling_rain(silver_like(spark, {(1.0, 1.0): days}), (7, 30), 32).collect()}
    assert len(got) == len(days)
    for d in days:
        for w in (7, 30):
            inside = [x for e, x in days.items() if d - w < e <= d]
            assert got[day(d)][f"lluvia_{w}d"] == round(sum(round(x * 1e4) for x in inside)) / 1e4
            assert got[day(d)][f"dias_{w}d"] == len(inside)
    with pytest.raises(ValueError):
        rolling.rolling_rain(silver_like(spark, {(1.0, 1.0): days}), (7, 90), 32)


def test_incremental_gold(spark, scratch):
    silver = to_silver(catalog.bronze_layer(spark, SF_SMALL)).cache()
    root = scratch("incremental-test")
    path = io.write_partitioned(silver, f"{root}/silver", ["anio", "mes"])
    assert len(incremental.update(spark, path, f"{root}/state")["scanned"]) == silver.select("anio", "mes").distinct().count()
    from cafetal.operators import gold as G
    assert rows(incremental.cube(spark, f"{root}/state")) == rows(G.gold_cube(silver))
    assert incremental.update(spark, path, f"{root}/state") == {"version": 1, "scanned": [], "removed": []}
    for k, (y, m) in enumerate([(1996, 5), (1999, 12), (1996, 5)]):          # the same month again: its newest moments go
        part = silver.filter((F.col("anio") == y) & (F.col("mes") == m)).filter(F.dayofmonth("fecha") > 5 + k)
        io.write_partitioned(part, path, ["anio", "mes"])
        silver = silver.filter(~((F.col("anio") == y) & (F.col("mes") == m))).unionByName(part)
        assert incremental.update(spark, path, f"{root}/state") == {"version": k + 2, "scanned": [(y, m)], "removed": []}
        assert rows(incremental.cube(spark, f"{root}/state")) == rows(G.gold_cube(silver))


def test_incremental_gold_forgets_removed_months(spark, scratch):
    from cafetal.operators import gold as G
    silver = to_silver(catalog.bronze_layer(spark, SF_SMALL)).cache()
    root = scratch("incremental-gone")
    a = io.write_partitioned(silver, f"{root}/a", ["anio", "mes"])
    incremental.update(spark, a, f"{root}/state")
    less = silver.filter("NOT (anio = 1997 AND mes IN (1, 2))")
    b = io.write_partitioned(less, f"{root}/b", ["anio", "mes"])
    assert incremental.update(spark, b, f"{root}/state")["removed"] == [(1997, 1), (1997, 2)]
    assert rows(incremental.cube(spark, f"{root}/state")) == rows(G.gold_cube(less))


def test_polygons_brute(spark):
    from fractions import Fraction

    from cafetal.operators import polygon

    rng = random.Random(7)
    g = lambda: rng.choice([rng.randrange(-20, 20) / 10, round(rng.uniform(-2, 2), 6)])
    rings = [("a", 0, [(-1.5, -1.5), (-1.5, 1.5), (0.2, 0.3), (1.5, 1.5), (1.5, -1.5)]), ("a", 1, [(-1.0, -1.0), (-0.5, -1.0), (-0.5, -0.5)]),
             ("b", 0, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]), ("c", 0, [(g(), g()) for _ in range(7)])]
    vertices = [(p, r, s, la, lo) for p, r, vs in rings for s, (la, lo) in enumerate(vs)]
    points = [(g(), g()) for _ in range(500)] + [(0.0, 0.5), (1.0, 1.0), (0.0, 0.0), (-0.75, -1.0), (None, 1.0)]
    v = spark.createDataFrame(vertices, "polygon string, ring int, seq int, lat double, lon double")
    p = spark.createDataFrame(points, "lat double, lon double")
    want = set()
    for la, lo in points:
        for name in "abc":
            if la is None:
                continue
            y, x, n, on = Fraction(round(la * 1e6)), Fraction(round(lo * 1e6)), 0, False
            for q, _, vs in rings:
                for (a, b), (c, d) in zip(vs, vs[1:] + vs[:1]) if q == name else ():
                    y1, x1, y2, x2 = (Fraction(round(z * 1e6)) for z in (a, b, c, d))
                    on |= ((x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(y1, y2) <= y <= max(y1, y2)
                           and min(x1, x2) <= x <= max(x1, x2))
                    n += (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1)
            if on or n % 2:
                want.add((la, lo, name))
    for cell in (20_000, 200_000, 5_000_000):
        got = polygon.points_in_polygons(p, v, cell)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want), cell
    plan = plan_text(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_table_diff_is_a_multiset_difference(spark):
    from collections import Counter

    from cafetal.operators.tablediff import table_diff

    rng = random.Random(8)
    row = lambda: (rng.choice([1, 2, 3, None]), rng.choice(["k1", "k2", "k3", "k4", None]), rng.choice([0.5, 1.5, None]))
    schema = "part int, k string, v double"
    for _ in range(4):
        same = [row() for _ in range(30)]
        a, b = same + [row() for _ in range(rng.choice([0, 9]))], same + [row() for _ in range(6)]
        rng.shuffle(b)
        x, y = Counter(a), Counter(b)
        diff = [(s, r, n) for s, d in (("alta", y - x), ("baja", x - y)) for r, n in d.items()]
        sides = {k: {s for s, r, _ in diff if r[1] == k} for k in {r[1] for _, r, _ in diff}}
        want = [("cambio_" + s if len(sides[r[1]]) == 2 else s, *r, n) for s, r, n in diff]
        got = table_diff(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], ["part"])
        assert rows(got) == sorted(want, key=lambda t: tuple((z is None, str(z)) for z in t))
    assert table_diff(spark.createDataFrame(a, schema), spark.createDataFrame(a[::-1], schema), ["k"], ["part"]).count() == 0


def test_region_is_answered_from_stored_sketches(spark, scratch):
    from cafetal.operators import sketches

    silver = catalog.silver_layer(spark, SF_SMALL)
    states = spark.read.parquet(io.write_parquet(sketches.month_states(silver), scratch("sketches-test")))
    got = sketches.quantiles(states, []).first()
    values = sorted(r[0] for r in silver.select("temp_c").collect())
    assert got.n == len(values)
    for rank, q in ((0.1, got.q10), (0.5, got.q50), (0.9, got.q90)):
        below, upto = (sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values))
        assert below - sketches.RANK_ERROR <= rank <= upto + sketches.RANK_ERROR
    days = silver.select("fecha").distinct().count()
    assert abs(got.dias_distintos - days) <= sketches.COUNT_ERROR * days
    plan = plan_text(sketches.quantiles(states, ["mes"]))
    assert "temp_c" not in plan                                            # only states are read


def test_stream_join_keeps_matches_over_restarts_and_drops_state(spark, scratch):
    from cafetal.streaming.alarm_join import run_alarm_join
    from cafetal.streaming.amplitude import EVENTS_SCHEMA

    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    src, sink, ckpt = scratch("alarm_in"), scratch("alarm_out"), scratch("alarm_ckpt")
    deliveries = [[(1, t(0), 7, "error"), (2, t(5), 7, "view"), (3, t(1), 8, "error")],
                  [(4, t(6), 7, "view"), (5, t(6.5), 7, "view"), (6, t(7), 8, "view"), (7, t(6), 8, "view"), (8, t(6), 9, "error")],
                  [(9, t(11), 9, "view"), (10, t(40), 9, "error")], [(11, t(44), 9, "view"), (12, t(90), 1, "view")]]
    want = {(1, 2), (1, 4), (3, 6), (3, 7), (8, 9), (10, 11)}
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "2")
    for k, part in enumerate(deliveries):
        spark.createDataFrame([(*r, 0.0, None) for r in part], EVENTS_SCHEMA).write.parquet(f"{src}/{k}")
        q = run_alarm_join(session, f"{src}/*", sink, ckpt)
    assert sorted((r.alarma, r.lectura) for r in spark.read.parquet(sink).collect()) == sorted(want)
    kept = sum(s["numRowsTotal"] for s in q.recentProgress[-1]["stateOperators"])
    assert kept < sum(map(len, deliveries)) - 6                              # rows that can't match any more are gone
