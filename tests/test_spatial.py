import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import spatial as S


def frame(spark, pts):
    return spark.createDataFrame(pts, "sample string, id bigint, x double, y double")


def test_nearest_against_brute_force(spark):
    rng = random.Random(1)
    pts = [("a", i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(120)] + [("a", 500 + i, 50 + rng.random() * 1e-3, 50.0) for i in range(40)] + [("a", 999, 1e4, -1e4), ("b", 1, 0.0, 0.0), ("b", 2, 0.0, 0.0), ("c", 1, 1.0, 1.0), ("a", 1000, float("nan"), 0.0), ("a", 1001, None, 0.0)]
    got = {(r.sample, r.id): r.nn for r in S.nearest(frame(spark, pts)).collect()}
    ok = [p for p in pts if p[2] is not None and not math.isnan(p[2])]
    for s, i, x, y in ok:
        d = [math.hypot(x - u, y - v) for t, j, u, v in ok if t == s and j != i]
        if d and (s, i) in got:
            assert got[s, i] == pytest.approx(min(d))
    assert len([p for p in ok if p[0] == "a"]) == len([k for k in got if k[0] == "a"]) and ("c", 1) not in got


def test_components_against_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(60)]
    got = {r.node: r.component for r in S.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[n] == min(seen)


def test_pieces(spark):
    pts = [("a", i, float(i % 10), float(i // 10)) for i in range(100)] + [("a", 200 + i, 30.0 + i % 5, float(i // 5)) for i in range(25)] + [("a", 300, 100.0, 100.0)]
    m = S.pieces(frame(spark, pts), spark.createDataFrame([("a", 1.5)], "sample string, radius double"))
    assert {r.piece for r in m.collect()} == {0, 200, 300}
    assert tuple(S.piece_report(m, 20, 0.05, 3).first()) == ("a", 2, 0, 126)


def verdict(spark, tech, nn, span, modal=None, frac=1.0, bin_um=None):
    c = lambda x, t="double": F.lit(x).cast(t)
    r = spark.range(1).select(S.unit_verdict(c(tech, "string"), c(nn), c(frac), c(span), c(span), F.lit(1000), c(modal), c(bin_um)).alias("v")).first().v
    return r.unit, r.verdict


def test_units(spark):
    assert verdict(spark, "Visium", 100.0, 6000.0, 0.95) == ("microns", "ok")
    assert verdict(spark, "Visium", 200.0, 12000.0, 0.95)[1] == "rescale"
    assert verdict(spark, "Visium", 200.0, 12000.0, 0.5) == ("microns", "ok")
    assert verdict(spark, "Xenium", 0.01, 7.0) == ("millimetres", "rescale")
    assert verdict(spark, "DBiT-seq", 1.0, 50.0)[1] == "array_index_not_a_unit"
    assert verdict(spark, "Xenium", None, 6.0)[1] == verdict(spark, "Xenium", 0.0, 6.0)[1] == "coords_degenerate"
    assert verdict(spark, "Xenium", 1.0, 6.0, frac=0.4)[1] == "coords_non_finite"
    assert verdict(spark, "Xenium", 10.0, None)[1] == "no_expected_spacing"
    assert verdict(spark, "Visium HD", 8.0, 6000.0, 0.99, bin_um=8.0) == ("microns", "ok")


def test_grids(spark):
    g = lambda r, s="x": tuple(spark.range(1).select(S.grid(F.lit(r).cast("int"), F.lit(s)).alias("g")).first().g)
    assert g(3350) == (2.0, 6.5, "hd_grid") and g(5524) == (2.0, 11.0, "hd_grid") and g(78) == (None, None, "not_visium_hd")
    assert g(870) == (8.0, 6.5, "hd_grid") and g(872)[2] == "unrecognised_grid" and g(None)[2] == "no_positions_table" and g(1000, "square_008um") == (8.0, None, "hd_grid")


def test_a_cluster_and_a_far_point(spark):
    from tessera.operators.spatial import _sized, nearest

    rows = [("s", i, (i % 60) * 1.0, (i // 60) * 1.0) for i in range(3000)] + [("s", 9999, 1e7, 1e7), ("t", 1, 0.0, 0.0), ("t", 2, 3.0, 4.0)]
    p = spark.createDataFrame(rows, "sample string, id bigint, x double, y double")
    got = {(r["sample"], r.id): r.nn for r in nearest(p).collect()}
    far = ((1e7 - 59) ** 2 + (1e7 - 49) ** 2) ** 0.5
    assert len(got) == 3003 and abs(got["s", 9999] - far) < 1e-6 and got["t", 1] == 5.0 and {got["s", i] for i in range(3000)} == {1.0}
    at = p.selectExpr("sample", "x", "y", "1 n", "id first")
    assert max(r["count"] for r in _sized(at, 32).selectExpr("sample", "floor(x / h) a", "floor(y / h) b").groupBy("sample", "a", "b").count().collect()) <= 32


def test_components_of_a_long_chain(spark):
    from tessera.operators.spatial import connected

    e = spark.createDataFrame([(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)], "a string, b string")
    assert {r.component for r in connected(e).collect()} == {"n0000"}
