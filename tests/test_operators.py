import random

from pyspark.sql import functions as F

from tessera.operators import dedupe, matrix, ontology, panels, quality, relational


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_qc_keeps_empty_cells_and_repeated_entries(spark):
    obs = spark.createDataFrame([("s", 1), ("s", 2), ("t", 3)], "sample string, cell bigint")
    e = spark.createDataFrame([(1, 10, 2.0), (1, 10, 3.0), (1, 11, 1.0)], "cell bigint, gene bigint, value double")
    q = {r["sample"]: r for r in matrix.qc_per_sample(obs, e).collect()}
    assert (q["s"].n_cells, q["s"].n_genes, q["s"].median_counts, q["s"].frac_zero_cells) == (2, 2, 3.0, 0.5)
    assert (q["t"].n_genes, q["t"].frac_zero_cells) == (0, 1.0)


def test_matrix_kinds(spark):
    m = [("raw", c, float(c % 3)) for c in range(9)] + [("scaled", c, -0.5) for c in range(3)] + [("norm", c, v) for c in range(9) for v in (0.25 + c / 100, 9.75 - c / 100)] + [("log", c, c * 0.37) for c in range(9)] + [("other", c, 33.3 * c) for c in range(9)] + [("log", 1, None)]
    got = {r.matrix: r.kind for r in matrix.matrix_kind(spark.createDataFrame(m, "matrix string, cell bigint, value double")).collect()}
    assert got == {"raw": "raw_counts", "scaled": "scaled", "norm": "normalised", "log": "log1p", "other": "other"}


def test_counts_recover(spark):
    e = [("half", g, k * 0.5 + 0.0) for g in range(3) for k in (1, 2, 3, 5, 7)] + [("int", 1, float(k)) for k in range(6)] + [("neg", 1, -1.0)] + [("odd", 1, 1 + k * 0.37) for k in range(9)]
    got = {r.matrix: r.verdict for r in matrix.counts_recover(spark.createDataFrame(e, "matrix string, gene bigint, value double")).collect()}
    assert got == {"half": "fractional", "int": "counts", "neg": "not_recoverable", "odd": "not_recoverable"}


def test_sex(spark):
    panel = {
        "f": {"XIST": 50, "DDX3Y": 0, "KDM5D": 0, "A": 1000}, "m": {"Xist": 0, "DDX3Y": 9, "KDM5D": 9, "A": 1000}, "one": {"XIST": 0, "DDX3Y": 9, "A": 1000}, "trap": {"XIST": 0, "RPS4Y1": 90, "DDX3Y": 1, "A": 100},
        "none": {"A": 10}, "x only": {"XIST": 5, "A": 10}, "y only": {"DDX3Y": 5, "UTY": 5, "A": 10}, "mixed": {"XIST": 5, "DDX3Y": 5, "UTY": 5, "A": 10},
    }
    e = [(s, g, v) for s, p in panel.items() for g, v in p.items() if v]
    v = [(s, i, g) for s, p in panel.items() for i, g in enumerate(p)]
    got = {r["sample"]: r.call for r in matrix.marker_call(spark.createDataFrame(e, "sample string, gene string, value bigint"), spark.createDataFrame(v, "sample string, ordinal bigint, gene string")).collect()}
    assert got == {"f": "female", "m": "male", "one": "unknown", "trap": "unknown", "none": "unknown", "x only": "female", "y only": "male", "mixed": "unknown"}


def test_panel_identity(spark):
    ids = lambda *g: spark.createDataFrame([(list(g),)], "g array<string>").select(panels.panel_id(F.col("g")), panels.panel_key(F.col("g"))).first()
    a, b, c = ids("A", "b", " C "), ids("c", "B", "A", "a", "", "NegControl1"), ids("A", "B")
    assert a[0] == b[0] != c[0] and a[1] != b[1]


def test_cohorts(spark):
    genes = [("p1", g) for g in range(10)] + [("p2", g) for g in range(9)] + [("p3", g) for g in range(8)] + [("p4", g + 5) for g in range(9)]
    g = spark.createDataFrame(genes, "panel string, gene bigint")
    s = spark.createDataFrame([(f"{p}-{i}", p) for p, n in (("p1", 3), ("p2", 1), ("p3", 3), ("p4", 2)) for i in range(n)], "sample string, panel string")
    assert rows(panels.cohorts(s.selectExpr("*", "'X' technology"), g, 0.9, 2)) == [("X", "p1", 2, 4, 10), ("X", "p3", 1, 3, 8), ("X", "p4", 1, 2, 9)]


def test_exact_copies(spark):
    d = spark.createDataFrame([(1, "t", "a", 1), (2, "t", "b", 0), (3, "t", "a", 1), (4, "u", "a", 0), (5, "u", "a", 0), (6, None, "a", 0), (7, None, "b", 0)], "id bigint, t string, src string, gaps int")
    assert rows(dedupe.exact_copies(d, "id", F.col("t"), "src", [F.col("gaps")])) == [(1, 2), (3, 2)]


def test_series_aggregates(spark):
    d = [("x", "x", 105.0), ("x", "s1", 60.0), ("x", "s2", 40.0), ("y", "y", 106.0), ("y", "s", 100.0), ("z", "z", 1.0)]
    assert rows(dedupe.series_aggregates(spark.createDataFrame(d, "accession string, sample_id string, units double"))) == [("x", 1.05, 2)]


def test_closure_and_levels(spark):
    e = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("x", "x"), ("p", "q"), ("q", "p")], "child string, parent string")
    c = ontology.closure(e)
    assert rows(c) == [("b", "a"), ("c", "a"), ("d", "a"), ("d", "b"), ("d", "c"), ("p", "q"), ("q", "p")]
    t = spark.createDataFrame([("d",), ("a",), ("lone",)], "term string")
    assert rows(ontology.levels(t, c, ["c", "a"], ["a", "c", "b"])) == [("a", "a", "a", "a"), ("d", "c", "c", "d"), ("lone", "other", "lone", "lone")]


def test_keyed_rewrites(spark):
    base = spark.createDataFrame([("a", "x"), ("b", "unknown"), ("c", None)], "k string, v string")
    new = spark.createDataFrame([("b", "y"), ("c", " "), ("d", "z")], "k string, v string")
    from tessera.functions.text import stated

    filled, log = relational.fill_with_conflicts(base, new.union(spark.createDataFrame([("a", "X2")], "k string, v string")), ["k"], ["v"], lambda c: ~stated(c))
    assert rows(filled) == [("a", "x"), ("b", "y"), ("c", None)] and rows(log) == [("a", "v", "x", "X2")]
    assert rows(relational.upsert(base, new, ["k"])) == [("a", "x"), ("b", "y"), ("c", " "), ("d", "z")]
    assert rows(relational.insert_new(base, new.union(new), ["k"])) == [("d", "z")]
    assert rows(relational.no_downgrade(base, new, ["k"])) == rows(relational.upsert(base, new, ["k"]))
    assert rows(relational.keep_prior(base, spark.createDataFrame([("b", "old"), ("a", "old")], "k string, v string"), ["k"], "v")) == [("a", "x", False), ("b", "old", True), ("c", None, False)]


def test_joins(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id bigint, k string")
    dim = spark.createDataFrame([("a", 5), ("a", 4), (None, 7)], "k string, v bigint")
    assert rows(relational.star_join(fact, [(dim, ["k"], "d_")])) == [(1, "a", 4), (2, None, 7), (3, "z", None)]
    l, r = spark.range(10).toDF("id"), spark.range(4).toDF("id")  # noqa: E741
    assert relational.overlap_join(l, r, "id").count() == 0 and relational.overlap_join(l, spark.range(5).toDF("id"), "id").count() == 5


def test_species(spark):
    g = [("human", i, f"SOX{i}") for i in range(12)] + [("mouse", i, f"Sox{i}") for i in range(12)] + [("few", i, "Sox1") for i in range(3)] + [("ids", i, f"ENSG{i:011d}") for i in range(12)] + [("mids", i, f"ENSMUSG{i:011d}") for i in range(12)]
    got = {r["sample"]: r.species for r in quality.species(spark.createDataFrame(g, "sample string, ordinal bigint, gene string")).collect()}
    # an identifier of the mouse begins like a human one, so it counts on both sides and settles nothing alone
    assert got["human"] == "homo_sapiens" and got["mouse"] == "mus_musculus" and got["few"] is None and got["ids"] == "homo_sapiens"


def test_rule_order_and_empty_tables(spark):
    assert relational.top_values(spark.createDataFrame([], "a string"), "a", 3).count() == 0
    d = spark.createDataFrame([(1, 0, 100, 0, True, "ok"), (2, 500, 100, 9, True, "wrong unit"), (3, 100, 20000, 10, False, "ok"), (4, 500, 100, 9, True, "missing"), (5, 500, 100, 9, True, "ok")], "sample bigint, n_units bigint, n_genes bigint, n_pairs bigint, is_counts boolean, geometry string")
    assert [r.verdict for r in quality.readiness(d).orderBy("sample").collect()] == ["usable_with_care", "fixable_rescale", "usable_with_care", "not_ready", "ready"]


def test_ledger_order(spark):
    rng = random.Random(1)
    r = [(rng.choice("ab"), rng.choice(("done", "failed", "x")), i) for i in range(40)]
    d = spark.createDataFrame(r, "k string, s string, i bigint")
    assert rows(relational.last_wins(d, ["k"], [F.col("i")])) == sorted((k, *max(((s, i) for q, s, i in r if q == k), key=lambda x: x[1])) for k in "ab")
    want = sorted((k, *min(((s, i) for q, s, i in r if q == k), key=lambda x: (("done", "failed", "x").index(x[0]), -x[1]))) for k in "ab")
    assert rows(relational.preferred_status(d, ["k"], "s", ["done", "failed"], [F.col("i")])) == want


def test_guards(spark):
    import pytest

    d = spark.createDataFrame([(1,), (2,), (None,)], "x bigint")
    assert quality.require_share(d, F.col("x") > 0, 0.6) is d
    for bad, least in ((d, 0.7), (d.limit(0), 0.0)):
        with pytest.raises(quality.QualityError):
            quality.require_share(bad, F.col("x") > 0, least)
    base = spark.createDataFrame([("a", None), ("b", "v")], "k string, v string")
    fill = spark.createDataFrame([("a", "new")], "k string, v string")
    assert rows(relational.guarded_fill(base, fill, ["k"], "v", lambda c: c.isNull())) == [("a", "new"), ("b", "v")]
    with pytest.raises(relational.OverwriteError):
        relational.guarded_fill(base, spark.createDataFrame([("b", "new")], "k string, v string"), ["k"], "v", lambda c: c.isNull())


def test_containment_join(spark):
    l = spark.createDataFrame([("visium hd",), ("xenium",), ("ab",), (None,), ("",)], "t string")  # noqa: E741
    r = spark.createDataFrame([("visium",), ("10x xenium v1",), ("xaby",), ("zzz",)], "s string")
    assert rows(relational.containment_join(l, "t", r, "s")) == [("ab", "xaby"), ("visium hd", "visium"), ("xenium", "10x xenium v1")]


def test_pooled_panels(spark):
    e = spark.createDataFrame([("g", "s1", "A"), ("g", "s2", "A"), ("g", "s1", "B"), ("h", "s3", "A")], "organ string, sample string, gene string")
    assert rows(panels.pooled_panel(e, "organ")) == [("g", "A", 2), ("g", "B", 1), ("h", "A", 1)]


def test_label_transfer_on_held_out_labels(spark):
    import random

    from tessera.operators.labels import transfer

    rng = random.Random(8)
    data = [(i, [rng.gauss(3.0 if k == i % 4 else 0.0, 1.0) for k in range(6)], i % 4) for i in range(600)]
    df = spark.createDataFrame([(i, v, None if i % 5 == 0 else c) for i, v, c in data], "id int, v array<double>, c int")
    got = {r.id: r.predicted for r in transfer(df, "id", "v", "c", clusters=4).collect()}
    held = [(got[i], c) for i, _, c in data if i % 5 == 0]
    assert len(got) == 600 and sum(a == b for a, b in held) >= 0.85 * len(held)
