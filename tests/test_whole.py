"""Queries that once returned a part of their rows."""

from collections import Counter
from hashlib import md5

from pyspark.sql import functions as F

from tessera.operators import relational
from tessera.plans import catalogue, derived, resolve


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_balance_cap_keeps_all_rows_of_classes_of_fifty(spark, tmp_path):
    rows = [(i, label) for label, n in ((0, 49), (1, 50), (2, 200), (None, 60)) for i in range(1000 * (label or 9), 1000 * (label or 9) + n)]
    folder = put(spark, tmp_path, "embeddings", rows, "vec_id bigint, label bigint")
    assert sorted(map(tuple, catalogue.balance_cap(spark, folder).collect())) == sorted(r for r in rows if r[1] in (1, 2))


def test_balance_cap_beyond_25000_rows(spark, tmp_path):
    sizes = {0: 49, 1: 60, 2: 9000, 3: 20000}
    rows = [(100_000 * label + i, label) for label, n in sizes.items() for i in range(n)]
    folder = put(spark, tmp_path, "embeddings", rows, "vec_id bigint, label bigint")
    got = [tuple(r) for r in catalogue.balance_cap(spark, folder).collect()]
    assert Counter(x for _, x in got) == {1: 60, 2: 8333, 3: 8333}
    first = sorted((v for v, x in rows if x == 3), key=lambda v: md5(str(v).encode()).hexdigest())[:8333]
    assert {v for v, x in got if x == 3} == set(first)


def test_balance_floor(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("c"), "id")
    count = lambda **k: Counter(r.c for r in relational.balance(rows, "c", [F.col("id")], **k).collect())
    assert count(most=300, least=50) == {0: 100, 1: 100, 2: 100} and count(most=299, least=50) == {0: 99, 1: 99, 2: 99}
    assert count(most=90, least=50) == {0: 50, 1: 50, 2: 50} and count(most=90, least=101) == {}


def test_priority_queue_is_the_whole_queue_in_order(spark, tmp_path):
    rows = [(i, ("GEO", "Zenodo", None)[i % 3], None if i % 50 == 7 else f"2025-01-{i % 28 + 1:02d}", "failed" if i % 10 == 9 else " Pending") for i in range(500)]
    folder = put(spark, tmp_path, "candidates", rows, "cand_id bigint, source string, added string, status string")
    want = sorted((r[:3] for r in rows if r[3] == " Pending"), key=lambda r: (r[1] is not None, r[1] == "GEO", r[2] is None, r[2] or "", r[0]))
    assert len(want) == 450 and [tuple(r) for r in catalogue.priority_queue(spark, folder).collect()] == want


def test_segment_queue_reaches_deposits_of_unknown_size(spark, tmp_path):
    rows = [(f"a{i:03d}", role, None if i == 5 else (i * 7919) % 1000) for i in range(150) for role in ("coords", " Matrix")] + [("half", "coords", 1), (None, "coords", 1), (None, "matrix", 1)]
    folder = put(spark, tmp_path, "files", rows, "accession string, role string, size_bytes bigint")
    want = sorted({(a, n) for a, _, n in rows if a not in (None, "half")}, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    got = [tuple(r) for r in derived.segment_queue(spark, folder).collect()]
    assert got == want and len(got) == 150 and got[-1] == ("a005", None)


def test_annotation_plan_holds_the_small_groups(spark, tmp_path):
    rows = [(f"organ{i:03d}", assay) for i in range(150) for assay in ("x", None) for _ in range(1 + i % 3)] + [("n/a", "x"), (None, "x")]
    folder = put(spark, tmp_path, "sample_meta", rows, "tissue string, assay string")
    want = Counter(r for r in rows if r[0] not in (None, "n/a"))
    want = sorted(((*k, n) for k, n in want.items()), key=lambda r: (-r[2], r[0], r[1] is not None))
    assert len(want) == 300 and [tuple(r) for r in derived.annotation_plan(spark, folder).collect()] == want


def test_pair_coverage_asks_for_every_neighbouring_pair(spark, tmp_path):
    put(spark, tmp_path, "part", [(k,) for k in range(1, 13)], "p_partkey bigint")
    held = {1: [1, 2, 3, 4, 5, 6], 2: [1, 3, 6, 7], 3: [2, 4], 4: [11, 12]}
    folder = put(spark, tmp_path, "lineitem", [(s, k) for s, ks in held.items() for k in ks + ks[:1]], "l_suppkey bigint, l_partkey bigint")
    assert {r["sample"]: r.n_pairs for r in resolve.pair_coverage(spark, folder).collect()} == {1: 5, 2: 1, 3: 0, 4: 1}


def test_shares_and_classes_over_many_parts(spark, monkeypatch):
    from itertools import accumulate

    values = [(f"v{i:03d}",) for i in range(200) for _ in range(1 + i % 7)]
    n = sorted(((c, v) for v, c in Counter(v for (v,) in values).items()), key=lambda x: (-x[0], x[1]))
    want = [(v, c, k + 1, round(100 * s / len(values), 6)) for k, ((c, v), s) in enumerate(zip(n, accumulate(c for c, _ in n)))]
    got = relational.cumulative_share(spark.createDataFrame([*values, (None,)], "v string"), "v").orderBy("rank").collect()
    assert [(r["value"], r.n, r["rank"], round(r.cum_pct, 6)) for r in got] == want
    monkeypatch.setattr(relational, "SALT_ROWS", 10)
    rows = spark.range(300).select((F.col("id") % 3).alias("c"), "id")
    assert sorted(r.id for r in relational.balance(rows, "c", [F.col("id")], most=150, least=50).collect()) == list(range(150))


def test_cohorts_per_technology_against_brute_force(spark):
    import random

    from tessera.operators import panels

    rng = random.Random(6)
    sets = {f"p{i}": set(rng.sample([f"g{k}" for k in range(12)], rng.randrange(5, 12))) for i in range(14)}
    sets |= {f"q{i}": sets[f"p{i}"] - {min(sets[f"p{i}"])} for i in range(6)}
    samples = [(i, rng.choice("XYZ"), rng.choice(sorted(sets))) for i in range(300)]
    want, taken = [], set()
    for tech in "XYZ":
        n = Counter(p for _, t, p in samples if t == tech)
        for seed in sorted((p for p in n if n[p] >= 4), key=lambda p: (-len(sets[p]), p)):
            if seed not in taken:
                group = [p for p in n if p not in taken and len(sets[p] & sets[seed]) >= 0.7 * len(sets[seed])]
                taken |= set(group)
                want.append((tech, seed, len(group), sum(n[p] for p in group), len(sets[seed])))
    s = spark.createDataFrame(samples, "sample int, technology string, panel string")
    g = spark.createDataFrame([(p, x) for p, xs in sets.items() for x in xs], "panel string, gene string")
    assert [tuple(r) for r in panels.cohorts(s, g, 0.7, 4).collect()] == want
    pairs = {(a, b): round(len(sets[a] & sets[b]) / len(sets[a]), 6) for a in sets for b in sets if a != b and sets[a] & sets[b]}
    assert {(r.seed, r.panel): r.share for r in panels.containment(g).collect()} == pairs
    assert {(r.seed, r.panel): r.share for r in panels.containment(g, min_share=0.7).collect()} == {k: x for k, x in pairs.items() if x >= 0.7}
