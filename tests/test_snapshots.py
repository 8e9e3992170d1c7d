import datetime as dt
import random

import numpy as np

from tessera.operators.snapshots import _locate, snapshot_changes

SCHEMA = "snap_date string, delivered_at timestamp_ntz, k string, v string, updated double, key string, bucket int"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, snapshot_changes(df, ["k"], ["v"], **kw).collect()))


def t(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def brute(rows):
    norm = lambda x: None if x is None else x.strip().lower()
    last = {}
    for s, d, *_ in rows:
        last[s] = max(last.get(s, d), d)
    state = {s: {} for s in last}
    for s, d, k, v, u in rows:
        if d == last[s] and k is not None and (norm(k) not in state[s] or u > state[s][norm(k)][0]):
            state[s][norm(k)] = (u, norm(v), k.strip())
    out, dates = [], sorted(state)
    for a, b in zip(dates, dates[1:]):
        p, q = state[a], state[b]
        out += [(b, q[k][2], "added") for k in q.keys() - p.keys()] + [(b, p[k][2], "removed") for k in p.keys() - q.keys()]
        out += [(b, q[k][2], "changed") for k in p.keys() & q.keys() if p[k][1] != q[k][1]]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for n, s in enumerate("abcd"):
        for d in (1, 2)[: 1 + n % 2]:
            for k in rng.sample(range(60), 45):
                for _ in range(rng.choice((1, 1, 2))):
                    rows.append((s, t(n * 3 + d), f"K{k}", rng.choice(("x", " X ", "y", None)), rng.random()))
    for buckets in (10**6, 20):
        assert run(spark, rows, bucket_rows=buckets) == brute(rows)


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [("a", t(1), "k", "v", 1.0)]) == []
    rows = [
        ("a", t(1), "k", None, 1.0), ("a", t(1), "K ", None, 1.0), ("a", t(1), "gone", "v", None), ("a", t(1), None, "v", 1.0),
        ("b", t(2), "k", "", 1.0), ("b", t(2), "n", "v", float("nan")), ("b", t(2), "n", "w", 0.0), ("b", t(2), None, "w", 0.0),
        ("c", None, "k", "", 1.0), ("c", None, "n", "W", 1.0), (None, t(9), "z", "w", 1.0),
    ]
    assert run(spark, rows) == [("b", "gone", "removed"), ("b", "k", "changed"), ("b", "n", "added")]


def test_locate_with_equal_first_halves():
    b1, b2 = np.array([1, 5, 5, 5, 9]), np.array([0, 1, 4, 8, 0])
    assert list(_locate(np.array([5, 5, 5, 2]), np.array([4, 8, 2, 0]), b1, b2)) == [2, 3, -1, -1]


def test_keys_are_fetched_for_differences_only(spark):
    rows = [(s, t(n), f"k{i}", "v" if n < 2 or i > 1 else "w", 1.0) for n, s in ((1, "a"), (2, "b")) for i in range(50)]
    df = snapshot_changes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), ["k"], ["v"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, df.collect())) == [("b", "k0", "changed"), ("b", "k1", "changed")]
    assert "LeftSemi" in plan[plan.index("min(record_key") :]  # the rows meet the differences before their keys are grouped
