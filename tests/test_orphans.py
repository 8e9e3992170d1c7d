import datetime as dt
import random

from tessera.operators.orphans import integer_key, orphans

REF = "id bigint, s string, a string, at timestamp_ntz, family string, number string"
PAR = "s string, a string, at timestamp_ntz, gone timestamp_ntz, month string"


def run(spark, refs, parents):
    r = spark.createDataFrame([(i, *x, "c", "c") for i, x in enumerate(refs)], REF)
    p = spark.createDataFrame([(*x, "c") for x in parents], PAR)
    return sorted((x.row_id, x.period) for x in orphans(r, "id", ["s", "a"], "at", p, ["s", "a"], "at", "gone").collect())


def brute(refs, parents):
    norm = lambda *k: None if None in k else tuple(x.strip().lower() for x in k)
    out = []
    for i, (s, a, at) in enumerate(refs):
        if at is None or norm(s, a) is None:
            continue
        end = dt.datetime(at.year + at.month // 12, at.month % 12 + 1, 1)
        if not any(norm(ps, pa) == norm(s, a) and pt and pt < end and (g is None or g >= end) for ps, pa, pt, g in parents):
            out.append((i, f"{at:%Y-%m}"))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    day = lambda: dt.datetime(2024, 11, 1) + dt.timedelta(days=rng.randrange(150), seconds=rng.randrange(86400))
    acc = lambda: rng.choice(("GSE{}", "gse{} ", "x-{}.TEST", "v{}a", "nodigits", "GSE0{}")).format(rng.choice((rng.randrange(30), 65530 + rng.randrange(12))))
    parents = [(rng.choice("Gg"), acc(), day(), rng.choice((None, None, day()))) for _ in range(300)]
    refs = [(rng.choice("Gg"), acc(), day()) for _ in range(500)] + [("G", "GSE1", day())] * 50
    assert run(spark, refs, parents) == brute(refs, parents)


def test_edges(spark):
    t = dt.datetime(2025, 1, 31, 23, 59, 59)
    parents = [("a", "1", dt.datetime(2025, 2, 1), None), ("a", "2", t, dt.datetime(2025, 2, 1)), ("a", "3", None, None), ("a", None, t, None), ("a", "4", t, dt.datetime(2025, 1, 31))]
    refs = [("a", "1", t), ("a", "2", t), ("a", "3", t), ("a", None, t), (None, "1", t), ("a", "4", t), ("a", "", t), ("a", "1", None), ("A ", " 2", t)]
    assert run(spark, refs, parents) == brute(refs, parents) == [(0, "2025-01"), (2, "2025-01"), (5, "2025-01"), (6, "2025-01")]
    assert run(spark, [], parents) == [] and run(spark, refs[:1], []) == [(0, "2025-01")]


def test_integer_keys_are_one_to_one(spark):
    from pyspark.sql import functions as F

    keys = ["a1", "a01", "a10", "1", "", "a", "1a", "a1b2", "a1b", "9" * 40, "9" * 39 + "8", "a\n1", "a-1", "a\u0002b1", "a1b\u0002", "a\u0003b1", "a1b\u0003b", "\u0003", "\u0002", "\u0001"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(*integer_key([F.col("k")]))
    assert len({(r.family, r.number) for r in df.collect()}) == len(keys)
