import random

from pyspark.sql import functions as F

from tessera.llm import terms
from tessera.llm.terms import after, apply_delta, compacted, load, marked, signed_terms, term_frequencies

SCHEMA = "url string, fmt string, role string, loaded_at timestamp_ntz, term string, n bigint"


def brute(rows):
    import re
    from collections import defaultdict

    occ, rec = defaultdict(int), defaultdict(set)
    for url, *texts in rows:
        if url is not None:
            for f, t in zip(("fmt", "role"), texts):
                for w in re.findall("[a-z0-9]+", (t or "").lower()):
                    occ[f, w] += 1
                    rec[f, w].add(url)
    return {k: (n, len(rec[k])) for k, n in occ.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "c", 1) for r in rows], SCHEMA)


def state(spark, s):
    return of(s.counts_of(spark))


def of(counts):
    return {(r.field_name, r.term): (r.occurrences, r.records) for r in counts.where("field_name <> ''").collect()}


def test_deltas_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    row = lambda: (rng.choice(("u1", "u2", "u3", "u4", None)), rng.choice(("csv.gz", "CSV", "", None, "a+a", "İ.K")), rng.choice(("matrix", "matrix+coords", None)))
    old, folder = [row() for _ in range(40)], str(tmp_path / "state")
    s = apply_delta(spark, None, signed_terms(frame(spark, old), "url", ["fmt", "role"]), folder, rows=3 * terms.SLOT_ROWS)
    assert s.slots == 3 and state(spark, s) == brute(old)
    gone, new = old[:15], [row() for _ in range(10)]
    delta = frame(spark, gone).withColumn("sign", F.lit(-1)).unionByName(frame(spark, new).withColumn("sign", F.lit(1)))
    batch = signed_terms(delta, "url", ["fmt", "role"], sign=F.col("sign"))
    assert of(after(spark, s, batch)) == brute(old[15:] + new) and state(spark, load(spark, folder)) == brute(old)
    apply_delta(spark, s, batch)
    s = load(spark, folder)  # another application finds it
    assert s.version == 1 and s.batches == [0, 1] and state(spark, s) == brute(old[15:] + new)
    s = compacted(spark, s)
    assert s.batches == [0] and state(spark, s) == brute(old[15:] + new)
    s = apply_delta(spark, s, signed_terms(frame(spark, old[15:] + new), "url", ["fmt", "role"], sign=F.lit(-1)))
    assert state(spark, s) == {} and s.parts == {}
    assert load(spark, str(tmp_path / "nothing")) is None


def test_only_touched_partitions_are_written(spark, tmp_path):
    rows = [(f"u{i}", f"t{i}", None) for i in range(40)]
    s = apply_delta(spark, None, signed_terms(frame(spark, rows), "url", ["fmt"]), str(tmp_path / "s"), rows=8 * terms.SLOT_ROWS)
    t = apply_delta(spark, s, signed_terms(frame(spark, [("u1", "t1", None)]), "url", ["fmt"]))
    assert len(s.parts) == 8 and sorted(t.parts.values()).count(1) <= 2 and set(t.parts.values()) == {0, 1}
    assert state(spark, t)["fmt", "t1"] == (2, 1) and len(state(spark, t)) == 40


def test_the_second_call_loads_the_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "files.parquet")
    spark.createDataFrame([(f"u{i % 7}", f"a.b{i % 5}", f"2025-0{1 + i % 3}-05 00:00:00") for i in range(60)], "url string, fmt string, at string").withColumn("loaded_at", F.col("at").cast("timestamp_ntz")).write.parquet(path)
    call = lambda: sorted(map(tuple, term_frequencies(spark.read.parquet(path), "url", ["fmt"], "loaded_at").collect()))
    first = call()
    monkeypatch.setattr(terms, "apply_delta", None)
    assert call() == first


def test_marks_and_edges(spark):
    rows = [(f"u{i}", "csv.gz" if i < 20 else "h5", None) for i in range(40)] + [("u0", "rare", " ")] * 9 + [(None, "csv", "x")]
    got = {r.term: (r.occurrences, r.records, r.mark) for r in term_frequencies(frame(spark, rows), "url", ["fmt", "role"]).collect()}
    assert got == {"csv": (20, 20, "common"), "gz": (20, 20, "common"), "h5": (20, 20, "common"), "rare": (9, 1, "rare")}
    assert term_frequencies(frame(spark, []), "url", ["fmt"], "loaded_at").count() == 0
    few = [(f"u{i}", "five" if i < 5 else "four" if i < 9 else "x" * 9999, None) for i in range(25)]
    assert {r.term[:4]: r.mark for r in marked(apply_delta(spark, None, signed_terms(frame(spark, few), "url", ["fmt"])).counts_of(spark)).collect()} == {"five": None, "four": "rare", "xxxx": "common"}


def test_two_batches_equal_one(spark):
    rows = spark.createDataFrame([(f"u{i % 7}", f"a.b{i % 5}", "r", f"2025-0{1 + i % 3}-05 00:00:00") for i in range(60)], "url string, fmt string, role string, at string").withColumn("loaded_at", F.col("at").cast("timestamp_ntz"))
    a = sorted(map(tuple, term_frequencies(rows, "url", ["fmt", "role"]).collect()))
    assert a == sorted(map(tuple, term_frequencies(rows, "url", ["fmt", "role"], "loaded_at").collect()))
