from pyspark.sql import functions as F

from tessera.streaming import ledger as L


def put(spark, path, rows):
    spark.createDataFrame(rows, "user_id bigint, ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)


def test_a_second_run_goes_on_where_the_first_stopped(spark, tmp_path):
    import datetime as dt

    src, out, check = (str(tmp_path / x) for x in ("src/t.parquet", "out", "check"))
    day = dt.datetime(2024, 1, 1)
    put(spark, src, [(1, day, 2.0), (2, day, 1.0)])
    totals = lambda: L.final(spark, L.run(L.running_totals(L.stream(spark, str(tmp_path / "src"), "t"), "user_id", "value"), "update", out, check), ["user_id"], "user_id bigint, total double, n bigint")
    assert sorted(map(tuple, totals().collect())) == [(1, 2.0, 1), (2, 1.0, 1)]
    put(spark, src, [(1, day, 5.0)])
    assert sorted(map(tuple, totals().collect())) == [(1, 7.0, 2), (2, 1.0, 1)]
    assert sorted(map(tuple, totals().collect())) == [(1, 7.0, 2), (2, 1.0, 1)]


def test_guard_and_duplicates(spark, tmp_path):
    import datetime as dt

    src = str(tmp_path / "src")
    day = dt.datetime(2024, 1, 1)
    put(spark, f"{src}/t.parquet", [(1, day, 2.0), (1, day, 9.0), (2, day, 1.0)])
    out = L.run(L.spend_guard(L.stream(spark, src, "t"), "user_id", "ts", "value", 10.0), "update")
    got = L.final(spark, out, ["user_id"], "user_id bigint, spent double, capped boolean").collect()
    assert sorted(map(tuple, got)) == [(1, 11.0, True), (2, 1.0, False)]
    once = L.run(L.deduplicated(L.stream(spark, src, "t"), ["user_id"], "ts", "1 day").select("user_id"), "append")
    assert sorted(r[0] for r in spark.read.parquet(f"{once}/batch=*").collect()) == [1, 2]
    w = L.run(L.windowed_counts(L.stream(spark, src, "t"), "ts", "1 day", "1 day", "user_id"), "update")
    assert spark.read.parquet(f"{w}/batch=*").agg(F.sum("n")).first()[0] == 3
