import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import readers as R
from tessera.sources import sinks as K


def test_ledger(spark, tmp_path):
    schema = "accession string, n bigint"
    assert R.ledger(spark, str(tmp_path / "none.csv"), schema, ["accession"]).count() == 0
    (tmp_path / "l.csv").write_text("accession,n\n001,5\n,\n")
    assert [tuple(r) for r in R.ledger(spark, str(tmp_path / "l.csv"), schema, ["accession"]).collect()] == [("001", 5), (None, None)]


def test_series_text(spark, tmp_path):
    (tmp_path / "s.txt").write_text("!Sample_title = lost\n^SAMPLE = A\n!Sample_title = one\n!Sample_char = x = 1\r\n!Sample_char = y\nnoise\n^SAMPLE = B \n!Sample_title = " + "z" * 500 + "\n")
    got = {(r.sample, r.key): r.value for r in R.series_text(spark, str(tmp_path / "s.txt")).collect()}
    assert got == {("A", "title"): "one", ("A", "char"): "x = 1 y", ("B", "title"): "z" * 400}


def test_directory_index(spark):
    page = '<a href="?C=N">Name</a><a href="/up/">Parent</a><a href="../">..</a>\n<a href="a_matrix.mtx.gz">a</a> 2024-01-01 10:00 4.5M\n<a href="sub/">sub/</a> 2024-01-01 10:00 -\n<a href="x.tar">x</a> 12'
    got = sorted(map(tuple, R.directory_index(spark.createDataFrame([("http://h/d", page)], "url string, html string")).select("name", "url", "size_bytes", "role").collect()))
    assert got == [("a_matrix.mtx.gz", "http://h/d/a_matrix.mtx.gz", 4_500_000, "matrix"), ("sub/", "http://h/d/sub/", None, "dir"), ("x.tar", "http://h/d/x.tar", 12, "bundle")]


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("part", [7, 1 << 20])
def test_matrix_trio(spark, tmp_path, turned, part):
    entries = [(g, c, g * 10 + c) for g in range(1, 5) for c in range(1, 4) if (g + c) % 2]
    body = "".join(f"{c} {g} {v}\n" if turned else f"{g} {c} {v}\n" for g, c, v in entries)
    (tmp_path / "m.mtx").write_text(f"%%MatrixMarket matrix coordinate integer general\n% note\n4 3 {len(entries)}\n{body}")
    (tmp_path / "b.tsv").write_text("c1\nc2\nc3\n")
    (tmp_path / "f.tsv").write_text("id1\tG1\nid2\tG2\nid3\tG3\nid4\n")
    got = sorted(map(tuple, R.matrix_trio(spark, str(tmp_path / "m.mtx"), str(tmp_path / "b.tsv"), str(tmp_path / "f.tsv"), part).collect()))
    assert got == sorted((f"c{c}", "id4" if g == 4 else f"G{g}", float(v)) for g, c, v in entries)


def test_matrix_trio_compressed_and_refused(spark, tmp_path):
    with gzip.open(tmp_path / "m.mtx.gz", "wt") as f:
        f.write("%%MatrixMarket\n9 9 1\n9 9 1\n")
    (tmp_path / "b.tsv").write_text("c1\n")
    (tmp_path / "f.tsv").write_text("g1\n")
    with pytest.raises(ValueError):
        R.matrix_trio(spark, str(tmp_path / "m.mtx.gz"), str(tmp_path / "b.tsv"), str(tmp_path / "f.tsv"))


def test_coordinates(spark, tmp_path):
    (tmp_path / "bare.csv").write_text("ACGTACGTAC-1,1,0,0,10,20\nACGTACGTAA-1,1,0,1,11,25\n")
    bare = R.coordinate_table(spark, str(tmp_path / "bare.csv"))
    assert bare.columns == R.SPOT_COLUMNS and R.pick_xy(bare) == ("pxl_col_in_fullres", "pxl_row_in_fullres")
    (tmp_path / "head.csv").write_text("cell,x_centroid,y_centroid,X,Y\na,,,1,2\nb,,,3,4\n")
    assert R.pick_xy(R.coordinate_table(spark, str(tmp_path / "head.csv"))) == ("x", "y") or R.pick_xy(R.coordinate_table(spark, str(tmp_path / "head.csv"))) == ("X", "Y")
    (tmp_path / "no.csv").write_text("a,b\n1,2\n")
    assert R.pick_xy(spark.read.option("header", True).csv(str(tmp_path / "no.csv"))) is None


def test_dense_counts(spark, tmp_path):
    (tmp_path / "d.csv").write_text("fov,cell_ID,G1,G2\n1,7,0,3\n1,8,2,x\n")
    assert sorted(map(tuple, R.dense_counts(spark, str(tmp_path / "d.csv")).collect())) == [("1_7", "G2", 3.0), ("1_8", "G1", 2.0)]


def test_cached_reference(spark, tmp_path):
    calls = []

    def fetch(genes):
        calls.append(genes)
        return spark.createDataFrame([(g, 1) for g in genes if g != "none"], "gene string, n int")

    path = str(tmp_path / "ref")
    assert R.cached_reference(spark, path, ["a", "b"], fetch).count() == 2
    assert R.cached_reference(spark, path, ["a"], fetch).count() == 2 and len(calls) == 1
    assert R.cached_reference(spark, path, ["c"], fetch).count() == 3 and calls[-1] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        R.cached_reference(spark, str(tmp_path / "empty"), ["none"], fetch)


def test_sinks(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    K.append_ledger(spark.createDataFrame([(1,)], "b bigint"), str(tmp_path / "l"), schema)
    K.append_ledger(spark.createDataFrame([(2, "x")], "b bigint, a string"), str(tmp_path / "l"), schema)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "l")).collect()), key=str) == [("x", 2), (None, 1)]
    with pytest.raises(ValueError):
        K.append_ledger(spark.range(1), str(tmp_path / "l"), schema)
    assert K.verified_write(spark.range(5), str(tmp_path / "v")) == 5
    K.rewrite(spark, str(tmp_path / "t"), spark.range(3))
    K.rewrite(spark, str(tmp_path / "t"), K.current(spark, str(tmp_path / "t")).where("id > 0"))
    assert K.current(spark, str(tmp_path / "t")).count() == 2
    assert json.loads(K.report({"x": spark.range(2).withColumn("v", F.lit(float("nan")))}))["x"][0]["id"] == 0
    with pytest.raises(ValueError):
        K.report({"x": spark.range(5)}, most=3)


def test_sidecars(spark, tmp_path):
    (tmp_path / "m.json").write_text('{\n"organ": "lung",\n"types": ["a", "b"]\n}')
    assert R.model_sidecars(spark, str(tmp_path)).first().organ == "lung"


def test_gene_names_without_values(spark, tmp_path):
    (tmp_path / "features.tsv").write_text("id1\tG1\nid2\n")
    (tmp_path / "dense.csv").write_text("cell_id,G1,G2\n1,0,3\n")
    assert [r.gene for r in R.gene_names(spark, str(tmp_path / "features.tsv")).orderBy("ordinal").collect()] == ["G1", "id2"]
    assert [r.gene for r in R.gene_names(spark, str(tmp_path / "dense.csv")).orderBy("ordinal").collect()] == ["G1", "G2"]


def test_coordinate_ladder(spark):
    cells = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "cell string")
    t = lambda *k: spark.createDataFrame([(x, 1.0, 2.0) for x in k], "cell string, x double, y double")
    name, at = R.coordinate_ladder([("few", t("a")), ("half", t("a", "b", "b")), ("all", t("a", "b", "c", "d"))], cells)
    assert name == "half" and at.count() == 2
    assert R.coordinate_ladder([("none", t("z"))], cells) == (None, None)


def test_spreadsheet(spark):
    s = spark.createDataFrame([("Human", "unknown", "https://zenodo.org/record/5; x"), ("mouse", "a", "b"), ("homo sapiens", "GSE7 ncbi.nlm.nih.gov", None)], "species string, a string, b string")
    assert sorted((r.source, r.accession) for r in R.spreadsheet_records(s, ["a", "b"]).collect()) == [("GEO", "GSE7"), ("Zenodo", "zenodo:5")]
