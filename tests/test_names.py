import pytest
from pyspark.sql import functions as F

from tessera.functions import names as N


def one(spark, col):
    return spark.range(1).select(col).first()[0]


@pytest.mark.parametrize(
    "name,role",
    [("A/._x.h5ad", "other"), ("raw_feature_bc_matrix.h5", "matrix_raw"), ("s_umap.csv", "other"), ("cell_boundaries.parquet", "segmentation"), ("x.ome.tif", "image"), ("transcripts.parquet", "transcripts"), ("a.h5ad.gz", "matrix+coords"), ("tissue_positions.csv", "coords"), ("d/cells.csv.gz", "coords"), ("matrix.mtx.gz", "matrix"), ("a.tar.gz", "bundle"), ("readme", "other"), ("cells_transcripts.csv", "transcripts")],
)
def test_file_roles(spark, name, role):
    assert one(spark, N.file_role(F.lit(name))) == role


def test_technologies_in_order(spark):
    for text, t in (("10x Visium HD v2", "Visium HD"), ("visium", "Visium"), ("MERSCOPE", "MERFISH"), ("odd", "Other"), ("", "Unknown"), (None, "Unknown")):
        assert one(spark, N.technology(F.lit(text).cast("string"))) == t


@pytest.mark.parametrize(
    "url,want",
    [("x GSE123 y", ("GEO", "GSE123")), ("https://zenodo.org/record/77", ("Zenodo", "zenodo:77")), ("10.5281/zenodo.88", ("Zenodo", "zenodo:88")), ("https://figshare.com/articles/dataset/a/123456", ("figshare", "figshare:123456")), ("https://www.10xgenomics.com/datasets/slug-1?x#y", ("10x Datasets", "10xgenomics.com/datasets/slug-1")), ("E-MTAB-5", ("ArrayExpress", "E-MTAB-5")), ("HTA12_1", ("HTAN", "HTA12")), ("https://www.a.example/b/", ("other", "a.example/b")), ("nothing", (None, None)), (None, (None, None))],
)
def test_links(spark, url, want):
    assert tuple(one(spark, N.link(F.lit(url).cast("string")))) == want


def test_genes(spark):
    for g, s in (("GRCh38_ACTB", "ACTB"), ("ENSG00000075624.13", "ENSG00000075624"), ("actb-v1-prime", "ACTB")):
        assert one(spark, N.gene_symbol(F.lit(g))) == s
    for g, s in (("A-prime-with-v1-seg", "A"), ("A-seg", "A-seg"), ("-v1", "-v1"), ("B_v2", "B")):
        assert one(spark, N.without_probe_version(F.lit(g))) == s
    assert one(spark, N.is_control(F.lit("xNegControl"), "panel")) and not one(spark, N.is_control(F.lit("xNegControl"), "model"))


def test_ages(spark):
    age = lambda n, u, p=False: tuple(one(spark, N.age_fields(F.lit(n).cast("double"), F.lit(u).cast("string"), F.lit(p))))
    assert age(1.99, "year")[0] == "infant" and age(2, "year")[0] == "child" and age(60, "year")[0] == "late_adult"
    assert age(None, "year") == age(3, None) == ("unknown", "unknown")
    assert age(8.5, "week", True) == ("embryonic", "8th week post-fertilization stage") and age(11, "week", True)[1].startswith("11th") and age(21, "week", True)[1].startswith("21st")
    assert age(23, "month")[1] == "23-month-old stage" and age(24, "month")[1] == "2-year-old stage" and age(3, "year", True) == ("fetal", "unknown")


def test_sizes_and_magic(spark):
    assert [one(spark, N.size_to_bytes(F.lit(x))) for x in ("4.5G", "12", " 1.5k", "-", "")] == [4_500_000_000, 12, 1500, None, None]
    assert one(spark, N.magic(F.lit(bytearray(b"PK\x03\x04")))) == "zip" and one(spark, N.magic(F.lit(bytearray(b"\0" * 257 + b"ustar")))) == "tar"
    assert one(spark, N.decade_midpoint(F.lit("Fourth decade stage"))) == 35


def test_long_names_stay_apart(spark):
    a, b = (one(spark, N.slug_tag(F.lit("s"), F.lit("x" * 200 + c))) for c in "ab")
    assert a != b and len(a) == 119
