import pytest
from pyspark.sql import functions as F

from tessera.llm.canon import age_form, canonical, map_fields, near_pairs

CANON = [
    (1, "tissue", "kidney", '["ren"]'), (2, "tissue", "sigmoid colon", "[]"), (3, "tissue", "subcutaneous adipose tissue", '["subcutaneous fat"]'), (4, "tissue", "umbilical cord", None), (5, "tissue", "transverse colon", "[]"),
    (6, "tissue", "parathyroid gland", "[]"), (7, "tissue", "parotid gland", "[]"), (11, "state", "healthy", '["normal"]'), (12, "state", "disease", '["diseased"]'),
    (21, "stage", "12-year-old stage", "[]"), (22, "stage", "3-month-old stage", "[]"), (23, "stage", "12th week post-fertilization stage", "[]"), (24, "stage", "fetal stage", '["fetus"]'),
    (31, "people", "West African", "[]"), (32, "people", "East African", "[]"), (33, "people", "Ashkenazi Jewish", "[]"),
]
CASES = [
    ("tissue", " KIDNEY ", 1), ("tissue", "normal_kidney", 1), ("tissue", "ren;", 1), ("tissue", "sgimoid  colon", 2), ("tissue", "sigmoidd colon", 2), ("tissue", "colon, sigmoid", 2), ("tissue", "biopsy of sigmiod colon (FFPE)", 2),
    ("tissue", "subcutaneous adipose tissue sample", 3), ("tissue", "human subcutaneous adipose tissue, donor 12", 3), ("tissue", "cord, umbilical", 4), ("tissue", "transv. colon", 5), ("tissue", "Parath. gland", 6), ("tissue", "par. gland", 0),
    ("tissue", "slide 9", 0), ("tissue", "wing disc", 0), ("tissue", "kidneys and more", 0), ("tissue", "x" * 5000, 0),
    ("state", "status: normal", 11), ("state", "diseased tissue", 12), ("state", "disesae", 12), ("state", "batch 3", 0),
    ("stage", "age 12 years", 21), ("stage", "12yo.", 21), ("stage", "12-year old human stage", 21), ("stage", "3 mths old", 22), ("stage", "3-month old infant", 22), ("stage", "PCW12", 23), ("stage", "week 12 post-fertilization", 23),
    ("stage", "12 weeks post conception", 23), ("stage", "12th week post fertilisation", 23), ("stage", "fetal", 24), ("stage", "13 years", 0), ("stage", "passage 12", 0), ("stage", "12 h culture", 0),
    ("people", "wast african", 31), ("people", "eest african", 32), ("people", "self-identified ashkenazi jewish", 33), ("people", "East African descent", 32),
]


@pytest.fixture(scope="module")
def canon(spark):
    return spark.createDataFrame([(*r, "clash") for r in CANON], "term_id bigint, field_name string, label string, synonyms string, value string")


def test_cases(spark, canon):
    values = spark.createDataFrame([(f, v) for f, v, _ in CASES], "field_name string, value string")
    got = {(r.field_name, r.value): r.term_id for r in canonical(values, canon).collect()}
    assert got == {(f, v): t for f, v, t in CASES}


def test_ages(spark):
    for text, form in (("7y", "7 year"), ("07 y.o", "7 year"), ("age 2 months", "2 month"), ("31st week post-fertilization stage", "31 week"), ("pcw 9 embryo", "9 week"), ("9", None), ("passage 9", None), ("year 9", None)):
        assert spark.range(1).select(age_form(F.lit(text))).first()[0] == form


def test_slips_against_brute_force(spark):
    refs = ["sigmoid colon", "kidney cortex", "kidney medulla", "spleen", "lungs", "aorta"]
    forms = sorted({w[:i] + x + w[j:] for w in refs for i in range(len(w)) for j in (i, i + 1) for x in ("", "q")} | {w[:i] + w[i : i + 2][::-1] + w[i + 2 :] for w in refs for i in range(len(w))} | {"lung", "q", "kidney", "xxsigmoid colon"})
    r = spark.createDataFrame([("f", w, i) for i, w in enumerate(refs)], "field_name string, spelling string, term_id bigint")
    v = spark.createDataFrame([("f", w) for w in forms], "field_name string, form string")
    got = {(x.form, x.spelling) for x in near_pairs(v, r).collect()}

    def slip(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if any(a[:i] + a[i + 1 :] == b for i in range(len(a))) or any(b[:i] + b[i + 1 :] == a for i in range(len(b))):
            return True
        diff = [i for i in range(len(a)) if len(a) == len(b) and a[i] != b[i]]
        return len(a) == len(b) and (len(diff) == 1 or len(diff) == 2 and sorted(a) == sorted(b))

    assert got == {(a, b) for a in forms for b in refs if slip(a, b)}


def test_rows(spark, canon):
    rows = [(1, "kidney", "NORMAL"), (2, "Kidney", None), (2, "Kidney", ""), (3, "n/a", "unknown"), (4, "wing disc", "healthy")]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], "meta_id bigint, tissue string, state string, value string, key string")
    got = sorted(map(tuple, map_fields(df, canon, ["tissue", "state"]).collect()))
    assert got == [(1, "state", 11), (2, "tissue", 1), (2, "tissue", 1), (4, "tissue", 0)]
    assert map_fields(df.limit(0), canon, ["tissue"]).count() == 0
    assert {r.term_id for r in map_fields(df, canon.limit(0), ["tissue"]).collect()} == {0}


def test_slips_in_short_spellings_and_beside_digits(spark, canon):
    values = [("tissue", "rem", 1), ("tissue", "re", 1), ("stage", "12-yaer-old stage", 21), ("stage", "13-yaer-old stage", 0), ("stage", "3-mnoth-old stage", 22), ("stage", "2-month-old stgae", 0)]
    got = {(r.field_name, r.value): r.term_id for r in canonical(spark.createDataFrame([(f, v) for f, v, _ in values], "field_name string, value string"), canon).collect()}
    assert got == {(f, v): t for f, v, t in values}
