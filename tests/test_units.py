import math

import pytest
from pyspark.sql import functions as F

from tessera.operators.units import age_days, archive_defaults, group_units, resolve_units, unit_of, units_in_notes, with_age

META = "meta_id bigint, source string, age_num double, age_unit string, evidence string, development_stage string, name string"
SOURCES = [("GEO", None), ("Months", "Form asks for months, so an age without unit is in months."), (None, "ages in weeks")]


def ages(spark, rows, sources=SOURCES):
    meta = spark.createDataFrame([(i, *r, *[None] * (5 - len(r)), "clash") for i, r in enumerate(rows)], META)
    src = spark.createDataFrame(sources, "name string, notes string")
    return {r.meta_id: r.age_days for r in age_days(meta, src).collect()}


def judged(spark, rows):
    meta = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], META)
    return {r.meta_id: (r.unit, r.fit, r.n_solutions) for r in age_days(meta, spark.createDataFrame(SOURCES, "name string, notes string")).collect()}


@pytest.mark.parametrize(
    "text,unit",
    [("Years", "year"), (" y.o. ", "year"), ("yo", "year"), ("año", "year"), ("años", "year"), ("Jahre", "year"), ("mois", "month"), ("mth", "month"), ("month(s)", "month"), ("PCW", "week"), ("gestational weeks", "week"), ("Wochen", "week"), ("dpc", "day"), ("d post natal", "day"), ("Tage", "day"), ("x10 years", "decade"), ("unit?", None), ("", None), (None, None), ("wizard", None)],
)
def test_unit_names(spark, text, unit):
    assert spark.range(1).select(unit_of(F.lit(text).cast("string"))).first()[0] == unit


@pytest.mark.parametrize(
    "text,days",
    [
        ("aged 12 years", 4383), ("aged 2 years 3 months", 730.5 + 91.3125), ("14 years and 3 months old at biopsy", 14 * 365.25 + 91.3125), ("age 5 y 4 mo", 5 * 365.25 + 4 * 30.4375),
        ("ages 40–60 y", 50 * 365.25), ("between 70 and 79 years of age", 74.5 * 365.25), ("donor in their 40s", 45 * 365.25), ("patient in fifties", 55 * 365.25), ("in the seventh decade of life", 65 * 365.25),
        ("PCW29", 203), ("PCW 9 embryo", 63), ("title carries GW19", 133), ("34 wpc", 238), ("age at death 12,5 post-conception weeks", 87.5), ("a donor twenty-five years old", 25 * 365.25), ("aged ten years", 3652.5),
        ("host mouse 3 weeks old", None), ("mother was 30 years old; page text checked", None), ("relapse after 3 years", None), ("8 y disease duration", None), ("block archived 14 years ago", None), ("", None), (None, None),
        ("mother was 30 years old, age 3 years", 3 * 365.25), ("title says '66-year-old donor'", 66 * 365.25), ("donor was 7mo", 7 * 30.4375),
    ],
)
def test_ages_in_words(spark, text, days):
    got = with_age(spark.range(1), F.lit(text).cast("string"), "a").select("a.days").first()[0]
    assert got == days if days is None else math.isclose(got, days)


def test_unit_precedence_and_bounds(spark):
    got = ages(
        spark,
        [
            ("geo", 2.0, "weeks", "age 2 years"),  # the named unit
            (" GEO ", 2.0, "unknown", "age: 2 years"),  # the unit in evidence
            ("months", 2.0, None, "mother was 30 years old"),  # the archive's
            ("GEO", 2.0, None, None),  # none: no age
            ("GEO", None, "year", "aged 3 months"),
            ("GEO", -1.0, "year", None),
            ("GEO", 120.0, "year", None),
            ("GEO", 120.5, "year", None),
            ("GEO", 0.0, "day", None),
            ("GEO", float("nan"), None, "age 1 years"),
            ("GEO", 64.0, "", "age 5 y 4 mo"),  # least residual: months
            (None, 3.0, "d", ""),
            ("GEO", 0.5, "day", None),  # halves up
        ],
    )
    assert got == {0: 14, 1: 731, 2: 61, 4: 91, 6: 43830, 8: 0, 9: 365, 10: 1948, 11: 3, 12: 1}


def test_empty_and_repeated(spark):
    assert ages(spark, []) == {}
    assert ages(spark, [("GEO", 1.0, "d", None)] * 3) == {0: 1, 1: 1, 2: 1}
    assert ages(spark, [("GEO", 1.0, "d", None)], []) == {0: 1}


def test_a_null_archive_is_none(spark):
    assert ages(spark, [(None, 3.0, None, None), ("", 3.0, None, None)], [("", "ages in weeks"), (None, "ages in days")]) == {1: 21}


def test_notes(spark):
    for note, units in (("a bare age number there counts years.", ["year"]), ("Age column of the export = days since birth (unit left off).", ["day"]), ("Submitters fill the age box in weeks; the box shows no unit.", ["week"]), ("ages come monthly, once a month, in weeks", ["week", "month"]), ("updated every month", None), (None, None)):
        assert spark.range(1).select(units_in_notes(F.lit(note).cast("string"))).first()[0] == units


def test_the_unit_of_an_archive_by_its_own_rows(spark):
    notes = spark.createDataFrame([("A", "ages in months, updated every week"), ("B", "ages in months, updated every week"), ("C", "ages: years"), ("D", "no word")], "name string, notes string")
    rows = [("a", 7.0, None, None, "7-month-old stage"), ("A ", 30.0, "unknown", None, "30-month-old stage"), ("a", 3.0, "week", None, "9-year-old stage"), ("c", 24.0, None, None, "2-year-old stage"), ("d", 2.0, None, None, "2-year-old stage")]
    meta = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], META)
    # by its rows; by the last word; by its only word, whatever its rows say; by nothing
    assert {r.source: r.unit for r in archive_defaults(meta, notes).collect()} == {"a": "month", "b": "week", "c": "year"}


def test_contradictions_and_open_cases_are_flagged(spark):
    got = judged(
        spark,
        [
            ("GEO", 24.0, None, "aged 2 years", None),  # the unit written there; 24 months would fit
            ("GEO", 30.0, "week", None, "30-year-old stage"),  # the named unit; years would fit
            ("GEO", 2.0, "y", "aged 2 years", "9-month-old stage"),
            ("GEO", 2.0, "y", None, "unknown"),
            ("GEO", None, None, "aged 2 years", None),
        ],
    )
    assert got == {0: ("year", "month", 1), 1: ("week", "year", 1), 2: ("year", "year", 1), 3: ("year", None, None), 4: ("year", None, None)}


def test_identity_mass_density_volume(spark):
    # 5000 g = 2 kg/l * 2.5 l
    df = spark.createDataFrame([(5000.0, 2.0, 2.5), (5.0, 2.0, 2.5), (None, 2.0, 2.5), (-1.0, 2.0, 2.5)], "m double, d double, v double")
    c = lambda *p: F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(f).alias("factor")) for u, f in p])
    out = resolve_units(df, {"m": (F.col("m"), c(("g", 0.001), ("kg", 1.0)), 1.0), "d": (F.col("d"), c(("kg/l", 1.0)), -1.0), "v": (F.col("v"), c(("l", 1.0), ("ml", 0.001)), -1.0)}).collect()
    assert out[0].units.m == "g" and out[0].units.v == "l" and out[2].units is None
    assert [r.n_solutions for r in out] == [1, 2, 0, 0]  # 5 kg of 2.5 l, or 5 g of 2.5 ml
    twin = resolve_units(df.limit(1), {"m": (F.col("m"), c(("g", 0.001), ("gram", 0.001)), 1.0), "d": (F.col("d"), c(("x", 1.0)), -1.0), "v": (F.col("v"), c(("l", 1.0)), -1.0)}).first()
    assert twin.n_solutions == 2


def test_group_units(spark):
    rows = [("a", 2.0, 14.0), ("a", 3.0, 21.0), ("b", 1.0, 365.0), ("b", None, 3.0), ("c", 0.0, 1.0)]
    out = {r.g: (r.units, r.unique) for r in group_units(spark.createDataFrame(rows, "g string, x double, k double"), ["g"], {"x": (F.col("x"), {"week": 7.0, "year": 365.25}, 1.0), "k": (F.col("k"), {"day": 1.0}, -1.0)}).collect()}
    assert set(out) == {"a", "b"} and '"week"' in out["a"][0] and '"year"' in out["b"][0] and out["a"][1]
