"""Quantities recorded in different units, brought to one unit.

Physical identities among columns (say, an amount in one column equals the same amount in another, or mass equals
density times volume) are linear in the logarithms of values and unit factors. For every row the combination of
candidate units with the least log residual is chosen; a second combination within tolerance makes it non-unique.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import norm_key, stated
from tessera.session import small

#: Days of each unit of age.
DAYS = {"day": 1.0, "week": 7.0, "month": 30.4375, "year": 365.25, "decade": 3652.5}
MAX_AGE_DAYS = 120 * 365.25


def resolve_units(df: DataFrame, terms: dict[str, tuple[Column, Column, float]], const: Column | float = 0.0, tolerance: float = 1e-6, levels: bool = False) -> DataFrame:
    """Choose units for the identity ``sum(power * ln(value * factor)) = const`` row by row.

    ``terms``: name -> (value, array of candidate structs ``unit, factor``, power). Adds ``units`` (a struct of the
    chosen unit per name), ``residual``, ``fit`` (the struct of the least residual of all) and ``n_solutions``
    (combinations within ``tolerance`` of that). With ``levels`` candidates are structs ``unit, factor, level``: a
    combination of a lower sum of levels is chosen before one of a higher, whatever their residuals; then ``fit``
    tells what the identity alone would choose. The combinations of a row are a product of the few candidates of
    each term, made inside the row. A row with a null or non-positive value, or no candidates for a term, gets null
    and 0. Everything stays in the JVM.
    """
    target = const if isinstance(const, Column) else F.lit(const)
    out = df.withColumns({"_target": target, **{f"_log{i}": F.ln(F.when(value > 0, value)) for i, (value, _, _) in enumerate(terms.values())}})
    combos = None
    for i, (_, cands, power) in enumerate(terms.values()):
        combos = _extended(combos, F.col(f"_log{i}"), cands, power, levels)
    scored = F.transform(combos, lambda c: F.struct(c["level"].alias("level"), F.abs(c["r"] - F.col("_target")).alias("r"), c["u"].alias("u")))
    known = F.col("_target").isNotNull()
    for i in range(len(terms)):
        known &= F.col(f"_log{i}").isNotNull()
    out = out.withColumn("_scored", F.when(known, scored)).drop("_target", *[f"_log{i}" for i in range(len(terms))])
    out = out.withColumns({"_best": F.array_min("_scored"), "_fit": F.array_min(F.transform("_scored", lambda c: F.struct(c["r"].alias("r"), c["u"].alias("u"))))})
    named = lambda c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(c)["u"][i].alias(n) for i, n in enumerate(terms)]))
    near = F.filter("_scored", lambda c: c["r"] <= F.col("_fit")["r"] + tolerance)
    return out.withColumns({"units": named("_best"), "residual": F.col("_best.r"), "fit": named("_fit"), "n_solutions": F.when(F.col("_best").isNull(), 0).otherwise(F.size(near))}).drop("_scored", "_best", "_fit")


def _extended(combos: Column | None, log: Column, cands: Column, power: float, levels: bool) -> Column:
    """Every combination so far with every candidate of one more term."""
    level = (lambda c: c["level"]) if levels else (lambda c: F.lit(0))
    step = F.transform(cands, lambda c: F.struct((F.lit(power) * (log + F.ln(c["factor"]))).alias("r"), level(c).alias("level"), F.array(c["unit"]).alias("u")))
    if combos is None:
        return step
    both = lambda a: F.transform(step, lambda b: F.struct((a["r"] + b["r"]).alias("r"), (a["level"] + b["level"]).alias("level"), F.concat(a["u"], b["u"]).alias("u")))
    return F.flatten(F.transform(combos, both))


def group_units(df: DataFrame, groups: list[str], terms: dict[str, tuple[Column, dict[str, float], float]], const: float = 0.0, tolerance: float = 0.05) -> DataFrame:
    """Choose one combination of units per group (say, per archive) by the mean absolute log residual of its rows.

    ``terms``: name -> (value, unit -> factor, power). Returns the groups with ``units`` (JSON), ``residual``,
    ``n_rows``, ``unique`` (false means that another combination fits as well within ``tolerance``) and ``residuals``, an
    array of all combinations (r, u).
    All combinations are columns of one aggregation, so a row is read once and a large group is combined map-side.
    """
    combos: list[tuple[dict[str, str], Column]] = [({}, F.lit(0.0))]
    for name, (value, factors, power) in terms.items():
        log = F.ln(F.when(value > 0, value))
        combos = [({**u, name: unit}, r + F.lit(power) * (log + F.ln(F.lit(f)))) for u, r in combos for unit, f in factors.items()]
    aggs = [F.avg(F.abs(r - F.lit(const))).alias(f"_r{i}") for i, (_, r) in enumerate(combos)]
    out = df.groupBy(*groups).agg(F.count(combos[0][1]).alias("n_rows"), *aggs)
    ranked = F.array_sort(F.filter(F.array(*[F.struct(F.col(f"_r{i}").alias("r"), F.lit(json.dumps(u)).alias("u")) for i, (u, _) in enumerate(combos)]), lambda x: x["r"].isNotNull()))
    out = out.withColumn("_ranked", ranked).where(F.size("_ranked") > 0)
    second = F.try_element_at("_ranked", F.lit(2))
    return out.select(*groups, F.col("_ranked")[0]["u"].alias("units"), F.col("_ranked")[0]["r"].alias("residual"), "n_rows", (second.isNull() | (second["r"] > F.col("_ranked")[0]["r"] + tolerance)).alias("unique"), F.col("_ranked").alias("residuals"))


# ---- ages ----------------------------------------------------------------------------------------------------

#: Unit words of several languages, tried in this order; each must stand at the start of what is left of the text.
_UNIT_WORDS = {
    "decade": r"decades?|x ?10 ?years?|dekaden?|décadas?|décennies?",
    "month": r"months?(?:\(s\))?|mths?|mos?|mois|monate?n?|mes(?:es)?",
    "week": r"weeks?(?:\(s\))?|wks?|w|pcw|wpc|gw|wochen?|semaines?|semanas?|gestational weeks?|post[- ]conception(?:al)? weeks?",
    "day": r"days?(?:\(s\))?|dpc|dpn|d|tage?n?|jours?|d[ií]as?",
    "year": r"years?(?:\(s\))?|yrs?|y\.?/?o\.?|y|ans?|ann[ée]es?|años?|jahre?n?",
}
_ONES = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
_DECADES = "twenties thirties forties fifties sixties seventies eighties nineties".split()
#: What a duration that is not the donor's age is about.
_OTHER = r"\b(?:mouse|mice|rat|host|animal|mother|father|parent|sibling|antibody|lot|reagent|block|stored|archived|fixed|cultured?|passage|follow-up|relapse|therapy|treatment|treated|injury|disease|duration|biopsy \d|after|ago|for \d)\b"
#: What tells that a number is an age.
_CUE = r"(?:^|\W)(?:ages?|aged|age[_ ]at[_ ]\w+|donor|patient|subject|stated as|title (?:says|carries)|pcw|gw|wpc|embryo|fetus|decade of life|of age|old)(?:\W|\d|$)"
_NUM = r"(\d+(?:[.,]\d+)?)"
_ANY_UNIT = "(" + "|".join(_UNIT_WORDS.values()) + r")(?![a-zà-ÿ])"


def unit_of(text: Column) -> Column:
    """The unit (a key of ``DAYS``) that a short text names, null if none."""
    t = F.regexp_replace(norm_key(text), r"\s+", " ")
    tests = [F.when(t.rlike(rf"^(?:\d+ ?)?(?:{words})(?![a-zà-ÿ0-9])"), unit) for unit, words in _UNIT_WORDS.items()]
    return F.coalesce(*tests)


def _number(c: Column) -> Column:
    return F.regexp_replace(c, ",", ".").try_cast("double")


def digits_for_words(text: Column) -> Column:
    """Number words from one to ninety-nine as digits, and words for decades as '40s' (lower-case text)."""
    words = "|".join([*_ONES, *_TENS, *_DECADES, *(f"{w} decade" for w in _ORDINALS)])
    return F.when(text.rlike(rf"\b(?:{words})\b"), _replaced(text)).otherwise(text)


def _replaced(c: Column) -> Column:
    for i, w in enumerate(_DECADES):
        c = F.regexp_replace(c, rf"\b{w}\b", f"{20 + 10 * i}s")
    for i, w in enumerate(_TENS):
        ones = F.regexp_replace(c, rf"\b{w}[- ](?=(?:{'|'.join(_ONES[:9])})\b)", f"{i + 2}~")
        c = F.regexp_replace(ones, rf"\b{w}\b", f"{20 + 10 * i}")
    for i, w in enumerate(_ONES):
        if i < 9:
            c = F.regexp_replace(c, rf"~{w}\b", str(i + 1))
        c = F.regexp_replace(c, rf"\b{w}\b", str(i + 1))
    for i, w in enumerate(_ORDINALS):
        c = F.regexp_replace(c, rf"\b{w}(?= decade)", f"{i + 1}th")
    return c


_SEP = r"[ -]*"
#: Known forms of a stated age, tried in this order: pattern, and its groups of (number, second number, unit word).
_FORMS = {
    "pair": (rf"{_NUM}{_SEP}(?:years?|yrs?|y)\W+(?:and )?{_NUM}{_SEP}(?:months?|mos?|mths?)\b", (1, 2, 0)),
    "span": (rf"{_NUM}\s*(?:-|–|—|to|and)\s*{_NUM}{_SEP}{_ANY_UNIT}", (1, 2, 3)),
    "nth": (r"(\d+)(?:st|nd|rd|th) decade", (1, 0, 0)),
    "tens": (r"\b(\d+0)'?s\b", (1, 0, 0)),
    "lead": (rf"\b(pcw|gw)\s*{_NUM}", (2, 0, 1)),
    "plain": (rf"{_NUM}{_SEP}{_ANY_UNIT}", (1, 0, 2)),
    "bare": (rf"\bage[sd]?(?:[_ ]at[_ ]\w+)?[:= ]+{_NUM}\s*$", (1, 0, 0)),
}


def _form(t: Column) -> Column:
    """Struct (form, a, b, word) of the first known form that a clause has; null if it has none."""
    found = None
    for name, (pattern, groups) in _FORMS.items():
        parts = [F.regexp_extract(t, pattern, i) if i else F.lit("") for i in groups]
        hit = F.struct(F.lit(name).alias("form"), *[x.alias(n) for x, n in zip(parts, ("a", "b", "word"))])
        found = F.when(t.rlike(pattern), hit) if found is None else found.when(t.rlike(pattern), hit)
    return found


def with_age(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with a struct ``name`` (days, value, unit, unit2) of the first age of the donor that a text states.

    Forms are a number and a unit, years and months, a range (its midpoint), a decade (its middle), weeks after
    conception, a decimal comma, number words. ``unit2`` is the lesser unit of 'years and months'; ``days`` is null
    where no unit is written; other durations do not count. Each step is a projection of its own, so that no pattern
    is matched twice.
    """
    low = F.lower(text)
    clauses = F.split(digits_for_words(low), r"\s*(?:;|\||\n)\s*|[.,]\s+")
    about = F.filter(clauses, lambda c: c.rlike(_CUE) & ~c.rlike(_OTHER))
    # a clause with a cue makes a text with one
    out = df.withColumn("_form", F.when(low.rlike(_CUE), F.try_element_at(F.filter(F.transform(about, _form), lambda a: a.isNotNull()), F.lit(1))))
    form = F.col("_form.form")
    out = out.withColumns({"_a": _number(F.col("_form.a")), "_b": _number(F.col("_form.b")), "_unit": F.when(form.isin("span", "lead", "plain"), unit_of(F.col("_form.word"))).when(form.isin("pair", "nth", "tens"), "year")})
    a, b = F.col("_a"), F.col("_b")
    value = F.when(form == "span", (a + b) / 2).when(form == "nth", a * 10 - 5).when(form == "tens", a + 5).otherwise(a)
    days = F.when(form == "pair", a * DAYS["year"] + b * DAYS["month"]).otherwise(value * days_of(F.col("_unit")))
    age = F.struct(days.alias("days"), value.alias("value"), F.col("_unit").alias("unit"), F.when(form == "pair", "month").alias("unit2"))
    return out.withColumn(name, F.when(form.isNotNull(), age)).drop("_form", "_a", "_b", "_unit")


def with_stage_days(df: DataFrame, stage: Column, name: str) -> DataFrame:
    """``df`` with the days that a development stage states ('7-month-old stage', 'age 34 years'), null if none."""
    pattern, (n, _, word) = _FORMS["plain"]
    low = F.lower(stage)
    out = df.withColumns({"_n": _number(F.regexp_extract(low, pattern, n)), "_unit": F.regexp_extract(low, pattern, word)})
    return out.withColumn("_unit", unit_of(F.col("_unit"))).withColumn(name, F.col("_n") * days_of(F.col("_unit"))).drop("_n", "_unit")


def days_of(unit: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in DAYS.items() for x in pair]), unit)


def units_in_notes(notes: Column) -> Column:
    """The units (array, the last one first) that an archive's notes name, if they speak of ages; else null."""
    words = "|".join(f"(?:{w})" for w in ("decades?", "months?", "weeks?", "days?", "years?"))
    found = F.regexp_extract_all(F.lower(notes), F.lit(rf"\b({words})\b"), F.lit(1))
    return F.when(F.lower(notes).rlike(r"\bages?\b"), F.filter(F.transform(F.reverse(found), unit_of), lambda u: u.isNotNull()))


def bare_ages(meta: DataFrame) -> DataFrame:
    """Rows (source, num, known) with a number, no named unit and an age that the development stage states."""
    df = meta.where((F.col("age_num") > 0) & ~F.isnan("age_num")).select(norm_key(F.col("source")).alias("source"), F.col("age_num").cast("double").alias("num"), "age_unit", "development_stage")
    df = df.where(unit_of(F.coalesce("age_unit", F.lit(""))).isNull())
    return with_stage_days(df, F.col("development_stage"), "known").where("source IS NOT NULL AND known > 0").select("source", "num", "known")


def archive_units(meta: DataFrame) -> DataFrame:
    """Per archive the unit of its bare ages (source, units, residual, n_rows, unique) by the identity "age_num x
    unit = age of the development stage", with the mean residual of every unit (``residuals``)."""
    ages = {u: d for u, d in DAYS.items() if u != "decade"}
    return group_units(bare_ages(meta), ["source"], {"num": (F.col("num"), ages, 1.0), "known": (F.col("known"), {"day": 1.0}, -1.0)})


def archive_defaults(meta: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (source, unit): of the units that an archive's notes name for its ages the one for which the archive's
    own rows leave the least residual; without such rows, or between equals, the one named last."""
    named = sources.select(norm_key(F.col("name")).alias("source"), F.posexplode(units_in_notes(F.col("notes"))).alias("at", "unit")).where("source IS NOT NULL")
    fits = archive_units(meta).select("source", F.explode("residuals").alias("x")).select("source", F.get_json_object("x.u", "$.num").alias("unit"), F.round("x.r", 6).alias("r"))
    best = F.min(F.struct(F.coalesce("r", F.lit(float("inf"))).alias("r"), "at", "unit"))
    return named.join(fits, ["source", "unit"], "left").groupBy("source").agg(best.alias("m")).select("source", "m.unit")


def age_days(meta: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (meta_id, age_days, unit, fit, n_solutions, residual): the donor's age in days for every stated age.

    Every unit is a candidate for ``age_num``. Those that ``age_unit`` names come before those written with the age
    in ``evidence``, these before the archive's (``archive_defaults``), and any other is never taken; within a level
    the identity "age_num x unit = the age in evidence, else that of the development stage" decides by its log
    residual. ``fit`` is what the identity alone would choose, ``n_solutions`` how many units fit it equally well; both
    and ``residual`` are null where no age is known from elsewhere. A null or NaN ``age_num`` leaves the age in
    evidence. Negative ages and ages above 120 years are no ages, so the row is left out, as is a row without any
    age. Ages round half up. ``sources`` is a registry of one row per archive: it is broadcast if it is counted to be
    small, else joined by shuffle.
    """
    default = small(archive_defaults(meta, sources).select(F.col("source").alias("_src"), F.col("unit").alias("_default")))
    num = F.nanvl(F.col("age_num").cast("double"), F.lit(None).cast("double"))
    df = meta.select("meta_id", num.alias("num"), F.when(stated(F.col("age_unit")), unit_of(F.col("age_unit"))).alias("named"), norm_key(F.col("source")).alias("_src"), "evidence", "development_stage")
    df = with_stage_days(with_age(df, F.col("evidence"), "ev"), F.col("development_stage"), "stage").join(default, "_src", "left")
    level = lambda u: F.when(F.col("named") == u, 0).when((F.col("ev.unit") == u) | (F.col("ev.unit2") == u), 1).when(F.col("_default") == u, 2).otherwise(3)
    cands = F.array(*[F.struct(F.lit(u).alias("unit"), F.lit(d).alias("factor"), level(u).alias("level")) for u, d in DAYS.items()])
    value = F.when(F.col("num") > 0, F.col("num")).otherwise(F.lit(1.0))  # zero and below: the sign is judged later
    elsewhere = F.coalesce(F.when(F.col("ev.days") > 0, F.col("ev.days")), F.when(F.col("stage") > 0, F.col("stage")))
    df = df.withColumns({"elsewhere": elsewhere, "allowed": F.coalesce("named", "ev.unit", "_default")})
    df = resolve_units(df, {"num": (F.when(F.col("num").isNotNull(), value), cands, 1.0)}, const=F.ln(F.coalesce("elsewhere", value)), levels=True)
    ev_days = F.coalesce("ev.days", F.col("ev.value") * days_of(F.coalesce("named", "_default")))
    unit = F.when(F.col("num").isNotNull(), F.when(F.col("allowed").isNotNull(), F.col("units.num"))).otherwise(F.coalesce("ev.unit", "named", "_default"))
    df = df.withColumn("unit", unit).withColumn("d", F.round(F.when(F.col("num").isNotNull(), F.col("num") * days_of(F.col("unit"))).otherwise(ev_days), 6))
    told = lambda c: F.when((F.col("num") > 0) & F.col("elsewhere").isNotNull(), c)
    # the bounds as a filter of columns would be pushed down to the scan, with a copy of all patterns for each mention
    kept = F.explode(F.filter(F.array("d"), lambda x: x.between(0.0, MAX_AGE_DAYS))).alias("d")
    df = df.select("meta_id", "unit", told(F.col("fit.num")).alias("fit"), told(F.col("n_solutions")).alias("n_solutions"), told(F.col("residual")).alias("residual"), kept)
    return df.select("meta_id", F.floor(F.col("d") + 0.5).cast("bigint").alias("age_days"), "unit", "fit", "n_solutions", "residual")
