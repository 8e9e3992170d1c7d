"""Free-entered values mapped to a canonical list. Built-in SQL functions only.

Reference strings are cut into k + 1 segments; a value within k edits holds one of them, shifted by k places at most
(pigeonhole). So candidates come from an equality join on positional substrings, and ``levenshtein`` verifies them.
Values that nothing matches are reported through an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import stated
from tessera.session import persisted, small

K = 2
#: A shorter reference string has an empty segment, so it must be met exactly.
LEAST = K + 1

#: Words about the donor, the preparation or the piece, around an entry.
_PREFIX = r"(?:(?:human|adult|normal|fresh|frozen|healthy donor|biopsy of(?: the)?|sample of|section of|self[- ]identified(?: as)?|self[- ]reported) |(?:status|donor) ?: ?)"
_SUFFIX = r"(?:[ ,;]*\b(?:sample|section|tissue|specimen|biopsy|donor(?: ?#?\d+)?|patient|punch [a-z0-9]+|piece [a-z0-9]+|block [a-z0-9]+|descent|ancestry|origin|heritage))"
_ASIDE = r" *(?:\([^()]*\)|\[[^\[\]]*\])"
_YEARS = r"(?:years?|yrs?|y\.?/?o\.?|y)"
_MONTHS = r"(?:months?|mths?|mos?)"
_WEEKS = r"(?:post[- ]?(?:conception(?:al)?|fertili[sz]ation) weeks?|weeks? post[- ]?(?:conception|fertili[sz]ation)|wpc|pcw|gestational weeks?|weeks?)"


def plain(v: Column) -> Column:
    """Lower case, single spaces (underscores too), no outer space and no closing punctuation."""
    v = F.trim(F.regexp_replace(F.lower(v), r"(?U)[\s_]+", " "))
    return F.trim(F.regexp_replace(v, r"[ ;.,:!?]+$", ""))


def age_form(v: Column) -> Column:
    """An age or week in a fixed form ('12 year', '3 month', '9 week'), null for all else. ``v`` is ``plain``."""
    tail = r"(?:[- ]*old)?(?:[- ]*(?:human|infant|child|adult|donor|embryo|fetus))*(?: stage)?$"
    forms = []
    for unit, words in (("year", _YEARS), ("month", _MONTHS), ("week", _WEEKS)):
        after = rf"^(?:age[d:]? ?)?0*(\d+)(?:st|nd|rd|th)?[- ]*{words}(?: post[- ]?(?:conception|fertili[sz]ation))?{tail}"
        forms.append(F.when(v.rlike(after), F.concat(F.regexp_extract(v, after, 1), F.lit(f" {unit}"))))
    before = r"^(?:pcw|gw|week) ?0*(\d+)(?: post[- ]?(?:conception|fertili[sz]ation))?(?: stage| embryo| fetus)?$"
    forms.append(F.when(v.rlike(before), F.concat(F.regexp_extract(v, before, 1), F.lit(" week"))))
    return F.coalesce(*forms)


def forms(value: Column) -> Column:
    """Readings of a value, the least changed first: (rank, form)."""
    p = plain(value)
    bare = F.trim(F.regexp_replace(F.regexp_replace(p, _ASIDE, " "), " +", " "))
    cut = lambda v, pattern: F.trim(F.regexp_replace(v, pattern, ""))
    tail, head = cut(bare, f"{_SUFFIX}$"), cut(bare, f"^{_PREFIX}")
    both, core = cut(tail, f"^{_PREFIX}"), cut(cut(bare, f"{_SUFFIX}+$"), f"^{_PREFIX}+")
    turned = F.regexp_replace(core, r"^([^,]+), ([^,]+)$", "$2 $1")
    readings = (p, bare, tail, head, both, core, turned)
    ranked = F.array(*[F.struct(F.lit(i).alias("rank"), x.alias("form")) for i, x in enumerate(readings)])
    return F.filter(ranked, lambda x: F.length(x["form"]) > 0)


def reference(canon: DataFrame) -> DataFrame:
    """Spellings (field_name, spelling, kind, term_id) of every entry.

    kind 0: label and synonyms; 1: a label without the closing word 'stage', an age in fixed form, or a word cut to
    three letters or more and a full stop. A spelling that stands for several entries is left out of kind 1.
    """
    names = canon.select("field_name", "term_id", "label", F.concat(F.array("label"), F.coalesce(F.from_json("synonyms", "array<string>"), F.array().cast("array<string>"))).alias("all"))
    own = names.select("field_name", "term_id", F.explode("all").alias("s")).select("field_name", plain(F.col("s")).alias("spelling"), "term_id")
    own = own.where("length(spelling) > 0").groupBy("field_name", "spelling").agg(F.min("term_id").alias("term_id"))
    label = names.select("field_name", "term_id", plain(F.col("label")).alias("l"))
    short = label.where("l LIKE '% stage'").select("field_name", F.regexp_replace("l", " stage$", "").alias("spelling"), "term_id")
    ages = label.select("field_name", age_form(F.col("l")).alias("spelling"), "term_id").where("spelling IS NOT NULL")
    words = own.select("field_name", "term_id", F.split("spelling", " ").alias("w")).where("size(w) > 1").select("field_name", "term_id", "w", F.posexplode("w").alias("i", "word")).where("length(word) > 3")
    cut = words.select("field_name", "term_id", "w", "i", "word", F.explode(F.sequence(F.lit(3), F.length("word") - 1)).alias("n")).select(
        "field_name",
        F.expr("array_join(transform(w, (x, j) -> if(j = i, concat(substring(word, 1, n), if(j = size(w) - 1, '', '.')), x)), ' ')").alias("spelling"),
        "term_id",
    )
    more = short.unionByName(ages).unionByName(cut).groupBy("field_name", "spelling").agg(F.min("term_id").alias("term_id"), F.countDistinct("term_id").alias("n")).where("n = 1").drop("n")
    more = more.join(own, ["field_name", "spelling"], "left_anti")
    return own.withColumn("kind", F.lit(0)).unionByName(more.withColumn("kind", F.lit(1)))


def _cut(i: int, length: Column) -> tuple[Column, Column]:
    """Start and length of segment ``i`` of k + 1 nearly equal ones."""
    n = K + 1
    start = F.floor(length * i / n).cast("int")
    return start + 1, F.floor(length * (i + 1) / n).cast("int") - start


def near_pairs(values: DataFrame, refs: DataFrame) -> DataFrame:
    """Pairs (field_name, form, term_id, spelling, d) within one slip: an edit, or two letters exchanged (d = 1), no digit."""
    index = [refs.select("field_name", "spelling", "term_id", F.length("spelling").alias("len"), F.lit(i).alias("i"), F.substring(F.col("spelling"), *_cut(i, F.length("spelling"))).alias("seg")) for i in range(K + 1)]
    segs = index[0].unionByName(index[1]).unionByName(index[2])
    size = F.length("form")
    probes = values.select("field_name", "form", F.explode(F.sequence(size - K, size + K)).alias("len")).where(F.col("len") >= LEAST)
    made = F.flatten(F.array(*[_probe(i) for i in range(K + 1)]))
    probes = probes.select("field_name", "form", "len", F.explode(made).alias("x")).select("field_name", "form", "len", "x.i", "x.seg")
    pairs = probes.join(small(segs), ["field_name", "len", "i", "seg"]).select("field_name", "form", "spelling", "term_id").distinct()
    edits = F.levenshtein("form", "spelling", K)
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    swapped = (edits == 2) & (F.length("form") == F.length("spelling")) & (letters("form") == letters("spelling"))
    number = lambda c: F.regexp_replace(c, r"\D", "")
    # another number is no slip: '12-year-old' is not '13-year-old'
    return pairs.where(((edits == 1) | swapped) & (number("form") == number("spelling"))).withColumn("d", F.lit(1))


def _probe(i: int) -> Column:
    start, n = _cut(i, F.col("len"))
    shifts = [F.struct(F.lit(i).alias("i"), F.substring(F.col("form"), start + s, n).alias("seg"), (start + s).alias("at")) for s in range(-K, K + 1)]
    return F.filter(F.array(*shifts), lambda x: x["at"] >= 1)


def canonical(values: DataFrame, canon: DataFrame) -> DataFrame:
    """For different (field_name, value) rows the entry meant: (field_name, value, term_id), 0 if the list has none.

    Readings of a value are tried from the least changed to the most; a reading that is a spelling of the list wins
    over one that is a slip away. Of several entries one slip away, those with the value's first letter come first,
    then the smallest term_id. The list's spellings are broadcast if they are counted to be few. Null and blank values are not expected (see ``map_fields``); they map to 0.
    """
    refs = persisted(reference(canon), "canon-spellings")
    readings = values.select("field_name", "value", F.explode(forms(F.col("value"))).alias("x")).select("field_name", "value", "x.rank", "x.form")
    ages = readings.select("field_name", "value", F.lit(0).alias("rank"), age_form(F.col("form")).alias("form")).where("form IS NOT NULL")
    readings = persisted(readings.unionByName(ages).distinct(), "canon-readings")
    exact = readings.join(small(refs.withColumnRenamed("spelling", "form")), ["field_name", "form"]).select("field_name", "value", "term_id", F.struct(F.lit(0).alias("d"), "kind", "rank", F.lit(0).alias("other"), "term_id").alias("k"))
    hit = persisted(exact.groupBy("field_name", "value").agg(F.min("k").alias("k")), "canon-exact")
    rest = readings.join(hit, ["field_name", "value"], "left_anti")
    pairs = near_pairs(rest.select("field_name", "form").distinct(), refs.where(F.col("kind") == 0).where(F.length("spelling") >= LEAST))
    near = rest.join(pairs, ["field_name", "form"]).select(
        "field_name", "value", F.struct("d", F.lit(0).alias("kind"), "rank", (F.substring("form", 1, 1) != F.substring("spelling", 1, 1)).cast("int").alias("other"), "term_id").alias("k")
    )
    found = hit.unionByName(near.groupBy("field_name", "value").agg(F.min("k").alias("k"))).select("field_name", "value", F.col("k.term_id").alias("term_id"))
    none = values.select("field_name", "value").join(found, ["field_name", "value"], "left_anti").withColumn("term_id", F.lit(0).cast("bigint"))
    return found.unionByName(none)


def map_fields(rows: DataFrame, canon: DataFrame, fields: list[str], row_id: str = "meta_id", heavy_share: float = 1 / 256) -> DataFrame:
    """Rows (row_id, field_name, term_id) of every stated value that is not, byte by byte, a label of its field.

    Null, blank and 'not stated' values give no rows; repeated rows give one each. Values are made different before
    anything is matched. Back on the rows, values that make up at least ``heavy_share`` of all (so at most its
    reciprocal many) are broadcast, and the others are joined by value; no value gathers its rows in one task.
    """
    long = rows.select(F.col(row_id).alias("_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("_id", "x.*").where(stated(F.col("value")))
    labels = canon.select("field_name", F.col("label").alias("value")).distinct()
    long = long.join(small(labels), ["field_name", "value"], "left_anti")
    counted = persisted(long.groupBy("field_name", "value").agg(F.count("*").alias("n")), "canon-values")
    mapped = persisted(canonical(counted, canon).join(counted, ["field_name", "value"]), "canon-mapped")
    total = mapped.agg(F.sum("n")).first()[0] or 0
    heavy = mapped.where(F.col("n") >= total * heavy_share).select("field_name", "value", F.col("term_id").alias("h_term"))
    light = mapped.where(F.col("n") < total * heavy_share).select("field_name", F.col("value").alias("key"), "term_id")
    out = long.join(F.broadcast(heavy), ["field_name", "value"], "left")
    # a row that is done takes a key of its own, so that it meets no hot partition
    out = out.withColumn("key", F.when(F.col("h_term").isNull(), F.col("value")).otherwise(F.concat(F.lit("\u0000"), F.col("_id").cast("string"))))
    return out.join(light, ["field_name", "key"], "left").select(F.col("_id").alias(row_id), "field_name", F.coalesce("h_term", "term_id").alias("term_id"))
