"""Queries of the general training-data problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import norm_key
from tessera.operators.orphans import orphans
from tessera.operators.snapshots import snapshot_changes
from tessera.operators.units import _NUM, _SEP, _UNIT_WORDS, DAYS, age_days, archive_units
from tessera.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Ages of donors in days."""
    return age_days(table(spark, folder, "sample_meta"), table(spark, folder, "sources")).select("meta_id", "age_days")


def p1_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Ages whose unit the identity contradicts (another unit fits what is known from elsewhere better) or leaves open."""
    ages = age_days(table(spark, folder, "sample_meta"), table(spark, folder, "sources")).where("fit IS NOT NULL")
    return ages.where((F.col("n_solutions") > 1) | (F.col("fit") != F.col("unit"))).select("meta_id", "unit", "fit", "n_solutions", F.round("residual", 6).alias("residual"))


def p1_archive_units(spark: SparkSession, folder: str) -> DataFrame:
    """The unit of each archive's bare ages, found from rows whose development stage also states the age."""
    return archive_units(table(spark, folder, "sample_meta")).select("source", F.get_json_object("units", "$.num").alias("unit"), F.round("residual", 6).alias("residual"), "n_rows", "unique")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records added, removed or changed between consecutive snapshots of two tables."""
    parts = []
    for name, keys, value in (("dataset_snapshots", ["source", "accession"], "verdict"), ("file_snapshots", ["url"], "dl_status")):
        parts.append(snapshot_changes(table(spark, folder, name), keys, [value]).select(F.lit(name).alias("table_name"), "snap_date", "record_key", "change_kind"))
    return parts[0].unionByName(parts[1])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """References to records that do not exist at the end of the row's period."""
    datasets, files = table(spark, folder, "datasets"), table(spark, folder, "files")
    curated = table(spark, folder, "candidates").where(norm_key(F.col("status")) == "curated")
    deposit = ["source", "accession"]
    parts = [
        ("files", orphans(files, "file_id", deposit, "loaded_at", datasets, deposit, "loaded_at", "removed_at")),
        ("candidates", orphans(curated, "cand_id", deposit, "loaded_at", datasets, deposit, "loaded_at", "removed_at")),
        ("sample_meta", orphans(table(spark, folder, "sample_meta"), "meta_id", [*deposit, "sample_id"], "loaded_at", files, [*deposit, "sample_id"], "loaded_at")),
    ]
    out = [df.select(F.lit(name).alias("table_name"), "row_id", "period") for name, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references counted per table and period."""
    return p4_found(spark, folder).groupBy("table_name", "period").agg(F.count("*").alias("orphans"))


QUERIES = {f.__name__: f for f in (p1_found, p1_flags, p1_archive_units, p2_found, p4_found, p4_report)}

_KEY = "lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))"


def _k(c: str) -> str:
    return _KEY.format(c)


def _changes_sql(name: str, key: str, shown: str, value: str) -> str:
    return f"""
    SELECT '{name}' AS table_name, snap_date, record_key, change_kind FROM (
      WITH last AS (SELECT snap_date, max(delivered_at) AS delivered_at, row_number() OVER (ORDER BY snap_date) AS n FROM {name} WHERE snap_date IS NOT NULL GROUP BY snap_date),
      rows AS (
        SELECT l.n, {key} AS k, min({shown}) AS shown, arg_max(coalesce({_k(value)}, '<null>'), updated) AS v
        FROM {name} t JOIN last l ON t.snap_date = l.snap_date AND t.delivered_at = l.delivered_at WHERE {key} IS NOT NULL GROUP BY 1, 2)
      SELECT l.snap_date, coalesce(b.shown, a.shown) AS record_key,
        CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
      FROM rows a FULL JOIN rows b ON a.k = b.k AND a.n + 1 = b.n JOIN last l ON l.n = coalesce(b.n, a.n + 1)
      WHERE l.n > 1 AND (a.k IS NULL OR b.k IS NULL OR a.v <> b.v))"""


def _orphans_sql(name: str, row_id: str, keys: list[str], parent: str, removed: str, where: str = "true") -> str:
    ref = " || chr(1) || ".join(_k(f"r.{k}") for k in keys)
    par = " || chr(1) || ".join(_k(k) for k in keys)
    return f"""
    SELECT '{name}' AS table_name, row_id, period FROM (
      WITH r AS (SELECT r.{row_id} AS row_id, {ref} AS k, date_trunc('month', r.loaded_at) + INTERVAL 1 MONTH AS ends, strftime(r.loaded_at, '%Y-%m') AS period FROM {name} r WHERE {where}),
      p AS (SELECT {par} AS k, loaded_at AS a, {removed} AS b FROM {parent})
      SELECT row_id, period FROM r WHERE k IS NOT NULL AND ends IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.k = r.k AND p.a < r.ends AND (p.b IS NULL OR p.b >= r.ends)))"""


def _archive_units_sql() -> str:
    words = "|".join(_UNIT_WORDS.values())
    unit = lambda c: "CASE " + " ".join(f"WHEN regexp_matches({c}, '^([0-9]+ ?)?({w})([^a-zà-ÿ0-9]|$)') THEN '{u}'" for u, w in _UNIT_WORDS.items()) + " END"
    named = _k("coalesce(age_unit, '')")
    plain = f"'{_NUM}{_SEP}({words})([^a-zà-ÿ]|$)'"
    days = "CASE u " + " ".join(f"WHEN '{u}' THEN {d}" for u, d in DAYS.items()) + " END"
    tried = ", ".join(f"avg(abs(ln(num * {d}) - ln(known))) AS r_{u}" for u, d in DAYS.items() if u != "decade")
    listed = ", ".join(f"{{'r': r_{u}, 'u': '{u}'}}" for u in DAYS if u != "decade")
    return f"""WITH s AS (SELECT {_k('source')} AS source, age_num AS num, replace(regexp_extract(lower(development_stage), {plain}, 1), ',', '.') AS n, regexp_extract(lower(development_stage), {plain}, 2) AS w
        FROM sample_meta WHERE age_num > 0 AND NOT isnan(age_num) AND source IS NOT NULL AND ({unit(named)}) IS NULL),
      k AS (SELECT source, num, TRY_CAST(n AS DOUBLE) * {days} AS known FROM (SELECT *, {unit('w')} AS u FROM s)),
      g AS (SELECT source, count(*) AS n_rows, {tried} FROM k WHERE known > 0 GROUP BY 1),
      l AS (SELECT source, n_rows, list_sort([{listed}]) AS l FROM g)
      SELECT source, l[1].u AS unit, round(l[1].r, 6) AS residual, n_rows, l[2].r > l[1].r + 0.05 AS "unique" FROM l"""


_DEPOSIT = ["source", "accession"]
_P4 = " UNION ALL ".join(
    (
        _orphans_sql("files", "file_id", _DEPOSIT, "datasets", "removed_at"),
        _orphans_sql("candidates", "cand_id", _DEPOSIT, "datasets", "removed_at", f"{_k('r.status')} = 'curated'"),
        _orphans_sql("sample_meta", "meta_id", [*_DEPOSIT, "sample_id"], "files", "CAST(NULL AS TIMESTAMP)"),
    )
)
SQL = {
    "p1_archive_units": _archive_units_sql(),
    "p2_found": _changes_sql("dataset_snapshots", f"{_k('source')} || chr(1) || {_k('accession')}", "trim(source) || '|' || trim(accession)", "verdict")
    + " UNION ALL "
    + _changes_sql("file_snapshots", _k("url"), "trim(url)", "dl_status"),
    "p4_found": _P4,
    "p4_report": f"SELECT table_name, period, count(*) AS orphans FROM ({_P4}) GROUP BY 1, 2",
}
