"""Queries of the text problems, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import encode
from tessera.llm.canon import map_fields
from tessera.llm.leaks import leaks
from tessera.llm.sentences import sentences
from tessera.llm.survivor import precedence, survivors, transitions
from tessera.llm.terms import after, base_state, last_month, marked, signed_terms, term_frequencies
from tessera.sources.tables import table


def p3_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Occurrences and records of every term of the format and role of files, with the mark."""
    return term_frequencies(table(spark, folder, "files"), "url", ["fmt", "role"], "loaded_at")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Terms that are too rare or too common."""
    return p3_terms(spark, folder).where("mark IS NOT NULL").select("field_name", "term", "mark")


def p3_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Terms after a batch: the last month's rows come, failed rows of before go, rows of before without a role get one."""
    rows = table(spark, folder, "files").select("url", "fmt", "role", "dl_status", "loaded_at")
    cut = last_month(rows, "loaded_at")
    failed = F.coalesce(F.col("dl_status") == "failed", F.lit(False))
    gone, changed = rows.where(~cut & failed), rows.where(~cut & ~failed & F.col("role").isNull())
    signed = lambda df, n: df.withColumn("sign", F.lit(n))
    batch = signed(rows.where(cut), 1).unionByName(signed(gone, -1)).unionByName(signed(changed, -1)).unionByName(signed(changed.withColumn("role", F.lit("none given")), 1))
    state = base_state(rows, ~cut, "url", ["fmt", "role"], "loaded_at")
    return marked(after(spark, state, signed_terms(batch, "url", ["fmt", "role"], sign=F.col("sign"))))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The entry of the reference list that each free value means."""
    fields = ["tissue", "disease_state", "self_reported_ethnicity", "development_stage"]
    return map_fields(table(spark, folder, "sample_meta"), table(spark, folder, "canon_terms"), fields)


def p5_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per field whose value means no entry of the list."""
    return p5_found(spark, folder).where("term_id = 0").groupBy("field_name").agg(F.count("*").alias("rows"))


SURVIVOR_FIELDS = ["title", "publication", "technology", "tissue", "disease", "n_samples", "verdict"]


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Survivor of each deposit: the topologically latest value where a row without a time precedes all with one."""
    return survivors(table(spark, folder, "datasets"), table(spark, folder, "sources"), SURVIVOR_FIELDS)


def p6_order(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered pairs of values of each field, implied by the transitions that timestamped rows show."""
    return precedence(transitions(table(spark, folder, "datasets"), "accession", "updated", SURVIVOR_FIELDS))


def p6_currency(spark: SparkSession, folder: str) -> DataFrame:
    """Survivor of each deposit where rows without a time are ordered by the learned transitions of values."""
    return survivors(table(spark, folder, "datasets"), table(spark, folder, "sources"), SURVIVOR_FIELDS, order=p6_order(spark, folder))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return encode(table(spark, folder, "documents"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold half of a test item, with the share that they hold."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Test items leaked into documents."""
    return p8_shares(spark, folder).select("item_id", "doc_id")


def p8_near(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold half of a test item with one edit in twenty letters allowed."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"), errors=1)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences of every document."""
    return sentences(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p3_terms, p3_found, p3_deltas, p5_found, p5_unmatched, p6_found, p6_order, p6_currency, p7_ids, p8_shares, p8_found, p8_near, p9_found)}

_TERMS_OF = """
  WITH rows AS ({0}),
  t AS (SELECT url, 'fmt' AS field_name, unnest(regexp_extract_all(lower(fmt), '[a-z0-9]+')) AS term FROM rows
        UNION ALL SELECT url, 'role', unnest(regexp_extract_all(lower(role), '[a-z0-9]+')) FROM rows),
  c AS (SELECT field_name, term, CAST(count(*) AS BIGINT) AS occurrences, count(DISTINCT url) AS records FROM t GROUP BY 1, 2)
  SELECT *, CASE WHEN records < 5 THEN 'rare' WHEN records > 0.2 * (SELECT count(DISTINCT url) FROM rows) THEN 'common' END AS mark FROM c"""
_TERMS = _TERMS_OF.format("SELECT url, fmt, role FROM files WHERE url IS NOT NULL")
_OLD = "coalesce(loaded_at < (SELECT date_trunc('month', max(loaded_at)) FROM files), true)"
_DELTAS = _TERMS_OF.format(f"SELECT url, fmt, CASE WHEN {_OLD} AND role IS NULL THEN 'none given' ELSE role END AS role FROM files WHERE url IS NOT NULL AND NOT ({_OLD} AND coalesce(dl_status = 'failed', false))")
_STATED = "lower(trim(CAST({0} AS VARCHAR))) NOT IN ('', 'unknown', 'n/a', 'na', 'none', 'nan', 'not reported') AND {0} IS NOT NULL"
_SURVIVOR = " UNION ALL ".join(
    f"""SELECT group_id, '{f}' AS field_name, rec_id FROM (
      SELECT min(d.rec_id) OVER w AS group_id, count(*) OVER w AS n, d.rec_id, {_STATED.format('d.' + f)} AS ok,
        row_number() OVER (PARTITION BY lower(trim(d.accession)), {_STATED.format('d.' + f)} ORDER BY coalesce(s.trust_rank, 1000000), d.updated DESC NULLS LAST, d.rec_id) AS r
      FROM datasets d LEFT JOIN sources s ON lower(trim(d.source)) = lower(trim(s.name)) WHERE d.accession IS NOT NULL
      WINDOW w AS (PARTITION BY lower(trim(d.accession)))) WHERE n >= 2 AND ok AND r = 1"""
    for f in SURVIVOR_FIELDS
)
_VALUES = " UNION ALL ".join(f"SELECT lower(trim(accession)) AS g, lower(trim(source)) AS s, rec_id, updated AS t, '{f}' AS field_name, CAST({f} AS VARCHAR) AS v FROM datasets WHERE accession IS NOT NULL AND {_STATED.format(f)}" for f in SURVIVOR_FIELDS)
_ORDER = f"""vals AS ({_VALUES}), seq AS (SELECT DISTINCT g, field_name, t, v FROM vals WHERE t IS NOT NULL),
  led AS (SELECT field_name, v AS older, lead(v) OVER w AS newer, t, lead(t) OVER w AS t2 FROM seq WINDOW w AS (PARTITION BY g, field_name ORDER BY t, v)),
  steps AS (SELECT field_name, older, newer, count(*) AS support FROM led WHERE t2 > t AND newer <> older GROUP BY 1, 2, 3),
  learned AS (SELECT a.* FROM steps a LEFT JOIN steps b ON a.field_name = b.field_name AND a.older = b.newer AND a.newer = b.older WHERE a.support >= 3 AND a.support > coalesce(b.support, 0)),
  reach AS (SELECT field_name, older, newer FROM learned UNION SELECT r.field_name, r.older, l.newer FROM reach r JOIN learned l ON r.field_name = l.field_name AND r.newer = l.older),
  ordered AS (SELECT * FROM reach a WHERE older <> newer AND NOT EXISTS (SELECT 1 FROM reach b WHERE b.field_name = a.field_name AND b.older = a.newer AND b.newer = a.older))"""
_CURRENCY = f"""WITH RECURSIVE {_ORDER},
  ranked AS (SELECT v.*, coalesce(s.trust_rank, 1000000) AS r FROM vals v LEFT JOIN sources s ON v.s = lower(trim(s.name))),
  top AS (SELECT * FROM ranked QUALIFY r = min(r) OVER (PARTITION BY g, field_name)),
  cand AS (SELECT * FROM top QUALIFY t IS NULL OR row_number() OVER (PARTITION BY g, field_name ORDER BY t DESC NULLS LAST, rec_id) = 1),
  free AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM ordered o JOIN cand x ON x.g = c.g AND x.field_name = c.field_name AND x.v = o.newer WHERE o.field_name = c.field_name AND o.older = c.v)),
  best AS (SELECT * FROM free QUALIFY row_number() OVER (PARTITION BY g, field_name ORDER BY t IS NULL, rec_id) = 1),
  grp AS (SELECT lower(trim(accession)) AS g, min(rec_id) AS group_id FROM datasets WHERE accession IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)
  SELECT group_id, field_name, rec_id FROM best JOIN grp USING (g)"""
SQL = {
    "p6_order": f"WITH RECURSIVE {_ORDER} SELECT field_name, older, newer FROM ordered",
    "p6_currency": _CURRENCY,
    "p3_terms": _TERMS,
    "p3_deltas": _DELTAS,
    "p3_found": f"SELECT field_name, term, mark FROM ({_TERMS}) WHERE mark IS NOT NULL",
    "p6_found": _SURVIVOR,
}
