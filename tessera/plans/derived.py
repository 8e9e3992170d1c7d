"""Queries of derived tables, incremental ledgers and learned labels."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import names as N
from tessera.functions.text import NOT_STATED, norm_key, stated
from tessera.operators import relational as R
from tessera.sources.tables import table
from tessera.streaming import ledger as L

_OBS = ["tissue", "sex", "disease_state", "donor_id"]


def obs_harmonised(spark, folder):
    """Sample fields on every unit, null as 'unknown' (files stand for units)."""
    m = table(spark, folder, "sample_meta").where("sample_id IS NOT NULL").groupBy("sample_id").agg(F.min(F.struct("meta_id", *_OBS)).alias("m"))
    f = table(spark, folder, "files").select("file_id", "sample_id")
    j = f.join(m, "sample_id", "left")
    return j.select("file_id", *[F.when(stated(F.col(f"m.{c}")), F.col(f"m.{c}")).otherwise("unknown").alias(c) for c in _OBS])


def resolved_records(spark, folder):
    """Assay, implied sex and healthy short-cut of each record."""
    m = table(spark, folder, "sample_meta")
    tissue, sex = F.lower(F.coalesce("tissue", F.lit(""))), norm_key(F.col("sex"))
    implied = F.when(tissue.rlike("cervix|uter|ovar|endometri|fallopian|oviduct|vagin|vulva|myometri|decidua"), "female").when(tissue.rlike("prostat|testi|epididym|seminal|scrot|penis|spermat"), "male").otherwise("unknown")
    known = F.when(sex.isin("male", "female"), sex).when(F.col("species") == "homo_sapiens", implied).otherwise("unknown")
    return m.select("meta_id", F.coalesce(F.nullif(N.snake(F.col("assay")), F.lit("")), F.lit("unknown")).alias("assay"), known.alias("sex"), F.when(norm_key(F.col("disease_state")) == "healthy", "healthy").otherwise(F.coalesce("disease_level1", F.lit("unknown"))).alias("level1"))


def annotation_plan(spark, folder):
    """All groups of samples by tissue and assay, largest first."""
    m = table(spark, folder, "sample_meta").where(stated(F.col("tissue")))
    return m.groupBy(N.tissue(F.col("tissue")).alias("organ"), "assay").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "organ", "assay")


def celltype_counts(spark, folder):
    """Counts per section and class, rolled up by organ."""
    e = table(spark, folder, "events")
    c = e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return c.groupBy((F.col("user_id") % 7).alias("organ")).agg(F.count_distinct("user_id").alias("sections"), F.sum("n").alias("cells"), F.count_distinct("event_type").alias("types"))


def segment_queue(spark, folder):
    """All deposits with an image and a matrix, smallest first, sizes unknown last."""
    f = table(spark, folder, "files").where("accession IS NOT NULL")
    g = f.groupBy("accession").agg(F.bool_or(norm_key(F.col("role")) == "coords").alias("c"), F.bool_or(norm_key(F.col("role")) == "matrix").alias("m"), F.max("size_bytes").alias("largest"))
    return g.where("c AND m").orderBy(F.col("largest").asc_nulls_last(), "accession").select("accession", "largest")


def refresh_changed(spark, folder):
    """Derived values that differ from the ones on record (null-safe)."""
    a = table(spark, folder, "files").where("url IS NOT NULL").groupBy("url").agg(F.min(norm_key(F.col("dl_status"))).alias("least"), F.max(norm_key(F.col("dl_status"))).alias("most"))
    return a.where(~F.col("least").eqNullSafe(F.col("most")))


def conversion_plan(spark, folder):
    """Files in the order of conversion, the oversized deferred."""
    f = table(spark, folder, "files").where("size_bytes IS NOT NULL")
    s = f.select("file_id", "size_bytes", F.when(F.col("size_bytes") > 500_000_000, "deferred").when(F.col("dl_status") == "done", "convert").otherwise("wait").alias("plan"))
    return s.groupBy("plan").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"), F.min("size_bytes").alias("smallest"))


def added_fields(spark, folder):
    """Two ledgers of different columns under one schema, with the fields each row lacks."""
    c = table(spark, folder, "candidates").select(F.col("cand_id").alias("id"), "source", "reason")
    d = table(spark, folder, "datasets").select(F.col("rec_id").alias("id"), "source", "technology", "tissue")
    u = c.withColumn("from", F.lit("candidates")).unionByName(d.withColumn("from", F.lit("datasets")), allowMissingColumns=True)
    lack = F.array_compact(F.array(*[F.when(F.col(x).isNull(), F.lit(x)) for x in ("reason", "technology", "tissue")]))
    return u.groupBy("from").agg(F.count("*").alias("n"), F.sum(F.size(lack)).alias("missing"))


def section_lines(spark, folder):
    """The heading that each line of a page stands under."""
    d = table(spark, folder, "documents").where("text IS NOT NULL")
    l = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))  # noqa: E741
    head = F.when(F.col("line").isin("Summary", "Data files", "Overall design", "Sample table", "Known issues", "Contact and access"), F.col("line"))
    under = F.last(head, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return l.withColumn("under", under).where("under IS NOT NULL").groupBy("under").agg(F.count("*").alias("lines"), F.count_distinct("doc_id").alias("docs"))


def stream_dedupe(spark, folder):
    """First delivery of each event kind per user, by a stream."""
    e = L.stream(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = L.run(L.deduplicated(e, ["user_id", "event_type"], "at", "60 days").select("user_id", "event_type"), "append")
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{out}/batch=*")


def stream_running_total(spark, folder):
    """Running totals per user, the last state of each."""
    out = L.run(L.running_totals(L.stream(spark, folder, "events"), "user_id", "value"), "update")
    f = L.final(spark, out, ["user_id"], "user_id bigint, total double, n bigint")
    return f.select("user_id", R.r6(F.col("total")).alias("total"), "n")


def stream_window_counts(spark, folder):
    """Windowed counts with a watermark (an extension)."""
    e = L.stream(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = L.run(L.windowed_counts(e, "at", "1 day", "2 days", "event_type"), "update")
    f = L.final(spark, out, ["start", "event_type"], "start timestamp, event_type string, n bigint")
    return f.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_spend_cap(spark, folder):
    """Spend per user under a cap, by a stateful operator."""
    out = L.run(L.spend_guard(L.stream(spark, folder, "events"), "user_id", "ts", "value", 500.0), "update")
    f = L.final(spark, out, ["user_id"], "user_id bigint, spent double, capped boolean")
    return f.select("user_id", R.r6(F.col("spent")).alias("spent"), "capped")


def label_transfer(spark, folder):
    """Labels learned from a reference and smoothed over neighbourhoods."""
    from tessera.operators.labels import transfer

    e = table(spark, folder, "embeddings")
    known = F.when(F.col("vec_id") % 5 != 0, F.col("label"))
    return transfer(e.select("vec_id", "embedding", known.alias("label")), "vec_id", "embedding", "label")


QUERIES = {
    f.__name__: f
    for f in (obs_harmonised, resolved_records, annotation_plan, celltype_counts, segment_queue, refresh_changed, conversion_plan, added_fields, section_lines, stream_dedupe, stream_running_total, stream_window_counts, stream_spend_cap, label_transfer)
}

_NOT = ", ".join(f"'{x}'" for x in NOT_STATED)


def _st(c: str) -> str:
    return f"({c} IS NOT NULL AND lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) NOT IN ({_NOT}))"


_TISSUE = "coalesce(nullif(substr(lower(trim(split_part(split_part(tissue, ';', 1), ',', 1), ' ')), 1, 40), ''), 'unspecified')"
SQL = {
    "obs_harmonised": "WITH m AS (SELECT sample_id, arg_min(struct_pack(" + ", ".join(f"{c} := {c}" for c in _OBS) + "), meta_id) AS m FROM sample_meta WHERE sample_id IS NOT NULL GROUP BY 1) SELECT file_id, " + ", ".join(f"CASE WHEN {_st('m.' + c)} THEN m.{c} ELSE 'unknown' END AS {c}" for c in _OBS) + " FROM files LEFT JOIN m USING (sample_id)",
    "resolved_records": """SELECT meta_id, coalesce(nullif(trim(regexp_replace(lower(coalesce(assay, '')), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown') AS assay,
      CASE WHEN lower(trim(sex)) IN ('male', 'female') THEN lower(trim(sex)) WHEN species = 'homo_sapiens' THEN CASE WHEN regexp_matches(lower(coalesce(tissue, '')), 'cervix|uter|ovar|endometri|fallopian|oviduct|vagin|vulva|myometri|decidua') THEN 'female' WHEN regexp_matches(lower(coalesce(tissue, '')), 'prostat|testi|epididym|seminal|scrot|penis|spermat') THEN 'male' ELSE 'unknown' END ELSE 'unknown' END AS sex,
      CASE WHEN lower(trim(disease_state)) = 'healthy' THEN 'healthy' ELSE coalesce(disease_level1, 'unknown') END AS level1 FROM sample_meta""",
    "annotation_plan": f"SELECT {_TISSUE} AS organ, assay, count(*) AS n FROM sample_meta WHERE {_st('tissue')} GROUP BY 1, 2 ORDER BY n DESC, organ, assay NULLS FIRST",
    "celltype_counts": "SELECT user_id % 7 AS organ, count(DISTINCT user_id) AS sections, count(*) AS cells, count(DISTINCT event_type) AS types FROM events GROUP BY 1",
    "segment_queue": "SELECT accession, max(size_bytes) AS largest FROM files WHERE accession IS NOT NULL GROUP BY 1 HAVING bool_or(lower(trim(role)) = 'coords') AND bool_or(lower(trim(role)) = 'matrix') ORDER BY largest NULLS LAST, accession",
    "refresh_changed": "SELECT url, min(lower(trim(dl_status))) AS least, max(lower(trim(dl_status))) AS most FROM files WHERE url IS NOT NULL GROUP BY 1 HAVING min(lower(trim(dl_status))) IS DISTINCT FROM max(lower(trim(dl_status)))",
    "conversion_plan": "SELECT CASE WHEN size_bytes > 500000000 THEN 'deferred' WHEN dl_status = 'done' THEN 'convert' ELSE 'wait' END AS plan, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, min(size_bytes) AS smallest FROM files WHERE size_bytes IS NOT NULL GROUP BY 1",
    "added_fields": "SELECT 'candidates' AS \"from\", count(*) AS n, CAST(sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END + 2) AS BIGINT) AS missing FROM candidates UNION ALL SELECT 'datasets', count(*), CAST(sum(1 + CASE WHEN technology IS NULL THEN 1 ELSE 0 END + CASE WHEN tissue IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM datasets",
    "section_lines": "WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM s), u AS (SELECT doc_id, last_value(CASE WHEN line IN ('Summary', 'Data files', 'Overall design', 'Sample table', 'Known issues', 'Contact and access') THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS under FROM l) SELECT under, count(*) AS lines, count(DISTINCT doc_id) AS docs FROM u WHERE under IS NOT NULL GROUP BY 1",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_running_total": "SELECT user_id, round(sum(value), 6) AS total, count(*) AS n FROM events GROUP BY 1",
    "stream_window_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_spend_cap": "SELECT user_id, round(sum(value), 6) AS spent, sum(value) >= 500 AS capped FROM events GROUP BY 1",
}
