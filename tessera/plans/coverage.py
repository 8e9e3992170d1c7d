"""Queries of segmentation queues, reports and path rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import names as N
from tessera.functions.text import norm_key
from tessera.operators import relational as R
from tessera.operators import segmentation as S
from tessera.plans.names import _tech
from tessera.sources.tables import table


def _samples(spark, folder):
    f = table(spark, folder, "files").where(norm_key(F.col("dl_status")) == "done").where("local_path IS NOT NULL")
    role = F.coalesce(norm_key(F.col("role")), F.lit(""))
    # roles stand for the paths of bins and scale factors
    return S.eligible(table(spark, folder, "datasets"), f, N.technology(F.col("technology")), "Visium HD", S.has_part(role, "matrix"), S.has_part(role, "coords"))


def _images(spark, folder):
    # tables stand for images
    return S.best_image(table(spark, folder, "files"), F.element_at(F.split("url", "/"), -1), r"\.(csv\.gz|parquet|h5ad)$", 1_000_000)


def hd_images(spark, folder):
    """The image that each sample would use."""
    return _images(spark, folder)


def hd_queue(spark, folder):
    """Samples that can be segmented, with the source of labels that the image leaves."""
    return S.queue(_samples(spark, folder), _images(spark, folder))


def files_listed(spark, folder):
    """Of each deposit the first 60 files (a page of a listing), with the number of all."""
    f = table(spark, folder, "files").where("source IS NOT NULL AND accession IS NOT NULL")
    n = f.groupBy("source", "accession").agg(F.count("*").alias("of"))
    first = f.select("source", "accession", "file_id", F.substring(F.element_at(F.split(F.coalesce("local_path", "url", F.lit("")), "/"), -1), 1, 90).alias("file"), R.r6(F.round(F.coalesce("size_bytes", F.lit(0)) / 1e6, 1)).alias("mb"))
    r = F.row_number().over(Window.partitionBy("source", "accession").orderBy("file_id"))
    return first.withColumn("r", r).where("r <= 60").drop("r").join(n, ["source", "accession"])


def archive_dirs(spark, folder):
    """The folder of an accession in its archive."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").select(F.trim("accession").alias("accession")).distinct().where(F.col("accession").rlike("^GS[EM][0-9]+$"))
    return d.select("accession", N.archive_dir(F.col("accession")).alias("dir"))


def annotation_report(spark, folder):
    """Figures of an annotation (events stand for cells, users for sections): totals, and types with one tail."""
    e = table(spark, folder, "events").select(F.col("event_type").alias("type"), F.col("user_id").alias("section"), (F.col("user_id") % 7).alias("organ"), F.col("value"))
    total = e.agg(F.count("*").alias("cells"), F.count_distinct("section").alias("sections"), F.count_distinct("organ").alias("organs"), F.count_distinct("type").alias("types"))
    rows = total.select(F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in total.columns])).alias("x")).select("x.*")
    per = e.groupBy("section").agg(F.avg("value").alias("agrees"))
    q = per.agg(*[F.percentile("agrees", F.lit(p)).alias(n) for p, n in ((0.25, "agrees_q1"), (0.5, "agrees_median"), (0.75, "agrees_q3"))])
    spread = q.select(F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.round(c, 3).alias("value")) for c in q.columns])).alias("x")).select("x.*")
    types = R.composition(e, "type", F.lit(1), 3).select(F.concat(F.lit("type "), "value").alias("figure"), F.col("w").cast("double").alias("value"))
    return rows.unionByName(spread).unionByName(types)


def review_summary(spark, folder):
    """What a review found: rows with errors, and the five commonest conventions of each field, absent ones too."""
    f = table(spark, folder, "files")
    n = f.agg(F.count("*").alias("n"), F.count_if(norm_key(F.col("dl_status")) == "failed").alias("n_errors"), F.count_if(F.col("size_bytes").isNull()).alias("n_warnings"))
    out = n.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.lit("").alias("value"), F.col(c).alias("n")) for c in n.columns])).alias("x")).select("x.*")
    for c in ("fmt", "role"):
        top = R.top_values(f.select(F.coalesce(c, F.lit("(absent)")).alias(c)), c, 5)
        out = out.unionByName(top.select(F.lit(c).alias("field"), "value", "n"))
    return out


def hd_cells(spark, folder):
    """Files and cells by the method that called them."""
    o = table(spark, folder, "orders").select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), "H&E + GEX salvage").when(F.col("o_orderpriority").startswith("2"), "gene expression only").otherwise("unknown").alias("method"))
    n = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return o.join(n, "o_orderkey", "left").groupBy("method").agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("cells"))


QUERIES = {f.__name__: f for f in (hd_images, hd_queue, files_listed, archive_dirs, annotation_report, review_summary, hd_cells)}

_PLAIN = "lower(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g'))"
_NAME = "split_part(url, '/', -1)"
_IMAGES = f"""SELECT source, accession, sample_id, round(size_bytes / 1e9, 2) AS image_gb, url AS image_url FROM (SELECT *, {_PLAIN.format("split_part(sample_id, '/', 1)")} AS tok, {_PLAIN.format(_NAME)} AS nm FROM files WHERE regexp_matches({_NAME}, '\\.(csv\\.gz|parquet|h5ad)$') AND size_bytes > 1000000 AND sample_id IS NOT NULL AND accession IS NOT NULL AND source IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY source, accession, sample_id ORDER BY tok <> '' AND contains(nm, tok) DESC, size_bytes DESC, url) = 1"""
_HD = f"SELECT DISTINCT source, accession FROM datasets WHERE lower(trim(verdict)) IN ('ready', 'bundle_only') AND ({_tech('technology')}) = 'Visium HD'"
SQL = {
    "hd_images": _IMAGES,
    "hd_queue": f"""WITH i AS ({_IMAGES}), h AS ({_HD}), s AS (SELECT f.source, f.accession, f.sample_id FROM files f JOIN h ON f.source = h.source AND f.accession = h.accession
      WHERE lower(trim(dl_status)) = 'done' AND local_path IS NOT NULL AND sample_id IS NOT NULL GROUP BY 1, 2, 3 HAVING bool_or(coalesce(contains(lower(trim(role)), 'matrix'), false)) AND bool_or(coalesce(contains(lower(trim(role)), 'coords'), false)))
      SELECT s.*, image_gb, image_url, CASE WHEN image_url IS NOT NULL THEN 'he+gex' ELSE 'gex' END AS label_source FROM s LEFT JOIN i USING (source, accession, sample_id)""",
    "files_listed": "SELECT source, accession, file_id, substr(split_part(coalesce(local_path, url, ''), '/', -1), 1, 90) AS file, round(coalesce(size_bytes, 0) / 1e6, 1) AS mb, count(*) OVER (PARTITION BY source, accession) AS of FROM files WHERE source IS NOT NULL AND accession IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source, accession ORDER BY file_id) <= 60",
    "archive_dirs": "SELECT DISTINCT trim(accession) AS accession, CASE WHEN starts_with(trim(accession), 'GSE') THEN 'series/' ELSE 'samples/' END || CASE WHEN length(trim(accession)) > 6 THEN substr(trim(accession), 1, length(trim(accession)) - 3) ELSE substr(trim(accession), 1, 3) END || 'nnn/' || trim(accession) || '/suppl/' AS dir FROM datasets WHERE regexp_matches(trim(accession), '^GS[EM][0-9]+$')",
    "annotation_report": """WITH p AS (SELECT user_id, avg(value) AS a FROM events GROUP BY 1), t AS (SELECT event_type AS v, count(*) AS w, row_number() OVER (ORDER BY count(*) DESC, event_type) AS r FROM events WHERE event_type IS NOT NULL GROUP BY 1)
      SELECT 'cells' AS figure, count(*)::DOUBLE AS value FROM events UNION ALL SELECT 'sections', count(DISTINCT user_id) FROM events UNION ALL SELECT 'organs', count(DISTINCT user_id % 7) FROM events UNION ALL SELECT 'types', count(DISTINCT event_type) FROM events
      UNION ALL SELECT 'agrees_q1', round(quantile_cont(a, 0.25), 3) FROM p UNION ALL SELECT 'agrees_median', round(quantile_cont(a, 0.5), 3) FROM p UNION ALL SELECT 'agrees_q3', round(quantile_cont(a, 0.75), 3) FROM p
      UNION ALL SELECT 'type ' || v, w FROM t WHERE r <= 3 UNION ALL SELECT 'type ' || count(*) || ' rarer values', sum(w) FROM t WHERE r > 3 HAVING count(*) > 0""",
    "review_summary": """SELECT 'n' AS field, '' AS value, count(*) AS n FROM files UNION ALL SELECT 'n_errors', '', count(*) FROM files WHERE lower(trim(dl_status)) = 'failed' UNION ALL SELECT 'n_warnings', '', count(*) FROM files WHERE size_bytes IS NULL
      UNION ALL SELECT * FROM (SELECT 'fmt', coalesce(fmt, '(absent)') AS v, count(*) FROM files GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5) UNION ALL SELECT * FROM (SELECT 'role', coalesce(role, '(absent)') AS v, count(*) FROM files GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)""",
    "hd_cells": "SELECT CASE WHEN starts_with(o_orderpriority, '1') THEN 'H&E + GEX salvage' WHEN starts_with(o_orderpriority, '2') THEN 'gene expression only' ELSE 'unknown' END AS method, count(*) AS files, CAST(coalesce(sum(n), 0) AS BIGINT) AS cells FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1",
}
