"""Queries on points: two dimensions of the embeddings, by label."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import spatial as S
from tessera.operators.relational import keep_prior
from tessera.sources.tables import table

_TECH = ["Visium", "Visium HD", "Xenium", "CosMx", "MERFISH", "Stereo-seq", "GeoMx"]


def _points(spark, folder, scale=1.0, whole=False):
    e = table(spark, folder, "embeddings").select(F.lit("all") if whole else F.col("label"), F.col("vec_id"), (F.col("embedding")[0].cast("double") * scale), (F.col("embedding")[1].cast("double") * scale))
    return e.toDF("sample", "id", "x", "y")


def nn_distance(spark, folder):
    """Distance to the nearest point, exactly."""
    return S.nearest(_points(spark, folder)).select("sample", "id", S.r6(F.col("nn")).alias("nn"))


def nn_spacing(spark, folder):
    """Spacing figures per sample."""
    return S.spacing(_points(spark, folder), 20)


def _stats(spark, folder):
    """Stated spacings, spans and shares of suppliers (for the verdicts, which are pure columns)."""
    k = F.col("s_suppkey")
    f = F.element_at(F.array(*[F.lit(x) for x in (1.0, 0.001, 0.0001, 1e-6, 3.7, 250.0)]), (k % 6 + 1).cast("int"))
    return table(spark, folder, "supplier").select(
        k.alias("sample"), F.element_at(F.array(*map(F.lit, _TECH)), (k % 7 + 1).cast("int")).alias("technology"), F.when(k % 23 == 0, 1.0).when(k % 29 == 0, 0.0).otherwise((k % 11 + 3).cast("double") * 9.0 * f).alias("nn"),
        F.when(k % 31 == 0, 0.4).otherwise(1.0).alias("frac"), F.when(k % 37 == 0, None).otherwise(F.abs("s_acctbal") * f + 1).alias("sx"), (F.abs("s_acctbal") * f * 0.5 + 1).alias("sy"), F.when(k % 3 == 0, 0.95).when(k % 3 == 1, 0.5).alias("modal"), F.when(k % 2 == 0, 8.0).alias("bin"),
    )


def unit_classifier(spark, folder):
    """Units of coordinates from spacing and span."""
    c = F.col
    v = S.unit_verdict(c("technology"), c("nn"), c("frac"), c("sx"), c("sy"), F.lit(1000), c("modal"), c("bin"))
    return _stats(spark, folder).select("sample", v.alias("v")).select("sample", F.when(c("v.verdict") != "rescale", c("v.unit")).alias("unit"), S.r6(c("v.um_per_unit")).alias("um_per_unit"), c("v.verdict").alias("verdict"))


def pixel_hypothesis(spark, folder):
    """Whether coordinates are pixels."""
    c = F.col
    return _stats(spark, folder).select("sample", S.pixel_verdict(c("technology"), F.nullif(c("nn"), F.lit(0.0)), F.coalesce("sx", F.lit(0.0)) * 50, c("sy") * 50).alias("verdict"))


def rescale_plan(spark, folder):
    """Coordinates rescaled where the factor is known, once (a second run finds nothing to do)."""
    c = F.col
    v = S.unit_verdict(c("technology"), c("nn"), c("frac"), c("sx"), c("sy"), F.lit(1000), c("modal"), c("bin"))
    s = _stats(spark, folder).withColumn("v", v).withColumn("f", F.when(c("v.verdict") == "rescale", c("v.um_per_unit")).otherwise(1.0))
    return s.select("sample", S.r6(c("nn") * c("f")).alias("nn_after"), S.r6(c("sx") * c("f")).alias("sx_after"), F.when(c("v.verdict") == "rescale", "rescaled").otherwise("left").alias("status"))


def tissue_pieces(spark, folder):
    """Pieces of the radius graph over all points."""
    p = _points(spark, folder, whole=True)
    return S.pieces(p, p.groupBy("sample").agg(F.lit(0.02).alias("radius")))


def piece_report(spark, folder):
    """Pieces and fragments per label at eight times the median spacing."""
    p = _points(spark, folder)
    r = S.spacing(p, 20).select("sample", (F.col("nn") * 8).alias("radius"))
    return S.piece_report(S.pieces(p, r), 10, 0.05, 3)


def spatial_stats(spark, folder):
    """Extent, area, density."""
    return S.extent(_points(spark, folder), F.lit(100.0))


def modal_pitch(spark, folder):
    """Pitch of coordinates snapped to a lattice."""
    p = _points(spark, folder).select("sample", "id", (F.floor(F.col("x") * 40) * 2.5).alias("x"), (F.floor(F.col("y") * 25) * 4.0).alias("y"))
    return S.modal_pitch(p)


def _grids(spark, folder):
    k = F.col("p_partkey")
    base = F.element_at(F.array(*map(F.lit, (3350, 1675, 838, 419, 5500, 2750, 1375, 688, 78, 128, 1000, 64))), (k % 12 + 1).cast("int"))
    rows = F.when(k % 17 == 0, None).when(k % 12 >= 8, base).otherwise(F.floor(base * (1 + (k % 101 - 50) / 1000.0)))
    return table(spark, folder, "part").select(k.alias("sample"), rows.cast("int").alias("rows"), F.when(k % 5 == 0, F.concat(F.lit("s_square_008um_"), k.cast("string"))).otherwise(k.cast("string")).alias("sample_id"), F.col("p_retailprice").alias("x_range"), (F.col("p_size") * 100).alias("y_range"))


def grid_geometry(spark, folder):
    """Bin size, capture side and verdict by grid rows."""
    return _grids(spark, folder).select("sample", S.grid(F.col("rows"), F.col("sample_id")).alias("g")).select("sample", "g.*")


def coordinate_scale(spark, folder):
    """Micrometres per coordinate unit."""
    g = _grids(spark, folder).withColumn("g", S.grid(F.col("rows"), F.col("sample_id")))
    return g.select("sample", S.coordinate_scale(F.col("rows"), F.col("g.bin_um"), F.col("x_range"), F.col("y_range").cast("double")).alias("s")).select("sample", "s.*")


def technology_resolved(spark, folder):
    """Technology by evidence, the previous answer kept where there is none."""
    k = F.col("sample")
    g = _grids(spark, folder).withColumn("v", S.grid(F.col("rows"), F.col("sample_id"))["verdict"])
    t = S.resolved_technology(F.when(k % 4 < 3, "Visium HD").otherwise("Xenium"), F.col("v"), F.when(k % 3 == 0, 0.99).otherwise(0.5), F.when(k % 7 == 0, "xenium"), F.when(k % 2 == 0, 20000).otherwise(300))
    now = g.select("sample", t.alias("technology"))
    old = g.where("sample % 5 <> 0").select("sample", F.when(k % 2 == 0, "Visium").otherwise("unknown").alias("technology"))
    return keep_prior(now, old, ["sample"], "technology")


QUERIES = {
    f.__name__: f
    for f in (nn_distance, nn_spacing, unit_classifier, pixel_hypothesis, rescale_plan, tissue_pieces, piece_report, spatial_stats, modal_pitch, grid_geometry, coordinate_scale, technology_resolved)
}

_P = "p AS (SELECT label AS sample, vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"
_NN = f"{_P}, nn AS (SELECT a.sample, a.id, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS nn FROM p a JOIN p b ON a.sample = b.sample AND a.id <> b.id GROUP BY 1, 2)"
_SP = f"""{_NN}, m AS (SELECT sample, quantile_cont(nn, 0.5) AS nn, stddev_pop(nn) / avg(nn) AS cv FROM nn GROUP BY 1), f AS (SELECT nn.sample, avg(CASE WHEN abs(nn.nn - m.nn) <= 0.05 * m.nn THEN 1.0 ELSE 0 END) AS modal FROM nn JOIN m USING (sample) GROUP BY 1),
  b AS (SELECT sample, count(*) AS n, max(x) - min(x) AS sx, max(y) - min(y) AS sy FROM p GROUP BY 1)"""
_ST = """s AS (SELECT s_suppkey AS sample, ['Visium', 'Visium HD', 'Xenium', 'CosMx', 'MERFISH', 'Stereo-seq', 'GeoMx'][s_suppkey % 7 + 1] AS t, CAST([1.0, 0.001, 0.0001, 1e-6, 3.7, 250.0][s_suppkey % 6 + 1] AS DOUBLE) AS f, s_suppkey AS k, s_acctbal AS a FROM supplier),
  q AS (SELECT sample, t, CASE WHEN k % 23 = 0 THEN 1.0 WHEN k % 29 = 0 THEN 0.0 ELSE CAST(k % 11 + 3 AS DOUBLE) * 9.0::DOUBLE * f END AS nn, CASE WHEN k % 31 = 0 THEN 0.4 ELSE 1.0 END AS frac, CASE WHEN k % 37 <> 0 THEN abs(a) * f + 1 END AS sx, abs(a) * f * 0.5::DOUBLE + 1 AS sy, CASE k % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.5 END AS modal, CASE WHEN k % 2 = 0 THEN 8.0 END AS bin FROM s),
  e AS (SELECT *, CAST(CASE WHEN modal IS NULL OR modal >= 0.9 THEN CASE WHEN t IN ('Visium HD', 'Stereo-seq') THEN bin WHEN t = 'Visium' THEN 100.0 END END AS DOUBLE) AS pitch, CASE WHEN sx IS NULL THEN sy ELSE greatest(sx, sy) END AS w FROM q),
  c AS (SELECT *, pitch / nn AS um, list_filter([{'u': 'microns', 'f': 1.0::DOUBLE}, {'u': 'millimetres', 'f': 1e3::DOUBLE}, {'u': 'centimetres', 'f': 1e4::DOUBLE}, {'u': 'metres', 'f': 1e6::DOUBLE}], lambda z: w * z.f BETWEEN 200 AND 60000 AND nn * z.f BETWEEN 2 AND 2000) AS cand FROM e),
  v AS (SELECT *, CASE WHEN frac < 0.5 THEN 'coords_non_finite' WHEN nn <= 0 THEN 'coords_degenerate' WHEN sx IS NOT NULL AND abs(nn - 1) < 1e-6 AND w < 2000 THEN 'array_index_not_a_unit'
    WHEN pitch IS NOT NULL THEN CASE WHEN um BETWEEN 0.8 AND 1.25 THEN 'ok' WHEN sx IS NOT NULL AND NOT w * um BETWEEN 200 AND 60000 THEN 'spacing_unexplained' ELSE 'rescale' END
    WHEN sx IS NULL THEN 'no_expected_spacing' WHEN len(cand) = 0 THEN 'spacing_unexplained' WHEN cand[1].u = 'microns' THEN 'ok' WHEN len(cand) > 1 THEN 'unit_ambiguous' ELSE 'rescale' END AS verdict FROM c),
  z AS (SELECT *, CASE verdict WHEN 'ok' THEN 1.0 WHEN 'rescale' THEN coalesce(um, cand[1].f) END AS factor FROM v)"""
_G = """g AS (SELECT p_partkey AS k, CAST(CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 12 >= 8 THEN [3350, 1675, 838, 419, 5500, 2750, 1375, 688, 78, 128, 1000, 64][p_partkey % 12 + 1]
    ELSE floor([3350, 1675, 838, 419, 5500, 2750, 1375, 688, 78, 128, 1000, 64][p_partkey % 12 + 1] * CAST(1 + (p_partkey % 101 - 50) / 1000.0::DOUBLE AS DOUBLE)) END AS INT) AS r, p_retailprice AS xr, p_size * 100 AS yr FROM part),
  u AS (SELECT *, list_filter([[3350, 2], [1675, 4], [838, 8], [419, 16], [5500, 2], [2750, 4], [1375, 8], [688, 16]], lambda z: abs(r - z[1]) * 1.0::DOUBLE / z[1] < 0.04)[1][2] AS um, len(list_filter([5500, 2750, 1375, 688], lambda z: abs(r - z) * 1.0::DOUBLE / z < 0.04)) > 0 AS big FROM g),
  w AS (SELECT *, CAST(coalesce(um, CASE WHEN k % 5 = 0 THEN 8 END) AS DOUBLE) AS bin FROM u),
  x AS (SELECT *, CASE WHEN r IN (78, 128, 120, 64) THEN 'not_visium_hd' WHEN bin IS NOT NULL THEN 'hd_grid' WHEN r IS NULL THEN 'no_positions_table' ELSE 'unrecognised_grid' END AS verdict FROM w)"""
SQL = {
    "nn_distance": f"WITH {_NN} SELECT sample, id, round(nn, 6) AS nn FROM nn",
    "nn_spacing": f"WITH {_SP} SELECT sample, n, 1.0::DOUBLE AS frac_finite, round(CASE WHEN n >= 20 THEN m.nn END, 6) AS nn, round(CASE WHEN n >= 20 THEN cv END, 6) AS lattice_cv, round(CASE WHEN n >= 20 THEN modal END, 6) AS frac_modal, round(sx, 6) AS span_x, round(sy, 6) AS span_y FROM b JOIN m USING (sample) JOIN f USING (sample)",
    "unit_classifier": f"WITH {_ST} SELECT sample, CASE verdict WHEN 'ok' THEN 'microns' WHEN 'unit_ambiguous' THEN array_to_string(list_transform(cand, lambda y: y.u), '|') END AS unit, round(factor, 6) AS um_per_unit, verdict FROM z",
    "pixel_hypothesis": f"""WITH {_ST}, h AS (SELECT sample, nullif(nn, 0) AS nn, greatest(coalesce(sx, 0) * 50, sy * 50) AS w, CASE t WHEN 'CosMx' THEN 0.1202 WHEN 'Xenium' THEN 0.2125 WHEN 'Visium HD' THEN 0.2125 WHEN 'MERFISH' THEN 0.108 WHEN 'Visium' THEN 0.2125 END AS px FROM q)
      SELECT sample, CASE WHEN px IS NULL THEN 'no pixel size for this platform' WHEN nn IS NULL THEN 'too few points' WHEN nn * px BETWEEN 2 AND 30 AND w * px / 1000 BETWEEN 0.5 AND 40 THEN 'pixels'
        ELSE 'rejected (nn ' || CASE WHEN nn * px BETWEEN 2 AND 30 THEN 'ok' ELSE 'bad' END || ', span ' || CASE WHEN w * px / 1000 BETWEEN 0.5 AND 40 THEN 'ok' ELSE 'bad' END || ')' END AS verdict FROM h""",
    "rescale_plan": f"WITH {_ST} SELECT sample, round(nn * CASE WHEN verdict = 'rescale' THEN factor ELSE 1 END, 6) AS nn_after, round(sx * CASE WHEN verdict = 'rescale' THEN factor ELSE 1 END, 6) AS sx_after, CASE WHEN verdict = 'rescale' THEN 'rescaled' ELSE 'left' END AS status FROM z",
    "tissue_pieces": f"WITH RECURSIVE {_P}, e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id <> b.id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.02), c AS (SELECT id AS a, id AS b FROM p UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a) SELECT 'all' AS sample, a AS id, min(b) AS piece FROM c GROUP BY 2",
    "piece_report": f"""WITH RECURSIVE {_SP}, r AS (SELECT sample, round(nn, 6) * 8 AS r FROM m), e AS (SELECT a.sample, a.id AS a, b.id AS b FROM p a JOIN p b ON a.sample = b.sample AND a.id <> b.id JOIN r ON r.sample = a.sample WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= r),
      c AS (SELECT id AS a, id AS b FROM p UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a), l AS (SELECT a, min(b) AS piece FROM c GROUP BY 1), s AS (SELECT sample, piece, count(*) AS n FROM l JOIN p ON p.id = l.a GROUP BY 1, 2)
      SELECT s.sample, count(*) FILTER (s.n >= greatest(10, b.n * 0.05)) AS pieces, count(*) FILTER (s.n < greatest(10, b.n * 0.05) AND s.n >= 3) AS fragments, any_value(b.n) AS n_points FROM s JOIN b ON s.sample = b.sample GROUP BY 1""",
    "spatial_stats": f"WITH {_P}, g AS (SELECT sample, count(*) AS n, max(x) - min(x) AS w, max(y) - min(y) AS h FROM p GROUP BY 1) SELECT sample, n, round(w, 6) AS width, round(h, 6) AS height, round(w * 100 * h * 100 / 1e6, 6) AS area_mm2, round(n / nullif(w * 100 * h * 100 / 1e6, 0), 6) AS per_mm2 FROM g",
    "modal_pitch": f"""WITH {_P}, l AS (SELECT DISTINCT sample, 'x' AS axis, floor(x * 40) * 2.5 AS v FROM p UNION SELECT DISTINCT sample, 'y', floor(y * 25) * 4.0 FROM p), d AS (SELECT *, v - lag(v) OVER (PARTITION BY sample, axis ORDER BY v) AS d FROM l),
      m AS (SELECT sample, axis, min(d) AS least, max(v) - min(v) AS ext FROM d GROUP BY 1, 2), q AS (SELECT d.sample, d.axis, d, ext, CAST(round_even(d / least, 0) AS INT) AS q FROM d JOIN m USING (sample, axis) WHERE d IS NOT NULL),
      o AS (SELECT sample, axis, q FROM (SELECT sample, axis, q, row_number() OVER (PARTITION BY sample, axis ORDER BY count(*) DESC, q) AS r FROM q WHERE q <= 20 GROUP BY 1, 2, 3) WHERE r = 1)
      SELECT sample, axis, round(quantile_cont(d, 0.5), 6) AS pitch, CAST(round_even(any_value(ext) / quantile_cont(d, 0.5), 0) AS INT) + 1 AS rows FROM q JOIN o USING (sample, axis, q) GROUP BY 1, 2""",
    "grid_geometry": f"WITH {_G} SELECT k AS sample, bin AS bin_um, CAST(CASE WHEN um IS NOT NULL THEN CASE WHEN big THEN 11.0 ELSE 6.5 END END AS DOUBLE) AS capture_mm, verdict FROM x",
    "coordinate_scale": f"WITH {_G} SELECT k AS sample, round(r * bin / greatest(xr, yr), 6) AS um_per_unit, CASE WHEN r * bin / greatest(xr, yr) BETWEEN 0.8 AND 1.25 THEN 'microns' WHEN r * bin IS NOT NULL THEN 'pixels' ELSE 'unknown' END AS coord_units FROM x",
    "technology_resolved": f"""WITH {_G}, t AS (SELECT k, CASE WHEN verdict = 'hd_grid' THEN 'Visium HD' WHEN verdict = 'not_visium_hd' THEN 'Visium' WHEN k % 3 = 0 THEN CASE WHEN k % 4 < 3 THEN 'Visium HD' WHEN k % 7 = 0 THEN 'Xenium' WHEN k % 2 = 0 THEN 'cell-level WTA' ELSE 'cell-level (unknown platform)' END ELSE 'unknown' END AS n FROM x)
      SELECT k AS sample, CASE WHEN n = 'unknown' AND k % 5 <> 0 AND k % 2 = 0 THEN 'Visium' ELSE n END AS technology, n = 'unknown' AND k % 5 <> 0 AND k % 2 = 0 AS kept FROM t""",
}
