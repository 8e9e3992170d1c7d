"""Queries of standing checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import norm_key
from tessera.operators import quality as Q
from tessera.operators.relational import pivot_counts
from tessera.sources.tables import table


def _genes(spark, folder):
    """Gene names per supplier in several styles, made of the parts it sells."""
    from pyspark.sql.window import Window

    li = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    k, p = F.col("l_suppkey"), F.col("l_partkey")
    s = F.concat(F.when(p % 3 == 0, "Sox").when(p % 3 == 1, "Gata").otherwise("Pax"), p.cast("string"))
    name = F.when(k % 6 == 0, F.upper(s)).when(k % 6 == 1, s).when(k % 6 == 2, F.when(p % 4 == 0, s).otherwise(F.upper(s))).when(k % 6 == 3, F.concat(F.lit("ENSG"), F.lpad(p.cast("string"), 11, "0"))).when(k % 6 == 4, p.cast("string")).otherwise(F.when(p % 100 == 7, "cell_id").otherwise(F.upper(s)))
    return li.select(k.alias("sample"), F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_partkey")).alias("ordinal"), name.alias("gene"))


def species_call(spark, folder):
    """Species by gene names."""
    return Q.species(_genes(spark, folder))


def audit_rules(spark, folder):
    """First fault of every gene axis."""
    return Q.audit(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("sample")).union(spark.range(1).select(F.lit(-1).cast("bigint"))), _genes(spark, folder))


def axis_review(spark, folder):
    """Dialect, repeats, errors and warnings of gene axes."""
    return Q.axis_review(_genes(spark, folder).select("sample", F.when(F.col("ordinal") % 40 == 0, "REPEATED").otherwise(F.col("gene")).alias("gene")))


def _facts(spark, folder):
    k = F.col("c_custkey")
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (k % len(x) + 1).cast("int"))
    return table(spark, folder, "customer").select(
        k.alias("sample"), pick("Xenium", "Visium", "CosMx", "MERFISH", "GeoMx").alias("technology"), (k * 10).alias("n_cells"), pick(300, 30000, 7000).cast("bigint").alias("n_genes"), F.when(k % 7 == 0, k * 10 + k).otherwise(k * 10).alias("n_obs"), pick(300, 30000, 7000, 4000).cast("bigint").alias("n_vars"),
        pick("homo_sapiens", "mus_musculus", None, "homo_sapiens", "").alias("species"), F.when(k % 13 != 0, (k % 100) / 100.0).alias("frac_mouse"), (k % 60).alias("n_symbols"), pick("male", "female", "unknown").alias("sex"), pick("male", "male", "female", "unknown").alias("inferred_sex"),
        F.when(k % 11 != 0, (k % 10) / 10.0).alias("frac_known"), (k % 19 != 0).alias("has_spatial"), (k % 23 != 0).alias("spatial_ok"),
    )


def crosscheck(spark, folder):
    """Manifest against file facts."""
    return Q.crosscheck(_facts(spark, folder))


def crosscheck_counts(spark, folder):
    """The commonest issues."""
    return Q.message_counts(Q.crosscheck(_facts(spark, folder)), "detail")


def lr_ready_verdict(spark, folder):
    """Readiness for pair analysis."""
    k = F.col("c_custkey")
    geo = F.element_at(F.array(*map(F.lit, ("ok", "ok", "missing", "wrong unit", "ok", "degenerate", "implausible"))), (k % 7 + 1).cast("int"))
    d = table(spark, folder, "customer").select(k.alias("sample"), (k % 900).alias("n_units"), (k % 3 * 9000).alias("n_genes"), (k % 70).alias("n_pairs"), (k % 4 != 0).alias("is_counts"), geo.alias("geometry"))
    return Q.readiness(d)


def consistency_split(spark, folder):
    """Conventions that the corpus does not share."""
    return Q.split_fields(table(spark, folder, "sample_meta"), ["metadata_source", "confidence", "preservation", "species"])


def column_coverage(spark, folder):
    """Which words the titles of datasets share."""
    d = table(spark, folder, "datasets").select(F.regexp_replace(F.lower("title"), "[^a-z]+", ";").alias("cols"))
    return Q.column_coverage(d, "cols").where("kind <> 'rare'")


def load_status(spark, folder):
    """Where the samples of each technology ended."""
    k = F.col("rec_id")
    status = F.element_at(F.array(*map(F.lit, ("ok", "ok", "ok | qc_error", "no_coords", "no_recognised_matrix", "matrix_error: x"))), (k % 6 + 1).cast("int"))
    d = table(spark, folder, "datasets").where("technology IS NOT NULL").select("technology", Q.load_bucket(status, F.col("removed_at").isNotNull() | (norm_key(F.coalesce("verdict", F.lit(""))) != "ready")).alias("bucket"))
    return pivot_counts(d, "technology", "bucket", ["in atlas", "no coordinates", "no matrix found", "read error", "excluded"])


def loaders(spark, folder):
    """How each sample would be read."""
    f = table(spark, folder, "files").where("url IS NOT NULL AND sample_id IS NOT NULL")
    return Q.loaders(f, F.col("url"), ["sample_id"])


QUERIES = {f.__name__: f for f in (species_call, audit_rules, axis_review, crosscheck, crosscheck_counts, lr_ready_verdict, consistency_split, column_coverage, load_status, loaders)}

_GENES = """li AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS p, CASE l_partkey % 3 WHEN 0 THEN 'Sox' WHEN 1 THEN 'Gata' ELSE 'Pax' END || l_partkey AS s FROM lineitem),
  g AS (SELECT k AS sample, row_number() OVER (PARTITION BY k ORDER BY p) AS o, CASE k % 6 WHEN 0 THEN upper(s) WHEN 1 THEN s WHEN 2 THEN CASE WHEN p % 4 = 0 THEN s ELSE upper(s) END WHEN 3 THEN 'ENSG' || lpad(CAST(p AS VARCHAR), 11, '0') WHEN 4 THEN CAST(p AS VARCHAR) ELSE CASE WHEN p % 100 = 7 THEN 'cell_id' ELSE upper(s) END END AS gene FROM li)"""
_IDS = ", ".join(f"'{x}'" for x in Q.IDENTIFIERS)
_FACTS = """f AS (SELECT c_custkey AS k, ['Xenium', 'Visium', 'CosMx', 'MERFISH', 'GeoMx'][c_custkey % 5 + 1] AS t, c_custkey * 10 AS n_cells, [300, 30000, 7000][c_custkey % 3 + 1] AS n_genes, CASE WHEN c_custkey % 7 = 0 THEN c_custkey * 11 ELSE c_custkey * 10 END AS n_obs, [300, 30000, 7000, 4000][c_custkey % 4 + 1] AS n_vars,
    ['homo_sapiens', 'mus_musculus', NULL, 'homo_sapiens', ''][c_custkey % 5 + 1] AS species, CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 100 END AS fm, c_custkey % 60 AS ns, ['male', 'female', 'unknown'][c_custkey % 3 + 1] AS sex, ['male', 'male', 'female', 'unknown'][c_custkey % 4 + 1] AS inf,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 10 AS DOUBLE) / 10 END AS fk, c_custkey % 19 <> 0 AS hs, c_custkey % 23 <> 0 AS so FROM customer),
  x AS (SELECT k AS sample, list_filter([CASE WHEN n_obs > 0 AND abs(n_cells - n_obs) / greatest(n_obs, 1.0::DOUBLE) > 0.02 THEN 'cells_mismatch' END, CASE WHEN n_vars > 0 AND abs(n_genes - n_vars) / greatest(n_vars, 1.0::DOUBLE) > 0.02 THEN 'genes_mismatch' END,
    CASE WHEN fm > CASE WHEN ns >= 30 THEN 0.8 ELSE 0.95 END AND NOT contains(coalesce(species, ''), 'mus') THEN 'species: mouse symbols' END, CASE WHEN fm < 0.2 AND species = 'mus_musculus' THEN 'species: human symbols' END,
    CASE WHEN sex IN ('male', 'female') AND inf IN ('male', 'female') AND sex <> inf THEN 'sex' END, CASE WHEN n_vars > CASE t WHEN 'Xenium' THEN 6000 WHEN 'CosMx' THEN 21000 WHEN 'MERFISH' THEN 2000 END THEN 'panel: too many genes' END, CASE WHEN t = 'Visium' AND n_vars < 5000 THEN 'panel: too few genes' END,
    CASE WHEN fk < 0.5 AND n_vars >= 20 THEN 'not_genes' END, CASE WHEN NOT hs THEN 'spatial: no coordinates' END, CASE WHEN hs AND NOT so THEN 'spatial: degenerate' END], lambda z: z IS NOT NULL) AS i FROM f)"""
_FN = "lower(url)"
_LOAD = "CASE " + " ".join(f"WHEN regexp_matches({_FN}, '{p}') THEN {i}" for i, (p, _) in enumerate(Q.LOADERS)) + " ELSE 99 END"
SQL = {
    "species_call": f"""WITH {_GENES}, c AS (SELECT sample, count(*) FILTER (starts_with(upper(gene), 'ENSG')) AS h, count(*) FILTER (starts_with(upper(gene), 'ENSMUS')) AS m, count(*) FILTER (NOT regexp_matches(upper(gene), '^(ENSG|ENSMUS)') AND regexp_matches(gene, '{Q.UPPER_STRICT}')) AS up, count(*) FILTER (NOT regexp_matches(upper(gene), '^(ENSG|ENSMUS)') AND regexp_matches(gene, '{Q.TITLE_STRICT}')) AS ti FROM g WHERE o <= 4000 GROUP BY 1)
      SELECT sample, CASE WHEN h + m >= 10 THEN CASE WHEN h / (h + m) >= 0.95 THEN 'homo_sapiens' WHEN h / (h + m) <= 0.05 THEN 'mus_musculus' END WHEN up + ti < 10 THEN NULL WHEN ti / (up + ti) > CASE WHEN up + ti >= 30 THEN 0.8 ELSE 0.95 END THEN 'mus_musculus' WHEN ti / (up + ti) < CASE WHEN up + ti >= 30 THEN 0.2 ELSE 0.05 END THEN 'homo_sapiens' END AS species FROM c""",
    "audit_rules": f"""WITH {_GENES}, c AS (SELECT sample, count(*) AS n_var, count(*) FILTER (lower(trim(gene)) IN ({_IDS})) AS ids, avg(CASE WHEN o <= 500 THEN CASE WHEN regexp_matches(gene, '{Q.SYMBOL}') OR regexp_matches(gene, '{Q.ENSEMBL}') THEN 1.0 ELSE 0 END END) AS lik, avg(CASE WHEN o <= 500 THEN CASE WHEN regexp_matches(gene, '^\\d+$') THEN 1.0 ELSE 0 END END) AS dig,
      count(*) FILTER (NOT regexp_matches(gene, '^(ENSG|ENSMUS)') AND o <= 600 AND regexp_matches(gene, '{Q.UPPER}')) AS up, count(*) FILTER (NOT regexp_matches(gene, '^(ENSG|ENSMUS)') AND o <= 600 AND regexp_matches(gene, '{Q.TITLE}')) AS ti FROM g GROUP BY 1), a AS (SELECT s_suppkey AS sample FROM supplier UNION ALL SELECT -1)
      SELECT a.sample, coalesce(n_var, 0) AS n_var, CASE WHEN n_var IS NULL THEN 'empty_gene_axis' WHEN ids > 0 THEN 'identifier_as_gene' WHEN lik < 0.5 THEN 'var_axis_not_genes: ' || CASE WHEN dig > 0.5 THEN 'positional_integers' ELSE 'unrecognised' END
        WHEN up + ti >= 10 AND ti / (up + ti) > CASE WHEN up + ti >= 30 THEN 0.8 ELSE 0.95 END THEN 'not_human' WHEN up + ti >= 30 AND ti / (up + ti) > 0.2 THEN 'mixed_species' ELSE '' END AS problem FROM a LEFT JOIN c USING (sample)""",
    "axis_review": f"""WITH {_GENES}, h AS (SELECT sample, CASE WHEN o % 40 = 0 THEN 'REPEATED' ELSE gene END AS gene FROM g), c AS (SELECT sample, count(*) AS n, count(DISTINCT gene) AS d, count(*) FILTER (regexp_matches(gene, '{Q.ENSEMBL}')) AS ens, count(*) FILTER (regexp_matches(gene, '^\\d+$')) AS pos, count(*) FILTER (regexp_matches(gene, '{Q.SYMBOL}') AND NOT regexp_matches(gene, '{Q.ENSEMBL}')) AS sym FROM h GROUP BY 1),
      e AS (SELECT *, CASE WHEN ens / n > 0.5 THEN 'ensembl' WHEN pos / n > 0.5 THEN 'positional' WHEN sym / n > 0.5 THEN 'symbol' ELSE 'mixed' END AS dialect, round(1 - d / n, 4) AS dup_frac FROM c)
      SELECT sample, dialect, dup_frac, CASE WHEN pos / n > 0.5 THEN 'var axis is positional integers, not gene identity' ELSE '' END AS errors, array_to_string(list_filter([CASE WHEN dup_frac > 0.01 THEN 'duplicate gene names' END, CASE WHEN dialect = 'mixed' THEN 'mixed gene identifier dialects on one axis' END], lambda z: z IS NOT NULL), ' | ') AS warnings FROM e""",
    "crosscheck": f"WITH {_FACTS} SELECT sample, coalesce(split_part(i[1], ':', 1), '') AS issue, array_to_string(i, ' | ') AS detail FROM x",
    "crosscheck_counts": f"WITH {_FACTS} SELECT m AS message, count(*) AS n FROM (SELECT unnest(i) AS m FROM x) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "lr_ready_verdict": """WITH d AS (SELECT c_custkey AS k, c_custkey % 900 AS u, c_custkey % 3 * 9000 AS g, c_custkey % 70 AS p, c_custkey % 4 <> 0 AS c, ['ok', 'ok', 'missing', 'wrong unit', 'ok', 'degenerate', 'implausible'][c_custkey % 7 + 1] AS geo FROM customer),
      b AS (SELECT k, g, list_filter([CASE WHEN NOT c THEN 'not integer counts' END, CASE geo WHEN 'missing' THEN 'no coordinates' END, CASE geo WHEN 'degenerate' THEN 'coordinates degenerate' END, CASE geo WHEN 'wrong unit' THEN 'not microns' END, CASE geo WHEN 'implausible' THEN 'implausible scale' END,
        CASE WHEN g > 15000 AND p < 50 THEN 'only few pairs of the transcriptome' END, CASE WHEN g <= 15000 AND p < 5 THEN 'only few pairs' END, CASE WHEN u > 0 AND u < 200 THEN 'only few units' END], lambda z: z IS NOT NULL) AS bad FROM d)
      SELECT k AS sample, CASE WHEN g > 15000 THEN 'whole_transcriptome' ELSE 'targeted' END AS panel_class, CASE WHEN len(bad) = 0 THEN 'ready' WHEN list_contains(bad, 'not microns') THEN 'fixable_rescale' WHEN len(list_filter(bad, lambda z: NOT (contains(z, 'not integer') OR contains(z, 'only')))) = 0 THEN 'usable_with_care' ELSE 'not_ready' END AS verdict, array_to_string(bad, ' | ') AS reasons FROM b""",
    "consistency_split": """WITH l AS (SELECT 'metadata_source' AS field, coalesce(metadata_source, '(absent)') AS v FROM sample_meta UNION ALL SELECT 'confidence', coalesce(confidence, '(absent)') FROM sample_meta UNION ALL SELECT 'preservation', coalesce(preservation, '(absent)') FROM sample_meta UNION ALL SELECT 'species', coalesce(species, '(absent)') FROM sample_meta),
      r AS (SELECT field, v, count(*) AS n, row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, v) AS r, count(*) / sum(count(*)) OVER (PARTITION BY field) AS share FROM l GROUP BY 1, 2)
      SELECT field, max(v) FILTER (r = 1) AS majority, round(max(share) FILTER (r = 1), 3) AS majority_share, string_agg(v, ', ' ORDER BY r) FILTER (r BETWEEN 2 AND 6) AS minority FROM r GROUP BY 1 HAVING max(share) FILTER (r = 1) < 0.99""",
    "column_coverage": "WITH d AS (SELECT list_distinct(list_filter(string_split(coalesce(regexp_replace(lower(title), '[^a-z]+', ';', 'g'), ''), ';'), lambda z: z <> '')) AS w FROM datasets), c AS (SELECT unnest(w) AS name FROM d), n AS (SELECT name, count(*) AS n, count(*) / (SELECT count(*) FROM d) AS share FROM c GROUP BY 1) SELECT name, n, round(share, 6) AS share, CASE WHEN share >= 0.99 THEN 'universal' ELSE 'partial' END AS kind FROM n WHERE share >= 0.01",
    "load_status": """WITH d AS (SELECT technology, ['ok', 'ok', 'ok | qc_error', 'no_coords', 'no_recognised_matrix', 'matrix_error: x'][rec_id % 6 + 1] AS s, removed_at IS NOT NULL OR lower(trim(coalesce(verdict, ''))) <> 'ready' AS k FROM datasets WHERE technology IS NOT NULL),
      b AS (SELECT technology, CASE WHEN NOT starts_with(s, 'ok') THEN CASE WHEN s = 'no_coords' THEN 'no coordinates' WHEN s = 'no_recognised_matrix' THEN 'no matrix found' ELSE 'read error' END WHEN k THEN 'excluded' ELSE 'in atlas' END AS b FROM d)
      SELECT technology, count(*) FILTER (b = 'in atlas') AS "in atlas", count(*) FILTER (b = 'no coordinates') AS "no coordinates", count(*) FILTER (b = 'no matrix found') AS "no matrix found", count(*) FILTER (b = 'read error') AS "read error", count(*) FILTER (b = 'excluded') AS excluded, count(*) AS total FROM b GROUP BY 1""",
    "loaders": f"""WITH f AS (SELECT sample_id, url, {_LOAD} AS r FROM files WHERE url IS NOT NULL AND sample_id IS NOT NULL), w AS (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY r, contains(url, 'raw_feature'), len(string_split(url, '/')), url) AS o FROM f)
      SELECT sample_id, n AS n_files, ['h5ad', '10x_h5', 'xenium_zarr', 'mtx_trio', 'csv_matrix', 'feature_slice', 'seurat_rds'][r + 1] AS loader, CASE WHEN r < 99 THEN url END AS file, CASE WHEN r = 99 THEN 'no_recognised_matrix' ELSE 'ok' END AS status FROM w WHERE o = 1""",
}
