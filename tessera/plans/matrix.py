"""Queries on sparse matrices. Orders stand for cells, line items for stored entries, parts for genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import matrix as M
from tessera.sources.tables import table


def _obs(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(F.col("o_orderstatus").alias("sample"), F.col("o_orderkey").alias("cell"))


def _entries(spark, folder, value="l_quantity") -> DataFrame:
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene"), F.col(value).alias("value"))


def qc_per_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Quality figures per sample."""
    return M.qc_per_sample(_obs(spark, folder), _entries(spark, folder))


def qc_zero_rows(spark, folder):
    """Cells without entries."""
    return M.zero_rows(_obs(spark, folder), _entries(spark, folder))


def qc_gene_detection(spark, folder):
    """Detection of each gene of the axis."""
    return M.gene_detection(table(spark, folder, "part").select(F.col("p_partkey").alias("gene")), _entries(spark, folder))


def prefix_fraction(spark, folder):
    """Share of a cell's counts on genes of one name prefix."""
    return M.prefix_share(_entries(spark, folder), table(spark, folder, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("name")), "Brand#1")


def _three(spark, folder) -> DataFrame:
    li = table(spark, folder, "lineitem")
    cust = table(spark, folder, "customer")
    parts = [li.select(F.lit(c).alias("matrix"), F.col("l_orderkey").alias("cell"), F.col("l_partkey").alias("gene"), F.col(c).alias("value")) for c in ("l_quantity", "l_extendedprice", "l_discount")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(cust.select(F.lit("c_acctbal").alias("matrix"), F.col("c_custkey").alias("cell"), F.col("c_nationkey").cast("bigint").alias("gene"), F.col("c_acctbal").alias("value")))


def matrix_kind(spark, folder):
    """What kind of values four matrices hold."""
    return M.matrix_kind(_three(spark, folder))


def matrix_recoverable(spark, folder):
    """Whether counts can be had back, by kind."""
    known = F.create_map(*[F.lit(x) for kv in M.RECOVERABLE.items() for x in kv])
    return M.matrix_kind(_three(spark, folder)).select("matrix", "kind", F.coalesce(known[F.col("kind")], F.lit("unknown")).alias("recoverable"))


def counts_recover(spark, folder):
    """Per-gene lattice of the values."""
    return M.counts_recover(_three(spark, folder))


def marker_call(spark, folder):
    """Call by two marker families (brands of parts stand for genes)."""
    li = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    entries = li.select(F.col("l_suppkey").alias("sample"), F.col("p_brand").alias("gene"), F.col("l_quantity").alias("value"))
    var = entries.select("sample", "gene").distinct().withColumn("ordinal", F.lit(1))
    return M.marker_call(entries, var, ["BRAND#11"], ["BRAND#21", "BRAND#22", "BRAND#23"], ["BRAND#31"], ("first", "second"), ratio=5.0)


def log_normalised(spark, folder):
    """counts scaled to one total and log-transformed."""
    return M.log_normalise(_entries(spark, folder))


QUERIES = {f.__name__: f for f in (qc_per_sample, qc_zero_rows, qc_gene_detection, prefix_fraction, matrix_kind, matrix_recoverable, counts_recover, marker_call, log_normalised)}

_CELLS = """
  s AS (SELECT l_orderkey AS cell, l_partkey AS gene, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
  c AS (SELECT o_orderstatus AS sample, o_orderkey AS cell, coalesce(t.total, 0) AS total, coalesce(t.detected, 0) AS detected
        FROM orders LEFT JOIN (SELECT cell, sum(v) AS total, count(*) FILTER (v > 0) AS detected FROM s GROUP BY 1) t ON o_orderkey = t.cell)"""
_FOUR = " UNION ALL ".join(f"SELECT '{c}' AS matrix, l_orderkey AS cell, l_partkey AS gene, {c} AS value FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount")) + " UNION ALL SELECT 'c_acctbal', c_custkey, c_nationkey, c_acctbal FROM customer"
_KIND = f"""
  WITH e AS ({_FOUR}), r AS (SELECT matrix, cell, sum(value) AS s FROM e GROUP BY 1, 2),
  cv AS (SELECT matrix, count(s) AS n, stddev_pop(s) / greatest(avg(s), 1e-9) AS cv FROM r WHERE s > 0 GROUP BY 1),
  m AS (SELECT matrix, count(*) AS n_vals, min(value) AS lo, max(value) AS hi, avg(CASE WHEN value < 0 THEN 1.0 ELSE 0 END) AS neg,
        bool_and(abs(value - round_even(value, 0)) <= 1e-8 + 1e-5 * abs(round_even(value, 0))) AS whole FROM e GROUP BY 1)
  SELECT matrix, CASE WHEN neg > 0 THEN 'scaled' WHEN whole THEN 'raw_counts' WHEN n > 5 AND cv < 0.01 THEN 'normalised' WHEN hi <= 20 THEN 'log1p' ELSE 'other' END AS kind,
    n_vals, round(lo, 6) AS min, round(hi, 6) AS max, round(neg, 6) AS frac_negative, whole AS is_integer FROM m LEFT JOIN cv USING (matrix)"""
SQL = {
    "qc_per_sample": f"""WITH {_CELLS},
      g AS (SELECT o_orderstatus AS sample, count(DISTINCT l_partkey) AS n_genes, bool_and(l_quantity = round(l_quantity)) AS is_integer FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
      SELECT sample, count(*) AS n_cells, round(quantile_cont(total, 0.5), 6) AS median_counts, round(quantile_cont(CAST(detected AS DOUBLE), 0.5), 6) AS median_genes, round(avg(total), 6) AS mean_counts,
        round(avg(CASE WHEN total = 0 THEN 1.0 ELSE 0 END), 6) AS frac_zero_cells, round(avg(CASE WHEN total < 10 THEN 1.0 ELSE 0 END), 6) AS frac_low_cells, any_value(n_genes) AS n_genes, any_value(is_integer) AS is_integer
      FROM c JOIN g USING (sample) GROUP BY sample""",
    "qc_zero_rows": "SELECT o_orderstatus AS sample, count(*) AS zero_cells FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY 1",
    "qc_gene_detection": "SELECT p_partkey AS gene, count(DISTINCT l_orderkey) FILTER (l_quantity > 0) AS n_cells, round(coalesce(sum(l_quantity), 0), 6) AS total FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY 1",
    "prefix_fraction": "SELECT l_orderkey AS cell, round(sum(CASE WHEN starts_with(p_brand, 'Brand#1') THEN l_quantity ELSE 0 END) * 100 / sum(l_quantity), 6) AS pct FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1",
    "matrix_kind": _KIND,
    "matrix_recoverable": f"SELECT matrix, kind, CASE kind WHEN 'raw_counts' THEN 'yes' WHEN 'log1p' THEN 'yes_expm1' WHEN 'empty' THEN 'unknown' ELSE 'no' END AS recoverable FROM ({_KIND})",
    "counts_recover": f"""WITH e AS ({_FOUR}),
      o AS (SELECT matrix, round(avg(CASE WHEN abs(value - round_even(value, 0)) < 1e-6 THEN 1.0 ELSE 0 END), 6) AS frac_integer, bool_or(value < 0) AS has_negative FROM e GROUP BY 1),
      z AS (SELECT matrix, gene, count(*) FILTER (value > 0) AS n, min(value) FILTER (value > 0) AS u, row_number() OVER (PARTITION BY matrix ORDER BY count(*) DESC, gene) AS r FROM e WHERE value <> 0 GROUP BY 1, 2),
      f AS (SELECT e.matrix, e.gene, avg(CASE WHEN abs(value / u - round_even(value / u, 0)) < 1e-5 THEN 1.0 ELSE 0 END) AS fit FROM e JOIN z ON e.matrix = z.matrix AND e.gene = z.gene WHERE value > 0 AND r <= 400 AND n >= 5 GROUP BY 1, 2),
      l AS (SELECT matrix, round(quantile_cont(fit, 0.5), 6) AS gene_lattice FROM f GROUP BY 1)
      SELECT matrix, frac_integer, has_negative, gene_lattice, CASE WHEN has_negative THEN 'not_recoverable' WHEN frac_integer > 0.99 THEN 'counts' WHEN gene_lattice > 0.95 THEN 'fractional' ELSE 'not_recoverable' END AS verdict FROM o LEFT JOIN l USING (matrix)""",
    "marker_call": """WITH e AS (SELECT l_suppkey AS sample, upper(p_brand) AS gene, sum(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
      s AS (SELECT sample, sum(v) AS total, count(*) FILTER (gene = 'BRAND#11') AS nx, count(*) FILTER (gene IN ('BRAND#21', 'BRAND#22', 'BRAND#23', 'BRAND#31')) AS ny,
        coalesce(sum(v) FILTER (gene = 'BRAND#11'), 0) * 1e6 / sum(v) AS x, coalesce(sum(v) FILTER (gene IN ('BRAND#21', 'BRAND#22', 'BRAND#23', 'BRAND#31')), 0) * 1e6 / sum(v) AS y,
        count(*) FILTER (gene IN ('BRAND#21', 'BRAND#22', 'BRAND#23') AND v > 0) AS core FROM e GROUP BY 1)
      SELECT sample, CASE WHEN nx = 0 AND ny = 0 THEN 'unknown' WHEN greatest(x, y) < 3 THEN 'unknown'
        WHEN nx = 0 OR ny = 0 THEN CASE WHEN ny > 0 AND y >= 3 AND core >= 2 THEN 'second' WHEN nx > 0 AND x >= 3 THEN 'first' ELSE 'unknown' END
        WHEN y >= 3 AND y > 5 * greatest(x, 0.1) THEN CASE WHEN core >= 2 THEN 'second' ELSE 'unknown' END
        WHEN x >= 3 AND x > 5 * greatest(y, 0.1) THEN 'first' ELSE 'unknown' END AS call, round(x, 6) AS x_cpm, round(y, 6) AS y_cpm, core AS core_seen FROM s""",
    "log_normalised": "SELECT l_orderkey AS cell, l_partkey AS gene, round(ln(1 + l_quantity * 10000 / sum(l_quantity) OVER (PARTITION BY l_orderkey)), 6) AS value FROM lineitem",
}
