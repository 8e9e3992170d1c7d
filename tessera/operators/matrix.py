"""Quality figures and classifications of sparse matrices in long form (one row per stored entry).

Cells or genes without entries are rows of the axis tables only; every operator that counts them takes the axis.
Repeated entries of a (cell, gene) are summed first. All are two-level aggregations with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND = 6


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), ROUND)


def per_cell(obs: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows (sample, cell, total, detected) for every cell of ``obs`` (sample, cell), with 0 where nothing is stored."""
    sums = entries.groupBy("cell", "gene").agg(F.sum("value").alias("value")).groupBy("cell").agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("detected"))
    return obs.join(sums, "cell", "left").select("sample", "cell", F.coalesce("total", F.lit(0)).cast("double").alias("total"), F.coalesce("detected", F.lit(0)).alias("detected"))


def qc_per_sample(obs: DataFrame, entries: DataFrame) -> DataFrame:
    """Per sample: cells, genes, median counts and genes of a cell, share of empty cells, share of cells under 10
    counts, and whether all stored values are whole numbers."""
    cells = per_cell(obs, entries).groupBy("sample").agg(
        F.count("*").alias("n_cells"), r6(F.percentile("total", F.lit(0.5))).alias("median_counts"), r6(F.percentile("detected", F.lit(0.5))).alias("median_genes"),
        r6(F.avg("total")).alias("mean_counts"), r6(F.avg((F.col("total") == 0).cast("int"))).alias("frac_zero_cells"), r6(F.avg((F.col("total") < 10).cast("int"))).alias("frac_low_cells"),
    )
    genes = obs.join(entries, "cell").groupBy("sample", "gene").agg(F.bool_and(F.col("value") == F.rint("value")).alias("whole")).groupBy("sample").agg(F.count("*").alias("n_genes"), F.bool_and("whole").alias("is_integer"))
    return cells.join(genes, "sample", "left").withColumn("n_genes", F.coalesce("n_genes", F.lit(0)))


def zero_rows(obs: DataFrame, entries: DataFrame) -> DataFrame:
    """Cells of each sample that hold nothing."""
    return obs.join(entries.select("cell"), "cell", "left_anti").groupBy("sample").agg(F.count("*").alias("zero_cells"))


def gene_detection(var: DataFrame, entries: DataFrame) -> DataFrame:
    """Per gene of the axis ``var`` (gene): cells in which it is seen and its total."""
    sums = entries.groupBy("gene", "cell").agg(F.sum("value").alias("value")).groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("n_cells"), F.sum("value").alias("total"))
    return var.join(sums, "gene", "left").select("gene", F.coalesce("n_cells", F.lit(0)).alias("n_cells"), r6(F.coalesce("total", F.lit(0))).alias("total"))


def prefix_share(entries: DataFrame, names: DataFrame, prefix: str) -> DataFrame:
    """Per cell the percentage of its counts on genes whose name (gene, name) begins with ``prefix``."""
    marked = entries.join(names, "gene").withColumn("hit", F.when(F.col("name").startswith(prefix), F.col("value")).otherwise(0))
    return marked.groupBy("cell").agg(r6(F.sum("hit") * 100 / F.sum("value")).alias("pct"))


def whole(v: Column) -> Column:
    """Whether a value is a whole number within the usual tolerance of array comparison."""
    near = F.rint(v)
    return F.abs(v - near) <= 1e-8 + 1e-5 * F.abs(near)


def matrix_kind(entries: DataFrame) -> DataFrame:
    """Per matrix (matrix, cell, value): scaled, raw_counts, normalised, log1p, other or empty, with its evidence.

    Negative values mean scaled; only whole numbers, raw counts; a coefficient of variation of the positive row
    sums under 0.01 (of more than 5 rows), normalised; a maximum of 20 at most, log1p. All rows are used.
    """
    v = F.col("value").cast("double")
    rows = entries.groupBy("matrix", "cell").agg(
        F.sum(v).alias("s"), F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.count_if(v < 0).alias("neg"), F.bool_and(whole(v)).alias("whole")
    )
    ok = F.when((F.col("s") > 0) & (F.col("s") < float("inf")), F.col("s"))
    m = rows.groupBy("matrix").agg(
        F.sum("n").alias("n_vals"), F.min("lo").alias("min"), F.max("hi").alias("max"), (F.sum("neg") / F.sum("n")).alias("frac_negative"), F.bool_and("whole").alias("is_integer"),
        F.count(ok).alias("n_rows"), (F.stddev_pop(ok) / F.greatest(F.avg(ok), F.lit(1e-9))).alias("cv"),
    )
    kind = (
        F.when(F.col("n_vals") == 0, "empty").when(F.col("frac_negative") > 0, "scaled").when(F.col("is_integer"), "raw_counts")
        .when((F.col("n_rows") > 5) & (F.col("cv") < 0.01), "normalised").when(F.col("max") <= 20, "log1p").otherwise("other")
    )
    return m.select("matrix", kind.alias("kind"), "n_vals", r6(F.col("min")).alias("min"), r6(F.col("max")).alias("max"), r6(F.col("frac_negative")).alias("frac_negative"), "is_integer")


#: Whether counts can be had back from each kind of matrix.
RECOVERABLE = {"raw_counts": "yes", "log1p": "yes_expm1", "normalised": "no", "other": "no", "scaled": "no"}


def counts_recover(entries: DataFrame, least: int = 5, genes: int = 400) -> DataFrame:
    """Per matrix (matrix, gene, value): counts, fractional or not_recoverable.

    Of the ``genes`` most frequent genes (ties by gene) with ``least`` positive values each, the share of values that
    are whole multiples of the gene's smallest; its median above 0.95 means that counts were divided. The smallest
    value per gene is joined back by (matrix, gene), an aggregate far smaller than the entries.
    """
    from pyspark.sql.window import Window

    e = entries.select("matrix", "gene", F.col("value").cast("double").alias("value"))
    overall = e.groupBy("matrix").agg(r6(F.avg((F.abs(F.col("value") - F.rint("value")) < 1e-6).cast("int"))).alias("frac_integer"), F.bool_or(F.col("value") < 0).alias("has_negative"))
    size = e.where("value <> 0").groupBy("matrix", "gene").agg(F.count("*").alias("stored"), F.count_if(F.col("value") > 0).alias("n"), F.min(F.when(F.col("value") > 0, F.col("value"))).alias("u"))
    top = size.withColumn("rank", F.row_number().over(Window.partitionBy("matrix").orderBy(F.desc("stored"), "gene"))).where((F.col("rank") <= genes) & (F.col("n") >= least))
    q = F.col("value") / F.col("u")
    fits = e.where("value > 0").join(top.select("matrix", "gene", "u"), ["matrix", "gene"]).groupBy("matrix", "gene").agg(F.avg((F.abs(q - F.rint(q)) < 1e-5).cast("int")).alias("fit"))
    lattice = fits.groupBy("matrix").agg(r6(F.percentile("fit", F.lit(0.5))).alias("gene_lattice"))
    verdict = F.when(F.col("has_negative"), "not_recoverable").when(F.col("frac_integer") > 0.99, "counts").when(F.col("gene_lattice") > 0.95, "fractional").otherwise("not_recoverable")
    return overall.join(lattice, "matrix", "left").withColumn("verdict", verdict)


#: Genes that tell the sex of a donor.
XIST = ["XIST", "TSIX"]
CHRY_CORE = ["DDX3Y", "KDM5D", "ZFY", "UTY", "USP9Y", "EIF1AY", "NLGN4Y"]
CHRY_EXTRA = ["PRKY", "TMSB4Y", "RPS4Y1"]


def marker_call(entries: DataFrame, var: DataFrame, first: list[str] = XIST, core: list[str] = CHRY_CORE, extra: list[str] = CHRY_EXTRA, calls: tuple[str, str] = ("female", "male"), min_cpm: float = 3.0, ratio: float = 5.0, min_core: int = 2) -> DataFrame:
    """Call per sample by two families of marker genes, in counts per million.

    ``entries``: sample, gene, value; ``var``: sample, ordinal, gene (the panel, of which the first of equal names
    in upper case counts). The second family calls only with ``min_core`` core genes seen; a family missing from the
    panel is unknown, not zero; a call needs ``min_cpm`` and ``ratio`` times the other family (0.1 at least).
    """
    named = var.withColumn("up", F.upper("gene")).groupBy("sample", "up").agg(F.min_by("gene", "ordinal").alias("gene"))
    family = F.when(F.col("up").isin(*first), "x").when(F.col("up").isin(*core), "core").when(F.col("up").isin(*extra), "extra")
    panel = named.withColumn("family", family).where("family IS NOT NULL")
    total = entries.groupBy("sample").agg(F.sum("value").alias("total"))
    seen = panel.join(entries.groupBy("sample", "gene").agg(F.sum("value").alias("v")), ["sample", "gene"], "left")
    is_x, v = F.col("family") == "x", F.coalesce("v", F.lit(0))
    s = seen.groupBy("sample").agg(
        F.count_if(is_x).alias("n_x"), F.count_if(~is_x).alias("n_y"), F.sum(F.when(is_x, v).otherwise(0)).alias("cx"), F.sum(F.when(~is_x, v).otherwise(0)).alias("cy"),
        F.count_if((F.col("family") == "core") & (v > 0)).alias("core_seen"),
    )
    out = total.join(s, "sample", "left").na.fill(0, ["n_x", "n_y", "cx", "cy", "core_seen"])
    per = F.lit(1e6) / F.when(F.col("total") == 0, 1.0).otherwise(F.col("total"))
    out = out.withColumns({"x_cpm": F.col("cx") * per, "y_cpm": F.col("cy") * per})
    x, y, strong = F.col("x_cpm"), F.col("y_cpm"), F.col("core_seen") >= min_core
    call = (
        F.when((F.col("n_x") == 0) & (F.col("n_y") == 0), "unknown")
        .when(F.greatest(x, y) < min_cpm, "unknown")
        .when((F.col("n_x") == 0) | (F.col("n_y") == 0), F.when((F.col("n_y") > 0) & (y >= min_cpm) & strong, calls[1]).when((F.col("n_x") > 0) & (x >= min_cpm), calls[0]).otherwise("unknown"))
        .when((y >= min_cpm) & (y > ratio * F.greatest(x, F.lit(0.1))), F.when(strong, calls[1]).otherwise("unknown"))
        .when((x >= min_cpm) & (x > ratio * F.greatest(y, F.lit(0.1))), calls[0])
        .otherwise("unknown")
    )
    return out.select("sample", call.alias("call"), r6(x).alias("x_cpm"), r6(y).alias("y_cpm"), "core_seen")


def log_normalise(entries: DataFrame, target: float = 1e4) -> DataFrame:
    """Entries (cell, gene, value) scaled to ``target`` counts a cell and log1p-transformed."""
    total = entries.groupBy("cell").agg(F.sum("value").alias("total"))
    return entries.join(total, "cell").where("total > 0").select("cell", "gene", r6(F.log1p(F.col("value") * target / F.col("total"))).alias("value"))
