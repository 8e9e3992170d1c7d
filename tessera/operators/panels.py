"""Gene panels as sets: identity, containment, cohorts, shared genes, measurable pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.names import is_control

#: Most panels that the sequential pass over cohorts takes to the driver (a corpus has far fewer different panels).
MOST_PANELS = 100_000


def panel_id(genes: Column) -> Column:
    """Identity of a gene set whatever its order and case; control probes and blanks left out."""
    kept = F.filter(F.transform(F.filter(genes, lambda g: ~is_control(g)), lambda g: F.upper(F.trim(g))), lambda g: g != "")
    return F.substring(F.sha1(F.array_join(F.array_sort(F.array_distinct(kept)), "\n")), 1, 12)


def panel_key(genes: Column) -> Column:
    """Identity by the names as they are, controls included."""
    return F.substring(F.md5(F.array_join(F.array_sort(F.array_distinct(genes)), "|")), 1, 12)


def panels(entries: DataFrame) -> DataFrame:
    """Rows (sample, panel, n_genes) from (sample, gene)."""
    g = entries.groupBy("sample").agg(F.collect_set("gene").alias("genes"))
    return g.select("sample", panel_id(F.col("genes")).alias("panel"), panel_key(F.col("genes")).alias("key"), F.size("genes").alias("n_genes"))


def members(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, genes): panel of each sample, and the genes of each different panel."""
    p = panels(entries).select("sample", "panel")
    first = p.groupBy("panel").agg(F.min("sample").alias("sample"))
    return p, entries.join(first, "sample").select("panel", "gene").distinct()


def containment(genes: DataFrame, seeds: DataFrame | None = None, min_share: float = 0.0) -> DataFrame:
    """Rows (seed, panel, share): the part of the seed's genes that another panel holds. Different panels only.

    With ``min_share`` only pairs of at least that share are made: such a panel holds one at least of the seed's rarest
    genes, as many as the share lets it lack and one more, so candidates are joined by these alone and then counted.
    Without it every pair with a common gene is a row of the result.
    """
    size = genes.groupBy("panel").agg(F.count("*").alias("n"))
    s = genes if seeds is None else genes.join(seeds, "panel", "left_semi")
    s = s.withColumnRenamed("panel", "seed")
    if min_share <= 0:
        both = s.join(genes, "gene").where("seed <> panel").groupBy("seed", "panel").agg(F.count("*").alias("both"))
    else:
        used = genes.groupBy("gene").agg(F.count("*").alias("used"))
        rarest = F.row_number().over(Window.partitionBy("seed").orderBy("used", "gene"))
        sized = s.join(used, "gene").join(size.withColumnRenamed("panel", "seed"), "seed").withColumn("r", rarest)
        rare = sized.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * min_share - 1e-9) + 1).select("seed", "gene")
        pairs = rare.join(genes, "gene").where("seed <> panel").select("seed", "panel").distinct()
        both = pairs.join(s, "seed").join(genes, ["panel", "gene"], "left_semi").groupBy("seed", "panel").agg(F.count("*").alias("both"))
    out = both.join(size.withColumnRenamed("panel", "seed"), "seed").where(F.col("both") >= F.col("n") * min_share - 1e-9)
    return out.select("seed", "panel", F.round(F.col("both") / F.col("n"), 6).alias("share"))


def cohorts(samples: DataFrame, genes: DataFrame, min_share: float = 0.9, min_samples: int = 20) -> DataFrame:
    """Greedy cohorts (technology, cohort_seed, n_panels, n_samples, seed_genes) of samples (sample, technology, panel).

    Technologies are taken in order; the seeds of one are its panels of ``min_samples`` samples, largest gene set first
    (ties by panel); members are its panels that no cohort of any technology has taken and that hold ``min_share`` of
    the seed. The pass is sequential by definition: the panels' sizes and the pairs above the share (one row a pair of
    a seed and a panel, not a sample) go to the driver, ``MOST_PANELS`` panels at most.
    """
    size = {r.panel: r.n for r in genes.groupBy("panel").agg(F.count("*").alias("n")).limit(MOST_PANELS + 1).toLocalIterator()}
    if len(size) > MOST_PANELS:
        raise ValueError(f"more than {MOST_PANELS} different panels")
    used = samples.groupBy("technology", "panel").agg(F.count("*").alias("n"))
    near: dict[str, list[str]] = {}
    for r in containment(genes, used.where(F.col("n") >= min_samples).select("panel").distinct(), min_share).toLocalIterator():
        near.setdefault(r.seed, []).append(r.panel)
    count: dict[str, dict[str, int]] = {}
    for r in used.where("technology IS NOT NULL").orderBy("technology").toLocalIterator():
        count.setdefault(r.technology, {})[r.panel] = r.n
    taken: set[str] = set()
    rows = []
    for technology, of in count.items():
        for seed in sorted((p for p, n in of.items() if n >= min_samples and p in size), key=lambda p: (-size[p], p)):
            if seed in taken:
                continue
            group = [seed, *(p for p in near.get(seed, []) if p not in taken and p in of)]
            taken.update(group)
            rows.append((technology, seed, len(group), sum(of[p] for p in group), size[seed]))
    return samples.sparkSession.createDataFrame(rows, "technology string, cohort_seed string, n_panels int, n_samples bigint, seed_genes bigint")


def seed_cohort(samples: DataFrame, genes: DataFrame, group: str, min_share: float = 0.9) -> DataFrame:
    """Per group the commonest panel as seed (ties by panel) and how many samples' panels hold enough of it."""
    n = samples.groupBy(group, "panel").agg(F.count("*").alias("n"))
    seed = n.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "panel"))).where("r = 1").select(group, F.col("panel").alias("seed"))
    share = containment(genes, seed.select(F.col("seed").alias("panel")).distinct())
    j = n.join(seed, group).join(share, ["seed", "panel"], "left").withColumn("in", (F.col("panel") == F.col("seed")) | (F.coalesce("share", F.lit(0.0)) >= min_share))
    take = F.when(F.col("in"), F.col("n")).otherwise(0)
    return j.groupBy(group, "seed").agg(F.count_if(F.col("in")).alias("n_panels"), F.sum(take).alias("n_samples"), (F.sum("n") - F.sum(take)).alias("n_excluded"))


def shared_genes(entries: DataFrame) -> DataFrame:
    """Genes that every sample has."""
    n = entries.agg(F.count_distinct("sample").alias("all"))
    g = entries.groupBy("gene").agg(F.count_distinct("sample").alias("n"))
    return g.join(n, g["n"] == n["all"]).select("gene")


def outer_matrix(entries: DataFrame, samples: list) -> DataFrame:
    """Gene by sample totals in which a gene that a sample does not measure is null, never 0."""
    return entries.groupBy("gene").pivot("sample", samples).agg(F.sum("value"))


def pair_coverage(entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per sample the pairs (a, b) of which both genes are in its panel."""
    e = entries.select("sample", "gene").distinct()
    a = e.join(pairs, F.col("gene") == F.col("a")).select("sample", "a", "b")
    both = a.join(e.withColumnRenamed("gene", "b"), ["sample", "b"], "left_semi")
    n = both.groupBy("sample").agg(F.count("*").alias("n_pairs"))
    return e.select("sample").distinct().join(n, "sample", "left").select("sample", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))


def pooled_panel(entries: DataFrame, group: str) -> DataFrame:
    """Per group the genes that any of its panels holds, with how many panels hold them."""
    return entries.groupBy(group, "gene").agg(F.count_distinct("sample").alias("panels"))
