"""Standing checks: species, integrity audit, cross-check, consistency review, readiness. Rules in fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND = 6
# Shapes of gene names and columns that are no genes.
UPPER = r"^[A-Z][A-Z0-9\-]{1,}$"
TITLE = r"^[A-Z][a-z]{2,}[0-9A-Za-z\-]*$"
UPPER_STRICT = r"^[A-Z][A-Z0-9\-\.]{1,14}$"
TITLE_STRICT = r"^[A-Z][a-z0-9]{1,13}[0-9a-z]$"
SYMBOL = r"^[A-Za-z][A-Za-z0-9\-\.@_]{0,29}$"
ENSEMBL = r"^ENSG\d{11}"
IDENTIFIERS = ["fov", "cell_id", "cell", "cellid", "cell_index", "barcode", "cell_barcode", "x", "y", "x_global_px", "y_global_px", "area", "width", "height"]


def species(genes: DataFrame, first: int = 4000) -> DataFrame:
    """Rows (sample, species) from gene names (sample, ordinal, gene): identifiers decide if there are ten, else the
    casing of symbols; small panels (under 30 symbols) must be purer. Null where the names do not settle it."""
    g = F.upper("gene")
    is_m, is_h = g.startswith("ENSMUS"), g.startswith("ENSG")
    sym = ~(is_m | is_h)
    c = genes.where(F.col("ordinal") <= first).groupBy("sample").agg(
        F.count_if(is_h).alias("h"), F.count_if(is_m).alias("m"), F.count_if(sym & F.col("gene").rlike(UPPER_STRICT)).alias("up"), F.count_if(sym & F.col("gene").rlike(TITLE_STRICT)).alias("ti")
    )
    ids, sy = F.col("h") + F.col("m"), F.col("up") + F.col("ti")
    need = F.when(sy >= 30, 0.8).otherwise(0.95)
    frac, mouse = F.col("h") / ids, F.try_divide(F.col("ti"), sy)
    by_id = F.when(F.try_divide(F.col("h"), ids) >= 0.95, "homo_sapiens").when(F.try_divide(F.col("h"), ids) <= 0.05, "mus_musculus")
    by_case = F.when(sy < 10, None).when(mouse > need, "mus_musculus").when(mouse < 1 - need, "homo_sapiens")
    return c.select("sample", F.when(ids >= 10, by_id).otherwise(by_case).alias("species"))


def audit(axes: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows (sample, n_var, problem) per sample of ``axes`` (sample): the first rule that its gene axis breaks.

    Empty axis; identifiers among genes; less than half of the first 500 names look like genes; mouse-like symbols
    among the first 600 (a small panel must be purer to be called); else an empty problem.
    """
    low = F.lower(F.trim("gene"))
    like = F.col("gene").rlike(SYMBOL) | F.col("gene").rlike(ENSEMBL)
    head, sym = F.col("ordinal") <= 500, ~(F.col("gene").startswith("ENSG") | F.col("gene").startswith("ENSMUS")) & (F.col("ordinal") <= 600)
    c = genes.groupBy("sample").agg(
        F.count("*").alias("n_var"), F.count_if(low.isin(*IDENTIFIERS)).alias("ids"), F.avg(F.when(head, like.cast("int"))).alias("like"), F.avg(F.when(head, F.col("gene").rlike(r"^\d+$").cast("int"))).alias("digits"),
        F.count_if(sym & F.col("gene").rlike(UPPER)).alias("up"), F.count_if(sym & F.col("gene").rlike(TITLE)).alias("ti"),
    )
    n = F.col("up") + F.col("ti")
    mouse = F.try_divide(F.col("ti"), n)
    problem = (
        F.when(F.col("n_var").isNull(), "empty_gene_axis").when(F.col("ids") > 0, "identifier_as_gene")
        .when(F.col("like") < 0.5, F.concat(F.lit("var_axis_not_genes: "), F.when(F.col("digits") > 0.5, "positional_integers").otherwise("unrecognised")))
        .when((n >= 10) & (mouse > F.when(n >= 30, 0.8).otherwise(0.95)), "not_human").when((n >= 30) & (mouse > 0.2), "mixed_species").otherwise("")
    )
    return axes.join(c, "sample", "left").select("sample", F.coalesce("n_var", F.lit(0)).alias("n_var"), problem.alias("problem"))


def rule_columns(rules: list[tuple[str, Column]]) -> Column:
    """Messages of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(c, m) for m, c in rules]), lambda x: x.isNotNull())


def crosscheck(df: DataFrame) -> DataFrame:
    """Issues of a manifest row against its file's facts, joined by ' | ', the first as the row's issue.

    Columns: sample, technology, n_cells, n_genes, n_obs, n_vars, species, frac_mouse, n_symbols, sex, inferred_sex,
    frac_known, has_spatial, spatial_ok.
    """
    c = F.col
    far = lambda a, b: (c(b) > 0) & (F.abs(c(a) - c(b)) / F.greatest(c(b), F.lit(1)) > 0.02)
    most = F.coalesce(*[F.when(c("technology") == t, n) for t, n in (("Xenium", 6000), ("CosMx", 21000), ("MERFISH", 2000), ("STARmap", 2000), ("seqFISH", 2000))])  # fixed values
    wide = c("technology").isin("Visium", "Visium HD", "Stereo-seq", "Slide-seq")
    known = lambda x: c(x).isin("male", "female")
    rules = [
        ("cells_mismatch", far("n_cells", "n_obs")), ("genes_mismatch", far("n_genes", "n_vars")),
        ("species: mouse symbols", (c("frac_mouse") > F.when(c("n_symbols") >= 30, 0.8).otherwise(0.95)) & ~F.coalesce(c("species"), F.lit("")).contains("mus")), ("species: human symbols", (c("frac_mouse") < 0.2) & (c("species") == "mus_musculus")),
        ("sex", known("sex") & known("inferred_sex") & (c("sex") != c("inferred_sex"))), ("panel: too many genes", c("n_vars") > most), ("panel: too few genes", wide & (c("n_vars") < 5000)),
        ("not_genes", (c("frac_known") < 0.5) & (c("n_vars") >= 20)), ("spatial: no coordinates", ~c("has_spatial")), ("spatial: degenerate", c("has_spatial") & ~c("spatial_ok")),
    ]
    issues = rule_columns(rules)
    return df.withColumn("i", issues).select("sample", F.coalesce(F.split(F.try_element_at("i", F.lit(1)), ":")[0], F.lit("")).alias("issue"), F.array_join("i", " | ").alias("detail"))


def readiness(df: DataFrame) -> DataFrame:
    """Verdict on a sample's fitness for pair analysis, with reasons.

    Columns: sample, n_units, n_genes, n_pairs, is_counts, geometry ('ok', 'wrong unit', else a fault).
    """
    c = F.col
    whole = c("n_genes") > 15_000
    rules = [
        ("not integer counts", ~c("is_counts")), ("no coordinates", c("geometry") == "missing"), ("coordinates degenerate", c("geometry") == "degenerate"), ("not microns", c("geometry") == "wrong unit"),
        ("implausible scale", c("geometry") == "implausible"), ("only few pairs of the transcriptome", whole & (c("n_pairs") < 50)), ("only few pairs", ~whole & (c("n_pairs") < 5)), ("only few units", (c("n_units") > 0) & (c("n_units") < 200)),
    ]
    bad = rule_columns(rules)
    care = F.forall("bad", lambda x: x.contains("not integer") | x.contains("only"))
    verdict = F.when(F.size("bad") == 0, "ready").when(F.exists("bad", lambda x: x.contains("not microns")), "fixable_rescale").when(care, "usable_with_care").otherwise("not_ready")
    return df.withColumn("bad", bad).select("sample", F.when(whole, "whole_transcriptome").otherwise("targeted").alias("panel_class"), verdict.alias("verdict"), F.array_join("bad", " | ").alias("reasons"))


def axis_review(names: DataFrame) -> DataFrame:
    """Per sample dialect of its gene names, share of repeated names, errors and warnings."""
    g = F.col("gene")
    one = names.groupBy("sample", "gene").agg(F.count("*").alias("n"))
    c = one.groupBy("sample").agg(
        F.sum("n").alias("n"), F.count("*").alias("d"), *[F.sum(F.when(x, F.col("n")).otherwise(0)).alias(a) for a, x in (("ens", g.rlike(ENSEMBL)), ("pos", g.rlike(r"^\d+$")), ("sym", g.rlike(SYMBOL) & ~g.rlike(ENSEMBL)))]
    )
    share = lambda a: F.col(a) / F.col("n")
    dup = 1 - F.col("d") / F.col("n")
    dialect = F.when(share("ens") > 0.5, "ensembl").when(share("pos") > 0.5, "positional").when(share("sym") > 0.5, "symbol").otherwise("mixed")
    c = c.withColumns({"dialect": dialect, "dup_frac": F.round(dup, 4)})
    errors = rule_columns([("var axis is positional integers, not gene identity", share("pos") > 0.5)])
    warnings = rule_columns([("duplicate gene names", F.col("dup_frac") > 0.01), ("mixed gene identifier dialects on one axis", F.col("dialect") == "mixed")])
    return c.select("sample", "dialect", "dup_frac", F.array_join(errors, " | ").alias("errors"), F.array_join(warnings, " | ").alias("warnings"))


def split_fields(df: DataFrame, fields: list[str], universal: float = 0.99) -> DataFrame:
    """Per field its majority value with share, and the next five values, where the majority is not universal."""
    from pyspark.sql.window import Window

    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("(absent)")).alias("value")) for f in fields])).alias("x")).select("x.*")
    n = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    by = Window.partitionBy("field")
    r = n.withColumn("r", F.row_number().over(by.orderBy(F.desc("n"), "value"))).withColumn("share", F.col("n") / F.sum("n").over(by))
    top = r.where("r = 1").where(F.col("share") < universal).select("field", F.col("value").alias("majority"), F.round("share", 3).alias("majority_share"))
    rest = r.where("r BETWEEN 2 AND 6").groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "value"))), lambda x: x["value"]), ", ").alias("minority"))
    return top.join(rest, "field", "left")


def column_coverage(df: DataFrame, col: str, universal: float = 0.99, partial: float = 0.01, most: int = 25) -> DataFrame:
    """Names in a packed list: share of rows that have each, and whether that is universal or partial."""
    n = df.count()
    c = df.select(F.explode(F.array_distinct(F.filter(F.split(F.coalesce(F.col(col), F.lit("")), ";"), lambda x: x != ""))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    c = c.withColumn("share", F.col("n") / F.lit(max(n, 1)))
    kind = F.when(F.col("share") >= universal, "universal").when(F.col("share") >= partial, "partial").otherwise("rare")
    return c.select("name", "n", F.round("share", ROUND).alias("share"), kind.alias("kind"))


def message_counts(df: DataFrame, col: str, most: int = 15, width: int = 70) -> DataFrame:
    """The commonest messages of packed lists, cut to ``width``."""
    m = df.select(F.explode(F.split(F.coalesce(F.col(col), F.lit("")), r"\|")).alias("m")).select(F.substring(F.trim("m"), 1, width).alias("message")).where("message <> ''")
    return m.groupBy("message").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "message").limit(most)


def load_bucket(status: Column, kept_out: Column) -> Column:
    """Where a sample ended: in atlas, excluded, or why it was not read."""
    return F.when(~status.startswith("ok"), F.when(status.startswith("no_coords"), "no coordinates").when(status.startswith("no_recognised_matrix"), "no matrix found").otherwise("read error")).when(kept_out, "excluded").otherwise("in atlas")


#: Loaders by file name, in order of preference.
LOADERS = [
    (r"\.h5ad$", "h5ad"), (r"(cell_feature_matrix|filtered_feature_bc_matrix|feature_bc_matrix)\.h5(\.gz)?$", "10x_h5"), (r"cell_feature_matrix\.zarr\.zip$", "xenium_zarr"),
    (r"(matrix|counts?|count_matrix_sparse)\.mtx(\.gz)?$", "mtx_trio"), (r"(exprmat|cell_by_gene|stdata|_counts?\.|expression)", "csv_matrix"), (r"feature_slice\.h5$", "feature_slice"), (r"\.(rds|RDS)$", "seurat_rds"),
]


def loaders(files: DataFrame, name: Column, keys: list[str]) -> DataFrame:
    """Per sample the loader that its files allow, by the first of ``LOADERS`` that any file fits, and the file:
    filtered before raw, then the shallowest path, then by name."""
    rank = F.coalesce(*[F.when(F.lower(name).rlike(p), i) for i, (p, _) in enumerate(LOADERS)])
    r = files.withColumn("_n", name).withColumn("_r", rank)
    pick = F.struct(F.coalesce("_r", F.lit(99)).alias("r"), F.col("_n").contains("raw_feature").cast("int").alias("raw"), F.size(F.split("_n", "/")).alias("depth"), F.col("_n").alias("name"))
    best = r.groupBy(*keys).agg(F.count("*").alias("n_files"), F.min(pick).alias("b"))
    loader = F.try_element_at(F.array(*[F.lit(x) for _, x in LOADERS]), F.col("b.r") + 1)
    return best.select(*keys, "n_files", loader.alias("loader"), F.when(loader.isNotNull(), F.col("b.name")).alias("file"), F.when(loader.isNull(), "no_recognised_matrix").otherwise("ok").alias("status"))


class QualityError(ValueError):
    """A share of rows is under its floor."""


def require_share(df: DataFrame, ok: Column, least: float = 0.9, what: str = "rows") -> DataFrame:
    """``df`` itself, if at least ``least`` of its rows are ``ok`` (null counts as not); an empty table is refused."""
    n, good = df.agg(F.count("*"), F.count_if(F.coalesce(ok, F.lit(False)))).first()
    if not n or good < least * n:
        raise QualityError(f"{good} of {n} {what}")
    return df
