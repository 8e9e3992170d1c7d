"""Readers of the file shapes that deposits come in. All end in DataFrames; order is an explicit ordinal."""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from tessera.functions.names import file_role, size_to_bytes
from tessera.session import ship


def ledger(spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str]) -> DataFrame:
    """A CSV ledger by a declared schema; a missing file is an empty table. Keys are strings."""
    from py4j.protocol import Py4JError

    df = spark.createDataFrame([], schema)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        there = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)
    except Py4JError:
        there = False
    if there:
        df = spark.read.option("header", True).schema(df.schema).csv(path)
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, ordinal, line) of text files, ordinals from 0. A file is read by one task."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", r"\r\n?", "\n").alias("value"))
    return text.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n")).alias("ordinal", "line"))


def series_text(spark: SparkSession, path: str, most: int = 400) -> DataFrame:
    """Rows (sample, key, value) of series text: sections '^SAMPLE = id', lines '!Sample_key = value'.

    Values of a repeated key are joined in order and cut to ``most`` characters; lines before a section are skipped.
    """
    l = lines(spark, path)  # noqa: E741
    head = F.when(F.col("line").startswith("^SAMPLE"), F.trim(F.regexp_extract("line", r"^[^=]*=(.*)$", 1)))
    l = l.withColumn("sample", F.last(head, ignorenulls=True).over(Window.partitionBy("file").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)))  # noqa: E741
    kv = l.where("sample IS NOT NULL AND line LIKE '!Sample_%'").select("sample", "ordinal", F.regexp_extract("line", r"^!Sample_([^=]*?) = ", 1).alias("key"), F.regexp_extract("line", r"^[^=]*? = (.*)$", 1).alias("value")).where("key <> ''")
    return kv.groupBy("sample", "key").agg(F.array_sort(F.collect_list(F.struct("ordinal", "value"))).alias("v")).select("sample", "key", F.substring(F.array_join(F.transform("v", lambda x: x["value"]), " "), 1, most).alias("value"))


def directory_index(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Rows (page, name, url, size_bytes, role) of web-server directory listings."""
    pattern = r'<a href="([^"?#]+)">[^<]*</a>\s*([\d\-]+\s[\d:]+)?\s*([\d.]+[KMGT]?|-)?'
    hit = F.regexp_extract_all(html, F.lit(f"({pattern})"), F.lit(1))
    r = pages.select(F.col(url).alias("page"), F.explode(hit).alias("m")).select("page", F.regexp_extract("m", pattern, 1).alias("name"), F.regexp_extract("m", pattern, 3).alias("size"))
    r = r.where(~F.col("name").rlike(r"^(/|http|\.\.)") & (F.col("name") != "./"))
    base = F.when(F.col("page").endswith("/"), F.col("page")).otherwise(F.concat("page", F.lit("/")))
    return r.select("page", "name", F.concat(base, "name").alias("url"), F.when(~F.col("size").isin("", "-"), size_to_bytes(F.col("size"))).alias("size_bytes"), F.when(F.col("name").endswith("/"), "dir").otherwise(file_role(F.col("name"))).alias("role"))


#: Column order of a spot table without a header; pairs of coordinate columns, in order.
SPOT_COLUMNS = ["barcode", "in_tissue", "array_row", "array_col", "pxl_row_in_fullres", "pxl_col_in_fullres"]
XY_PAIRS = [
    ("x_centroid", "y_centroid"), ("pxl_col_in_fullres", "pxl_row_in_fullres"), ("CenterX_global_px", "CenterY_global_px"), ("x_global_px", "y_global_px"), ("center_x", "center_y"), ("centroid_x", "centroid_y"), ("global_x", "global_y"),
    ("sdimx", "sdimy"), ("adj_x", "adj_y"), ("x", "y"), ("X", "Y"), ("xcoord", "ycoord"), ("array_col", "array_row"), ("spatial_1", "spatial_2"), ("imagecol", "imagerow"),
]


def coordinate_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of positions, parquet or CSV; a CSV whose first field is a barcode or a number has no header."""
    if ".parquet" in path:
        return spark.read.parquet(path)
    first = spark.read.text(path).head(1)
    field = first[0][0].split(",")[0].strip('"') if first else ""
    import re

    bare = bool(re.fullmatch(r"[ACGT]{8,}-?\d*", field)) or field.replace(".", "").isdigit()
    df = spark.read.option("header", not bare).csv(path)
    if bare and len(df.columns) >= len(SPOT_COLUMNS):
        df = df.toDF(*SPOT_COLUMNS, *df.columns[len(SPOT_COLUMNS) :])
    return df


def pick_xy(df: DataFrame) -> tuple[str, str] | None:
    """The first pair of coordinate columns that is mostly finite and not constant; one aggregation for all pairs."""
    low = {c.lower(): c for c in df.columns}
    pairs = [(low[a.lower()], low[b.lower()]) for a, b in XY_PAIRS if a.lower() in low and b.lower() in low]
    if not pairs:
        return None
    num = lambda c: F.nanvl(F.col(f"`{c}`").try_cast("double"), F.lit(None).cast("double"))
    fin = lambda c: num(c).isNotNull() & (F.abs(num(c)) < float("inf"))
    aggs = [x for i, (a, b) in enumerate(pairs) for x in (F.avg((fin(a) & fin(b)).cast("int")).alias(f"s{i}"), (F.min(num(a)) < F.max(num(a))).alias(f"a{i}"), (F.min(num(b)) < F.max(num(b))).alias(f"b{i}"))]
    r = df.agg(*aggs).first()
    return next((p for i, p in enumerate(pairs) if (r[f"s{i}"] or 0) > 0.5 and r[f"a{i}"] and r[f"b{i}"]), None)


#: Leading columns of dense tables that name a unit.
ID_COLUMNS = {"fov", "cell_id", "cell", "cellid", "barcode", "cell_barcode", "x", "y", "gene", "index", "id", ""}


def dense_counts(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Entries (cell, gene, value) of a dense table of counts: leading identifier columns are joined by '_', the
    other columns are genes; zeros are dropped. The table is unpivoted inside the row, without a shuffle."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    ids = [c for c in df.columns[:25] if c.lower() in ID_COLUMNS or c.startswith("_c")] or df.columns[:1]
    genes = [c for c in df.columns if c not in ids]
    cells = F.concat_ws("_", *[F.col(f"`{c}`") for c in ids]).alias("cell")
    long = df.select(cells, F.explode(F.array(*[F.struct(F.lit(g).alias("gene"), F.col(f"`{g}`").try_cast("double").alias("value")) for g in genes])).alias("e")).select("cell", "e.gene", "e.value")
    return long.where("value <> 0")


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _open(path: str):
    return gzip.open(path, "rb") if path.endswith(".gz") else open(path, "rb")


class _MatrixReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("partitionbytes", 64 << 20))

    def partitions(self) -> list[_Part]:
        with _open(self.path) as f:
            line = f.readline()
            while line.startswith(b"%"):
                line = f.readline()
            start = f.tell()
        if self.path.endswith(".gz"):
            return [_Part(self.path, start, 1 << 62)]
        end = os.path.getsize(self.path)
        return [_Part(self.path, a, min(a + self.size, end)) for a in range(start, end, self.size)] or [_Part(self.path, start, start)]

    def read(self, part: _Part) -> Iterator[tuple]:
        with _open(part.path) as f:
            f.seek(part.start)
            at = part.start
            first = part is not None and part.start > 0
            if first:  # a line belongs to the part in which it begins
                f.seek(part.start - 1)
                at = part.start - 1 + len(f.readline())
            while at < part.end:
                line = f.readline()
                if not line:
                    break
                at += len(line)
                x = line.split()
                if len(x) >= 2:
                    yield int(x[0]), int(x[1]), float(x[2]) if len(x) > 2 else 1.0


class MatrixMarket(DataSource):
    """Coordinate Matrix-Market files (``path``; plain files are read in byte ranges of ``partitionBytes``)."""

    @classmethod
    def name(cls) -> str:
        return "matrixmarket"

    def schema(self) -> str:
        return "row bigint, col bigint, value double"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _MatrixReader({k.lower(): v for k, v in self.options.items()})


def matrix_trio(spark: SparkSession, matrix: str, barcodes: str, features: str, partition_bytes: int = 64 << 20) -> DataFrame:
    """Entries (cell, gene, value) of a matrix with barcode and feature files.

    Which axis holds the genes is told by the files' lengths: rows are genes unless the largest row number fits the
    barcodes only. Lengths that fit neither way are refused.
    """
    ship(spark)
    spark.dataSource.register(MatrixMarket)
    m = spark.read.format("matrixmarket").option("partitionBytes", str(partition_bytes)).load(matrix)
    b, f = lines(spark, barcodes), lines(spark, features)
    n_cells, n_genes = b.count(), f.count()
    top = m.agg(F.max("row").alias("r"), F.max("col").alias("c")).first()
    rows, cols = top.r or 0, top.c or 0
    if rows <= n_genes and cols <= n_cells:
        gene, cell = "row", "col"
    elif rows <= n_cells and cols <= n_genes:
        gene, cell = "col", "row"
    else:
        raise ValueError(f"a matrix of {rows} x {cols} fits neither {n_genes} features nor {n_cells} barcodes")
    cells = b.select((F.col("ordinal") + 1).cast("bigint").alias(cell), F.split("line", "\t")[0].alias("cell"))
    parts = F.split("line", "\t")
    genes = f.select((F.col("ordinal") + 1).cast("bigint").alias(gene), F.coalesce(F.try_element_at(parts, F.lit(2)), parts[0]).alias("gene"))
    return m.join(cells, cell).join(genes, gene).select("cell", "gene", "value")


def model_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """JSON sidecars of models, one object a file, without the control probes' own counts where they are absent."""
    return spark.read.option("multiLine", True).json(path)


def cached_reference(spark: SparkSession, path: str, want: list[str], fetch, gene_col: str = "gene") -> DataFrame:
    """A cached reference table of genes, fetched again for the union when it lacks wanted genes; never empty.

    ``fetch(genes)`` returns a DataFrame. The genes that the cache was built from are kept beside it.
    """
    try:
        have = [r[0] for r in spark.read.parquet(f"{path}/genes").collect()]
    except Exception:
        have = []
    if set(want) - set(have):
        genes = sorted({*want, *have})
        fresh = fetch(genes)
        if not fresh.head(1):
            raise ValueError("the reference came back empty")
        fresh.write.mode("overwrite").parquet(f"{path}/data.new")
        spark.read.parquet(f"{path}/data.new").write.mode("overwrite").parquet(f"{path}/data")
        spark.createDataFrame([(g,) for g in genes], f"{gene_col} string").write.mode("overwrite").parquet(f"{path}/genes")
    return spark.read.parquet(f"{path}/data")


def gene_names(spark: SparkSession, path: str) -> DataFrame:
    """Rows (ordinal, gene) of a feature file or of the header of a dense table, without reading its values."""
    name = path.lower().removesuffix(".gz")
    if name.endswith(".csv") or not any(k in name for k in ("features", "genes")):
        sep = "\t" if name.endswith((".tsv", ".txt")) else ","
        head = spark.read.text(path).limit(1).select(F.posexplode(F.split(F.col("value"), sep)).alias("ordinal", "gene"))
        return head.where(~F.lower(F.col("gene")).isin(*ID_COLUMNS))
    parts = F.split("line", "\t")
    return lines(spark, path).select("ordinal", F.coalesce(F.try_element_at(parts, F.lit(2)), parts[0]).alias("gene"))


def coordinate_ladder(candidates: list[tuple[str, DataFrame]], cells: DataFrame, key: str = "cell", least: float = 0.5) -> tuple[str | None, DataFrame | None]:
    """The first table of positions (source name, DataFrame with ``key``, x, y) that at least ``least`` of the cells
    are found in, joined to them; (None, None) if none is. One count per table tried."""
    n = cells.count()
    for name, table in candidates:
        at = cells.join(table.dropDuplicates([key]), key)
        if n and at.count() >= least * n:
            return name, at
    return None, None


def spreadsheet_records(sheet: DataFrame, links: list[str], species: str = "species") -> DataFrame:
    """Human rows of a sheet with their link: the first stated of ``links``, of a ';' list the first."""
    from tessera.functions.names import link_accession, link_host
    from tessera.functions.text import norm_key, stated

    url = F.trim(F.split(F.coalesce(*[F.when(stated(F.col(c)), F.col(c)) for c in links]), ";")[0])
    rows = sheet.where(norm_key(F.col(species)).isin("human", "homo sapiens", "homo_sapiens")).withColumn("link", url)
    return rows.withColumns({"source": link_host(F.col("link")), "accession": link_accession(F.col("link"))})
