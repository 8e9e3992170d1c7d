"""Which samples can be segmented into cells, with the image that each would use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import norm_key

#: Verdicts of usable deposits; endings of full-resolution images, and the bytes that such an image has.
USABLE = ("ready", "bundle_only")
IMAGE_NAME = r"(?i)\.(ome\.tiff?|tiff?|btf|qptiff|svs|ndpi)(\.gz)?$"
IMAGE_BYTES = 200_000_000
#: Parts of the paths of 2 um bins and of scale factors.
BINS, SCALES = "square_002um", "scalefactors"

KEY = ["source", "accession", "sample_id"]


def eligible(datasets: DataFrame, files: DataFrame, technology: Column, wanted: str, bins: Column, scales: Column) -> DataFrame:
    """Samples (``KEY``) of usable deposits of the ``wanted`` technology with a file of 2 um bins and one of scale factors.

    ``technology`` is a column of ``datasets``; ``bins`` and ``scales`` tell the files apart (``has_part`` of the path by
    default use). Rows with a null in the key are left out; repeated rows count once.
    """
    hd = datasets.where(norm_key(F.col("verdict")).isin(*USABLE) & (technology == wanted)).select("source", "accession").distinct()
    f = files.where("sample_id IS NOT NULL").select(*KEY, bins.alias("b"), scales.alias("s")).join(hd, ["source", "accession"], "left_semi")
    return f.groupBy(*KEY).agg(F.bool_or("b").alias("b"), F.bool_or("s").alias("s")).where("b AND s").select(*KEY)


def best_image(files: DataFrame, name: Column, pattern: str = IMAGE_NAME, least: int = IMAGE_BYTES) -> DataFrame:
    """Per sample (``KEY``) its image: one whose name holds the sample's own token before others, then the largest
    (ties by url), of those above ``least`` bytes. One aggregation of the greatest struct, combined map-side."""
    plain = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    token = plain(F.split_part(F.col("sample_id"), F.lit("/"), F.lit(1)))
    cand = files.where(name.rlike(pattern) & (F.col("size_bytes") > least)).where("sample_id IS NOT NULL AND accession IS NOT NULL AND source IS NOT NULL")
    own = ((token != "") & F.contains(plain(name), token)).cast("int")
    best = cand.groupBy(*KEY).agg(F.min(F.struct((-own).alias("o"), (-F.col("size_bytes")).alias("s"), "url")).alias("m"))
    return best.select(*KEY, F.round(-F.col("m.s") / 1e9, 2).alias("image_gb"), F.col("m.url").alias("image_url"))


def queue(samples: DataFrame, images: DataFrame) -> DataFrame:
    """Every sample, with its image if it has one and the source of labels that this leaves."""
    j = samples.join(images, KEY, "left")
    return j.withColumn("label_source", F.when(F.col("image_url").isNotNull(), "he+gex").otherwise("gex"))


def has_part(path: Column, part: str) -> Column:
    return F.coalesce(F.contains(path, F.lit(part)), F.lit(False))
