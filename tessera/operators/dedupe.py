"""Redundant samples: exact copies, series aggregates, re-deposits across archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_copies(df: DataFrame, row_id: str, content: Column, owner: str, rank: list[Column]) -> DataFrame:
    """Rows (row_id, duplicate_of) of copies of one content under more than one owner; the least by ``rank``, then by
    id, survives. Contents are compared by hash; null contents are no copies. The survivor is one aggregated struct,
    so a content of many copies is combined map-side and joined back by its hash (AQE splits a hot one)."""
    rows = df.where(content.isNotNull()).select(F.col(row_id).alias("id"), F.md5(content).alias("h"), F.col(owner).alias("o"), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col(row_id).alias("id")).alias("k"))
    best = rows.groupBy("h").agg(F.min("k").alias("k"), F.min("o").alias("lo"), F.max("o").alias("hi")).where("lo <> hi").select("h", F.col("k.id").alias("duplicate_of"))
    return rows.join(best, "h").where("id <> duplicate_of").select(F.col("id").alias(row_id), "duplicate_of")


def series_aggregates(df: DataFrame, most: float = 1.05) -> DataFrame:
    """Rows (accession, ratio, n_siblings) of samples named like their accession whose units are no more than
    ``most`` times those of their siblings together: the sum of what is there already."""
    agg = df.where("sample_id = accession").groupBy("accession").agg(F.max("units").alias("own"))
    sib = df.where("sample_id <> accession").groupBy("accession").agg(F.sum("units").alias("units"), F.count("*").alias("n_siblings"))
    ratio = F.col("own") / F.col("units")
    return agg.join(sib, "accession").where((F.col("units") > 0) & (ratio <= most)).select("accession", F.round(ratio, 6).alias("ratio"), "n_siblings")


def cross_archive(df: DataFrame, archive_id: Column, gaps: Column, rank: Column) -> DataFrame:
    """Rows of samples whose archive id is held under more than one accession, but for the survivor.

    ``df``: source, accession, sample_id, units, hash. The survivor has the fewest gaps, the best archive rank, most
    units, least accession. ``kind`` is identical where the values' hashes agree, else reprocessed.
    """
    k = F.struct(gaps.alias("g"), rank.alias("r"), (-F.col("units")).alias("u"), F.col("accession"), F.col("sample_id"), F.col("units").alias("n"), F.col("hash"))
    rows = df.withColumn("archive_id", archive_id).where("archive_id IS NOT NULL").withColumn("k", k)
    best = rows.groupBy("archive_id").agg(F.min("k").alias("best"), F.min("accession").alias("lo"), F.max("accession").alias("hi")).where("lo <> hi")
    j = rows.join(best.select("archive_id", "best"), "archive_id").where((F.col("accession") != F.col("best.accession")) | (F.col("sample_id") != F.col("best.sample_id")))
    return j.select(
        "archive_id", F.when(F.col("hash").eqNullSafe(F.col("best.hash")), "identical").otherwise("reprocessed").alias("kind"), "accession", "sample_id", F.col("best.accession").alias("duplicate_of"),
        F.round(F.col("units") / F.nullif(F.col("best.n"), F.lit(0)), 6).alias("unit_ratio"),
    )
