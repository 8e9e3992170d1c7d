"""Ontologies as edge tables: closure, levels, label lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import persisted


def closure(edges: DataFrame) -> DataFrame:
    """All (child, ancestor) pairs of (child, parent) edges, by doubling path lengths until nothing is new.

    Every round is written to the shared folder; a hierarchy of depth d takes log2(d) rounds. Cycles are harmless.
    """
    reach = persisted(edges.select("child", F.col("parent").alias("ancestor")).where("child <> parent").distinct(), "closure")
    n = reach.count()
    while True:
        step = reach.select("child", F.col("ancestor").alias("mid")).join(reach.select(F.col("child").alias("mid"), "ancestor"), "mid").select("child", "ancestor")
        reach = persisted(reach.union(step).where("child <> ancestor").distinct(), "closure")
        m = reach.count()
        if m == n:
            return reach
        n = m


def levels(terms: DataFrame, closed: DataFrame, level1: list[str], level2: list[str], other: str = "other") -> DataFrame:
    """Per term: level1, the first of the priority list that it falls under; level2, its most specific candidate
    (none that is an ancestor of another; of several the first of the list), else the term; level3, the term."""
    own = terms.select(F.col("term").alias("child"), F.col("term").alias("ancestor"))
    up = closed.join(terms.select(F.col("term").alias("child")), "child", "left_semi").unionByName(own)
    at = lambda names: F.array_position(F.array(*map(F.lit, names)), F.col("ancestor"))
    l1 = up.withColumn("p", at(level1)).where("p > 0").groupBy("child").agg(F.min("p").alias("p1"))
    cand = up.withColumn("p", at(level2)).where("p > 0").select("child", F.col("ancestor").alias("cand"), "p")
    above = cand.select("child", F.col("cand").alias("lower")).join(closed.select(F.col("child").alias("lower"), F.col("ancestor").alias("cand")), "lower").select("child", "cand")
    l2 = cand.join(above, ["child", "cand"], "left_anti").groupBy("child").agg(F.min("p").alias("p2"))
    j = terms.withColumnRenamed("term", "child").join(l1, "child", "left").join(l2, "child", "left")
    pick = lambda names, p: F.try_element_at(F.array(*map(F.lit, names)), F.col(p).cast("int"))
    return j.select(F.col("child").alias("term"), F.coalesce(pick(level1, "p1"), F.lit(other)).alias("level1"), F.coalesce(pick(level2, "p2"), F.col("child")).alias("level2"), F.col("child").alias("level3"))


def resolve_labels(queries: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """Different query texts with the entry found by label or synonym (id, label, match: exact, fuzzy or none).

    Exact is an equal label apart from case and outer space, fuzzy an equal synonym; texts that say nothing
    ('unknown' and the like) are none. ``terms``: id, label, synonyms (array).
    """
    from tessera.functions.text import norm_key, stated

    q = queries.select(F.col(text).alias("query")).distinct().withColumn("k", F.when(stated(F.col("query")), norm_key(F.col("query"))))
    names = terms.select("id", "label", norm_key(F.col("label")).alias("k"), F.lit(0).alias("m")).unionByName(terms.select("id", "label", F.explode("synonyms").alias("s")).select("id", "label", norm_key(F.col("s")).alias("k"), F.lit(1).alias("m")))
    best = names.where("k IS NOT NULL").groupBy("k").agg(F.min(F.struct("m", "id", "label")).alias("b"))
    j = q.join(best, "k", "left")
    return j.select("query", F.coalesce("b.id", F.lit("unknown")).alias("id"), F.coalesce("b.label", F.lit("unknown")).alias("label"), F.when(F.col("b").isNull(), "none").when(F.col("b.m") == 0, "exact").otherwise("fuzzy").alias("match"))
