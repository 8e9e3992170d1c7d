"""Labels learned from labelled vectors and smoothed by neighbourhood majority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the classifier is fitted on at most (taken by hash); all rows are labelled.
MOST_TRAINING = 50_000


def transfer(df: DataFrame, row_id: str, vector: str, label: str, most: int = MOST_TRAINING, clusters: int = 20, seed: int = 7) -> DataFrame:
    """Rows (row_id, predicted, consensus, agrees): a multinomial logistic regression fitted on the labelled rows
    (at most ``most``), and the commonest prediction of each row's cluster."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = df.select(F.col(row_id).alias("id"), array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"), F.col(label).cast("double").alias("label"))
    known = v.where("label IS NOT NULL")
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000)) < int(1_000_000 * most / total))
    model = LogisticRegression(maxIter=30, regParam=0.01).fit(known)
    groups = KMeans(k=clusters, seed=seed, maxIter=10).fit(known)
    p = groups.transform(model.transform(v).select("id", "features", "prediction").withColumnRenamed("prediction", "predicted")).select("id", "predicted", F.col("prediction").alias("cluster"))
    n = p.groupBy("cluster", "predicted").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max(F.struct("n", (-F.col("predicted")).alias("p"))).alias("m")).select("cluster", (-F.col("m.p")).alias("consensus"))
    return p.join(n, "cluster").select(F.col("id").alias(row_id), F.col("predicted").cast("int").alias("predicted"), F.col("consensus").cast("int").alias("consensus"), (F.col("predicted") == F.col("consensus")).alias("agrees"))
