"""Incremental ledgers on Structured Streaming. Each run takes what is available and stops; a checkpoint in the
shared folder makes the next run go on from there."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_dir, ship


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder as a file stream."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    return r.parquet(path) if os.path.isdir(path) else r.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run(df: DataFrame, mode: str, out: str | None = None, checkpoint: str | None = None) -> str:
    """Run a stream to the end of what is there; batches land in ``out`` with their number. Returns ``out``.

    A batch that is run again after a failure overwrites its own folder, so the result is exactly-once.
    """
    ship(df.sparkSession)
    root = shared_dir(df.sparkSession)
    out = out or f"{root}/stream-{uuid.uuid4().hex}"
    checkpoint = checkpoint or f"{root}/check-{uuid.uuid4().hex}"

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def final(spark: SparkSession, out: str, keys: list[str], schema) -> DataFrame:
    """The last state of each key over all batches."""
    d = spark.read.schema(schema).option("basePath", out).parquet(out).withColumn("batch", F.regexp_extract(F.input_file_name(), r"batch=(\d+)", 1).cast("bigint"))
    rest = [c for c in d.columns if c not in keys and c != "batch"]
    return d.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, *[F.col(f"r.{c}") for c in rest])


def deduplicated(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First delivery of each key within the delay; later copies are dropped while state is kept."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def running_totals(df: DataFrame, key: str, amount: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(amount).alias("total"), F.count("*").alias("n"))


def windowed_counts(df: DataFrame, time: str, width: str, late: str, key: str) -> DataFrame:
    """Counts per window and key; rows later than ``late`` behind the newest are dropped."""
    return df.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def spend_guard(df: DataFrame, key: str, time: str, amount: str, cap: float) -> DataFrame:
    """Spend per key with a cap, as a stateful operator: (key, spent, capped), updated every batch."""

    def step(k, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        spent = state.get[0] if state.exists else 0.0
        for f in frames:
            spent += float(f[amount].sum())
        state.update((spent,))
        yield pd.DataFrame({key: [k[0]], "spent": [spent], "capped": [spent >= cap]})

    kind = dict(df.dtypes)[key]
    return df.select(key, time, amount).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, spent double, capped boolean", "spent double", "update", "NoTimeout")
