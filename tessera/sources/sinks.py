"""Writers: appended ledgers, verified tables, keyed rewrites, small reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class WriteError(RuntimeError):
    """A table read back differs from what was written."""


def append_ledger(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows in the ledger's own column order; missing columns are null, unknown ones refused."""
    extra = set(df.columns) - set(schema.names)
    if extra:
        raise ValueError(f"not in the ledger: {sorted(extra)}")
    empty = df.sparkSession.createDataFrame([], schema)
    empty.unionByName(df, allowMissingColumns=True).select(*schema.names).write.mode("append").parquet(path)


def verified_write(df: DataFrame, path: str) -> int:
    """Write, read back, compare schema and row count with a count taken while writing; returns the rows.

    The count comes from an observation of the write itself, so the input is computed once.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    rows = seen.get["rows"]
    back = df.sparkSession.read.parquet(path)
    if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in df.schema] or back.count() != rows:
        raise WriteError(path)
    return rows


def rewrite(spark: SparkSession, root: str, df: DataFrame) -> str:
    """A new version of a table under ``root``, made current only after it was verified; old versions stay readable.

    Plain parquet has no MERGE: rows are replaced by writing the next version beside and moving one pointer file.
    """
    version = f"v-{uuid.uuid4().hex}"
    verified_write(df, f"{root}/{version}")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").text(f"{root}/_versions")
    return version


def current(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table written by ``rewrite``: that of the youngest pointer."""
    from pyspark.sql import functions as F

    p = spark.read.text(f"{root}/_versions").select("value", F.col("_metadata.file_modification_time").alias("at"))
    return spark.read.parquet(f"{root}/{p.orderBy(F.desc('at')).first()[0]}")


def report(figures: dict[str, DataFrame], most: int = 1000) -> str:
    """Small tables as one JSON document; each must have ``most`` rows at most. NaN becomes null."""
    out = {}
    for name, df in figures.items():
        rows = df.limit(most + 1).toJSON().collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows")
        out[name] = [json.loads(r.replace(":NaN", ":null")) for r in rows]
    return json.dumps(out, ensure_ascii=False, sort_keys=True)
