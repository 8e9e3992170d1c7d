"""Changes between consecutive full snapshots of a table.

Each row is reduced to a compact tuple (128-bit key hash, 64-bit value hash, snapshot number, time), the tuples
are hash-bucketed, and every bucket is sorted in numpy; set differences of consecutive snapshots come from
``searchsorted``. Full key values are fetched only for the keys that differ.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.text import norm_key, strip
from tessera.session import persisted, ship, small

#: Rows of all snapshots that one bucket is meant to hold (about 45 bytes a row in the Python worker).
BUCKET_ROWS = 1_000_000

_DIFF = T.StructType(
    [
        T.StructField("snap", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("h1", T.LongType()),
        T.StructField("h2", T.LongType()),
    ]
)
_KINDS = ("added", "removed", "changed")


def latest_rows(snap, h1, h2, value, updated):
    """Indices of the row that counts per (snapshot, key), sorted by snapshot and key.

    Of several rows the latest ``updated`` counts (NaN is earliest); of equal times the largest value hash.
    """
    order = np.lexsort((value, np.where(np.isnan(updated), -np.inf, updated), h2, h1, snap))
    s, a, b = snap[order], h1[order], h2[order]
    last = np.ones(len(order), bool)
    last[:-1] = (s[1:] != s[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order[last]


def _locate(a1, a2, b1, b2):
    """For each key (a1, a2) its place in the sorted keys (b1, b2), or -1."""
    lo = np.searchsorted(b1, a1, "left")
    hi = np.searchsorted(b1, a1, "right")
    at = np.where(hi > lo, lo, -1)
    miss = at >= 0
    miss[miss] = b2[at[miss]] != a2[miss]
    for i in np.flatnonzero(miss):  # equal first half, other second half: look through the few equal ones
        j = lo[i] + np.searchsorted(b2[lo[i] : hi[i]], a2[i])
        at[i] = j if j < hi[i] and b2[j] == a2[i] else -1
    return at


def diff_bucket(snap, h1, h2, value, updated, n_snaps):
    """Differences of one bucket: arrays (snapshot number of the later, kind, h1, h2)."""
    keep = latest_rows(snap, h1, h2, value, updated)
    snap, h1, h2, value = snap[keep], h1[keep], h2[keep], value[keep]
    bounds = np.searchsorted(snap, np.arange(1, n_snaps + 2))
    out = []
    for s in range(1, n_snaps):
        p, q = slice(bounds[s - 1], bounds[s]), slice(bounds[s], bounds[s + 1])
        there = _locate(h1[q], h2[q], h1[p], h2[p])
        gone = _locate(h1[p], h2[p], h1[q], h2[q]) < 0
        both = there >= 0
        changed = both.copy()
        changed[both] = value[q][both] != value[p][there[both]]
        for kind, sel, side in ((0, ~both, q), (1, gone, p), (2, changed, q)):
            if sel.any():
                out.append((np.full(sel.sum(), s + 1, np.int32), np.full(sel.sum(), kind, np.int32), h1[side][sel], h2[side][sel]))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int32, np.int32, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _diff_arrow(t: pa.Table) -> pa.Table:
    get = lambda c: t.column(c).to_numpy()
    cols = diff_bucket(get("snap"), get("h1"), get("h2"), get("value"), get("updated").astype(float), int(t.column("n_snaps")[0].as_py()))
    return pa.table(dict(zip(("snap", "kind", "h1", "h2"), cols)))


def snapshot_changes(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    snap: str = "snap_date",
    delivered: str = "delivered_at",
    updated: str = "updated",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (snap_date, record_key, change_kind) of records added, removed or changed from a snapshot to the next.

    * Of a snapshot delivered more than once only the last delivery counts; a null delivery time is the earliest.
    * Of several rows of a record in a delivery the latest ``updated`` counts (null or NaN is earliest); ties go to
      the row with the largest value hash, so repeated rows give one record.
    * Keys and values are compared apart from letter case and outer white space; null is a value of its own.
    * Rows with a null in the key or without a snapshot date are left out. An empty table gives no rows; so does a
      single snapshot. Further columns are ignored, whatever their names.
    * ``record_key`` is the trimmed spelling (the least of several) in the later snapshot, or in the earlier one
      for a removed record.
    """
    src = df.select(
        F.col(snap).alias("snap_date"),
        F.col(delivered).alias("delivered"),
        F.col(updated).cast("double").alias("updated"),
        *[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
        *[F.col(v).cast("string").alias(f"v{i}") for i, v in enumerate(values)],
    ).where(F.col("snap_date").isNotNull())
    ship(df.sparkSession)
    # one row a snapshot date: a handful of rows, numbered in one partition
    deliveries = src.groupBy("snap_date").agg(F.max("delivered").alias("delivered"))
    order = Window.orderBy("snap_date")
    deliveries = deliveries.withColumn("snap", F.row_number().over(order).cast("int")).withColumn(
        "n_snaps", F.max("snap").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    deliveries = small(persisted(deliveries, "deliveries"))
    key: Column = F.concat_ws("\u0001", *[norm_key(F.col(f"k{i}")) for i in range(len(keys))])
    value = F.array(*[norm_key(F.col(f"v{i}")) for i in range(len(values))])
    rows = (
        src.na.drop(subset=[f"k{i}" for i in range(len(keys))])
        .join(deliveries.withColumnRenamed("snap_date", "d_date").withColumnRenamed("delivered", "d_time"), (F.col("snap_date") == F.col("d_date")) & F.col("delivered").eqNullSafe(F.col("d_time")))
        .withColumn("key", key)
        .withColumn("h1", F.xxhash64("key"))
        .withColumn("h2", F.xxhash64(F.lit("second"), "key"))
    )
    n = max(1, math.ceil(df.count() / bucket_rows))
    # a null at any place must differ from every text there
    value_hash = F.xxhash64(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))
    at = F.coalesce(F.nanvl("updated", F.lit(None).cast("double")), F.lit(float("-inf")))
    # the row that counts per record and snapshot, combined map-side: a record of many rows never meets in one bucket
    compact = rows.groupBy("snap", "n_snaps", "h1", "h2").agg(F.max(F.struct(at.alias("updated"), value_hash.alias("value"))).alias("m"))
    compact = compact.select(F.pmod("h1", F.lit(n)).cast("int").alias("bucket"), "snap", "n_snaps", "h1", "h2", "m.value", "m.updated")
    diff = compact.groupBy("bucket").applyInArrow(_diff_arrow, _DIFF)
    diff = diff.withColumn("at", F.col("snap") - (F.col("kind") == 1).cast("int"))
    diff = persisted(diff, "differences")
    differing = small(diff.select("at", "h1", "h2").distinct())
    full = rows.withColumn("at", F.col("snap")).join(differing, ["at", "h1", "h2"], "left_semi")
    full = full.select("at", "h1", "h2", F.concat_ws("|", *[strip(F.col(f"k{i}")) for i in range(len(keys))]).alias("record_key")).groupBy("at", "h1", "h2").agg(F.min("record_key").alias("record_key"))
    dates = deliveries.select("snap", F.col("snap_date"))
    return (
        diff.join(full, ["at", "h1", "h2"])
        .join(dates, "snap")
        .select("snap_date", "record_key", F.element_at(F.array(*map(F.lit, _KINDS)), F.col("kind") + 1).alias("change_kind"))
    )
