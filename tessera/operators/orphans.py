"""References to records that do not exist, per period.

Parent keys become integers within a family of keys (the text around the last digits). The sorted integers are
compressed into contiguous runs of equal life times; a reference is matched as-of the preceding run start and is an
orphan when it lies beyond the run's end or outside its life time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import norm_key

#: Width of a block of integers. Runs end at block borders, so a sort holds one block of a family at most.
BLOCK = 1 << 16
_FOREVER = 1 << 30


def month_number(c: Column) -> Column:
    """Months since year 0 of a timestamp."""
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def integer_key(cols: list[Column]) -> list[Column]:
    """Columns (family, number, block) of a compound text key; equal keys, and only these, agree in family and number.

    The number is made of the key's last digits (15 at most); the family holds all else, and how many digits there
    are. A key without digits is a family of its own.
    """
    # control characters that stand for something here are escaped, so that no two keys become one
    escaped = [F.replace(F.replace(F.replace(norm_key(c), F.lit("\u0003"), F.lit("\u0003c")), F.lit("\u0002"), F.lit("\u0003b")), F.lit("\u0001"), F.lit("\u0003a")) for c in cols]
    key = F.concat_ws("\u0001", *escaped)
    tail = r"([0-9]{1,15})([^0-9]*)\z"
    digits = F.regexp_extract(key, tail, 1)
    family = F.when(digits == "", key).otherwise(F.concat(F.length(digits).cast("string"), F.lit("\u0002"), F.regexp_replace(key, tail, "\u0002$2")))
    number = F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("bigint")).cast("bigint")
    return [family.alias("family"), number.alias("number"), F.floor(number / BLOCK).cast("bigint").alias("block")]


def parent_runs(parents: DataFrame, keys: list[str], loaded: str, removed: str | None) -> DataFrame:
    """Runs (family, block, start, end, lives): contiguous keys with the same life times, in months."""
    gone = month_number(F.col(removed)) if removed else F.lit(None).cast("int")
    spans = (
        parents.select(
            *integer_key([F.col(k) for k in keys]),
            F.struct(month_number(F.col(loaded)).alias("a"), F.coalesce(gone, F.lit(_FOREVER)).alias("b")).alias("life"),
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        )
        .where(F.col("life.a").isNotNull() & (F.col("life.b") > F.col("life.a")))
        .na.drop(subset=[f"_k{i}" for i in range(len(keys))])
        # first by span: a hot key collapses to its few different spans before any list is made
        .groupBy("family", "number", "block", "life")
        .agg(F.lit(1).alias("one"))
    )
    lives = spans.groupBy("family", "number", "block").agg(F.array_sort(F.collect_list("life")).alias("lives"))
    by = Window.partitionBy("family", "block").orderBy("number")
    opens = F.coalesce((F.lag("number").over(by) != F.col("number") - 1) | (F.lag("lives").over(by) != F.col("lives")), F.lit(True))
    return (
        lives.withColumn("opens", opens.cast("int"))
        .withColumn("run", F.sum("opens").over(by))
        .groupBy("family", "block", "run")
        .agg(F.min("number").alias("start"), F.max("number").alias("end"), F.first("lives").alias("lives"))
        .drop("run")
    )


def orphans(
    refs: DataFrame,
    row_id: str,
    ref_keys: list[str],
    ref_time: str,
    parents: DataFrame,
    parent_keys: list[str],
    parent_time: str,
    parent_removed: str | None = None,
) -> DataFrame:
    """Rows (row_id, period) of references whose target does not exist at the end of their own period.

    * A period is the calendar month of ``ref_time``. A target exists at its end when one of its rows was loaded
      before that and not removed before that.
    * Keys are equal apart from letter case and outer white space. A row with a null in the key, or without a
      time, refers to nothing and is no case; a blank key is a key. Parents with a null in the key or without a
      load time are no targets.
    * Repeated references each give a row. Empty parents make every reference an orphan.
    """
    rows = (
        refs.select(F.col(row_id).alias("row_id"), F.col(ref_time).alias("_t"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(ref_keys)])
        .na.drop(subset=["_t", *[f"_k{i}" for i in range(len(ref_keys))]])
        .select("row_id", month_number(F.col("_t")).alias("month"), F.date_format("_t", "yyyy-MM").alias("period"), *integer_key([F.col(f"_k{i}") for i in range(len(ref_keys))]))
    )
    wanted = rows.groupBy("family", "number", "block", "month").agg(F.lit(1).alias("one"))
    runs = parent_runs(parents, parent_keys, parent_time, parent_removed)
    lives_type = runs.schema["lives"].dataType
    both = runs.select("family", "block", F.col("start").alias("at"), F.lit(0).alias("side"), F.struct("end", "lives").alias("run"), F.lit(None).cast("int").alias("month")).unionByName(
        wanted.select("family", "block", F.col("number").alias("at"), F.lit(1).alias("side"), F.lit(None).cast(f"struct<end:bigint,lives:{lives_type.simpleString()}>").alias("run"), "month")
    )
    asof = F.last("run", ignorenulls=True).over(Window.partitionBy("family", "block").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0))
    alive = F.exists("asof.lives", lambda x: (x["a"] <= F.col("month")) & (F.col("month") < x["b"]))
    missing = (
        both.withColumn("asof", asof)
        .where("side = 1")
        .where(F.col("asof").isNull() | (F.col("asof.end") < F.col("at")) | ~alive)
        .select("family", F.col("at").alias("number"), "month")
    )
    # a key of many rows is one row of `missing`: the rows stream past it, and AQE splits its partition
    return rows.join(missing, ["family", "number", "month"], "left_semi").select("row_id", "period")
