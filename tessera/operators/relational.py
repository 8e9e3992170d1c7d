"""Catalogue algebra: star joins, roll-ups, shares, ledgers, rewrites of keyed tables, agreement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import persisted

ROUND = 6
#: Rows of one part of a class, when its first rows are looked for.
SALT_ROWS = 1_000_000


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), ROUND)


# ---- joins ----------------------------------------------------------------------------------------------------


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Left joins of a fact table to dimensions (table, keys, prefix of its other columns).

    Null keys meet null keys, as in the catalogue's own merges. A dimension must be unique by its keys; of repeated
    keys the least row is taken, so a join never multiplies the fact.
    """
    for dim, keys, prefix in dims:
        rest = [c for c in dim.columns if c not in keys]
        one = dim.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(f"_r.{c}").alias(prefix + c) for c in rest])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        fact = fact.join(one, on, "left").drop(*[f"_k_{k}" for k in keys])
    return fact


def overlap_join(left: DataFrame, right: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """Inner join, empty unless at least ``least`` of the left keys are met."""
    met = left.join(right.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("met"))
    share = left.agg(F.count("*").alias("n")).join(met, F.lit(True)).select((F.col("met") >= F.col("n") * least).alias("_ok"))
    # one row: whether the gate is open
    return left.join(right, key).join(F.broadcast(share.where("_ok")), F.lit(True), "left_semi")


def token_join(left: DataFrame, left_text: str, right: DataFrame, right_text: str, pattern: str, left_id: str, right_id: str) -> DataFrame:
    """Rows (left_id, right_id, token): the first token of the left text that any right text holds, and the least
    right id holding it. An equality join of different tokens, not of texts."""
    lt = left.select(F.col(left_id), F.posexplode(F.transform(F.regexp_extract_all(F.col(left_text), F.lit(pattern), F.lit(0)), F.upper)).alias("pos", "token"))
    rt = right.select(F.col(right_id), F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.col(right_text), F.lit(pattern), F.lit(0)), F.upper))).alias("token"))
    rt = rt.groupBy("token").agg(F.min(right_id).alias(right_id))
    best = lt.join(rt, "token").groupBy(left_id).agg(F.min(F.struct("pos", "token", right_id)).alias("b"))
    return best.select(left_id, F.col(f"b.{right_id}").alias(right_id), F.col("b.token").alias("token"))


# ---- aggregates -----------------------------------------------------------------------------------------------


def completeness(df: DataFrame, known: dict[str, Column]) -> DataFrame:
    """Rows (field, pct_known, n_distinct) of columns; ``known`` gives each column's test. One pass."""
    aggs = [x for c, ok in known.items() for x in (F.avg(ok.cast("int")).alias(f"{c}|p"), F.count_distinct(F.when(ok, F.col(c))).alias(f"{c}|n"))]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), r6(F.col(f"`{c}|p`") * 100).alias("pct_known"), F.col(f"`{c}|n`").alias("n_distinct")) for c in known])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent values, ties by value; nulls are left out."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def balance(rows: DataFrame, label: str, order: list[Column], most: int = 25_000, least: int = 50) -> DataFrame:
    """Rows of the classes of at least ``least`` rows: all of them if these are ``most`` rows at most, else of each
    class the first by ``order``, max(``least``, ``most`` / classes) of them. Rows without a class are left out.
    """
    big = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    n, classes = big.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    kept = rows.join(big.select(label), label, "left_semi")
    if n <= most:
        return kept
    cap, salts = max(least, most // classes), max(1, n // SALT_ROWS)
    # the first of a class are among the first of its parts: no task sorts a whole large class
    by = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    keys = [f"_o{i}" for i in range(len(order))]
    part = kept.select("*", *by).withColumn("_s", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    first = part.withColumn("_r", F.row_number().over(Window.partitionBy(label, "_s").orderBy(*keys))).where(F.col("_r") <= cap)
    return first.withColumn("_r", F.row_number().over(Window.partitionBy(label).orderBy(*keys))).where(F.col("_r") <= cap).drop("_r", "_s", *keys)


def composition(df: DataFrame, col: str, weight: Column, k: int) -> DataFrame:
    """The ``k`` heaviest values and one honest row for all the rest."""
    sums = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.sum(weight).alias("w"))
    top = sums.orderBy(F.desc("w"), "value").limit(k)
    rest = sums.join(top.select("value"), "value", "left_anti").agg(F.count("*").alias("n"), F.sum("w").alias("w")).where("n > 0").select(F.concat(F.col("n").cast("string"), F.lit(" rarer values")).alias("value"), "w")
    return top.unionByName(rest)


def ranked_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows (value, n, rank, upto): values by count, ties by value, with the number of rows up to each.

    The values are parted by ranges of (count, value), written to the shared folder, and ranked within a part; what
    the parts before hold is a row a part. No task sees more than its range.
    """
    n = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = persisted(n.repartitionByRange(tasks, F.desc("n"), F.col("value")).withColumn("part", F.spark_partition_id()), "counts-ranged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = parts.groupBy("part").agg(F.count("*").alias("k"), F.sum("n").alias("m"))  # one row a part
    held = held.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m"))
    own = Window.partitionBy("part").orderBy(F.desc("n"), "value")
    run = F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, 0))
    ranked = parts.select("value", "n", "part", F.row_number().over(own).alias("r"), run.alias("s")).join(F.broadcast(held), "part")
    return ranked.select("value", "n", (F.col("k") + F.col("r")).alias("rank"), (F.col("m") + F.col("s")).alias("upto"))


def cumulative_share(df: DataFrame, col: str) -> DataFrame:
    """Values ranked by count with the running share of all rows, in per cent."""
    total = df.where(F.col(col).isNotNull()).agg(F.count("*").alias("all"))  # one row
    return ranked_counts(df, col).join(F.broadcast(total)).select("value", "n", F.col("rank").cast("int").alias("rank"), r6(F.col("upto") * 100 / F.col("all")).alias("cum_pct"))


def coverage_ranks(df: DataFrame, col: str, levels: list[int]) -> DataFrame:
    """How many of the commonest values hold each level of per cent of all rows."""
    c = cumulative_share(df, col)
    one = c.agg(*[F.min(F.when(F.col("cum_pct") >= x, F.col("rank"))).alias(f"l{x}") for x in levels])
    return one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("pct"), F.col(f"l{x}").alias("values")) for x in levels])).alias("x")).select("x.*")


def top_share(df: DataFrame, col: str, quotas: list[int]) -> DataFrame:
    """Share of rows that the top ``q`` per cent of values hold (the value at place int(n * q / 100), 1 at least)."""
    values = df.where(F.col(col).isNotNull()).agg(F.count_distinct(col).alias("values"))  # one row
    c = cumulative_share(df, col).join(F.broadcast(values))
    one = c.agg(*[F.max(F.when(F.col("rank") == F.greatest(F.floor(F.col("values") * q / 100), F.lit(1)), F.col("cum_pct"))).alias(f"q{q}") for q in quotas])
    return one.select(F.explode(F.array(*[F.struct(F.lit(q).alias("top_pct"), F.col(f"q{q}").alias("share")) for q in quotas])).alias("x")).select("x.*")


def binned(value: Column, edges: list[float]) -> Column:
    """Label '[a, b)' of right-open bins; null outside."""
    return F.coalesce(*[F.when((value >= a) & (value < b), f"[{a}, {b})") for a, b in zip(edges, edges[1:])])


def pivot_counts(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """Counts by row and named column values, 0 where none, with the row's total."""
    p = df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).na.fill(0)
    return p.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values]))


def paired_groups(df: DataFrame, group: str, side: str, pair: tuple, top: int, least: int) -> DataFrame:
    """Of the ``top`` most frequent groups those with ``least`` rows on both sides."""
    best = top_values(df, group, top).select(F.col("value").alias(group))
    counts = df.join(best, group, "left_semi").groupBy(group).agg(*[F.count_if(F.col(side) == s).alias(n) for s, n in zip(pair, ("n_a", "n_b"))])
    return counts.where((F.col("n_a") >= least) & (F.col("n_b") >= least))


def describe(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, deviation, least, quartiles and greatest per group."""
    v = F.col(value)
    q = [r6(F.percentile(v, F.lit(p))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    return df.groupBy(group).agg(F.count(v).alias("n"), r6(F.avg(v)).alias("mean"), r6(F.stddev(v)).alias("std"), r6(F.min(v)).alias("min"), *q, r6(F.max(v)).alias("max"))


# ---- ledgers and keyed tables ---------------------------------------------------------------------------------


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the greatest by ``order``, which must tell all rows of a key apart."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("r"))).alias("m")).select(*keys, *[F.col(f"m.r.{c}").alias(c) for c in rest])


def preferred_status(df: DataFrame, keys: list[str], status: str, prefer: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first status in ``prefer`` (others last), then the latest."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, prefer)), F.col(status)), F.lit(0))
    rank = F.when(rank == 0, len(prefer) + 1).otherwise(rank)
    return last_wins(df, keys, [-rank, *order])


def todo(wanted: DataFrame, ledger: DataFrame, keys: list[str], done: Column, retry_prefix: str | None = None) -> DataFrame:
    """Keys still to be processed: without a ledger row that is ``done``, or with ``retry_prefix`` only the keys
    whose rows have a status of that prefix."""
    if retry_prefix is not None:
        return wanted.join(ledger.where(F.col("status").startswith(retry_prefix)), keys, "left_semi")
    return wanted.join(ledger.where(done), keys, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The base with changed keys replaced; columns of either side only are null on the other."""
    return base.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def insert_new(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new keys only, one per key (the least row)."""
    fresh = rows.join(base.select(*keys), keys, "left_anti")
    rest = [c for c in rows.columns if c not in keys]
    return fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def fill_with_conflicts(base: DataFrame, other: DataFrame, keys: list[str], fields: list[str], unknown) -> tuple[DataFrame, DataFrame]:
    """(filled, conflicts): unknown fields take the other's known value; known ones stay, and where the two differ
    (apart from case) a row (keys, field, base_value, other_value) is a conflict."""
    o = other.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    both = base.join(o, keys, "left")
    filled = both.select(*[F.when(unknown(F.col(c)) & ~unknown(F.col(f"_{c}")), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in base.columns])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("base_value"), F.col(f"_{f}").alias("other_value")) for f in fields])
    c = both.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.*")
    return filled, c.where(~unknown(F.col("base_value")) & ~unknown(F.col("other_value")) & (F.lower("base_value") != F.lower("other_value")))


def no_downgrade(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All new rows, and the old ones that the new extraction does not have."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def keep_prior(new: DataFrame, old: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The new answer, or the previous one where the new is 'unknown'; ``kept`` tells which."""
    j = new.join(old.select(*keys, F.col(col).alias("_old")), keys, "left")
    take = (F.col(col) == "unknown") & F.col("_old").isNotNull() & (F.col("_old") != "unknown")
    return j.withColumn("kept", F.coalesce(take, F.lit(False))).withColumn(col, F.when(take, F.col("_old")).otherwise(F.col(col))).drop("_old")


def running_total(df: DataFrame, group: str, order: list[str], amount: Column, cap: float) -> DataFrame:
    """Running spend per group and whether it is still under the cap."""
    run = F.sum(amount).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("spent", r6(run)).withColumn("under_cap", run < cap)


def agreement(df: DataFrame, pairs: dict[str, tuple[Column, Column]], unknown) -> DataFrame:
    """Rows (field, n_ref, agree, unknown, pct): how a field agrees with its reference, where that is known."""
    aggs = []
    for f, (mine, ref) in pairs.items():
        has = ~unknown(ref)
        aggs += [F.count_if(has).alias(f"{f}|n"), F.count_if(has & (F.lower(mine) == F.lower(ref))).alias(f"{f}|a"), F.count_if(has & unknown(mine)).alias(f"{f}|u")]
    one = df.agg(*aggs)
    c = lambda f, x: F.col(f"`{f}|{x}`")
    rows = [F.struct(F.lit(f).alias("field"), c(f, "n").alias("n_ref"), c(f, "a").alias("agree"), c(f, "u").alias("unknown"), r6(c(f, "a") * 100 / F.nullif(c(f, "n") - c(f, "u"), F.lit(0))).alias("pct")) for f in pairs]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def hierarchy_confusion(df: DataFrame, mine: str, ref: str, closure: DataFrame) -> DataFrame:
    """Counts of exact, consistent (one is an ancestor of the other), conflict and unknown pairs.

    ``closure``: (child, ancestor) of all pairs."""
    pairs = df.groupBy(F.col(mine).alias("a"), F.col(ref).alias("b")).agg(F.count("*").alias("n"))
    up = closure.select(F.col("child").alias("a"), F.col("ancestor").alias("b"), F.lit(True).alias("up"))
    down = closure.select(F.col("ancestor").alias("a"), F.col("child").alias("b"), F.lit(True).alias("down"))
    j = pairs.join(up.distinct(), ["a", "b"], "left").join(down.distinct(), ["a", "b"], "left")
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "unknown").when(F.col("a") == F.col("b"), "exact").when(F.col("up") | F.col("down"), "consistent").otherwise("conflict")
    return j.groupBy(verdict.alias("verdict")).agg(F.sum("n").alias("n"))


class OverwriteError(ValueError):
    """A known value would be overwritten."""


def containment_join(left: DataFrame, left_text: str, right: DataFrame, right_text: str, n: int = 6) -> DataFrame:
    """Pairs (left_text, right_text) of which one text holds the other, by an equality join of n-grams.

    The shorter text's first ``n`` characters must occur in the longer one, so pairs are candidates only where they
    share that gram; the containment itself is then checked. Texts shorter than ``n`` are matched by their whole.
    """
    l = left.select(F.col(left_text).alias("l")).where("length(l) > 0").distinct()  # noqa: E741
    r = right.select(F.col(right_text).alias("r")).where("length(r) > 0").distinct()

    def grams(c: str, head: bool) -> Column:
        if head:
            return F.substring(c, 1, n)
        sizes = [_windows(c, k) for k in range(1, n + 1)]
        return F.explode(F.array_distinct(F.flatten(F.array(*sizes))))

    a = l.select("l", grams("l", False).alias("g")).join(r.select("r", grams("r", True).alias("g")), "g").where(F.contains("l", "r"))
    b = r.select("r", grams("r", False).alias("g")).join(l.select("l", grams("l", True).alias("g")), "g").where(F.contains("r", "l"))
    return a.select("l", "r").union(b.select("l", "r")).distinct().toDF(left_text, right_text)


def _windows(c: str, k: int) -> Column:
    """All substrings of ``k`` characters."""
    return F.when(F.length(c) >= k, F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(F.col(c), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def positional_join(left: DataFrame, right: DataFrame, by: list[str], ordinal: str) -> DataFrame:
    """Rows joined by explicit ordinals within ``by``; groups whose sides differ in length are left out whole."""
    n = left.groupBy(*by).agg(F.count("*").alias("_n"))
    same = right.groupBy(*by).agg(F.count("*").alias("_n")).join(n, [*by, "_n"]).select(*by)
    return left.join(right, [*by, ordinal]).join(same, by, "left_semi")


def guarded_fill(base: DataFrame, fill: DataFrame, keys: list[str], col: str, unknown) -> DataFrame:
    """Values filled in where they are unknown; any attempt on a known one is an error (checked before)."""
    j = base.join(fill.select(*keys, F.col(col).alias("_f")), keys, "left")
    if j.where(F.col("_f").isNotNull() & ~unknown(F.col(col))).head(1):
        raise OverwriteError(col)
    return j.withColumn(col, F.coalesce("_f", col)).drop("_f")


def append_text(base: DataFrame, hints: DataFrame, keys: list[str], col: str, sep: str = " | ") -> DataFrame:
    """A hint appended to the text of matched rows; an empty text becomes the hint."""
    h = hints.groupBy(*keys).agg(F.min(col).alias("_h"))
    j = base.join(h, keys, "left")
    return j.withColumn(col, F.when(F.col("_h").isNull(), F.col(col)).otherwise(F.concat_ws(sep, F.nullif(F.col(col), F.lit("")), "_h"))).drop("_h")
