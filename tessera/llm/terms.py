"""Frequency of every distinct term, kept up to date by signed deltas.

State lasts in a named folder: a log of signed occurrences of each term per record, partitioned by a hash of the
record, and per term the occurrences and the number of records, partitioned by a hash of the term. A batch of added,
changed or deleted rows becomes signed counts; only the log's slots of the records that it touches are read, and only
the partitions of the counts that it touches are written anew. A batch is there once its manifest is.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import fingerprint, newest_text, persisted, put_text, scratch, shared_dir

#: The term that every row holds once; the records holding it are all records.
ANY = ""
#: Rows of the first batch for each slot of the log and each partition of the counts.
SLOT_ROWS = 2_000_000
_LOG = "record string, field_name string, term string, n long, slot int"
_COUNTS = "field_name string, term string, occurrences long, records long, part int"


@dataclass
class TermState:
    """A version of the state in ``folder``: ``slots`` of the log, ``batches`` in it, and per partition the version of
    its counts (partitions without terms are absent)."""

    folder: str
    version: int
    slots: int
    batches: list[int]
    parts: dict[str, int]

    def log(self, spark: SparkSession, slots: list[int]) -> DataFrame:
        """Signed occurrences of the records of some slots."""
        paths = [f"{self.folder}/log/batch={b}" for b in self.batches]
        rows = spark.read.schema(_LOG).option("basePath", f"{self.folder}/log").parquet(*paths)
        return rows.where(F.col("slot").isin(slots)).select("record", "field_name", "term", "n", "slot")

    def counts_of(self, spark: SparkSession, parts: list[int] | None = None) -> DataFrame:
        """Counts of some partitions, of all by default."""
        out = spark.createDataFrame([], _COUNTS)
        want = {int(p): v for p, v in self.parts.items() if parts is None or int(p) in parts}
        for v in sorted(set(want.values())):
            out = out.unionByName(spark.read.schema(_COUNTS).parquet(f"{self.folder}/counts-{v}").where(F.col("part").isin([p for p, x in want.items() if x == v])))
        return out


def load(spark: SparkSession, folder: str) -> TermState | None:
    """The latest complete version of the state in a folder, None if there is none."""
    text = newest_text(spark, f"{folder}/manifest-*.json")
    return TermState(**{**json.loads(text), "folder": folder}) if text else None


def _hashed(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def signed_terms(rows: DataFrame, record: str, fields: list[str], pattern: str = "[a-z0-9]+", sign: Column | None = None) -> DataFrame:
    """Signed occurrences (record, field_name, term, n) of a batch, net of what cancels out.

    ``sign`` is 1 for added rows and -1 for deleted ones; a changed row comes twice. Rows without a record key are
    left out. Terms are runs of ``pattern`` in the lower-cased text; null and empty texts hold none.
    """
    src = rows.select(F.col(record).alias("record"), (F.lit(1) if sign is None else sign).cast("bigint").alias("n"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)]).where("record IS NOT NULL")
    lists = [_named(f"f{i}", f, pattern) for i, f in enumerate(fields)]
    every = F.array(F.struct(F.lit(ANY).alias("field_name"), F.lit(ANY).alias("term")))
    return (
        src.select("record", "n", F.explode(F.concat(every, *lists)).alias("t"))
        .groupBy("record", F.col("t.field_name").alias("field_name"), F.col("t.term").alias("term"))
        .agg(F.sum("n").alias("n"))
        .where("n <> 0")
    )


def _named(col: str, name: str, pattern: str) -> Column:
    terms = F.coalesce(F.regexp_extract_all(F.lower(col), F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))
    return F.transform(terms, lambda t: F.struct(F.lit(name).alias("field_name"), t.alias("term")))


def _moved(spark: SparkSession, state: TermState | None, log: DataFrame) -> DataFrame:
    """Net changes (field_name, term, d_occ, d_rec) of a batch ``log``: a record holds a term while its occurrences are above 0."""
    zero, keys = F.lit(0).cast("bigint"), ["slot", "record", "field_name", "term"]
    moved = log.withColumn("before", zero)
    if state is not None:
        touched = [r.slot for r in log.select("slot").distinct().collect()]  # slots are few
        before = state.log(spark, touched).join(log.select("slot", "record").distinct(), ["slot", "record"], "left_semi").groupBy(*keys).agg(F.sum("n").alias("before"))
        moved = log.join(before, keys, "left").withColumn("before", F.coalesce("before", zero))
    holds = lambda c: (c > 0).cast("bigint")
    return moved.groupBy("field_name", "term").agg(F.sum("n").alias("d_occ"), F.sum(holds(F.col("before") + F.col("n")) - holds(F.col("before"))).alias("d_rec"))


def _merged(counts: DataFrame, net: DataFrame) -> DataFrame:
    """Counts with net changes; terms held by no record leave them."""
    plus = lambda a, b: F.coalesce(a, F.lit(0).cast("bigint")) + F.coalesce(b, F.lit(0).cast("bigint"))
    out = net.join(counts.select("field_name", "term", "occurrences", "records"), ["field_name", "term"], "full")
    return out.select("field_name", "term", plus("occurrences", "d_occ").alias("occurrences"), plus("records", "d_rec").alias("records")).where("records > 0")


def apply_delta(spark: SparkSession, state: TermState | None, delta: DataFrame, folder: str | None = None, rows: int = 0) -> TermState:
    """The state after a batch of ``signed_terms``; ``state`` None begins one in ``folder`` (by default a scratch one).

    ``rows`` of the first batch gives the number of slots. Only touched slots are read and only touched partitions
    written; what a failed batch leaves behind is in no manifest.
    """
    n = 0 if state is None else state.version + 1
    slots = max(1, -(-rows // SLOT_ROWS)) if state is None else state.slots
    folder = state.folder if state is not None else folder or scratch(spark, "terms")
    delta.select("record", "field_name", "term", "n", _hashed(slots, "record").alias("slot")).write.mode("overwrite").partitionBy("slot").parquet(f"{folder}/log/batch={n}")
    log = spark.read.schema(_LOG).parquet(f"{folder}/log/batch={n}")
    net = persisted(_moved(spark, state, log).withColumn("part", _hashed(slots, "term")), "term-changes")
    touched = [r.part for r in net.select("part").distinct().collect()]  # partitions are as few as slots
    counts = net if state is None else _merged(state.counts_of(spark, touched), net)
    if state is None:
        counts = net.select("field_name", "term", F.col("d_occ").alias("occurrences"), F.col("d_rec").alias("records")).where("records > 0")
    counts.withColumn("part", _hashed(slots, "term")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{folder}/counts-{n}")
    left = {r.part for r in spark.read.schema(_COUNTS).parquet(f"{folder}/counts-{n}").select("part").distinct().collect()}
    parts = {} if state is None else {p: v for p, v in state.parts.items() if int(p) not in touched}
    out = TermState(folder, n, slots, [*(state.batches if state else []), n], {**parts, **{str(p): n for p in sorted(left)}})
    put_text(spark, f"{folder}/manifest-{n:09d}.json", json.dumps({k: v for k, v in asdict(out).items() if k != "folder"}))
    return out


def after(spark: SparkSession, state: TermState, delta: DataFrame) -> DataFrame:
    """Counts (field_name, term, occurrences, records) as they would be after a batch; the state stays as it is."""
    log = persisted(delta.select("record", "field_name", "term", "n", _hashed(state.slots, "record").alias("slot")), "term-batch")
    return _merged(state.counts_of(spark), _moved(spark, state, log))


def compacted(spark: SparkSession, state: TermState, rows: int = 0) -> TermState:
    """The same counts in a new folder, with one batch in its log, and with slots for ``rows``."""
    whole = state.log(spark, list(range(state.slots))).groupBy("record", "field_name", "term").agg(F.sum("n").alias("n")).where("n <> 0")
    return apply_delta(spark, None, whole, rows=rows)


def marked(counts: DataFrame, rare_below: int = 5, common_above: float = 0.2) -> DataFrame:
    """Rows (field_name, term, occurrences, records, mark): rare, common or null.

    Common is a term held by more than ``common_above`` of all records. One value, the number of records, is read
    from the counts.
    """
    total = counts.where((F.col("field_name") == ANY) & (F.col("term") == ANY)).agg(F.coalesce(F.max("records"), F.lit(0))).first()[0]
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") / F.lit(float(max(total, 1))) > common_above, "common")
    return counts.where(F.col("field_name") != ANY).select("field_name", "term", "occurrences", "records", mark.alias("mark"))


def term_frequencies(rows: DataFrame, record: str, fields: list[str], loaded: str | None = None, **marks) -> DataFrame:
    """``marked`` counts of all terms of ``rows``.

    With ``loaded`` the counts of all rows before the last calendar month are state, named after the files of the
    table, the record and the fields: they are built where that state is not there yet, and the last month's rows
    are merged as a delta. An empty table gives no rows. Extra columns are ignored.
    """
    spark = rows.sparkSession
    if loaded is None:
        state = apply_delta(spark, None, signed_terms(rows, record, fields), rows=rows.count())
        return marked(state.counts_of(spark), **marks)
    cut = last_month(rows, loaded)
    state = base_state(rows, ~cut, record, fields, loaded)
    return marked(after(spark, state, signed_terms(rows.where(cut), record, fields)), **marks)


def last_month(rows: DataFrame, loaded: str) -> Column:
    """Whether a row was loaded in the last calendar month of the table."""
    last = rows.agg(F.date_trunc("month", F.max(loaded)).alias("m")).first()[0]
    return F.coalesce(F.col(loaded) >= F.lit(last), F.lit(False)) if last is not None else F.lit(False)


def base_state(rows: DataFrame, old: Column, record: str, fields: list[str], loaded: str) -> TermState:
    """The state of the ``old`` rows of a table, loaded if it was committed for the same files, else built."""
    spark = rows.sparkSession
    if not rows.inputFiles():
        return apply_delta(spark, None, signed_terms(rows.where(old), record, fields), rows=rows.count())
    folder = f"{shared_dir(spark)}/terms-{fingerprint(rows)}-{'-'.join([record, *fields, loaded])}"
    return load(spark, folder) or apply_delta(spark, None, signed_terms(rows.where(old), record, fields), folder, rows.count())
