"""Queries of the catalogue: manifest, roll-ups, shares, ledgers, keyed rewrites, agreement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions.text import NOT_STATED, norm_key, stated
from tessera.operators import relational as R
from tessera.sources.tables import table

_OK = ["source", "accession"]


def manifest_build(spark, folder):
    """One wide row per order line-up: fact joined to four dimensions, with flags."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"), "c_mktsegment", "c_acctbal")
    n = table(spark, folder, "nation").select(F.col("n_nationkey").alias("cust_nation"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    r = table(spark, folder, "region").select(F.col("r_regionkey").alias("nat_region"), F.col("r_name").alias("name"))
    li = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    m = R.star_join(o, [(c, ["o_custkey"], "cust_"), (n, ["cust_nation"], "nat_"), (r, ["nat_region"], "reg_"), (li, ["o_orderkey"], "li_")])
    m = m.withColumns({"standardised": F.col("li_lines").isNotNull(), "usable": F.col("o_orderstatus").startswith("F") & F.col("li_lines").isNotNull(), "segment": F.when(F.col("cust_c_acctbal") < 0, F.lit("in debt")).otherwise(F.col("cust_c_mktsegment"))})
    core = ["o_orderkey", "o_orderstatus", "reg_name", "nat_name"]
    return m.select(*core, *[c for c in ("segment", "li_lines", "li_quantity", "standardised", "usable")]).withColumn("li_quantity", R.r6(F.col("li_quantity")))


def file_rollup(spark, folder):
    """Files per deposit: rows, done, gigabytes, samples, any failure."""
    f = table(spark, folder, "files").where("accession IS NOT NULL")
    done = F.col("dl_status") == "done"
    return f.groupBy(*_OK).agg(
        F.count("*").alias("files"), F.count_if(done).alias("done"), R.r6(F.coalesce(F.sum(F.when(done, F.col("size_bytes"))), F.lit(0)) / 1e9).alias("gb"), F.count_distinct("sample_id").alias("samples"), F.coalesce(F.bool_or(F.col("dl_status") == "failed"), F.lit(False)).alias("any_failed")
    )


def status_rollup(spark, folder):
    """A1, L1: candidates by source and status."""
    return table(spark, folder, "candidates").groupBy("source", norm_key(F.col("status")).alias("status")).agg(F.count("*").alias("n"))


def load_status_pivot(spark, folder):
    """Download state per source."""
    f = table(spark, folder, "files").where("source IS NOT NULL").withColumn("s", F.when(F.col("dl_status").isin("done", "pending", "failed"), F.col("dl_status")).otherwise("other"))
    return R.pivot_counts(f, "source", "s", ["done", "pending", "failed", "other"])


_META = ["tissue", "donor_id", "disease_state", "age_group", "sex", "preservation"]


def completeness(spark, folder):
    """Share of stated values and different ones per field."""
    return R.completeness(table(spark, folder, "sample_meta"), {c: stated(F.col(c)) for c in _META})


def top_values(spark, folder):
    """A4, L4: the commonest formats."""
    return R.top_values(table(spark, folder, "files"), "fmt", 15)


def composition_tail(spark, folder):
    """The heaviest formats and one row for the rest."""
    return R.composition(table(spark, folder, "files"), "fmt", F.coalesce("size_bytes", F.lit(0)), 14)


def headline(spark, folder):
    """Totals over deposits that are there: files, samples, donors, tissues, bytes."""
    d = table(spark, folder, "datasets").where("removed_at IS NULL AND accession IS NOT NULL").select(norm_key(F.col("source")).alias("s"), norm_key(F.col("accession")).alias("a")).distinct()
    k = [norm_key(F.col("source")).alias("s"), norm_key(F.col("accession")).alias("a")]
    f = table(spark, folder, "files").where(norm_key(F.col("dl_status")) == "done").select(*k, "url", "sample_id", "size_bytes").join(d, ["s", "a"], "left_semi")
    m = table(spark, folder, "sample_meta").select(*k, "donor_id", "tissue").join(d, ["s", "a"], "left_semi")
    files = f.agg(F.count("*").alias("files"), F.count_distinct("url").alias("urls"), F.count_distinct("sample_id").alias("samples"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
    people = m.agg(F.count_distinct(F.when(stated(F.col("donor_id")), F.struct("a", "donor_id"))).alias("donors"), F.count_distinct(F.when(stated(F.col("tissue")), N.tissue(F.col("tissue")))).alias("tissues"))
    # two single rows side by side
    rows = files.select(F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("bigint").alias("value")) for c in files.columns])).alias("x"))
    more = people.select(F.explode(F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("bigint").alias("value")) for c in people.columns])).alias("x"))
    return rows.unionByName(more).select("x.*")


def quantiles_by_group(spark, folder):
    """Quartiles of file sizes per format family."""
    f = table(spark, folder, "files").where("size_bytes IS NOT NULL AND role IS NOT NULL")
    q = [R.r6(F.percentile("size_bytes", F.lit(p))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    return f.groupBy("role").agg(*q)


def describe_by_group(spark, folder):
    """Description of prices per flag."""
    return R.describe(table(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice")


def cumulative_share(spark, folder):
    """Running share of rows by accession of files."""
    return R.cumulative_share(table(spark, folder, "files"), "accession")


def half_coverage(spark, folder):
    """How many accessions hold half and four fifths of the files."""
    return R.coverage_ranks(table(spark, folder, "files"), "accession", [50, 80])


def lorenz_top_pct(spark, folder):
    """Share of files in the top per cent of accessions."""
    return R.top_share(table(spark, folder, "files"), "accession", [1, 5, 10, 25, 50])


_EDGES = [1, 2, 3, 5, 10, 20, 50, 100, 10000]


def size_bins(spark, folder):
    """F32: accessions binned by their number of files."""
    n = table(spark, folder, "files").where("accession IS NOT NULL").groupBy("accession").agg(F.count("*").alias("n"))
    return n.groupBy(R.binned(F.col("n"), _EDGES).alias("bin")).agg(F.count("*").alias("accessions"))


def paired_groups(spark, folder):
    """Formats that have enough matrices and enough coordinates."""
    return R.paired_groups(table(spark, folder, "files"), "fmt", "role", ("matrix", "coords"), 18, 10)


def ledger_last_wins(spark, folder):
    """The last delivered row of each url."""
    f = table(spark, folder, "files").where("url IS NOT NULL").select("url", "dl_status", "size_bytes", "loaded_at", "file_id")
    return R.last_wins(f, ["url"], [F.col("loaded_at"), F.col("file_id")]).select("url", "dl_status", "file_id")


def ledger_pref_status(spark, folder):
    """The most welcome status of each url."""
    f = table(spark, folder, "files").where("url IS NOT NULL").select("url", "dl_status", "file_id")
    return R.preferred_status(f, ["url"], "dl_status", ["done", "deferred", "pending"], [F.col("file_id")]).select("url", "dl_status", "file_id")


def resume_antijoin(spark, folder):
    """Deposits of which no file is done."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").select(*_OK).distinct()
    return R.todo(d, table(spark, folder, "files").withColumnRenamed("dl_status", "status"), _OK, F.col("status") == "done")


def retry_semijoin(spark, folder):
    """Deposits with a skipped file, to be tried again."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").select(*_OK).distinct()
    return R.todo(d, table(spark, folder, "files").withColumnRenamed("dl_status", "status"), _OK, F.col("status") == "done", "skipped")


def _states(spark, folder, n) -> "DataFrame":  # noqa: F821
    s = table(spark, folder, "file_snapshots").where(F.col("snap_date") == n).groupBy("url").agg(F.max("dl_status").alias("dl_status"), F.max("updated").alias("updated"))
    return s


def upsert_rewrite(spark, folder):
    """M1, M6, K1: one snapshot upserted into the one before."""
    return R.upsert(_states(spark, folder, "2025-01-06"), _states(spark, folder, "2025-02-03"), ["url"])


def insert_ignore_count(spark, folder):
    """M2: candidates newly inserted, counted per source."""
    c = table(spark, folder, "candidates").where("source IS NOT NULL AND accession IS NOT NULL").select(*_OK, "url", "title")
    base = table(spark, folder, "datasets").where("accession IS NOT NULL").select(*_OK).distinct()
    return R.insert_new(base, c, _OK).groupBy("source").agg(F.count("*").alias("inserted"))


def _unknown(c: Column) -> Column:
    return ~stated(c)


def _two_sources(spark, folder):
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").select("accession", "source", "technology", "tissue", "disease", "rec_id")
    least = d.groupBy("accession").agg(F.min(F.struct("rec_id", "technology", "tissue", "disease")).alias("r"), F.max(F.struct("rec_id", "technology", "tissue", "disease")).alias("s"))
    base = least.select("accession", "r.technology", "r.tissue", "r.disease")
    other = least.select("accession", "s.technology", "s.tissue", "s.disease")
    return base, other


def fill_with_conflicts(spark, folder):
    """Unknown fields of the first record of a deposit filled from its last."""
    base, other = _two_sources(spark, folder)
    return R.fill_with_conflicts(base, other, ["accession"], ["technology", "tissue", "disease"], _unknown)[0]


def conflict_log(spark, folder):
    """Fields in which the first and the last record differ."""
    base, other = _two_sources(spark, folder)
    return R.fill_with_conflicts(base, other, ["accession"], ["technology", "tissue", "disease"], _unknown)[1]


def no_downgrade(spark, folder):
    """A later extraction that misses records loses none."""
    return R.no_downgrade(_states(spark, folder, "2025-02-03"), _states(spark, folder, "2025-03-03"), ["url"])


def keep_prior(spark, folder):
    """The answer of the snapshot before, where this one has none."""
    st = lambda n: _states(spark, folder, n).select("url", F.coalesce(norm_key(F.col("dl_status")), F.lit("unknown")).alias("dl_status"))
    return R.keep_prior(st("2025-02-03"), st("2025-01-06"), ["url"], "dl_status")


def running_spend_cap(spark, folder):
    """Running spend per user under a cap."""
    e = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return R.running_total(e, "user_id", ["ts", "event_id"], F.col("value"), 500.0).select("event_id", "user_id", "spent", "under_cap")


def agreement_report(spark, folder):
    """Agreement of two records of a deposit."""
    base, other = _two_sources(spark, folder)
    j = base.join(other.toDF("accession", "t2", "ti2", "d2"), "accession")
    return R.agreement(j, {"technology": (F.col("technology"), F.col("t2")), "tissue": (F.col("tissue"), F.col("ti2")), "disease": (F.col("disease"), F.col("d2"))}, _unknown)


def token_join(spark, folder):
    """Candidates matched to datasets by the accession tokens in their links."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL")
    return R.token_join(table(spark, folder, "candidates"), "url", d, "accession", r"GSE\d+|E-MTAB-\d+|HTX-\d+", "cand_id", "rec_id")


def row_key(spark, folder):
    """Compound ids with a mark for nulls, made unique by a suffix."""
    from pyspark.sql.window import Window

    f = table(spark, folder, "files").select("file_id", F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("<NA>")) for c in ("source", "accession", "role")]).alias("key"))
    n = F.row_number().over(Window.partitionBy("key").orderBy("file_id")) - 1
    return f.withColumn("n", n).select("file_id", F.when(F.col("n") == 0, F.col("key")).otherwise(F.concat("key", F.lit("-"), F.col("n").cast("string"))).alias("name"))


def json_links(spark, folder):
    """JSON arrays flattened, joined in order."""
    d = table(spark, folder, "datasets").select("rec_id", F.from_json("links", "array<string>").alias("l"))
    return d.select("rec_id", F.size(F.coalesce("l", F.array().cast("array<string>"))).alias("n"), F.array_join(F.array_sort(F.array_distinct("l")), "; ").alias("links"))


def json_props(spark, folder):
    """JSON properties of events."""
    e = table(spark, folder, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").cast("bigint").alias("sum_k"))


def keyword_union(spark, folder):
    """U8: accessions with all keywords that found them."""
    words = ["lung", "kidney", "visium", "xenium", "atlas"]
    c = table(spark, folder, "candidates").where("accession IS NOT NULL AND title IS NOT NULL")
    hit = F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower("title"), w))
    x = c.select("accession", F.explode(hit).alias("w"))
    return x.groupBy("accession").agg(F.array_join(F.array_sort(F.collect_set("w")), ",").alias("words"))


def record_gate(spark, folder):
    """Deposits called ready whose files have no matrix with coordinates."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").where(norm_key(F.col("verdict")) == "ready").select(*_OK).distinct()
    roles = table(spark, folder, "files").where("accession IS NOT NULL").groupBy(*_OK).agg(F.collect_set(norm_key(F.col("role"))).alias("roles"))
    r = F.coalesce("roles", F.array().cast("array<string>"))
    fine = F.array_contains(r, "matrix+coords") | (F.size(F.array_except(F.array(F.lit("matrix"), F.lit("coords")), r)) == 0)
    return d.join(roles, _OK, "left").where(~fine).select(*_OK)


def sample_cascade(spark, folder):
    """Sample id from the url: the archive's number, else the second folder, else the accession."""
    f = table(spark, folder, "files").where("url IS NOT NULL")
    return f.select("file_id", F.coalesce(N.extract(F.col("url"), r"(GSM\d+)"), N.extract(F.col("url"), r"/data/[^/]+/(.+)_\d+\."), F.col("accession")).alias("sample"))


def name_patterns(spark, folder):
    """Url patterns (digits as #) with counts and an example."""
    f = table(spark, folder, "files").where("url IS NOT NULL")
    p = F.regexp_replace(F.regexp_replace(F.element_at(F.split("url", "/"), -1), r"^GSM\d+_", ""), r"\d+", "#")
    return f.groupBy(p.alias("pattern")).agg(F.count("*").alias("n"), F.count_distinct("accession").alias("accessions"), F.min("url").alias("example")).orderBy(F.desc("n"), "pattern").limit(80)


def reference_coverage(spark, folder):
    """Candidates known, new and ready per source."""
    c = table(spark, folder, "candidates").where("source IS NOT NULL AND accession IS NOT NULL").select(norm_key(F.col("source")).alias("s"), norm_key(F.col("accession")).alias("a")).distinct()
    d = table(spark, folder, "datasets").where("accession IS NOT NULL").groupBy(norm_key(F.col("source")).alias("s"), norm_key(F.col("accession")).alias("a")).agg(F.bool_or(norm_key(F.col("verdict")) == "ready").alias("ready"))
    j = c.join(d.withColumn("known", F.lit(True)), ["s", "a"], "left")
    return j.groupBy(F.col("s").alias("source")).agg(F.count("*").alias("refs"), F.count_if(F.col("known")).alias("known"), F.count_if(F.col("known").isNull()).alias("new"), F.count_if(F.col("ready")).alias("ready"))


def balance_cap(spark, folder):
    """Classes of at least 50 rows; beyond 25,000 rows each is capped, by hash order, at max(50, 25,000 / classes)."""
    d = table(spark, folder, "embeddings").select("vec_id", "label")
    return R.balance(d, "label", [F.md5(F.col("vec_id").cast("string")), F.col("vec_id")]).select("vec_id", "label")


def priority_queue(spark, folder):
    """All pending candidates, other archives before the largest, oldest first."""
    c = table(spark, folder, "candidates").where(norm_key(F.col("status")) == "pending")
    return c.orderBy((F.col("source") == "GEO").asc_nulls_first(), F.col("added").asc_nulls_last(), "cand_id").select("cand_id", "source", "added")


def usage_cost(spark, folder):
    """Cost of events by type at given prices."""
    e = table(spark, folder, "events")
    price = F.when(F.col("event_type") == "purchase", 3.0).when(F.col("event_type") == "view", 0.3).otherwise(1.0)
    return e.groupBy("event_type").agg(R.r6(F.sum(F.col("value") * price / 1e6)).alias("usd"), F.count("*").alias("n"))


def record_dataset(spark, folder):
    """M3: re-recording deposits keeps downloaded files, drops pending ones and adds the new."""
    f = table(spark, folder, "files").where("url IS NOT NULL AND accession IS NOT NULL")
    old = R.last_wins(f.where(F.col("loaded_at") < F.lit("2025-06-01").cast("timestamp_ntz")).select("url", *_OK, "dl_status", "file_id"), ["url"], [F.col("file_id")])
    new = R.last_wins(f.where(F.col("loaded_at") >= F.lit("2025-06-01").cast("timestamp_ntz")).select("url", *_OK, "dl_status", "file_id"), ["url"], [F.col("file_id")])
    recorded = new.select(*_OK).distinct()
    pending = old.where("dl_status = 'pending'").join(recorded, _OK, "left_semi").select("url")
    kept = old.join(pending, "url", "left_anti")
    return kept.unionByName(R.insert_new(kept.select("url"), new, ["url"])).select("url", "dl_status", "file_id")


QUERIES = {
    f.__name__: f
    for f in (
        manifest_build, file_rollup, status_rollup, load_status_pivot, completeness, top_values, composition_tail, headline, quantiles_by_group, describe_by_group, cumulative_share, half_coverage, lorenz_top_pct, size_bins,
        paired_groups, ledger_last_wins, ledger_pref_status, resume_antijoin, retry_semijoin, upsert_rewrite, insert_ignore_count, fill_with_conflicts, conflict_log, no_downgrade, keep_prior, running_spend_cap, agreement_report,
        token_join, row_key, json_links, json_props, keyword_union, record_gate, sample_cascade, name_patterns, reference_coverage, balance_cap, priority_queue, usage_cost, record_dataset,
    )
}

_NOT = ", ".join(f"'{x}'" for x in NOT_STATED)


def _st(c: str) -> str:
    return f"({c} IS NOT NULL AND lower(trim({c})) NOT IN ({_NOT}))"


_CUM = """WITH n AS (SELECT accession AS value, count(*) AS n FROM files WHERE accession IS NOT NULL GROUP BY 1),
  c AS (SELECT value, n, row_number() OVER w AS rank, round(sum(n) OVER (w ROWS UNBOUNDED PRECEDING) * 100 / (SELECT sum(n) FROM n), 6) AS cum_pct FROM n WINDOW w AS (ORDER BY n DESC, value))"""
_TWO = "SELECT accession, arg_min(struct_pack(t := technology, i := tissue, d := disease), rec_id) AS a, arg_max(struct_pack(t := technology, i := tissue, d := disease), rec_id) AS b FROM datasets WHERE accession IS NOT NULL GROUP BY 1"
_SNAP = "SELECT url, max(dl_status) AS dl_status, max(updated) AS updated FROM file_snapshots WHERE snap_date = '{0}' GROUP BY 1"


def _fill(x: str, name: str) -> str:
    return f"CASE WHEN NOT {_st('a.' + x)} AND {_st('b.' + x)} THEN b.{x} ELSE a.{x} END AS {name}"


_LAST = "SELECT url, arg_max(source, file_id) AS source, arg_max(accession, file_id) AS accession, arg_max(coalesce(dl_status, '~'), file_id) AS dl_status, max(file_id) AS file_id FROM files WHERE url IS NOT NULL AND accession IS NOT NULL AND loaded_at {0} TIMESTAMP '2025-06-01' GROUP BY 1"
SQL = {
    "manifest_build": """SELECT o_orderkey, o_orderstatus, r_name AS reg_name, n_name AS nat_name, CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE c_mktsegment END AS segment, lines AS li_lines, round(quantity, 6) AS li_quantity, lines IS NOT NULL AS standardised, starts_with(o_orderstatus, 'F') AND lines IS NOT NULL AS usable
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "file_rollup": "SELECT source, accession, count(*) AS files, count(*) FILTER (dl_status = 'done') AS done, round(coalesce(sum(size_bytes) FILTER (dl_status = 'done'), 0) / 1e9, 6) AS gb, count(DISTINCT sample_id) AS samples, coalesce(bool_or(dl_status = 'failed'), false) AS any_failed FROM files WHERE accession IS NOT NULL GROUP BY 1, 2",
    "status_rollup": "SELECT source, lower(trim(status)) AS status, count(*) AS n FROM candidates GROUP BY 1, 2",
    "load_status_pivot": "SELECT source, count(*) FILTER (dl_status = 'done') AS done, count(*) FILTER (dl_status = 'pending') AS pending, count(*) FILTER (dl_status = 'failed') AS failed, count(*) FILTER (coalesce(dl_status, '') NOT IN ('done', 'pending', 'failed')) AS other, count(*) AS total FROM files WHERE source IS NOT NULL GROUP BY 1",
    "completeness": " UNION ALL ".join(f"SELECT '{c}' AS field, round(avg(CASE WHEN {_st(c)} THEN 1.0 ELSE 0 END) * 100, 6) AS pct_known, count(DISTINCT {c}) FILTER ({_st(c)}) AS n_distinct FROM sample_meta" for c in _META),
    "top_values": "SELECT fmt AS value, count(*) AS n FROM files WHERE fmt IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "composition_tail": "WITH s AS (SELECT fmt AS value, CAST(sum(coalesce(size_bytes, 0)) AS BIGINT) AS w FROM files WHERE fmt IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY w DESC, value) AS r FROM s) SELECT value, w FROM r WHERE r <= 14 UNION ALL SELECT count(*) || ' rarer values', CAST(sum(w) AS BIGINT) FROM r WHERE r > 14 HAVING count(*) > 0",
    "headline": f"""WITH d AS (SELECT DISTINCT lower(trim(source)) AS s, lower(trim(accession)) AS a FROM datasets WHERE removed_at IS NULL AND accession IS NOT NULL),
      f AS (SELECT * FROM files SEMI JOIN d ON lower(trim(source)) = s AND lower(trim(accession)) = a WHERE lower(trim(dl_status)) = 'done'), m AS (SELECT * FROM sample_meta SEMI JOIN d ON lower(trim(source)) = s AND lower(trim(accession)) = a)
      SELECT 'files' AS figure, count(*) AS value FROM f UNION ALL SELECT 'urls', count(DISTINCT url) FROM f UNION ALL SELECT 'samples', count(DISTINCT sample_id) FROM f UNION ALL SELECT 'bytes', CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM f
      UNION ALL SELECT 'donors', count(DISTINCT (lower(trim(accession)), donor_id)) FILTER ({_st('donor_id')}) FROM m
      UNION ALL SELECT 'tissues', count(DISTINCT coalesce(nullif(substr(lower(trim(split_part(split_part(tissue, ';', 1), ',', 1), ' ')), 1, 40), ''), 'unspecified')) FILTER ({_st('tissue')}) FROM m""",
    "quantiles_by_group": "SELECT role, round(quantile_cont(size_bytes, 0.25), 6) AS q1, round(quantile_cont(size_bytes, 0.5), 6) AS median, round(quantile_cont(size_bytes, 0.75), 6) AS q3 FROM files WHERE size_bytes IS NOT NULL AND role IS NOT NULL GROUP BY 1",
    "describe_by_group": "SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev(l_extendedprice), 6) AS std, round(min(l_extendedprice), 6) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, round(max(l_extendedprice), 6) AS max FROM lineitem GROUP BY 1",
    "cumulative_share": f"{_CUM} SELECT value, n, CAST(rank AS INT) AS rank, cum_pct FROM c",
    "half_coverage": f"{_CUM} SELECT 50 AS pct, CAST(min(rank) FILTER (cum_pct >= 50) AS INT) AS \"values\" FROM c UNION ALL SELECT 80, CAST(min(rank) FILTER (cum_pct >= 80) AS INT) FROM c",
    "lorenz_top_pct": f"{_CUM} SELECT q AS top_pct, (SELECT max(cum_pct) FROM c WHERE rank = greatest(CAST(floor((SELECT count(*) FROM c) * q / 100) AS BIGINT), 1)) AS share FROM (SELECT unnest([1, 5, 10, 25, 50]) AS q)",
    "size_bins": "WITH n AS (SELECT count(*) AS n FROM files WHERE accession IS NOT NULL GROUP BY accession) SELECT CASE " + " ".join(f"WHEN n >= {a} AND n < {b} THEN '[{a}, {b})'" for a, b in zip(_EDGES, _EDGES[1:])) + " END AS bin, count(*) AS accessions FROM n GROUP BY 1",
    "paired_groups": "WITH t AS (SELECT fmt FROM files WHERE fmt IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, fmt LIMIT 18) SELECT fmt, count(*) FILTER (role = 'matrix') AS n_a, count(*) FILTER (role = 'coords') AS n_b FROM files WHERE fmt IN (SELECT fmt FROM t) GROUP BY 1 HAVING n_a >= 10 AND n_b >= 10",
    "ledger_last_wins": "SELECT url, dl_status, file_id FROM (SELECT url, dl_status, file_id, row_number() OVER (PARTITION BY url ORDER BY loaded_at DESC NULLS LAST, file_id DESC) AS r FROM files WHERE url IS NOT NULL) WHERE r = 1",
    "ledger_pref_status": "SELECT url, dl_status, file_id FROM (SELECT url, dl_status, file_id, row_number() OVER (PARTITION BY url ORDER BY CASE dl_status WHEN 'done' THEN 1 WHEN 'deferred' THEN 2 WHEN 'pending' THEN 3 ELSE 4 END, file_id DESC) AS r FROM files WHERE url IS NOT NULL) WHERE r = 1",
    "resume_antijoin": "SELECT DISTINCT d.source, d.accession FROM datasets d WHERE d.accession IS NOT NULL AND NOT EXISTS (SELECT 1 FROM files f WHERE f.source = d.source AND f.accession = d.accession AND f.dl_status = 'done')",
    "retry_semijoin": "SELECT DISTINCT d.source, d.accession FROM datasets d WHERE d.accession IS NOT NULL AND EXISTS (SELECT 1 FROM files f WHERE f.source = d.source AND f.accession = d.accession AND starts_with(f.dl_status, 'skipped'))",
    "upsert_rewrite": f"WITH a AS ({_SNAP.format('2025-01-06')}), b AS ({_SNAP.format('2025-02-03')}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.url = a.url)",
    "insert_ignore_count": "SELECT source, count(DISTINCT accession) AS inserted FROM candidates c WHERE source IS NOT NULL AND accession IS NOT NULL AND NOT EXISTS (SELECT 1 FROM datasets d WHERE d.source = c.source AND d.accession = c.accession) GROUP BY 1",
    "fill_with_conflicts": f"SELECT accession, {_fill('t', 'technology')}, {_fill('i', 'tissue')}, {_fill('d', 'disease')} FROM ({_TWO})",
    "conflict_log": " UNION ALL ".join(f"SELECT accession, '{n}' AS field, a.{x} AS base_value, b.{x} AS other_value FROM ({_TWO}) WHERE {_st('a.' + x)} AND {_st('b.' + x)} AND lower(a.{x}) <> lower(b.{x})" for x, n in (("t", "technology"), ("i", "tissue"), ("d", "disease"))),
    "no_downgrade": f"WITH a AS ({_SNAP.format('2025-02-03')}), b AS ({_SNAP.format('2025-03-03')}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.url = a.url)",
    "keep_prior": f"WITH a AS ({_SNAP.format('2025-01-06')}), b AS ({_SNAP.format('2025-02-03')}), j AS (SELECT b.url, coalesce(lower(trim(b.dl_status)), 'unknown') AS n, lower(trim(a.dl_status)) AS o FROM b LEFT JOIN a ON a.url = b.url) SELECT url, CASE WHEN n = 'unknown' AND o IS NOT NULL THEN o ELSE n END AS dl_status, n = 'unknown' AND o IS NOT NULL AS kept FROM j",
    "running_spend_cap": "SELECT event_id, user_id, round(s, 6) AS spent, s < 500 AS under_cap FROM (SELECT event_id, user_id, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events)",
    "agreement_report": " UNION ALL ".join(
        f"SELECT '{n}' AS field, n_ref, agree, unknown, round(agree * 100.0 / nullif(n_ref - unknown, 0), 6) AS pct FROM (SELECT count(*) FILTER ({_st('b.' + x)}) AS n_ref, count(*) FILTER ({_st('b.' + x)} AND lower(a.{x}) = lower(b.{x})) AS agree, count(*) FILTER ({_st('b.' + x)} AND NOT {_st('a.' + x)}) AS unknown FROM ({_TWO}))"
        for x, n in (("t", "technology"), ("i", "tissue"), ("d", "disease"))
    ),
    "token_join": r"""WITH l AS (SELECT cand_id, unnest(list_transform(regexp_extract_all(url, 'GSE\d+|E-MTAB-\d+|HTX-\d+'), lambda x: upper(x))) AS token, generate_subscripts(regexp_extract_all(url, 'GSE\d+|E-MTAB-\d+|HTX-\d+'), 1) AS pos FROM candidates),
      r AS (SELECT min(rec_id) AS rec_id, token FROM (SELECT rec_id, unnest(list_transform(regexp_extract_all(accession, 'GSE\d+|E-MTAB-\d+|HTX-\d+'), lambda x: upper(x))) AS token FROM datasets WHERE accession IS NOT NULL) GROUP BY 2)
      SELECT cand_id, arg_min(rec_id, pos) AS rec_id, arg_min(token, pos) AS token FROM l JOIN r USING (token) GROUP BY 1""",
    "row_key": "SELECT file_id, CASE WHEN n = 0 THEN k ELSE k || '-' || n END AS name FROM (SELECT file_id, k, row_number() OVER (PARTITION BY k ORDER BY file_id) - 1 AS n FROM (SELECT file_id, coalesce(source, '<NA>') || '_' || coalesce(accession, '<NA>') || '_' || coalesce(role, '<NA>') AS k FROM files))",
    "json_links": "SELECT rec_id, CAST(coalesce(len(l), 0) AS INT) AS n, array_to_string(list_sort(list_distinct(l)), '; ') AS links FROM (SELECT rec_id, CAST(links AS JSON)::VARCHAR[] AS l FROM datasets)",
    "json_props": "SELECT event_type, count(CAST(props::JSON->>'k' AS INT)) AS n, CAST(sum(CAST(props::JSON->>'k' AS INT)) AS BIGINT) AS sum_k FROM events GROUP BY 1",
    "keyword_union": "SELECT accession, string_agg(DISTINCT w, ',' ORDER BY w) AS words FROM candidates, (SELECT unnest(['lung', 'kidney', 'visium', 'xenium', 'atlas']) AS w) WHERE accession IS NOT NULL AND contains(lower(title), w) GROUP BY 1",
    "record_gate": "WITH r AS (SELECT source, accession, bool_or(lower(trim(role)) = 'matrix+coords') AS b, bool_or(lower(trim(role)) = 'matrix') AS m, bool_or(lower(trim(role)) = 'coords') AS c FROM files GROUP BY 1, 2) SELECT DISTINCT d.source, d.accession FROM datasets d LEFT JOIN r ON r.source = d.source AND r.accession = d.accession WHERE d.accession IS NOT NULL AND lower(trim(verdict)) = 'ready' AND NOT coalesce(b OR m AND c, false)",
    "sample_cascade": r"SELECT file_id, coalesce(nullif(regexp_extract(url, '(GSM\d+)', 1), ''), nullif(regexp_extract(url, '/data/[^/]+/(.+)_\d+\.', 1), ''), accession) AS sample FROM files WHERE url IS NOT NULL",
    "name_patterns": r"SELECT regexp_replace(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '^GSM\d+_', ''), '\d+', '#', 'g') AS pattern, count(*) AS n, count(DISTINCT accession) AS accessions, min(url) AS example FROM files WHERE url IS NOT NULL GROUP BY 1 ORDER BY n DESC, pattern LIMIT 80",
    "reference_coverage": "WITH c AS (SELECT DISTINCT lower(trim(source)) AS s, lower(trim(accession)) AS a FROM candidates WHERE source IS NOT NULL AND accession IS NOT NULL), d AS (SELECT lower(trim(source)) AS s, lower(trim(accession)) AS a, bool_or(lower(trim(verdict)) = 'ready') AS r FROM datasets WHERE accession IS NOT NULL GROUP BY 1, 2) SELECT c.s AS source, count(*) AS refs, count(d.s) AS known, count(*) FILTER (d.s IS NULL) AS new, count(*) FILTER (r) AS ready FROM c LEFT JOIN d ON c.s = d.s AND c.a = d.a GROUP BY 1",
    "balance_cap": """WITH c AS (SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1 HAVING count(*) >= 50), t AS (SELECT sum(n) AS total, count(*) AS classes FROM c),
      r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) AS r FROM embeddings SEMI JOIN c USING (label))
      SELECT vec_id, label FROM r, t WHERE total <= 25000 OR r <= greatest(50, 25000 // classes)""",
    "priority_queue": "SELECT cand_id, source, added FROM candidates WHERE lower(trim(status)) = 'pending' ORDER BY (source = 'GEO') NULLS FIRST, added NULLS LAST, cand_id",
    "usage_cost": "SELECT event_type, round(sum(value * CASE event_type WHEN 'purchase' THEN 3.0 WHEN 'view' THEN 0.3 ELSE 1.0 END / 1e6), 6) AS usd, count(*) AS n FROM events GROUP BY 1",
    "record_dataset": f"""WITH o AS ({_LAST.format('<')}), n AS ({_LAST.format('>=')}), k AS (SELECT * FROM o WHERE NOT (dl_status = 'pending' AND EXISTS (SELECT 1 FROM n WHERE n.source = o.source AND n.accession = o.accession)))
      SELECT url, nullif(dl_status, '~') AS dl_status, file_id FROM (SELECT * FROM k UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.url = n.url))""",
}
