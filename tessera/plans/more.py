"""Queries of the remaining catalogue operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import names as N
from tessera.functions.text import norm_key
from tessera.operators import relational as R
from tessera.sources.tables import table


def containment_join(spark, folder):
    """Technologies and assays of which one name holds the other."""
    d = table(spark, folder, "datasets").select(N.snake(F.col("technology")).alias("technology"))
    return R.containment_join(d, "technology", table(spark, folder, "sample_meta").select(N.snake(F.col("assay")).alias("assay")), "assay")


def positional_join(spark, folder):
    """Files of an accession's first role paired by order with its second, where both are as many."""
    f = table(spark, folder, "files").where("accession IS NOT NULL")
    w = Window.partitionBy("accession", "role").orderBy("file_id")
    f = f.withColumn("ordinal", F.row_number().over(w))
    a = f.where("role = 'matrix'").select("accession", "ordinal", F.col("file_id").alias("matrix_id"))
    b = f.where("role = 'coords'").select("accession", "ordinal", F.col("file_id").alias("coords_id"))
    return R.positional_join(a, b, ["accession"], "ordinal")


def status_transition(spark, folder):
    """M5: download states after a run: large ones skipped, fetched ones done, others failed or still pending."""
    f = table(spark, folder, "files")
    open_ = norm_key(F.coalesce("dl_status", F.lit("pending"))) == "pending"
    new = F.when(~open_, F.col("dl_status")).when(F.col("size_bytes") > 500_000_000, "skipped_large").when(F.col("local_path").isNotNull(), "done").when(F.col("dl_msg").isNotNull(), "failed").otherwise("pending")
    return f.groupBy(norm_key(F.coalesce("dl_status", F.lit("pending"))).alias("before"), norm_key(new).alias("after")).agg(F.count("*").alias("n"))


def appended_reasons(spark, folder):
    """M7: a hint appended to the reasons of candidates that are deposited."""
    c = table(spark, folder, "candidates").select("cand_id", "accession", "reason")
    h = table(spark, folder, "datasets").where("accession IS NOT NULL AND notes IS NOT NULL").select("accession", F.col("notes").alias("reason"))
    return R.append_text(c, h, ["accession"], "reason")


def backfilled(spark, folder):
    """Unknown tissues filled from another record of the deposit, never overwriting a known one."""
    from tessera.functions.text import stated

    d = table(spark, folder, "datasets").where("accession IS NOT NULL").groupBy("accession").agg(F.min(F.struct("rec_id", "tissue")).alias("r"), F.min(F.when(stated(F.col("tissue")), F.col("tissue"))).alias("any"))
    base = d.select("accession", "r.tissue")
    fill = d.where(~stated(F.col("r.tissue"))).where("any IS NOT NULL").select("accession", F.col("any").alias("tissue"))
    return R.guarded_fill(base, fill, ["accession"], "tissue", lambda c: ~stated(c))


def merged_maps(spark, folder):
    """two maps of a record's facts merged, the last one winning."""
    d = table(spark, folder, "datasets")
    first = F.create_map(F.lit("tissue"), F.col("tissue"), F.lit("technology"), F.col("technology"))
    last = F.when(F.col("disease").isNotNull(), F.create_map(F.lit("tissue"), F.col("disease"))).otherwise(F.create_map().cast("map<string,string>"))
    kept = F.map_filter(first, lambda k, v: ~F.map_contains_key(last, k))
    return d.select("rec_id", F.map_concat(kept, last).alias("m")).select("rec_id", F.col("m")["tissue"].alias("tissue"), F.col("m")["technology"].alias("technology"))


def payload_hash(spark, folder):
    """hash of a sample's values in order, to tell equal data by."""
    li = table(spark, folder, "lineitem")
    s = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q")))).alias("v"))
    return s.select("l_orderkey", F.md5(F.array_join(F.transform("v", lambda x: x["q"].cast("string")), ",")).alias("hash"))


def grid_slices(spark, folder):
    """Occupied bins of a grid of slices with their numbers and coordinates, empty genes left out."""
    li = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("gene"), (F.col("l_orderkey") % 97).alias("row"), (F.col("l_suppkey") % 53).alias("col"), F.col("l_quantity").alias("v"))
    full = li.groupBy("gene").agg(F.sum("v").alias("s")).where("s > 0").select("gene")
    b = li.join(full, "gene", "left_semi").groupBy("row", "col").agg(F.sum("v").alias("total"), F.count_distinct("gene").alias("genes"))
    return b.select((F.col("row") * 53 + F.col("col")).alias("bin"), (F.col("col") * 2.0).alias("x"), (F.col("row") * 2.0).alias("y"), R.r6(F.col("total")).alias("total"), "genes")


def file_places(spark, folder):
    """Where a file is stored, by source, accession and name."""
    f = table(spark, folder, "files").where("url IS NOT NULL")
    name = F.regexp_replace(F.element_at(F.split("url", "/"), -1), "[?#].*$", "")
    return f.select("file_id", F.concat_ws("/", N.safe_name(F.coalesce("source", F.lit("unknown"))), N.safe_name(F.coalesce("accession", F.lit("unknown"))), N.safe_name(name)).alias("place"))


def hidden_images(spark, folder):
    """A listing without images, with how many are hidden."""
    f = table(spark, folder, "files").where("url IS NOT NULL AND accession IS NOT NULL").withColumn("role2", N.file_role(F.col("url")))
    return f.groupBy("accession").agg(F.count_if(F.col("role2") != "image").alias("shown"), F.count_if(F.col("role2") == "image").alias("hidden"))


def epoch_dates(spark, folder):
    """F-date: epoch seconds as text, ledger style."""
    d = table(spark, folder, "datasets")
    return d.select("rec_id", F.date_format(F.timestamp_seconds(F.floor("updated").cast("bigint")), "yyyy-MM-dd HH:mm").alias("updated_at"))


QUERIES = {f.__name__: f for f in (containment_join, positional_join, status_transition, appended_reasons, backfilled, merged_maps, payload_hash, grid_slices, file_places, hidden_images, epoch_dates)}

_SNAKE = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '_', 'g'), '_')"
_ST = "(tissue IS NOT NULL AND lower(trim(tissue)) NOT IN ('', 'unknown', 'n/a', 'na', 'none', 'nan', 'not reported'))"
_SAFE = "substr(regexp_replace({0}, '[^A-Za-z0-9._\\-]+', '_', 'g'), 1, 150)"


def _image_sql() -> str:
    base = "regexp_extract(lower(url), '([^/]*)$', 1)"
    before = "|".join(f"(?:{p})" for p, r in N.FILE_ROLES[:2])
    image = N.FILE_ROLES[2][0]
    return f"(NOT starts_with({base}, '._') AND NOT contains({base}, 'raw_feature_bc_matrix') AND NOT regexp_matches({base}, '{before}') AND regexp_matches({base}, '{image}'))"


SQL = {
    "containment_join": f"WITH a AS (SELECT DISTINCT {_SNAKE.format('technology')} AS technology FROM datasets), b AS (SELECT DISTINCT {_SNAKE.format('assay')} AS assay FROM sample_meta) SELECT technology, assay FROM a JOIN b ON contains(technology, assay) OR contains(assay, technology) WHERE technology <> '' AND assay <> ''",
    "positional_join": "WITH f AS (SELECT accession, role, file_id, CAST(row_number() OVER (PARTITION BY accession, role ORDER BY file_id) AS INT) AS ordinal, count(*) OVER (PARTITION BY accession, role) AS n FROM files WHERE accession IS NOT NULL) SELECT a.accession, a.ordinal, a.file_id AS matrix_id, b.file_id AS coords_id FROM f a JOIN f b ON a.accession = b.accession AND a.ordinal = b.ordinal AND a.n = b.n WHERE a.role = 'matrix' AND b.role = 'coords'",
    "status_transition": "SELECT lower(trim(coalesce(dl_status, 'pending'))) AS before, lower(trim(CASE WHEN lower(trim(coalesce(dl_status, 'pending'))) <> 'pending' THEN dl_status WHEN size_bytes > 500000000 THEN 'skipped_large' WHEN local_path IS NOT NULL THEN 'done' WHEN dl_msg IS NOT NULL THEN 'failed' ELSE 'pending' END)) AS after, count(*) AS n FROM files GROUP BY 1, 2",
    "appended_reasons": "WITH h AS (SELECT accession, min(notes) AS h FROM datasets WHERE accession IS NOT NULL AND notes IS NOT NULL GROUP BY 1) SELECT c.cand_id, c.accession, CASE WHEN h IS NULL THEN reason WHEN coalesce(reason, '') = '' THEN h ELSE reason || ' | ' || h END AS reason FROM candidates c LEFT JOIN h USING (accession)",
    "backfilled": f"WITH d AS (SELECT accession, arg_min(struct_pack(t := tissue), rec_id).t AS t, min(tissue) FILTER ({_ST}) AS a FROM datasets WHERE accession IS NOT NULL GROUP BY 1) SELECT accession, CASE WHEN {_ST.replace('tissue', 't')} THEN t ELSE coalesce(a, t) END AS tissue FROM d",
    "merged_maps": "SELECT rec_id, coalesce(disease, tissue) AS tissue, technology FROM datasets",
    "payload_hash": "SELECT l_orderkey, md5(string_agg(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), ',' ORDER BY l_linenumber, l_quantity)) AS hash FROM lineitem GROUP BY 1",
    "grid_slices": "WITH g AS (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 0) SELECT l_orderkey % 97 * 53 + l_suppkey % 53 AS bin, l_suppkey % 53 * 2.0::DOUBLE AS x, l_orderkey % 97 * 2.0::DOUBLE AS y, round(sum(l_quantity), 6) AS total, count(DISTINCT l_partkey) AS genes FROM lineitem SEMI JOIN g USING (l_partkey) GROUP BY 1, 2, 3",
    "file_places": f"SELECT file_id, {_SAFE.format(chr(99) + 'oalesce(source, ' + chr(39) + 'unknown' + chr(39) + ')')} || '/' || {_SAFE.format('coalesce(accession, ' + chr(39) + 'unknown' + chr(39) + ')')} || '/' || {_SAFE.format('regexp_replace(regexp_extract(url, ' + chr(39) + '([^/]*)$' + chr(39) + ', 1), ' + chr(39) + '[?#].*$' + chr(39) + ', ' + chr(39) + chr(39) + ')')} AS place FROM files WHERE url IS NOT NULL",
    "hidden_images": f"SELECT accession, count(*) FILTER (NOT {_image_sql()}) AS shown, count(*) FILTER ({_image_sql()}) AS hidden FROM files WHERE url IS NOT NULL AND accession IS NOT NULL GROUP BY 1",
    "epoch_dates": "SELECT rec_id, strftime(make_timestamp(CAST(floor(updated) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M') AS updated_at FROM datasets",
}
