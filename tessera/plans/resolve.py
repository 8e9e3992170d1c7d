"""Queries of panels, duplicates and ontologies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions.text import NOT_STATED
from tessera.operators import dedupe as D
from tessera.operators import ontology as O
from tessera.operators import panels as P
from tessera.sources.tables import table


def _by_supplier(spark, folder):
    li = table(spark, folder, "lineitem")
    return li.select(F.col("l_suppkey").alias("sample"), F.col("l_partkey").cast("string").alias("gene"))


def _by_order(spark, folder):
    li = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return li.select(F.col("l_orderkey").alias("sample"), F.col("p_type").alias("gene"))


def panel_ids(spark, folder):
    """Panel identities of suppliers."""
    return P.panels(_by_supplier(spark, folder))


def panel_containment(spark, folder):
    """Share of one panel held by another (panels of orders by type)."""
    return P.containment(P.members(_by_order(spark, folder))[1])


def panel_cohorts_greedy(spark, folder):
    """Greedy cohorts of panels per technology (order status), assigned over all of them."""
    samples, genes = P.members(_by_order(spark, folder))
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("sample"), F.col("o_orderstatus").alias("technology"))
    return P.cohorts(samples.join(o, "sample"), genes, min_share=0.9, min_samples=20)


def panel_cohort_seed(spark, folder):
    """The commonest panel per order status and who holds enough of it."""
    samples, genes = P.members(_by_order(spark, folder))
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("sample"), F.col("o_orderstatus").alias("status"))
    return P.seed_cohort(samples.join(o, "sample"), genes, "status", 0.6)


def shared_genes_inner(spark, folder):
    """Parts sold under every return flag and line status."""
    li = table(spark, folder, "lineitem")
    return P.shared_genes(li.select(F.concat("l_returnflag", "l_linestatus").alias("sample"), F.col("l_partkey").alias("gene")))


def outer_null_not_zero(spark, folder):
    """Totals by part and return flag; what is not sold is null."""
    li = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene"), F.col("l_quantity").alias("value"))
    return P.outer_matrix(li, ["A", "N", "R"])


def pair_coverage(spark, folder):
    """Pairs of neighbouring parts of which a supplier has both."""
    pairs = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("a"), (F.col("p_partkey") + 1).cast("string").alias("b"))
    return P.pair_coverage(_by_supplier(spark, folder), pairs)


def dedupe_exact(spark, folder):
    """Equal texts under several sources."""
    d = table(spark, folder, "documents")
    rank = F.when(F.col("kind") == "summary", 0).when(F.col("kind") == "protocol", 1).otherwise(2)
    return D.exact_copies(d, "doc_id", F.nullif(F.col("text"), F.lit("")), "source", [F.when(F.col("lang").isNull(), 1).otherwise(0), rank])


def redundant_keys_antijoin(spark, folder):
    """Documents left when copies are taken out, per kind."""
    d = table(spark, folder, "documents")
    gone = dedupe_exact(spark, folder).select("doc_id").union(d.where("text IS NULL OR text = ''").select("doc_id")).distinct()
    return d.join(gone, "doc_id", "left_anti").groupBy("kind").agg(F.count("*").alias("n"))


def dedupe_aggregate(spark, folder):
    """customers' sums deposited beside their orders."""
    o = table(spark, folder, "orders")
    li = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("units"))
    own = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("accession"), (F.col("o_orderkey") + 10**9).alias("sample_id"), "units")
    k = F.col("accession") % 3
    sums = own.groupBy("accession").agg(F.sum("units").alias("units")).select("accession", F.col("accession").alias("sample_id"), (F.col("units") * F.when(k == 0, 1.0).when(k == 1, 1.03).otherwise(1.2)).alias("units"))
    return D.series_aggregates(own.unionByName(sums))


def dedupe_cross_archive(spark, folder):
    """Archive samples held again under a mirror's accession (every third sample is mirrored)."""
    f = table(spark, folder, "files").where("sample_id IS NOT NULL AND accession IS NOT NULL").groupBy("source", "accession", "sample_id").agg(F.count("*").alias("units"), F.md5(F.concat_ws("|", F.array_sort(F.collect_set("url")))).alias("hash"))
    k = F.regexp_extract("sample_id", r"(\d{1,12})$", 1).try_cast("bigint")
    again = f.where(k % 3 == 0).select(F.lit("Aggregator").alias("source"), F.concat(F.lit("copy-"), "accession").alias("accession"), F.lower("sample_id").alias("sample_id"), (F.col("units") + k % 2).alias("units"), F.when(k % 2 == 0, F.col("hash")).alias("hash"))
    return D.cross_archive(f.unionByName(again), N.archive_id(F.col("sample_id")), F.when(F.col("hash").isNull(), 1).otherwise(0), F.when(F.col("source") == "GEO", 0).otherwise(9))


def _edges(spark, folder):
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    e = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    e = e.union(r.select("r_name", F.lit("WORLD"))).union(n.where("n_nationkey % 3 = 0").select("n_name", F.lit("GROUP A")))
    return e.union(n.limit(1).select(F.lit("GROUP A"), F.lit("WORLD"))).union(n.limit(1).select(F.lit("GROUP A"), F.lit("ASIA")))


def ontology_closure(spark, folder):
    """Ancestors of every term."""
    return O.closure(_edges(spark, folder))


def ontology_levels(spark, folder):
    """Levels of nations in a hierarchy with a diamond."""
    terms = table(spark, folder, "nation").select(F.col("n_name").alias("term"))
    return O.levels(terms, O.closure(_edges(spark, folder)), ["EUROPE", "ASIA", "AFRICA"], ["WORLD", "ASIA", "GROUP A", "AMERICA"])


def hierarchy_confusion(spark, folder):
    """Nations of customers and suppliers compared in the hierarchy."""
    from tessera.operators.relational import hierarchy_confusion as confusion

    n = table(spark, folder, "nation")
    c = table(spark, folder, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ref = F.when(F.col("c_custkey") % 4 == 0, F.col("n_name")).when(F.col("c_custkey") % 4 == 1, F.col("r_name")).when(F.col("c_custkey") % 4 == 2, "ASIA")
    return confusion(c.select(F.col("n_name").alias("a"), ref.alias("b")), "a", "b", O.closure(_edges(spark, folder)))


def label_lookup(spark, folder):
    """Tissues resolved to the reference list by label or synonym."""
    t = table(spark, folder, "canon_terms").where("field_name = 'tissue'").select(F.col("obo_id").alias("id"), "label", F.from_json("synonyms", "array<string>").alias("synonyms"))
    return O.resolve_labels(table(spark, folder, "sample_meta"), "tissue", t)


QUERIES = {
    f.__name__: f
    for f in (panel_ids, panel_containment, panel_cohorts_greedy, panel_cohort_seed, shared_genes_inner, outer_null_not_zero, pair_coverage, dedupe_exact, redundant_keys_antijoin, dedupe_aggregate, dedupe_cross_archive, ontology_closure, ontology_levels, hierarchy_confusion, label_lookup)
}

_BY_ORDER = """g AS (SELECT DISTINCT l_orderkey AS sample, p_type AS gene FROM lineitem JOIN part ON l_partkey = p_partkey),
  p AS (SELECT sample, substr(sha1(array_to_string(list_sort(list(upper(trim(gene)))), chr(10))), 1, 12) AS panel FROM g GROUP BY 1),
  u AS (SELECT DISTINCT panel, gene FROM p JOIN g USING (sample)), z AS (SELECT panel, count(*) AS n FROM u GROUP BY 1),
  s AS (SELECT a.panel AS seed, b.panel, round(count(*) * 1.0 / any_value(z.n), 6) AS share FROM u a JOIN u b ON a.gene = b.gene AND a.panel <> b.panel JOIN z ON z.panel = a.panel GROUP BY 1, 2)"""
_COPIES = """k AS (SELECT doc_id, md5(text) AS h, source, CASE WHEN lang IS NULL THEN 1 ELSE 0 END AS a, CASE kind WHEN 'summary' THEN 0 WHEN 'protocol' THEN 1 ELSE 2 END AS b FROM documents WHERE text <> ''),
  r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY a, b, doc_id) AS best, min(source) OVER (PARTITION BY h) AS lo, max(source) OVER (PARTITION BY h) AS hi FROM k),
  c AS (SELECT doc_id, best AS duplicate_of FROM r WHERE lo <> hi AND doc_id <> best)"""
_EDGES = """e AS (SELECT n_name AS child, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'WORLD' FROM region UNION ALL SELECT n_name, 'GROUP A' FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL VALUES ('GROUP A', 'WORLD'), ('GROUP A', 'ASIA')), cl AS (SELECT child, parent AS ancestor FROM e UNION SELECT cl.child, e.parent FROM cl JOIN e ON cl.ancestor = e.child)"""
_NOT = ", ".join(f"'{x}'" for x in NOT_STATED)
SQL = {
    "panel_ids": "SELECT sample, substr(sha1(array_to_string(list_sort(list(gene)), chr(10))), 1, 12) AS panel, substr(md5(array_to_string(list_sort(list(gene)), '|')), 1, 12) AS key, CAST(count(*) AS INT) AS n_genes FROM (SELECT DISTINCT l_suppkey AS sample, CAST(l_partkey AS VARCHAR) AS gene FROM lineitem) GROUP BY 1",
    "panel_containment": f"WITH {_BY_ORDER} SELECT * FROM s",
    "panel_cohort_seed": f"""WITH {_BY_ORDER}, n AS (SELECT o_orderstatus AS status, panel, count(*) AS n FROM p JOIN orders ON sample = o_orderkey GROUP BY 1, 2),
      b AS (SELECT status, panel AS seed FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY n DESC, panel) AS r FROM n) WHERE r = 1),
      j AS (SELECT n.status, b.seed, n.n, n.panel = b.seed OR coalesce(s.share, 0) >= 0.6 AS i FROM n JOIN b USING (status) LEFT JOIN s ON s.seed = b.seed AND s.panel = n.panel)
      SELECT status, seed, count(*) FILTER (i) AS n_panels, CAST(sum(CASE WHEN i THEN n ELSE 0 END) AS BIGINT) AS n_samples, CAST(sum(CASE WHEN i THEN 0 ELSE n END) AS BIGINT) AS n_excluded FROM j GROUP BY 1, 2""",
    "shared_genes_inner": "SELECT l_partkey AS gene FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag || l_linestatus) = (SELECT count(DISTINCT l_returnflag || l_linestatus) FROM lineitem)",
    "outer_null_not_zero": "SELECT l_partkey AS gene, sum(l_quantity) FILTER (l_returnflag = 'A') AS \"A\", sum(l_quantity) FILTER (l_returnflag = 'N') AS \"N\", sum(l_quantity) FILTER (l_returnflag = 'R') AS \"R\" FROM lineitem GROUP BY 1",
    "pair_coverage": "WITH e AS (SELECT DISTINCT l_suppkey AS sample, l_partkey AS g FROM lineitem), n AS (SELECT a.sample, count(*) AS n FROM e a JOIN e b ON a.sample = b.sample AND a.g + 1 = b.g GROUP BY 1) SELECT DISTINCT e.sample, coalesce(n, 0) AS n_pairs FROM e LEFT JOIN n USING (sample)",
    "dedupe_exact": f"WITH {_COPIES} SELECT * FROM c",
    "redundant_keys_antijoin": f"WITH {_COPIES} SELECT kind, count(*) AS n FROM documents d WHERE coalesce(text, '') <> '' AND NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = d.doc_id) GROUP BY 1",
    "dedupe_aggregate": "SELECT accession, round(own / units, 6) AS ratio, n AS n_siblings FROM (SELECT o_custkey AS accession, sum(u) AS units, count(*) AS n, sum(u) * CASE o_custkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1.03 ELSE 1.2 END AS own FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS u FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1) WHERE own / units <= 1.05",
    "dedupe_cross_archive": r"""WITH f AS (SELECT source, accession, sample_id, count(*) AS units, md5(array_to_string(list_sort(list(DISTINCT url) FILTER (url IS NOT NULL)), '|')) AS hash, TRY_CAST(regexp_extract(sample_id, '(\d{1,12})$', 1) AS BIGINT) AS k FROM files WHERE sample_id IS NOT NULL AND accession IS NOT NULL GROUP BY 1, 2, 3),
      a AS (SELECT source, accession, sample_id, units, hash FROM f UNION ALL SELECT 'Aggregator', 'copy-' || accession, lower(sample_id), units + k % 2, CASE WHEN k % 2 = 0 THEN hash END FROM f WHERE k % 3 = 0),
      r AS (SELECT *, upper(coalesce(nullif(regexp_extract(sample_id, '(?i)(GSM\d{5,})', 1), ''), nullif(regexp_extract(sample_id, '(?i)(E-MTAB-\d+)', 1), ''), nullif(regexp_extract(sample_id, '(?i)(E-GEOD-\d+)', 1), ''), nullif(regexp_extract(sample_id, '(?i)(SRS\d{6,})', 1), ''))) AS archive_id FROM a),
      w AS (SELECT *, first_value(accession) OVER o AS ba, first_value(sample_id) OVER o AS bs, first_value(units) OVER o AS bu, first_value(hash) OVER o AS bh, min(accession) OVER (PARTITION BY archive_id) AS lo, max(accession) OVER (PARTITION BY archive_id) AS hi FROM r WHERE archive_id IS NOT NULL
        WINDOW o AS (PARTITION BY archive_id ORDER BY (hash IS NULL), CASE WHEN source = 'GEO' THEN 0 ELSE 9 END, -units, accession, sample_id))
      SELECT archive_id, CASE WHEN hash IS NOT DISTINCT FROM bh THEN 'identical' ELSE 'reprocessed' END AS kind, accession, sample_id, ba AS duplicate_of, round(units * 1.0 / nullif(bu, 0), 6) AS unit_ratio FROM w WHERE lo <> hi AND (accession <> ba OR sample_id <> bs)""",
    "ontology_closure": f"WITH RECURSIVE {_EDGES} SELECT DISTINCT child, ancestor FROM cl WHERE child <> ancestor",
    "ontology_levels": f"""WITH RECURSIVE {_EDGES}, u AS (SELECT child, ancestor FROM cl UNION SELECT n_name, n_name FROM nation),
      c AS (SELECT child, ancestor, list_position(['WORLD', 'ASIA', 'GROUP A', 'AMERICA'], ancestor) AS p FROM u WHERE ancestor IN ('WORLD', 'ASIA', 'GROUP A', 'AMERICA')),
      s AS (SELECT child, min(p) AS p2 FROM c WHERE NOT EXISTS (SELECT 1 FROM c o JOIN cl ON cl.child = o.ancestor WHERE o.child = c.child AND cl.ancestor = c.ancestor) GROUP BY 1),
      f AS (SELECT child, min(list_position(['EUROPE', 'ASIA', 'AFRICA'], ancestor)) AS p1 FROM u WHERE ancestor IN ('EUROPE', 'ASIA', 'AFRICA') GROUP BY 1)
      SELECT n_name AS term, coalesce(['EUROPE', 'ASIA', 'AFRICA'][p1], 'other') AS level1, coalesce(['WORLD', 'ASIA', 'GROUP A', 'AMERICA'][p2], n_name) AS level2, n_name AS level3 FROM nation LEFT JOIN f ON f.child = n_name LEFT JOIN s ON s.child = n_name""",
    "hierarchy_confusion": f"""WITH RECURSIVE {_EDGES}, d AS (SELECT DISTINCT child, ancestor FROM cl), c AS (SELECT n_name AS a, CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN r_name WHEN 2 THEN 'ASIA' END AS b FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
      SELECT CASE WHEN a IS NULL OR b IS NULL THEN 'unknown' WHEN a = b THEN 'exact' WHEN EXISTS (SELECT 1 FROM d WHERE child = a AND ancestor = b OR child = b AND ancestor = a) THEN 'consistent' ELSE 'conflict' END AS verdict, count(*) AS n FROM c GROUP BY 1""",
    "label_lookup": f"""WITH t AS (SELECT obo_id AS id, label, CAST(synonyms AS JSON)::VARCHAR[] AS syn FROM canon_terms WHERE field_name = 'tissue'), n AS (SELECT id, label, lower(trim(label)) AS k, 0 AS m FROM t UNION ALL SELECT id, label, lower(trim(unnest(syn))), 1 FROM t),
      b AS (SELECT k, min((m, id, label)) AS b FROM n WHERE k IS NOT NULL GROUP BY 1), q AS (SELECT DISTINCT tissue AS query FROM sample_meta)
      SELECT query, coalesce(b[2], 'unknown') AS id, coalesce(b[3], 'unknown') AS label, CASE WHEN b IS NULL THEN 'none' WHEN b[1] = 0 THEN 'exact' ELSE 'fuzzy' END AS match FROM q LEFT JOIN b ON query IS NOT NULL AND lower(trim(query)) NOT IN ({_NOT}) AND lower(regexp_replace(query, '^\\s+|\\s+$', '', 'g')) = k""",
}
