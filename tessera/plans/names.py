"""Queries of text rules, on the catalogue's own names and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions.text import NOT_STATED
from tessera.sources.tables import table


def file_roles(spark, folder):
    """Role of every file by its url, against the role on record."""
    f = table(spark, folder, "files").where("url IS NOT NULL")
    return f.select(N.file_role(F.col("url")).alias("by_name"), F.lower(F.trim("role")).alias("on_record")).groupBy("by_name", "on_record").agg(F.count("*").alias("n"))


def technology_names(spark, folder):
    """normalised technology of every dataset and of the words in titles."""
    d = table(spark, folder, "datasets")
    return d.select("rec_id", N.technology(F.col("technology")).alias("technology"), N.technology(F.col("title")).alias("in_title"))


def tissue_names(spark, folder):
    """normalised tissue and its snake case."""
    d = table(spark, folder, "datasets")
    return d.select("rec_id", N.tissue(F.col("tissue")).alias("tissue"), N.snake(F.col("tissue")).alias("snake"))


def slug_tags(spark, folder):
    """safe and unambiguous output names."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL AND source IS NOT NULL")
    return d.select("rec_id", N.safe_name(F.col("url")).alias("safe"), N.slug_tag(F.col("source"), F.col("accession")).alias("tag"))


def archive_ids(spark, folder):
    """archive accessions named in sample ids."""
    return table(spark, folder, "files").select("file_id", N.archive_id(F.col("sample_id")).alias("archive_id"))


def links(spark, folder):
    """source and accession of links (accessions set into several archives' link forms)."""
    d = table(spark, folder, "datasets").where("accession IS NOT NULL")
    n = F.regexp_extract("accession", r"(\d+)", 1)
    form = F.col("rec_id") % 7
    url = (
        F.when(form == 0, F.concat(F.lit("https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GSE"), n)).when(form == 1, F.concat(F.lit("https://zenodo.org/records/"), n)).when(form == 2, F.concat(F.lit("doi:10.5281/zenodo."), n))
        .when(form == 3, F.concat(F.lit("https://figshare.com/articles/dataset/x/"), n)).when(form == 4, F.concat(F.lit("https://www.10xgenomics.com/datasets/slug-"), n, F.lit("?page=2#top"))).when(form == 5, F.col("url"))
        .otherwise(F.concat(F.lit("http://www.example.example/E-MTAB-"), n, F.lit("/")))
    )
    x = d.select("rec_id", url.alias("url")).withColumn("to", N.link(F.col("url")))
    return x.select("rec_id", F.col("to.source").alias("source"), F.col("to.accession").alias("accession"), N.link_host(F.col("url")).alias("host"), N.link_accession(F.col("url")).alias("by_host"))


def byte_sizes(spark, folder):
    """sizes written with a unit, as bytes."""
    f = table(spark, folder, "files").where("size_bytes IS NOT NULL")
    text = F.when(F.col("file_id") % 3 == 0, F.concat(F.floor(F.col("size_bytes") / 1000).cast("string"), F.lit("K"))).when(F.col("file_id") % 3 == 1, F.concat(F.floor(F.col("size_bytes") / 1000000).cast("string"), F.lit(".5 m"))).otherwise(F.col("size_bytes").cast("string"))
    return f.select("file_id", N.size_to_bytes(text).alias("bytes"))


def gene_names(spark, folder):
    """Gene names in several dialects, and three definitions of control probes."""
    p = table(spark, folder, "part")
    forms = ["GRCh38_", "", "hg19-", ""]
    ends = ["-v1-prime", ".13", "-prime-with-v1-seg", "-seg", "", "_v2"]
    base = F.regexp_replace(F.upper("p_name"), "[^A-Z0-9]", "")
    name = F.concat(F.element_at(F.array(*map(F.lit, forms)), (F.col("p_partkey") % 4 + 1).cast("int")), base, F.element_at(F.array(*map(F.lit, ends)), (F.col("p_partkey") % 6 + 1).cast("int")))
    name = F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("NegControlProbe_"), F.col("p_partkey").cast("string"))).when(F.col("p_partkey") % 13 == 0, F.concat(F.lit("Blank-"), F.col("p_size").cast("string"))).otherwise(name)
    p = p.select("p_partkey", name.alias("name"))
    flags = [N.is_control(F.col("name"), d).alias(f"control_{d}") for d in N.CONTROL_PROBES]
    return p.select("p_partkey", "name", N.gene_symbol(F.col("name")).alias("symbol"), N.without_probe_version(F.col("name")).alias("bare"), *flags)


def cell_classes(spark, folder):
    """Major class of cell types, the words of documents and tissues standing for labels."""
    d = table(spark, folder, "canon_terms").select("term_id", N.cell_class(F.col("label")).alias("class"))
    return d


def age_bins(spark, folder):
    """age group and stage label by number and unit."""
    c = table(spark, folder, "customer")
    k = F.col("c_custkey")
    num = F.when(k % 17 == 0, None).otherwise((k % 97).cast("double") + F.when(k % 2 == 0, 0.5).otherwise(0.0))
    unit = F.element_at(F.array(*map(F.lit, ("year", "month", "week", "day", "unknown"))), (k % 5 + 1).cast("int"))
    return c.select("c_custkey", N.age_fields(num, unit, k % 3 == 0).alias("a")).select("c_custkey", "a.age_group", "a.stage")


def html_pages(spark, folder):
    """Text and links of pages; the documents' texts set into a page."""
    d = table(spark, folder, "documents").where("text IS NOT NULL")
    page = F.concat(F.lit("<html><style>p {x}</style><script>var a = '<b>';</script><p>"), F.col("text"), F.lit("</p>&amp;&nbsp;<a href='https://a.example/x'>one</a> <a href=\"/y\">two</a></html>"))
    return d.select("doc_id", N.html_text(page).alias("text"), N.html_links(page).alias("links")).select("doc_id", F.length("text").alias("n"), F.md5("text").alias("hash"), F.array_join("links", " ").alias("links"))


def member_samples(spark, folder):
    """first telling folder of a path, and the archive's stem."""
    f = table(spark, folder, "files").where("local_path IS NOT NULL")
    return f.select("file_id", N.member_sample(F.col("local_path"), ["raw", "outs", "data"]).alias("sample"), N.archive_stem(F.concat(F.col("local_path"), F.lit(".tar.gz"))).alias("stem"))


def stated_flags(spark, folder):
    """Missing values: spellings of 'unknown' counted per column."""
    m = table(spark, folder, "sample_meta")
    cols = ["tissue", "sex", "age_unit", "age_group", "disease_state", "donor_id", "preservation"]
    long = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.lower(F.trim(c)).alias("v")) for c in cols])).alias("x")).select("x.*")
    return long.where(F.col("v").isNull() | F.col("v").isin(*NOT_STATED)).groupBy("field", F.coalesce("v", F.lit("<null>")).alias("spelling")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (file_roles, technology_names, tissue_names, slug_tags, archive_ids, links, byte_sizes, gene_names, cell_classes, age_bins, html_pages, member_samples, stated_flags)}


def _rules_sql(text: str, rules, otherwise: str, literal: bool = False) -> str:
    q = lambda s: s.replace("'", "''")
    test = (lambda p: f"contains({text}, '{q(p)}')") if literal else (lambda p: f"regexp_matches({text}, '{q(p)}')")
    return "CASE " + " ".join(f"WHEN {test(p)} THEN '{q(v)}'" for p, v in rules) + f" ELSE {otherwise} END"


_BASE = "regexp_extract(lower(url), '([^/]*)$', 1)"
_ROLE = f"CASE WHEN starts_with({_BASE}, '._') THEN 'other' WHEN contains({_BASE}, 'raw_feature_bc_matrix') THEN 'matrix_raw' ELSE {_rules_sql(_BASE, N.FILE_ROLES, chr(39) + 'other' + chr(39))} END"


def _tech(c: str) -> str:
    t = f"lower(coalesce({c}, ''))"
    return _rules_sql(t, N.TECHNOLOGIES, f"CASE WHEN {t} = '' THEN 'Unknown' ELSE 'Other' END", literal=True)


_NUM = "regexp_extract(accession, '(\\d+)', 1)"
_URL = f"""CASE rec_id % 7 WHEN 0 THEN 'https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GSE' || {_NUM} WHEN 1 THEN 'https://zenodo.org/records/' || {_NUM} WHEN 2 THEN 'doi:10.5281/zenodo.' || {_NUM}
  WHEN 3 THEN 'https://figshare.com/articles/dataset/x/' || {_NUM} WHEN 4 THEN 'https://www.10xgenomics.com/datasets/slug-' || {_NUM} || '?page=2#top' WHEN 5 THEN url ELSE 'http://www.example.example/E-MTAB-' || {_NUM} || '/' END"""
_NOT = ", ".join(f"'{x}'" for x in NOT_STATED)
_BARE = "substr(rtrim(regexp_replace({0}, '^https?://(www\\.)?', ''), '/'), 1, 200)"
SQL = {
    "file_roles": f"SELECT {_ROLE} AS by_name, lower(trim(role)) AS on_record, count(*) AS n FROM files WHERE url IS NOT NULL GROUP BY 1, 2",
    "technology_names": f"SELECT rec_id, {_tech('technology')} AS technology, {_tech('title')} AS in_title FROM datasets",
    "tissue_names": "SELECT rec_id, coalesce(nullif(substr(lower(trim(split_part(split_part(coalesce(tissue, ''), ';', 1), ',', 1))), 1, 40), ''), 'unspecified') AS tissue, trim(regexp_replace(lower(coalesce(tissue, '')), '[^a-z0-9]+', '_', 'g'), '_') AS snake FROM datasets",
    "slug_tags": "SELECT rec_id, substr(regexp_replace(url, '[^A-Za-z0-9._\\-]+', '_', 'g'), 1, 150) AS safe, substr(regexp_replace(source || '__' || accession, '[^A-Za-z0-9._\\-]+', '_', 'g'), 1, 110) || '_' || substr(md5(source || '__' || accession), 1, 8) AS tag FROM datasets WHERE accession IS NOT NULL AND source IS NOT NULL",
    "archive_ids": "SELECT file_id, upper(coalesce(" + ", ".join(f"nullif(regexp_extract(sample_id, '{p}', 1), '')" for p in N.ARCHIVE_IDS) + ")) AS archive_id FROM files",
    "links": f"""WITH d AS (SELECT rec_id, {_URL} AS url FROM datasets WHERE accession IS NOT NULL), u AS (SELECT rec_id, url AS raw, trim(coalesce(url, '')) AS u FROM d),
      z AS (SELECT *, coalesce(nullif(regexp_extract(u, 'zenodo\\.org/(?:records?|record)/(\\d+)', 1), ''), nullif(regexp_extract(u, 'zenodo\\.(\\d+)', 1), '')) AS zen, nullif(regexp_extract(u, '(GSE\\d+)', 1), '') AS gse,
        nullif(regexp_extract(u, 'figshare\\.com/.*?/(\\d{{6,}})', 1), '') AS fig, contains(u, '10xgenomics.com/datasets/') OR contains(u, '10xgenomics.com/resources/datasets/') AS tenx, nullif(regexp_extract(u, '(E-MTAB-\\d+)', 1), '') AS mtab,
        nullif(regexp_extract(u, '(HTA\\d+|HT\\d{{3}}[A-Z0-9]+)', 1), '') AS htan, {_rules_sql('raw', N.LINK_HOSTS, chr(39) + 'other' + chr(39), literal=True)} AS host FROM u)
      SELECT rec_id, CASE WHEN gse IS NOT NULL THEN 'GEO' WHEN zen IS NOT NULL THEN 'Zenodo' WHEN fig IS NOT NULL THEN 'figshare' WHEN tenx THEN '10x Datasets' WHEN mtab IS NOT NULL THEN 'ArrayExpress' WHEN htan IS NOT NULL THEN 'HTAN' WHEN starts_with(u, 'http') THEN 'other' END AS source,
        CASE WHEN gse IS NOT NULL THEN gse WHEN zen IS NOT NULL THEN 'zenodo:' || zen WHEN fig IS NOT NULL THEN 'figshare:' || fig WHEN tenx THEN '10xgenomics.com/datasets/' || regexp_extract(rtrim(regexp_replace(u, '[?#].*', ''), '/'), '([^/]*)$', 1)
          WHEN mtab IS NOT NULL THEN mtab WHEN htan IS NOT NULL THEN htan WHEN starts_with(u, 'http') THEN {_BARE.format('u')} END AS accession, host,
        CASE WHEN host = 'GEO' AND gse IS NOT NULL THEN gse WHEN host = 'Zenodo' AND nullif(regexp_extract(raw, '(?:records?|zenodo\\.)/?(\\d+)', 1), '') IS NOT NULL THEN 'zenodo:' || regexp_extract(raw, '(?:records?|zenodo\\.)/?(\\d+)', 1) ELSE {_BARE.format('raw')} END AS by_host FROM z""",
    "byte_sizes": "SELECT file_id, CAST(CASE file_id % 3 WHEN 0 THEN size_bytes // 1000 * 1000 WHEN 1 THEN size_bytes // 1000000 * 1000000 + 500000 ELSE size_bytes END AS BIGINT) AS bytes FROM files WHERE size_bytes IS NOT NULL",
    "gene_names": "WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'NegControlProbe_' || p_partkey WHEN p_partkey % 13 = 0 THEN 'Blank-' || p_size ELSE ['GRCh38_', '', 'hg19-', ''][p_partkey % 4 + 1] || regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') || ['-v1-prime', '.13', '-prime-with-v1-seg', '-seg', '', '_v2'][p_partkey % 6 + 1] END AS name FROM part) "
    "SELECT p_partkey, name, regexp_replace(regexp_replace(upper(name), '^(GRCH38|GRCH37|HG38|HG19|HUMAN|MM10|GRCM38|GRCM39|MOUSE)[_-]', ''), '(\\.\\d+|-V\\d+(-PRIME|-ALT)?)$', '') AS symbol, "
    "CASE WHEN regexp_matches(regexp_extract(name, '(?i)((?:[-_](?:prime|with|seg|v\\d+))+)$', 1), '(?i)prime|v\\d+') THEN regexp_replace(name, '(?i)((?:[-_](?:prime|with|seg|v\\d+))+)$', '') ELSE name END AS bare, "
    + ", ".join(f"regexp_matches(name, '{p}') AS control_{d}" for d, p in N.CONTROL_PROBES.items()) + " FROM p",
    "cell_classes": f"SELECT term_id, {_rules_sql('lower(label)', N.CELL_CLASSES, 'label')} AS class FROM canon_terms",
    "age_bins": """WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 97 + CASE WHEN c_custkey % 2 = 0 THEN 0.5 ELSE 0 END END AS n, ['year', 'month', 'week', 'day', 'unknown'][c_custkey % 5 + 1] AS u, c_custkey % 3 = 0 AS pre FROM customer),
      d AS (SELECT *, CAST(round_even(CAST(CASE u WHEN 'week' THEN n WHEN 'month' THEN n * 4.345 WHEN 'day' THEN n / 7.0 END AS DOUBLE), 0) AS INT) AS w, CAST(CASE u WHEN 'year' THEN n WHEN 'month' THEN n / 12.0 WHEN 'week' THEN n / 52.18 ELSE n / 365.25 END AS DOUBLE) AS y FROM c)
      SELECT k AS c_custkey, CASE WHEN n IS NULL OR u = 'unknown' THEN 'unknown' WHEN pre AND w IS NULL THEN 'fetal' WHEN pre THEN CASE WHEN w < 9 THEN 'embryonic' ELSE 'fetal' END
        WHEN y < 2 THEN 'infant' WHEN y < 13 THEN 'child' WHEN y < 20 THEN 'adolescent' WHEN y < 40 THEN 'young_adult' WHEN y < 60 THEN 'middle_aged' ELSE 'late_adult' END AS age_group,
        CASE WHEN n IS NULL OR u = 'unknown' OR pre AND w IS NULL THEN 'unknown' WHEN pre THEN w || CASE WHEN w % 10 = 1 AND w <> 11 THEN 'st' WHEN w % 10 = 2 AND w <> 12 THEN 'nd' WHEN w % 10 = 3 AND w <> 13 THEN 'rd' ELSE 'th' END || ' week post-fertilization stage'
        WHEN u = 'month' AND n < 24 THEN CAST(floor(n) AS INT) || '-month-old stage' WHEN y >= 1 THEN CAST(floor(y) AS INT) || '-year-old stage' ELSE 'unknown' END AS stage FROM d""",
    "html_pages": r"""WITH p AS (SELECT doc_id, '<html><style>p {x}</style><script>var a = ''<b>'';</script><p>' || text || '</p>&amp;&nbsp;<a href=''https://a.example/x''>one</a> <a href="/y">two</a></html>' AS h FROM documents WHERE text IS NOT NULL),
      t AS (SELECT doc_id, h, regexp_replace(regexp_replace(h, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g') AS t FROM p),
      e AS (SELECT doc_id, h, trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\t\n\x0b\f\r ]+', ' ', 'g'), ' ') AS t FROM t)
      SELECT doc_id, CAST(length(t) AS INT) AS n, md5(t) AS hash, array_to_string(regexp_extract_all(h, 'href=["'']([^"''#]+)["'']', 1), ' ') AS links FROM e""",
    "member_samples": "SELECT file_id, list_filter(string_split(local_path, '/')[:-2], lambda x: x <> '' AND lower(x) NOT IN ('raw', 'outs', 'data'))[1] AS sample, regexp_replace(regexp_extract(local_path || '.tar.gz', '([^/]*)$', 1), '(?i)\\.(tar\\.gz|tar\\.bz2|tgz|tar|zip|7z|rar)$', '') AS stem FROM files WHERE local_path IS NOT NULL",
    "stated_flags": "SELECT field, coalesce(v, '<null>') AS spelling, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, lower(trim({c})) AS v FROM sample_meta" for c in ("tissue", "sex", "age_unit", "age_group", "disease_state", "donor_id", "preservation")) + f") WHERE v IS NULL OR v IN ({_NOT}) GROUP BY 1, 2",
}
