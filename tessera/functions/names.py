"""Ordered text rules: file roles, technologies, tissues, links, genes, ages. Pure columns, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: Column, literal: bool = False) -> Column:
    """The value of the first rule (pattern, value) that the text matches; rules are regular expressions or, if
    ``literal``, plain substrings. Null text takes ``otherwise``."""
    out: Column | None = None
    for pattern, value in rules:
        hit = text.contains(pattern) if literal else text.rlike(pattern)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


#: Roles of files by name, in order.
FILE_ROLES = [
    (r"differential_expression|^analysis|/analysis/|cluster|umap|pca|projection", "other"),
    (r"cell_boundar|nucleus_boundar|segmentation|masks?\.", "segmentation"),
    (r"\.(tiff?|png|jpe?g|svs|ndpi|btf|czi|qptiff|ome\.tif)(\.gz)?$|morphology|_he_image|hires_image|lowres_image", "image"),
    (r"transcripts?\.(csv|parquet|zarr)|detected_transcripts|tx_file|_tx\.csv|molecules|spots\.csv", "transcripts"),
    (r"\.h5ad(\.gz)?$|\.gef$|\.cellbin\.gef$|_seurat.*\.rds$|\.rds$|\.h5seurat$|\.zarr\.zip$|\.loom$", "matrix+coords"),
    (
        r"_coords\.|spot_coord|tissue_positions|scalefactors_json|(^|[_\-.])cells\.(csv|parquet)|cell_metadata|metadata_file|"
        r"beadlocations|bead_locations|coordinates|positions|centroids|spatial\.tar\.gz|spatial\.zip|"
        r"_spatial\.csv|xy\.csv|locations?\.csv",
        "coords",
    ),
    (
        r"stdata|_st_data|filtered_feature_bc_matrix|cell_feature_matrix|feature_bc_matrix|matrix\.mtx|barcodes\.tsv|"
        r"features\.tsv|genes\.tsv|exprmat|cell_by_gene|counts?[._\-]|_count\.|expression|\.mtx(\.gz)?$|"
        r"\.h5$|dge\.|_umi",
        "matrix",
    ),
    (r"\.(tar|tar\.gz|tgz|zip|7z|rar)$", "bundle"),
]

#: Technologies by substring, in order.
TECHNOLOGIES = [
    ("atera", "Atera"), ("visium hd", "Visium HD"), ("visium", "Visium"), ("xenium", "Xenium"), ("cosmx", "CosMx"),
    ("merscope", "MERFISH"), ("merfish", "MERFISH"), ("stereo", "Stereo-seq"), ("slide", "Slide-seq"),
    ("curio", "Slide-seq"), ("geomx", "GeoMx"), ("dbit", "DBiT-seq"), ("starmap", "STARmap"),
    ("seqfish", "seqFISH"), ("cartana", "ISS/Cartana"), ("in situ seq", "ISS/Cartana"), ("hdst", "HDST"),
    ("spatial transcriptomics", "ST (legacy)"), ("legacy st", "ST (legacy)"),
]

#: Archives by a part of the link, in order.
LINK_HOSTS = [
    ("10xgenomics", "10x Datasets"), ("vizgen", "Vizgen"), ("nanostring", "NanoString"), ("cellxgene", "CELLxGENE"),
    ("zenodo", "Zenodo"), ("ncbi.nlm.nih.gov", "GEO"), ("drive.google", "Google Drive"),
    ("broadinstitute", "Broad SCP"), ("datadryad", "Dryad"), ("brainimagelibrary", "Brain Image Library"),
]

#: Archive accessions inside sample ids, in order.
ARCHIVE_IDS = [r"(?i)(GSM\d{5,})", r"(?i)(E-MTAB-\d+)", r"(?i)(E-GEOD-\d+)", r"(?i)(SRS\d{6,})"]

#: Three dialects of control probes.
CONTROL_PROBES = {
    "panel": r"(?i)NEGCONTROL|UNASSIGNED|CODEWORD|BLANK|ANTISENSE|DEPRECATED|GENOMICCONTROL|INTERGENIC",
    "model": r"(?i)^(neg_?control|unassigned|blank[-_]?\d|deprecated_ensg|intergenic|antisense_)",
    "crosscheck": r"^(NEGCONTROL|UNASSIGNEDCODEWORD|BLANKCODEWORD|NEGPROBE|ANTISENSE|DEPRECATEDCODEWORD|SYSTEMCONTROL|FALSECODE|UNNAMED)",
}

#: Major classes of cell types, in order.
CELL_CLASSES = [
    (r"\bplasma\b|plasmablast", "plasma cell"),
    (r"\b(t cell|thymocyte|t-cell)\b|cd4-positive|cd8-positive|regulatory t|gamma-delta|mucosal invariant|nkt|t-helper|t follicular|lymphocyte", "T cell"),
    (r"natural killer|\bnk cell\b|innate lymphoid", "NK/ILC"),
    (r"\bb cell\b|b-1a|b-1b|pre-b|pro-b|germinal center", "B cell"),
    (r"macrophage|kupffer|histiocyte|mononuclear phagocyte|myeloid", "macrophage"),
    (r"monocyte", "monocyte"),
    (r"dendritic", "dendritic cell"),
    (r"microglia", "microglia"),
    (r"mast cell|basophil", "mast cell"),
    (r"neutrophil|granulocyte", "neutrophil"),
    (r"erythro|megakaryo|platelet|hematopoietic|myeloid progenitor|stem cell", "progenitor"),
    (r"endothelial|vein|capillary|lymphatic", "endothelial cell"),
    (r"pericyte", "pericyte"),
    (r"smooth muscle|myofibroblast|contractile", "smooth muscle"),
    (r"fibroblast|stromal cell|mesenchymal|adventitial", "fibroblast"),
    (r"skeletal muscle|myocyte|cardiac muscle|cardiomyocyte", "muscle cell"),
    (r"adipocyte", "adipocyte"),
    (r"neuron|neural|glutamatergic|gabaergic", "neuron"),
    (r"astrocyte", "astrocyte"),
    (r"oligodendrocyte|opc", "oligodendrocyte"),
    (r"schwann", "Schwann cell"),
    (r"melanocyte", "melanocyte"),
    (r"keratinocyte", "keratinocyte"),
    (r"chondrocyte|osteo", "skeletal cell"),
    (
        r"glandular|secretory|goblet|club cell|ciliated|basal cell|epithelial|enterocyte|"
        r"hepatocyte|podocyte|pneumocyte|type i |type ii |secreting|ionocyte|hillock|"
        r"deuterosomal|acinar|neuroendocrine|tuft cell|serous|mucus|luminal|myoepithelial",
        "epithelial cell",
    ),
]


def file_role(name: Column) -> Column:
    """Role of a file by its base name."""
    n = F.element_at(F.split(F.lower(name), "/"), -1)
    return F.when(n.startswith("._"), "other").when(n.contains("raw_feature_bc_matrix"), "matrix_raw").otherwise(first_match(n, FILE_ROLES, F.lit("other")))


def technology(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return first_match(t, TECHNOLOGIES, F.when(t == "", "Unknown").otherwise("Other"), literal=True)


def tissue(text: Column) -> Column:
    """First part of a tissue list, lower case, 40 characters, 'unspecified' if there is none."""
    t = F.split(F.split(F.coalesce(text, F.lit("")), ";")[0], ",")[0]
    return F.coalesce(F.nullif(F.substring(F.lower(F.trim(t)), 1, 40), F.lit("")), F.lit("unspecified"))


def snake(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "_"), F.lit("_"))


def safe_name(text: Column) -> Column:
    """A file name of harmless characters, 150 at most."""
    return F.substring(F.regexp_replace(text, r"[^A-Za-z0-9._\-]+", "_"), 1, 150)


def slug_tag(*parts: Column) -> Column:
    """An output name that truncation cannot make ambiguous: 110 characters of the slug and 8 of the identity's MD5."""
    whole = F.concat_ws("__", *parts)
    return F.concat(F.substring(F.regexp_replace(whole, r"[^A-Za-z0-9._\-]+", "_"), 1, 110), F.lit("_"), F.substring(F.md5(whole), 1, 8))


def archive_id(sample_id: Column) -> Column:
    return F.upper(F.coalesce(*[extract(sample_id, p) for p in ARCHIVE_IDS]))


def _bare(url: Column) -> Column:
    return F.substring(F.rtrim(F.regexp_replace(url, r"^https?://(www\.)?", ""), F.lit("/")), 1, 200)


def link(url: Column) -> Column:
    """Struct (source, accession) of a link; nulls for what is no link."""
    u = F.trim(F.coalesce(url, F.lit("")))
    zenodo = F.coalesce(extract(u, r"zenodo\.org/(?:records?|record)/(\d+)"), extract(u, r"zenodo\.(\d+)"))
    tenx = u.contains("10xgenomics.com/datasets/") | u.contains("10xgenomics.com/resources/datasets/")
    slug = F.element_at(F.split(F.rtrim(F.regexp_replace(u, "[?#].*", ""), F.lit("/")), "/"), -1)
    htan = extract(u, r"(HTA\d+|HT\d{3}[A-Z0-9]+)")
    none = F.lit(None).cast("string")
    s = lambda a, b: F.struct(a.alias("source"), b.alias("accession"))
    return (
        F.when(u.rlike(r"GSE\d+"), s(F.lit("GEO"), extract(u, r"(GSE\d+)")))
        .when(zenodo.isNotNull(), s(F.lit("Zenodo"), F.concat(F.lit("zenodo:"), zenodo)))
        .when(u.rlike(r"figshare\.com/.*?/(\d{6,})"), s(F.lit("figshare"), F.concat(F.lit("figshare:"), extract(u, r"figshare\.com/.*?/(\d{6,})"))))
        .when(tenx, s(F.lit("10x Datasets"), F.concat(F.lit("10xgenomics.com/datasets/"), slug)))
        .when(u.rlike(r"E-MTAB-\d+"), s(F.lit("ArrayExpress"), extract(u, r"(E-MTAB-\d+)")))
        .when(htan.isNotNull(), s(F.lit("HTAN"), htan))
        .when(u.startswith("http"), s(F.lit("other"), _bare(u)))
        .otherwise(s(none, none))
    )


def link_host(url: Column) -> Column:
    return first_match(url, LINK_HOSTS, F.lit("other"), literal=True)


def link_accession(url: Column) -> Column:
    """Accession by the host's own rule."""
    host = link_host(url)
    geo, zen = extract(url, r"(GSE\d+)"), extract(url, r"(?:records?|zenodo\.)/?(\d+)")
    return F.when((host == "GEO") & geo.isNotNull(), geo).when((host == "Zenodo") & zen.isNotNull(), F.concat(F.lit("zenodo:"), zen)).otherwise(_bare(url))


def size_to_bytes(text: Column) -> Column:
    """'4.5G' as a number of bytes (decimal multiples), null for what is no size."""
    pattern = r"^\s*(\d+(?:\.\d+)?|\.\d+)\s*([KMGTkmgt]?)"
    unit = F.upper(F.regexp_extract(text, pattern, 2))
    times = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "G", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    return F.floor(extract(text, pattern).try_cast("double") * times + 1e-6).cast("bigint")


def gene_symbol(name: Column) -> Column:
    """Gene in upper case without an assembly prefix and a version or probe suffix."""
    up = F.regexp_replace(F.upper(name), r"^(GRCH38|GRCH37|HG38|HG19|HUMAN|MM10|GRCM38|GRCM39|MOUSE)[_-]", "")
    return F.regexp_replace(up, r"(\.\d+|-V\d+(-PRIME|-ALT)?)$", "")


def without_probe_version(name: Column) -> Column:
    """Gene without a closing run of probe tokens, if the run names a version; never stripped to nothing."""
    pattern = r"(?i)((?:[-_](?:prime|with|seg|v\d+))+)$"
    base = F.regexp_replace(name, pattern, "")
    return F.when(F.regexp_extract(name, pattern, 1).rlike(r"(?i)prime|v\d+") & (base != ""), base).otherwise(name)


def is_control(name: Column, dialect: str = "panel") -> Column:
    return name.rlike(CONTROL_PROBES[dialect])


def cell_class(label: Column) -> Column:
    """Major class of a cell type; unmatched labels are kept."""
    return first_match(F.lower(label), CELL_CLASSES, label)


def week_label(w: Column) -> Column:
    end = F.when((w % 10 == 1) & (w != 11), "st").when((w % 10 == 2) & (w != 12), "nd").when((w % 10 == 3) & (w != 13), "rd").otherwise("th")
    return F.concat(w.cast("string"), end, F.lit(" week post-fertilization stage"))


def age_fields(num: Column, unit: Column, prenatal: Column) -> Column:
    """Struct (age_group, stage) of an age; 'unknown' where number or unit is missing."""
    num = num.cast("double")
    weeks = F.when(unit == "week", num).when(unit == "month", num * 4.345).when(unit == "day", num / 7)
    w = F.bround(weeks).cast("int")
    years = F.when(unit == "year", num).when(unit == "month", num / 12).when(unit == "week", num / 52.18).otherwise(num / 365.25)
    group = F.when(years < 2, "infant").when(years < 13, "child").when(years < 20, "adolescent").when(years < 40, "young_adult").when(years < 60, "middle_aged").otherwise("late_adult")
    stage = (
        F.when((unit == "month") & (num < 24), F.concat(num.cast("int").cast("string"), F.lit("-month-old stage")))
        .when(years >= 1, F.concat(years.cast("int").cast("string"), F.lit("-year-old stage"))).otherwise("unknown")
    )
    s = lambda a, b: F.struct(a.alias("age_group"), b.alias("stage"))
    u = F.lit("unknown")
    return (
        F.when(num.isNull() | unit.isNull() | (unit == "unknown"), s(u, u))
        .when(prenatal & weeks.isNull(), s(F.lit("fetal"), u))
        .when(prenatal, s(F.when(w < 9, "embryonic").otherwise("fetal"), week_label(w)))
        .otherwise(s(group, stage))
    )


def decade_midpoint(text: Column) -> Column:
    """'fourth decade' -> 35."""
    words = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]
    return F.coalesce(*[F.when(F.lower(text).contains(f"{w} decade"), 10 * i + 5) for i, w in enumerate(words)])


def html_text(page: Column) -> Column:
    """Visible text of a page: scripts, styles and tags removed, common entities decoded, spaces collapsed."""
    t = F.regexp_replace(page, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    for entity, x in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(x))
    return F.trim(F.regexp_replace(t, r"[\t\n\x0b\f\r ]+", " "))


def html_links(page: Column, most: int = 400) -> Column:
    return F.slice(F.regexp_extract_all(page, F.lit(r"""href=["']([^"'#]+)["']"""), F.lit(1)), 1, most)


def archive_stem(name: Column) -> Column:
    """Archive name without its closing extensions."""
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?i)\.(tar\.gz|tar\.bz2|tgz|tar|zip|7z|rar)$", "")


def member_sample(path: Column, generic: list[str]) -> Column:
    """First folder of an archive member that is not a generic one, null if there is none."""
    folders = F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    return F.try_element_at(F.filter(folders, lambda x: (x != "") & ~F.lower(x).isin(*generic)), F.lit(1))


def magic(head: Column) -> Column:
    """Kind of an archive by its first bytes."""
    h = F.hex(head)
    tar = F.substring(h, 515, 10) == "7573746172"
    return F.when(h.startswith("504B"), "zip").when(h.startswith("1F8B"), "gzip").when(h.startswith("425A68"), "bz2").when(h.startswith("FD377A585A"), "xz").when(tar, "tar").otherwise("unknown")


def archive_dir(accession: Column) -> Column:
    """Folder of a series or sample in its archive: the accession with its last three digits as 'nnn', then itself."""
    head = F.when(F.length(accession) > 6, F.substring(accession, F.lit(1), F.length(accession) - 3)).otherwise(F.substring(accession, 1, 3))
    return F.concat(F.when(accession.startswith("GSE"), "series/").otherwise("samples/"), head, F.lit("nnn/"), accession, F.lit("/suppl/"))
