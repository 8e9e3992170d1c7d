"""Spatial analytics of points (sample, id, x, y): spacing, units, pieces, grids.

Neighbours are found by equality joins on grid cells, never by comparing all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import persisted

ROUND = 6


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), ROUND)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _cell(c: Column, h: Column) -> Column:
    return F.floor(c / h).cast("bigint")


def _around(n: int) -> Column:
    """Offsets (dx, dy) of the cells within n of a cell."""
    return F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in range(-n, n + 1) for j in range(-n, n + 1)]))


#: Places that a cell may hold when the search for neighbours begins.
CELL_PLACES = 32


def _sized(at: DataFrame, most: int) -> DataFrame:
    """Places with a side ``h`` of their sample's cells: the mean spacing, halved until no cell holds more than ``most``.

    So a far outlier, which makes the mean spacing large, does not put a dense cluster into one cell.
    """
    span = at.groupBy("sample").agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("w"), F.count("*").alias("m"))
    sides = persisted(span.where("m > 1 AND w > 0").select("sample", (F.col("w") / F.sqrt("m")).alias("h")), "sides")
    while True:
        cells = at.join(sides, "sample").groupBy("sample", "h", _cell(F.col("x"), F.col("h")).alias("cx"), _cell(F.col("y"), F.col("h")).alias("cy")).agg(F.count("*").alias("n"))
        full = persisted(cells.groupBy("sample", "h").agg(F.max("n").alias("n")), "fullest")
        if not full.where(F.col("n") > most).head(1):
            return persisted(at.join(sides, "sample"), "places-sized")
        sides = persisted(full.select("sample", F.when(F.col("n") > most, F.col("h") / F.greatest(F.lit(2.0), F.floor(F.sqrt(F.col("n") / most)))).otherwise(F.col("h")).alias("h")), "sides")


def nearest(points: DataFrame, cell_places: int = CELL_PLACES) -> DataFrame:
    """Rows (sample, id, nn): exact distance of each finite point to the nearest other point of its sample.

    Points lie in cells of side h; a distance of h at most, found among the 3 x 3 cells around, is exact. Points
    without one are asked again with 2h, until none is left. The first h is the mean spacing, or less where cells
    would hold too many (``_sized``), so that dense places settle while cells are small and only sparse points are
    left for large ones. Points at one place (distance 0) are made one first. A lone point has no row. Every round is
    written to the shared folder.
    """
    p = points.where(finite(F.col("x")) & finite(F.col("y"))).select("sample", "id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    at = persisted(p.groupBy("sample", "x", "y").agg(F.count("*").alias("n"), F.min("id").alias("first")), "places")
    sized = _sized(at, cell_places)
    open_, done, i = sized.where("n = 1"), None, 0
    while True:
        h = F.col("h") * (2.0**i)
        target = sized.select("sample", _cell(F.col("x"), h).alias("cx"), _cell(F.col("y"), h).alias("cy"), F.col("x").alias("tx"), F.col("y").alias("ty"))
        probe = open_.select("sample", "x", "y", "first", "h", "n", _cell(F.col("x"), h).alias("gx"), _cell(F.col("y"), h).alias("gy"), _around(1).alias("o"))
        probe = probe.withColumns({"cx": F.col("gx") + F.col("o.dx"), "cy": F.col("gy") + F.col("o.dy")}).drop("gx", "gy", "o")
        d = F.sqrt((F.col("x") - F.col("tx")) ** 2 + (F.col("y") - F.col("ty")) ** 2)
        best = probe.join(target, ["sample", "cx", "cy"]).where((F.col("x") != F.col("tx")) | (F.col("y") != F.col("ty"))).groupBy("sample", "x", "y").agg(F.min(d).alias("d"))
        step = persisted(open_.join(best, ["sample", "x", "y"], "left").withColumn("ok", F.coalesce(F.col("d") <= h, F.lit(False))), "nearest")
        found = step.where("ok").select("sample", "x", "y", "d")
        done = found if done is None else done.unionByName(found)
        open_, i = step.where("NOT ok").drop("d", "ok"), i + 1
        if not open_.head(1):
            break
    one = done.select("sample", "x", "y", F.col("d").alias("nn"))
    alone = p.join(one, ["sample", "x", "y"]).select("sample", "id", "nn")
    stacked = p.join(at.where("n > 1").select("sample", "x", "y"), ["sample", "x", "y"]).select("sample", "id", F.lit(0.0).alias("nn"))
    return alone.unionByName(stacked)


def spacing(points: DataFrame, least: int = 50) -> DataFrame:
    """Per sample: points, share of finite ones, median spacing, its coefficient of variation, share within 5 % of
    the median, span. Spacing is null with fewer than ``least`` finite points or less than half finite."""
    ok = finite(F.col("x")) & finite(F.col("y"))
    base = points.groupBy("sample").agg(
        F.count("*").alias("n"), F.count_if(ok).alias("n_finite"), (F.max(F.when(ok, F.col("x"))) - F.min(F.when(ok, F.col("x")))).alias("span_x"), (F.max(F.when(ok, F.col("y"))) - F.min(F.when(ok, F.col("y")))).alias("span_y")
    )
    d = nearest(points)
    med = d.groupBy("sample").agg(F.percentile("nn", F.lit(0.5)).alias("nn"), (F.stddev_pop("nn") / F.avg("nn")).alias("cv"))
    modal = d.withColumnRenamed("nn", "d").join(med, "sample").groupBy("sample").agg(F.avg((F.abs(F.col("d") - F.col("nn")) <= 0.05 * F.col("nn")).cast("int")).alias("modal"))
    j = base.join(med, "sample", "left").join(modal, "sample", "left")
    enough = (F.col("n_finite") >= least) & (F.col("n_finite") >= 0.5 * F.col("n"))
    return j.select("sample", "n", r6(F.col("n_finite") / F.col("n")).alias("frac_finite"), *[r6(F.when(enough, F.col(c))).alias(a) for c, a in (("nn", "nn"), ("cv", "lattice_cv"), ("modal", "frac_modal"))], r6(F.col("span_x")).alias("span_x"), r6(F.col("span_y")).alias("span_y"))


#: Pitch of lattices, bounds of sections and spacings, units, in micrometres.
LATTICE_PITCH = {"Visium": 100.0}
LATTICE_SHARE, SPAN_UM, SPACING_UM = 0.90, (200.0, 60_000.0), (2.0, 2_000.0)
UNITS = [("microns", 1.0), ("millimetres", 1_000.0), ("centimetres", 10_000.0), ("metres", 1_000_000.0)]
#: Micrometres of a pixel; bounds of spacing (um) and span (mm) for the pixel hypothesis.
PIXEL_UM = {"CosMx": 0.1202, "Xenium": 0.2125, "Visium HD": 0.2125, "MERFISH": 0.108, "Visium": 0.2125}


def unit_verdict(technology: Column, nn: Column, frac_finite: Column, span_x: Column, span_y: Column, n: Column, frac_modal: Column, bin_um: Column) -> Column:
    """Struct (unit, um_per_unit, verdict) of a sample's coordinates.

    Refusals come first (non-finite, degenerate, array indices). A lattice with a known pitch, if the points are
    measured to lie on one (an unmeasured lattice is trusted), gives the factor by division. Else the span and the
    spacing must be plausible in one unit; micrometres win over others, several others are ambiguous.
    """
    s = lambda u, f, v: F.struct((u if isinstance(u, Column) else F.lit(u).cast("string")).alias("unit"), (f if isinstance(f, Column) else F.lit(f).cast("double")).alias("um_per_unit"), F.lit(v).alias("verdict"))
    none = F.lit(None)
    fin = lambda c: F.coalesce(finite(c), F.lit(False))
    wide = F.greatest(span_x, span_y)
    index = fin(span_x) & fin(span_y) & (F.abs(nn - 1.0) < 1e-6) & (wide < 2000)
    pitch = F.when(technology.isin("Visium HD", "Stereo-seq"), F.when(fin(bin_um) & (bin_um > 0), bin_um)).otherwise(F.coalesce(*[F.when(technology == t, F.lit(p)) for t, p in LATTICE_PITCH.items()], F.lit(None).cast("double")))
    on = frac_modal.isNull() | (fin(frac_modal) & (frac_modal >= LATTICE_SHARE))
    pitch = F.when(on, pitch)
    um = pitch / nn
    fits = ~(fin(span_x) & fin(span_y) & (span_x != 0) & (span_y != 0)) | (wide * um).between(*SPAN_UM)
    lattice = F.when(um.between(0.8, 1.25), s("microns", 1.0, "ok")).when(~fits, s(None, None, "spacing_unexplained")).otherwise(s(F.concat(F.format_number(um, 4), F.lit(" um/unit")), um, "rescale"))
    cand = F.filter(F.array(*[F.struct(F.lit(u).alias("u"), F.lit(f).alias("f")) for u, f in UNITS]), lambda c: (wide * c["f"]).between(*SPAN_UM) & (nn * c["f"]).between(*SPACING_UM))
    usable = fin(span_x) & fin(span_y) & (span_x > 0) & (span_y > 0) & (n > 0)
    physics = (
        F.when(~usable, s(None, None, "no_expected_spacing")).when(F.size(cand) == 0, s(None, None, "spacing_unexplained")).when(cand[0]["u"] == "microns", s("microns", 1.0, "ok"))
        .when(F.size(cand) > 1, s(F.array_join(F.transform(cand, lambda c: c["u"]), "|"), None, "unit_ambiguous")).otherwise(s(cand[0]["u"], cand[0]["f"], "rescale"))
    )
    return F.when(frac_finite < 0.5, s(None, None, "coords_non_finite")).when(~fin(nn) | (nn <= 0), s(None, None, "coords_degenerate")).when(index, s(None, None, "array_index_not_a_unit")).when(pitch.isNotNull(), lattice).otherwise(physics)


def pixel_verdict(technology: Column, nn: Column, span_x: Column, span_y: Column) -> Column:
    """Whether coordinates are pixels of the platform's size: spacing of 2-30 um and span of 0.5-40 mm."""
    px = F.coalesce(*[F.when(technology == t, F.lit(p)) for t, p in PIXEL_UM.items()])
    a, b = (nn * px).between(2.0, 30.0), (F.greatest(span_x, span_y) * px / 1000).between(0.5, 40.0)
    ok = lambda c: F.when(c, "ok").otherwise("bad")
    return F.when(px.isNull(), "no pixel size for this platform").when(nn.isNull(), "too few points").when(a & b, "pixels").otherwise(F.concat(F.lit("rejected (nn "), ok(a), F.lit(", span "), ok(b), F.lit(")")))


# ---- radius graph ---------------------------------------------------------------------------------------------


def connected(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of an undirected edge table (a, b); a component is named after its least node.

    Alternating large-star and small-star steps, each written to the shared folder, until the edges stand still.
    """
    e = persisted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # large star: of every node, greater neighbours to the least neighbour (itself included)
        both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: of every node, the lesser neighbours and itself to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new = persisted(small, "edges")
        same = new.join(e, ["u", "v"], "left_anti").head(1) == [] and e.join(new, ["u", "v"], "left_anti").head(1) == []
        e = new
        if same:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def pieces(points: DataFrame, radius: DataFrame) -> DataFrame:
    """Rows (sample, id, piece): components of the graph that joins points within the sample's ``radius``.

    Points of one cell of side radius / sqrt(2) are always joined, so only cells are graph nodes: two cells are
    joined when any two of their points are near enough. Cells hold what the density gives; components run on cells.
    """
    p = points.where(finite(F.col("x")) & finite(F.col("y"))).join(radius, "sample").where("radius > 0")
    side = F.col("radius") / F.sqrt(F.lit(2.0))
    p = persisted(p.select("sample", "id", "x", "y", "radius", _cell(F.col("x"), side).alias("cx"), _cell(F.col("y"), side).alias("cy")), "cells")
    # one row a place: points at one place count once
    q = p.select("sample", "cx", "cy", "x", "y", "radius").distinct()
    probe = q.withColumn("o", _around(2)).where("o.dx > 0 OR (o.dx = 0 AND o.dy > 0)").select("sample", F.col("cx").alias("ax"), F.col("cy").alias("ay"), (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    name = lambda x, y: F.concat_ws("\u0001", F.col("sample").cast("string"), F.format_string("%020d", F.col(x)), F.format_string("%020d", F.col(y)))
    near = probe.join(q, ["sample", "cx", "cy"]).where(F.sqrt((F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2) <= F.col("radius"))
    comp = connected(near.select(name("ax", "ay").alias("a"), name("cx", "cy").alias("b")).distinct())
    labelled = p.withColumn("node", name("cx", "cy")).join(comp, "node", "left").withColumn("c", F.coalesce("component", "node"))
    first = labelled.groupBy("c").agg(F.min("id").alias("piece"))
    return labelled.join(first, "c").select("sample", "id", "piece")


def piece_report(members: DataFrame, least: int = 50, share: float = 0.05, debris: int = 3) -> DataFrame:
    """Per sample: pieces (of ``least`` points and ``share`` of all), fragments of ``debris`` points or more, points."""
    size = members.groupBy("sample", "piece").agg(F.count("*").alias("n"))
    all_ = members.groupBy("sample").agg(F.count("*").alias("n_points"))
    j = size.join(all_, "sample")
    floor = F.greatest(F.lit(float(least)), F.col("n_points") * share)
    return j.groupBy("sample").agg(F.count_if(F.col("n") >= floor).alias("pieces"), F.count_if((F.col("n") < floor) & (F.col("n") >= debris)).alias("fragments"), F.max("n_points").alias("n_points"))


# ---- grids ----------------------------------------------------------------------------------------------------

#: Rows of bin grids with bin size (um) and capture side (mm), in order; spot grids that are no bin grids.
GRIDS = [(3350, 2.0, 6.5), (1675, 4.0, 6.5), (838, 8.0, 6.5), (419, 16.0, 6.5), (5500, 2.0, 11.0), (2750, 4.0, 11.0), (1375, 8.0, 11.0), (688, 16.0, 11.0)]
SPOT_GRIDS = [78, 128, 120, 64]


def grid(rows: Column, sample_id: Column) -> Column:
    """Struct (bin_um, capture_mm, verdict) of a grid's number of rows, within 4 % of a known one; a bin size in the
    sample id ('square_008um') stands in where none fits."""
    near = lambda k: F.abs(rows - k) / k < 0.04
    um = F.coalesce(*[F.when(near(k), F.lit(u)) for k, u, _ in GRIDS], F.lit(None).cast("double"))
    big = F.coalesce(F.when(near(5500) | near(2750) | near(1375) | near(688), 11.0), F.lit(6.5))
    said = F.nullif(F.regexp_extract(sample_id, r"square_(\d{3})um", 1), F.lit("")).try_cast("double")
    bin_um = F.coalesce(um, said)
    verdict = F.when(rows.isin(*SPOT_GRIDS), "not_visium_hd").when(bin_um.isNotNull(), "hd_grid").when(rows.isNull(), "no_positions_table").otherwise("unrecognised_grid")
    return F.struct(bin_um.alias("bin_um"), F.when(um.isNotNull(), big).alias("capture_mm"), verdict.alias("verdict"))


def coordinate_scale(rows: Column, bin_um: Column, x_range: Column, y_range: Column) -> Column:
    """Struct (um_per_unit, coord_units) from a known grid over the coordinates' extent."""
    um = rows * bin_um / F.nullif(F.greatest(x_range, y_range), F.lit(0.0))
    return F.struct(r6(um).alias("um_per_unit"), F.when(um.between(0.8, 1.25), "microns").when(um.isNotNull(), "pixels").otherwise("unknown").alias("coord_units"))


def resolved_technology(labelled: Column, verdict: Column, unique_share: Column, coord_source: Column, n_genes: Column) -> Column:
    """Technology by the evidence of the file: bin grid, spot grid, one position per unit; else unknown."""
    cell = (
        F.when((labelled == "Visium HD") & verdict.isin("unrecognised_grid", "no_positions_table"), "Visium HD").when(coord_source == "xenium", "Xenium").when(n_genes > 10000, "cell-level WTA").otherwise("cell-level (unknown platform)")
    )
    return F.when(verdict == "hd_grid", "Visium HD").when(verdict == "not_visium_hd", "Visium").when(unique_share > 0.95, cell).otherwise("unknown")


#: Fixed value: the greatest whole multiple of the least step that can be a grid's pitch.
MOST_STEPS = 20


def modal_pitch(points: DataFrame, most: int = MOST_STEPS) -> DataFrame:
    """Per sample and axis: pitch of a regular grid (the median of the steps between different coordinates that are
    the commonest whole multiple of the least; ties take the smaller) and how many rows it makes."""
    long = points.select("sample", F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col("x").alias("v")), F.struct(F.lit("y").alias("axis"), F.col("y").alias("v")))).alias("a")).select("sample", "a.*")
    u = long.where(finite(F.col("v"))).distinct()
    d = u.withColumn("d", F.col("v") - F.lag("v").over(Window.partitionBy("sample", "axis").orderBy("v")))
    low = d.groupBy("sample", "axis").agg(F.min("d").alias("least"), (F.max("v") - F.min("v")).alias("extent"))
    q = d.where("d IS NOT NULL").join(low, ["sample", "axis"]).withColumn("q", F.rint(F.col("d") / F.col("least")).cast("int"))
    mode = q.where(F.col("q") <= most).groupBy("sample", "axis", "q").agg(F.count("*").alias("n")).groupBy("sample", "axis").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("q"))).alias("m")).select("sample", "axis", F.col("m.q").alias("q"))
    return q.join(mode, ["sample", "axis", "q"]).groupBy("sample", "axis").agg(F.percentile("d", F.lit(0.5)).alias("pitch"), F.first("extent").alias("extent")).select("sample", "axis", r6(F.col("pitch")).alias("pitch"), (F.bround(F.col("extent") / F.col("pitch")).cast("int") + 1).alias("rows"))


def extent(points: DataFrame, um_per_unit: Column) -> DataFrame:
    """Per sample: extent in units and um, area in mm2 and points per mm2."""
    g = points.where(finite(F.col("x")) & finite(F.col("y"))).groupBy("sample").agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"), F.count("*").alias("n"))
    area = F.col("w") * um_per_unit * F.col("h") * um_per_unit / 1e6
    return g.select("sample", "n", r6(F.col("w")).alias("width"), r6(F.col("h")).alias("height"), r6(area).alias("area_mm2"), r6(F.col("n") / F.nullif(area, F.lit(0.0))).alias("per_mm2"))


def thinned_spacing(nn: Column, kept: Column, all_: Column) -> Column:
    """Spacing of all points from that of an even sample of them, which thins the plane by the root of the ratio."""
    return nn * F.sqrt(kept / all_)
