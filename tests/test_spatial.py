"""Spatial jobs against brute force and against properties of their results."""

from math import pi, sin

import pytest
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.geo import ENVELOPE
from landcarbon.operators import footprint, overlap, overlay
from landcarbon.operators.dissolve import connected_components, dissolve, multi
from landcarbon.operators.grid import Grid, cell_extents, crowded_cells, spatial_exists, spatial_left_join, spatial_pairs, suggest_cell_size, tiles
from landcarbon.operators.points import points_in_polygons

GRID = Grid(40.0)
# Thresholds so low that nearly every cell is divided.
DIVIDED = Grid(80.0, crowded_pairs=4, part_features=1)
FY = "financial_year_end"


def shapes(spark, n=90, seed=7):
    """Triangles and circles over a small field, some of them copies."""
    geo.register(spark)
    df = spark.range(n).select("id", *(F.rand(seed + i).alias(c) for i, c in enumerate("abcd")))
    x, y, r = F.col("a") * 300, F.col("b") * 300, 3 + F.col("c") * 25
    triangle = F.format_string(
        "POLYGON ((%.3f %.3f, %.3f %.3f, %.3f %.3f, %.3f %.3f))", x, y, x + r, y + r / 3, x + r / 4, y + r, x, y
    )
    shape = F.when(F.col("d") < 0.5, geo.from_text(triangle)).otherwise(geo.buffer(geo.point(x, y), r))
    df = df.select("id", (F.col("id") % 3).cast("int").alias(FY), shape.alias("geom"))
    copies = df.filter("id < 5").withColumn("id", F.col("id") + 1000)
    return geo.with_envelope(df.unionAll(copies))


@pytest.fixture(scope="module")
def field(spark):
    df = shapes(spark).cache()
    df.count()
    return df


def brute(field, test):
    a = field.select(F.col("id").alias("i"), F.col("geom").alias("g"))
    b = field.select(F.col("id").alias("j"), F.col("geom").alias("h"))
    return {(r.i, r.j) for r in a.crossJoin(b).filter(test(F.col("g"), F.col("h"))).select("i", "j").collect()}


@pytest.mark.parametrize("grid", [GRID, DIVIDED, Grid(7.0), Grid(1000.0)])
@pytest.mark.parametrize("name", ["intersects", "overlaps", "covered_by", "equals", "within"])
def test_pairs_equal_brute_force(field, grid, name):
    found = [(r.l_id, r.r_id) for r in spatial_pairs(field, field, name, grid).select("l_id", "r_id").collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(field, getattr(geo, name))


def test_crowded_cells_are_found(field):
    cells = cell_extents(field, 80.0)
    assert crowded_cells(cells, cells, Grid(80.0)) is None
    hot = crowded_cells(cells, cells, DIVIDED).collect()
    assert len(hot) > 5 and all(r._k > 1 for r in hot)


def test_exists_and_left_join(spark, field):
    geo.register(spark)
    far = spark.sql("select 5000 id, 1 financial_year_end, lc_box(9000D, 9000D, 9001D, 9001D) geom")
    left = field.unionByName(geo.with_envelope(far))
    near = field.filter("id < 30")
    pairs = {(i, j) for i, j in brute(field, geo.intersects) if j < 30}
    hit = {r.id for r in spatial_exists(left, near, "intersects", GRID).collect()}
    assert hit == {i for i, _ in pairs}
    missed = {r.id for r in spatial_exists(left, near, "intersects", GRID, negate=True).collect()}
    assert missed == {r.id for r in left.collect()} - hit
    joined = spatial_left_join(left, near, "intersects", GRID, "id").select("id", "r_id").collect()
    assert {(r.id, r.r_id) for r in joined} == pairs | {(i, None) for i in missed}


def test_touching_boxes(spark):
    geo.register(spark)
    a, b = (geo.box(x, 0, x + 10, 10) for x in (0, 10))
    row = spark.range(1).select(
        geo.intersects(a, b).alias("i"), geo.overlaps(a, b).alias("o"), geo.area(geo.intersection(a, b)).alias("s"),
        geo.disjoint(a, b).alias("d"),
    ).first()
    assert tuple(row) == (True, False, 0.0, False)


def test_cell_size(field):
    assert 20 < suggest_cell_size(field) < 300


@pytest.mark.parametrize("grid", [GRID, DIVIDED, Grid(1000.0)])
def test_dissolve_is_the_union(field, grid):
    parts = dissolve(field, [FY], grid)
    got = {r[FY]: (r.n, r.area) for r in parts.groupBy(FY).agg(
        F.count(F.lit(1)).alias("n"), F.sum(geo.area("geom")).alias("area")).collect()}
    whole = field.groupBy(FY).agg(geo.union("geom").alias("geom"))
    for r in whole.select(FY, F.size(geo.parts("geom")).alias("n"), geo.area("geom").alias("area")).collect():
        assert got[r[FY]][0] == r.n
        assert got[r[FY]][1] == pytest.approx(r.area, rel=1e-9)


@pytest.mark.parametrize("few", [0, 3])
def test_keys_of_few_and_of_many_features(field, monkeypatch, few):
    df = field.withColumn("key", F.when(F.col("id") % 7 > 0, F.when(F.col("id") < 3, F.lit(9)).otherwise(F.col("id") % 3)))
    totals = [F.count(F.lit(1)).alias("n"), F.round(F.sum(geo.area("geom")), 6).alias("area")]
    # Keys of few features need no spatial join.
    with monkeypatch.context() as none:
        none.setattr("landcarbon.operators.dissolve.spatial_pairs", None)
        at_once = {r.key: (r.n, r.area) for r in dissolve(df, ["key"], GRID).groupBy("key").agg(*totals).collect()}
    counts = [r["count"] for r in df.groupBy("key").count().collect()]
    assert min(counts) <= 3 < max(counts) and None in at_once
    monkeypatch.setattr("landcarbon.operators.dissolve.FEW", few)
    assert {r.key: (r.n, r.area) for r in dissolve(df, ["key"], GRID).groupBy("key").agg(*totals).collect()} == at_once


def test_dissolve_keeps_a_null_key_together(field):
    df = field.withColumn(FY, F.when(F.col(FY) != 1, F.col(FY)))
    area = dissolve(df, [FY], GRID).filter(f"{FY} is null").agg(F.sum(geo.area("geom"))).first()[0]
    whole = df.filter(f"{FY} is null").agg(geo.union("geom").alias("g")).select(geo.area("g")).first()[0]
    assert area == pytest.approx(whole)


def test_components_of_chain_star_and_pair(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("s000", f"s{i:03}") for i in range(1, 40)]
    edges = spark.createDataFrame(chain + star + [("z2", "z1")], "a string, b string")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert {v for k, v in found.items() if k[0] == "c"} == {"c000"} and len(found) == 61 + 40 + 2
    assert {v for k, v in found.items() if k[0] == "s"} == {"s000"}
    assert (found["z1"], found["z2"]) == ("z1", "z1")


@pytest.mark.parametrize("grid", [GRID, DIVIDED])
def test_drop_covered(field, grid):
    covered = {i for i, j in brute(field, geo.covered_by) if i != j}
    assert {0, 1000} <= covered
    left = {r.id for r in overlap.drop_covered(field, grid).collect()}
    assert left == {r.id for r in field.collect()} - covered


@pytest.mark.parametrize("grid", [GRID, DIVIDED])
def test_flag_overlap(field, grid):
    df = field.withColumn(FY, F.when(F.col("id") != 20, F.col(FY)))
    years = {r.id: r[FY] for r in df.collect()}
    pairs = brute(field, geo.overlaps)
    for r in overlap.flag_overlap(df, grid).collect():
        others = [j for i, j in pairs if i == r.id]
        same = any(years[j] == years[r.id] is not None for j in others)
        assert r.overlap == (1 if same else None if others else 0)
    flags = {r.id: r.overlap for r in overlap.flag_overlap(df, grid, group=None).collect()}
    assert flags == {i: int(any(a == i for a, _ in pairs)) for i in years}


def test_drop_equal_compares_shapes_not_vertices(spark, field):
    geo.register(spark)
    square = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
    more_vertices = "POLYGON ((10 10, 0 10, 0 5, 0 0, 10 0, 10 10))"
    df = spark.createDataFrame([("a", square), ("b", more_vertices), ("c", square)], "grant_id string, wkt string")
    kept = overlap.drop_equal(df.select("grant_id", geo.from_text("wkt").alias("geom")), ["grant_id"])
    assert kept.count() == 1
    assert overlap.drop_equal(field, ["id"]).count() == field.count() - 5


@pytest.mark.parametrize("grid", [GRID, DIVIDED, Grid(1000.0)])
def test_priority_subtract(field, grid):
    df = field.select(F.col("id").cast("string").alias("grant_id"), FY, "geom")
    cut = overlap.subtract_higher_priority(df, grid).cache()
    assert cut.count() == df.count()
    # No ground is shared between years any more, and none is lost.
    by_year = cut.groupBy(FY).agg(geo.union("geom").alias("geom")).select(geo.area("geom").alias("a"))
    whole = df.agg(geo.union("geom").alias("geom")).select(geo.area("geom")).first()[0]
    assert by_year.agg(F.sum("a")).first()[0] == pytest.approx(whole)


def test_small_cases_of_priority(spark):
    geo.register(spark)
    rows = [("A", 2022, 0.0, 10.0), ("B", 2024, 5.0, 15.0), ("N", None, 0.0, 10.0), ("C", 2021, 6.0, 9.0)]
    df = spark.createDataFrame(rows, f"grant_id string, {FY} int, x0 double, x1 double")
    df = df.select("grant_id", FY, geo.box(F.col("x0"), F.lit(0), F.col("x1"), F.lit(10)).alias("geom"))
    areas = {r.grant_id: r.a for r in overlap.subtract_higher_priority(df, GRID).select(
        "grant_id", geo.area("geom").alias("a")).collect()}
    assert areas == {"A": 50, "B": 100, "N": 100, "C": 0}


def test_what_is_left_of_a_polygon_has_no_vertices_where_cells_were_cut(spark):
    geo.register(spark)
    # Cells of 120 m, a notched square over three of them; a later one takes its right half.
    rows = [("A", 2022, "POLYGON((100 100, 400 100, 400 400, 200 400, 200 380, 100 380, 100 100))"), ("B", 2024, "POLYGON((250 0, 500 0, 500 500, 250 500, 250 0))")]
    df = spark.createDataFrame(rows, f"grant_id string, {FY} int, wkt string").select("grant_id", FY, geo.from_text("wkt").alias("geom"))
    left = overlap.subtract_higher_priority(df, Grid(120.0)).filter("grant_id = 'A'")
    row = left.select(geo.as_text(geo.normalize("geom")).alias("wkt"), geo.geometry_type("geom").alias("type")).first()
    assert row.type == "Polygon"
    assert row.wkt == "POLYGON ((100 100, 100 380, 200 380, 200 400, 250 400, 250 100, 100 100))"


def test_resolved_overlaps(field):
    df = field.select(F.concat(F.lit("G"), "id").alias("grant_id"), FY, "geom")
    df = overlap.drop_covered(df, GRID)
    work = overlap.resolve_overlaps(df, GRID).cache()
    # Polygons may still lie inside each other, since containment is no overlap, but none overlap.
    keyed = geo.with_envelope(work.withColumn("k", F.monotonically_increasing_id())).cache()
    met = spatial_pairs(keyed, keyed, "intersects", GRID, condition=F.col("l_k") < F.col("r_k"))
    shared = met.select(geo.area(geo.intersection("l_geom", "r_geom")).alias("s"), geo.area("l_geom").alias("l"),
                        geo.area("r_geom").alias("r"))
    for r in shared.filter("s > 1e-3").collect():
        assert r.s == pytest.approx(min(r.l, r.r), rel=1e-6)
    ids = {g for r in work.select("grant_id").collect() for g in r.grant_id.split(",")}
    assert ids <= {r.grant_id for r in df.collect()}


@pytest.mark.parametrize("grid", [GRID, DIVIDED, Grid(500.0)])
def test_points_strictly_inside(spark, field, grid):
    geo.register(spark)
    points = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "Modified").alias("condition"),
        geo.point(F.col("id") % 30 * 10, F.floor(F.col("id") / 30) * 10).alias("geom"),
    )
    points = points.unionAll(points)
    polygons = field.select("id", "geom")
    got = {(r.id, r.condition): r.n for r in points_in_polygons(polygons, points, grid, "id")
           .groupBy("id", "condition").agg(F.sum("n").alias("n")).collect()}
    want = polygons.crossJoin(points.select("condition", F.col("geom").alias("p"))).filter(geo.within("p", "geom"))
    want = {(r.id, r.condition): r.n for r in want.groupBy("id", "condition").agg(F.count("*").alias("n")).collect()}
    assert got == want


@pytest.mark.parametrize("grid", [Grid(64.0), Grid(16.0), Grid(1000.0, crowded_pairs=1000, part_features=4), Grid(1000.0, crowded_pairs=1, part_features=1)])
def test_many_points_under_overlapping_polygons(spark, grid):
    """Boxes and triangles over one dense place, also with negative coordinates and points on every border, and copies of points."""
    geo.register(spark)
    points = spark.range(12000).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("condition"),
        geo.point(F.col("id") % 100 * 4 - 200, F.floor(F.col("id") % 8100 / 100) * 4 - 160).alias("geom"),
    )
    x, y, w = (F.col("id") * 37 % 300 - 220).cast("double"), (F.col("id") * 53 % 240 - 180).cast("double"), (F.col("id") % 7 * 40 + 4).cast("double")
    triangle = geo.from_text(F.format_string("POLYGON ((%s %s, %s %s, %s %s, %s %s))", x, y, x + w, y, x, y + w, x, y))
    polygons = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, geo.box(x, y, x + w, y + w)).otherwise(triangle).alias("geom"))
    got = points_in_polygons(polygons, points, grid, "id").groupBy("id", "condition").agg(F.sum("n").alias("n"))
    want = polygons.join(points.select("condition", F.col("geom").alias("p")), geo.within("p", "geom")).groupBy("id", "condition").agg(F.count("*").alias("n"))
    rows = lambda df: {(r.id, r.condition): r.n for r in df.collect()}
    assert rows(got) == rows(want) and got.count() > 100
    assert points_in_polygons(polygons.limit(0), points, grid, "id").count() == 0
    assert points_in_polygons(polygons, points.limit(0), grid, "id").count() == 0


def test_insides_come_from_counts(spark):
    """A wide box takes few counts, on several levels, however many points are inside; only border points are tested."""
    geo.register(spark)
    box = spark.range(1).select("id", geo.box(F.lit(1.0), F.lit(1.0), F.lit(1023.0), F.lit(1023.0)).alias("geom"))
    cells = box.select(F.inline(geo.cover("geom", 8.0, 0.125, 20)))
    levels = {(r.level, r.whole): r.n for r in cells.groupBy("level", F.isnull("geom").alias("whole")).agg(F.count("*").alias("n")).collect()}
    assert levels[(0, False)] == 4 * 127 and max(k for k, whole in levels if whole) >= 5
    assert sum(4**level * n for (level, _), n in levels.items()) == 128**2


@pytest.mark.parametrize("grid", [GRID, DIVIDED, Grid(500.0)])
def test_clip_equals_whole_intersections(field, grid):
    marks = field.select(
        F.col("id").alias("fid"), "geom"
    )
    base = field.filter("id % 2 = 0").select(
        F.concat(F.lit("L"), F.col("id") % 4).alias("lc_level2"), F.lit("x").alias("lc_level3"),
        F.lit("c").alias("condition"), "geom")
    got = overlay.category_areas(marks, base, grid).groupBy("fid", "category").agg(F.sum("area").alias("a"))
    got = {(r.fid, r.category): r.a for r in got.collect()}
    cross = marks.crossJoin(base.withColumnRenamed("geom", "g")).filter(geo.intersects("geom", "g"))
    cross = cross.withColumn("cut", geo.intersection("geom", "g")).groupBy("fid", "lc_level2").agg(
        geo.union("cut").alias("cut"))
    want = {(r.fid, f"{r.lc_level2} - x - c"): r.a for r in cross.select(
        "fid", "lc_level2", geo.area("cut").alias("a")).collect()}
    assert got.keys() == want.keys()
    for k, a in want.items():
        assert got[k] == pytest.approx(a, rel=1e-6, abs=1e-6)


def test_clip_overlay_parts(spark):
    geo.register(spark)
    foot = spark.sql("select 1 as fid, lc_box(0D, 0D, 100D, 10D) as geom")
    base = spark.sql(
        """select 'a' lc_level2, 'b' lc_level3, 'c' condition, lc_box(x, -5D, x + 20D, 20D) geom
           from values (-10D), (5D), (60D) as t(x)"""
    )
    parts = overlay.clip_overlay(foot, base, GRID).select("fid", geo.area("geom").alias("a")).collect()
    assert sorted(r.a for r in parts) == [200.0, 250.0]


def test_unmapped_rows_have_null_areas(spark):
    geo.register(spark)
    polygons = spark.sql(
        "select 'in' as grant_id, lc_box(0D, 0D, 10D, 10D) geom union all select 'out', lc_box(500D, 0D, 510D, 10D)"
    )
    base = spark.sql("select 'Scrub' lc_level2, 'Scrub' lc_level3, 'Forest' condition, lc_box(0D, 0D, 10D, 5D) geom")
    draft = overlay.overlay_report(polygons, base, GRID)
    rows = {r.grant_id: r for r in overlay.append_unmapped(draft, polygons, GRID).collect()}
    assert (rows["in"].scrub, rows["in"].conifer) == (50, 0)
    assert rows["out"].scrub is None and rows["out"].project_area == 100


def test_point_buffer_has_32_sides(spark):
    geo.register(spark)
    area = spark.range(1).select(geo.area(geo.buffer(geo.point(100, 200), 30))).first()[0]
    assert area == pytest.approx(2809.3006370) == pytest.approx(16 * 900 * sin(2 * pi / 32))


def test_footprint_of_layers(spark):
    geo.register(spark)
    head = "grant_id string, site_id string, restoration_technique string, notes string, wkt string"

    def layer(rows):
        df = spark.createDataFrame(rows, head)
        df = df.withColumn("geom", geo.from_text("wkt")).drop("wkt")
        return df.withColumn("techniques", F.col("restoration_technique"))

    square = "POLYGON ((0 0, 100 0, 100 100, 0 100, 0 0))"
    layers = {
        "restoration_lines": layer([
            ("G1", "s", "New TRACK", None, "LINESTRING (5000 0, 6000 0)"),
            ("G1", "s", None, None, "LINESTRING (7000 0, 8000 0)"),
            ("G1", "s", "dams", None, "LINESTRING (1000 0, 1100 0)"),
        ]),
        "restoration_points": layer([("G1", "s", "dams", None, "POINT (1050 0)"), ("old", "s", "x", None, "POINT (0 0)")]),
        "restoration_areas": layer([
            ("G1", "t", "scrub removal", None, square),
            ("G1", "u", "Scrub removal", None, square),
            ("G1", "v", None, None, square),
        ]),
        "bare_peat_stabilisation": layer([("G1", "w", None, None, square)]),
        "forest_to_bog": layer([("G1", "x", None, None, square), ("G1", "x", None, None, None)]),
    }
    grants = spark.createDataFrame([("G1", 2026), ("old", 2025)], "grant_id string, financial_year_end int")
    from landcarbon.plans import applications, final_reports

    circle = 16 * 900 * sin(2 * pi / 32)
    whole = {r.site_id: r.a for r in applications.footprint(layers, grants, GRID).groupBy("grant_id", "site_id").agg(
        F.sum(geo.area("geom")).alias("a")).collect()}
    assert whole.keys() == {"s", "t", "u", "v", "w", "x"}
    assert whole["s"] == pytest.approx(100 * 60 + circle)
    assert whole["t"] == whole["x"] == 10_000
    assert whole["u"] == whole["v"] == whole["w"] == pytest.approx(10_000 + 4 * 100 * 30 + circle)

    fallback = spark.createDataFrame(
        [("G1", "t", square), ("G1", None, square), ("G9", "a", square)], "grant_id string, site_id string, wkt string"
    ).select("grant_id", "site_id", geo.from_text("wkt").alias("geom"))
    final = final_reports.footprint(layers, GRID, 50.0, fallback)
    pairs = {(r.grant_id, r.site_id) for r in final.collect()}
    # Bare peat is not part of it, the older grant is; the fallback adds what is missing.
    assert pairs == {("G1", s) for s in ("s", "t", "u", "v", "x", None)} | {("old", "s"), ("G9", "a")}


def test_circles_use_the_short_pi(spark):
    geo.register(spark)
    summary = spark.sql("select 'G1' grant_reference, 3.14D as ha_reported_total, lc_point(0D, 0D) as geom")
    row = footprint.circles_from_hectares(summary, GRID).select(geo.area("geom").alias("a")).first()
    assert row.a == pytest.approx(16 * 10_000 * sin(2 * pi / 32))


def test_multi_puts_parts_together(spark, field):
    parts = dissolve(field, [FY], GRID)
    whole = multi(parts, [FY])
    assert {r.t for r in whole.select(geo.geometry_type("geom").alias("t")).collect()} == {"MultiPolygon"}
    assert geo.explode_parts(whole).count() == parts.count()
    assert set(ENVELOPE) <= set(geo.with_envelope(whole).columns)


def test_wide_features_do_not_keep_a_crowded_cell_whole(spark):
    small = [(float(i % 20) * 5, float(i // 20 % 20) * 5, float(i % 20) * 5 + 5, float(i // 20 % 20) * 5 + 5) for i in range(2000)]
    wide = [(0.0, 0.0, 1_000.0, 1_000.0)] * 60
    df = spark.createDataFrame(small + wide, "minx double, miny double, maxx double, maxy double")
    grid = Grid(120.0, 1_000_000, 50)
    hot = crowded_cells(cell_extents(df, grid.size), cell_extents(df, grid.size), grid)
    assert hot is not None and {(r._ix, r._iy) for r in hot.collect()} == {(0, 0)}


@pytest.mark.parametrize(
    ("wkt", "area"),
    [
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", 15.0),  # valid
        ("POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))", 8.0),
        ("POLYGON ((0 0, 3 0, 3 3, 1 3, 1 -1, 2 -1, 2 2, 0 2, 0 0))", 7.0),  # the middle is wound around twice
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (6 0, 8 0, 8 2, 6 2, 6 0))", 20.0),  # a hole outside
        ("POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 8 1, 8 8, 1 8, 1 1), (2 2, 3 2, 3 3, 2 3, 2 2))", 33.0),  # a hole in a hole
        ("MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((0 0, 4 0, 4 4, 0 4, 0 0)))", 16.0),  # the same part twice
        ("POLYGON ((0 0, 4 0, 0 0, 0 0))", 0.0),
    ],
)
def test_repair(spark, wkt, area):
    geo.register(spark)
    row = spark.range(1).select(geo.area(geo.make_valid(geo.from_text(F.lit(wkt)))).alias("area")).first()
    assert row.area == pytest.approx(area)


# Ground in a cell of 40 m, and an edge along the border of the same cell.
ANGLE = "POLYGON ((30 0, 60 0, 60 10, 40 10, 40 90, 30 90, 30 0))"


def test_ground_and_a_touching_edge_in_one_cell(spark):
    geo.register(spark)
    df = spark.range(1).select("id", geo.from_text(F.lit(ANGLE)).alias("geom"))
    pieces = tiles(df, 40.0).select("_ix", "_iy", geo.geometry_type("geom").alias("type"), geo.area("geom").alias("area"))
    found = {(r._ix, r._iy, r.type): r.area for r in pieces.collect()}
    assert (found[1, 0, "Polygon"], found[1, 0, "LineString"], found[1, 1, "LineString"]) == (200, 0, 0)
    assert sum(found.values()) == 1100

    later = spark.range(1).select("id", geo.box(50.0, 0.0, 70.0, 100.0).alias("geom"))
    years = df.select(F.lit("a").alias("grant_id"), F.lit(2000).alias(FY), "geom").unionByName(
        later.select(F.lit("b").alias("grant_id"), F.lit(2001).alias(FY), "geom")
    )
    left = {r.grant_id: r.area for r in overlap.subtract_higher_priority(years, GRID).select("grant_id", geo.area("geom").alias("area")).collect()}
    assert left == {"a": 1000, "b": 2000}

    spots = spark.createDataFrame([("x", 50.0, 5.0), ("x", 40.0, 50.0), ("x", 35.0, 85.0), ("x", 70.0, 5.0)], "condition string, x double, y double")
    spots = spots.select("condition", geo.point(F.col("x"), F.col("y")).alias("geom"))
    assert points_in_polygons(df, spots, GRID, "id").agg(F.sum("n")).first()[0] == 2


def test_equal_polygons_are_shuffled_once(spark, field):
    df = field.select("id", "geom").unionByName(spark.range(2000, 2003).select("id", F.lit(None).cast("binary").alias("geom")))
    kept = overlap.drop_equal(df, ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "stage-" not in plan
    assert kept.filter("geom is null").count() == 3
    assert kept.filter("geom is not null").count() == field.select(geo.canonical("geom").alias("c")).distinct().count()


def test_collection_of_several_dimensions_is_cut(spark):
    geo.register(spark)
    text = "GEOMETRYCOLLECTION (POLYGON ((1 1, 15 1, 15 15, 1 15, 1 1)), LINESTRING (15 15, 25 15))"
    df = spark.createDataFrame([(1, text)], "id long, t string").select("id", geo.from_text("t").alias("geom"))
    cut = tiles(df, 10.0).groupBy(geo.geometry_type("geom").alias("kind")).agg(F.sum(geo.area("geom")).alias("area"), F.count(F.lit(1)).alias("n"))
    assert {(r.kind, r.area, r.n) for r in cut.collect()} == {("Polygon", 196.0, 4), ("LineString", 0.0, 2)}


def test_rectangles_are_clipped_as_other_polygons(spark):
    """A rectangle and the same one with one more corner on a side give the same pieces."""
    geo.register(spark)
    sides = [(0, 0, 4, 4), (4, 0, 8, 4), (4, 4, 6, 6), (1, 1, 2, 3), (9, 9, 12, 12), (-1.5, 0.25, 7.5, 0.75)]
    drawn = [(f"POLYGON (({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))", f"POLYGON (({a} {b}, {(a + c) / 2} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))") for a, b, c, d in sides]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(drawn)], "id long, a string, b string")
    df = df.select("id", geo.from_text("a").alias("box"), geo.from_text("b").alias("other"))
    pairs = df.crossJoin(df.select(*(F.col(c).alias(f"r_{c}") for c in df.columns)))
    found = pairs.select(geo.clip("box", "r_box").alias("x"), geo.clip("other", "r_other").alias("y"))
    found = found.selectExpr("size(x) as m", "size(y) as n", "lc_equals(get(x, 0), get(y, 0)) as same", "lc_type(get(x, 0)) as k", "lc_type(get(y, 0)) as l").collect()
    # A line with the further corner may come in two parts.
    assert [r for r in found if r.m != r.n or r.m and not (r.same and r.k == r.l.removeprefix("Multi"))] == []
    assert {r.k for r in found} == {None, "Point", "LineString", "Polygon"}
    whole = [tiles(df.select("id", F.col(c).alias("geom")), 2.5).groupBy("id", "_ix", "_iy").agg(F.sum(geo.area("geom")).alias("area")) for c in ("box", "other")]
    assert sorted(map(tuple, whole[0].collect())) == sorted(map(tuple, whole[1].collect()))


def test_parts_of_an_overlay_follow_its_pieces(field, monkeypatch):
    land = field.select(F.lit("a").alias("lc_level2"), F.lit("b").alias("lc_level3"), F.lit("c").alias("condition"), "geom")
    work = field.select(F.col("id").alias("fid"), "geom")
    result = lambda df: {(r.fid, r.category, round(r.area, 6)) for r in df.groupBy("fid", "category").agg(F.sum("area").alias("area")).collect()}
    want = result(overlay.category_areas(work, land, GRID))
    monkeypatch.setattr(overlay, "PART_PIECES", 4)
    df = overlay.category_areas(work, land, GRID)
    assert df.rdd.getNumPartitions() > 2 * field.sparkSession.sparkContext.defaultParallelism and result(df) == want


def test_copies_are_found_without_sorting(field):
    plan = geo.distinct_shapes(geo.with_shape(field.select("geom")))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_features_are_widened_where_they_are_put_together(spark):
    """The dissolve of features with distances is that of their buffers, without these being shuffled."""
    geo.register(spark)
    shapes = [
        "POINT (3 4)", "POINT (3 4)", "LINESTRING (0 0, 7 5)", "LINESTRING (0 0, 7 5, 9 1)", "LINESTRING (2 2, 2 2)", "POLYGON ((0 0, 5 0, 5 3, 0 3, 0 0))",
        "POLYGON ((20 20, 20 25, 25 25, 25 20, 20 20))", "POLYGON ((40 0, 48 8, 48 0, 40 8, 40 0))", "POLYGON EMPTY", "MULTIPOINT (90 90, 95 95)",
        "POLYGON ((70 0, 76 0, 76 6, 72 6, 72 -2, 74 -2, 74 4, 70 4, 70 0))", "POLYGON ((100 0, 120 0, 120 20, 100 20, 100 0), (105 5, 115 5, 115 15, 105 15, 105 5))",
    ]
    rows = [(k, f"{k % 5}", w, d) for k, (w, d) in enumerate((w, d) for w in shapes for d in (0.0, 0.5, 3.0))] + [(99, "0", None, 1.0), (98, "0", shapes[0], None)]
    df = spark.createDataFrame(rows, "id int, k string, wkt string, d double").select("k", geo.from_text("wkt").alias("geom"), "d")
    wide = df.select("k", F.explode(F.array(geo.buffer(geo.make_valid("geom"), F.col("d")))).alias("geom"))
    done = dissolve(df, ["k"], Grid(120.0), "d")
    assert "lc_buffer" not in done._jdf.queryExecution().executedPlan().toString()
    found, want = (t.groupBy("k").agg(geo.union("geom").alias(n)) for t, n in ((done, "a"), (wide, "b")))
    apart = found.join(want, "k").select(geo.area("a"), geo.area("b"), geo.area(geo.difference("a", "b")), geo.area(geo.difference("b", "a"))).collect()
    assert len(apart) == 5 and all(abs(a - b) < 1e-6 and c < 1e-6 and d < 1e-6 for a, b, c, d in apart)


def test_outlines_of_simple_shapes_are_their_buffers(spark):
    """Of a point, a straight line and a rectangle, against the library's buffer of the same ground drawn with more vertices."""
    geo.register(spark)
    pairs = [("POINT (3 4)", "MULTIPOINT (3 4)"), ("LINESTRING (1 1, 9 4)", "LINESTRING (1 1, 5 2.5, 9 4)"), ("POLYGON ((0 0, 0 3, 5 3, 5 0, 0 0))", "POLYGON ((0 0, 2 0, 5 0, 5 3, 0 3, 0 0))")]
    df = spark.createDataFrame(pairs, "a string, b string").crossJoin(spark.createDataFrame([(0.25,), (30.0,)], "d double"))
    df = df.select(*(geo.buffer(geo.from_text(c), F.col("d")).alias(c) for c in "ab"))
    for a, b, c in df.select(geo.area("a"), geo.area("b"), geo.area(geo.difference("a", "b"))).collect():
        assert abs(a - b) < 1e-6 * a and c < 1e-6 * a


def test_a_union_of_groups_apart_is_the_union(spark):
    """Chains of boxes far from each other, in any order, with copies and holes: parts and areas are those of the whole."""
    geo.register(spark)
    boxes = [(x * 50 + i * 4, y * 50, x * 50 + i * 4 + 6, y * 50 + 5) for x in range(6) for y in range(5) for i in range(1 + (x + y) % 4)]
    df = spark.createDataFrame(boxes * 2, "a int, b int, c int, d int").repartition(3, "a", "b").select(geo.box(*(F.col(c) for c in "abcd")).alias("geom"))
    whole = geo.explode_parts(df.agg(geo.union("geom").alias("geom"))).select(geo.area("geom").alias("n")).collect()
    assert sorted(r.n for r in whole) == sorted(5.0 * (6 + 4 * ((x + y) % 4)) for x in range(6) for y in range(5))


def test_fallback_footprints_follow_the_ground_of_features(spark):
    """Sites whose features have no ground take the older footprint; no polygon is written to know them."""
    geo.register(spark)
    areas = [("a", "scrub removal", "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0))"), ("b", "scrub removal", "POLYGON ((0 0, 9 0, 5 0, 0 0))"), ("c", "dams", "POLYGON ((0 0, 9 0, 5 0, 0 0))")]
    areas += [("d", "scrub removal", "POLYGON EMPTY"), ("e", "scrub removal", "LINESTRING (0 0, 9 9)"), ("f", "dams", "LINESTRING (0 0, 9 9)"), ("g", None, "POINT (1 1)"), ("h", "scrub removal", "POLYGON ((0 0, 8 8, 8 0, 0 8, 0 0))")]
    areas += [("i", "dams", None), ("b", "scrub removal", "POINT (1 1)"), ("d", "dams", "POINT EMPTY")]
    df = spark.createDataFrame([(s, t, w) for s, t, w in areas], "site_id string, restoration_technique string, wkt string")
    df = df.select(F.lit("g").alias("grant_id"), "site_id", "restoration_technique", F.lit(None).cast("string").alias("notes"), geo.from_text("wkt").alias("geom"))
    old = spark.createDataFrame([("g", s) for s in "abcdefghijj"], "grant_id string, site_id string").withColumn("geom", geo.box(0.0, 0.0, 1000.0, 1.0))
    done = footprint.build_footprint({"restoration_areas": df}, 5.0, Grid(120.0), include=["restoration_areas"], fallback=old)
    ground = footprint.build_footprint({"restoration_areas": df}, 5.0, Grid(120.0), include=["restoration_areas"]).select("site_id").distinct()
    fell = [r.site_id for r in done.filter(geo.area("geom") == 1000).collect()]
    new = {r.site_id for r in ground.collect()}
    assert sorted(fell) == sorted(s for s in "abcdefghijj" if s not in new) and {"a", "f", "g", "h"} <= new and not {"b", "d", "e", "i"} & new
    assert not any("stage-" in f for f in done.inputFiles())
