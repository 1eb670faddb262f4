"""What rasters say of two polygons is what the geometry says, and existence tests read no geometry where they decide."""

import random

import pytest
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.geo import ENVELOPE
from landcarbon.operators import overlap
from landcarbon.operators.grid import TESTS, Grid, in_cells, spatial_exists, spatial_hits, staged_shapes


def polygon(r):
    """A box, a triangle, a star of eight corners or a box with a hole, on a lattice so that borders often touch."""
    x, y = r.randint(-20, 60), r.randint(-20, 60)
    w = r.choice([1, 2, 4, 8, 30])
    kind = r.randrange(5)
    if kind == 0:
        return f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}))"
    if kind == 1:
        return f"POLYGON(({x} {y}, {x + w} {y}, {x} {y + w}, {x} {y}))"
    if kind == 2:
        a, b = x + w / 3, y + w / 3
        return f"POLYGON(({x} {y}, {a} {y + w / 5}, {x + w} {y}, {x + w * .8} {b}, {x + w} {y + w}, {a} {y + w * .8}, {x} {y + w}, {x + w / 5} {b}, {x} {y}))"
    if kind == 3:
        return f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + w}, {x} {y + w}, {x} {y}), ({x + w / 4} {y + w / 4}, {x + w / 2} {y + w / 4}, {x + w / 2} {y + w / 2}, {x + w / 4} {y + w / 4}))"
    z = x + r.random()
    return f"POLYGON(({z} {y}, {z + w} {y + w / 3}, {z + w / 7} {y + w}, {z} {y}))"


@pytest.fixture(scope="module")
def field(spark):
    geo.register(spark)
    r = random.Random(6)
    texts = [polygon(r) for _ in range(140)] + ["POINT(3 3)", "LINESTRING(0 0, 9 9)", "POLYGON EMPTY", "POLYGON((0 0, 1e7 0, 0 1e7, 0 0))"]
    rows = [(i, i % 3 if i % 11 else None, t) for i, t in enumerate(texts + texts[:6])]
    df = spark.createDataFrame(rows, "id int, year int, wkt string").withColumn("geom", geo.from_text("wkt")).drop("wkt")
    df = df.cache()
    df.count()
    return df


@pytest.mark.parametrize("test", ["intersects", "within", "covered_by", "overlaps"])
def test_verdicts_agree_with_geometry(field, test):
    side = field.select("id", "geom", geo.raster("geom").alias("raster"))
    a, b = (side.select(*(F.col(c).alias(f"{p}_{c}") for c in side.columns)) for p in "ab")
    pairs = a.crossJoin(b).select(geo.decided(test, "a_raster", "b_raster").alias("said"), TESTS[test](F.col("a_geom"), F.col("b_geom")).alias("true"))
    counted = {(r.said, r.true): r.n for r in pairs.groupBy("said", "true").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert (1, False) not in counted and (0, True) not in counted
    undecided = sum(n for (said, _), n in counted.items() if said == -1)
    assert counted[1, True] > 0 and undecided < 0.15 * sum(counted.values())


@pytest.mark.parametrize("grid", [Grid(10.0), Grid(40.0, crowded_pairs=4, part_features=1)])
@pytest.mark.parametrize("test", ["intersects", "overlaps", "covered_by"])
def test_existence_equals_brute_force(field, grid, test):
    df = field.filter("id != 143")  # the huge one would cover a million cells of this grid
    right = df.filter("id % 4 = 1")
    a, b = df.select("id", "geom"), right.select(F.col("id").alias("j"), F.col("geom").alias("other"))
    want = {r.id for r in a.crossJoin(b).filter(TESTS[test](F.col("geom"), F.col("other"))).select("id").distinct().collect()}
    got = [r.id for r in spatial_exists(df, right, test, grid).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.id for r in spatial_exists(df, right, test, grid, negate=True).collect()} == {r.id for r in df.collect()} - want


def test_overlap_flags_equal_brute_force(field):
    df = field.filter("id < 140 or id > 143")
    rows = df.crossJoin(df.select(F.col("id").alias("j"), F.col("year").alias("y"), F.col("geom").alias("other")))
    found = rows.filter(geo.overlaps("geom", "other")).groupBy("id").agg(F.max(F.expr("coalesce(year = y, false)")).alias("same")).collect()
    same = {r.id: r.same for r in found}
    want = {r.id: (1 if same[r.id] else None) if r.id in same else 0 for r in df.collect()}
    assert {r.id: r.overlap for r in overlap.flag_overlap(df, Grid(10.0), group="year").collect()} == want
    assert {r.id: r.overlap for r in overlap.flag_overlap(df, Grid(10.0), group=None).collect()} == {i: int(v != 0) for i, v in want.items()}


def test_the_semi_join_reads_no_geometry(spark, field):
    boxes = spark.range(50).select(geo.box(F.col("id") * 3.0, F.lit(0.0), F.col("id") * 3.0 + 4, F.lit(4.0)).alias("geom"))
    shapes = staged_shapes(geo.with_shape(boxes))
    hits = spatial_hits(shapes, shapes, "overlaps", Grid(10.0), ["_shape"], condition=F.col("l__shape") != F.col("r__shape"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and not any("geom#" in line for line in scans) and "lc_decide_overlaps" in plan
    assert hits.count() == 50 and not set(ENVELOPE) & set(hits.columns)


def test_rasters_of_rectangles_do_not_travel(field, monkeypatch):
    seen = []

    def listed(sides, grid, real=in_cells):
        seen.extend(sides.values())
        return real(sides, grid)

    monkeypatch.setattr("landcarbon.operators.grid.in_cells", listed)
    shapes = staged_shapes(geo.with_shape(field.filter("id < 140")))
    spatial_hits(shapes, shapes, "overlaps", Grid(10.0), ["_shape"]).count()
    counted = {(r.box, r.none) for r in seen[0].select("box", F.col("raster").isNull().alias("none")).collect()}
    assert counted == {(True, True), (False, False)}


def test_rectangles_are_staged_as_envelopes(field):
    """Shapes with copies: of a rectangle neither geometry nor cells are written, and tests that need them see it all the same."""
    rows = field.select("id", "geom").unionAll(field.select("id", "geom"))
    shapes = staged_shapes(geo.with_shape(rows))
    kinds = {(r.box, r.g, r.r) for r in shapes.select("box", F.col("geom").isNull().alias("g"), F.col("raster").isNull().alias("r")).collect()}
    assert kinds <= {(True, True, True), (False, False, False), (False, False, True)} and len(kinds) > 1
    assert {r.copies % 2 for r in shapes.select("copies").collect()} == {0}


def test_rectangles_with_vertices_on_their_sides(spark):
    """What a union leaves of boxes in a row is a rectangle, of which no cells travel; what only has its envelope is none."""
    geo.register(spark)
    texts = {
        "row": "POLYGON((0 0, 4 0, 8 0, 12 0, 12 8, 8 8, 4 8, 0 8, 0 0))",
        "turned": "POLYGON((4 8, 0 8, 0 0, 4 0, 12 0, 12 8, 4 8))",
        "backwards": "POLYGON((0 0, 0 8, 4 8, 12 8, 12 0, 4 0, 0 0))",
        "notched": "POLYGON((0 0, 4 0, 4 2, 6 2, 6 0, 12 0, 12 8, 0 8, 0 0))",
        "cut": "POLYGON((0 0, 12 0, 12 8, 4 8, 0 4, 0 0))",
        "holed": "POLYGON((0 0, 6 0, 12 0, 12 8, 0 8, 0 0), (2 2, 4 2, 4 4, 2 2))",
    }
    df = spark.createDataFrame(list(texts.items()), "id string, wkt string").withColumn("geom", geo.from_text("wkt"))
    rows = df.withColumn("raster", geo.raster("geom")).select("id", geo.boxed("raster").alias("box")).collect()
    assert {r.id for r in rows if r.box} == {"row", "turned", "backwards"}
    halves = df.select("id", geo.area(geo.intersection("geom", geo.box(3, 1, 9, 20))).alias("area"))
    assert {r.id: r.area for r in halves.collect()} == {"row": 42, "turned": 42, "backwards": 42, "notched": 40, "cut": 41.5, "holed": 40.5}


def test_used_shuffles_go(spark, tmp_path):
    """The shuffle files of a staged table do not stay until the session ends."""
    from pathlib import Path

    from landcarbon.session import SHUFFLE_CLEANUP, cut_lineage

    root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    files = lambda: set(root.rglob("shuffle_*.data"))
    before, conf = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    assert cut_lineage(spark.range(20000).repartition(7, "id")).count() == 20000
    mine = [f for f in files() - before if f.stat().st_size > 10000]
    assert not mine and spark.conf.get(SHUFFLE_CLEANUP, None) == conf


def test_tables_of_a_step_go_when_it_is_settled(spark):
    """Of nested steps only the outermost result stays; tables written before stay, and those of a step that fails."""
    from pathlib import Path
    from urllib.parse import urlparse

    from landcarbon.session import cut_lineage, settled

    root = Path(urlparse(cut_lineage(spark.range(1)).inputFiles()[0]).path).parent.parent
    stages = lambda: {p.name for p in root.iterdir() if p.name.startswith("stage-")}
    given = cut_lineage(spark.range(10))
    before = stages()

    def inner():
        return cut_lineage(given.selectExpr("id + 1 as id")).union(cut_lineage(given))

    done = settled(lambda: settled(inner).join(cut_lineage(given), "id"))
    assert sorted(r.id for r in done.collect()) == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 9]
    assert len(stages() - before) == 1 and before <= stages() and given.count() == 10
    with pytest.raises(ZeroDivisionError):
        settled(lambda: cut_lineage(given) and 1 / 0)
    assert len(stages() - before) == 2 and settled(lambda: given).count() == 10


def test_resolving_overlaps_leaves_two_tables(field):
    from landcarbon import session

    written = []
    session._written().append(written)
    df = field.filter("id < 60").select(F.col("id").cast("string").alias("grant_id"), F.col("year").cast("int").alias("financial_year_end"), "geom")
    try:
        work = overlap.resolve_overlaps(df, Grid(10.0))
    finally:
        session._written().pop()
    assert work.count() > 0 and len(written) == 2


def test_rest(spark):
    """Ground without a blade: no value where the two have no point in common, nothing of what is covered."""
    geo.register(spark)
    blades = {"apart": (20, 0, 30, 9), "touching": (10, 0, 30, 9), "half": (5, -5, 30, 30), "covering": (-1, -1, 11, 11), "none": None}
    rows = [(k, *(map(float, v) if v else [None] * 4)) for k, v in blades.items()]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, d double")
    blade = F.when(F.col("a").isNotNull(), geo.box(*map(F.col, "abcd")))
    left = df.select("id", geo.area(geo.rest(geo.box(0, 0, 10, 10), blade)).alias("area"))
    assert {r.id: r.area for r in left.collect()} == {"apart": None, "touching": 100, "half": 50, "covering": 0, "none": None}
