"""Equal polygons have one canonical form, and reports know the place of each row."""

import random

from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.operators.overlap import drop_equal
from landcarbon.plans.reporting import in_report_order, numbered


def ring(points, r):
    """The same ring with another start, direction and some vertices on its straight runs."""
    out = []
    for (x, y), (u, v) in zip(points, points[1:] + points[:1]):
        out += [(x, y), *(((x + u) / 2, (y + v) / 2),) * r.randint(0, 2)]
    at = r.randrange(len(out))
    out = out[at:] + out[:at]
    out = out[::-1] if r.random() < 0.5 else out
    return "(" + ", ".join(f"{x} {y}" for x, y in [*out, out[0]]) + ")"


def polygon(kind, r):
    a = ring([(0, 0), (8, 0), (8, 8), (0, 8)], r)
    holes = [ring([(1, 1), (2, 1), (2, 2)], r), ring([(4, 4), (6, 4), (6, 6), (4, 6)], r)]
    r.shuffle(holes)
    parts = [f"({ring([(0, 0), (2, 0), (2, 2)], r)})", f"({ring([(4, 4), (6, 4), (6, 6)], r)})"]
    r.shuffle(parts)
    return {
        "square": f"POLYGON({a})" if r.random() < 0.5 else f"MULTIPOLYGON(({a}))",
        "one hole": f"POLYGON({a}, {ring([(1, 1), (2, 1), (2, 2)], r)})",
        "holes": f"POLYGON({a}, {', '.join(holes)})",
        "parts": f"MULTIPOLYGON({', '.join(parts)})",
        "corner": f"POLYGON({ring([(0, 0), (8, 0), (8, 8)], r)})",
        "zero": f"POLYGON({ring([(-0.0, 0), (8, -0.0), (8, 8.5)], r)})",
    }[kind]


def test_equal_polygons_share_one_form(spark):
    geo.register(spark)
    r = random.Random(2)
    kinds = ["square", "one hole", "holes", "parts", "corner", "zero"]
    rows = [(i, kinds[i % 6], polygon(kinds[i % 6], r)) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, kind string, wkt string").withColumn("geom", geo.from_text("wkt"))
    forms = df.select("kind", F.md5(geo.canonical("geom")).alias("form")).distinct().collect()
    assert len(forms) == 6 and len({f.kind for f in forms}) == 6
    same = df.select(geo.equals("geom", geo.canonical("geom")).alias("same")).distinct().collect()
    assert [x.same for x in same] == [True]


def test_drop_equal_is_one_grouping(spark):
    geo.register(spark)
    r = random.Random(3)
    rows = [(str(i), polygon(["square", "holes", "parts"][i % 3], r)) for i in range(30)] + [("x", None), ("y", None)]
    df = spark.createDataFrame(rows, "grant_id string, wkt string").withColumn("geom", geo.from_text("wkt")).drop("wkt")
    kept = drop_equal(df.unionAll(df), ["grant_id"])
    assert kept.filter("geom is not null").count() == 3 and kept.filter("geom is null").count() == 4
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "lc_equals" not in plan


def test_places_in_the_report_order(spark):
    rows = [(k, v) for k in ["b", None, "a", "B", "é", "10", "9"] for v in ("x", "y", None)]
    df = spark.createDataFrame(rows, "grant_id string, emission_factor_pre string").repartition(5)
    want = [tuple(r) for r in in_report_order(df).collect()]
    got = sorted(numbered(df).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, len(rows) + 1)) and [tuple(r)[:2] for r in got] == want
    assert numbered(df.limit(0)).count() == 0
