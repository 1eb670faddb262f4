"""Survey points in polygons: share of each condition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.categories import CONDITIONS
from landcarbon.operators.grid import Grid
from landcarbon.session import cut_lineage

# Levels of the pyramid above the grid's cells, and of the division of crowded cells below them.
TOP, FINEST = 20, 12


def share(count: str, total: str, integer: bool) -> Column:
    """Percentage of a total: whole, cut off below; or exact."""
    if integer:
        return F.expr(f"cast({count} * 100 div {total} as int)")
    return F.expr(f"cast(cast({count} as decimal(18,0)) * 100.0 / cast({total} as decimal(18,0)) as decimal(20,12))")


def condition_shares(
    df: DataFrame, keys: list[str], condition: str = "condition", weight: str = "1", integer: bool = True
) -> DataFrame:
    """Share of the twelve conditions per key, among all rows, unknown conditions included.

    ``weight`` is the number of equal rows that a row stands for.
    """
    counts = [
        F.expr(f"sum(case when {condition} = '{c}' then {weight} else 0 end)").alias(name)
        for c, name in CONDITIONS.items()
    ]
    counted = df.groupBy(*keys).agg(F.expr(f"sum({weight})").alias("_total"), *counts)
    return counted.select(*keys, *(share(name, "_total", integer).alias(name) for name in CONDITIONS.values()))


def _pyramid(counted: DataFrame, place: list[str], top: Column | int) -> DataFrame:
    """Counts per cell and condition on all levels from 0 to ``top``: (place, level, cx, cy, condition, n)."""
    tops = top if isinstance(top, Column) else F.lit(top)
    levels = counted.withColumn("level", F.explode(F.sequence(F.lit(0), tops.cast("int"))))
    at = {c: F.expr(f"shiftright({c}, level)") for c in ("cx", "cy")}
    return levels.withColumns(at).groupBy(*place, "level", "cx", "cy", "condition").agg(F.sum("n").alias("n"))


def _divisions(placed: DataFrame, pieces: DataFrame, grid: Grid) -> DataFrame | None:
    """Cells where too many points meet too many pieces: (ix, iy, k, top), with k = 2 ** top parts per side; None if there are none.

    The parts follow the number of points alone. A polygon has about 4 k border parts there, and its inside comes as few counts.
    """
    n0 = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n0"))
    n1 = pieces.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n1"))
    hot = n0.join(n1, ["cx", "cy"]).filter(F.col("n0").cast("double") * F.col("n1") > grid.crowded_pairs)
    wanted = F.ceil(F.log2(F.sqrt(F.col("n0") / F.lit(float(grid.part_features)))))
    hot = hot.withColumn("top", F.least(F.greatest(wanted, F.lit(0)), F.lit(FINEST)).cast("int")).filter("top > 0")
    hot = cut_lineage(hot.select(F.col("cx").alias("hx"), F.col("cy").alias("hy"), F.expr("shiftleft(1L, top)").alias("k"), "top"))
    return None if hot.isEmpty() else hot


def _tested(placed: DataFrame, pieces: DataFrame, place: list[str], key: str) -> DataFrame:
    """Points and pieces of a cell, point by point."""
    x, y = F.col("x"), F.col("y")
    inside_envelope = (x > F.col("minx")) & (x < F.col("maxx")) & (y > F.col("miny")) & (y < F.col("maxy"))
    met = placed.join(pieces, place).filter(inside_envelope & geo.within(geo.point(x, y), F.col("geom")))
    return met.select(key, "condition", "n")


def points_in_polygons(polygons: DataFrame, points: DataFrame, grid: Grid, key: str = "fid") -> DataFrame:
    """Points strictly inside polygons, as (key, condition, n); a key may have several rows of a condition, to be summed.

    Points on a boundary are outside. Equal points are counted first. A polygon takes the counts of the cells wholly inside
    it from a pyramid of counts per cell and condition, as wide cells as possible, and meets single points in its border
    cells only. Border cells with very many points are divided, and counted in the same way.
    Cells reach a little beyond their borders, so that a point on a cell border is still inside the piece.
    """
    geo.register(polygons.sparkSession)
    size = float(grid.size)
    margin = size / 64
    placed = geo.with_envelope(points.select("condition", "geom"), drop_empty=True)
    placed = placed.groupBy(F.col("minx").alias("x"), F.col("miny").alias("y"), "condition").agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = cut_lineage(placed.withColumns({f"c{a}": F.floor(F.col(a) / F.lit(size)).cast("long") for a in "xy"}))
    cells = cut_lineage(polygons.select(key, F.inline(geo.cover("geom", size, margin, TOP))).withColumnsRenamed({"ix": "cx", "iy": "cy"}))
    # One number: the widest cells that are in use.
    top = cells.filter("geom is null").agg(F.max("level")).first()[0]
    found = []
    if top is not None:
        sums = _pyramid(placed, [], top)
        found.append(cells.filter("geom is null").select(key, "level", "cx", "cy").join(sums, ["level", "cx", "cy"]).select(key, "condition", "n"))
    pieces = cells.filter("geom is not null").drop("level")
    hot = _divisions(placed, pieces, grid)
    if hot is None:
        found.append(_tested(placed, pieces, ["cx", "cy"], key))
    else:
        at = (F.col("cx") == F.col("hx")) & (F.col("cy") == F.col("hy"))
        found.append(_tested(placed.join(hot, at, "left_anti"), pieces.join(hot, at, "left_anti"), ["cx", "cy"], key))
        found += _in_parts(placed.join(hot, at), pieces.join(hot, at), size, margin / 1024, key)
    return reduce(DataFrame.unionByName, found)


def _in_parts(placed: DataFrame, pieces: DataFrame, size: float, margin: float, key: str) -> list[DataFrame]:
    """Counts in divided cells: parts wholly inside from a pyramid over the parts, the others point by point."""
    step = F.lit(size) / F.col("k")
    # The same parts as the quadtree has, counted over the whole plane and held inside the cell.
    part = {
        f"c{a}": F.least(F.greatest(F.floor(F.col(a) / step).cast("long"), F.col(f"h{a}") * F.col("k")), (F.col(f"h{a}") + 1) * F.col("k") - 1)
        for a in "xy"
    }
    placed = placed.withColumns(part)
    cut = pieces.select(key, "hx", "hy", "k", "top", F.inline(geo.cover("geom", step, margin, F.col("top")))).withColumnsRenamed({"ix": "cx", "iy": "cy"})
    inside = [F.expr(f"shiftright(c{a}, top - level) = h{a}") for a in "xy"]
    cut = cut_lineage(cut.filter(inside[0] & inside[1]))
    place = ["hx", "hy", "cx", "cy"]
    sums = _pyramid(placed, ["hx", "hy"], F.col("top"))
    whole = cut.filter("geom is null").select(key, "hx", "hy", "level", "cx", "cy").join(sums, [*place, "level"]).select(key, "condition", "n")
    border = cut.filter("geom is not null").select(key, *place, "geom", "minx", "miny", "maxx", "maxy")
    return [whole, _tested(placed.select(*place, "x", "y", "condition", "n"), border, place, key)]


def point_condition_share(
    polygons: DataFrame, points: DataFrame, grid: Grid, key: str = "fid", integer: bool = True
) -> DataFrame:
    """Polygons with the twelve percentages of the points inside; all 0 where there is no point."""
    found = points_in_polygons(polygons, points, grid, key)
    shares = condition_shares(found, [key], weight="n", integer=integer)
    none = {name: F.expr(f"coalesce({name}, 0)") for name in CONDITIONS.values()}
    return polygons.join(shares, key, "left").withColumns(none)
