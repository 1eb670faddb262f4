"""Spatial joins as equi-joins on the cells of a square grid.

Each feature is listed under the cells that its envelope covers, both sides meet by cell, and native envelope
comparisons come before the exact geometry test. A pair that shares several cells is kept only in the cell with the
lower left corner of the two envelopes' intersection, which needs no shuffle.

Cells double in width from level to level. A feature is at home on the first level whose cells are as wide as itself, so
it covers at most two by two of them, however wide it is. Two features meet on the home level of the wider one; for that,
a feature is also listed on the wider levels that the other side has.

Cells that hold too many candidates are divided further, so that one crowded place becomes many tasks.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.geo import ENVELOPE
from landcarbon.session import cut_lineage, settled

# Candidate pairs in one cell above which it is divided, and features aimed at in each part.
CROWDED_PAIRS = 4_000_000
PART_FEATURES = 500

TESTS = {
    "intersects": geo.intersects,
    "within": geo.within,
    "covered_by": geo.covered_by,
    "overlaps": geo.overlaps,
    "equals": geo.equals,
}
# A cell: whose home it is (0: the left feature's, 1: only the right one's), its width and place, and the part of it.
PLACE = ["_home", "_w", "_ix", "_iy"]
CELL = [*PLACE, "_k", "_sx", "_sy"]
PART = ["_ix", "_iy", "_k", "_sx", "_sy"]


class Grid(NamedTuple):
    """A square grid in metres. Best with cells a few times as wide as the features."""

    size: float
    crowded_pairs: int = CROWDED_PAIRS
    part_features: int = PART_FEATURES


def suggest_cell_size(df: DataFrame, factor: float = 4.0) -> float:
    """A cell size from the median envelope of a table with envelope columns; runs one small aggregation."""
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    median = df.agg(F.percentile_approx(extent, 0.5, 1000)).first()[0]
    return max(1.0, (median or 0.0) * factor)


def _width(size: Column | float) -> Column:
    return size if isinstance(size, Column) else F.lit(float(size))


def _cell_of(value: Column, size: Column | float) -> Column:
    return F.floor(value / _width(size)).cast("long")


def _extent() -> Column:
    return F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))


def covered_cells(df: DataFrame, size: Column | float, prefix: str = "") -> DataFrame:
    """One row per feature and covered cell."""
    minx, miny, maxx, maxy = (F.col(prefix + c) for c in ENVELOPE)
    along_x = df.withColumn("_ix", F.explode(F.sequence(_cell_of(minx, size), _cell_of(maxx, size))))
    return along_x.withColumn("_iy", F.explode(F.sequence(_cell_of(miny, size), _cell_of(maxy, size))))


def _level(size: float) -> Column:
    """How often a cell doubles until it is as wide as the feature."""
    return F.greatest(F.ceil(F.log2(_extent() / F.lit(float(size)))), F.lit(0)).cast("int").alias("_level")


def _levels(sides: list[DataFrame], size: float, same: bool = False) -> list[list[int]]:
    """The home levels on each side; a few numbers, as each stands for a doubling of the width."""
    if same:
        return [sorted(r._level for r in sides[0].select(_level(size)).distinct().collect())] * 2
    found = [df.select(F.lit(i).alias("side"), _level(size)) for i, df in enumerate(sides)]
    rows = found[0].unionAll(found[1]).distinct().collect()
    return [sorted(r._level for r in rows if r.side == i) for i in (0, 1)]


def _on_levels(df: DataFrame, side: int, levels: list[list[int]], size: float) -> DataFrame:
    """Rows once per level they are listed on, with ``_home`` and ``_w``.

    Right features are at home for finer ones on the left, too. So each pair meets once: on the wider one's level.
    """
    if levels[0] == levels[1] and len(levels[0]) == 1:
        # All features are at home on one level, so none is a guest and each row stays one row.
        return df.withColumns({"_home": F.lit(0), "_w": F.lit(float(size) * 2.0 ** levels[0][0])})
    others = f"cast(array({', '.join(map(str, levels[1 - side]))}) as array<int>)"
    own = [0] if side == 0 else [0, 1]
    at_home = f"transform(array({', '.join(map(str, own))}), h -> named_struct('_home', h, '_on', _level))"
    if side == 1:
        at_home = f"filter({at_home}, p -> p._home = 0 or _level > {min(levels[0], default=0)})"
    visits = f"transform(filter({others}, v -> v > _level), v -> named_struct('_home', {1 - side}, '_on', v))"
    placed = df.select("*", _level(size)).selectExpr("*", f"inline(concat({at_home}, {visits}))")
    return placed.withColumn("_w", F.lit(float(size)) * F.pow(F.lit(2.0), "_on")).drop("_level", "_on")


def crowded_cells(left: DataFrame, right: DataFrame, grid: Grid, place: list[str] | None = None) -> DataFrame | None:
    """Cells with too many candidate pairs and into how many parts per side to divide them; None if there are none.

    Both inputs list the columns of the place and ``extent``. The division follows the number of features, but stops
    where the parts would be smaller than the features themselves: beyond that each feature would only be copied to
    more parts. Pairs are the same with and without division.
    """
    place = place or ["_ix", "_iy"]
    return crowded_counts(cell_counts(left, place), cell_counts(right, place), grid, place)


def cell_counts(df: DataFrame, place: list[str]) -> DataFrame:
    """(place, n, extent): features per cell and the sum of their widths."""
    return df.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.sum("extent").alias("extent"))


def placed(cut: DataFrame, grid: Grid) -> DataFrame:
    """Cells of tiles, and how wide these are."""
    extent = F.least(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")), F.lit(float(grid.size)))
    return cut.select("_ix", "_iy", extent.alias("extent"))


def crowded_counts(left: DataFrame, right: DataFrame, grid: Grid, place: list[str]) -> DataFrame | None:
    """As ``crowded_cells``, from the counts of both sides."""
    width = F.col("_w") if "_w" in place else F.lit(float(grid.size))
    counted = [side.select(*place, "n", "extent", F.lit(i).alias("side")) for i, side in enumerate((left, right))]
    n = [F.coalesce(F.sum(F.when(F.col("side") == i, F.col("n"))), F.lit(0)) for i in (0, 1)]
    cells = (
        counted[0]
        .unionAll(counted[1])
        .groupBy(*place)
        .agg(n[0].alias("n0"), n[1].alias("n1"), (F.sum("extent") / F.sum("n")).alias("extent"))
        .filter(F.col("n0").cast("double") * F.col("n1") > grid.crowded_pairs)
    )
    wanted = F.ceil(F.sqrt((F.col("n0") + F.col("n1")) / grid.part_features))
    # NULL, which does not count, where all features are points.
    useful = F.floor(width / F.nullif(F.col("extent"), F.lit(0.0)))
    hot = cells.select(*place, F.greatest(F.least(wanted, useful), F.lit(1)).cast("long").alias("_k"))
    hot = cut_lineage(hot.filter("_k > 1"))
    return None if hot.isEmpty() else hot


def _may_crowd(sides: list[DataFrame], grid: Grid) -> bool:
    """Whether a cell can be crowded, from the lower left corners alone, which is one row per feature.

    One side alone stands for a table that is joined with itself.

    A feature covers two by two cells at most, so a cell holds no more of them than four cells have corners.
    """
    corners = [df.select("_home", "_w", _cell_of(F.col("minx"), F.col("_w")).alias("_ix"), _cell_of(F.col("miny"), F.col("_w")).alias("_iy"), F.lit(i).alias("side")) for i, df in enumerate(sides)]
    n = [F.sum((F.col("side") == i).cast("long")) for i in (0, len(sides) - 1)]
    counted = reduce(DataFrame.unionAll, corners).groupBy(*PLACE).agg(n[0].alias("n0"), n[1].alias("n1"))
    most = counted.groupBy("_home", "_w").agg((F.max("n0").cast("double") * F.max("n1")).alias("pairs"))
    found = most.agg(F.max("pairs")).first()[0]
    return found is not None and 16 * found > grid.crowded_pairs


def _part(value: Column, index: Column, size: Column | float) -> Column:
    """Part of a divided cell that a coordinate falls in, held inside the cell."""
    step = F.floor((value - index * _width(size)) * F.col("_k") / _width(size)).cast("long")
    return F.least(F.greatest(step, F.lit(0)), F.col("_k") - 1)


def _divide(df: DataFrame, hot: DataFrame | None, prefix: str) -> DataFrame:
    if hot is None:
        return df.withColumns({"_k": F.lit(1), "_sx": F.lit(0), "_sy": F.lit(0)})
    minx, miny, maxx, maxy = (F.col(prefix + c) for c in ENVELOPE)
    ix, iy, w = F.col("_ix"), F.col("_iy"), F.col("_w")
    marked = df.join(hot, PLACE, "left").withColumn("_k", F.coalesce("_k", F.lit(1)).cast("long"))
    along_x = marked.withColumn("_sx", F.explode(F.sequence(_part(minx, ix, w), _part(maxx, ix, w))))
    return along_x.withColumn("_sy", F.explode(F.sequence(_part(miny, iy, w), _part(maxy, iy, w))))


def cell_extents(df: DataFrame, size: float) -> DataFrame:
    """Cells that the features' envelopes cover and how wide the features are; geometry is not touched."""
    cells = covered_cells(df.select(*ENVELOPE), size)
    # Of a wide feature, no more than the cell counts; else a few of them would keep a crowded cell whole.
    return cells.select("_ix", "_iy", F.least(_extent(), F.lit(float(size))).alias("extent"))


def in_cells(sides: dict[str, DataFrame], grid: Grid) -> tuple[list[DataFrame], DataFrame | None]:
    """Two sides with prefixed columns, listed under the cells where they can meet, crowded cells divided.

    Reads the envelopes of both sides up to three times, so the sides should be tables rather than long plans. Of a table
    that is joined with itself, one side tells the levels, and where these are one, the crowd.
    """
    left, right = sides.values()
    same = left.sameSemantics(right)
    levels = _levels(list(sides.values()), grid.size, same)
    placed = [_on_levels(df, i, levels, grid.size) for i, df in enumerate(sides.values())]
    hot = None
    if _may_crowd(placed[:1] if same and len(levels[0]) == 1 else placed, grid):
        extents = [
            covered_cells(df.select(*ENVELOPE, "_home", "_w"), F.col("_w")).select(*PLACE, F.least(_extent(), "_w").alias("extent"))
            for df in placed
        ]
        hot = crowded_cells(*extents, grid, PLACE)
    listed = []
    for prefix, df in zip(sides, placed):
        named = df.select(*(F.col(c).alias(c if c in PLACE else prefix + c) for c in df.columns))
        listed.append(_divide(covered_cells(named, F.col("_w"), prefix), hot, prefix))
    return listed, hot


def envelopes_meet() -> Column:
    return (
        (F.col("l_minx") <= F.col("r_maxx"))
        & (F.col("r_minx") <= F.col("l_maxx"))
        & (F.col("l_miny") <= F.col("r_maxy"))
        & (F.col("r_miny") <= F.col("l_maxy"))
    )


def spatial_pairs(
    left: DataFrame,
    right: DataFrame,
    test: str,
    grid: Grid,
    on: list[str] | None = None,
    condition: Column | None = None,
    key: str | None = None,
) -> DataFrame:
    """Pairs of features that pass an exact test, each pair once.

    Both sides have ``geom`` and the four envelope columns. The result holds all columns, as ``l_…`` and ``r_…``.
    ``on`` names further columns that must agree, NULLs included; ``condition`` is a cheap filter on the prefixed
    columns without geometry.

    Features meet without their geometry, which is joined to the candidates afterwards. Both sides are staged under
    a row number for that, unless ``key`` names a column that is unique in each of them, and they are tables already.
    """
    geo.register(left.sparkSession)
    same = left is right
    if key is None:
        key = "_row"
        left = cut_lineage(left.withColumn(key, F.monotonically_increasing_id()))
        right = left if same else cut_lineage(right.withColumn(key, F.monotonically_increasing_id()))
    (a, b), hot = in_cells({"l_": left.drop("geom"), "r_": right.drop("geom")}, grid)
    met = a.join(b, [*CELL]) if not on else _join_on(a, b, on)
    keep = envelopes_meet() & _here(hot)
    if condition is not None:
        keep = keep & condition
    met = met.filter(keep).drop(*CELL)
    for prefix, df in (("l_", left), ("r_", right)):
        met = met.join(df.select(F.col(key).alias(prefix + key), F.col("geom").alias(f"{prefix}geom")), prefix + key)
    met = met.filter(TESTS[test](F.col("l_geom"), F.col("r_geom")))
    return met.drop("l__row", "r__row")


def spatial_hits(
    left: DataFrame,
    right: DataFrame,
    test: str,
    grid: Grid,
    keys: list[str],
    on: list[str] | None = None,
    condition: Column | None = None,
    unproved: Column | None = None,
) -> DataFrame:
    """Distinct keys of the left features with at least one partner on the right, both as ``staged_shapes`` gives them.

    First a semi join on the cell, which reads rasters and no geometry. It goes on to the next feature at the first
    partner that the rasters prove, so that a place where very many features overlap costs no pairs. Of the features left
    then, the pairs that rasters leave undecided are joined with their geometry and tested. ``on`` names columns that must
    be equal, which a NULL never is. ``condition`` holds for all pairs, ``unproved`` for undecided ones only: what it asks
    for need not travel where rasters decide.
    """
    geo.register(left.sparkSession)
    names = list(dict.fromkeys(["_shape", *keys, *(on or []), *ENVELOPE]))
    # A rectangle is known by its envelope, so no raster of it travels.
    marks = ["box", "raster"]
    (a, b), hot = in_cells({"l_": left.select(*names, *marks), "r_": right.select(*names, *marks)}, grid)
    b = b.withColumnsRenamed({c: f"_r{c}" for c in CELL})
    together = envelopes_meet()
    for c in CELL:
        together = together & (F.col(c) == F.col(f"_r{c}"))
    for c in on or []:
        together = together & (F.col(f"l_{c}") == F.col(f"r_{c}"))
    if condition is not None:
        together = together & condition
    verdict = _verdict(test)
    mine = [F.col(f"l_{k}").alias(k) for k in keys]
    proved = a.join(b, together & (verdict == 1), "left_semi").select(*mine).distinct()

    # Two rectangles leave nothing undecided.
    odd = [not side.filter("not box").isEmpty() for side in ([left] if left is right else [left, right])]
    if not any(odd):
        return proved
    proved = cut_lineage(proved)
    mark = proved.withColumnsRenamed({k: f"_had_{k}" for k in keys})
    had = F.lit(True)
    for k in keys:
        had = had & F.col(f"l_{k}").eqNullSafe(F.col(f"_had_{k}"))
    # A pair that shares several cells counts in one of them.
    undecided = together & _here(hot) & (verdict == -1)
    if unproved is not None:
        undecided = undecided & unproved
    columns = ["l__shape", "r__shape", *(f"l_{k}" for k in keys if k != "_shape")]
    rest = a.join(mark, had, "left_anti")
    pairs = rest.filter("l_box").join(b.filter("not r_box"), undecided).select(*columns)
    if odd[0]:
        pairs = pairs.unionAll(rest.filter("not l_box").join(b, undecided).select(*columns))
    pairs = cut_lineage(pairs)
    if pairs.isEmpty():
        return proved
    tested = pairs.select("l__shape", "r__shape").distinct()
    for prefix, df in (("l_", left), ("r_", right)):
        shapes = df.select(F.col("_shape").alias(f"{prefix}_shape"), geo.whole().alias(f"{prefix}geom")).join(tested.select(f"{prefix}_shape").distinct(), f"{prefix}_shape", "left_semi")
        tested = tested.join(shapes.dropDuplicates([f"{prefix}_shape"]), f"{prefix}_shape")
    tested = tested.filter(TESTS[test](F.col("l_geom"), F.col("r_geom"))).select("l__shape", "r__shape")
    found = pairs.join(tested, ["l__shape", "r__shape"], "left_semi").select(*mine)
    return proved.unionByName(found).distinct()


def _verdict(test: str) -> Column:
    """``geo.decided`` of the two sides; of two rectangles, whose envelopes meet, their sides tell."""
    in_r = (F.col("r_minx") <= F.col("l_minx")) & (F.col("l_maxx") <= F.col("r_maxx"))
    in_r = in_r & (F.col("r_miny") <= F.col("l_miny")) & (F.col("l_maxy") <= F.col("r_maxy"))
    in_l = (F.col("l_minx") <= F.col("r_minx")) & (F.col("r_maxx") <= F.col("l_maxx"))
    in_l = in_l & (F.col("l_miny") <= F.col("r_miny")) & (F.col("r_maxy") <= F.col("l_maxy"))
    ground = (F.col("l_minx") < F.col("r_maxx")) & (F.col("r_minx") < F.col("l_maxx"))
    ground = ground & (F.col("l_miny") < F.col("r_maxy")) & (F.col("r_miny") < F.col("l_maxy"))
    sides = {"intersects": envelopes_meet(), "overlaps": ground & ~in_r & ~in_l}.get(test, in_r)
    rasters = (F.when(F.col(f"{p}box"), geo.box_raster(*(p + c for c in ENVELOPE))).otherwise(F.col(f"{p}raster")) for p in ("l_", "r_"))
    return F.when(F.col("l_box") & F.col("r_box"), sides.cast("int")).otherwise(geo.decided(test, *rasters))


def _here(hot: DataFrame | None) -> Column:
    """Whether the cell is the one with the lower left corner of the intersection of two envelopes."""
    corner_x, corner_y, w = F.greatest("l_minx", "r_minx"), F.greatest("l_miny", "r_miny"), F.col("_w")
    here = (_cell_of(corner_x, w) == F.col("_ix")) & (_cell_of(corner_y, w) == F.col("_iy"))
    if hot is not None:
        here = here & (_part(corner_x, F.col("_ix"), w) == F.col("_sx"))
        here = here & (_part(corner_y, F.col("_iy"), w) == F.col("_sy"))
    return here


def _join_on(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Equi-join on the cell and on further columns with NULL equal to NULL."""
    for c in on:
        a = a.withColumn(f"_on_{c}", F.struct(F.col("l_" + c)))
        b = b.withColumn(f"_on_{c}", F.struct(F.col("r_" + c)))
    keys = [f"_on_{c}" for c in on]
    return a.join(b, [*CELL, *keys]).drop(*keys)


def staged_shapes(shaped: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Distinct shapes as a table, with rasters, so that joins read envelopes and rasters alone.

    A rectangle is its envelope (``box``), so its geometry is neither shuffled nor written, and it has no raster.
    """
    geo.register(shaped.sparkSession)
    names = ["_shape", *(extra or [])]
    rows = shaped.select(*names, F.inline(geo.outline("geom")))
    counted = rows.groupBy(*names, *ENVELOPE, "geom").agg(F.count(F.lit(1)).alias("copies"))
    return cut_lineage(counted.select("*", F.col("geom").isNull().alias("box"), geo.raster("geom").alias("raster")))


def spatial_exists(left: DataFrame, right: DataFrame, test: str, grid: Grid, negate: bool = False) -> DataFrame:
    """Rows of the left side with (or without) a partner on the right.

    Copies of a shape count once on both sides. A row without geometry has no partner.
    """
    shaped = geo.with_shape(left)
    hits = settled(lambda: spatial_hits(*(staged_shapes(df) for df in (shaped, geo.with_shape(right))), test, grid, ["_shape"]))
    return shaped.join(hits, "_shape", "left_anti" if negate else "left_semi").select(*left.columns)


def spatial_left_join(left: DataFrame, right: DataFrame, test: str, grid: Grid, key: str) -> DataFrame:
    """All left rows with their partners' columns as ``r_…``; NULL where there is none."""
    partners = [c for c in right.columns if c not in ENVELOPE and c != "geom"]
    found = spatial_pairs(left.select(key, "geom", *ENVELOPE), right, test, grid)
    found = found.select(F.col(f"l_{key}").alias(key), *(f"r_{c}" for c in partners))
    return left.join(found, key, "left")


def tiles(df: DataFrame, size: float, margin: float = 0.0, bare: bool = False) -> DataFrame:
    """Features cut at the cell borders: one row per feature and cell, with the piece and its envelope.

    A wide feature then travels as many small pieces and not as one copy of itself per cell. With a margin, pieces
    reach a little beyond their cell. Bare pieces that are rectangles are their envelopes, without geometry.
    """
    geo.register(df.sparkSession)
    others = [c for c in df.columns if c not in ENVELOPE and c != "geom"]
    cut = df.select(*others, F.inline(geo.tile("geom", size, margin, bare)))
    return cut.withColumnsRenamed({"ix": "_ix", "iy": "_iy"})


def divided_tiles(df: DataFrame, hot: DataFrame | None, grid: Grid, margin: float = 0.0) -> DataFrame:
    """Cut the tiles of crowded cells once more, at the borders of their parts."""
    if hot is None:
        return df.withColumns({"_k": F.lit(1), "_sx": F.lit(0), "_sy": F.lit(0)})
    others = [c for c in df.columns if c not in ENVELOPE and c != "geom"]
    marked = df.join(hot, ["_ix", "_iy"], "left")
    whole = marked.filter("_k is null").withColumns({"_k": F.lit(1).cast("long"), "_sx": F.lit(0), "_sy": F.lit(0)})
    step = F.lit(float(grid.size)) / F.col("_k")
    cut = marked.filter("_k is not null").select(*others, "_k", F.inline(geo.tile(geo.whole(), step, margin)))
    parts = cut.select(
        *others,
        "_k",
        (F.col("ix") - F.col("_ix") * F.col("_k")).alias("_sx"),
        (F.col("iy") - F.col("_iy") * F.col("_k")).alias("_sy"),
        "geom",
        *ENVELOPE,
    )
    inside = F.col("_sx").between(0, F.col("_k") - 1) & F.col("_sy").between(0, F.col("_k") - 1)
    return whole.unionByName(parts.filter(inside))
