"""Dissolve: union of features per key, as single polygons.

A key of few features is put together at once. Others can hold any number of them, so their union is never built in one
task: features are first unioned per key and grid cell, with map-side merging. The resulting pieces that touch are linked
by a spatial join, connected components are found by joins, and only the pieces of one component, which end up in one
polygon anyway, are merged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.geo import ENVELOPE
from landcarbon.operators.grid import Grid, spatial_pairs
from landcarbon.session import cut_lineage, settled

# Features up to which a key is put together at once, without looking for those that touch.
FEW = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge, as (node, component); the component is its smallest node.

    Edges are (a, b). Alternating "large star" and "small star" steps (Kiveris et al., 2014) shorten long chains
    in few rounds, and every step is a grouped minimum plus a join, whatever the degree of a node.
    """
    links, mark = _written(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi != lo").distinct()
    )
    before = None
    while mark != before:  # each round shortens some chain, so it comes to rest
        before = mark
        links, mark = _written(_small_star(_large_star(links)))
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """Links as a table, with their number and digest, which are taken while they are written."""
    mark = Observation()
    digest = F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))
    return cut_lineage(links.observe(mark, F.count(F.lit(1)).alias("n"), digest.alias("digest"))), mark.get


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u").join(smallest, "u")
    return larger.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node itself, to the smallest of them."""
    smallest = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(smallest, "hi")
    to_neighbours = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    to_self = smallest.select("hi", F.col("m").alias("lo"))
    return to_neighbours.unionAll(to_self).filter("hi != lo").distinct()


def dissolve(df: DataFrame, keys: list[str], grid: Grid, distance: str | None = None) -> DataFrame:
    """Single polygons of the union of ``geom`` per key, as (keys, geom).

    With a column of distances, features are repaired and buffered first: those of keys of few features where they are put together,
    so that what is shuffled is the features as drawn, with a few vertices in place of some dozens.
    """
    geo.register(df.sparkSession)
    # Counting reads no geometry. A NULL in a key is a value like any other.
    same = [F.col(k).eqNullSafe(F.col(f"_many_{k}")) for k in keys]
    counted = cut_lineage(df.groupBy(*(F.col(k).alias(f"_many_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("n")))
    many = counted.filter(F.col("n") > FEW)
    if many.isEmpty():
        return _at_once(df, keys, distance)
    many = many.drop("n")
    if counted.filter(F.col("n") <= FEW).isEmpty():
        return _by_components(_widened(df, keys, distance), keys, grid)
    columns = [*keys, "geom", *([distance] if distance else [])]
    few, rest = (df.select(*columns).join(many, same, how) for how in ("left_anti", "left_semi"))
    return _at_once(few, keys, distance).unionByName(_by_components(_widened(rest, keys, distance), keys, grid))


def _widened(df: DataFrame, keys: list[str], distance: str | None) -> DataFrame:
    return df if distance is None else df.select(*keys, geo.buffer(geo.make_valid("geom"), F.col(distance)).alias("geom"))


def _at_once(df: DataFrame, keys: list[str], distance: str | None = None) -> DataFrame:
    """Features of keys that have few of them, merged per key."""
    if distance is not None:
        feature = F.struct(F.col("geom"), F.col(distance).cast("double"))
        listed = df.groupBy(*keys).agg(F.collect_list(feature).alias("_features"))
        return listed.select(*keys, F.explode(geo.widened_union("_features")).alias("geom"))
    merged = df.groupBy(*keys).agg(geo.union("geom").alias("geom"))
    return geo.explode_parts(merged.select(*keys, "geom"))


def _by_components(df: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Features of keys of any size, merged per cell and then per component of pieces that touch."""

    def labelled_pieces() -> DataFrame:
        pieces = cut_lineage(_pieces(df, keys, grid).withColumn("piece", F.monotonically_increasing_id()))
        # Pieces of one home cell are disjoint already.
        apart = F.lit(False)
        for l, r in zip(_home_cell(grid, "l_"), _home_cell(grid, "r_")):
            apart = apart | (l != r)
        condition = (F.col("l_piece") < F.col("r_piece")) & apart
        touching = spatial_pairs(pieces, pieces, "intersects", grid, on=keys, condition=condition, key="piece")
        edges = touching.select(F.col("l_piece").alias("a"), F.col("r_piece").alias("b"))
        components = connected_components(edges)
        return pieces.join(components.withColumnRenamed("node", "piece"), "piece", "left")

    labelled = settled(labelled_pieces)
    alone = labelled.filter("component is null").select(*keys, "geom")
    # Where a component is large, its cells are merged separately first.
    linked = labelled.filter("component is not null")
    near = linked.groupBy(*keys, "component", *_home_cell(grid)).agg(geo.union("geom").alias("geom"))
    merged = near.groupBy(*keys, "component").agg(geo.union("geom").alias("geom"))
    return alone.unionByName(geo.explode_parts(merged.select(*keys, "geom")))


def _pieces(df: DataFrame, keys: list[str], grid: Grid) -> DataFrame:
    """Union per key and home cell, as single polygons."""
    placed = geo.with_envelope(df.select(*keys, "geom"), drop_empty=True)
    unions = placed.groupBy(*keys, *_home_cell(grid)).agg(geo.union("geom").alias("geom"))
    return geo.with_envelope(geo.explode_parts(unions.select(*keys, "geom")))


def _home_cell(grid: Grid, prefix: str = "") -> list[Column]:
    """The cell of the lower left corner; that of a piece is the one of the features it is made of."""
    return [F.floor(F.col(prefix + c) / F.lit(float(grid.size))).alias(f"_home_{c}") for c in ENVELOPE[:2]]


def multi(df: DataFrame, keys: list[str]) -> DataFrame:
    """Disjoint polygons of a key put together as one multi-polygon; no overlay takes place.

    Meant for output in that form. Jobs here go on with single polygons, which spread over tasks.
    """
    geo.register(df.sparkSession)
    return df.groupBy(*keys).agg(geo.collect(F.collect_list("geom")).alias("geom"))


def union_layers(layers: list[DataFrame]) -> DataFrame:
    """Layers one below the other, duplicates included; a dissolve makes them harmless."""
    return reduce(DataFrame.unionByName, layers)
