"""Geometry functions as Spark column expressions.

Geometry travels as WKB in a binary column, in planar metres. The functions run in the JVM over JTS, which ships
with Spark; the small jar next to this file only exposes it to SQL. ``register`` adds the jar to a session, Spark
sends it to the executors.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

JAR = Path(__file__).parent / "geo.jar"
ENVELOPE = ("minx", "miny", "maxx", "maxy")

_registered: set[str] = set()


def register(spark: SparkSession) -> None:
    """Make the geometry functions known to a session; does nothing the second time."""
    session = spark._jsparkSession.sessionUUID()
    if session in _registered:
        return
    spark.sql(f"ADD JAR '{JAR.as_posix()}'")
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    functions = loader.loadClass("landcarbon.Geo").newInstance()
    functions.accept(spark._jsparkSession)
    _registered.add(session)


def _fn(name: str, *args: Column | str) -> Column:
    return F.call_function(f"lc_{name}", *(F.col(a) if isinstance(a, str) else a for a in args))


def _real(value: Column | float) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("double")


def make_valid(geom: Column | str) -> Column:
    """Repaired polygons; ground that a ring winds around twice is left out, valid geometry stays as it is."""
    return _fn("make_valid", geom)


def buffer(geom: Column | str, distance: Column | float) -> Column:
    """Buffer with 8 segments per quarter circle."""
    return _fn("buffer", geom, _real(distance))


def widened_union(features: Column | str) -> Column:
    """The single parts of the union of features, an array of (geom, distance), each repaired and buffered first."""
    return _fn("widened_union", features)


def widened_any(geom: Column | str, distance: Column | float) -> Column:
    """Whether a feature has any ground once it is repaired and buffered."""
    return _fn("widened_any", geom, _real(distance))


def intersection(a: Column | str, b: Column | str) -> Column:
    return _fn("intersection", a, b)


def difference(a: Column | str, b: Column | str) -> Column:
    return _fn("difference", a, b)


def rest(a: Column | str, b: Column | str) -> Column:
    """What is left of the first geometry without the second; NULL where they have no point in common, or one is missing."""
    return _fn("rest", a, b)


def normalize(geom: Column | str) -> Column:
    """The same geometry with rings and vertices in a canonical order, so that equal shapes have equal bytes."""
    return _fn("normalize", geom)


def canonical(geom: Column | str) -> Column:
    """The one form that topologically equal polygons share, whatever their vertices on straight lines and their order."""
    return _fn("canonical", geom)


def straight(geom: Column | str, other: Column | str) -> Column:
    """Polygons without vertices on straight lines, but for those that the other geometry has at that place, too."""
    return _fn("straight", geom, other)


def parts(geom: Column | str) -> Column:
    """The non-empty single parts, as an array of geometries."""
    return _fn("parts", geom)


def area(geom: Column | str) -> Column:
    return _fn("area", geom)


def envelope(geom: Column | str) -> Column:
    """Array of one (minx, miny, maxx, maxy), or of none for an empty geometry."""
    return _fn("envelope", geom)


def outline(geom: Column | str) -> Column:
    """As ``envelope``, with the geometry before it, which is NULL for a rectangle."""
    return _fn("outline", geom)


def present(geom: Column | str) -> Column:
    """Array of the geometry, or of nothing if it is empty."""
    return _fn("present", geom)


def clip(a: Column | str, b: Column | str) -> Column:
    """Array of the intersection, or of nothing for disjoint geometries."""
    return _fn("clip", a, b)


def point_on_surface(geom: Column | str) -> Column:
    return _fn("point_on_surface", geom)


def xy(point: Column | str) -> Column:
    """Struct of x, y of a point; NULL for an empty one."""
    return _fn("xy", point)


def is_empty(geom: Column | str) -> Column:
    return _fn("is_empty", geom)


def geometry_type(geom: Column | str) -> Column:
    return _fn("type", geom)


def from_text(wkt: Column | str) -> Column:
    return _fn("from_text", wkt)


def as_text(geom: Column | str) -> Column:
    return _fn("as_text", geom)


def box(minx: Column | float, miny: Column | float, maxx: Column | float, maxy: Column | float) -> Column:
    return _fn("box", _real(minx), _real(miny), _real(maxx), _real(maxy))


def point(x: Column | float, y: Column | float) -> Column:
    return _fn("point", _real(x), _real(y))


def tile(geom: Column | str, size: Column | float, margin: float = 0.0, bare: bool = False) -> Column:
    """Array of (ix, iy, geom, envelope): the pieces of a geometry in the cells of a square grid.

    Bare pieces have no geometry where they are rectangles, see ``whole``.
    """
    return _fn("tile_bare" if bare else "tile", geom, _real(size), _real(margin))


def whole(prefix: str = "") -> Column:
    """The geometry, which is the envelope where there is none but an envelope."""
    return F.coalesce(F.col(f"{prefix}geom"), box(*(F.col(prefix + c) for c in ENVELOPE)))


def cover(geom: Column | str, size: Column | float, margin: float, top: Column | int) -> Column:
    """Array of (level, ix, iy, geom, envelope): cells of a quadtree, ``size`` times two to the level wide, up to ``top``.

    A cell wholly inside, with the margin around it, comes once, on the widest such level and without geometry; what is left
    comes as pieces in cells of level 0.
    """
    return _fn("cover", geom, _real(size), _real(margin), (top if isinstance(top, Column) else F.lit(top)).cast("int"))


def collect(polygons: Column | str) -> Column:
    """One multi-polygon from an array of disjoint polygons, without an overlay."""
    return _fn("collect", polygons)


def intersects(a: Column | str, b: Column | str) -> Column:
    return _fn("intersects", a, b)


def within(a: Column | str, b: Column | str) -> Column:
    return _fn("within", a, b)


def covered_by(a: Column | str, b: Column | str) -> Column:
    return _fn("covered_by", a, b)


def overlaps(a: Column | str, b: Column | str) -> Column:
    return _fn("overlaps", a, b)


def equals(a: Column | str, b: Column | str) -> Column:
    """Topological equality, whatever the vertices."""
    return _fn("equals", a, b)


def disjoint(a: Column | str, b: Column | str) -> Column:
    return ~intersects(a, b)


def raster(geom: Column | str) -> Column:
    """The cells of a polygon as bytes, for ``decided``; NULL for other geometry."""
    return _fn("raster", geom)


def decided(test: str, a: Column | str, b: Column | str) -> Column:
    """What two rasters tell of a test: 1 if it holds, 0 if not, -1 if only the geometry can tell."""
    return _fn(f"decide_{test}", a, b)


def boxed(raster: str) -> Column:
    """Whether a raster is that of a rectangle; two of these leave nothing undecided."""
    return F.coalesce(F.octet_length(raster) == 40, F.lit(False))


def box_raster(minx: Column | str, miny: Column | str, maxx: Column | str, maxy: Column | str) -> Column:
    """The raster of a rectangle, from its sides."""
    return _fn("box_raster", minx, miny, maxx, maxy)


def union(geom: Column | str) -> Column:
    """Aggregate: the union of a group, merged on the map side first."""
    return _fn("union", geom)


def with_envelope(df: DataFrame, geom: str = "geom", drop_empty: bool = False) -> DataFrame:
    """Add the four envelope columns, so that candidate filters run without touching the geometry.

    They come from a generator, like other costly values here. The optimizer moves filters below plain columns, which
    would evaluate the geometry function once more per filter.
    """
    register(df.sparkSession)
    generator = F.inline if drop_empty else F.inline_outer
    return df.select("*", generator(envelope(geom)))


def explode_parts(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per single polygon; rows without any part disappear."""
    register(df.sparkSession)
    others = [c for c in df.columns if c != geom]
    return df.select(*others, F.explode(parts(geom)).alias(geom))


def drop_empty(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Rows whose geometry is neither NULL nor empty."""
    register(df.sparkSession)
    others = [c for c in df.columns if c != geom]
    return df.select(*others, F.explode(present(geom)).alias(geom)).select(*df.columns)


def with_area(df: DataFrame, geom: str = "geom", name: str = "project_area") -> DataFrame:
    """Area rounded to 2 decimal places."""
    register(df.sparkSession)
    return df.withColumn(name, F.round(area(geom).cast("decimal(26,6)"), 2).cast("decimal(20,2)"))


def type_counts(df: DataFrame, geom: str = "geom") -> DataFrame:
    register(df.sparkSession)
    return df.groupBy(geometry_type(geom).alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))


def geometry_key(geom: Column | str = "geom") -> Column:
    """A key equal for equal shapes with equal vertices; stands in for comparing whole geometries."""
    return F.md5(normalize(geom))


def feature_id(keys: list[str], geom: str = "geom") -> Column:
    """A stable row id from the key columns and the geometry."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    return F.md5(F.concat_ws("\x1f", *texts, geometry_key(geom)))


def with_shape(df: DataFrame) -> DataFrame:
    """Add ``_shape``, a key that copies of a geometry share, so that they are handled once.

    Equal bytes are enough here: shapes that are equal but differ in their vertices are left to the geometry tests.
    """
    register(df.sparkSession)
    return df.select("*", F.explode(F.array(F.unhex(F.md5("geom")))).alias("_shape"))


def distinct_shapes(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per shape (and further columns) of a table with ``_shape``, with envelope and number of rows."""
    # The geometry as a key, not as a first value, which Spark could only find by sorting. Rows of a shape have equal bytes.
    names = ["_shape", *(extra or []), "geom"]
    grouped = df.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    return with_envelope(grouped.select(*names, "copies"), drop_empty=True)
