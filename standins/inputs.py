"""Report inputs derived from the general test tables, which hold no geometry and no report columns.

Grants are customers, features are orders, areas are line items. Each derivation is given for Spark here and as SQL
in ``oracle.py``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landcarbon.functions import geo
from landcarbon.functions.categories import CATEGORIES, CONDITION_COLUMNS, HECTARE_LABELS
from landcarbon.functions.geo import ENVELOPE
from landcarbon.operators.attributes import DRAINED_BY_TECHNIQUES
from landcarbon.operators.categories import category_label, pivot_categories, with_difference
from landcarbon.operators.points import condition_shares
from landcarbon.plans.final_reports import Sources

# A kind of event stands for the condition of a survey point; "error" stands for an unknown one.
CONDITION_OF_EVENT = {
    "click": "Actively eroding",
    "view": "Modified",
    "purchase": "Forested / previously forested",
    "signup": "Drained: Hagg/gully",
}

# Bytes of a stored table that one part of it has at most.
PART_BYTES = 4 << 20

# Columns of an order as a report feature.
FEATURE = ["fid", "grant_id", "financial_year_end", "project_area", "user_id", "forestry"]

# Invented factor mapping: the conditions before and after restoration per report class.
MAPPING = {
    "woodland": ("Forest", "Near Natural Bog"),
    "cropland": ("Cropland (peat > 40 cm)", "Rewetted Bog"),
    "eroding": ("Eroding Modified Bog (bare peat)", "Rewetted Modified (Semi-natural) Bog"),
    "drained_modified_bog": (
        "Modified (semi-natural Heather + Grass dominated)",
        "Rewetted Modified (Semi-natural) Bog",
    ),
    "intensive_grassland_class": ("Intensive Grassland", "Near Natural Fen"),
    "extensive_grassland_class": ("Extensive Grassland (combined bog/fen)", "Rewetted Bog"),
    "industrial_peat_extraction": ("Extracted Industrial", "Near Natural Bog"),
    "domestic_peat_extraction": ("Extracted Domestic", "Near Natural Bog"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a table that is stored in fewer pieces than there are cores.

    The test tables are one row group each, which a scan cannot split. Parts are of a bounded size, however large the
    table. A table of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(parts_of(df))


def parts_of(stored: DataFrame) -> int:
    """Parts of a bounded size that a stored table has, one per core at least."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(stored.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for a comparison that does not depend on decimal types.

    Doubles are rounded to the 6 decimal places that the exact results have at most.
    """

    def value(field: T.StructField) -> str:
        if isinstance(field.dataType, T.DecimalType):
            return f"cast({field.name} as double) as {field.name}"
        if isinstance(field.dataType, T.DoubleType):
            return f"round({field.name}, 6) as {field.name}"
        return field.name

    return df.selectExpr(*(value(f) for f in df.schema))


def mapping(spark: SparkSession) -> DataFrame:
    rows = [(HECTARE_LABELS[c], pre, post) for c, (pre, post) in MAPPING.items()]
    names = ("category", "emission_factor_pre", "emission_factor_post")
    return spark.createDataFrame(pa.table({n: [row[i] for row in rows] for i, n in enumerate(names)}))


def label_parts(index: str) -> list[Column]:
    """Three label columns for a category number; past the last category the second part is NULL."""
    parts = [label.split(" - ") for label in CATEGORIES]
    out = []
    for i, name in enumerate(("lc_level2", "lc_level3", "condition")):
        values = ", ".join(f"'{p[i]}'" for p in parts)
        other = "null" if name == "lc_level3" else "'Unknown'"
        out.append(F.expr(f"case when {index} < {len(parts)} then get(array({values}), {index}) else {other} end").alias(name))
    return out


def orders(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders")
    return df.select(
        F.col("o_orderkey").alias("fid"),
        F.col("o_custkey").cast("string").alias("grant_id"),
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.year("o_orderdate").alias("financial_year_end"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("project_area"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.expr("o_custkey div 10").alias("user_id"),
        F.expr("case o_orderstatus when 'F' then true when 'O' then false end").alias("forestry"),
    )


def clipped_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Areas of line items with their feature and three label parts.

    Items of one order and kind are added up before the join, where an order with very many items would be one task.
    Orders are then dealt into parts that follow the table of items: Spark's own are of so many bytes of these narrow rows that the
    wide sums made of them, which need no further shuffle, would take a task's memory.
    """
    parts = parts_of(spark.read.parquet(f"{folder}/lineitem.parquet"))
    items = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("fid"), "l_returnflag", "l_linestatus")
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("area"))
    )
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    status = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    features = orders(spark, folder).select(*FEATURE, "priority")
    joined = items.repartition(parts, "fid").join(features.repartition(parts, "fid"), "fid")
    numbered = joined.withColumn("idx", (flag * 10 + status * 5 + F.col("priority") - 1).cast("int"))
    return numbered.select(*FEATURE, "area", *label_parts("idx"))


def labelled_areas(spark: SparkSession, folder: str) -> DataFrame:
    return clipped_areas(spark, folder).withColumn("category", category_label())


def shares_by_user(spark: SparkSession, folder: str, integer: bool = True) -> DataFrame:
    kinds = F.create_map(*(F.lit(x) for pair in CONDITION_OF_EVENT.items() for x in pair))
    events = table(spark, folder, "events").select("user_id", kinds[F.col("event_type")].alias("condition"))
    return condition_shares(events, ["user_id"], integer=integer)


def draft_report(spark: SparkSession, folder: str, as_double: bool = False) -> DataFrame:
    """Wide report rows without shares: one per order with line items."""
    return with_difference(pivot_categories(labelled_areas(spark, folder), FEATURE, as_double=as_double))


def wide_report(spark: SparkSession, folder: str, as_double: bool = True) -> DataFrame:
    """Finished wide report rows, with survey-point shares and forestry flag.

    Areas are doubles as in final reports, or decimals as in applications.
    """
    shares = shares_by_user(spark, folder)
    joined = draft_report(spark, folder, as_double).join(shares, "user_id", "left")
    return joined.withColumns({c: F.expr(f"coalesce({c}, 0)") for c in CONDITION_COLUMNS}).drop("user_id")


def boxed(df: DataFrame, minx: Column, miny: Column, width: Column) -> DataFrame:
    """Add a square and its envelope columns."""
    geo.register(df.sparkSession)
    corners = (minx, miny, minx + width, miny + width)
    df = df.withColumns(dict(zip(ENVELOPE, (c.cast("double") for c in corners))))
    return df.withColumn("geom", geo.box(*(F.col(c) for c in ENVELOPE)))


def order_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One square per order, 5 to 54 m wide: (fid, grant_id, financial_year_end, geom, envelope)."""
    df = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("fid"),
        F.col("o_custkey").cast("string").alias("grant_id"),
        F.year("o_orderdate").alias("financial_year_end"),
        "o_custkey",
        F.floor(F.col("o_totalprice") / 10000).alias("w"),
    )
    boxes = boxed(df, F.col("o_custkey") * 13, F.col("fid") % 1000, F.col("w") + 5)
    return boxes.drop("o_custkey", "w")


def mixed_squares(spark: SparkSession, folder: str) -> DataFrame:
    """A square 5 m wide per order, and one of 30 km and more per nation: (id, geom, envelope)."""
    small = table(spark, folder, "orders").selectExpr(
        "concat('o', o_orderkey) as id", "o_custkey * 13 as x", "o_orderkey % 1000 as y", "5 as w"
    )
    wide = table(spark, folder, "nation").selectExpr(
        "concat('n', n_nationkey) as id", "n_nationkey * 7000 as x", "n_nationkey - 15000 as y", "30000 + n_regionkey * 5000 as w"
    )
    both = small.unionByName(wide)
    return boxed(both, F.col("x"), F.col("y"), F.col("w")).select("id", "geom", *ENVELOPE)


def item_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One square per distinct (part, supplier, quantity) and order, 1 to 50 m wide."""
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("w"), "l_returnflag"
    )
    df = df.distinct()
    return boxed(df, F.col("l_partkey") * 10, F.col("l_suppkey") * 10, F.col("w"))


def tile_map(spark: SparkSession, folder: str) -> DataFrame:
    """A land-cover map of disjoint 10 m squares, one per part and supplier that occur together."""
    df = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()
    df = df.withColumn("idx", ((F.col("l_partkey") + F.col("l_suppkey")) % 30).cast("int"))
    df = df.select("l_partkey", "l_suppkey", *label_parts("idx"))
    return boxed(df, F.col("l_partkey") * 10, F.col("l_suppkey") * 10, F.lit(10)).drop("l_partkey", "l_suppkey")


def survey_points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per event, on whole and half metres, so that some lie on borders."""
    geo.register(spark)
    kinds = F.create_map(*(F.lit(x) for pair in CONDITION_OF_EVENT.items() for x in pair))
    df = table(spark, folder, "events")
    x = F.col("user_id") * 130 + F.col("event_id") % 260 / 2
    y = F.col("event_id") * 7 % 1000
    return df.select(kinds[F.col("event_type")].alias("condition"), geo.point(x, y).alias("geom"))


def rectangle(df: DataFrame, minx: Column, miny: Column, maxx: Column, maxy: Column) -> DataFrame:
    geo.register(df.sparkSession)
    return df.withColumn("geom", geo.box(*(c.cast("double") for c in (minx, miny, maxx, maxy))))


def plots(spark: SparkSession, folder: str) -> DataFrame:
    """A plot of 250 m per order, apart from all others: (fid, status, priority, year, x, y, w)."""
    df = table(spark, folder, "orders")
    return df.select(
        F.col("o_orderkey").alias("fid"),
        F.col("o_orderstatus").alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.year("o_orderdate").alias("year"),
        (F.col("o_orderkey") % 1000 * 250).alias("x"),
        F.expr("o_orderkey div 1000 * 250").alias("y"),
        (F.floor(F.col("o_totalprice") / 10000).cast("long") * 2 + 6).alias("w"),
    )


def plot_squares(spark: SparkSession, folder: str, ground: DataFrame | None = None) -> DataFrame:
    """Squares of a plot in a row, of one grant each: ``a`` alone, ``a`` and a later ``c`` over its half, or ``a``, ``b``
    of the same year over its half, and a later ``c`` over half of ``b``. ``ground`` is the result of ``plots``, where it is shared."""
    square = lambda name, at, later: F.struct(F.lit(name).alias("name"), at.alias("at"), F.lit(later).alias("later"))
    none, half, whole = F.lit(0).cast("long"), F.expr("w div 2"), F.col("w")
    rows = (
        F.when(F.col("status") == "F", F.array(square("a", none, 0), square("b", half, 0), square("c", whole, 1)))
        .when(F.col("status") == "O", F.array(square("a", none, 0), square("c", half, 1)))
        .otherwise(F.array(square("a", none, 0)))
    )
    df = (plots(spark, folder) if ground is None else ground).withColumn("s", F.explode(rows))
    df = df.withColumns({"x": F.col("x") + F.col("s.at"), "grant_id": F.concat(F.col("fid").cast("string"), "s.name")})
    df = df.withColumn("financial_year_end", (F.col("year") + F.col("s.later")).cast("int"))
    df = rectangle(df, F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w"))
    return df.select("fid", "status", "priority", "year", F.col("s.name").alias("name"), "grant_id", "financial_year_end", "geom")


def plot_map(spark: SparkSession, folder: str, ground: DataFrame | None = None) -> DataFrame:
    """Two strips of land cover on four of five plots: the first half of square ``a``, and the rest of the row."""
    df = (plots(spark, folder) if ground is None else ground).filter("fid % 5 > 0")
    half, end = F.col("x") + F.expr("w div 2"), F.col("x") + F.col("w") * 2
    sides = (("fid % 30", F.col("x"), half), ("(fid + 7) % 30", half, end))
    strips = [
        rectangle(df.withColumn("idx", F.expr(f"cast({i} as int)")), a, F.col("y"), b, F.col("y") + F.col("w"))
        for i, a, b in sides
    ]
    return strips[0].unionByName(strips[1]).select(*label_parts("idx"), "geom")


def plot_points(spark: SparkSession, folder: str, ground: DataFrame | None = None) -> DataFrame:
    """Two survey points in square ``a`` of every other plot."""
    df = (plots(spark, folder) if ground is None else ground).filter("fid % 2 = 0")
    kinds = F.array(F.struct(F.lit("Modified"), F.lit(1)), F.struct(F.lit("Drained: Hagg/gully"), F.lit(2)))
    df = df.select("x", "y", F.inline(kinds).alias("condition", "at"))
    return df.select("condition", geo.point(F.col("x") + F.col("at"), F.col("y") + 1).alias("geom"))


def plot_sources(
    spark: SparkSession, folder: str, ground: DataFrame | None = None
) -> tuple[DataFrame, dict[str, DataFrame], Sources]:
    """Footprints, feature layers and attribute tables of the final report, on the plots.

    Squares come from the footprints, from sub-sites (``c``) or from projects (``a`` where it is alone); each of the
    less preferred sources also has shapes elsewhere that must not be taken.
    """
    ground = plots(spark, folder) if ground is None else ground
    squares = plot_squares(spark, folder, ground)
    alone = F.col("status") == "P"
    shape = ["grant_id", "geom"]
    elsewhere = lambda df: rectangle(df, F.lit(-900), F.lit(-900), F.lit(-800), F.lit(-800)).select(*shape)
    c, b = squares.filter("name = 'c'"), squares.filter("name = 'b'")
    footprints = squares.filter((F.col("name") != "c") & ~alone).select(*shape)
    subsites = c.select(*shape).unionByName(elsewhere(b))
    projects = squares.filter(alone).select(*shape).unionByName(elsewhere(c))
    years = squares.select("grant_id", "financial_year_end")
    reported = years.unionByName(years.withColumn("financial_year_end", F.col("financial_year_end") - 2))

    a = squares.filter("name = 'a'")
    lone = ground.filter("status = 'P'")
    d = lone.select(
        F.concat(F.col("fid").cast("string"), F.lit("d")).alias("grant_reference"),
        F.when(F.col("priority") <= 3, "Peat restoration").otherwise("feasibility").alias("project_type"),
        F.lit("Completed 2015").alias("project_status"),
        (F.col("fid") % 5 / 100).alias("ha_reported_total"),
        F.lit("grouse").alias("current_use_of_site"),
        F.lit("Yes").alias("peat_condition_data"),
        F.lit(None).cast("string").alias("restoration_activities"),
        geo.point(F.col("x") + 60, F.col("y") + 160).alias("geom"),
    )
    named = F.concat(F.substring_index("grant_reference", "d", 1), F.lit("a"))
    none = F.lit(None).cast("string")
    known = d.withColumns({"grant_reference": named, "current_use_of_site": none, "peat_condition_data": none})
    outline = a.select(
        "grant_id",
        F.when(F.col("fid") % 4 == 0, "5,4").otherwise("grazing").alias("current_use"),
        F.when(F.col("priority") == 1, "Yes").when(F.col("priority") == 2, "Old forest").alias("peatland_condition"),
        none.alias("notes"),
    )
    names = [a.filter("priority <> 5").withColumn("project_name", F.concat(F.lit("P"), "priority"))]
    names += [b.filter("fid % 2 = 0").withColumn("project_name", F.concat(F.lit("B"), "priority"))]
    grants = names[0].unionByName(names[1]).select("grant_id", "project_name")

    columns = {c: none for c in ("restoration_technique", "techniques", "technique", "notes")}
    no_rows = a.filter("false").withColumns(columns)
    layers = {n: no_rows for n in ("restoration_points", "restoration_areas", "forest_to_bog")}
    technique = F.when(F.col("fid") % 3 == 0, DRAINED_BY_TECHNIQUES[0]).when(F.col("fid") % 3 == 1, "tree felling")
    layers["restoration_lines"] = a.withColumns({**columns, "restoration_technique": technique}).filter("restoration_technique is not null")
    return footprints, layers, Sources(subsites, projects, reported, d.unionByName(known), outline, grants, no_rows)


def plot_layers(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five restoration layers on the plots, one grant per plot and one site per order status.

    Features of one kind overlap along a row, and the rows of a plot's layers are a kilometre apart.
    """
    df = plots(spark, folder).withColumns({"grant_id": F.col("fid").cast("string"), "site_id": F.col("status")})
    half, none = F.expr("w div 2"), F.lit(None).cast("string")

    def line(x0: Column, x1: Column) -> Column:
        return geo.from_text(F.format_string("LINESTRING (%d %d, %d %d)", x0, F.col("y"), x1, F.col("y")))

    def squares(km: int, *columns: Column) -> DataFrame:
        y = F.col("y") + km * 1000
        parts = [rectangle(df, F.col("x") + at, y, F.col("x") + at + F.col("w"), y + F.col("w")) for at in (F.lit(0), half)]
        return parts[0].unionByName(parts[1]).select("grant_id", "site_id", *columns, "geom")

    geo.register(spark)
    x, w = F.col("x"), F.col("w")
    # Tracks and lines of an unknown kind are left out, so they may lie anywhere.
    lines = F.array(
        F.struct(F.lit("dams").alias("restoration_technique"), line(x, x + w).alias("geom")),
        F.struct(F.lit("bunds").alias("restoration_technique"), line(x + half, x + w * 2).alias("geom")),
        F.struct(F.lit("Access track").alias("restoration_technique"), line(x, x + w * 9).alias("geom")),
        F.struct(none.alias("restoration_technique"), line(x, x + w * 8).alias("geom")),
    )
    # One point on the line, one apart, one without a place.
    places = F.array(geo.point(x + w, F.col("y")), geo.point(x, F.col("y") + 1000), F.lit(None).cast("binary"))
    technique = F.when(F.col("fid") % 3 == 0, "scrub removal").when(F.col("fid") % 3 == 1, "Scrub removal")
    return {
        "restoration_lines": df.select("grant_id", "site_id", none.alias("notes"), F.inline(lines)),
        "restoration_points": df.select(
            "grant_id", "site_id", none.alias("restoration_technique"), none.alias("notes"), F.explode(places).alias("geom")
        ),
        "restoration_areas": squares(2, technique.alias("restoration_technique"), none.alias("notes")),
        "bare_peat_stabilisation": squares(3),
        "forest_to_bog": squares(4, none.alias("techniques"), none.alias("notes")),
    }
