"""The queries that are checked against SQL on the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.categories import CATEGORY_COLUMNS, CONDITION_COLUMNS
from landcarbon.functions.factors import TOTAL_FACTORS, total_factors
from landcarbon.functions.geo import ENVELOPE
from landcarbon.functions.text import clean_current_use, grid_reference, names_forestry_technique, text_or_notes
from landcarbon.operators import allocation, attributes, emissions, footprint, keys, overlap, overlay, points
from landcarbon.operators.categories import category_label as category_label_of
from landcarbon.operators.categories import pivot_categories
from landcarbon.operators.changes import track_changes
from landcarbon.operators.dissolve import dissolve, multi
from landcarbon.operators.grid import Grid, spatial_exists, spatial_pairs
from landcarbon.plans import applications, final_reports
from landcarbon.plans.publish import publish_report, publish_rollup
from landcarbon.plans.reporting import in_report_order, numbered, report_by_grant, report_by_year
from landcarbon.session import cut_lineage, shared_folder
from landcarbon.sources import tables
from landcarbon.sources.celled_map import open_celled_map, write_celled_map
from landcarbon.sources.keyed_snapshots import key_changes, keyed_runs, open_keyed, rows_to_redo, write_keyed
from landcarbon.sources.manifest import open_latest
from landcarbon.sources.snapshots import latest_snapshot, publish_latest, read_snapshot, run_ids, write_snapshot, write_table
from standins.inputs import (
    draft_report,
    item_boxes,
    labelled_areas,
    mapping,
    mixed_squares,
    order_boxes,
    orders,
    plain,
    plot_layers,
    plot_map,
    plot_points,
    plot_sources,
    plot_squares,
    plots,
    rectangle,
    shares_by_user,
    survey_points,
    table,
    tile_map,
    wide_report,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Boxes are up to 55 m wide.
GRID = Grid(120.0)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, folder: plain(fn(spark, folder))
    return fn


# --- areas, allocation, classes -------------------------------------------------------------------------------


@query
def category_area(spark, d):
    from landcarbon.operators.categories import category_area as op

    return op(labelled_areas(spark, d), ["fid"])


@query
def category_label(spark, d):
    labels = labelled_areas(spark, d).groupBy("lc_level2", "lc_level3", "condition", "category")
    return labels.agg(F.sum("area").alias("area"))


@query
def pivoted_categories(spark, d):
    return pivot_categories(labelled_areas(spark, d), ["fid", "grant_id"])


@query
def category_difference(spark, d):
    return draft_report(spark, d).select("fid", "project_area", "difference")


@query
def outside_map_split(spark, d):
    split = allocation.split_outside_map(wide_report(spark, d))
    return split.select("fid", "eroding_outside_map", "modified_outside_map", "forest_outside_map")


@query
def unspecified_allocation(spark, d):
    names = ["unspecified", "unspecified_to_forest", "unspecified_to_modified", "unspecified_to_eroding"]
    return allocation.allocate(wide_report(spark, d)).select("fid", *names)


@query
def report_classes(spark, d):
    return allocation.to_report_classes(allocation.allocate(wide_report(spark, d)), ["fid"])


@query
def report_classes_exact(spark, d):
    df = wide_report(spark, d, as_double=False)
    return allocation.to_report_classes(allocation.allocate(df), ["fid"])


@query
def report_classes_legacy(spark, d):
    # As after an append of unmapped features: without any mapped area the columns are NULL.
    df = wide_report(spark, d)
    unmapped = sum(F.col(c) for c in CATEGORY_COLUMNS) == 0
    df = df.withColumns({c: F.when(~unmapped, F.col(c)) for c in CATEGORY_COLUMNS})
    return allocation.to_report_classes(allocation.allocate(df), ["fid"], legacy_bog=True)


@query
def rollup_m2_by_grant(spark, d):
    return emissions.rollup_m2(allocation.allocate(wide_report(spark, d)), "grant_id")


def _by_grant(spark, d):
    return report_by_grant(wide_report(spark, d), mapping(spark), total_factors(spark))


def _by_year(spark, d):
    return report_by_year(wide_report(spark, d), mapping(spark), total_factors(spark))


@query
def rollup_ha_by_grant(spark, d):
    return _by_grant(spark, d).ha


@query
def rollup_ha_by_year(spark, d):
    return _by_year(spark, d).ha


@query
def unpivot_classes(spark, d):
    return emissions.unpivot_classes(_by_grant(spark, d).ha, "grant_id")


@query
def emission_calcs(spark, d):
    return _by_grant(spark, d).emissions


@query
def emission_calcs_by_year(spark, d):
    return _by_year(spark, d).emissions


@query
def savings_by_grant(spark, d):
    return _by_grant(spark, d).savings


@query
def report_order(spark, d):
    """The place of every grant in the printed report."""
    return numbered(_by_grant(spark, d).savings).select("grant_id", "position")


@query
def savings_by_year(spark, d):
    return _by_year(spark, d).savings


@query
def factor_fanout(spark, d):
    # The classes that occur in the data, and how often the factor table makes them count.
    areas = emissions.unpivot_classes(_by_grant(spark, d).ha, "grant_id").filter("area <> 0")
    used = areas.select("category").distinct()
    return emissions.factor_duplicates(mapping(spark).join(used, "category", "left_semi"), total_factors(spark))


@query
def condition_share_int(spark, d):
    return shares_by_user(spark, d)


@query
def condition_share_exact(spark, d):
    df = shares_by_user(spark, d, integer=False)
    return df.select("user_id", *(F.round(c, 6).alias(c) for c in CONDITION_COLUMNS))


@query
def sliver_filter(spark, d):
    # Fine areas, so that the threshold cuts: line items as features, areas in tenths; NULL areas stay.
    items = table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_quantity") != 50, F.col("l_quantity") * 10).alias("project_area")
    )
    kept = keys.drop_slivers(items, 133)
    return kept.groupBy("project_area").agg(F.count(F.lit(1)).alias("n"))


@query
def qc_totals(spark, d):
    return emissions.qc_totals(orders(spark, d))


# --- filters and joins on keys --------------------------------------------------------------------------------


@query
def eligible_grants(spark, d):
    grants = table(spark, d, "orders").select(
        F.col("o_custkey").alias("grant_id"), F.year("o_orderdate").alias("financial_year_end")
    )
    eligible = keys.eligible_grants(grants, 2000)
    return keys.key_in(orders(spark, d), "grant_id", eligible).select("fid", "grant_id")


def _techniques(spark, d):
    name = F.col("p_name")
    technique = F.when(F.col("p_type") != "SMALL", F.replace(name, F.lit("ring"), F.lit("Access TRACK")))
    technique = F.replace(F.replace(technique, F.lit("rod"), F.lit("tree felling")), F.lit("gear"), F.lit("Stump"))
    return table(spark, d, "part").select("p_partkey", technique.alias("restoration_technique"))


@query
def not_track_filter(spark, d):
    return _techniques(spark, d).filter(keys.not_track())


@query
def stem_match(spark, d):
    return _techniques(spark, d).filter(names_forestry_technique("restoration_technique"))


def _grants_with_status(spark, d, status):
    return orders(spark, d).filter(F.col("o_orderstatus") == status).select("grant_id", "o_orderpriority")


@query
def priority_sources(spark, d):
    return keys.prefer_sources([_grants_with_status(spark, d, s) for s in "FOP"], "grant_id")


@query
def null_aware_not_in(spark, d):
    # The second list holds a NULL, so nothing passes it; the third is empty, so everything does.
    df = orders(spark, d).select("fid", F.when(F.col("priority") != 1, F.col("grant_id")).alias("grant_id"))
    late = orders(spark, d).filter("financial_year_end >= 2001 and priority = 2")
    lists = {"known": late, "holds_null": df, "empty": df.filter("fid is null")}
    parts = [
        keys.not_in(df, "grant_id", k.select("grant_id")).select("fid", F.lit(name).alias("list"))
        for name, k in lists.items()
    ]
    return keys.union_all(parts)


def _site_rows(spark, d, flag):
    """Items that were accepted (A), or all the others (R)."""
    accepted = F.col("l_returnflag") == "A"
    rows = table(spark, d, "lineitem").filter(accepted if flag == "A" else ~accepted)
    site = F.when(F.col("l_suppkey") != 1, F.col("l_suppkey").cast("string"))
    return rows.select(F.col("l_partkey").alias("grant_id"), site.alias("site_id"), F.lit(flag).alias("source"))


@query
def composite_not_in(spark, d):
    return keys.composite_not_in(_site_rows(spark, d, "R"), _site_rows(spark, d, "A"), ["grant_id", "site_id"])


@query
def append_missing(spark, d):
    return keys.append_missing(_site_rows(spark, d, "A"), _site_rows(spark, d, "R"), ["grant_id", "site_id"])


@query
def enrich_by_key(spark, d):
    """Name and year of the smallest matching row per grant."""
    attrs = orders(spark, d).select("grant_id", "financial_year_end", F.col("o_orderpriority").alias("project_name"))
    grants = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("grant_id"), "c_mktsegment")
    return keys.enrich(grants, attrs, "grant_id", ["financial_year_end", "project_name"])


# --- attributes over joined ids -------------------------------------------------------------------------------


def _features(spark, d):
    """Orders as features, with the suppliers of their items as joined ids."""
    from landcarbon.functions.text import distinct_concat

    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("centroid"), "l_suppkey")
    return items.groupBy("centroid").agg(distinct_concat(F.col("l_suppkey").cast("string")).alias("grant_id"))


def _supplier_attrs(spark, d):
    name = F.when(F.col("s_nationkey") > 4, F.concat_ws("/", "s_name", "s_nationkey"))
    return table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("grant_id"), name.alias("name"))


@query
def enrich_by_id_list(spark, d):
    return attributes.enrich_by_id_list(_features(spark, d), _supplier_attrs(spark, d), "name", "project_name")


@query
def first_id_fallback(spark, d):
    known = _supplier_attrs(spark, d).withColumnRenamed("name", "project_name")
    first = F.split_part(F.col("grant_id"), F.lit(","), F.lit(1))
    return keys.lookup(_features(spark, d), known, first, "grant_id", "project_name", "project_name")


@query
def fy_range(spark, d):
    from landcarbon.functions.text import distinct_concat

    items = table(spark, d, "lineitem").select(F.col("l_partkey").alias("centroid"), "l_orderkey")
    features = items.groupBy("centroid").agg(distinct_concat(F.col("l_orderkey").cast("string")).alias("grant_id"))
    years = orders(spark, d).select(F.col("fid").cast("string").alias("grant_id"), "financial_year_end")
    return attributes.fy_range(features, years)


@query
def max_fy(spark, d):
    return keys.max_per_key(orders(spark, d).select("grant_id", "financial_year_end"), "grant_id", "financial_year_end")


@query
def technique_list(spark, d):
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_brand") == "Brand#1", "Other (please specify in Notes)")
        .otherwise(F.col("p_name"))
        .alias("technique"),
        F.col("p_type").alias("notes"),
    )
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("grant_id"), "l_partkey", "l_linenumber")
    rows = items.join(parts, "l_partkey")
    sources = [(rows.filter(F.col("l_linenumber") % 5 == i), "technique") for i in range(5)]
    return attributes.technique_list(sources)


@query
def clean_use_codes(spark, d):
    codes = F.array(*(F.lit(c) for c in ["5,4", "x 5,4", "1,3,4", "3,4,1 y", "4", "1,4", "1,2", "14", "5,4,1,4"]))
    use = F.get(codes, (F.col("fid") % 9).cast("int"))
    return orders(spark, d).select("fid", clean_current_use(use).alias("pa_current_use"))


def _attributes(spark, d):
    df = table(spark, d, "part")
    condition = F.when(F.col("p_size") > 10, F.element_at(F.split("p_name", " "), 1))
    condition = F.when(condition == "hot", "Yes").when(condition == "old", "Y").otherwise(condition)
    condition = F.when(F.col("p_name") == "red ring", "Old FOREST edge").otherwise(condition)
    techniques = F.when(F.col("p_brand") == "Brand#2", "dams, ditch blocking").when(
        F.col("p_brand") == "Brand#3", "tree felling"
    )
    return df.select(
        "p_partkey",
        condition.alias("pa_condition_category"),
        F.when(F.col("p_type") == "PROMO", "Forestry").otherwise(F.col("p_type")).alias("pa_current_use"),
        techniques.alias("techniques"),
    )


@query
def forestry_flag(spark, d):
    df = _attributes(spark, d).withColumn("forestry", attributes.flag_forestry_by_attributes())
    by_name = attributes.flag_forestry_by_name("pa_condition_category").alias("forestry_by_name")
    return df.select("p_partkey", "forestry", by_name)


@query
def fix_conditions(spark, d):
    df = _attributes(spark, d).withColumn("forestry", attributes.flag_forestry_by_attributes())
    return df.select("p_partkey", attributes.fix_conditions().alias("pa_condition_category"))


@query
def text_or_notes_clean(spark, d):
    df = table(spark, d, "part")
    lead = F.when(F.col("p_size") > 25, "OTHER: ").otherwise("")
    text = F.concat(lead, "p_name", F.lit(' (""'), "p_type", F.lit(";^"), "p_brand", F.lit("), ok!"))
    notes = F.when(F.col("p_size") != 30, F.col("p_type"))
    return df.select("p_partkey", text_or_notes(text, notes).alias("current_use"))


@query
def warnings(spark, d):
    df = _features(spark, d)
    ids = table(spark, d, "supplier").filter("s_acctbal > 2000").select(F.col("s_suppkey").cast("string"))
    return attributes.with_warning(df, ids)


@query
def changes_since_snapshot(spark, d):
    df = orders(spark, d).select(
        "fid",
        F.when(F.col("priority") != 5, F.col("grant_id")).alias("grant_id"),
        F.concat_ws("-", "grant_id", "o_orderpriority").alias("centroid"),
        "financial_year_end",
    )
    previous = df.filter("financial_year_end < 1997 and grant_id is not null")
    changed = track_changes(df.filter("financial_year_end >= 1997"), previous).drop("financial_year_end")
    return changed.withColumn("new_site", F.col("new_site").cast("string"))


@query
def newest_snapshot(spark, d):
    base = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    df = orders(spark, d).select("fid", "grant_id", "financial_year_end")
    write_snapshot(df.filter("financial_year_end < 2000"), base, "report", date(2024, 9, 4))
    write_snapshot(df.filter("financial_year_end >= 2000"), base, "report", date(2025, 12, 12))
    publish_latest(spark, base, "report")
    return latest_snapshot(spark, base, "report")


@query
def snapshot_runs(spark, d):
    """Rows of each run: one that is repeated, one by time of day, and a newest one without rows."""
    base = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    df = orders(spark, d).select("fid", "grant_id", "financial_year_end")
    write_snapshot(df, base, "report", date(2024, 9, 4))
    write_snapshot(df.filter("financial_year_end < 2000"), base, "report", date(2024, 9, 4))
    write_snapshot(df.filter("financial_year_end >= 2000"), base, "report", datetime(2025, 12, 12, 8, 30))
    write_snapshot(df.filter("financial_year_end < 0"), base, "report", date(2026, 1, 1))
    runs = [read_snapshot(spark, base, "report", r).withColumn("run", F.lit(r)) for r in run_ids(spark, base, "report")]
    newest = latest_snapshot(spark, base, "report").withColumn("run", F.lit("newest"))
    counted = reduce(DataFrame.unionByName, [*runs, newest]).groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.sum("fid").alias("fids"))
    known = spark.createDataFrame([(r,) for r in [*run_ids(spark, base, "report"), "newest"]], "run string")
    return known.join(counted, "run", "left")


@query
def recreated_table(spark, d):
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df = orders(spark, d).select("fid", "grant_id", "financial_year_end")
    write_table(df.filter("financial_year_end < 2000"), path)
    return write_table(df.filter("financial_year_end >= 2000"), path)


def _two_runs(spark, d):
    """The orders as two runs keyed by (customer, priority): the second without odd years, with other prices where 7 divides the id."""
    base = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}"
    df = table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("customer"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("price"),
    )
    late = df.filter("year % 2 = 0 or o_orderkey % 11 > 3")
    late = late.withColumn("price", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("price")))
    write_keyed(df.filter("year > 1992"), base, "orders", date(2024, 9, 4), ["customer", "priority"])
    write_keyed(late, base, "orders", date(2025, 9, 4), ["customer", "priority"])
    other = spark.newSession()
    return [open_keyed(other, base, "orders", run) for run in keyed_runs(other, base, "orders")]


@query
def changed_keys(spark, d):
    return key_changes(*_two_runs(spark, d))


@query
def rows_of_changed_keys(spark, d):
    return rows_to_redo(*_two_runs(spark, d))


# --- geometry -------------------------------------------------------------------------------------------------


@query
def grid_references(spark, d):
    x, y = F.col("o_custkey") * 397 + 1000, F.col("fid") * 83 + 2000
    digits = {f"ref_{n}": grid_reference(x, y, n) for n in (10, 6, 2)}
    return orders(spark, d).select("fid", *(v.alias(k) for k, v in digits.items()))


@query
def box_area(spark, d):
    return geo.with_area(item_boxes(spark, d)).groupBy("project_area").agg(F.count(F.lit(1)).alias("n"))


@query
def circle_radius(spark, d):
    radius = footprint.circle_radius(F.col("l_quantity"))
    df = table(spark, d, "lineitem").groupBy(F.round(radius, 6).alias("radius"))
    return df.agg(F.count(F.lit(1)).alias("n"))


@query
def point_buffer_area(spark, d):
    df = survey_points(spark, d)
    wide = footprint.buffered(df, ["condition"], 30.0)
    return wide.groupBy("condition", F.round(geo.area("geom"), 4).alias("area")).agg(F.count(F.lit(1)).alias("n"))


@query
def conditional_buffer(spark, d):
    df = order_boxes(spark, d).join(orders(spark, d).select("fid", "o_orderpriority"), "fid")
    technique = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "scrub removal")
        .when(F.col("o_orderpriority") == "2-HIGH", "Scrub removal")
        .when(F.col("o_orderpriority") != "5-LOW", "dams")
    )
    df = df.withColumn("restoration_technique", technique)
    wide = footprint.buffered(df, ["fid"], footprint.area_distance(30.0))
    return wide.select("fid", F.round(geo.area("geom"), 3).alias("area"))


@query
def geometry_types(spark, d):
    boxes = order_boxes(spark, d).select("geom")
    parted = multi(order_boxes(spark, d), ["grant_id"]).select("geom")
    return geo.type_counts(boxes.unionAll(parted).unionAll(survey_points(spark, d).select("geom")))


@query
def explode_parts(spark, d):
    parts = geo.explode_parts(multi(order_boxes(spark, d), ["grant_id"]))
    return parts.groupBy("grant_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(geo.area("geom")), 2).alias("area")
    )


@query
def box_clip_area(spark, d):
    """Clipped area per order box and category of the tile map."""
    from landcarbon.operators.categories import category_area as op

    return op(overlay.category_areas(order_boxes(spark, d), tile_map(spark, d), GRID), ["fid"])


@query
def stored_map_clip(spark, d):
    """Clipped area per order box and category, from a map that is stored in cells first and then opened."""
    from landcarbon.operators.categories import category_area as op

    path = f"{shared_folder(spark)}/map-{uuid.uuid4().hex}"
    write_celled_map(tile_map(spark, d), path, GRID)
    return op(overlay.category_areas(order_boxes(spark, d), open_celled_map(spark, path), GRID), ["fid"])


@query
def clipped_map(spark, d):
    """The clipped map as polygons of each order box and label, measured after they were put together over cells."""
    polygons = overlay.clip_overlay(order_boxes(spark, d), tile_map(spark, d), GRID)
    grouped = polygons.groupBy("fid", category_label_of().alias("category"))
    return grouped.agg(F.round(F.sum(geo.area("geom")), 2).alias("category_area"))


@query
def clip_report(spark, d):
    """The whole overlay job up to the wide draft, one row per distinct grant and box."""
    work = order_boxes(spark, d).select("grant_id", "geom")
    draft = overlay.overlay_report(work, tile_map(spark, d), GRID)
    boxed = geo.with_envelope(draft).drop("geom")
    return boxed.select("grant_id", *ENVELOPE, "project_area", *CATEGORY_COLUMNS)


@query
def unmapped_boxes(spark, d):
    """Order boxes that do not even touch a box of an item."""
    return spatial_exists(order_boxes(spark, d), item_boxes(spark, d), "intersects", GRID, negate=True).select("fid", "grant_id")


@query
def points_in_boxes(spark, d):
    boxes = order_boxes(spark, d).select("fid", "geom")
    shares = points.point_condition_share(boxes, survey_points(spark, d), GRID)
    return shares.select("fid", *CONDITION_COLUMNS)


@query
def intersecting_boxes(spark, d):
    """Number of other boxes that each order box meets, with the spatial join alone."""
    side = order_boxes(spark, d).select("fid", "geom", *ENVELOPE)
    met = spatial_pairs(side, side, "intersects", GRID, condition=F.col("l_fid") != F.col("r_fid"))
    return met.groupBy(F.col("l_fid").alias("fid")).agg(F.count(F.lit(1)).alias("n"))


@query
def mixed_widths(spark, d):
    """Number of others that each square meets, among small squares and some hundreds of cells wide."""
    side = mixed_squares(spark, d)
    met = spatial_pairs(side, side, "intersects", GRID, condition=F.col("l_id") != F.col("r_id"))
    return met.groupBy(F.col("l_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query
def covered_boxes(spark, d):
    return overlap.drop_covered(item_boxes(spark, d), GRID).select("l_orderkey", "l_linenumber", *ENVELOPE)


@query
def overlap_flag(spark, d):
    # As a double, since the flag can be NULL.
    return overlap.flag_overlap(order_boxes(spark, d), GRID).select("fid", F.col("overlap").cast("double"))


@query
def overlap_flag_any(spark, d):
    return overlap.flag_overlap(order_boxes(spark, d), GRID, group=None).select("fid", "overlap")


@query
def equal_boxes(spark, d):
    """Distinct squares that remain once equal ones are removed, and how many rows are left of each."""
    kept = overlap.drop_equal(item_boxes(spark, d), ["l_orderkey", "l_linenumber"])
    return kept.groupBy(*ENVELOPE).agg(F.count(F.lit(1)).alias("n"))


@query
def dissolve_boxes(spark, d):
    done = dissolve(order_boxes(spark, d), ["grant_id"], GRID)
    return done.groupBy("grant_id").agg(F.round(F.sum(geo.area("geom")), 2).alias("area"))


@query
def dissolve_by_year(spark, d):
    done = dissolve(order_boxes(spark, d), ["financial_year_end"], GRID)
    return done.groupBy("financial_year_end").agg(F.round(F.sum(geo.area("geom")), 2).alias("area"))


@query
def priority_subtract(spark, d):
    boxes = order_boxes(spark, d).select("grant_id", "financial_year_end", "geom")
    left = overlap.subtract_higher_priority(boxes, GRID)
    return left.groupBy("grant_id", "financial_year_end").agg(F.round(F.sum(geo.area("geom")), 2).alias("area"))


@query
def footprint_by_grant(spark, d):
    """Footprint of square areas without a buffer: forest-to-bog features and scrub removal."""
    geo.register(spark)
    boxes = order_boxes(spark, d).withColumn("site_id", F.col("financial_year_end").cast("string"))
    none = F.lit(None).cast("string")
    boxes = boxes.withColumns(
        {"restoration_technique": F.lit("scrub removal"), "techniques": none, "notes": none}
    )
    odd = F.col("fid") % 2 == 1
    layers = {"restoration_areas": boxes.filter(odd), "forest_to_bog": boxes.filter(~odd)}
    done = footprint.build_footprint(layers, 30.0, GRID, include=list(layers))
    return done.groupBy("grant_id", "site_id").agg(F.round(F.sum(geo.area("geom")), 2).alias("area"))


@query
def overlap_dissolve(spark, d):
    """Overlapping boxes of a year dissolved, with the grants found in each part; other boxes as they are."""
    flagged = cut_lineage(overlap.flag_overlap(order_boxes(spark, d), GRID))
    done = overlap.dissolve_overlapping(flagged, GRID)
    return done.select("grant_id", "financial_year_end", F.round(geo.area("geom"), 2).alias("area"))


@query
def resolved_overlaps(spark, d):
    """The three steps against overlaps in a row; checked by properties in the tests."""
    polygons = cut_lineage(order_boxes(spark, d).select("grant_id", "financial_year_end", "geom"))
    work = geo.with_area(overlap.resolve_overlaps(polygons, GRID))
    return work.groupBy("grant_id").agg(F.count(F.lit(1)).alias("n"), F.sum("project_area").alias("area"))


@query
def resolved_plots(spark, d):
    """The three steps against overlaps on rows of squares, where what is left of each is known."""
    polygons = cut_lineage(plot_squares(spark, d).select("grant_id", "financial_year_end", "geom"))
    work = geo.with_area(overlap.resolve_overlaps(polygons, GRID))
    return work.groupBy("grant_id").agg(F.count(F.lit(1)).alias("n"), F.sum("project_area").alias("area"))


# --- whole jobs -----------------------------------------------------------------------------------------------

RUN_DATE = date(2025, 12, 12)


def _application(spark, d):
    """Application report of all order boxes; a third of the grants are forest projects, some have no name."""
    name = F.when(F.col("grant_id") % 3 == 0, "Old Forest").when(F.col("grant_id") % 3 == 1, "Moor")
    grants = orders(spark, d).groupBy("grant_id").agg(F.min("financial_year_end").alias("financial_year_end"))
    grants = grants.withColumn("project_name", name)
    boxes = order_boxes(spark, d).select("grant_id", "geom")
    return applications.report(boxes, tile_map(spark, d), survey_points(spark, d), grants, GRID, RUN_DATE)


@query
def application_report(spark, d):
    df = geo.with_envelope(_application(spark, d)).drop("geom").withColumn("version", F.col("version").cast("string"))
    shares = {c: F.col(c).cast("double") for c in CONDITION_COLUMNS}
    return df.withColumns({c: F.col(c).cast("double") for c in CATEGORY_COLUMNS} | shares)


@query
def published_savings(spark, d):
    """The application report published as a snapshot, rolled up from there and published table by table."""
    base = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"
    publish_report(_application(spark, d), base, "applications", RUN_DATE)
    moment = datetime(2025, 12, 12, 8, 30)
    return publish_rollup(spark, base, "applications", mapping(spark), total_factors(spark), moment)


@query
def latest_rollup(spark, d):
    """The savings again, by another session, from the newest whole rollup that it finds published."""
    base = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"
    publish_report(_application(spark, d), base, "applications", RUN_DATE)
    publish_rollup(spark, base, "applications", mapping(spark), total_factors(spark), datetime(2025, 12, 12, 8, 30))
    other = spark.newSession()
    open_latest(other, base, "applications_rollup")
    return in_report_order(emissions.savings(other.table("applications_emissions_latest"), "grant_id"))


@query
def final_report(spark, d):
    """The final-report job from all its sources to change flags, on the plots."""
    # All sources are made of it, and most of them are read several times.
    ground = cut_lineage(plots(spark, d))
    footprints, layers, sources = plot_sources(spark, d, ground)
    previous = plot_squares(spark, d, ground).filter("name = 'a' and fid % 3 = 0").select("grant_id", F.lit("none").alias("centroid"))
    where = (plot_map(spark, d, ground), plot_points(spark, d, ground), GRID, RUN_DATE)
    df = final_reports.report(footprints, layers, sources, *where, previous)
    numbers = {c: F.col(c).cast("double") for c in [*CATEGORY_COLUMNS, *CONDITION_COLUMNS, "financial_year_end"]}
    # The point inside a circle is known to 100 m only.
    rough = F.concat(F.substring("centroid", 1, 5), F.substring("centroid", 8, 3))
    df = df.withColumn("centroid", F.when(F.col("grant_id").endswith("d"), rough).otherwise(F.col("centroid")))
    return df.withColumns(numbers | {c: F.col(c).cast("string") for c in ("version", "new_site")}).drop("geom")


def _layers_from_files(spark, d):
    """The layers as Parquet tables, read back by the readers of the library."""
    base = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    for name, df in plot_layers(spark, d).items():
        df.withColumn("extra", F.lit(1)).write.parquet(f"{base}/{name}")
    return {name: tables.read_layer(spark, f"{base}/{name}", name) for name in tables.LAYERS}


def _by_site(footprints):
    sums = footprints.groupBy("grant_id", "site_id").agg(F.count(F.lit(1)).alias("n"), F.sum(geo.area("geom")).alias("area"))
    return sums.withColumn("area", F.round("area", 2))


@query
def application_footprint(spark, d):
    """All five layers at 30 m, for grants of the later years."""
    grants = orders(spark, d).select(F.col("fid").alias("grant_id"), "financial_year_end")
    return _by_site(applications.footprint(_layers_from_files(spark, d), grants, GRID, after_fy=1998))


@query
def final_footprint(spark, d):
    """Four layers at 50 m, with older footprints: only those of sites without a new one are taken."""
    squares = plot_squares(spark, d).filter("name = 'a'").withColumn("grant_id", F.col("fid").cast("string"))
    new, old = squares.withColumn("site_id", F.lit("old")), squares.withColumn("site_id", F.col("status"))
    fallback = new.unionByName(old).select("grant_id", "site_id", "geom")
    return _by_site(final_reports.footprint(_layers_from_files(spark, d), GRID, final_reports.BUFFERS[0], fallback))


@query
def savings_from_files(spark, d):
    """Savings per grant with factors, units and mapping read from files; only classes with a unit are used."""
    base = f"{shared_folder(spark)}/factors-{uuid.uuid4().hex}"
    names = tables.FACTOR_SCHEMA.names
    rows = [[n, drained, *[""] * (len(names) - 5), a, b, ""] for n, drained, a, b in TOTAL_FACTORS]
    # The header starts with a byte-order mark.
    lines = ["\ufeff" + ",".join(names), *(",".join(row) for row in rows)]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{base}/factors")
    units = ["drainage_status,units", *(f"{n},t CO2e ha-1 yr-1" for n in names[-3:])]
    spark.createDataFrame([(line,) for line in units], "value string").coalesce(1).write.text(f"{base}/units")
    mapping(spark).withColumn("extra", F.lit(1)).write.parquet(f"{base}/mapping")
    factors = tables.read_factors(spark, f"{base}/factors")
    read = tables.read_mapping(spark, f"{base}/mapping")
    saved = report_by_grant(wide_report(spark, d), read, factors).savings
    unit = tables.read_units(spark, f"{base}/units").filter("factor_column = 'total_break1'").select("units")
    return saved.withColumn("unit", unit.scalar())


@query
def source_tables(spark, d):
    """Map, survey points and boundaries written with further columns and read back, counted by what they hold."""
    base = f"{shared_folder(spark)}/sources-{uuid.uuid4().hex}"
    tile_map(spark, d).write.parquet(f"{base}/map")
    survey_points(spark, d).withColumn("extra", F.lit(1)).write.parquet(f"{base}/points")
    boundaries = order_boxes(spark, d).select(F.col("fid").alias("grant_ref"), F.col("geom").alias("wkb_geometry"))
    cover = tables.read_baseline(spark, f"{base}/map")
    points_read = tables.read_points(spark, f"{base}/points")
    projects = tables.read_boundaries(boundaries, "grant_ref", "wkb_geometry")
    size = F.round(F.sum(geo.area("geom")), 2).alias("area")
    parts = [
        cover.groupBy(F.col("lc_level3").alias("what")).agg(F.count(F.lit(1)).alias("n"), size),
        points_read.groupBy(F.col("condition").alias("what")).agg(F.count(F.lit(1)).alias("n"), size),
        projects.groupBy(F.substring("grant_id", 1, 1).alias("what")).agg(F.count(F.lit(1)).alias("n"), size),
    ]
    named = [p.withColumn("source", F.lit(n)) for p, n in zip(parts, ("map", "points", "projects"))]
    return reduce(DataFrame.unionByName, named)


@query
def uses_and_conditions(spark, d):
    """Current uses of both sources per grant, and the conditions of the outline and the summary."""
    _, _, sources = plot_sources(spark, d)
    pairs = (("current_use", "current_use_of_site"), ("peatland_condition", "peat_condition_data"))
    found = [attributes.outline_and_summary(sources.outline, sources.summary, *p).toDF("grant_id", "value") for p in pairs]
    return found[0].withColumn("kind", F.lit("use")).unionByName(found[1].withColumn("kind", F.lit("condition")))


@query
def equal_shapes(spark, d):
    """Squares drawn as a whole, drawn in two halves, and slightly larger: the first two are equal."""
    df = plots(spark, d).withColumn("grant_id", F.col("fid").cast("string"))
    x, y, w, half = F.col("x"), F.col("y"), F.col("w"), F.expr("w div 2")
    drawn = lambda x0, x1, y1: rectangle(df, x0, y, x1, y1).select("grant_id", "geom")
    halves = drawn(x, x + half, y + w).unionByName(drawn(x + half, x + w, y + w))
    halves = halves.groupBy("grant_id").agg(geo.union("geom").alias("geom"))
    rows = drawn(x, x + w, y + w).unionByName(halves).unionByName(drawn(x, x + w, y + w + 1))
    left = overlap.drop_equal(cut_lineage(rows), ["grant_id"])
    return left.groupBy("grant_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(geo.area("geom")), 2).alias("area"))


@query
def repaired_rings(spark, d):
    """Areas of polygons with a ring that crosses itself, one that winds around its middle twice, and a valid one."""
    rings = {
        "bow": "0 0, 2 2, 2 0, 0 2, 0 0",
        "twice": "0 0, 3 0, 3 3, 1 3, 1 -1, 2 -1, 2 2, 0 2, 0 0",
        "valid": "0 0, 1 0, 1 1, 0 1, 0 0",
    }

    def drawn(ring: str):
        corners = [c.split() for c in ring.split(", ")]
        texts = [F.concat_ws(" ", F.col("x") + F.col("w") * int(a), F.col("y") + F.col("w") * int(b)) for a, b in corners]
        return geo.from_text(F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *texts), F.lit("))")))

    geo.register(spark)
    rows = F.array(*(F.struct(F.lit(k).alias("ring"), drawn(v).alias("geom")) for k, v in rings.items()))
    df = plots(spark, d).select("fid", F.inline(rows))
    done = footprint.buffer_dissolve(df, ["fid", "ring"], 0.0, GRID)
    return done.groupBy("fid", "ring").agg(F.round(F.sum(geo.area("geom")), 2).alias("area"))
