"""Reports for grant applications, from feature layers to the finished wide report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from landcarbon.functions import geo
from landcarbon.operators.attributes import enrich_application
from landcarbon.operators.categories import with_difference
from landcarbon.operators.footprint import build_footprint
from landcarbon.operators.grid import Grid
from landcarbon.operators.keys import eligible_grants
from landcarbon.operators.overlay import overlay_report
from landcarbon.plans.finalise import finalise, with_grid_ref
from landcarbon.session import cut_lineage

BUFFER = 30.0
AFTER_FY = 2025


def footprint(layers: dict[str, DataFrame], grants: DataFrame, grid: Grid, after_fy: int = AFTER_FY) -> DataFrame:
    """Footprint polygons of eligible grants at 30 m."""
    return build_footprint(layers, BUFFER, grid, eligible=eligible_grants(grants, after_fy))


def report(
    footprints: DataFrame, baseline: DataFrame, points: DataFrame, grants: DataFrame, grid: Grid, run_date: date
) -> DataFrame:
    """Finished wide report. A footprint that meets no map polygon is not in it."""
    geo.register(footprints.sparkSession)
    polygons = geo.explode_parts(footprints.select("grant_id", "geom"))
    work = polygons.withColumn("geom", geo.make_valid("geom"))
    work = cut_lineage(geo.drop_empty(work))
    draft = overlay_report(work, baseline, grid)
    enriched = enrich_application(with_grid_ref(draft), grants)
    return finalise(with_difference(enriched), points, grid, run_date, integer_shares=False)
