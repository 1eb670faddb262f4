"""The worked example: one box grant from its geometry to savings, in all three forms."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.factors import total_factors
from landcarbon.operators.allocation import allocate
from landcarbon.operators.grid import Grid
from landcarbon.plans import applications, finalise
from landcarbon.operators.categories import with_difference
from landcarbon.operators.overlay import overlay_report
from landcarbon.plans.publish import publish_report, publish_rollup
from landcarbon.plans.reporting import report_by_grant, report_by_year

REWETTED = "Rewetted Modified (Semi-natural) Bog"
MAPPING = [
    ("Eroding (ha)", "Eroding Modified Bog (bare peat)", REWETTED),
    ("Drained Modified Bog (ha)", "Modified (semi-natural Heather + Grass dominated)", REWETTED),
]
GRID = Grid(300.0)


def inputs(spark):
    geo.register(spark)
    work = spark.sql("select 'G1' as grant_id, lc_box(0D, 0D, 1000D, 1000D) as geom")
    baseline = spark.sql(
        """select 'Modified' lc_level2, 'Heather-dominated' lc_level3, 'Modified Bog' condition,
                  lc_box(0D, 0D, 500D, 1000D) geom
           union all
           select 'Eroding', 'Eroding', 'Eroded', lc_box(500D, 0D, 800D, 1000D)"""
    )
    conditions = ["Actively eroding", *["Modified"] * 4, "Forested / previously forested", None, None]
    points = spark.createDataFrame(
        [(c, 100.0 * i + 50) for i, c in enumerate(conditions)], "condition string, x double"
    ).select("condition", geo.point(F.col("x"), F.lit(300.0)).alias("geom"))
    grants = spark.createDataFrame([("G1", "Moor", 2026)], "grant_id string, project_name string, financial_year_end int")
    mapping = spark.createDataFrame(MAPPING, "category string, emission_factor_pre string, emission_factor_post string")
    return work, baseline, points, grants, mapping


def final_report(spark, integer=True):
    work, baseline, points, _, _ = inputs(spark)
    draft = overlay_report(work, baseline, GRID, as_double=True)
    enriched = with_difference(
        draft.withColumns({"forestry": F.lit(False), "financial_year_end": F.lit(2025)})
    )
    return finalise.finalise(enriched, points, GRID, date(2025, 12, 12), integer_shares=integer)


def test_final_report(spark):
    report = final_report(spark).cache()
    row = allocate(report).first()
    assert row.project_area == Decimal("1000000.00")
    assert (row.heather, row.eroded, row.conifer) == (500_000.0, 300_000.0, 0.0)
    assert row.difference == Decimal("-200000.00")
    assert (row.pct_eroding, row.pct_modified, row.pct_forested, row.pct_na) == (12, 50, 12, 0)
    assert (row.eroding_outside_map, row.modified_outside_map, row.forest_outside_map) == (24_000, 100_000, 24_000)
    assert (row.unspecified_to_modified, row.unspecified_to_eroding) == (44_200, 7_800)

    rollup = report_by_grant(report, inputs(spark)[4], total_factors(spark))
    m2 = rollup.m2.first()
    assert (m2.eroding, m2.drained_modified_bog, m2.project_area_class) == (76_800, 899_200, 976_000)
    ha = rollup.ha.first()
    assert (ha.eroding, ha.drained_modified_bog, ha.project_area_class) == (8, 90, 98)
    calcs = {r.emission_factor_pre: r for r in rollup.emissions.collect()}
    eroding, bog = calcs["Eroding Modified Bog (bare peat)"], calcs[MAPPING[1][1]]
    assert eroding.pre_emissions_break1 == Decimal("292.64") and eroding.post_emissions_break1 == Decimal("5.12")
    assert bog.pre_emissions_break1 == Decimal("524.70") and bog.diff_break1 == Decimal("467.10")
    total = rollup.savings.first()
    assert (total.pre_emission_break1, total.post_emission_break1) == (Decimal("817.34"), Decimal("62.72"))
    assert total.savings_break1 == Decimal("754.62")


def test_annual_legacy(spark):
    report = final_report(spark)
    rollup = report_by_year(report, inputs(spark)[4], total_factors(spark))
    ha = rollup.ha.first()
    assert ha.year == 2025
    # 255,000 square metres are 25.5 ha and round up.
    assert (ha.eroding, ha.drained_modified_bog, ha.project_area_class) == (8, 26, 98)
    total = rollup.savings.first()
    assert (total.pre_emission_break1, total.post_emission_break1) == (Decimal("444.22"), Decimal("21.76"))
    assert total.savings_break1 == Decimal("422.46")
    fixed = report_by_year(report, inputs(spark)[4], total_factors(spark), legacy_bog=False)
    assert fixed.savings.first().savings_break1 == Decimal("754.62")


def test_application(spark):
    work, baseline, points, grants, mapping = inputs(spark)
    report = applications.report(work, baseline, points, grants, GRID, date(2025, 12, 12)).cache()
    row = allocate(report).first()
    assert (row.heather, row.difference) == (Decimal("500000.00"), Decimal("-200000.00"))
    assert (row.pct_eroding, row.pct_modified, row.pct_forested) == (Decimal("12.5"), 50, Decimal("12.5"))
    assert (row.eroding_outside_map, row.forest_outside_map) == (25_000, 25_000)
    assert (row.unspecified_to_modified, row.unspecified_to_eroding) == (42_500, 7_500)
    assert row.forestry is False and row.financial_year_end == 2026
    rollup = report_by_grant(report, mapping, total_factors(spark))
    m2, ha = rollup.m2.first(), rollup.ha.first()
    assert (m2.eroding, m2.drained_modified_bog, m2.project_area_class) == (77_500, 897_500, 975_000)
    assert (ha.eroding, ha.drained_modified_bog, ha.project_area_class) == (8, 90, 98)
    assert rollup.savings.first().savings_break1 == Decimal("754.62")


@pytest.mark.parametrize("forestry", [True, False, None])
def test_classes_add_up_to_the_polygon(spark, forestry):
    report = final_report(spark).withColumn("forestry", F.lit(forestry).cast("boolean"))
    allocated = allocate(report)
    m2 = report_by_grant(report, inputs(spark)[4], total_factors(spark)).m2
    total = m2.first().project_area_class + allocated.first().forest_outside_map
    expected = 1_000_000 if forestry is not None else 1_000_000 - 52_000
    assert total == pytest.approx(expected)


def test_published_tables(spark, tmp_path):
    base, mapping, factors = str(tmp_path), inputs(spark)[4], total_factors(spark)
    with pytest.raises(LookupError):
        publish_rollup(spark, base, "final", mapping, factors, datetime(2025, 12, 12, 9))
    report = final_report(spark).withColumn("grant_id", F.lit("G1"))
    assert publish_report(report, base, "final", date(2025, 12, 12)) == "final_report_latest"
    total = publish_rollup(spark, base, "final", mapping, factors, datetime(2025, 12, 12, 9)).first()
    assert (total.grant_id, total.savings_break1) == ("G1", Decimal("754.62"))
    assert spark.table("final_ha_latest").first().drained_modified_bog == 90
    yearly = publish_rollup(
        spark, base, "final", mapping, factors, datetime(2025, 12, 12, 10), "financial_year_end", legacy_bog=True
    ).first()
    assert (yearly.financial_year_end, yearly.savings_break1) == (2025, Decimal("422.46"))
    assert spark.table("final_emissions_latest").count() == 2
