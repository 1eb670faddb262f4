"""The final-report job over all its sources, on hand-made boxes."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from landcarbon.functions import geo
from landcarbon.functions.categories import CATEGORIES, CONDITION_COLUMNS
from landcarbon.operators.attributes import WARNING
from landcarbon.operators.emissions import qc_totals
from landcarbon.operators.grid import Grid
from landcarbon.plans import final_reports

GRID = Grid(400.0)


def boxes(spark, rows, names):
    """Rows of values followed by x0, y0, x1, y1."""
    df = spark.createDataFrame(rows, f"{names}, x0 double, y0 double, x1 double, y1 double")
    return df.withColumn("geom", geo.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))).drop("x0", "y0", "x1", "y1")


def empty_layer(spark):
    columns = "grant_id string, site_id string, restoration_technique string, techniques string, notes string, geom binary"
    return spark.createDataFrame([], columns)


@pytest.fixture(scope="module")
def job(spark):
    geo.register(spark)
    footprints = boxes(spark, [
        ("A", "s", 0.0, 0.0, 100.0, 100.0),
        ("B", "s", 50.0, 0.0, 150.0, 100.0),        # overlaps A, same year: dissolved
        ("C", "s", 100.0, 50.0, 200.0, 150.0),      # overlaps B, earlier year: loses ground
        ("D", "s", 1000.0, 0.0, 1100.0, 100.0),     # alone
        ("E", "s", 3000.0, 0.0, 3100.0, 100.0),     # meets no map polygon
        ("F", "s", 1010.0, 10.0, 1020.0, 20.0),     # inside D: dropped
        ("T", "s", 4000.0, 0.0, 4005.0, 5.0),       # sliver
        ("X", "s", 6000.0, 0.0, 6100.0, 100.0),     # not reported
    ], "grant_id string, site_id string")
    subsites = boxes(spark, [("D", 7000.0, 0.0, 7100.0, 100.0), ("S", 1200.0, 0.0, 1300.0, 100.0)], "grant_id string")
    projects = boxes(spark, [("S", 7200.0, 0.0, 7300.0, 100.0), ("P", 1400.0, 0.0, 1500.0, 100.0)], "grant_id string")
    years = [("A", 2024), ("B", 2024), ("C", 2023), ("D", 2025), ("D", 2022), ("E", 2025), ("F", 2025), ("S", 2021),
             ("P", 2020), ("T", 2025)]
    reported = spark.createDataFrame(years, "grant_id string, financial_year_end int")
    summary = spark.createDataFrame(
        [("O", "Peat restoration", "Completed 2015", 3.14, "grazing", "Yes", "tree felling", 2000.0, 500.0),
         ("A", "restoration", "completed", 3.14, "game", None, None, 2400.0, 500.0),
         ("Q", "feasibility", "completed", 3.14, None, None, None, 9000.0, 500.0)],
        "grant_reference string, project_type string, project_status string, ha_reported_total double, "
        "current_use_of_site string, peat_condition_data string, restoration_activities string, x double, y double",
    ).withColumn("geom", geo.point(F.col("x"), F.col("y")))
    outline = spark.createDataFrame(
        [("A", "5,4", "Eroding; bare", None), ("B", "Other", "Drained", "deer")],
        "grant_id string, current_use string, peatland_condition string, notes string",
    )
    grants = spark.createDataFrame([("A", "Alpha"), ("B", "Beta"), ("D", "Delta")], "grant_id string, project_name string")
    lines = spark.createDataFrame(
        [("A", "s", "dams", "dams", None, None), ("A", "s", "Other (please specify in Notes)", "x", "by hand", None),
         ("D", "s", "dams, ditch blocking", "x", None, None)], empty_layer(spark).schema)
    layers = {name: empty_layer(spark) for name in ("restoration_points", "restoration_areas", "forest_to_bog")}
    layers["restoration_lines"] = lines
    details = spark.createDataFrame([("D", None, None)], "grant_id string, technique string, notes string")
    sources = final_reports.Sources(subsites, projects, reported, summary, outline, grants, details)

    def label(text):
        return tuple(text.split(" - "))

    heather = label("Modified - Heather-dominated - Modified Bog")
    baseline = boxes(spark, [
        (*heather, -50.0, -50.0, 120.0, 300.0), (*label("Scrub - Scrub - Forest"), 120.0, -50.0, 1050.0, 300.0),
        ("Eroding", None, "Eroded", 1050.0, -50.0, 2800.0, 900.0), (*heather, 6000.0, 0.0, 8000.0, 900.0),
    ], "lc_level2 string, lc_level3 string, condition string")
    points = spark.createDataFrame([("Modified", 1001.0 + i) for i in range(2)] + [("Drained", 1010.0)], "condition string, x double")
    points = points.select("condition", geo.point(F.col("x"), F.lit(50.0)).alias("geom"))
    previous = spark.createDataFrame([("D", "nowhere"), ("P", "x")], "grant_id string, centroid string")
    args = (footprints.select("grant_id", "geom"), layers, sources, baseline, points, GRID, date(2025, 12, 12))
    return final_reports.report(*args, previous).cache()


@pytest.fixture(scope="module")
def rows(job):
    return {r.grant_id: r for r in job.collect()}


def test_which_features_are_reported(rows):
    assert rows.keys() == {"A,B", "C", "D", "E", "S", "P", "O"}


def test_areas(rows):
    # A and B together 15,000; C keeps 10,000 less the 2,500 it shares with B.
    assert float(rows["A,B"].project_area) == 15_000 and float(rows["C"].project_area) == 7_500
    assert (rows["A,B"].heather, rows["A,B"].scrub) == (12_000, 3_000)
    assert (rows["C"].heather, rows["C"].scrub) == (1_000, 6_500)
    # Half of D lies on a map polygon without a full label, which is in no column.
    assert (rows["D"].scrub, rows["D"].difference) == (5_000, -5_000)
    assert rows["E"].heather is None and float(rows["E"].difference) == -10_000
    assert sum(rows["S"][c] for c in CATEGORIES.values()) == 0
    assert float(rows["O"].project_area) == pytest.approx(31_214.45, abs=0.01)


def test_attributes(rows):
    ab = rows["A,B"]
    assert ab.project_name == "Alpha,Beta" and ab.financial_year_end == 2024
    # Forestry comes from the code 5,4, and from felling at O.
    assert ab.pa_current_use == "Forestry,Other - deer,game" and ab.forestry is True
    assert ab.pa_condition_category == "Drained,Eroding bare"
    assert ab.techniques == "by hand, dams"
    assert rows["O"].forestry is True and rows["O"].pa_condition_category == "Not provided"
    assert rows["D"].pa_condition_category == "Drained" and rows["D"].forestry is False
    assert rows["P"].project_name is None and rows["P"].financial_year_end == 2020
    # The circle's grant is not in the reported years.
    assert rows["O"].financial_year_end is None
    assert {r.version for r in rows.values()} == {date(2025, 12, 12)}


def test_shares_and_warning(rows):
    assert (rows["D"].pct_modified, rows["D"].pct_drained) == (66, 33)
    assert all(rows["C"][c] == 0 for c in CONDITION_COLUMNS)
    # A is in the older list as well, but has a footprint.
    assert {k for k, r in rows.items() if r.warning == WARNING} == {"O"}


def test_change_flags(rows):
    assert {k for k, r in rows.items() if r.new_site is False} == {"D", "P"}
    assert {k for k, r in rows.items() if r.changed} == {"D", "P"}


def test_totals(job):
    row = qc_totals(job).first()
    assert row.n_rows == 7 and float(row.total_ha) == pytest.approx(9.37)
