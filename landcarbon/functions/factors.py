"""Emission factors per peat condition and their units."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_FACTOR = T.DecimalType(12, 4)

FACTOR_SCHEMA = T.StructType(
    [
        T.StructField("peat_condition", T.StringType()),
        T.StructField("drainage_status", T.StringType()),
        T.StructField("direct_co2", T.StringType()),
        T.StructField("direct_co2_1", _FACTOR),
        T.StructField("direct_co2_2", _FACTOR),
        T.StructField("co2_from_doc", _FACTOR),
        T.StructField("co2_from_poc", _FACTOR),
        T.StructField("direct_ch4", _FACTOR),
        T.StructField("ch4_from_ditches", _FACTOR),
        T.StructField("direct_n2o", _FACTOR),
        T.StructField("total_(up_down_se)", T.StringType()),
        T.StructField("total_break1", _FACTOR),
        T.StructField("total_break2", _FACTOR),
        T.StructField("total_up_down", _FACTOR),
    ]
)
# The key column is headed drainage_status in the file, although it holds the names of factor columns.
UNIT_SCHEMA = T.StructType(
    [T.StructField("drainage_status", T.StringType()), T.StructField("units", T.StringType())]
)

# Peat condition, drainage status, total factor (lower and upper break), t CO2e per ha and year.
TOTAL_FACTORS: list[tuple[str, str, str, str]] = [
    ("Forest", "Drained", "5.71", "0.84"),
    ("Cropland (peat > 40 cm)", "Drained", "37.17", "37.17"),
    ("Cropland (peat < 40 cm)", "Drained", "26.1", "26.1"),
    ("Eroding Modified Bog (bare peat)", "Drained", "18.86", "18.86"),
    ("Eroding Modified Bog (bare peat)", "Undrained", "17.72", "17.72"),
    ("Modified (semi-natural Heather + Grass dominated)", "Drained", "3.32", "3.32"),
    ("Modified (semi-natural Heather + Grass dominated)", "Undrained", "2.51", "2.51"),
    ("Extensive Grassland (combined bog/fen)", "Drained", "15.88", "15.88"),
    ("Intensive Grassland", "Drained", "22", "22"),
    ("Rewetted Bog", "Rewetted", "3.42", "3.42"),
    ("Rewetted Bog", "Rewetted", "3.31", "3.31"),
    ("Rewetted Modified (Semi-natural) Bog", "Rewetted", "0.32", "0.32"),
    ("Near Natural Bog", "Undrained", "0.32", "0.32"),
    ("Near Natural Fen", "Undrained", "-0.36", "-0.36"),
    ("Extracted Domestic", "Drained", "15.18", "15.18"),
    ("Extracted Industrial", "Drained", "18.86", "18.86"),
    ("Settlement", "Drained", "1.66", "1.66"),
]


def total_factors(spark: SparkSession) -> DataFrame:
    """The totals as a table, for use without the factor file."""
    names = ("peat_condition", "drainage_status", "total_break1", "total_break2")
    # From Arrow, so that Spark keeps the few rows in the plan and knows their size.
    rows = spark.createDataFrame(pa.table({n: [row[i] for row in TOTAL_FACTORS] for i, n in enumerate(names)}))
    return rows.select(*names[:2], *(rows[c].cast("decimal(12,4)").alias(c) for c in names[2:]))
