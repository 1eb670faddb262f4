"""From a finished wide report to emission savings; shared by all pipelines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landcarbon.operators.allocation import allocate, to_report_classes
from landcarbon.operators.emissions import (
    emission_calcs,
    hectares_of,
    rollup_ha,
    rollup_m2,
    savings,
    unpivot_classes,
)
from landcarbon.session import cut_lineage
from landcarbon.sources.tables import EMISSION_SCHEMA, conform


class Rollup(NamedTuple):
    """Square metres, hectares, emissions per factor pair, savings; all lazy and without an order."""

    m2: DataFrame
    ha: DataFrame
    emissions: DataFrame
    savings: DataFrame


def report_by_grant(report: DataFrame, mapping: DataFrame, factors: DataFrame, key: str = "grant_id") -> Rollup:
    """Rollup per grant, for applications and final reports."""
    m2 = rollup_m2(allocate(report), key)
    ha = hectares_of(m2, key)
    emissions = emission_calcs(unpivot_classes(ha, key), mapping, factors, key)
    return Rollup(m2, ha, emissions, savings(emissions, key))


def report_by_year(report: DataFrame, mapping: DataFrame, factors: DataFrame, legacy_bog: bool = True) -> Rollup:
    """Annual rollup: classes per report row, in the older form of Drained Modified Bog, then sums per year."""
    rows = to_report_classes(allocate(report), ["financial_year_end"], legacy_bog)
    m2 = rows.withColumnRenamed("financial_year_end", "year")
    ha = rollup_ha(m2, "year")
    emissions = conform(emission_calcs(unpivot_classes(ha, "year"), mapping, factors, "year"), EMISSION_SCHEMA)
    return Rollup(m2, ha, emissions, savings(emissions, "year"))


def in_report_order(df: DataFrame, key: str = "grant_id") -> DataFrame:
    """Order for output: by key, and by factor name where there is one."""
    return df.orderBy(*(c for c in (key, "emission_factor_pre") if c in df.columns))


def numbered(df: DataFrame, key: str = "grant_id") -> DataFrame:
    """The rows of a report with their ``position`` in its order, from 1.

    Sorted once, in ranges; a range then adds the number of rows before it.
    """
    ordered = cut_lineage(in_report_order(df, key).withColumn("_row", F.monotonically_increasing_id()))
    # The upper bits of such a number are those of the range.
    ranges = ordered.withColumn("_range", F.shiftright("_row", 33))
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranges.join(offsets, "_range").select(*df.columns, position.alias("position"))
