"""Publishing: finished reports and their rollups as snapshots, with a view on the newest of each."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from landcarbon.operators.allocation import allocate, to_report_classes
from landcarbon.operators.emissions import (
    emission_calcs,
    hectares_of,
    rollup_ha,
    rollup_m2,
    savings,
    unpivot_classes,
)
from landcarbon.plans.reporting import in_report_order
from landcarbon.sources.manifest import publish_manifest
from landcarbon.sources.snapshots import latest_snapshot, publish_latest, read_snapshot, run_id_of, write_snapshot

REPORT, ROLLUP = "report", "rollup"


def publish_report(report: DataFrame, base: str, pipeline: str, run_date: date) -> str:
    """Write a finished wide report under its date, publish it, and point the session's view at the newest one."""
    run = write_snapshot(report, base, f"{pipeline}_{REPORT}", run_date)
    publish_manifest(report.sparkSession, base, f"{pipeline}_{REPORT}", run, [f"{pipeline}_{REPORT}"])
    return publish_latest(report.sparkSession, base, f"{pipeline}_{REPORT}")


def publish_rollup(
    spark: SparkSession,
    base: str,
    pipeline: str,
    mapping: DataFrame,
    factors: DataFrame,
    moment: datetime,
    key: str = "grant_id",
    legacy_bog: bool = False,
) -> DataFrame:
    """Roll up the newest report of a pipeline, write each table under a timestamp, and return the savings.

    Each table is computed from the one written before it, so nothing is computed twice. When all are written, one
    manifest makes them the newest rollup for every session. An error if there is no report.
    """
    written = []
    report = allocate(latest_snapshot(spark, base, f"{pipeline}_{REPORT}"))

    def publish(df: DataFrame, table: str) -> DataFrame:
        name = f"{pipeline}_{table}"
        run = write_snapshot(df, base, name, moment)
        written.append(name)
        publish_latest(spark, base, name)
        return read_snapshot(spark, base, name, run)

    if legacy_bog:
        # The annual form keeps one row per report row, as the older classes are not summed before the hectares.
        m2 = publish(to_report_classes(report, [key], legacy_bog), "m2")
        ha = publish(rollup_ha(m2, key), "ha")
    else:
        m2 = publish(rollup_m2(report, key), "m2")
        ha = publish(hectares_of(m2, key), "ha")
    calcs = publish(emission_calcs(unpivot_classes(ha, key), mapping, factors, key), "emissions")
    publish_manifest(spark, base, f"{pipeline}_{ROLLUP}", run_id_of(moment), written)
    return in_report_order(savings(calcs, key), key)
