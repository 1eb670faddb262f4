"""Versioned snapshots: Parquet folders partitioned by run id, and a view on the newest."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

RUN_ID = "run_id"


def run_id_of(moment: date | datetime) -> str:
    """Sortable id: the date, with the time for a rollup."""
    return moment.strftime("%Y%m%d_%H%M%S" if isinstance(moment, datetime) else "%Y%m%d")


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Drop and recreate a table, and read on from it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_snapshot(df: DataFrame, base: str, name: str, moment: date | datetime) -> str:
    """Write one run, also one without rows; a repeat of the same run replaces it, other runs stay."""
    run = run_id_of(moment)
    df.write.mode("overwrite").parquet(f"{base}/{name}/{RUN_ID}={run}")
    return run


def run_ids(spark: SparkSession, base: str, name: str) -> list[str]:
    """Ids of the finished runs of a snapshot, from its folder names: no data file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return []
    prefix = f"{RUN_ID}="
    folders = [status.getPath() for status in fs.listStatus(path) if status.getPath().getName().startswith(prefix)]
    # Spark leaves this mark when a write is complete.
    done = [f for f in folders if fs.exists(f.suffix("/_SUCCESS"))]
    return sorted(f.getName()[len(prefix) :] for f in done)


def read_snapshot(spark: SparkSession, base: str, name: str, run: str) -> DataFrame:
    """One chosen run, without its run id."""
    return spark.read.parquet(f"{base}/{name}/{RUN_ID}={run}")


def latest_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The newest run; an error if there is none."""
    runs = run_ids(spark, base, name)
    if not runs:
        raise LookupError(f"no snapshot of {name} under {base}")
    return read_snapshot(spark, base, name, runs[-1])


def publish_latest(spark: SparkSession, base: str, name: str) -> str:
    """Point the view ``<name>_latest`` at the newest run.

    Names start with their pipeline, so that one pipeline does not replace another's view.
    """
    view = f"{name}_latest"
    latest_snapshot(spark, base, name).createOrReplaceTempView(view)
    return view
