"""What a pipeline published last, as one file: the tables of a run together, with schema and data files.

The file is written beside the old one and put in its place by an atomic rename, after all tables of the run are written.
So any session finds the newest whole run, a run that breaks off stays unseen, and tables of two runs never mix.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landcarbon.sources.snapshots import RUN_ID


class BrokenSnapshot(LookupError):
    """The files of a published table are not the ones that were published."""


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of the data files of one run of a table, from one listing."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return {}
    listed = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(path))
    return {name: size for name, size in listed if not name.startswith(("_", "."))}


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place, over an older one, in one step."""
    target, _ = _path(spark, path)
    folder, _, file = path.rpartition("/")
    draft, fs = _path(spark, f"{folder}/.{file}.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    # The rename of a file context replaces in one step; that of a file system would have to delete first.
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(draft, target, how)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, through Spark, which reads from any store; an error if it is not there."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        raise LookupError(f"nothing is published as {path}")
    return spark.read.text(path, wholetext=True).collect()[0].value


def file_names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def publish_manifest(spark: SparkSession, base: str, name: str, run: str, tables: list[str]) -> None:
    """Make one run of several tables, all of them written, the newest of ``name``."""
    listed = {}
    for table in tables:
        folder = f"{table}/{RUN_ID}={run}"
        files = _files(spark, f"{base}/{folder}")
        if not files:
            raise BrokenSnapshot(f"{folder} has no files")
        schema = spark.read.parquet(f"{base}/{folder}").schema
        listed[table] = {"folder": folder, "schema": schema.jsonValue(), "files": files}
    text = json.dumps({"run": run, "tables": listed})
    put_text(spark, f"{base}/{name}.manifest", text)


def read_manifest(spark: SparkSession, base: str, name: str) -> dict:
    path, fs = _path(spark, f"{base}/{name}.manifest")
    if not fs.exists(path):
        raise LookupError(f"{name} was never published under {base}")
    # As one row of text, through Spark, which reads from any store.
    rows = spark.read.text(f"{base}/{name}.manifest", wholetext=True).collect()
    return json.loads(rows[0].value)


def latest_tables(spark: SparkSession, base: str, name: str) -> dict[str, DataFrame]:
    """The tables of the newest published run, checked against their files."""
    out = {}
    for table, about in read_manifest(spark, base, name)["tables"].items():
        folder = f"{base}/{about['folder']}"
        if _files(spark, folder) != about["files"]:
            raise BrokenSnapshot(f"{folder} is not as it was published")
        out[table] = spark.read.schema(StructType.fromJson(about["schema"])).parquet(folder)
    return out


def open_latest(spark: SparkSession, base: str, name: str) -> list[str]:
    """Views ``<table>_latest`` on the newest published run, in whichever session asks."""
    tables = latest_tables(spark, base, name)
    for table, df in tables.items():
        df.createOrReplaceTempView(f"{table}_latest")
    return [f"{table}_latest" for table in tables]
