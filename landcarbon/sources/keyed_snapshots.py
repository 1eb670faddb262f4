"""Snapshots with digests per key, bucketed by key, so that two runs are compared without shuffling either.

A run is its rows, and one narrow row per key: number of rows and sums of two hashes of their content. The sums are taken on the
map side, so a key with very many rows comes to its bucket as few numbers. Every run of a snapshot has the same buckets, and a
comparison merges the digests of two runs bucket by bucket, without reading the rows.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landcarbon.sources.manifest import file_names, put_text, read_text
from landcarbon.sources.snapshots import run_id_of

BUCKETS = 64
KEY = "_key"
_MARK = ".keyed"


class KeyedRun(NamedTuple):
    """One run: its rows, its digests by key (a bucketed table), and the columns of the key."""

    rows: DataFrame
    digests: DataFrame
    keys: list[str]


def _as_text(columns: list[str]) -> Column:
    """Columns as one text that tells NULL from anything else."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """(_key, keys, n, a, b) per key; the order of rows and of columns does not matter."""
    content = _as_text(sorted(df.columns))
    hashed = df.select(_as_text(keys).alias(KEY), *keys, F.xxhash64(content).alias("a"), F.xxhash64(F.lit("b"), F.reverse(content)).alias("b"))
    sums = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in "ab"]
    return hashed.groupBy(KEY, *keys).agg(F.count(F.lit(1)).alias("n"), *sums)


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def write_keyed(df: DataFrame, base: str, name: str, moment: date | datetime, keys: list[str], buckets: int = BUCKETS) -> str:
    """Write one run, also one without rows; a repeat of the same run takes its place, other runs stay.

    The key may be NULL and may repeat. A run that breaks off stays unseen, since the file that names its folder is put in place
    last, by an atomic rename. Folders of replaced runs are kept, for readers that still use them.
    """
    clash = {c.lower() for c in keys} & {KEY, "n", "a", "b"}
    if clash:
        raise ValueError(f"key columns with a name in use: {sorted(clash)}")
    spark, run = df.sparkSession, run_id_of(moment)
    folder = f"{name}/{run}-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{folder}/rows")
    stored = spark.read.schema(df.schema).parquet(f"{base}/{folder}/rows")
    table = f"keyed_{uuid.uuid4().hex}"
    digests = _digests(stored, keys).repartition(buckets, KEY)
    writer = digests.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
    writer.option("path", f"{base}/{folder}/digests").saveAsTable(table)
    # Only the name goes: the table is declared over files that stay.
    spark.sql(f"DROP TABLE {table}")
    about = {"folder": folder, "keys": keys, "buckets": buckets, "rows": df.schema.jsonValue(), "digests": digests.schema.jsonValue()}
    put_text(spark, f"{base}/{name}/{run}{_MARK}", json.dumps(about))
    return run


def keyed_runs(spark: SparkSession, base: str, name: str) -> list[str]:
    """Ids of the finished runs, the newest last."""
    return sorted(f.removesuffix(_MARK) for f in file_names(spark, f"{base}/{name}") if f.endswith(_MARK) and not f.startswith("."))


def open_keyed(spark: SparkSession, base: str, name: str, run: str) -> KeyedRun:
    """A finished run, in whichever session asks."""
    about = json.loads(read_text(spark, f"{base}/{name}/{run}{_MARK}"))
    table = f"keyed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({_columns(StructType.fromJson(about['digests']))}) USING parquet CLUSTERED BY ({KEY}) "
        f"SORTED BY ({KEY}) INTO {about['buckets']} BUCKETS LOCATION '{base}/{about['folder']}/digests'"
    )
    rows = spark.read.schema(StructType.fromJson(about["rows"])).parquet(f"{base}/{about['folder']}/rows")
    return KeyedRun(rows, spark.table(table), about["keys"])


def key_changes(previous: KeyedRun, current: KeyedRun) -> DataFrame:
    """(keys, status, n_before, n_after) of every key of either run; status is new, gone, changed or same.

    A key has changed if its rows are not the same ones, each as often as before. Neither run is shuffled.
    """
    if previous.keys != current.keys:
        raise ValueError("the runs have different keys")
    sides = []
    for run, p in ((previous, "_before_"), (current, "_after_")):
        sides.append(run.digests.withColumnsRenamed({c: p + c for c in run.digests.columns if c != KEY}))
    both = sides[0].join(sides[1], KEY, "full")
    same = " and ".join(f"_before_{c} = _after_{c}" for c in ("n", "a", "b"))
    status = F.expr(f"case when _before_n is null then 'new' when _after_n is null then 'gone' when {same} then 'same' else 'changed' end")
    # A NULL key column is NULL on both sides.
    named = [F.coalesce(f"_after_{k}", f"_before_{k}").alias(k) for k in current.keys]
    counts = [F.coalesce(f"_{side}_n", F.lit(0).cast("long")).alias(f"n_{side}") for side in ("before", "after")]
    return both.select(*named, status.alias("status"), *counts)


def rows_to_redo(previous: KeyedRun, current: KeyedRun) -> DataFrame:
    """The rows of new and changed keys: what an incremental report has to compute again."""
    wanted = key_changes(previous, current).filter("status in ('new', 'changed')")
    names = current.keys
    marked = wanted.select(*(F.col(k).alias(f"_redo_{k}") for k in names))
    on = [F.col(k).eqNullSafe(F.col(f"_redo_{k}")) for k in names]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return current.rows.join(marked, condition, "left_semi")
