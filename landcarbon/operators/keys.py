"""Filters and joins on keys, with the NULL rules of SQL kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eligible_grants(grants: DataFrame, after_fy: int) -> DataFrame:
    """Ids of grants that end after a financial year."""
    return grants.filter(F.col("financial_year_end") > after_fy).select(F.col("grant_id").cast("string"))


def not_track(technique: str = "restoration_technique") -> Column:
    """Technique that does not mention a track; a NULL technique does not pass."""
    return ~F.col(technique).ilike("%Track%")


def drop_slivers(df: DataFrame, min_area: float = 33, area: str = "project_area") -> DataFrame:
    """Drop features under a minimum area; an unknown area stays."""
    return df.filter(~F.coalesce(F.col(area) < min_area, F.lit(False)))


def key_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in the first column of ``keys``; used as an existence filter, so rows never multiply."""
    # Distinct first: the sides of an anti or semi join that AQE can split are only the left ones.
    return df.join(keys.select(F.col(keys.columns[0]).alias(column)).distinct(), column, "left_semi")


def not_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """SQL ``NOT IN``: nothing passes if the key list holds a NULL, and a NULL key passes only an empty list.

    Written as an anti join plus two facts about the list. Spark's own form copies the whole list to every
    executor whatever its size; this one can shuffle it.
    """
    listed = keys.select(F.col(keys.columns[0]).alias(column))
    # One row of facts, so that the list is read once for both.
    n, known_n = F.count(F.lit(1)), F.count(column)
    facts = listed.agg(F.struct((n == 0).alias("is_empty"), (n > known_n).alias("has_null"))).scalar()
    is_empty, has_null = facts["is_empty"], facts["has_null"]
    possible = df.filter(is_empty | (~has_null & F.col(column).isNotNull()))
    known = listed.filter(F.col(column).isNotNull()).distinct()
    return possible.join(known, column, "left_anti").select(*df.columns)


def composite_key(columns: list[str]) -> Column:
    """Key columns as one text, NULL counting as empty text."""
    pieces: list[Column] = []
    for c in columns:
        if pieces:
            pieces.append(F.lit("--"))
        pieces.append(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.concat(*pieces)


def composite_not_in(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose composite key does not occur in ``keys``."""
    marked = df.withColumn("_composite", composite_key(columns))
    listed = keys.select(composite_key(columns).alias("_composite")).distinct()
    return marked.join(listed, "_composite", "left_anti").select(*df.columns)


def append_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Append rows that may lack some columns; those become NULL."""
    return df.unionByName(other.select(*(c for c in other.columns if c in df.columns)), allowMissingColumns=True)


def append_missing(df: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Append the fallback rows whose composite key is not present yet."""
    return append_rows(df, composite_not_in(fallback, df, keys))


def prefer_sources(sources: list[DataFrame], key: str) -> DataFrame:
    """Distinct rows of the first source, and of each later one where no earlier source has the key.

    As ``not_in`` with the keys of all earlier sources, NULL rules included, but these keys are listed once for all sources,
    each with the first source that has it.
    """
    if len(sources) < 2:
        return union_distinct(sources)
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    first = union_all([s.select(key, "_source") for s in tagged[:-1]]).groupBy(key).agg(F.min("_source").alias("_first"))
    # One row of facts: the first source that has any row, and the first one with a NULL key.
    null_first = F.min(F.when(F.col(key).isNull(), F.col("_first")))
    facts = first.agg(F.struct(F.min("_first").alias("any"), null_first.alias("null"))).scalar()
    earlier = lambda found: F.coalesce(found < F.col("_source"), F.lit(False))
    later = union_all(tagged[1:])
    names = later.columns
    # A NULL key meets none here, as the facts tell all about it.
    listed = later.join(first.filter(F.col(key).isNotNull()), key, "left").select(*names, "_first")
    possible = ~earlier(facts["any"]) | (~earlier(facts["null"]) & F.col(key).isNotNull() & ~earlier(F.col("_first")))
    chosen = listed.filter(possible).drop("_source", "_first")
    return union_distinct([sources[0], chosen])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def enrich(df: DataFrame, attributes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add attribute columns by key. Of several matching rows the smallest is taken, so a run can be repeated."""
    row = F.min(F.struct(*columns)).alias("_row")
    one = attributes.groupBy(key).agg(row).select(key, *(F.col(f"_row.{c}").alias(c) for c in columns))
    return df.join(one, key, "left").select(*df.columns, *columns)


def lookup(df: DataFrame, right: DataFrame, key: Column, right_key: str, value: str, name: str) -> DataFrame:
    """Scalar lookup: the one value for a key, NULL if there is none, an error if there are several."""
    counted = right.groupBy(F.col(right_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_value")
    )
    several = F.raise_error(F.concat(F.lit(f"more than one {value} for "), F.col("_key").cast("string")))
    found = df.withColumn("_key", key).join(counted, "_key", "left")
    checked = F.when(F.col("_n") > 1, several).otherwise(F.col("_value"))
    return found.select(*(c for c in df.columns if c != name), checked.alias(name))


def max_per_key(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(column).alias(column))
