"""Clipped areas per land-cover category: label, sum and pivot to the wide report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.functions.categories import CATEGORIES, CATEGORY_COLUMNS

AREA = "decimal(20,2)"


def category_label(level2: str = "lc_level2", level3: str = "lc_level3", condition: str = "condition") -> Column:
    """Full category label; NULL as soon as one part is NULL."""
    return F.concat(F.col(level2), F.lit(" - "), F.col(level3), F.lit(" - "), F.col(condition))


def category_area(
    df: DataFrame, keys: list[str], category: str = "category", area: str = "area", as_double: bool = False
) -> DataFrame:
    """Area per feature and category, rounded to 2 decimal places."""
    total = F.expr(_rounded(f"sum({area})"))
    return df.groupBy(*keys, category).agg((total.cast("double") if as_double else total).alias("category_area"))


def pivot_categories(
    df: DataFrame,
    keys: list[str],
    category: str = "category",
    area: str = "area",
    as_double: bool = False,
) -> DataFrame:
    """One row per feature with one area column per category, 0 where the feature has none of it.

    The sum per category and the pivot are one aggregation, so that the areas are shuffled once, by feature. Each label is
    looked up once per row, and columns are told apart by its number.
    A NULL or unknown label adds to no column, but its feature keeps a row.
    """
    kind = "double" if as_double else AREA
    value = f"cast({area} as double)" if as_double else area
    code = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col(category)).cast("int")
    df = df.select(*keys, area, code.alias("_code"))
    columns = []
    for i, name in enumerate(CATEGORIES.values()):
        total = _rounded(f"sum(case when _code = {i + 1} then {value} end)")
        columns.append(F.expr(f"coalesce(cast({total} as {kind}), cast(0 as {kind}))").alias(name))
    return df.groupBy(*keys).agg(*columns)


def _rounded(total: str) -> str:
    # Through a fixed scale first: a binary double just below a half must round as its decimal text does.
    return f"cast(round(cast({total} as decimal(30,6)), 2) as {AREA})"


def with_difference(df: DataFrame, project_area: str = "project_area", name: str = "difference") -> DataFrame:
    """Mapped area minus project area, rounded to 2 decimal places; NULL counts as 0 everywhere."""
    mapped = " + ".join(f"coalesce({c}, 0)" for c in CATEGORY_COLUMNS)
    return df.withColumn(name, F.expr(_rounded(f"{mapped} - coalesce({project_area}, 0)")))
