"""From report classes to hectares, emissions and savings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landcarbon.functions.categories import CLASS_COLUMNS, HECTARE_LABELS, PROJECT_AREA
from landcarbon.operators.allocation import to_report_classes

MEASURES = ["pre_emissions_break1", "pre_emissions_break2", "post_emissions_break1", "post_emissions_break2"]
DIFFERENCES = ["diff_break1", "diff_break2"]


def rollup_m2(df: DataFrame, key: str, legacy_bog: bool = False) -> DataFrame:
    """Report classes summed per key, in square metres, from an allocated wide report."""
    classes = to_report_classes(df, [key], legacy_bog)
    return classes.groupBy(key).agg(*(F.sum(c).alias(c) for c in [*CLASS_COLUMNS, PROJECT_AREA]))


def rollup_ha(df: DataFrame, key: str) -> DataFrame:
    """Square metres per row or key to whole hectares per key, halves away from zero."""
    return df.groupBy(key).agg(*(_hectares(f"sum({c})").alias(c) for c in [*CLASS_COLUMNS, PROJECT_AREA]))


def hectares_of(m2: DataFrame, key: str) -> DataFrame:
    """``rollup_ha`` for input that already has one row per key: no second aggregation."""
    return m2.select(key, *(_hectares(c).alias(c) for c in [*CLASS_COLUMNS, PROJECT_AREA]))


def _hectares(square_metres: str) -> Column:
    # Round first, then divide: a quotient cut to its type's scale could be lifted onto a half.
    nearest = f"cast(round(cast({square_metres} as decimal(30,6)), -4) as decimal(24,0))"
    return F.expr(f"cast({nearest} / 10000 as decimal(20,0))")


def unpivot_classes(ha: DataFrame, key: str) -> DataFrame:
    """One row per key and class, with the class named as in the factor mapping; the project area is left out.

    As a generator, which keeps rows partitioned by key: the sums per key that follow need no further shuffle.
    """
    pairs = ", ".join(f"'{label}', {column}" for column, label in HECTARE_LABELS.items())
    return ha.selectExpr(key, f"stack({len(HECTARE_LABELS)}, {pairs}) as (category, area)")


def factor_join(areas: DataFrame, mapping: DataFrame, factors: DataFrame) -> DataFrame:
    """Areas with every matching pair of factors and the emissions they give.

    A condition name can have several factor rows. Each of them takes part, so a category with n rows before and
    m rows after contributes n * m times; ``factor_duplicates`` lists such categories. Whether the lookup tables are
    broadcast is left to Spark, which knows their size when it runs.
    """
    pairs = mapping.select("category", "emission_factor_pre", "emission_factor_post")
    joined = areas.join(pairs, "category")
    for side in ("pre", "post"):
        values = factors.select(
            F.col("peat_condition").alias(f"emission_factor_{side}"),
            *(F.col(f"total_{b}").cast("decimal(12,4)").alias(f"{side}_{b}") for b in ("break1", "break2")),
        )
        joined = joined.join(values, f"emission_factor_{side}")
    return joined.withColumns({m: F.col("area") * F.col(m.replace("_emissions", "")) for m in MEASURES})


def factor_duplicates(mapping: DataFrame, factors: DataFrame) -> DataFrame:
    """Check: categories that count more than once, because a condition name has several factor rows."""
    once = mapping.select("category").distinct().withColumn("area", F.lit(1))
    return (
        factor_join(once, mapping, factors)
        .groupBy("category", "emission_factor_pre", "emission_factor_post")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def emission_calcs(areas: DataFrame, mapping: DataFrame, factors: DataFrame, key: str) -> DataFrame:
    """Emissions before and after per key and pair of factors, and their differences."""
    sums = (
        factor_join(areas, mapping, factors)
        .groupBy(key, "emission_factor_pre", "emission_factor_post")
        .agg(*(F.sum(m).alias(m) for m in MEASURES))
    )
    return sums.withColumns(
        {
            d: F.col(f"pre_emissions_{d[5:]}") - F.col(f"post_emissions_{d[5:]}")
            for d in DIFFERENCES
        }
    )


def savings(calcs: DataFrame, key: str) -> DataFrame:
    """Emissions and savings per key over all factor pairs."""
    names = {
        "pre_emissions_break1": "pre_emission_break1",
        "pre_emissions_break2": "pre_emission_break2",
        "post_emissions_break1": "post_emission_break1",
        "post_emissions_break2": "post_emission_break2",
        "diff_break1": "savings_break1",
        "diff_break2": "savings_break2",
    }
    return calcs.groupBy(key).agg(*(F.sum(c).alias(name) for c, name in names.items()))


def qc_totals(df: DataFrame, area: str = "project_area") -> DataFrame:
    """Total hectares, rounded to 2 decimal places, and number of rows."""
    total = (F.round(F.sum(area).cast("decimal(30,6)"), -2).cast("decimal(24,0)") / F.lit(10000)).cast("decimal(20,2)")
    return df.agg(total.alias("total_ha"), F.count(F.lit(1)).alias("n_rows"))
