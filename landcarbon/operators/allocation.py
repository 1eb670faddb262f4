"""Where a site is not covered by the baseline map: split by survey points, allocate the rest, form report classes."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landcarbon.functions.categories import (
    CLASSES,
    OUTSIDE_GROUPS,
    PROJECT_AREA,
    REMAINDER_TO_ERODING,
    REMAINDER_TO_MODIFIED,
)

# Results at one fixed scale: left alone, Spark would give up decimal places as sums nest. Single terms are a little
# narrower, so that the sum of a class still fits without a cast after each step.
_EXACT = "decimal(28,8)"
_TERM = "decimal(24,8)"


def _typed(df: DataFrame, column: str):
    """Keep exact inputs exact at one fixed scale; leave doubles as they are."""
    exact = isinstance(df.schema[column].dataType, T.DecimalType)
    return (lambda value: value.cast(_EXACT)) if exact else (lambda value: value.cast("double"))


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def split_outside_map(df: DataFrame, difference: str = "difference") -> DataFrame:
    """Share of the unmapped area per group of survey-point conditions."""
    typed = _typed(df, difference)
    splits = {}
    for name, members in OUTSIDE_GROUPS.items():
        percent = " + ".join(f"coalesce({m}, 0)" for m in members)
        splits[name] = typed(F.expr(f"-{difference} * (({percent}) * 0.01)"))
    return df.withColumns(splits)


def unspecified(df: DataFrame, difference: str = "difference") -> DataFrame:
    """What the three splits leave of the unmapped area; needs the columns of ``split_outside_map``."""
    typed = _typed(df, difference)
    return df.withColumn(
        "unspecified", typed(-F.col(difference) - _total([F.col(name) for name in OUTSIDE_GROUPS]))
    )


def allocate_unspecified(
    df: DataFrame,
    to_modified: Decimal = REMAINDER_TO_MODIFIED,
    to_eroding: Decimal = REMAINDER_TO_ERODING,
    forestry: str = "forestry",
) -> DataFrame:
    """Give the remainder to forest on forestry sites, else to modified and eroding; unknown forestry gives 0."""
    typed = _typed(df, "unspecified")
    rest = F.col("unspecified")
    is_forestry = F.col(forestry)

    def given(condition: Column, value: Column) -> Column:
        return typed(F.when(condition, value).otherwise(F.lit(0)))

    return df.withColumns(
        {
            "unspecified_to_forest": given(is_forestry, rest),
            "unspecified_to_modified": given(~is_forestry, rest * F.lit(to_modified)),
            "unspecified_to_eroding": given(~is_forestry, rest * F.lit(to_eroding)),
        }
    )


def allocate(df: DataFrame) -> DataFrame:
    """The three steps in order."""
    return allocate_unspecified(unspecified(split_outside_map(df)))


def _weighted_sum(members: dict[str, Decimal], exact: bool) -> Column:
    kind = _TERM if exact else "double"
    terms = [f"cast(coalesce({_weighted(m, w)}, 0) as {kind})" for m, w in members.items()]
    return F.expr(f"cast({' + '.join(terms)} as {_EXACT if exact else 'double'})")


def _weighted(column: str, weight: Decimal) -> str:
    # A weight of one is left out, which keeps the scale of exact areas.
    return column if weight == 1 else f"{column} * {weight}"


def to_report_classes(df: DataFrame, keep: list[str], legacy_bog: bool = False) -> DataFrame:
    """Report classes per row of an allocated wide report in square metres, with their total as the project area.

    ``legacy_bog`` is the annual report's older form of Drained Modified Bog: only the weighted eroded area, the
    other members count just where that is NULL. The project area is the same in both forms.
    """
    exact = isinstance(df.schema["unspecified"].dataType, T.DecimalType)
    sums = df.select(*keep, "eroded", *(_weighted_sum(c.members, exact).alias(c.column) for c in CLASSES))
    total = _total([F.col(c.column) for c in CLASSES])
    total = total.cast(_EXACT) if exact else total
    columns = {c.column: F.col(c.column) for c in CLASSES}
    if legacy_bog:
        name = "drained_modified_bog"
        weight = next(c.members["eroded"] for c in CLASSES if c.column == name)
        # Where the eroded area is NULL it adds nothing to the full sum, which is then the sum of the others.
        columns[name] = F.coalesce(F.expr(_weighted("eroded", weight)).cast(_EXACT if exact else "double"), F.col(name))
    return sums.select(*keep, *(value.alias(name) for name, value in columns.items()), total.alias(PROJECT_AREA))
