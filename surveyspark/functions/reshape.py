"""Column selection, renaming, pivots and unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order, both included."""
    names = df.columns
    return names[names.index(first): names.index(last) + 1]


def any_of(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of the names the table has, in the order asked for."""
    have = set(df.columns)
    return [n for n in names if n in have]


def only_in_right(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of the right table the left one lacks."""
    have = set(left.columns)
    return [n for n in right.columns if n not in have]


def strip_from_names(df: DataFrame, text: str) -> DataFrame:
    return df.toDF(*[n.replace(text, "") for n in df.columns])


def wider(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    levels: Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """Long to wide with fixed levels.

    ``values`` maps a name pattern such as ``"n_{}"`` to an aggregate; the
    pattern is filled with the level. Levels are always given: letting Spark
    look for them costs a job and makes the schema depend on the data.
    """
    aggs = [agg.alias(f"v{i}") for i, agg in enumerate(values.values())]
    wide = df.groupBy(*keys).pivot(names_from, list(levels)).agg(*aggs)
    # pivoted columns come level by level, and by aggregate within the level
    return wide.toDF(*keys, *[pattern.format(level) for level in levels for pattern in values])


def longer(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], names_to: str, values_to: str
) -> DataFrame:
    """Wide to long; missing cells stay as rows."""
    return df.unpivot(list(keys), list(columns), names_to, values_to)


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Row-bind by name, missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
