"""Keys, links and joins between household and member tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions.nulls import unite
from surveyspark.functions.reshape import only_in_right
from surveyspark.sources.stages import stage


#: parents with more rows than this are numbered band by band, over many tasks
CROWD = 10_000


def number_within(
    df: DataFrame, parent: str, order: Sequence[str], band: Column, name: str
) -> DataFrame:
    """Position of each row inside its parent, by ``order``.

    ``band`` is a coarse value that comes before ``order``. Rows are numbered in one
    window over the parent. The parents with more than ``CROWD`` rows are counted and
    listed first; their rows are numbered inside (parent, band), and the rows in earlier
    bands, counted with map-side combine, are added. A parent with very many rows is
    thus spread over as many tasks as it has bands. Rows without parent are left out, and
    so are rows without band, which take the first positions of their parent.
    """
    banded = df.withColumn("_band", band).filter(F.col(parent).isNotNull())
    has_band = F.col("_band").isNotNull()
    place = F.row_number().over(Window.partitionBy(parent).orderBy("_band", *order))
    crowds = stage(
        banded.groupBy(F.col(parent).alias("_crowd")).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > CROWD).select("_crowd"), "crowds")
    if crowds.isEmpty():
        return banded.withColumn(name, place.cast("int")).filter(has_band).drop("_band")
    of_crowd = F.col(parent) == F.col("_crowd")
    usual = banded.join(crowds, of_crowd, "left_anti").withColumn(name, place.cast("int")).filter(has_band)
    crowded = _number_by_bands(banded.join(crowds, of_crowd, "left_semi"), parent, order, name)
    return usual.unionByName(crowded).drop("_band")


def _number_by_bands(banded: DataFrame, parent: str, order: Sequence[str], name: str) -> DataFrame:
    sizes = banded.groupBy(parent, "_band").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(parent).orderBy("_band").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        parent, "_band", (F.sum("_size").over(before) - F.col("_size")).alias("_offset"))
    inside = Window.partitionBy(parent, "_band").orderBy(*order)
    return (
        banded.withColumn("_place", F.row_number().over(inside))
        .join(offsets, [parent, "_band"])
        .withColumn(name, (F.col("_place") + F.col("_offset")).cast("int"))
        .drop("_place", "_offset")
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> Column:
    """Join condition under which a missing key matches a missing key."""
    return reduce(
        lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in keys.items()]
    )


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all columns the two tables share, missing matching missing."""
    shared = [c for c in right.columns if c in left.columns]
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    on = null_safe(left, renamed, {c: f"_r_{c}" for c in shared})
    return left.join(renamed, on, "left").drop(*[f"_r_{c}" for c in shared])


def fan_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once on the right side of a join."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def checked_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails at run time when a right-hand key is not unique.

    A missing key matches a missing key. Columns keep their labels.
    """
    renamed = unique_on(right, keys).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = null_safe(left, renamed, {k: f"_r_{k}" for k in keys})
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows as they are; the job fails when two share a key (missing is a value)."""
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.filter(
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"repeated key: {', '.join(keys)}")).cast("boolean"))
        .otherwise(F.lit(True))).drop("_n")


def merge_rosters(
    part_a: DataFrame,
    part_b: DataFrame,
    keys: Mapping[str, str],
) -> DataFrame:
    """Left-join the second roster part, adding only columns the first lacks.

    ``keys`` maps columns of part A to columns of part B. Missing key parts
    match missing key parts, as they would in a pasted text key. A repeated key
    in part B fails the job, as its rows would multiply members.
    """
    new = only_in_right(part_a, part_b)
    b = unique_on(part_b, list(keys.values())).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys.values())], *new)
    on = reduce(
        lambda x, y: x & y,
        [part_a[k].eqNullSafe(b[f"_k{i}"]) for i, k in enumerate(keys)])
    return part_a.join(b, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def roster_key(parent: str, name: str, age: str) -> Column:
    """Text key of a member; holds a name, so it must not leave the stage."""
    return unite(parent, name, age)


def respondent_key(index: str, selected: str) -> Column:
    """Text key of the interviewed member."""
    return unite(index, selected)


def link_respondent(
    households: DataFrame, members: DataFrame, columns: Sequence[str],
    selected: str = "selected_adult", found: str = "_found",
) -> DataFrame:
    """Attributes of the selected member beside the household form.

    Joined on household and member number; a form without a selected member
    gets NULLs rather than every unselected member. ``found`` tells whether
    there was one.
    """
    right = members.select(
        F.col("_parent_index").alias("_hh"), F.col("member_no").alias("_no"), *columns)
    on = (F.col("_index") == F.col("_hh")) & (F.col(selected) == F.col("_no"))
    return (
        households.join(right, on, "left")
        .withColumn(found, F.col("_hh").isNotNull())
        .drop("_hh", "_no")
    )


def push_down(members: DataFrame, households: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Household-level columns on every member of the household."""
    right = households.select(F.col("_index").alias("_hh"), *columns)
    return members.join(right, F.col("_parent_index") == F.col("_hh"), "left").drop("_hh")


def add_region(df: DataFrame, countries: DataFrame, origin: str, unknown: str = "Unknown") -> DataFrame:
    """Region of a country code; codes without a region read ``Unknown``.

    The planner broadcasts the lookup if its bytes are below the session's threshold.
    """
    lookup = countries.select(
        F.col("iso3").cast("string").alias("_iso3"),
        F.col("hcr_region").cast("string").alias("_region"))
    return (
        df.join(lookup, F.col(origin) == F.col("_iso3"), "left")
        .withColumn("originHcrRegion", F.coalesce("_region", F.lit(unknown)))
        .drop("_iso3", "_region")
    )


def strip_identifiers(df: DataFrame, identifiers: Sequence[str], work: Sequence[str] = ()) -> DataFrame:
    """Drop identifying and working columns by name; assert none is left."""
    out = df.drop(*identifiers, *work)
    left = set(out.columns) & {*identifiers, *work}
    if left:
        raise ValueError(f"identifiers left in the table: {sorted(left)}")
    return out
