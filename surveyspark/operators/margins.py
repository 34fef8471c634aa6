"""Population margins from external counts, and the survey tables beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.labels import decode
from surveyspark.functions.nulls import ratio, row_sum, sum_or_zero, unite
from surveyspark.functions.reshape import longer, wider
from surveyspark.operators.demographics import collapse_origin
from surveyspark.operators.linkage import add_region
from surveyspark.operators.quality import share_of_total
from surveyspark.sources.profile import Profile

# The sex by age cells of the population table.
FEMALE_CHILD = ("female_0_4", "female_5_11", "female_12_17")
FEMALE_ADULT = ("female_18_59", "female_60")
MALE_CHILD = ("male_0_4", "male_5_11", "male_12_17")
MALE_ADULT = ("male_18_59", "male_60")
FEMALE = FEMALE_CHILD + FEMALE_ADULT
MALE = MALE_CHILD + MALE_ADULT
CELLS = FEMALE + MALE
ADULT_CELLS = FEMALE_ADULT + MALE_ADULT


def in_scope(dem: DataFrame, profile: Profile) -> DataFrame:
    """Counts of the survey year and country, empty rows left out."""
    return dem.filter(
        (F.col("year") == profile.year)
        & (F.col("asylum_iso3") == profile.host)
        & F.col("populationType").isin(*profile.population_types)
        & (F.col("totalEndYear") > 0))


def check_cells(dem: DataFrame) -> DataFrame:
    """Sums of the age cells and their difference to the published totals."""
    return dem.withColumns({
        "checkFemale": row_sum(FEMALE),
        "checkMale": row_sum(MALE),
        "checkTotalEndYear": row_sum(CELLS),
    }).withColumns({
        "checkFemaleDiff": F.col("checkFemale") - F.col("female"),
        "checkMaleDiff": F.col("checkMale") - F.col("male"),
        "checkTotalEndYearDiff": F.col("checkTotalEndYear") - F.col("totalEndYear"),
    })


def cells_by_origin(dem: DataFrame, profile: Profile, cells: tuple[str, ...] = CELLS) -> DataFrame:
    """Cells summed by origin with their total; an unknown origin is code 98."""
    code = F.when(F.col("origin") == profile.unknown_origin, "98").otherwise(
        F.col("origin_iso3").cast("string"))
    known = F.when(F.col("origin").isNotNull(), code)
    summed = dem.groupBy(known.alias("origin_iso3")).agg(
        *[sum_or_zero(c).alias(c) for c in cells])
    return summed.withColumn("totalEndYear", row_sum(cells))


def by_origin(dem: DataFrame, countries: DataFrame, profile: Profile) -> DataFrame:
    return add_region(cells_by_origin(dem, profile), countries, "origin_iso3")


def _with_shares(df: DataFrame, parts: dict[str, tuple[str, ...]]) -> DataFrame:
    df = df.withColumns({name: row_sum(cells) for name, cells in parts.items()})
    df = df.withColumn("n", row_sum(parts))
    return df.withColumns({f"perc{name}": ratio(name, "n") for name in parts})


def adult_counts(origins: DataFrame) -> DataFrame:
    """Adults by origin and sex, with the sex shares within the origin."""
    kept = origins.select("origin_iso3", "originHcrRegion", *ADULT_CELLS)
    return _with_shares(kept, {"Female": FEMALE_ADULT, "Male": MALE_ADULT})


def member_counts(origins: DataFrame) -> DataFrame:
    """Children and adults by origin and sex, with their shares."""
    kept = origins.select("origin_iso3", "originHcrRegion", *CELLS)
    return _with_shares(kept, {
        "Child_Female": FEMALE_CHILD, "Child_Male": MALE_CHILD,
        "Adult_Female": FEMALE_ADULT, "Adult_Male": MALE_ADULT,
    })


def _margin(counts: DataFrame, columns: list[str], part: str, key: str, profile: Profile) -> DataFrame:
    long = longer(counts, ["originHcrRegion", "origin_iso3"], columns, part, "value")
    collapsed = collapse_origin(long, profile, origin="origin_iso3")
    return collapsed.groupBy(unite("origin_ps", part).alias(key)).agg(F.sum("value").alias("Freq"))


def adult_margin(origins: DataFrame, profile: Profile) -> DataFrame:
    """Population of adults by collapsed origin and sex."""
    return _margin(adult_counts(origins), ["Female", "Male"], "R02", "originSex_ps", profile)


def member_margin(origins: DataFrame, profile: Profile) -> DataFrame:
    """Population by collapsed origin, age group and sex."""
    columns = ["Child_Female", "Child_Male", "Adult_Female", "Adult_Male"]
    return _margin(member_counts(origins), columns, "agesex", "originAgeSex_ps", profile)


def origin_shares(origins: DataFrame) -> DataFrame:
    """Population by origin with its share of the whole."""
    return share_of_total(origins.groupBy("origin_iso3").agg(F.sum("totalEndYear").alias("n")), "n")


def respondents_by_citizenship(hh: DataFrame, profile: Profile) -> DataFrame:
    """Survey respondents by citizenship, sex and broad age group, wide."""
    cells = ["Female_18-59", "Female_60+", "Male_18-59", "Male_60+"]
    foreign = decode(hh.filter(F.col("citizenship") != profile.host), ["R02", "R03cat2"])
    counted = foreign.groupBy("citizenship", unite("R02", "R03cat2").alias("ageSex")).agg(
        F.count(F.lit(1)).alias("n"))
    wide = wider(counted, ["citizenship"], "ageSex", cells, {"{}": F.first("n")})
    return wide.withColumn("total", row_sum([F.col(f"`{c}`") for c in cells]))


def respondents_by_origin_sex(hh: DataFrame, profile: Profile) -> DataFrame:
    """Survey respondents by origin and sex, with the shares within the origin."""
    counted = hh.filter(F.col("origin") != profile.host).groupBy("origin", "R02").agg(
        F.count(F.lit(1)).alias("n"))
    wide = wider(counted, ["origin"], "R02", ["Female", "Male"], {"{}": F.first("n")})
    return wide.withColumn("n", row_sum(["Female", "Male"])).withColumns({
        "percFemale": ratio("Female", "n"), "percMale": ratio("Male", "n")})
