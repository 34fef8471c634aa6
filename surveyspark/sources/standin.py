"""Survey-shaped views over the relational test tables.

The test tables hold orders and line items, not interviews. Here an order is
read as a household, a line item as a household member, and every answer is a
fixed function of the row key, so that any SQL engine can rebuild the same
rows. Nothing is stored: the views grow with the tables they read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.operators.linkage import number_within
from surveyspark.sources.profile import Profile
from surveyspark.sources.stages import stage

# What the stand-in population looks like.
PROFILE = Profile(
    host="NATION_8",
    kept_origins=("NATION_3", "NATION_12", "NATION_18", "NATION_21"),
    named_region="MIDDLE EAST",
    other_inside="OtherA",
    other_outside="OtherB",
)

#: a member's key is the household's times this plus the position
MEMBER_STRIDE = 1_000_000_000

# Answer codes per household question, in question order. The
# position gives the salt; an empty last entry stands for a missing answer.
HOUSEHOLD_ANSWERS = {
    "selected_adult": "1,1,2,2,3,",
    "UNEM01": "1,2,2,2",
    "UNEM02": "1,2,2",
    "UNEM03": "1,2,2",
    "UNEM04": "1,2,2",
    "UNEM05": "1,2,2",
    "UNEM06": "1,2,3,3",
    "UNEM07": "1,2,3",
    "UNEM08": "1,2,3,4",
    "UNEM09": "1,1,2,",
    "UNEM10": "1,1,2,",
    "BANK01": "1,2,2,98",
    "BANK02": "1,2",
    "BANK03": "1,2,",
    "BANK04": "1,2,2",
    "BANK05": "1,2,2",
    "HACC01": "1,2",
    "HACC03": "1,2,2,98",
    "COOK01": "1,1,1,2",
    "COOK03": "1,3,5,6,7,9,96,",
    "COOK04": "1,2,22,5,",
    "SAF01": "1,2,3,4,97,98,99",
    "DWA01": "1,5,7,9,12,14,17,98",
    "DWA02": "1,2,3,",
    "DWA03a": "5,20,40,1,98,",
    "DWA03b": "1,1,2,",
    "TOI01": "11,12,22,31,14,41,96",
    "TOI05": "1,2,2,",
    "LIGHT01": "1,1,1,2",
    "LIGHT03": "0,1,2,7,",
    "INC01": "1,2,3,98",
}

# Answer codes per member question; salts start at 101.
MEMBER_ANSWERS = {
    "DIS01": "1,1,1,1,2,3,4,98,99,",
    "DIS02": "1,1,1,1,1,2,3,99,",
    "DIS03": "1,1,1,1,1,1,2,98,",
    "DIS04": "1,1,1,1,1,1,1,3,99",
    "DIS05": "1,1,1,1,1,1,2,4,",
    "DIS06": "1,1,1,1,1,1,1,2,98",
    "REG01a": "1,2,2,",
    "REG01b": "1,2,2",
    "REG01h": "2,2,1",
    "REG01i": "2,2",
    "REG01d": "2,2,1",
    "REG01e": "2,2",
    "REG01f": "2,2,",
    "REG04a": "1,2,2",
    "REG04f": "2,2,",
    "REG04g": "2,2,1",
    "REG04c": "2,2",
    "REG04e": "2,2",
}

# The ten sex by age cells of the population table.
CELLS = (
    "female_0_4", "female_5_11", "female_12_17", "female_18_59", "female_60",
    "male_0_4", "male_5_11", "male_12_17", "male_18_59", "male_60",
)

# Labels of questions that are labelled on the form itself.
INCOME_LABELS = {"1": "Decreased", "2": "Stayed the same", "3": "Increased", "98": "Don't know"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def answer(key: str, salt: int, codes: str) -> Column:
    """Pick one of the codes by a multiplicative hash of key and salt."""
    entries = codes.split(",")
    choices = ", ".join(f"'{e}'" if e else "NULL" for e in entries)
    mixed = f"(({key} % 1000003) * 1000 + {salt}) * 2654435761 % 4294967296"
    return F.expr(
        f"element_at(array({choices}), cast(shiftright({mixed}, 16) % {len(entries)} + 1 AS int))")


def adult_numbers(items: DataFrame) -> DataFrame:
    """Per household the first adult at or after members 1, 2 and 3."""
    adult = items.filter(member_age() >= PROFILE.working_age)
    return adult.groupBy(F.col("l_orderkey").alias("_hh")).agg(*[
        F.min(F.when(F.col("member_no") >= k, F.col("member_no"))).alias(f"_adult{k}") for k in (1, 2, 3)])


def households(spark: SparkSession, sf_dir: str, respondent: bool = True,
               items: DataFrame | None = None) -> DataFrame:
    """One row per household form (order).

    The respondent is an adult: the first one from the drawn number on, or else the
    household's first. ``respondent=False`` leaves the drawn number as it is, which
    spares reading the members. ``items`` is the ``roster``, if the caller has it.
    """
    answers = [
        answer("_index", salt, codes).alias(name)
        for salt, (name, codes) in enumerate(HOUSEHOLD_ANSWERS.items(), start=1)
    ]
    person = F.concat(F.lit("person "), F.col("o_custkey").cast("string"))
    forms = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_index"), "o_custkey")
    adults: list[str] = []
    if respondent:  # before the answers are laid out, so that the join deals out keys only
        numbers = adult_numbers(numbered_items(spark, sf_dir) if items is None else items)
        forms, adults = forms.join(numbers, F.col("_index") == F.col("_hh"), "left"), numbers.columns
    forms = (
        forms.select("_index", person.alias("adult_name"), person.alias("fam_name1"), *answers, *adults)
        .withColumn("selected_adult", F.col("selected_adult").cast("int"))
    )
    if respondent:
        drawn = F.col("selected_adult")
        adult = (F.when(drawn == 1, F.col("_adult1")).when(drawn == 2, F.coalesce("_adult2", "_adult1"))
                 .when(drawn == 3, F.coalesce("_adult3", "_adult1")))
        forms = forms.withColumn("selected_adult", adult).drop(*adults)
    return (
        forms
        .withColumn("INC01", F.col("INC01").alias(
            "INC01", metadata={"label": "Change in income",
                               "codes": list(INCOME_LABELS), "texts": list(INCOME_LABELS.values())}))
    )


def member_age() -> Column:
    """Age in years, missing for some."""
    return F.when(F.col("l_partkey") % 97 != 0,
                  F.col("l_quantity").cast("int") * 2 - 2 + F.col("l_linenumber") % 2).cast("int")


def numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their position inside the order (1, 2, ...)."""
    items = table(spark, sf_dir, "lineitem")
    top_part = table(spark, sf_dir, "part").select(F.max("p_partkey") + 1).scalar()
    part_band = F.least(F.lit(63), F.floor(F.col("l_partkey") * 64 / top_part))
    return number_within(
        items,
        parent="l_orderkey",
        order=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_shipdate"],
        band=F.col("l_linenumber") * 64 + part_band,
        name="member_no",
    )


def with_nations(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    """Line items with the nations of their seller and their buyer.

    The sellers' nations are written, so the planner knows their bytes: where it broadcasts
    them, items that were numbered in the same plan are not dealt out again for the buyers,
    who are joined by the order.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    seller = stage(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(nation.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "seller_nation"}),
              "s_nationkey", "left").select("s_suppkey", "seller_nation"), "sellers")
    buyer = (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation.withColumnsRenamed({"n_nationkey": "c_nationkey", "n_name": "buyer_nation"}),
              "c_nationkey", "left")
        .select("o_orderkey", "buyer_nation")
    )
    return (
        items.join(seller, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(buyer, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .drop("s_suppkey", "o_orderkey")
    )


def roster(spark: SparkSession, sf_dir: str, origins: bool = True) -> DataFrame:
    """The numbered line items, written, for jobs that take members and respondents from them.

    With ``origins`` they have their nations, which cost the least while the items lie
    dealt by order for their numbers.
    """
    kept = ["l_orderkey", "member_no", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus"]
    items = numbered_items(spark, sf_dir)
    if origins:
        items = with_nations(spark, sf_dir, items)
    return stage(items.select(*kept, *(("seller_nation", "buyer_nation") if origins else ("l_suppkey",))), "roster")


def members(
    spark: SparkSession, sf_dir: str, questions: Iterable[str] | None = None, origins: bool = True,
    items: DataFrame | None = None,
) -> DataFrame:
    """One row per household member (line item).

    ``origins=False`` leaves out the citizenship questions, which need four
    more joins. ``items`` is the ``roster``, if the caller has it; one with origins spares these joins.
    """
    items = numbered_items(spark, sf_dir) if items is None else items
    part = F.col("l_partkey")
    keep = {
        "_index": F.col("l_orderkey") * MEMBER_STRIDE + F.col("member_no"),
        "_parent_index": F.col("l_orderkey"),
        "member_no": F.col("member_no"),
        "R01": F.concat(F.lit("person "), (F.col("l_orderkey") * MEMBER_STRIDE + F.col("member_no")).cast("string")),
        "R02": F.when(F.col("l_linestatus") == "F", "Female").otherwise("Male"),
        "R03": member_age(),
        "R02_rel": F.when(part % 193 == 0, None).when(F.col("l_linenumber") == 1, "1").otherwise("2"),
    }
    if origins:
        if "seller_nation" not in items.columns:
            items = with_nations(spark, sf_dir, items)
        born = F.col("buyer_nation")
        held = F.col("seller_nation")
        unknown = F.col("l_orderkey") % 307 == 0  # nobody of the household says where they are from
        keep["REF01"] = (
            F.when(unknown, "99").when(held == PROFILE.host, "1").when(part % 41 == 0, "99")
            .when(part % 43 == 0, "98").otherwise("2")
        )
        keep["REF02"] = F.when(part % 47 == 0, "77").otherwise(held)
        keep["REF06"] = F.when(unknown, None).when(part % 53 == 0, "98").when(part % 59 == 0, None).otherwise(born)
    silent = F.coalesce(part % 211 == 0, F.lit(False))  # refuses all questions on functioning
    out = items.select(*[c.alias(n) for n, c in keep.items()], silent.alias("_silent"))
    wanted = MEMBER_ANSWERS if questions is None else set(questions)
    answers = [
        (F.when(F.col("_silent"), "98").otherwise(given) if name.startswith("DIS") else given).alias(name)
        for name, given in ((n, answer("_index", salt, codes))
                            for salt, (n, codes) in enumerate(MEMBER_ANSWERS.items(), start=101))
        if name in wanted
    ]
    return out.select("*", *answers).drop("_silent")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("iso3"), F.col("r_name").alias("hcr_region"),
        F.concat(F.lit("Country "), F.col("n_nationkey").cast("string")).alias("name"))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External population counts, one row per origin, year and status.

    Year 2021 with status REF or ASY holds the counts in use; the other rows
    are there for the filter to remove. Some cells are missing, one origin is
    unknown, and the published totals do not always agree with the cells.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    unknown = nation.agg(F.count(F.lit(1)).alias("n_nationkey"), F.lit(PROFILE.unknown_origin).alias("n_name"))
    nation = nation.union(unknown)
    scale = F.floor(table(spark, sf_dir, "lineitem").select(F.count(F.lit(1)) / 1000).scalar())
    key = F.col("n_nationkey").cast("long")
    cells = {c: F.when((key + pos) % 11 != 0, (50 + (key * 37 + pos * 11) % 100) * F.col("scale"))
             for pos, c in enumerate(CELLS)}
    status = F.when(key % 2 == 0, "REF").otherwise("ASY")
    versions = F.explode(F.array(
        F.struct(F.lit(2021).alias("year"), status.alias("populationType")),
        F.struct(F.lit(2020).alias("year"), status.alias("populationType")),
        F.struct(F.lit(2021).alias("year"), F.lit("ROC").alias("populationType")),
    ))
    wide = nation.withColumn("scale", scale).select(
        versions.alias("v"), key.alias("key"), F.col("n_name").alias("origin_iso3"),
        *[v.cast("long").alias(c) for c, v in cells.items()],
    )
    female = sum((F.coalesce(c, F.lit(0)) for c in CELLS[:5]), F.col("key") % 3)
    male = sum((F.coalesce(c, F.lit(0)) for c in CELLS[5:]), F.col("key") % 2)
    return wide.select(
        F.col("v.year").alias("year"), F.lit(PROFILE.host).alias("asylum_iso3"),
        F.col("origin_iso3").alias("origin"), "origin_iso3",
        F.col("v.populationType").alias("populationType"),
        *CELLS, female.alias("female"), male.alias("male"), (female + male).alias("totalEndYear"),
    )
