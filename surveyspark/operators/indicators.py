"""Standard indicators from the household form, as labelled 0/1 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.labels import labelled
from surveyspark.functions.nulls import any_equal, if_else_na, in_set, number, recode
from surveyspark.sources.profile import Profile

# Answer codes and labels of the indicators.
WORKING_AGE_LABELS = {0: "Not working-age", 1: "Working-age"}
LABOUR_FORCE_LABELS = {0: "Outside the labour force", 1: "In the labour force"}
EMPLOYMENT_LABELS = {0: "Employed", 1: "Unemployed"}
BANKING_LABELS = {
    1: "Has account at bank/financial institution/mobile money-service provider",
    0: "Does not have account",
}
HEALTH_LABELS = {0: "No", 1: "Yes"}
CLEAN_STOVES = ("1", "2", "3", "4", "5")
POLLUTING_STOVES = ("7", "8", "9", "10")
STOVES_JUDGED_BY_FUEL = ("6", "96")
CLEAN_FUELS = ("1", "2", "3", "22")
COOKING_LABELS = {0: "Polluting", 1: "Clean"}
SAFETY_RECODE = {"1": 1, "2": 1, "3": 2, "4": 2, "97": 97, "98": 98, "99": 98}
SAFETY_LABELS = {
    1: "Very or fairly safe",
    2: "Very or bit unsafe",
    97: "I never walk alone after dark",
    98: "Unknown/Prefer not to respond",
}
IMPROVED_WATER = ("1", "2", "3", "4", "5", "6", "8", "10", "11", "12", "14", "15", "16")
UNIMPROVED_WATER = ("7", "9", "13", "17", "98")
IMPROVED_LABELS = {0: "Unimproved", 1: "Improved"}
WATER_LABELS = {
    0: "Limited, unimproved or surface water source",
    1: "Basic drinking water source",
}
MINUTES_PER_UNIT = {"1": 1, "2": 60}
NEAR_WATER_MINUTES = 30
IMPROVED_TOILETS = ("11", "12", "13", "21", "22", "31")
UNIMPROVED_TOILETS = ("14", "18", "23", "41", "51", "85", "96")
SANITATION_LABELS = {
    0: "Limited/unimproved sanitation facility or open defecation",
    1: "Basic sanitation facility",
}
WEAK_LIGHT_SOURCES = ("0", "7")
ELECTRICITY_LABELS = {1: "Electricity in household", 0: "No electricity in household"}
FACILITIES_LABELS = {
    1: "Household has access to basic facilities",
    0: "Household does not have access to basic facilities",
}

# every household question that only feeds the indicators below
SERVICE_ANSWERS = (
    "BANK01", "BANK02", "BANK03", "BANK04", "BANK05", "HACC01", "HACC03",
    "COOK01", "COOK03", "COOK04", "SAF01", "DWA01", "DWA02", "DWA03a", "DWA03b",
    "TOI01", "TOI05", "LIGHT01", "LIGHT03",
)


def _in_or_out(c: str, inside: tuple[str, ...], outside: tuple[str, ...]) -> Column:
    return F.when(F.col(c).isin(*inside), 1).when(F.col(c).isin(*outside), 0)


def working_age(df: DataFrame, profile: Profile, age: str = "R03") -> DataFrame:
    old_enough = if_else_na(F.col(age) >= profile.working_age, 1, 0)
    return df.withColumn("workingAge", labelled(
        old_enough, "workingAge", WORKING_AGE_LABELS, "Working-age population"))


def employment(df: DataFrame) -> DataFrame:
    """Whether the respondent is employed, by the household form alone.

    The questionnaire walks from paid work, over own business or family job
    and temporary absence, to farming, and asks what farm produce is for.
    """
    yes, no = "1", "2"
    q = {i: F.col(f"UNEM{i:02d}") for i in range(1, 11)}
    own_job = any_equal(["UNEM02", "UNEM03"], yes)
    no_own_job = (q[2] == no) & (q[3] == no)
    df = df.withColumn("atWork", F.when(q[1] == yes, 1).when(
        q[1] == no, F.when(no_own_job, 2).when(own_job, 3)))

    idle = F.col("atWork") == 2
    df = df.withColumn("tempAbs", F.when(idle, F.when(q[4] == yes, 1).when(
        q[4] == no, F.when(q[5] == yes, 3).when(q[5] == no, 2))))

    has_own_job = in_set(F.col("atWork").cast("string"), ["3"]) | in_set(
        F.col("tempAbs").cast("string"), ["3"])
    farm = ("1", "2")
    df = df.withColumn(
        "agriFish",
        F.when(has_own_job, F.when(q[7] == "3", 1).when(q[7].isin(*farm), 2))
        .when(F.col("tempAbs") == 2, F.when(q[6] == "3", 0).when(q[6].isin(*farm), 2)))
    df = df.withColumn("agriFishDest", F.when(
        F.col("agriFish") == 2, recode(q[8], {"1": 1, "2": 1, "3": 0, "4": 0})))

    unpaid = (F.col("agriFishDest") == 0) | (F.col("agriFish") == 0)
    paid = any_equal(["atWork", "tempAbs", "agriFish", "agriFishDest"], 1)
    looking = (q[9] == yes) & (q[10] == yes)
    return df.withColumn("employed", F.when(unpaid & looking, 0).when(paid, 1))


def labour_force(df: DataFrame) -> DataFrame:
    """Employment status and labour force participation, expects ``workingAge``.

    Takes ``employed`` as it is where ``employment`` went before.
    """
    if "employed" not in df.columns:
        df = employment(df)
    participates = F.when(F.col("workingAge") == 1, F.col("employed").isNotNull().cast("int"))
    return df.withColumns({
        "unemployed": 1 - F.col("employed"),
        "labourForce": labelled(participates, "labourForce", LABOUR_FORCE_LABELS, "Labour force"),
        "employmentStatus": labelled(
            1 - F.col("employed"), "employmentStatus", EMPLOYMENT_LABELS, "Employment status"),
    })


def banking(df: DataFrame) -> DataFrame:
    """Account with any provider; a joint account counts when usable."""
    yes, no = "1", "2"
    b = {i: F.col(f"BANK{i:02d}") for i in range(1, 6)}
    none_alone = (b[1] == no) & (b[4] == no) & (b[5] == no)
    none_shared = (b[2] == no) | (b[3] == no) | b[3].isNull()
    shared = (b[2] == yes) & (b[3] == yes)
    has_one = any_equal(["BANK01", "BANK04", "BANK05"], yes) | shared
    rule = F.when(none_alone & none_shared, 0).when(has_one, 1)
    return df.withColumn("banking", labelled(
        rule, "banking", BANKING_LABELS,
        "Account at a bank or other financial institution or with a mobile-money-service provider"))


def health_access(df: DataFrame) -> DataFrame:
    """Whether needed care was received; missing where none was needed."""
    denied, received = F.col("HACC03"), F.col("HACC01")
    rule = F.when(denied == "1", 0).when((denied == "2") & (received == "1"), 1)
    return df.withColumn("healthaccess", labelled(
        rule, "healthaccess", HEALTH_LABELS, "Received needed health services in the last 3 months"))


def cooking_fuel(df: DataFrame) -> DataFrame:
    """Clean or polluting cooking; a missing fuel counts as polluting."""
    stove = F.col("COOK03")
    by_stove = (
        _in_or_out("COOK03", CLEAN_STOVES, POLLUTING_STOVES)
    )
    by_fuel = in_set("COOK04", CLEAN_FUELS).cast("int")
    rule = F.when(F.col("COOK01") == "1", F.when(
        stove.isin(*STOVES_JUDGED_BY_FUEL), by_fuel).otherwise(by_stove))
    return df.withColumn("cookingfuel", labelled(
        rule, "cookingfuel", COOKING_LABELS, "Primary cooking fuel and technology"))


def safety(df: DataFrame) -> DataFrame:
    return df.withColumn("SAF01SDG", labelled(
        recode("SAF01", SAFETY_RECODE), "SAF01SDG", SAFETY_LABELS,
        "SDG 16.1.4: How safe do you feel walking alone in your area/neighbourhood after dark?"))


def drinking_water(df: DataFrame) -> DataFrame:
    """Improved source, minutes for the trip, and basic service."""
    improved = _in_or_out("DWA01", IMPROVED_WATER, UNIMPROVED_WATER)
    trip = F.col("DWA03a").cast("string")
    minutes = F.when(trip != "98", number(trip) * recode("DWA03b", MINUTES_PER_UNIT))
    df = df.withColumns({
        "improvedDrinkingWater": labelled(
            improved, "improvedDrinkingWater", IMPROVED_LABELS,
            "Main drinking water source - improved vs unimproved"),
        "DWA03": labelled(minutes, "DWA03", None,
                          "Time for return trip to water source in minutes"),
    })
    place, time = F.col("DWA02"), F.col("DWA03")
    at_hand = place.isin("1", "2") | (place.isNull() & time.isNull())
    walked = place.isNull() | (place == "3")
    rule = F.when(F.col("improvedDrinkingWater") == 0, 0).when(
        F.col("improvedDrinkingWater") == 1,
        F.when(at_hand, 1).when(walked, (time <= NEAR_WATER_MINUTES).cast("int")))
    return df.withColumn("basicDrinkingWater", labelled(
        rule, "basicDrinkingWater", WATER_LABELS,
        "Main drinking water source (basic: improved source and at most 30 minute return trip)"))


def sanitation(df: DataFrame) -> DataFrame:
    """Improved facility, and basic service where it is not shared."""
    df = df.withColumn("improvedSanitation", labelled(
        _in_or_out("TOI01", IMPROVED_TOILETS, UNIMPROVED_TOILETS),
        "improvedSanitation", IMPROVED_LABELS, "Sanitation facility - improved vs unimproved"))
    rule = ((F.col("improvedSanitation") == 1) & (F.col("TOI05") == "2")).cast("int")
    return df.withColumn("basicSanitation", labelled(
        rule, "basicSanitation", SANITATION_LABELS,
        "Sanitation facility  (basic: improved and not shared)"))


def electricity(df: DataFrame) -> DataFrame:
    light = F.col("LIGHT01")
    rule = F.when((light == "2") | in_set("LIGHT03", WEAK_LIGHT_SOURCES), 0).when(light == "1", 1)
    return df.withColumn("electricity", labelled(
        rule, "electricity", ELECTRICITY_LABELS, "Electricity in household"))


def basic_facilities(df: DataFrame) -> DataFrame:
    """All four services; one known lack decides, whatever else is missing."""
    services = ["basicDrinkingWater", "basicSanitation", "cookingfuel", "electricity"]
    rule = 1 - any_equal(services, 0).cast("int")
    return df.withColumn("basicFacilities", labelled(
        rule, "basicFacilities", FACILITIES_LABELS,
        "Household access to basic facilities (drinking water, sanitation, clean cooking fuel, electricity)"))


def household_services(df: DataFrame) -> DataFrame:
    """The indicators that need only the household form."""
    for step in (banking, health_access, cooking_fuel, safety, drinking_water,
                 sanitation, electricity, basic_facilities):
        df = step(df)
    return df
