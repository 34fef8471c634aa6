"""Member demographics: age bands, citizenship, origin, functioning, documents.

The rules of a member's derived answers take a function that gives an answer by name.
They serve member rows (``F.col``) and the entries of a nested roster alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.labels import labelled, variable_label
from surveyspark.functions.nulls import all_in, any_equal, count_in, cut, in_set, unite
from surveyspark.sources.profile import Profile

# Age bands, upper ends included.
FINE_BOUNDS = (-1, 4, 11, 17, 24, 49, 59)
FINE_LABELS = {1: "0-4", 2: "5-11", 3: "12-17", 4: "18-24", 5: "25-49", 6: "50-59", 7: "60+"}
BROAD_BOUNDS = (-1, 4, 11, 17, 59)
BROAD_LABELS = {1: "0-4", 2: "5-11", 3: "12-17", 4: "18-59", 5: "60+"}

# Texts of the codes that stand for no country.
NO_COUNTRY_LABELS = {"77": "Stateless", "98": "Don't know", "99": "No answer"}

# The six functioning questions and their answer codes.
FUNCTIONING = ("DIS01", "DIS02", "DIS03", "DIS04", "DIS05", "DIS06")
SOME_DIFFICULTY = ("2", "3", "4")
SEVERE_DIFFICULTY = ("3", "4")
CANNOT_DO = "4"
NO_ANSWER = ("98", "99")
DISABILITY_LABELS = {0: "Without disability", 1: "With disability", 98: "Unknown"}

# Document questions from age five on, and below.
DOCUMENTS_FROM_5 = ("REG01a", "REG01b", "REG01h", "REG01i", "REG01d", "REG01e", "REG01f")
DOCUMENTS_BELOW_5 = ("REG04a", "REG04f", "REG04g", "REG04c", "REG04e")
DOCUMENT_LABELS = {
    0: "Does not have documents or credentials",
    1: "Has documents or credentials",
}


# Value labels and variable labels of the derived answers.
MEMBER_LABELS = {
    "R03cat": (FINE_LABELS, "Fine age brackets"),
    "R03cat2": (BROAD_LABELS, "Broad age brackets (18-59)"),
    **{f"DISABILITY{k}": (DISABILITY_LABELS, f"Washington Group disability identifier {k}") for k in range(1, 5)},
    "documents": (DOCUMENT_LABELS, "Valid identity documents or credentials"),
}

Get = Callable[[str], Column]


def with_labels(c: Column, name: str, answer: str | None = None) -> Column:
    """The column under a name, with the labels of the derived answer it holds, if that has any."""
    texts = MEMBER_LABELS.get(answer or name)
    return labelled(c, name, *texts) if texts else c.alias(name)


def age_band_rules(get: Get, age: str = "R03") -> dict[str, Column]:
    fine = cut(get(age), FINE_BOUNDS, list(FINE_LABELS))
    broad = cut(get(age), BROAD_BOUNDS, list(BROAD_LABELS))
    return {
        "R03cat": with_labels(fine, "R03cat"),
        "R03cat2": with_labels(broad, "R03cat2"),
    }


def age_bands(df: DataFrame, age: str = "R03") -> DataFrame:
    return df.withColumns(age_band_rules(F.col, age))


def citizenship_rules(get: Get, profile: Profile) -> dict[str, Column]:
    """Primary citizenship, and the origin it implies when it is known."""
    status = get("REF01")
    held = (
        F.when(status == "1", profile.host)
        .when(status.isin("2", "98"), get("REF02").cast("string"))
        .when(status == "99", "99")
    )
    unknown = profile.unknown_codes
    uninformative = [*unknown, profile.host]
    from_citizenship = F.when(~in_set(held, unknown), held)
    from_birth = F.when(
        in_set(held, unknown) & ~in_set(get("REF06"), uninformative), get("REF06").cast("string"))
    return {"citizenship": held, "originAux": F.coalesce(from_citizenship, from_birth)}


def citizenship(df: DataFrame, profile: Profile) -> DataFrame:
    rules = citizenship_rules(F.col, profile)
    label = variable_label(df, "REF02") or "Country of citizenship"
    return df.withColumns({**rules, "citizenship": labelled(rules["citizenship"], "citizenship", None, label)})


def functioning_flags(df: DataFrame) -> DataFrame:
    """Twelve flags: each domain with some, and with severe, difficulty."""
    flags = {}
    for i, question in enumerate(FUNCTIONING, start=1):
        flags[f"disaux{i}_234"] = in_set(question, SOME_DIFFICULTY)
        flags[f"disaux{i}_34"] = in_set(question, SEVERE_DIFFICULTY)
    return df.withColumns(flags)


def functioning_sums(get: Get) -> dict[str, Column]:
    """Domains with some, and with severe, difficulty, and whether no domain was answered."""
    answers = [get(q) for q in FUNCTIONING]
    return {"disSum234": count_in(answers, SOME_DIFFICULTY), "disSum34": count_in(answers, SEVERE_DIFFICULTY),
            "undisclosed": all_in(answers, NO_ANSWER)}


def disability_rules(get: Get, sums: Get | None = None) -> dict[str, Column]:
    """Counts of affected domains and the four disability identifiers.

    Identifiers 1 to 3 read a missing answer as "not affected"; identifier 4
    compares directly and so stays missing where the answers do not decide it.
    ``sums`` gives the ``functioning_sums`` by name, if the caller has them.
    """
    known = sums or functioning_sums(get).__getitem__
    some, severe, undisclosed = known("disSum234"), known("disSum34"), known("undisclosed")
    unable = any_equal([get(q) for q in FUNCTIONING], CANNOT_DO)

    def counted(hit: Column) -> Column:
        return F.when(hit, 1).when(undisclosed, 98).otherwise(0)

    rules = {
        "DISABILITY1": counted(some >= 1),
        "DISABILITY2": counted((some >= 2) | (severe >= 1)),
        "DISABILITY3": counted(severe >= 1),
        "DISABILITY4": F.when(undisclosed, 98).otherwise(unable.cast("int")),
    }
    return {"disSum234": some, "disSum34": severe, **{
        name: with_labels(rule, name) for name, rule in rules.items()}}


def disability(df: DataFrame) -> DataFrame:
    return df.withColumns(disability_rules(F.col))


def document_rules(get: Get, age: str = "R03") -> dict[str, Column]:
    """Any valid identity document, by the question set of the age group."""
    older = any_equal([get(q) for q in DOCUMENTS_FROM_5], "1").cast("int")
    younger = any_equal([get(q) for q in DOCUMENTS_BELOW_5], "1").cast("int")
    rule = F.when(get(age) < 5, younger).when(get(age) >= 5, older)
    return {"doc5plus": older, "doc04": younger, "documents": with_labels(rule, "documents")}


def documents(df: DataFrame, age: str = "R03") -> DataFrame:
    return df.withColumns(document_rules(F.col, age))


def own_origin(df: DataFrame, profile: Profile) -> DataFrame:
    """The origin by a member's own answers, and whether it goes before the household's.

    A join that brings the household's origin carries these two in place of three answers.
    """
    born = F.col("REF06").cast("string")
    last_resort = F.when(born == profile.host, F.col("citizenship")).otherwise(born)
    return df.withColumns({"_own": F.coalesce("originAux", last_resort), "_sure": F.col("originAux").isNotNull()})


def impute_origin(df: DataFrame, profile: Profile) -> DataFrame:
    """Origin: own, else the household's, else birth country or citizenship.

    Expects ``originAux`` or what ``own_origin`` makes of it and, per household, ``originAux2``.
    """
    if "_own" not in df.columns:
        df = own_origin(df, profile)
    origin = F.coalesce(F.when(F.col("_sure"), F.col("_own")), "originAux2", "_own")
    return df.withColumn("origin", labelled(
        origin, "origin", None,
        "Origin (nationality where available, country of birth for foreign-born stateless persons)")).drop("_own", "_sure")


def collapse_origin(df: DataFrame, profile: Profile, origin: str = "origin",
                    name: str = "origin_ps") -> DataFrame:
    """Named origins stay; the rest splits into one region against all others."""
    region = F.col("originHcrRegion")
    kept = in_set(origin, profile.kept_origins)
    return df.withColumn(
        name,
        F.when(kept, F.col(origin))
        .when(region == profile.named_region, profile.other_inside)
        .when(region != profile.named_region, profile.other_outside))


def age_group(df: DataFrame, age: str = "R03", name: str = "R03bin",
              adult_from: int = Profile.working_age) -> DataFrame:
    return df.withColumn(
        name, F.when(F.col(age) < adult_from, "Child").when(F.col(age) >= adult_from, "Adult"))


def adult_stratum(df: DataFrame, sex: str = "R02") -> DataFrame:
    return df.withColumn("originSex_ps", unite("origin_ps", sex))


def member_stratum(df: DataFrame, sex: str = "R02") -> DataFrame:
    return df.withColumn("originAgeSex_ps", unite("origin_ps", "R03bin", sex))
