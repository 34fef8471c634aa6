"""Country settings of one survey round."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """What has to be adapted per country.

    The defaults are fixed values of the survey round this library follows.
    """

    host: str = "GEO"
    unknown_codes: tuple[str, ...] = ("77", "98", "99")
    kept_origins: tuple[str, ...] = ("IRN", "IRQ", "RUS", "UKR")
    named_region: str = "Middle East and North Africa"
    other_inside: str = "OtherMENA"
    other_outside: str = "OtherNotMENA"
    working_age: int = 18
    year: int = 2021
    population_types: tuple[str, ...] = ("REF", "ASY")
    unknown_origin: str = "UKN"


# Columns that identify a person, by table.
HOUSEHOLD_IDENTIFIERS = (
    "adult_name", "fam_name1", "fam_name2", "fam_name3", "fam_name4", "fam_name5",
    "fam_name6", "fam_name7", "fam_name8", "fam_name9", "namechild2less",
    "women_name_b_total", "R01",
)
MEMBER_IDENTIFIERS = ("R01", "indid2", "name_individual")

# Working columns that do not leave the cleaning stage.
HOUSEHOLD_WORK_COLUMNS = (
    "originAux", "originAux2", "atWork", "tempAbs", "agriFish", "agriFishDest",
    "employed", "unemployed", "headHHindex",
)
MEMBER_WORK_COLUMNS = (
    "R05b", "calculation_002", "AgeMonths", "calculation3", "calculation4", "R04",
    "adult", "ind_age_month", "originAux", "originAux2",
)
