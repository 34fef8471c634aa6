"""Named queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from surveyspark.catalog.oracle import ORACLE
from surveyspark.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
CHECKED = (
    "head_of_household", "head_attributes", "household_origin_by_count", "origin_imputation",
    "disability_identifiers", "labour_force", "basic_facilities", "margin_member",
    "origin_sex_wide", "column_summary", "submissions_flatten", "poststratified_weights",
    "adult_proportion_ci", "weighted_total_se", "report_join_form", "respondent_attributes",
    "deidentified_members", "members_left_out", "margin_consistency", "margin_by_origin",
    "equal_probability_table",
)


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted("|".join(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(rel.columns, rel.fetchall())


def test_every_survey_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 4
