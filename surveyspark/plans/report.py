"""Stage three: indicator tables with confidence limits, and the full report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions.labels import quoted, variable_label
from surveyspark.functions.reshape import any_of, stack_tables, strip_from_names, wider
from surveyspark.operators.design import SurveyDesign
from surveyspark.operators.estimate import TOTAL, Breakdown, Question, estimate_many, with_limits
from surveyspark.plans.weight import Designs

# Breakdown levels and row texts of the report.
SEX_LEVELS = ("Female", "Male")
AGE_LEVELS = ("0-4", "5-11", "12-17", "18-24", "25-49", "50-59", "60+")
DISABILITY_LEVELS = ("Without disability", "With disability")
LEVELS = SEX_LEVELS + AGE_LEVELS + DISABILITY_LEVELS
WEIGHTED_BASE = "SAMPLE SIZE WEIGHTED TO POPULATION"
UNWEIGHTED_BASE = "UNWEIGHTED SAMPLE SIZE"
BASE_ROW = 1_000_000
HEADER = ("Indicator", "Unit of analysis", "Question")


@dataclass(frozen=True)
class TableSpec:
    """One table of the report."""

    x: str
    design: str
    unit: str
    indicator: str = ""
    domain: str | None = None


HOUSEHOLD_BREAKDOWNS = (
    Breakdown("headHHR02", SEX_LEVELS),
    Breakdown("headHHR03cat", AGE_LEVELS),
    Breakdown("hhdisability3", DISABILITY_LEVELS),
)
PERSON_BREAKDOWNS = (
    Breakdown("R02", SEX_LEVELS),
    Breakdown("R03cat", AGE_LEVELS),
    Breakdown("DISABILITY3", DISABILITY_LEVELS),
)

# The tables of the report in their order.
REPORT = (
    TableSpec("hhsizecat", "households", "Households (HH size includes national household members)"),
    TableSpec("R02", "foreign_members", "Household member"),
    TableSpec("R03cat", "foreign_members", "Household member"),
    TableSpec("DISABILITY3", "foreign_members", "Household member"),
    TableSpec("basicFacilities", "foreign_members", "Household member", "Core impact 2.2"),
    TableSpec("documents", "foreign_members", "Household member", "Core outcome 1.3"),
    TableSpec("cookingfuel", "foreign_members", "Household member", "Core outcome 8.2"),
    TableSpec("R02", "foreign_adults", "Adult individual"),
    TableSpec("R03cat", "foreign_adults", "Adult individual"),
    TableSpec("DISABILITY3", "foreign_adults", "Adult individual"),
    TableSpec("healthaccess", "foreign_adults", "Adult individual", "Core impact 2.3"),
    TableSpec("SAF01SDG", "foreign_adults", "Adult individual", "Core impact 3.3"),
    TableSpec("basicDrinkingWater", "foreign_members", "Household member", "Core outcome 12.1"),
    TableSpec("basicSanitation", "foreign_members", "Household member", "Core outcome 12.2"),
    TableSpec("banking", "foreign_adults", "Adult individual", "Core outcome 13.1"),
    TableSpec("INC01", "foreign_adults", "Adult individual", "Core outcome 13.2"),
    TableSpec("labourForce", "foreign_adults", "Adult individual", "Labour force participation rate",
              "workingAge = 'Working-age'"),
    TableSpec("employmentStatus", "foreign_adults", "Adult individual", "Core outcome 13.3",
              "labourForce = 'In the labour force'"),
)


# every column the report reads
REPORT_COLUMNS = tuple(dict.fromkeys(
    [s.x for s in REPORT] + [b.column for b in HOUSEHOLD_BREAKDOWNS + PERSON_BREAKDOWNS]
    + ["workingAge"]))


def level_columns(by: Sequence[Breakdown]) -> dict[tuple[str, str], str]:
    """Column of every level; a text that several breakdowns share is told apart by the breakdown."""
    texts = [level for b in by for level in b.levels]
    return {(b.column, level): level if texts.count(level) == 1 else f"{level} ({b.column})"
            for b in by for level in b.levels}


def with_level_columns(cells: DataFrame, by: Sequence[Breakdown]) -> DataFrame:
    """Cells whose ``level`` is the column they go to."""
    shared = {key: name for key, name in level_columns(by).items() if name != key[1]}
    if not shared:
        return cells
    renamed = F.col("level")
    for (column, level), name in shared.items():
        renamed = F.when((F.col("breakdown") == column) & (F.col("level") == level), name).otherwise(renamed)
    return cells.withColumn("level", renamed)


def column_names(levels: Sequence[str]) -> list[str]:
    """Value columns of a table: share and limits, in total and per level."""
    names = ["Total", "low", "upp"]
    for level in levels:
        names += [level, f"low_{level}", f"upp_{level}"]
    return names


def _with_base_rows(cells: DataFrame) -> DataFrame:
    """Cells as (answer, level) values, and per level the two base values.

    The first cell of a level carries the level's sums, so the cells are read
    once and not once more for the bases.
    """
    level = Window.partitionBy("tab", "level")
    summed = cells.withColumns({
        "weighted": F.sum("n").over(level),
        "unweighted": F.sum("unwn").over(level).cast("double"),
        "first": F.min("answer_no").over(level),
    })

    def line(row_no: object, text: str, v: str, low: str, upp: str, n: str) -> str:
        return (f"struct({row_no} AS row_no, {text} AS Answers, {v} AS v, "
                f"cast({low} AS double) AS low, cast({upp} AS double) AS upp, {n} AS n)")

    three = ", ".join((
        line("answer_no", "answer", "p", "low", "upp", "n"),
        line(BASE_ROW + 1, quoted(WEIGHTED_BASE), "weighted", "NULL", "NULL", "weighted"),
        line(BASE_ROW + 2, quoted(UNWEIGHTED_BASE), "unweighted", "NULL", "NULL", "unweighted")))
    lines = F.expr(
        f"inline(filter(array({three}), r -> r.row_no < {BASE_ROW} OR answer_no = first))")
    return summed.select("tab", "level", lines)


def wide_tables(cells: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Cells of one or more tables as report rows: answers, then two base rows."""
    wide = wider(
        _with_base_rows(cells), ["tab", "row_no", "Answers"], "level", [TOTAL, *levels],
        {"{}": F.first("v"), "low_{}": F.first("low"), "upp_{}": F.first("upp"),
         "n_{}": F.first("n")})
    wide = wide.withColumnsRenamed({"low_Total": "low", "upp_Total": "upp", "n_Total": "n"})
    is_base = F.col("row_no") > BASE_ROW
    empty = {v: F.when(is_base & F.col(f"`{v}`").isNull(), 0.0).otherwise(F.col(f"`{v}`"))
             for v in levels}
    return wide.withColumns(empty).select(
        "tab", "row_no", "Answers", "n", *[f"`{c}`" for c in column_names(levels)])


def with_header(rows: DataFrame, specs: Sequence[TableSpec], questions: Sequence[str]) -> DataFrame:
    """Report number and header texts, shown on the first row of each table only."""
    heads = F.array(*[
        F.array(F.lit(s.indicator), F.lit(s.unit), F.lit(question))
        for s, question in zip(specs, questions)])
    head = F.element_at(heads, F.col("tab"))
    texts = [
        F.when(F.col("row_no") == 1, head[i]).otherwise("").alias(name)
        for i, name in enumerate(HEADER)]
    rest = [f"`{c}`" for c in rows.columns if c not in ("tab", "row_no")]
    return rows.select("tab", "row_no", *texts, *rest)


def indicator_tables(design: SurveyDesign, specs: Sequence[TableSpec],
                     by: Sequence[Breakdown]) -> DataFrame:
    """All tables of one design; ``tab`` numbers them, ``row_no`` their rows."""
    cells = with_limits(estimate_many(design, [Question(s.x, s.domain) for s in specs], by))
    cells = with_level_columns(cells, by)
    levels = list(level_columns(by).values())
    questions = [variable_label(design.df, s.x) for s in specs]
    return with_header(wide_tables(cells, levels), specs, questions)


def indicator_table(design: SurveyDesign, x: str, by: Sequence[Breakdown],
                    indicator: str = "", unit: str = "") -> DataFrame:
    """Answers of ``x`` by all breakdowns: weighted size, shares, 95 % limits."""
    return indicator_tables(design, [TableSpec(x, "", unit, indicator)], by).drop("tab")


def full_report(designs: Designs, specs: Sequence[TableSpec] = REPORT) -> DataFrame:
    """All tables one below the other; ``table_no`` and ``row_no`` give the order.

    Tables of the same design are estimated together, so the report reads each
    design twice and shuffles it once, whatever the number of tables.
    """
    parts = []
    for name in dict.fromkeys(s.design for s in specs):
        mine = [(no, s) for no, s in enumerate(specs, start=1) if s.design == name]
        by = HOUSEHOLD_BREAKDOWNS if name == "households" else PERSON_BREAKDOWNS
        cells = estimate_many(
            getattr(designs, name), [Question(s.x, s.domain) for _, s in mine], by)
        number = F.element_at(F.array(*[F.lit(no) for no, _ in mine]), F.col("tab"))
        parts.append(cells.withColumn("tab", number))
    rows = wide_tables(with_limits(stack_tables(parts)), LEVELS)
    questions = [variable_label(getattr(designs, s.design).df, s.x) for s in specs]
    return with_header(rows, specs, questions).withColumnRenamed("tab", "table_no")


def joined_table(design: SurveyDesign, x: str, by: Sequence[Breakdown],
                 indicator: str = "", unit: str = "") -> DataFrame:
    """The same table put together by joins: one block per breakdown.

    Each block is pivoted on its own, with ``%_`` in front of the level, and
    left-joined to the totals on the answer; the mark is stripped at the end.
    """
    cells = with_level_columns(with_limits(estimate_many(design, [Question(x)], by)), by)
    columns = level_columns(by)
    total = cells.filter(F.col("breakdown") == TOTAL).select(
        "answer_no", "answer", "n", F.col("p").alias("%"),
        F.col("low").alias("%_low"), F.col("upp").alias("%_upp"))
    patterns = {"%_{}": F.first("p"), "%_low_{}": F.first("low"), "%_upp_{}": F.first("upp")}
    table, names = total, []
    for b in by:
        block = wider(
            cells.filter(F.col("breakdown") == b.column), ["answer"], "level",
            [columns[b.column, level] for level in b.levels], patterns)
        names += [p.format(columns[b.column, level]) for level in b.levels for p in patterns]
        table = table.join(block, "answer", "left")
    table = table.select(
        F.col("answer_no").alias("row_no"), F.col("answer").alias("Answers"), "n",
        F.col("`%`").alias("Total"), F.col("`%_low`"), F.col("`%_upp`"),
        *[F.col(f"`{c}`") for c in any_of(table, names)])
    table = strip_from_names(table, "%_").withColumn("tab", F.lit(1))
    levels = list(columns.values())
    bases = wide_tables(cells, levels).filter(F.col("row_no") > BASE_ROW)
    rows = stack_tables([table, bases.select(*any_of(bases, table.columns))])
    spec = TableSpec(x, "", unit, indicator)
    return with_header(rows, [spec], [variable_label(design.df, x)]).drop("tab")
