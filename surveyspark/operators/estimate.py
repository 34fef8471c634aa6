"""Weighted totals and proportions with design-based standard errors.

A table counts answers by groups: the total and every level of every
breakdown. All tables of one design are estimated together, in two passes over
its rows, however many tables there are:

1. Rows are counted by type: table, post-stratum, breakdown levels, answer.
   The type table has as many rows as there are such combinations, whatever
   the number of interviews, and all estimates follow from it. It is written
   once and read back.
2. In clustered designs every row adds its score to its sampling unit, one
   column per group. Scores depend on the type only and come from a written
   lookup, so this is one join, whose strategy the planner picks by the lookup's
   bytes, and one grouping by unit. The rows are dealt by unit before they are copied
   for the tables, with levels and answers as small numbers in one word, so that the sums
   of a unit, many times wider than its rows, are formed where they are needed and never
   shuffled. Units of more than ``CROWD`` rows are listed first; for them partial sums are
   formed before the shuffle, hence a unit of any size is safe. Where each row
   is its own unit, the sums of squares follow from the type table as well.

The score of a row is its linearised contribution ``(hit - p) / W`` to a cell,
less the mean contribution of its post-stratum (over all rows of the design,
in the domain or not). The variance is that of the unit totals.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions.labels import level_order, quoted
from surveyspark.functions.stats import logit_limits, mean_limits, t_975
from surveyspark.operators.design import SurveyDesign
from surveyspark.sources.stages import stage

TOTAL = "Total"

#: sampling units with more rows than this are summed over many tasks
CROWD = 10_000

#: rows of a task that sums units; the sums of that many units fit its memory
UNIT_ROWS = 100_000

#: numbers are packed into words below this
WORD = 1 << 62


@dataclass(frozen=True)
class Breakdown:
    """A column and the levels a table shows of it, in order."""

    column: str
    levels: tuple[str, ...]


@dataclass(frozen=True)
class Question:
    """A tabulated column, on part of the design's rows if a condition is given."""

    x: str
    domain: str | None = None


def _groups(by: Sequence[Breakdown]) -> list[tuple[str, str]]:
    """All groups of a table; their position is the group number."""
    return [(TOTAL, TOTAL)] + [(b.column, level) for b in by for level in b.levels]


def _people(design: SurveyDesign, questions: Sequence[Question], by: Sequence[Breakdown]) -> DataFrame:
    """Design rows: unit, weight, stratum, groups, and the answer to every table's question.

    ``_b0``, ``_b1``, ... hold the row's group number per breakdown (0: none),
    ``_x1``, ``_x2``, ... the answers by table, empty for a row outside the table's domain.
    """
    numbers = {group: n for n, group in enumerate(_groups(by))}
    out = {
        "_w": F.col(design.weight).cast("double"),
        "_h": F.col(design.stratum).cast("string") if design.stratum else F.lit(""),
        "_fpc": F.col(design.fpc).cast("double") if design.fpc else F.lit(None).cast("double"),
    }
    if design.psu:
        out["_psu"] = F.col(design.psu)
    for i, b in enumerate(by):
        whens = " ".join(
            f"WHEN {quoted(level)} THEN {numbers[b.column, level]}" for level in b.levels)
        out[f"_b{i}"] = F.expr(f"CASE CAST(`{b.column}` AS STRING) {whens} ELSE 0 END")
    for no, q in enumerate(questions, start=1):
        answer = F.col(q.x).cast("string")
        inside = answer.isNotNull()
        for condition in (design.domain, q.domain and F.expr(q.domain)):
            inside = inside if condition is None else inside & F.coalesce(condition, F.lit(False))
        out[f"_x{no}"] = F.when(inside, F.concat(F.lit("="), answer)).otherwise("")
    return design.df.select(*[c.alias(n) for n, c in out.items()])


def _by_table(people: DataFrame, tables: int) -> DataFrame:
    """The rows once per table, with its number ``_tab`` and the answer ``_x``."""
    answers = [f"_x{no}" for no in range(1, tables + 1)]
    entries = F.array(*[F.struct(F.lit(no).alias("_tab"), F.col(x).alias("_x"))
                        for no, x in enumerate(answers, start=1)])
    return people.select(*[c for c in people.columns if c not in answers], F.inline(entries))


def _packed(values: Mapping[str, tuple[Column, int]]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Numbers from 0 to below their size in as few 64-bit words as hold them, and how to read them."""
    words: dict[str, Column] = {}
    read: dict[str, Column] = {}
    room = WORD
    for name, (value, size) in values.items():
        if not words or room * size > WORD:
            word, room = f"_c{len(words)}", 1
            words[word] = F.lit(0).cast("long")
        words[word] = words[word] + value.cast("long") * F.lit(room).cast("long")
        read[name] = F.expr(f"cast({word} div {room} % {size} as int)")
        room *= size
    return words, read


def _dealt_by_unit(people: DataFrame, types: DataFrame, tables: int, by: Sequence[Breakdown]) -> DataFrame:
    """``_people`` without ``_fpc``, all rows of a unit in one partition.

    Groups and answers travel as numbers. The type table gives the answers and the
    rows, hence the number of partitions, so that the sums of a partition's units fit a task.
    """
    answers: dict[int, list[str]] = {no: [] for no in range(1, tables + 1)}
    count = 0
    for tab, x, n in types.groupBy("_tab", "_x").agg(F.sum("_n")).orderBy("_tab", "_x").collect():
        answers[tab].append(x)
        count += n if tab == 1 else 0
    texts = {f"_x{no}": F.array(*[F.lit(x) for x in found or [""]]) for no, found in answers.items()}
    values = {f"_b{i}": (F.col(f"_b{i}"), len(_groups(by))) for i in range(len(by))}
    values |= {f"_x{no}": (F.array_position(texts[f"_x{no}"], F.col(f"_x{no}")) - 1, len(found) or 1)
               for no, found in answers.items()}
    words, read = _packed(values)
    dealt = people.select("_psu", "_w", "_h", *[c.alias(n) for n, c in words.items()]).repartition(
        max(1, math.ceil(count / UNIT_ROWS)), "_psu")
    back = {x: F.get(texts[x], c) if x in texts else c for x, c in read.items()}
    return dealt.select("_psu", "_w", "_h", *[c.alias(n) for n, c in back.items()])


def type_table(rows: DataFrame, by: Sequence[Breakdown]) -> DataFrame:
    """Rows, weight and squared weight per type."""
    levels = [f"_b{i}" for i in range(len(by))]
    return rows.groupBy("_tab", "_h", *levels, "_x").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_w").alias("_w"),
        F.expr("sum(_w * _w)").alias("_w2"),
        F.max("_fpc").alias("_fpc"),
    )


def _by_group(types: DataFrame, by: Sequence[Breakdown]) -> DataFrame:
    """Sums per table, group, stratum and answer, for rows in the domain."""
    levels = [F.col(f"_b{i}") for i in range(len(by))]
    group = F.explode(F.array_distinct(F.array(F.lit(0), *levels)))
    return types.filter("_x <> ''").withColumn("_g", group).groupBy("_tab", "_g", "_h", "_x").agg(
        F.sum("_n").alias("_n"), F.sum("_w").alias("_a"), F.sum("_w2").alias("_a2"))


def _cells(grouped: DataFrame, stat: str) -> DataFrame:
    """One row per table, group and answer, with its score constants.

    The score of a row in the group is ``(hit - _p) * _iw``.
    """
    base = Window.partitionBy("_tab", "_g")
    cells = grouped.groupBy("_tab", "_g", "_x").agg(
        F.sum("_n").alias("unwn"), F.sum("_a").alias("n")).withColumn(
        "_base", F.sum("n").over(base)).withColumn("p", F.expr("try_divide(n, _base)"))
    if stat == "total":
        return cells.withColumns({"_p": F.lit(0.0), "_iw": F.lit(1.0)})
    return cells.withColumns({"_p": F.col("p"), "_iw": F.expr("try_divide(1D, _base)")})


def _stratum_scores(grouped: DataFrame, cells: DataFrame, types: DataFrame,
                    stratified: bool) -> DataFrame:
    """Per cell and stratum: mean score, and sums of scores and their squares."""
    strata = types.groupBy("_tab", "_h").agg(F.sum("_w").alias("_c"), F.sum("_w2").alias("_c2"))
    in_group = grouped.groupBy("_tab", "_g", "_h").agg(
        F.sum("_a").alias("_b"), F.sum("_a2").alias("_b2"))
    hits = grouped.select("_tab", "_g", "_h", "_x", "_a", "_a2")
    pairs = (
        in_group.join(cells.select("_tab", "_g", "_x", "_p", "_iw"), ["_tab", "_g"])
        .join(hits, ["_tab", "_g", "_h", "_x"], "left")
        .join(strata, ["_tab", "_h"])
        .fillna(0.0, ["_a", "_a2"])
        .withColumn("_score", F.expr("_iw * (_a - _p * _b)"))
    )
    mean = F.expr("try_divide(_score, _c)") if stratified else F.lit(0.0)
    return pairs.withColumn("_zb", mean).select(
        "_tab", "_g", "_h", "_x", "_zb",
        F.expr("_score - _zb * _c").alias("_s"),
        F.expr("_iw * _iw * (_a2 * (1 - _p) * (1 - _p) + (_b2 - _a2) * _p * _p)"
               " - 2 * _zb * _iw * (_a2 * (1 - _p) - (_b2 - _a2) * _p)"
               " + _zb * _zb * _c2").alias("_ss"))


def _units_of_rows(types: DataFrame, grouped: DataFrame, scores: DataFrame) -> DataFrame:
    """Sums over sampling units when every row is its own unit."""
    units = types.groupBy("_tab").agg(F.sum("_n").alias("_m"))
    seen = grouped.groupBy("_tab", "_g").agg(F.sum("_n").alias("_seen"))
    sums = scores.groupBy("_tab", "_g", "_x").agg(F.sum("_s").alias("_s"), F.sum("_ss").alias("_ss"))
    return sums.join(units, "_tab").join(seen, ["_tab", "_g"])


def _score_lookup(types: DataFrame, cells: DataFrame, scores: DataFrame, size: int,
                  stat: str) -> DataFrame:
    """Score constants per table, stratum and answer, as arrays over the groups.

    Of two answers only the first is kept: the scores of the other are the
    same with the opposite sign. The lists collected here have one entry per
    group of the table.
    """
    def dense(column: str) -> Column:
        return F.expr(
            f"transform(sequence(0, {size - 1}), g -> coalesce(try_element_at(_m, g).{column}, 0D))")

    strata = types.select("_tab", "_h").distinct()
    constants = cells.groupBy("_tab", "_x").agg(
        F.expr("map_from_entries(collect_list(struct(_g, struct(_p, _iw))))").alias("_m"))
    constants = constants.select("_tab", "_x", dense("_p").alias("_p"), dense("_iw").alias("_iw"))
    if stat == "proportion":
        each = Window.partitionBy("_tab")
        constants = constants.withColumns({
            "_k": F.count(F.lit(1)).over(each), "_first": F.min("_x").over(each),
        }).filter("_k > 2 or _x = _first").drop("_k", "_first")
    means = scores.groupBy("_tab", "_h", "_x").agg(
        F.expr("map_from_entries(collect_list(struct(_g, struct(_zb))))").alias("_m"))
    means = means.select("_tab", "_h", "_x", dense("_zb").alias("_zb"))
    none = F.expr(f"array_repeat(0D, {size})")
    return strata.join(constants, "_tab").join(means, ["_tab", "_h", "_x"], "left").select(
        "_tab", "_h", F.col("_x").alias("_k"), "_p", "_iw", F.coalesce("_zb", none).alias("_zb"))


def _units_of_clusters(people: DataFrame, types: DataFrame, lookup: DataFrame, tables: int,
                       by: Sequence[Breakdown], df_from: str) -> DataFrame:
    """Sums over sampling units, each the total of its rows' scores."""
    crowds = stage(
        people.groupBy(F.col("_psu").alias("_crowd")).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > CROWD).select("_crowd"), "crowded-units")
    if crowds.isEmpty():
        units = _unit_sums(_dealt_by_unit(people, types, tables, by), lookup, tables, by, df_from)
    else:
        of_crowd = F.col("_psu").eqNullSafe(F.col("_crowd"))
        usual = _dealt_by_unit(people.join(crowds, of_crowd, "left_anti"), types, tables, by)
        crowded = people.join(crowds, of_crowd, "left_semi")
        units = _unit_sums(usual, lookup, tables, by, df_from).unionByName(
            _unit_sums(crowded, lookup, tables, by, df_from))
    size = len(_groups(by))
    flagged = range(size) if df_from == "group" else range(1)
    sums = units.groupBy("_tab", "_k").agg(
        F.count(F.lit(1)).alias("_m"),
        *[F.expr(f"struct({g} as _g, sum(_f{g if g in flagged else 0}) as _seen, "
                 f"sum(_t{g}) as _s, sum(_t{g} * _t{g}) as _ss) as _r{g}") for g in range(size)])
    every = ", ".join(f"_r{g}" for g in range(size))
    return sums.select("_tab", F.col("_k").alias("_from"), "_m", F.expr(f"inline(array({every}))"))


def _unit_sums(people: DataFrame, lookup: DataFrame, tables: int, by: Sequence[Breakdown],
               df_from: str) -> DataFrame:
    """Per unit, table and answer: the score by group, and whether the unit is in the group."""
    inside = ["_x <> ''"] + [
        f"(_x <> '' and _b{i} = {{g}})" for i, b in enumerate(by) for _ in b.levels]
    inside = [text.format(g=g) for g, text in enumerate(inside)]
    rows = _by_table(people, tables)
    scored = rows.join(lookup, ["_tab", "_h"]).withColumn("_hit", F.expr("if(_x = _k, 1D, 0D)"))
    score = "sum(_w * (if({i}, (_hit - _p[{g}]) * _iw[{g}], 0D) - _zb[{g}])) as _t{g}"
    size = len(inside)
    flagged = range(size) if df_from == "group" else range(1)
    return scored.groupBy("_psu", "_tab", "_k").agg(
        *[F.expr(score.format(i=inside[g], g=g)) for g in range(size)],
        *[F.expr(f"max(if({inside[g]}, 1, 0)) as _f{g}") for g in flagged])


def _mirror(units: DataFrame, cells: DataFrame) -> DataFrame:
    """Unit sums for every cell, the left-out one of two answers included."""
    answers = cells.select("_tab", "_x").distinct()
    each = Window.partitionBy("_tab")
    source = answers.withColumns({
        "_k": F.count(F.lit(1)).over(each), "_first": F.min("_x").over(each),
    }).select("_tab", "_x", F.expr("if(_k > 2, _x, _first)").alias("_from"))
    return units.join(source, ["_tab", "_from"]).drop("_from")


def _left_out(design: SurveyDesign) -> str:
    """Share of the population that was not sampled."""
    if design.fpc is None:
        return "1D"
    return "(1 - _m / _fpc)" if design.fpc_kind == "size" else "(1 - _fpc)"


def estimate_many(
    design: SurveyDesign,
    questions: Sequence[Question],
    by: Sequence[Breakdown] = (),
    stat: str = "proportion",
    df_from: str = "design",
) -> DataFrame:
    """Cells of all tables: weighted total, share, standard error, and df.

    ``tab`` numbers the questions from 1. ``stat`` is what ``se`` belongs to:
    the ``"proportion"`` of the answer within its group, or the ``"total"``.
    ``df_from="group"`` counts the sampling units of each group for the
    degrees of freedom instead of those of the whole domain.
    """
    people = _people(design, questions, by)
    types = stage(type_table(_by_table(people, len(questions)), by), "types")
    grouped = _by_group(types, by)
    cells = _cells(grouped, stat)
    scores = _stratum_scores(grouped, cells, types, design.stratum is not None)
    groups = _groups(by)
    if design.psu is None:
        units = _units_of_rows(types, grouped, scores)
        if df_from == "design":
            whole = units.filter("_g = 0").select("_tab", "_x", F.col("_seen").alias("_all"))
            whole = whole.groupBy("_tab").agg(F.max("_all").alias("_all"))
            units = units.join(whole, "_tab").withColumn("_seen", F.col("_all")).drop("_all")
    else:
        lookup = stage(_score_lookup(types, cells, scores, len(groups), stat), "scores")
        units = _units_of_clusters(people, types, lookup, len(questions), by, df_from)
        if stat == "proportion":
            units = _mirror(units, cells)
        else:
            units = units.withColumnRenamed("_from", "_x")
    fpc = types.groupBy("_tab").agg(F.max("_fpc").alias("_fpc"))
    names = F.array(*[F.struct(F.lit(a).alias("by"), F.lit(b).alias("level")) for a, b in groups])
    orders = F.array(*[
        F.array(*[F.lit(text) for text in level_order(design.df, q.x)] or [F.lit("")])
        for q in questions])
    rank = F.array_position(F.element_at(orders, F.col("_tab")), F.col("answer"))
    variance = f"{_left_out(design)} * try_divide(_m, _m - 1) * greatest(_ss - _s * _s / _m, 0D)"
    out = (
        cells.join(units, ["_tab", "_g", "_x"]).join(fpc, "_tab")
        .withColumn("answer", F.expr("substring(_x, 2)"))
        .withColumn("_rank", F.when(rank > 0, rank))
        .withColumn("_name", F.get(names, F.col("_g")))
    )
    order = Window.partitionBy("_tab").orderBy(F.col("_rank").asc_nulls_last(), "answer")
    return out.select(
        F.col("_tab").alias("tab"),
        F.col("_name.by").alias("breakdown"), F.col("_name.level").alias("level"),
        F.dense_rank().over(order).alias("answer_no"), "answer", "n", "unwn", "p",
        F.expr(f"sqrt({variance})").alias("se"),
        F.expr("cast(_seen - 1 as bigint)").alias("df"))


def estimate(design: SurveyDesign, x: str, by: Sequence[Breakdown] = (),
             stat: str = "proportion", df_from: str = "design") -> DataFrame:
    """Cells of a single table."""
    return estimate_many(design, [Question(x)], by, stat, df_from).drop("tab")


def with_limits(cells: DataFrame, method: str = "logit") -> DataFrame:
    """Add the 95 % limits ``low`` and ``upp`` of the proportion."""
    limits = logit_limits if method == "logit" else mean_limits
    low, upp = limits(F.col("p"), F.col("se"), t_975(F.col("df")))
    return cells.withColumns({"low": low, "upp": upp})


def design_total(design: SurveyDesign) -> DataFrame:
    """Weighted size of the design's domain with its standard error."""
    whole = design.with_columns({"_all": F.lit("all")})
    return estimate(whole, "_all", stat="total").select("n", "unwn", "se")
