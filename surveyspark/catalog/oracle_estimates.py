"""Brute-force SQL for design-based estimates: every row against every cell."""

from __future__ import annotations

from collections.abc import Sequence

from surveyspark.catalog.views import FINE, text_of, with_views

Group = tuple[str, str]

SEX = [("R02", "Female"), ("R02", "Male")]
AGE = [("R03cat", t) for t in FINE]
DIS = [("DISABILITY3", "Without disability"), ("DISABILITY3", "With disability")]
PERSON = SEX + AGE + DIS
HOUSEHOLD = (
    [("headHHR02", v) for _, v in SEX] + [("headHHR03cat", v) for _, v in AGE]
    + [("hhdisability3", v) for _, v in DIS]
)
AGE_TEXT = text_of("R03cat", {str(i): t for i, t in enumerate(FINE, start=1)})
DIS_TEXT = text_of("DISABILITY3", {"0": "Without disability", "1": "With disability", "98": "Unknown"})

# 97.5 % t quantile by expansion in 1/df; the designs have thousands of units.
_Z = 1.959963984540054
_T = (
    f"({_Z} + {(_Z**3 + _Z) / 4} / df + {(5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96} / (df * df)"
    f" + {(3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384} / (df * df * df))"
)

MEMBER_PS = ("member_ps", "weight_ps", "_parent_index", "originAgeSex_ps", "fpc")
MEMBER_BASE = ("member_base", "dweight", "_parent_index", None, "fpc")
ADULT_PS = ("adult_ps", "weight_ps", "_index", "originSex_ps", "fpc")
ADULT_BASE = ("adult_base", "dweight", "_index", None, "fpc")


def person_rows(design: tuple, x: str, domain: str = "true", tab: int = 1) -> str:
    """Rows of a design with the answer and the three usual breakdowns."""
    table, weight, psu, stratum, fpc = design
    return (
        f"SELECT {tab} AS tab, {psu} AS psu, {weight} AS w, {stratum or 'NULL'} AS h, {fpc} AS f,\n"
        f"  CASE WHEN {domain} THEN {x} END AS x,\n"
        f"  R02 AS b1, {AGE_TEXT} AS b2, {DIS_TEXT} AS b3 FROM {table}"
    )


def estimate_views(rows: str, groups: Sequence[Group], stat: str = "proportion") -> dict[str, str]:
    """Views ``est`` and ``lim``: a row per cell with n, unwn, p, se, df (, low, upp).

    The rows hold one column b1, b2, ... per breakdown, in order of first use.
    """
    breakdowns = list(dict.fromkeys(b for b, _ in groups))
    values = ", ".join(
        ["(0, 'Total', 'Total')"]
        + [f"({i}, '{b}', '{v}')" for i, (b, v) in enumerate(groups, start=1)])
    inside = " OR ".join(
        ["grp.breakdown = 'Total'"]
        + [f"(grp.breakdown = '{b}' AND rws.b{i} = grp.level)"
           for i, b in enumerate(breakdowns, start=1)])
    hit = "(m.x = s.x)::int"
    score = f"({hit} - s.p) / s.base" if stat == "proportion" else hit
    logit = f"ln(p / (1 - p)) {{}} {_T} * se / (p * (1 - p))"
    limit = "CASE WHEN p >= 1 THEN p ELSE 1 / (1 + exp(-(" + logit + "))) END"
    return {
        "rws": f"SELECT row_number() OVER () AS id, * FROM ({rows})",
        "grp": f"SELECT * FROM (VALUES {values}) AS t(g, breakdown, level)",
        "hits": f"SELECT id, tab, g, x, w FROM rws JOIN grp ON ({inside}) WHERE x IS NOT NULL",
        "cells": "SELECT tab, g, x, sum(w) AS n, count(*) AS unwn, "
                 "sum(sum(w)) OVER (PARTITION BY tab, g) AS base FROM hits GROUP BY tab, g, x",
        "shares": "SELECT *, row_number() OVER () AS cell, n / base AS p FROM cells",
        "zs": f"SELECT r.psu, r.h, r.w, s.cell, CASE WHEN m.id IS NULL THEN 0 ELSE {score} END AS z\n"
              "FROM rws r JOIN shares s ON r.tab = s.tab\n"
              "LEFT JOIN hits m ON m.id = r.id AND m.g = s.g",
        "zbar": "SELECT cell, h, sum(w * z) / sum(w) AS zb FROM zs WHERE h IS NOT NULL GROUP BY cell, h",
        "units": "SELECT psu, cell, sum(w * (z - coalesce(zb, 0))) AS e\n"
                 "FROM zs LEFT JOIN zbar USING (cell, h) GROUP BY psu, cell",
        "spread": "SELECT cell, count(*)::double AS m, sum(e * e) - sum(e) * sum(e) / count(*) AS ss "
                  "FROM units GROUP BY cell",
        "dfs": "SELECT tab, count(DISTINCT psu) - 1 AS df FROM rws WHERE x IS NOT NULL GROUP BY tab",
        "fs": "SELECT tab, max(f) AS f FROM rws GROUP BY tab",
        "est": "SELECT s.tab, grp.breakdown, grp.level, s.x AS answer, s.n, s.unwn, s.p, df,\n"
               "  sqrt((1 - f) * m / (m - 1) * greatest(ss, 0)) AS se\n"
               "FROM shares s JOIN spread USING (cell) JOIN grp USING (g)\n"
               "JOIN dfs USING (tab) JOIN fs USING (tab)",
        "lim": f"SELECT *, {limit.format('-')} AS low, {limit.format('+')} AS upp FROM est",
    }


def cells_sql(rows: str, groups: Sequence[Group], columns: str, stat: str = "proportion") -> str:
    source = "lim" if "low" in columns else "est"
    return with_views(f"SELECT {columns} FROM {source}", estimate_views(rows, groups, stat))


def report_sql(rows: str, groups: Sequence[Group], heads: str, order: str, order_by_tab: bool,
               extra: dict[str, str] | None = None) -> str:
    """Wide report rows from long cells.

    ``heads`` is a VALUES list (tab, indicator, unit, question), ``order`` a
    VALUES list (tab, answer, place).
    """
    levels = [v for _, v in groups]

    def cell(value: str, level: str) -> str:
        return f"max({value}) FILTER (level = '{level}')"

    wide = [f'round({cell("p", "Total")}, 6) AS "Total"', f'round({cell("low", "Total")}, 6) AS "low"',
            f'round({cell("upp", "Total")}, 6) AS "upp"']
    base_w, base_u = ['round(sum(n) FILTER (level = \'Total\'), 4) AS "Total", NULL AS "low", NULL AS "upp"'], [
        "sum(unwn) FILTER (level = 'Total')::double AS \"Total\", NULL AS \"low\", NULL AS \"upp\""]
    for v in levels:
        wide += [f'round({cell("p", v)}, 6) AS "{v}"', f'round({cell("low", v)}, 6) AS "low_{v}"',
                 f'round({cell("upp", v)}, 6) AS "upp_{v}"']
        base_w.append(f"coalesce(round(sum(n) FILTER (level = '{v}'), 4), 0) AS \"{v}\", "
                      f'NULL AS "low_{v}", NULL AS "upp_{v}"')
        base_u.append(f"coalesce(sum(unwn) FILTER (level = '{v}'), 0)::double AS \"{v}\", "
                      f'NULL AS "low_{v}", NULL AS "upp_{v}"')
    views = {**(extra or {}), **estimate_views(rows, groups)}
    views["ranks"] = (
        "SELECT tab, answer, row_number() OVER (PARTITION BY tab ORDER BY place NULLS LAST, answer) AS row_no\n"
        f"FROM (SELECT DISTINCT tab, answer FROM lim) LEFT JOIN (VALUES {order}) AS o(tab, answer, place)\n"
        "  USING (tab, answer)")
    views["heads"] = f"SELECT * FROM (VALUES {heads}) AS t(tab, indicator, unit, question)"
    first = (
        "SELECT tab, cast(row_no AS int) AS row_no, CASE WHEN row_no = 1 THEN any_value(indicator) ELSE '' END AS \"Indicator\",\n"
        "  CASE WHEN row_no = 1 THEN any_value(unit) ELSE '' END AS \"Unit of analysis\",\n"
        "  CASE WHEN row_no = 1 THEN any_value(question) ELSE '' END AS \"Question\",\n"
        f"  answer AS \"Answers\", round({cell('n', 'Total')}, 4) AS n,\n  " + ",\n  ".join(wide)
        + "\nFROM lim JOIN ranks USING (tab, answer) JOIN heads USING (tab) GROUP BY tab, row_no, answer")

    def base(no: int, text: str, total: str, columns: list[str]) -> str:
        return (f"SELECT tab, {1000000 + no} AS row_no, '' , '', '', '{text}', {total}, "
                + ", ".join(columns) + " FROM lim GROUP BY tab")

    body = "\nUNION ALL\n".join([
        first,
        base(1, "SAMPLE SIZE WEIGHTED TO POPULATION",
             "round(sum(n) FILTER (level = 'Total'), 4)", base_w),
        base(2, "UNWEIGHTED SAMPLE SIZE", "sum(unwn) FILTER (level = 'Total')::double", base_u),
    ])
    keep = "*" if order_by_tab else "* EXCLUDE (tab)"
    return with_views(f"SELECT {keep} FROM ({body})", views)
