"""Missing-value rules of survey answers, as Spark columns.

Survey code treats a missing answer in ways that differ from SQL: a missing
value is simply "not in" a list, a strict count over a group with a missing
condition is itself missing, a horizontal sum skips missing cells. Each rule
has one helper here, so that no caller relies on the SQL default by accident.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_set(c: Column | str, values: Iterable[str]) -> Column:
    """Membership that is FALSE, never NULL, for a missing value."""
    return F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def strict_sum(condition: Column) -> Column:
    """Count of true conditions; NULL as soon as one condition is NULL."""
    hits = F.sum(condition.cast("long"))
    return F.when(F.count(condition) == F.count(F.lit(1)), hits)


def skip_sum(condition: Column) -> Column:
    """Count of true conditions, missing ones skipped."""
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0).cast("long"))


def sum_or_zero(c: Column | str) -> Column:
    """Group sum that is 0 for a group without any value."""
    c = as_col(c)
    return F.coalesce(F.sum(c), F.lit(0))


def row_sum(columns: Iterable[Column | str]) -> Column:
    """Horizontal sum, missing cells counted as 0."""
    cells = [F.coalesce(as_col(c), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, cells)


def any_equal(columns: Iterable[Column | str], code: str) -> Column:
    """Three-valued OR of ``column = code``."""
    return reduce(lambda a, b: a | b, [as_col(c) == code for c in columns])


def all_in(columns: Iterable[Column | str], codes: Iterable[str]) -> Column:
    codes = list(codes)
    return reduce(lambda a, b: a & b, [in_set(c, codes) for c in columns])


def count_in(columns: Iterable[Column | str], codes: Iterable[str]) -> Column:
    """How many of the columns hold one of the codes (0 when all missing)."""
    codes = list(codes)
    return reduce(
        lambda a, b: a + b, [in_set(c, codes).cast("int") for c in columns]
    )


def if_else_na(condition: Column, yes: Any, no: Any) -> Column:
    """Two-way choice that stays NULL when the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def unite(*parts: Column | str, sep: str = "_") -> Column:
    """Paste parts into a text key; a missing part is spelled ``NA``.

    Numeric key parts must be integral: a double would be pasted as ``5.0``.
    """
    texts = [F.coalesce(as_col(p).cast("string"), F.lit("NA")) for p in parts]
    return F.concat_ws(sep, *texts)


def cut(c: Column | str, upper_bounds: Sequence[float], labels: Sequence[Any]) -> Column:
    """Right-closed bins: label i covers (bound i-1, bound i].

    ``upper_bounds`` starts with the exclusive lower limit; the last bin is
    open to the right when one label more than bounds - 1 is given.
    """
    c = as_col(c)
    low, *uppers = upper_bounds
    out = F.when(c <= low, F.lit(None))
    for upper, label in zip(uppers, labels):
        out = out.when(c <= upper, F.lit(label))
    if len(labels) == len(uppers) + 1:
        out = out.when(c.isNotNull(), F.lit(labels[-1]))
    return out


def recode(c: Column | str, mapping: Mapping[str, Any]) -> Column:
    """Replace codes by a fixed mapping; anything else becomes NULL."""
    c = as_col(c).cast("string")
    groups: dict[Any, list[str]] = {}
    for code, target in mapping.items():
        groups.setdefault(target, []).append(code)
    out = None
    for target, codes in groups.items():
        hit = c.isin(codes)
        out = F.when(hit, F.lit(target)) if out is None else out.when(hit, F.lit(target))
    return out


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; NULL for a zero denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def number(c: Column | str) -> Column:
    """Text answer to double; NULL where it is not a number."""
    return as_col(c).cast("string").try_cast("double")
