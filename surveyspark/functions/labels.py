"""Value and variable labels, kept in the column metadata.

Metadata survives filters, joins, unions and Parquet, but any new expression
on a column drops it. Derivations therefore attach labels as their last step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(
    c: Column, name: str, labels: Mapping[Any, str] | None = None, label: str = ""
) -> Column:
    """Name a column and attach its variable label and value labels."""
    meta: dict[str, Any] = {"label": label}
    if labels:
        meta["codes"] = [str(code) for code in labels]
        meta["texts"] = list(labels.values())
    return c.alias(name, metadata=meta)


def attach(df: DataFrame, name: str, labels: Mapping[Any, str] | None = None,
           label: str = "") -> DataFrame:
    """Attach labels to an existing column."""
    meta = labelled(F.col(name), name, labels, label)
    return df.select(*[meta if c == name else F.col(f"`{c}`") for c in df.columns])


def value_labels(df: DataFrame, name: str) -> dict[str, str]:
    meta = df.schema[name].metadata
    return dict(zip(meta.get("codes", []), meta.get("texts", [])))


def variable_label(df: DataFrame, name: str) -> str:
    return df.schema[name].metadata.get("label", "")


def level_order(df: DataFrame, name: str) -> list[str]:
    """Category texts in label order (also after decoding)."""
    return list(df.schema[name].metadata.get("texts", []))


def quoted(text: str) -> str:
    """Text as a SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def decode(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Replace codes by their texts in every labelled column.

    A code without a text is kept as it is. The decoded column remembers the
    order of its texts, so that reports can list them in questionnaire order.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        wanted = names is None or field.name in names
        codes, texts = field.metadata.get("codes"), field.metadata.get("texts")
        if not (wanted and codes):
            out.append(col)
            continue
        code = f"CAST(`{field.name}` AS STRING)"
        whens = " ".join(f"WHEN {quoted(c)} THEN {quoted(t)}" for c, t in zip(codes, texts))
        meta = {"label": field.metadata.get("label", ""), "texts": texts}
        out.append(F.expr(f"CASE {code} {whens} ELSE {code} END").alias(field.name, metadata=meta))
    return df.select(*out)


def decode_from(df: DataFrame, names: Sequence[str], table: DataFrame, code: str, text: str,
                extra: Mapping[str, str] | None = None) -> DataFrame:
    """Replace codes by texts of a label table, for columns with too many codes to spell out.

    ``extra`` adds texts of codes that stand for no entry. A code without a text is kept as
    it is; of several texts of a code the first in order counts. Each column is one join,
    which the planner broadcasts when the table's bytes allow. Labels of the columns stay.
    """
    lookup = table.groupBy(F.col(code).cast("string").alias("_code")).agg(F.min(text).alias("_text"))
    out = df
    for name in names:
        value = F.col(f"`{name}`").cast("string")
        fixed = F.lit(None).cast("string")
        for c, t in (extra or {}).items():
            fixed = F.when(value == c, t).otherwise(fixed)
        meta = {"label": df.schema[name].metadata.get("label", "")}
        out = (out.join(lookup, value == F.col("_code"), "left")
               .withColumn(name, F.coalesce("_text", fixed, value).alias(name, metadata=meta)).drop("_code", "_text"))
    return out.select(*[f"`{c}`" for c in df.columns])
