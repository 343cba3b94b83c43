"""Separating rows that break an output constraint from those that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reason(columns: set[str]) -> Column:
    """The first broken rule, or NULL. Rules on absent columns do not apply."""
    rules: list[tuple[str, str, Column]] = [
        ("days_to_expiration", "negative days_to_expiration", F.col("days_to_expiration") < 0),
        ("expiration_date", "missing expiration_date", F.col("expiration_date").isNull()),
    ]
    if "similarity_score" in columns:
        rules.append(("similarity_score", "similarity_score out of range",
                      ~F.col("similarity_score").between(0.0, 100.0)))
    if "possible_matches" in columns:
        rules.append(("possible_matches", "invalid possible match", F.exists(
            "possible_matches",
            lambda m: m["expiration_date"].isNull() | (m["days_to_expiration"] < 0)
            | ~m["similarity_score"].between(0.0, 100.0))))
    out = None
    for _, text, broken in (r for r in rules if r[0] in columns):
        out = F.when(broken, text) if out is None else out.when(broken, text)
    return out


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reason``). One bad row never costs its source the rest."""
    checked = df.withColumn("reason", _reason(set(df.columns)))
    return checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL")
