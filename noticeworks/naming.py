"""Names of working columns that a caller's columns can't meet. Spark's names know no case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns, like the given ones, that df doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        k = 0
        while (found := f"_{name}{k or ''}").lower() in taken:
            k += 1
        taken.add(found.lower())
        out.append(found)
    return out


def others(df: DataFrame, *made: str) -> list[str]:
    """df's columns whose names differ from all of `made` in more than case."""
    taken = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in taken]


def bundled(df: DataFrame, columns: list[str]) -> Column:
    """The columns as one, named row, so that none meets a working name; unbundled() gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(0).alias("")).alias("row")


def unbundled(columns: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in columns]
