"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks import naming
from noticeworks.naming import bundled, others, unbundled  # noqa: F401  columns whose names may clash
from noticeworks.staging import discard  # noqa: F401  deletes such a table
from noticeworks.staging import staged as written  # noqa: F401  a table in the shared folder

#: Fixed value: the white space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(df: DataFrame, name: str) -> str:
    """A name for a working column that df doesn't have."""
    return naming.unused(df, name)[0]
