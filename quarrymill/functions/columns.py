"""Columns and identifiers by exact name, whatever characters the name has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def exact(name: str) -> Column:
    """The column of that name; dots in it do not reach into structs."""
    return F.col(quoted(name))
