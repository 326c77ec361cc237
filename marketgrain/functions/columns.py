"""Columns by their literal name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal_column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col(quoted(name))
