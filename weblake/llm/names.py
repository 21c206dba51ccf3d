"""Column names that clash with none of a table's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_prefix(df: DataFrame, wanted: str) -> str:
    """`wanted`, with as many underscores before it as no column of `df` begins with, in whatever case."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(wanted.lower()) for c in taken):
        wanted = "_" + wanted
    return wanted
