"""Columns for work that is expensive per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is evaluated exactly once per row.

    A plain projection is inlined into the filters and columns that use it, so a
    regex over a whole text would run for each of them. A one-row generator is not.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def free_name(columns: list[str], name: str) -> str:
    """``name``, made longer until it is none of the ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
