"""Text rules that the operators share."""

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The characters that separate words and are stripped from lines.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = rf"[^{SPACE_CLASS}]+"
WORD_RE = re.compile(WORD)


def single_spaced(text: Column) -> Column:
    """Each run of separators as one space; NULL counts as empty.

    Lone spaces are left out of the pattern: replacing them changes nothing.
    """
    runs = rf"[\x09-\x0D][{SPACE_CLASS}]*|\x20[{SPACE_CLASS}]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def with_fields(schema: StructType, fields: dict[str, str]) -> StructType:
    """A new schema with further fields, given as name to type."""
    longer = StructType(list(schema.fields))
    for name, kind in fields.items():
        longer.add(name, kind)
    return longer


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, *replaced: str) -> list[Column]:
    """All columns of ``df`` but those named like a result column."""
    out = {name.lower() for name in replaced}
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in out]


def hide(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable]:
    """``df`` whose columns but the ``needed`` ones have names that clash with nothing, and a
    function that gives rows made of it their names back, in the order of ``df``.

    The function takes the names of result columns, which come last; columns of ``df`` with
    such a name are left out.
    """
    names = {c: c if c.lower() in needed else f"user_column_{i}" for i, c in enumerate(df.columns)}
    hidden = df.select(*[F.col(quoted(c)).alias(name) for c, name in names.items()])

    def show(rows: DataFrame, *added: str) -> DataFrame:
        new = {name.lower() for name in added}
        own = [F.col(name).alias(c) for c, name in names.items() if c.lower() not in new]
        return rows.select(*own, *[F.col(name) for name in added])

    return hidden, show
