"""Prompt templates with ``{name}`` fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKENS = r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"
FIELD = r"^\{[^{}]*\}$"


def template_tokens(template: Column) -> Column:
    """The template cut into literals, fields and escaped braces."""
    return F.regexp_extract_all(template, F.lit(f"(?s){_TOKENS}"), F.lit(0))


def unknown_fields(tokens: Column, names: list[str]) -> Column:
    """Fields of the template, or stray braces, that no value is given for."""
    known = [f"{{{n}}}" for n in names]
    return F.filter(
        tokens, lambda t: (t.rlike(FIELD) & ~t.isin(known)) | t.isin("{", "}")
    )


def render(tokens: Column, values: dict[str, Column]) -> Column:
    """Fill the fields in one pass, so braces inside values are never substituted."""

    def piece(token: Column) -> Column:
        text = F.when(token == "{{", F.lit("{")).when(token == "}}", F.lit("}"))
        for name, value in values.items():
            text = text.when(token == f"{{{name}}}", value.cast("string"))
        return text.otherwise(token)

    return F.array_join(F.transform(tokens, piece), "")
