"""Identifiers of taxonomy leaves."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator that ends the identifying part of a topic, and the
# sign that does not appear in identifiers.
TOPIC_SEPARATOR = " \u2013 "
SECTION_SIGN = "\u00a7"


def leaf_id(domain: Column, category: Column, topic: Column, legacy: bool = False) -> Column:
    """``domain.category.topic``, spaces removed, topic up to the first separator.

    ``legacy`` keeps the category's spaces and the topic's section signs; the two
    forms give different ids for the same leaf.
    """
    head = F.replace(
        F.substring_index(topic, TOPIC_SEPARATOR, 1), F.lit(" "), F.lit("")
    )
    if not legacy:
        head = F.replace(head, F.lit(SECTION_SIGN), F.lit(""))
        category = F.replace(category, F.lit(" "), F.lit(""))
    return F.concat(domain, F.lit("."), category, F.lit("."), head)


def leaf_label(taxonomy_id: Column) -> Column:
    """Last dot-separated part of an id."""
    return F.substring_index(taxonomy_id, ".", -1)


def query_terms(label: Column, synonyms: Column | None = None) -> Column:
    """The label followed by its synonyms, if the leaf has any."""
    if synonyms is None:
        return F.array(label)
    return F.concat(F.array(label), F.coalesce(synonyms, F.array().cast("array<string>")))
