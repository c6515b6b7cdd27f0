"""Whitespace-exact text expressions.

Model output and prompts are written by Python programs, so "whitespace" and
"line" mean what Python's ``str`` methods mean by them, not Java's regex classes.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set, its complement and all decimal digits under Java's (?U) flag. Spelling
# the characters out instead makes matching ten times slower.
SPACE = r"[\s\x1c-\x1f]"
NON_SPACE = r"[^\s\x1c-\x1f]"
# The line boundaries of Python's str.splitlines().
LINE_BREAK = r"[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029](?:(?<=\r)\n)?"


def strip(text: Column) -> Column:
    """Remove whitespace from both ends; touches only the ends of the string."""
    return F.btrim(text, F.lit(WHITESPACE))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(text, F.lit(f"(?U){NON_SPACE}+"))


def has_min_words(text: Column, n: int) -> Column:
    """True if the text has at least ``n`` words.

    The anchored possessive pattern stops at the n-th word, so a long document
    costs no more than a short one.
    """
    if n <= 0:
        return text.isNotNull()
    words_before = rf"(?:{NON_SPACE}++{SPACE}++){{{n - 1}}}"
    return text.rlike(rf"(?U)\A{SPACE}*+{words_before}{NON_SPACE}")


def words(text: Column) -> Column:
    """Array of the lower-cased words of the text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"(?U){NON_SPACE}+"), F.lit(0))


def split_lines(text: Column) -> Column:
    """Lines of the text without their terminators; a final terminator adds none."""
    parts = F.split(text, LINE_BREAK)
    return F.when(
        F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
    ).otherwise(parts)


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of the group, NULL where the pattern does not match."""
    return none_if_empty(F.regexp_extract(text, pattern, group))
