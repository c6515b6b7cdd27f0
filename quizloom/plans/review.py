"""Shuffled review sheets of parsed questions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.mcq import parse_mcq
from quizloom.operators.columns import with_computed
from quizloom.operators.numbering import shuffle_key
from quizloom.operators.storage import materialise


def parsed_questions(questions: DataFrame) -> DataFrame:
    """``file_path, pos`` and the parsed fields; texts that do not parse drop out."""
    parsed = with_computed(questions, "mcq", parse_mcq(F.col("q_raw")))
    return parsed.filter(F.col("mcq").isNotNull()).select("file_path", "pos", "mcq.*")


def widest(parsed: DataFrame) -> DataFrame:
    """One row: the largest number of options."""
    return parsed.agg(F.max(F.size("options")).alias("max_options"))


def row_key():
    """Text that identifies a question in a shuffle."""
    return F.concat_ws("#", F.col("file_path"), F.col("pos").cast("string"))


def widen(parsed: DataFrame, width: int, *keep: str) -> DataFrame:
    """Sheet columns: the question, ``width`` options padded with '', the answer."""
    options = [
        F.coalesce(F.get("options", F.lit(i)), F.lit("")).alias(f"Option {i + 1}")
        for i in range(width)
    ]
    return parsed.select(
        *keep,
        F.col("question").alias("Question Text"),
        *options,
        F.col("answer_text").alias("Answer Text"),
        F.col("answer_number").alias("Answer Number"),
    )


def _cell(text: Column) -> Column:
    """A CSV cell: quoted, with quotes doubled, only where it must be."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def sheet_line(width: Column) -> Column:
    """The CSV line of a parsed question, with options padded to ``width`` cells."""
    padding = F.array_repeat(F.lit(""), width - F.size("options"))
    cells = F.concat(
        F.array("question"),
        "options",
        padding,
        F.array("answer_text", F.coalesce(F.col("answer_number").cast("string"), F.lit(""))),
    )
    return F.array_join(F.transform(cells, _cell), ",")


def sheet_header(width: Column) -> Column:
    options = F.transform(
        F.sequence(F.lit(1), F.greatest(width, F.lit(1))),
        lambda i: F.concat(F.lit("Option "), i.cast("string")),
    )
    options = F.slice(options, F.lit(1), width)
    cells = F.concat(
        F.array(F.lit("Question Text")), options, F.array(F.lit("Answer Text"), F.lit("Answer Number"))
    )
    return F.array_join(cells, ",")


def review_sheet(questions: DataFrame, seed: int | str = 0) -> DataFrame:
    """CSV lines of all parsed questions in a seeded random order, the header first.

    The order depends on the seed and the row keys alone. The sheet is as wide as its
    widest question, but a line is one text: the width is data, not schema. Parsed rows
    are stored first, as the width, the sort's sampling and the sort each read them.
    """
    parsed = materialise(parsed_questions(questions))
    width = F.lit(widest(parsed).first()["max_options"] or 0)
    lines = parsed.select(
        shuffle_key(seed, row_key()).alias("_order"),
        row_key().alias("_key"),
        sheet_line(width).alias("line"),
    )
    header = parsed.sparkSession.range(1).select(
        F.lit("").alias("_order"), F.lit("").alias("_key"), sheet_header(width).alias("line")
    )
    return header.unionByName(lines).orderBy("_order", "_key").select("line")
