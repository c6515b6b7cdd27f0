"""Parsing of multiple-choice questions and of the answers models give to them.

The flags give Java's regexes the patterns' Python meaning: ``(?U)`` for Unicode
whitespace, digits and case, ``(?d)`` so that only a line feed ends a line.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.text import (
    SPACE,
    extract,
    split_lines,
    strip,
)

# The text patterns that decide what counts as a question, an answer
# key or a model's choice.
BLOCK_PATTERN = rf"(?sU)Q\d+\..+?Answer:{SPACE}*[A-F0-8]"
MCQ_PATTERN = rf"(?sU)Q\d+\.{SPACE}*(.*?)\n(\(\d+\).*?\n)Answer:{SPACE}*(\d+)"
OPTION_LABEL = rf"(?U)^\(\d+\){SPACE}*"
KEY_PATTERN = rf"(?iU)Answer:{SPACE}*([A-F1-8])"
STEM_PATTERN = rf"(?sU)\A(.*?)\n{SPACE}*-?\(1\)"
CHOICE_PATTERNS = (
    rf"Answer:{SPACE}*([1-8])",
    rf"<final_answer>{SPACE}*([1-8]){SPACE}*</final_answer>",
    rf"The correct option is {SPACE}*\(*([1-8])",
    rf"The final answer is {SPACE}*\(*([1-8])",
    rf"My choice is {SPACE}*\(*([1-8])",
    rf"^{SPACE}*\(*([1-8])\)",
)
LONE_DIGIT = r"(?<![\p{L}\p{N}_])([1-8])(?![\p{L}\p{N}_])"
# Letter by letter, as without regard to case the long s would match an s, which it must
# not here.
ANSWER_LINE = rf"(?U)\A{SPACE}*[Aa][Nn][Ss][Ww][Ee][Rr]:"
INVALID_ANSWER = "Error: Invalid Answer Index"
ERROR_PREFIX = "Error:"
DIFFICULTY_STEPS = ((0.75, "easy"), (0.50, "medium"), (0.25, "hard"))
HARDEST = "very_hard"


def extract_blocks(raw: Column) -> Column:
    """All question blocks of a model's reply, in text order.

    A block ends after one answer character, so ``Answer: 12`` ends at the 1.
    """
    return F.regexp_extract_all(raw, F.lit(BLOCK_PATTERN), F.lit(0))


def capture_groups(pattern: Column) -> Column:
    """Number of capturing groups of a regular expression held in a column."""
    bare = F.regexp_replace(pattern, r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "")
    return F.regexp_count(bare, F.lit(r"\((?!\?)|\(\?P?<(?![=!])"))


def extract_blocks_with(raw: Column, pattern: Column, groups: Column | None = None) -> Column:
    """Blocks found by a template's own pattern, dot matching line breaks.

    A pattern with one capturing group yields that group, one without yields the whole
    match. One with several yields all its groups as a JSON list of texts.
    """
    groups = capture_groups(pattern) if groups is None else groups
    whole = F.concat(F.lit("(?sdU)"), pattern)
    single = F.regexp_extract_all(raw, whole, F.least(groups, F.lit(1)))
    by_group = F.transform(
        F.sequence(F.lit(1), F.greatest(groups, F.lit(1))),
        lambda g: F.regexp_extract_all(raw, whole, g),
    )
    several = F.transform(
        single, lambda _, i: F.to_json(F.transform(by_group, lambda of_group: F.get(of_group, i)))
    )
    return F.when(groups > 1, several).otherwise(single)


def parse_mcq(q: Column) -> Column:
    """Question, options, answer text and number; NULL if the text does not parse.

    The option block runs from the first numbered line to the first line that holds
    a numeric answer. It is matched as one span and split afterwards: repeating a
    lazy group per option selects the same span but backtracks exponentially.
    Letter answers do not parse, and a wrapped option line becomes its own option.
    """
    whole = extract(q, MCQ_PATTERN, 0)
    parts = F.transform(F.array(whole), lambda m: F.when(m.isNotNull(), _mcq_parts(m)))
    return F.transform(parts, lambda p: F.when(p.isNotNull(), _with_answer_text(p)))[0]


def _mcq_parts(match: Column) -> Column:
    """Parts of a matched question; searching the match again is cheap."""
    block = strip(F.regexp_extract(match, MCQ_PATTERN, 2))
    options = F.transform(
        F.split(block, "\n"), lambda o: F.regexp_replace(strip(o), OPTION_LABEL, "")
    )
    return F.struct(
        strip(F.regexp_extract(match, MCQ_PATTERN, 1)).alias("question"),
        options.alias("options"),
        F.regexp_extract(match, MCQ_PATTERN, 3).try_cast("bigint").alias("number"),
    )


def _with_answer_text(parts: Column) -> Column:
    number, options = parts["number"], parts["options"]
    chosen = F.when(
        number.between(1, F.size(options)), F.get(options, (number - 1).cast("int"))
    ).otherwise(F.lit(INVALID_ANSWER))
    return F.struct(
        parts["question"].alias("question"),
        options.alias("options"),
        chosen.alias("answer_text"),
        number.alias("answer_number"),
    )


def answer_key(q: Column) -> Column:
    """The key as an option number, NULL if the answer tag is missing.

    Only the first character after the tag counts: letters A-F and digits 1-8.
    """
    token = F.upper(extract(q, KEY_PATTERN))
    return F.translate(token, "ABCDEF", "123456").cast("int")


def model_choice(raw: Column) -> Column:
    """Option number a model chose, NULL if none is found.

    The order of the patterns decides, not the order of matches in the text.
    """
    tries = [extract(raw, f"(?imdU){p}") for p in CHOICE_PATTERNS]
    return F.coalesce(*tries, extract(raw, LONE_DIGIT)).cast("int")


def question_stem(q: Column) -> Column:
    """Text before option (1), keeping the ``Q1.`` label; empty if there is none."""
    return strip(F.regexp_extract(q, STEM_PATTERN, 1))


def judge_prompt(q: Column, instructions: Column | str) -> Column:
    """The question without its answer lines, framed by the instructions."""
    if isinstance(instructions, str):
        instructions = F.lit(instructions)
    shown = F.filter(split_lines(q), lambda ln: ~ln.rlike(ANSWER_LINE))
    return F.concat(
        instructions, F.lit("\n"), F.array_join(shown, "\n"), F.lit("\n\nYour answer:")
    )


def panel_choice(raw: Column) -> Column:
    """Option a judge chose; NULL for a missing reply, an error or no clear choice."""
    return F.when(raw.isNotNull() & ~raw.startswith(ERROR_PREFIX), model_choice(raw))


def outcome(choice: Column, correct: Column) -> Column:
    """``correct``, ``incorrect``, or ``unanswered`` where there is no choice."""
    result = F.when(choice.isNull(), "unanswered").when(choice == correct, "correct")
    return result.otherwise("incorrect")


def difficulty_tag(ratio: Column) -> Column:
    (first, name), *rest = DIFFICULTY_STEPS
    tag = F.when(ratio >= first, name)
    for bound, name in rest:
        tag = tag.when(ratio >= bound, name)
    return tag.otherwise(HARDEST)


def accuracy(correct: Column, total: Column) -> Column:
    """Share of correct answers, 0 for an empty total."""
    return F.coalesce(F.try_divide(correct, total), F.lit(0.0))


def report_line(
    model: Column, acc: Column, correct: Column, incorrect: Column, unanswered: Column
) -> Column:
    # Fixed value: the line of the report.
    return F.format_string(
        "  %-22s  acc=%.2f%%  (C:%d I:%d U:%d)",
        model,
        acc * 100,
        correct,
        incorrect,
        unanswered,
    )


def reply_failed(raw: Column) -> Column:
    """True for a reply that reports a failure instead of text."""
    return F.coalesce(raw.startswith(ERROR_PREFIX), F.lit(True))
