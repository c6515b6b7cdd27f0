"""Evaluation of questions by a panel of judge models."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.journal import ReplyJournal
from quizloom.functions.mcq import judge_prompt
from quizloom.functions.models import judge_panel
from quizloom.operators import panel
from quizloom.operators.asking import known_of_panel
from quizloom.operators.storage import materialise
from quizloom.sources.questions import write_document, write_ordered


@dataclass(frozen=True)
class Judge:
    """A panel member. Only enabled judges, those with a credential say, are asked."""

    name: str
    make_client: Callable[[], Callable]
    enabled: bool = True


@dataclass(frozen=True)
class PanelResult:
    questions: DataFrame
    responses: DataFrame
    models: list[str]

    def summary(self) -> DataFrame:
        return panel.model_summary(self.questions, self.responses, self.models)

    def per_question(self) -> DataFrame:
        return panel.question_report(self.questions, self.responses)

    def debug(self) -> DataFrame:
        return panel.debug_rows(self.questions, self.responses)

    def document(self) -> DataFrame:
        return panel.summary_document(self.questions, self.summary())

    def lines(self) -> DataFrame:
        return panel.report_lines(self.summary())

    def write(self, folder: str, debug: bool = False) -> None:
        """Model summary, question report and, on request, the debug rows."""
        write_document(self.document(), f"{folder}/summary")
        write_ordered(self.per_question(), f"{folder}/questions", "file_path", "pos")
        if debug:
            write_ordered(self.debug(), f"{folder}/debug", "file", "pos")


def ask_panel(
    questions: DataFrame,
    judges: list[Judge],
    instructions: str,
    workers: int | None = None,
    partitions: int | None = None,
    journal: ReplyJournal | None = None,
) -> DataFrame:
    """Every enabled judge's reply to every gradable question, stored once.

    With a ``journal``, replies are kept as they come; judges are asked only what they have
    not answered in an earlier task or run.

    Work is spread by question, not by model: a panel of eight models would otherwise
    make eight large tasks. Pairing questions with models is a narrow explode.
    """
    enabled = [j for j in judges if j.enabled]
    keyed = panel.gradable(panel.with_keys(questions)).select(*panel.KEY, "q_raw")
    if partitions is not None:
        keyed = keyed.repartition(partitions, *panel.KEY)
    prompts = keyed.select(*panel.KEY, judge_prompt(F.col("q_raw"), instructions).alias("prompt"))
    ask = judge_panel({j.name: j.make_client for j in enabled}, workers, journal)
    known = None
    if journal is not None:
        prompts = known_of_panel(prompts, journal, F.col("prompt"), ask.models, "known")
        known = F.col("known")
    replies = prompts.select(*panel.KEY, F.explode(ask(F.col("prompt"), known)).alias("reply"))
    return materialise(replies.select(*panel.KEY, "reply.model", "reply.raw"))


def evaluate_panel(
    questions: DataFrame,
    judges: list[Judge],
    instructions: str,
    workers: int | None = None,
    partitions: int | None = None,
    journal: ReplyJournal | None = None,
) -> PanelResult:
    """Ask the panel and hold what is needed for its reports."""
    responses = ask_panel(questions, judges, instructions, workers, partitions, journal)
    return PanelResult(questions, responses, [j.name for j in judges if j.enabled])


def grade_responses(
    questions: DataFrame, responses: DataFrame, models: list[str]
) -> PanelResult:
    """Reports over responses asked for earlier; those of other models are left out."""
    return PanelResult(questions, responses.filter(F.col("model").isin(models)), models)
