"""Caller-supplied models as column functions.

Each factory takes ``make_client``, a function that builds the client once per task
and returns the callable that is applied to every row. A failing call never fails
the task: its error is part of the row. Pacing and retries belong to the callable.

Results are marked nondeterministic so that Catalyst neither duplicates nor reorders
calls; a caller that uses a result twice must write it first
(:func:`quizloom.operators.storage.materialise`).
"""

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.batches import by_bytes
from quizloom.functions.journal import ReplyJournal, digest_of
from quizloom.functions.mcq import ERROR_PREFIX
from quizloom.functions.text import words
from quizloom.schemas import GRADE, PANEL_REPLIES, REPLY

DEFAULT_THRESHOLD = 0.5


def _mapper(workers: int):
    if workers <= 1:
        return lambda fn, *cols: list(map(fn, *cols))
    pool = ThreadPoolExecutor(workers)
    return lambda fn, *cols: list(pool.map(fn, *cols))


def _replies(call: Callable, rows: list[tuple], model: str, notes, run: Callable, step: int):
    """``raw, error`` of each row of arguments; known ones are not asked for."""
    keys = [digest_of(row) if notes and row[0] is not None else None for row in rows]
    found = [(notes.get(model, key), None) if key else None for key in keys]
    open_ = [i for i, reply in enumerate(found) if reply is None or reply[0] is None]
    for at in range(0, len(open_), step):
        part = open_[at : at + step]
        for i, (raw, error) in zip(part, run(call, *zip(*(rows[i] for i in part)))):
            found[i] = raw, error
            if keys[i] and raw is not None and error is None and not raw.startswith(ERROR_PREFIX):
                notes.add(model, keys[i], raw)
        if notes:
            notes.flush()
    return found


def text_model(
    make_client: Callable[[], Callable],
    workers: int = 1,
    name: str = "model",
    journal: ReplyJournal | None = None,
) -> Callable:
    """Column function prompt(s) -> ``STRUCT<raw, error>`` with stripped text.

    The client is called with as many arguments as columns are passed. A NULL first
    argument is not sent. ``workers`` calls of one task run at the same time. With a
    ``journal``, replies are kept under the model's ``name`` as they come, and a task that is
    run again asks only for what its predecessor did not get; at most ``workers`` calls in
    flight are lost.
    """

    def answer(client):
        def one(*args):
            if args[0] is None:
                return None, None
            try:
                text = client(*args)
                return (None if text is None else str(text).strip()), None
            except Exception as exc:  # noqa: BLE001 - any client error is a row value
                return None, f"{type(exc).__name__}: {exc}"

        return one

    def replies(batches):
        one, run = answer(make_client()), _mapper(workers)
        notes = journal.of_task() if journal else None
        for batch in batches:
            found = []
            for columns in by_bytes(batch):
                rows = list(zip(*columns))
                found += _replies(one, rows, name, notes, run, max(1, workers) if notes else len(rows))
            if notes:
                notes.flush(now=True)
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.string()) for c in (zip(*found) if found else ([], []))],
                names=["raw", "error"],
            )

    @F.arrow_udf(REPLY)
    def single(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from replies((batch,) for batch in batches)

    @F.arrow_udf(REPLY)
    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from replies(batches)

    single, several = single.asNondeterministic(), several.asNondeterministic()

    def model(*cols):
        return single(cols[0]) if len(cols) == 1 else several(*cols)

    model.name, model.journal = name, journal
    return model


def _client(make_client: Callable[[], Callable]) -> Callable:
    """The client, or one that fails every call with the error of building it."""
    try:
        return make_client()
    except Exception as exc:  # noqa: BLE001 - a judge that cannot be built is a row value
        error = exc

    def broken(*_):
        raise error

    return broken


def judge_panel(
    makers: dict[str, Callable[[], Callable]],
    workers: int | None = None,
    journal: ReplyJournal | None = None,
) -> Callable:
    """Column function prompt, known -> ``ARRAY<STRUCT<model, raw>>``, one entry per model.

    ``raw`` is the stripped reply, or ``Error: ...`` for a failed call. A prompt
    reaches the task once for the whole panel, whose models are asked at the same time
    unless ``workers`` says otherwise; a task opens one client per model. ``known`` are
    replies of the same form that need not be asked for; a ``journal`` keeps new ones, as
    :func:`text_model` does.
    """
    models = list(makers)

    def replies(batches):
        clients = [_client(makers[m]) for m in models]
        run = _mapper(len(models) if workers is None else workers)
        notes = journal.of_task() if journal else None

        def one(prompt, client):
            try:
                return client(prompt).strip()
            except Exception as exc:  # noqa: BLE001 - any client error is a reply
                return f"{ERROR_PREFIX} {type(exc).__name__}: {exc}"

        def answers(prompts, known):
            """One reply per prompt and model, prompt by prompt."""
            found = []
            for prompt, pairs in zip(prompts, known):
                had = {pair["model"]: pair["raw"] for pair in pairs or ()}
                key = digest_of((prompt,)) if notes else None
                found += [had.get(m) or (notes.get(m, key) if notes else None) for m in models]
            open_ = [i for i, raw in enumerate(found) if raw is None]
            asked = [prompts[i // len(models)] for i in open_], [clients[i % len(models)] for i in open_]
            for i, raw in zip(open_, run(one, *asked)):
                found[i] = raw
                if notes and not raw.startswith(ERROR_PREFIX):
                    notes.add(models[i % len(models)], digest_of((prompts[i // len(models)],)), raw)
            if notes:
                notes.flush()
            return found

        for batch in batches:
            rows = []
            for prompts, known in by_bytes(batch, rows=1 if journal else None):
                raws = iter(answers(prompts, known))
                rows += [[{"model": m, "raw": next(raws)} for m in models] for _ in prompts]
            if notes:
                notes.flush(now=True)
            yield pa.array(rows, _PANEL_ARROW)

    @F.arrow_udf(PANEL_REPLIES)
    def ask(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from replies(batches)

    ask = ask.asNondeterministic()
    nothing = F.lit(None).cast(PANEL_REPLIES)

    def panel(prompt, known=None):
        return ask(prompt, nothing if known is None else known)

    panel.models, panel.journal = models, journal
    return panel


_PANEL_ARROW = pa.list_(pa.struct([("model", pa.string()), ("raw", pa.string())]))


def model_grader(
    make_client: Callable[[], Callable],
    workers: int = 1,
    name: str = "grader",
    journal: ReplyJournal | None = None,
) -> Callable:
    """Column function (question, answer, context) -> ``STRUCT<passing, score, error>``.

    The client returns a (passing, score) pair; a failed call has no grades but an error.
    A NULL answer is not graded. A ``journal`` keeps grades for tasks that are run again.
    """

    @F.arrow_udf(GRADE)
    def grade(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        client, run = make_client(), _mapper(workers)
        notes = journal.of_task() if journal else None

        def one(*args):
            if args[1] is None:
                return None, None
            try:
                passing, score = client(*args)
                return json.dumps([bool(passing), float(score)]), None
            except Exception as exc:  # noqa: BLE001 - an ungraded row stays in the report
                return None, f"{type(exc).__name__}: {exc}"

        for batch in batches:
            found = []
            for columns in by_bytes(batch):
                rows = list(zip(*columns))
                found += _replies(one, rows, name, notes, run, max(1, workers) if notes else len(rows))
            if notes:
                notes.flush(now=True)
            grades = [json.loads(raw) if raw else (None, None) for raw, _ in found]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([passing for passing, _ in grades], pa.bool_()),
                    pa.array([score for _, score in grades], pa.float64()),
                    pa.array([error for _, error in found], pa.string()),
                ],
                names=["passing", "score", "error"],
            )

    return grade.asNondeterministic()


def _overlap(part: Column, whole: Column, threshold: float) -> Column:
    distinct = F.array_distinct(words(part))
    shared = F.size(F.array_intersect(distinct, words(whole)))
    score = F.coalesce(F.try_divide(shared, F.size(distinct)), F.lit(0.0))
    error = F.lit(None).cast("string")
    return F.struct(
        (score >= threshold).alias("passing"), score.alias("score"), error.alias("error")
    )


def faithfulness_by_overlap(threshold: float = DEFAULT_THRESHOLD) -> Callable:
    """Grader: share of the answer's distinct words that occur in the context."""
    return lambda question, answer, context: _overlap(answer, context, threshold)


def relevancy_by_overlap(threshold: float = DEFAULT_THRESHOLD) -> Callable:
    """Grader: share of the question's distinct words found in answer or context."""
    return lambda question, answer, context: _overlap(
        question, F.concat_ws(" ", answer, context), threshold
    )
