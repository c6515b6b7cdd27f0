"""Replies of models that outlive the task, and the run, that paid for them.

A task adds its replies to the journal as it gets them, in small files that appear whole or
not at all. Each part of a run has a folder of its own there; a task that is run again,
after a loss say, reads what its predecessors got and asks for the rest. A later run joins
its prompts with all replies of earlier ones before it asks anybody
(:func:`quizloom.operators.asking.ask`).

A reply is known by its model's name and a digest of everything that was asked. Failures are
never kept, so they are asked for again.
"""

import hashlib
import time
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.operators.storage import delete_folder, new_name, open_path, path_exists

FLUSH_ROWS = 256
FLUSH_SECONDS = 2.0
_REPLIES = "model STRING, digest STRING, raw STRING"
_SEPARATOR = "\x1f"


def asked_digest(*asked: Column) -> Column:
    """Names what is asked; :func:`digest_of` is the same in a task."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in asked]
    return F.sha2(F.concat_ws(_SEPARATOR, *texts), 256)


def digest_of(asked: tuple) -> str:
    texts = ("" if value is None else str(value) for value in asked)
    return hashlib.sha256(_SEPARATOR.join(texts).encode("utf-8", "surrogatepass")).hexdigest()


@dataclass(frozen=True)
class ReplyJournal:
    """A folder that all executors share."""

    path: str
    flush_rows: int = FLUSH_ROWS
    flush_seconds: float = FLUSH_SECONDS
    # One name for everything that is asked through this object.
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def replies(self, spark: SparkSession) -> DataFrame:
        """``model, digest, raw`` of all kept replies, one per model and digest."""
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], _REPLIES)
        stored = spark.read.schema(_REPLIES).option("recursiveFileLookup", True).parquet(self.path)
        return stored.groupBy("model", "digest").agg(F.min("raw").alias("raw"))

    def compact(self, spark: SparkSession) -> None:
        """Put all small files together; to be called while nobody writes."""
        if not path_exists(spark, self.path):
            return
        old = self._folders()
        self.replies(spark).write.parquet(f"{self.path}/{new_name('all')}")
        for folder in old:
            delete_folder(spark, folder)

    def _folders(self) -> list[str]:
        system, name = open_path(self.path)
        prefix = self.path.rstrip("/")
        return [f"{prefix}/{info.base_name}" for info in system.get_file_info(FileSelector(name))]

    def of_task(self) -> "TaskJournal":
        """The part of the journal that belongs to the running task, with what it has."""
        return TaskJournal(self, TaskContext.get().partitionId())


class TaskJournal:
    """Replies of one part of a run."""

    def __init__(self, journal: ReplyJournal, part: int):
        self._journal = journal
        self._system, self._folder = open_path(f"{journal.path.rstrip('/')}/run-{journal.run}/part-{part:06d}")
        self._known: dict[tuple[str, str], str] = {}
        self._new: list[tuple[str, str, str]] = []
        self._flushed = time.monotonic()
        for info in self._system.get_file_info(FileSelector(self._folder, allow_not_found=True)):
            if not info.base_name.startswith("."):
                rows = pq.read_table(self._system.open_input_file(info.path)).to_pydict()
                self._known.update(zip(zip(rows["model"], rows["digest"]), rows["raw"]))

    def get(self, model: str, digest: str) -> str | None:
        return self._known.get((model, digest))

    def add(self, model: str, digest: str, raw: str) -> None:
        self._known[model, digest] = raw
        self._new.append((model, digest, raw))

    def flush(self, now: bool = False) -> None:
        """Write what is new if it is much or old enough, or ``now``."""
        late = time.monotonic() - self._flushed >= self._journal.flush_seconds
        if self._new and (now or late or len(self._new) >= self._journal.flush_rows):
            columns = dict(zip(("model", "digest", "raw"), map(list, zip(*self._new))))
            self._system.create_dir(self._folder, recursive=True)
            name = f"{uuid.uuid4().hex}.parquet"
            hidden = f"{self._folder}/.{name}"
            with self._system.open_output_stream(hidden) as out:
                pq.write_table(pa.table(columns), out)
            self._system.move(hidden, f"{self._folder}/{name}")
            self._new = []
        if now or late:
            self._flushed = time.monotonic()
