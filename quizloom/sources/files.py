"""Files that tasks write by themselves, one per row."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quizloom.operators.storage import open_path

# Tasks that write files, per core.
TASKS_PER_CORE = 2


def write_texts(rows: DataFrame, folder: str) -> int:
    """Write each row's ``text`` as the file ``name`` in the shared folder; returns their number.

    A file appears whole or not at all; a task that is run again writes it anew. Nothing of a
    text passes through the driver. NULL is an empty file. The rows are dealt out first, as
    many small ones can lie in one partition.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_path(folder)
        system.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                hidden = f"{root}/.{name.as_py()}.{attempt}"
                with system.open_output_stream(hidden, compression=None) as out:
                    out.write((text.as_py() or "").encode())
                system.move(hidden, f"{root}/{name.as_py()}")
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    tasks = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    dealt = rows.select("name", "text").repartition(tasks)
    written = dealt.mapInArrow(write, "files BIGINT")
    return written.groupBy().sum("files").first()[0] or 0
