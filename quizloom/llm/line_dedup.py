"""Line deduplication by levelled sorted runs of line hashes.

Documents come in batches of rising doc_id. A run is a table of (line hash, owner), the
owner being the smallest doc_id that holds the line; it is bucketed and sorted by the
hash. Every batch is merged against the runs: hashes found there belong to an earlier
document, the others become the batch's own run. ``fanout`` runs of one level are
compacted into one run of the next, so a batch meets few runs however many came before.

Runs are bucketed tables, so merging a batch moves the batch's hashes only. Keys are
reduced to one row per batch before they move; the join that hands the verdict back to
each line is a plain one, in which Spark splits the partitions of very common lines.

A line's key is the line stripped of separators at both ends with A-Z lower-cased; keys
are compared by their 128-bit digests. Keys below ``min_chars`` code points are never
dropped.

Defined results: NULL or empty text is one empty line. Rows with the same doc_id are
one document, also where their texts differ; rows without a doc_id are together one
document that comes last. Other columns are passed through; an empty table gives an
empty one.
"""

import hashlib
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm.tasks import releasing
from quizloom.llm.text import SPACES, UPPER, hide, with_fields
from quizloom.operators.storage import new_folder

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
_LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def keyed_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, h``: one row per line whose key is long enough."""
    lines = documents.select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.explode(F.split("text", "\n")).alias("line")
    )
    keys = lines.select("id", line_key(F.col("line")).alias("key"))
    return keys.filter(F.length("key") >= min_chars).select(
        "id", F.unhex(F.md5("key")).alias("h")
    )


@dataclass
class LineRuns:
    """The runs by level, newest last. Each holds ``h, owner``; no hash is in two."""

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def store(self, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
        """Write rows bucketed and sorted by ``h``; the table and its path."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = new_folder(self.spark, name)
        table = f"{name}_{uuid.uuid4().hex}"
        writer = rows.repartition(buckets, "h").write.format("parquet").option("path", path)
        writer.bucketBy(buckets, "h").sortBy("h").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table), path

    def close(self) -> None:
        """Take the runs out of the catalog."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()

    def merge(self, lines: DataFrame, last: bool = False) -> DataFrame:
        """Add a batch of ``id, h``. Returns ``h, owner`` of the keys that cost a line.

        After the ``last`` batch nothing reads the runs, so they are not compacted again.

        Those are the keys an earlier batch owns and those that several documents of
        this batch hold. All ids must be above those of earlier batches.
        """
        keys = lines.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        owners = []
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.withColumnRenamed("owner", f"owner{i}"), "h", "left")
            owners.append(F.col(f"owner{i}"))
        fresh = F.coalesce(*owners).isNull() if owners else F.lit(True)
        merged = keys.select(
            "h",
            F.coalesce(*owners, "low").alias("owner"),
            fresh.alias("fresh"),
            (~fresh | (F.col("low") != F.col("high"))).alias("shared"),
        )
        table, path = self.store(merged, "line_batch")
        if not last:
            self._push(0, table.filter("fresh").select("h", "owner"))
        # Read back as plain files: a bucketed side would keep Spark from splitting
        # the partition of a line that very many documents hold.
        plain = self.spark.read.schema(merged.schema).parquet(path)
        return plain.filter("shared").select("h", "owner")

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return
        together = self.levels[level][0]
        for other in self.levels[level][1:]:
            together = together.unionByName(other)
        self.levels[level] = []
        self._push(level + 1, self.store(together, "line_run")[0])


def _batch_of(doc_id: Column, bounds: list[int]) -> Column:
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + (doc_id > bound).cast("int")
    return batch


def dropped_keys(
    documents: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``id, drop``: the digests of the lines that each document loses."""
    spark = documents.sparkSession
    shares = [i / batches for i in range(1, batches)]
    cuts = documents.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
    bounds = sorted(set(cuts or []))
    lines = keyed_lines(documents, min_chars).withColumn("batch", _batch_of(F.col("id"), bounds))
    path = new_folder(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    schema = "id BIGINT, h BINARY, batch INT"
    stored = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, fanout)
    verdicts = None
    for batch in range(len(bounds) + 1):
        own = stored.filter(F.col("batch") == batch).select("id", "h")
        shared = runs.merge(own, last=batch == len(bounds))
        shared = shared.withColumn("batch", F.lit(batch))
        verdicts = shared if verdicts is None else verdicts.unionByName(shared)
    runs.close()
    lost = stored.join(verdicts, ["batch", "h"]).filter("id != owner")
    return lost.groupBy("id").agg(F.collect_set("h").alias("drop"))


def _rebuild(batches):
    """Text without the dropped lines, in Arrow batches; one document at a time."""
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("_drop", "text")}
        kept, n_lines, n_dropped, digests = [], [], [], []
        for text, drop in zip(batch.column("text"), batch.column("_drop")):
            lines = (text.as_py() or "").split("\n")
            n_lines.append(len(lines))
            if drop.is_valid:
                lost = set(drop.as_py())
                lines = [line for line in lines if _digest(line) not in lost]
            kept.append("\n".join(lines))
            n_dropped.append(n_lines[-1] - len(lines))
            digests.append(hashlib.sha256(kept[-1].encode()).hexdigest())
        columns |= {
            "text": pa.array(kept, pa.string()),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_dropped": pa.array(n_dropped, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _digest(line: str) -> bytes:
    return hashlib.md5(line.encode().strip(SPACES.encode()).lower()).digest()


def line_dedup(
    documents: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``documents`` with the kept text, n_lines, n_dropped and kept_sha256.

    Of a line with its key in several documents all occurrences go but those in the
    document with the smallest doc_id. Columns of the input with one of the three new
    names are replaced.
    """
    base, show = hide(documents, "doc_id", "text")
    drops = dropped_keys(base, min_chars, batches, fanout)
    rest = [c for c in base.columns if c != "text"]
    rows = (
        base.withColumn("_id", F.coalesce("doc_id", F.lit(_LAST)))
        .join(drops.select(F.col("id").alias("_id"), F.col("drop").alias("_drop")), "_id", "left")
        .select(*rest, "text", "_drop")
    )
    added = {"n_lines": "long", "n_dropped": "long", "kept_sha256": "string"}
    schema = with_fields(base.select(*rest, "text").schema, added)
    return show(rows.mapInArrow(releasing(_rebuild), schema), *added)
