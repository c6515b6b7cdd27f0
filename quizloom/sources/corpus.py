"""Corpus and index tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.operators.numbering import row_positions
from quizloom.operators.ranges import MAX_RANGES

ROWS_PER_FILE = 1 << 15


def read_corpus(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    text_col: str = "Text",
    id_col: str | None = None,
) -> DataFrame:
    """``doc_id, text`` of a corpus; without an id column, the position is the id.

    Positions count through the files by path.

    Only the named columns are read. Text that is not a string becomes NULL, which
    the length filter drops.
    """
    rows = spark.read.format(format).load(path)
    is_text = rows.schema[text_col].dataType.typeName() in ("string", "varchar", "char")
    text = F.col(text_col) if is_text else F.lit(None).cast("string")
    if id_col is not None:
        return rows.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return row_positions(rows, "doc_id").select("doc_id", text.alias("text"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk metadata as (gzip) JSON lines.

    A gzip file is read by one task; keep a large table as many files or as parquet.
    """
    return spark.read.schema(schemas.CHUNK).json(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.VECTOR).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with their vectors; a query reads only the columns it needs."""
    return spark.read.schema(schemas.INDEX).parquet(path)


def write_index(index: DataFrame, path: str, in_order: bool = False) -> None:
    """Files hold ranges of ids in order, so a lookup of few ids skips most row groups.

    Ids are dense, so a row's file follows from its id: no row is computed before it is
    written but for its id, and none twice. ``in_order`` says that partitions hold ranges
    of ids in order already, as :func:`quizloom.plans.index.embed_corpus` makes them.
    """
    rows = index.select(*schemas.INDEX.names)
    if not in_order:
        last = rows.agg(F.max("chunk_id")).first()[0] or 0
        width = max(ROWS_PER_FILE, -(-(last + 1) // MAX_RANGES))
        file = F.expr(f"CAST(chunk_id div {width} AS INT)")
        rows = rows.repartitionById(last // width + 1, file).sortWithinPartitions("chunk_id")
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.parquet(path)
