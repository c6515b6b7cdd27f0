"""JSON documents read as text, one per file or one per line."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_texts(spark: SparkSession, path: str, pattern: str, file_per_row: bool) -> DataFrame:
    """``text, path, name, place`` of the files that match; empty lines are no rows.

    ``place`` numbers the rows of a scan partition; with the path it names a line.
    """
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=file_per_row)
    rows = files.select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.monotonically_increasing_id().alias("place"),
    )
    return rows if file_per_row else rows.filter(F.btrim("text") != "")


def read_small_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``text, path, name`` of the files that match, none of them compressed.

    Spark's reader of whole texts copies the cluster's settings for each file, which takes
    longer than reading a small one; its reader of bytes does not. Bytes become the same text.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        F.col("content").cast("string").alias("text"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
    )


def parse(text: Column, schema: StructType) -> Column:
    """The document, NULL if the text is not one; unknown fields are left out."""
    marked = StructType([*schema.fields, StructField("_bad", StringType())])
    doc = F.from_json(text, marked, {"columnNameOfCorruptRecord": "_bad"})
    return F.when(doc["_bad"].isNull(), doc.dropFields("_bad"))
