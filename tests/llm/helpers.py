"""Small tables with the awkward rows that every operator must handle."""

SENTENCE = "the quick brown fox jumps over the lazy dog near the old river bank today"

EDGE_ROWS = [
    (1, SENTENCE, "en", "src1", 10),
    (2, SENTENCE, "en", "src1", 10),
    (2, SENTENCE, "en", "src1", 10),
    (3, None, None, None, None),
    (4, "", "en", "src2", 0),
    (None, SENTENCE + " again", "de", "src3", 1),
    (None, None, None, None, None),
    (5, "  \n\t ", "fr", "src0", 4),
    (6, "word " * 30_000, "en", "src1", 150_000),
    (7, "x" * 200_000, "en", "odd", 200_000),
    (8, "ünïcödé ☃ 😀 line\nshared line of text\nlast", "es", "src4", 3),
    (9, "shared line of text\nown line number nine", "es", "src4", 3),
]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def edge_documents(spark, extra: str | None = None):
    """The awkward rows; ``extra`` adds a column of that name."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    return df.withColumn(extra, F.lit("mine")) if extra else df


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
